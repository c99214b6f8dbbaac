"""Streaming source of integer items, one per line or one per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_items(spark: SparkSession, fmt: str = "text", path: str | None = None,
               options: dict | None = None, column: str = "value",
               schema: str | None = None, how: str = "exact") -> DataFrame:
    """Unbounded items as a streaming DataFrame ``(item BIGINT)``.

    ``fmt`` is any Structured Streaming source: ``text`` / ``csv`` /
    ``parquet`` directories in tests, ``rate`` or ``kafka`` by option on a
    cluster.  ``column`` names the field that holds the integer; text is
    parsed strictly (a non-integer raises under ANSI casts).  ``how="floor"``
    takes the floor of a numeric column.
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path) if path is not None else reader.load()
    raw = F.col(column)
    if fmt in ("text", "socket", "kafka"):
        raw = F.trim(raw.cast("string"))
    if how == "floor":
        raw = F.floor(raw)
    elif how != "exact":
        raise ValueError(f"unknown how {how!r}")
    return df.select(raw.cast("bigint").alias("item"))
