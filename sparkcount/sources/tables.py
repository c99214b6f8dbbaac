"""Inputs derived from the given parquet tables (``<sf_dir>/<name>.parquet``).

Only the columns an operator needs are selected, so Catalyst prunes the
parquet scan to them (``ReadSchema`` shows two columns for the edge list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pairs ``(u, v)`` = ``(l_partkey, l_suppkey)``, repeats kept.

    Parts and suppliers share one id space, so this is a graph with
    triangles; ``distinct_edges`` drops repeated ordered pairs.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").cast("bigint").alias("u"),
                     F.col("l_suppkey").cast("bigint").alias("v"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` - one row is one document, whole text."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def hour_index(ts: Column) -> Column:
    """Hours since 1970-01-01 of a TIMESTAMP_NTZ, free of the session time zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return (days.cast("bigint") * 24 + F.hour(ts)).cast("bigint")


def items(spark: SparkSession, sf_dir: str, kind: str = "value") -> DataFrame:
    """Integer stream stand-in from ``events``: ``(event_id, batch_id, item)``.

    ``batch_id`` is the hour of ``ts`` (the bounded form of a micro-batch).
    ``kind``: ``value`` = floor(value) (skewed, many items), ``skewed`` =
    floor(value / 25) (one item holds about 39 %), ``flat`` = user_id.
    """
    ev = table(spark, sf_dir, "events")
    if kind == "value":
        item = F.floor(F.col("value"))
    elif kind == "skewed":
        item = F.floor(F.col("value") / 25)
    elif kind == "flat":
        item = F.col("user_id")
    else:
        raise ValueError(f"unknown item kind {kind!r}")
    return ev.select("event_id", hour_index(F.col("ts")).alias("batch_id"),
                     item.cast("bigint").alias("item"))
