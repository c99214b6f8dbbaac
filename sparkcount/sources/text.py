"""Text-file sources: edge lists (``u,v`` per line) and one-document-per-line files.

The line parsers take any DataFrame with one text column, so the file readers
and the registered queries go through the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_edges(lines: DataFrame, column: str = "value") -> DataFrame:
    """``u,v`` lines into ``(u BIGINT, v BIGINT)``, strictly.

    A line must have exactly two fields that are integers (blanks around them
    are allowed); anything else - an empty field or line, quotes, a third field -
    is an error.  The check is a filter, so it also runs when the columns are
    not read (``count()``)."""
    parts = F.split(F.col(column), ",", -1)
    number = r"^\s*[+-]?[0-9]+\s*$"
    ok = (F.size(parts) == 2) & F.get(parts, F.lit(0)).rlike(number) & F.get(parts, F.lit(1)).rlike(number)
    strict = F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("not an edge 'u,v': "), F.coalesce(F.col(column), F.lit("NULL")))).cast("boolean"))
    return lines.where(strict).select(F.get(parts, F.lit(0)).cast("bigint").alias("u"),
                                      F.get(parts, F.lit(1)).cast("bigint").alias("v"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """An edge file (or folder of files) through ``parse_edges``; split by Spark's
    input format, so this scales with the number of files and blocks."""
    return parse_edges(spark.read.text(path))


def line_documents(texts: DataFrame, *keep: str, column: str = "value") -> DataFrame:
    """``(keep..., text)``: one document per line of a text column."""
    return texts.select(*keep, F.explode(F.split(F.col(column), "\n", -1)).alias("text"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each line of a text file is one document: ``(text)``.

    A line has no id of its own that survives another way of splitting the
    files, so none is made up: operators per document take the caller's.  The
    number of partitions follows Spark's split settings
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``)."""
    return line_documents(spark.read.text(path))
