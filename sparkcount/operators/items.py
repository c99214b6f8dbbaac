"""Operators over a stream of integer items.

Input: ``(batch_id BIGINT, item BIGINT, ...)``.  In a streaming query
``batch_id`` is the micro-batch; in the bounded form it is the hour of
arrival.  The aggregates here are plain ``groupBy``s, so the same function
serves a bounded DataFrame and - where Structured Streaming allows one
aggregation - a streaming one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of the per-batch ledger summed inside one window partition; blocks of
# batches are offset by a second, much smaller window (see ``running_sizes``).
_BLOCK = 4096


def batch_sizes(items: DataFrame) -> DataFrame:
    """``(batch_id, n)``: items per batch; an empty batch has no row."""
    return items.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


def _prefix(rows: DataFrame, id_: str, value: str, block: int, levels: int) -> DataFrame:
    """``rows`` and ``running``: the sum of ``value`` up to each id, in id order.

    Ids are cut into blocks of ``block`` consecutive ids, summed inside each
    block by a window partitioned by block, and offset by the blocks before -
    for which the same is done ``levels`` times, so that sparse ids (epoch
    milliseconds, say) do not leave one window with a row per batch."""
    if levels == 0:
        w = Window.orderBy(id_).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("running", F.sum(value).over(w))
    # non-NULL by declaration (batch ids are never NULL): otherwise the join
    # below infers an ``isnotnull`` filter on one branch only, the two uses of
    # ``rows`` stop being equal plans, and the items are scanned twice
    blk = F.coalesce(F.floor(F.col(id_) / block), F.lit(0).cast("bigint"))
    b = rows.withColumn(f"blk{levels}", blk)
    inside = Window.partitionBy(f"blk{levels}").orderBy(id_).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("local", F.sum(value).over(inside))
    totals = b.groupBy(f"blk{levels}").agg(F.sum(value).alias("tot"))
    offsets = _prefix(totals, f"blk{levels}", "tot", block, levels - 1).select(
        f"blk{levels}", (F.col("running") - F.col("tot")).alias("off"))
    return local.join(offsets, f"blk{levels}").select(
        *rows.columns, (F.col("local") + F.col("off")).alias("running"))


def running_sizes(sizes: DataFrame, block: int = _BLOCK, levels: int = 2) -> DataFrame:
    """``(batch_id, n, running)``: stream length after each batch.

    The last, unpartitioned window has a row per ``block ** levels`` ids
    (16.8 M by default: about 100,000 rows for the milliseconds of 50 years)."""
    return _prefix(sizes, "batch_id", "n", block, levels).select(
        "batch_id", "n", F.col("running").cast("bigint").alias("running"))


def kept_batches(items: DataFrame, threshold: int, on_stop: str = "drop") -> DataFrame:
    """Items of the batches that are processed under the stop rule.

    The stream stops once its length reaches ``threshold``.  ``drop``: the
    batch that reaches it, and every later one, only add to the length.
    ``keep``: they are processed too, so every item is kept.
    """
    if on_stop == "keep":
        return items
    if on_stop != "drop":
        raise ValueError(f"unknown on_stop {on_stop!r}")
    # Lengths only grow, so the kept batches are those before the first batch
    # that reaches the threshold: one number, applied as a scalar subquery -
    # the items are filtered where they are read, never joined or shuffled.
    ledger = running_sizes(batch_sizes(items))
    return items.sparkSession.sql(
        f"""SELECT * FROM {{items}} WHERE batch_id < coalesce(
              (SELECT min(batch_id) FROM {{ledger}} WHERE running >= {int(threshold)}),
              9223372036854775807)""",
        items=items, ledger=ledger)


def batches_until(items: DataFrame, threshold: int) -> DataFrame:
    """Items of the batches up to and with the one that reaches ``threshold``:
    what a ``keep`` run has processed when it stops."""
    ledger = running_sizes(batch_sizes(items))
    return items.sparkSession.sql(
        f"""SELECT * FROM {{items}} WHERE batch_id <= coalesce(
              (SELECT min(batch_id) FROM {{ledger}} WHERE running >= {int(threshold)}),
              9223372036854775807)""",
        items=items, ledger=ledger)


def in_interval(items: DataFrame, left: int, right: int) -> DataFrame:
    """Items with ``left <= item <= right``.  A stored ``item`` column is filtered
    in the Parquet scan; for a computed one (``floor(value)``) only the NULL
    check reaches it."""
    return items.where(F.col("item").between(left, right))


def batch_frequencies(items: DataFrame) -> DataFrame:
    """``(batch_id, item, n)``."""
    return items.groupBy("batch_id", "item").agg(F.count(F.lit(1)).alias("n"))


def running_frequencies(items: DataFrame) -> DataFrame:
    """``(item, freq)`` over everything given; works as a streaming aggregate.

    A hot item costs one row per task before the shuffle (partial
    aggregation), so skew in the items needs no salt here."""
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))


def batch_distinct(items: DataFrame) -> DataFrame:
    """``(batch_id, item)``: distinct items within each batch."""
    return items.select("batch_id", "item").dropDuplicates(["batch_id", "item"])


def running_distinct(items: DataFrame) -> DataFrame:
    """``(item)``: all distinct items seen; append-mode safe in streaming."""
    return items.select("item").dropDuplicates(["item"])


def largest_item(items: DataFrame) -> DataFrame:
    return items.agg(F.max("item").alias("largest_item"))


def stream_length(items: DataFrame) -> DataFrame:
    """Every item received, in or out of the interval, kept or dropped."""
    return items.agg(F.count(F.lit(1)).alias("stream_length"))
