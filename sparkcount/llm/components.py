"""Connected components of a distributed edge table (large-star / small-star).

Each round rewires every node to its smallest known neighbour; the edge table
never grows, is written after each step, and nothing but two numbers per round
reaches the driver.  Rounds stop when the edges no longer change: then every
node hangs on the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.llm.storage import Work


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def connected_components(edges: DataFrame, work: Work) -> DataFrame:
    """``(id, root)`` for every node of ``edges (a, b)`` but the roots themselves;
    ``root`` is the smallest node of the component.  Loops, repeats and either
    direction are allowed in ``edges``."""
    e = work.cut(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = work.cut(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")), "low")
        large = work.cut(both.where("v > u").join(low, "u").select(
            F.col("m").alias("a"), F.col("v").alias("b")).distinct(), "large")
        low = work.cut(large.groupBy("b").agg(F.min("a").alias("m")), "low")
        small = large.join(low, "b").where("a <> m").select(
            F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
            low.select(F.col("m").alias("a"), "b"))
        e = work.cut(small.distinct(), "small")
        now = _state(e)
        if now == state:
            break
        state = now
    return e.select(F.col("b").alias("id"), F.col("a").alias("root"))
