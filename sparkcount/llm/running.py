"""Running totals over a total order, without one task that sees all rows.

The rows are range-partitioned and sorted by the order; each task counts from
zero within its range, and the ranges' totals (one row per partition, so their
broadcast is bounded by the partition count) give every range its start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkcount.llm.storage import Work


def _counting(value: str):
    def kernel(batches):
        part, base = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = len(batch)
            v = np.asarray(batch.column(batch.schema.get_field_index(value)).cast(pa.int64()))
            end = base + np.cumsum(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(end - v)],
                names=[*batch.schema.names, "part", "before"])
            if n:
                base = int(end[-1])
    return kernel


def running_total(df: DataFrame, order: list[Column], value: str, work: Work, tag: str = "running") -> DataFrame:
    """``df`` (a written table without columns ``part`` or ``before``) with
    ``before`` = the sum of the long column ``value`` over all earlier rows of
    ``order``.  Order by a column of distinct values last, so that rows that
    tie otherwise can lie in different ranges."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    placed = work.cut(ranged.mapInArrow(_counting(value), f"{schema}, part bigint, before bigint"), tag)
    totals = placed.groupBy("part").agg(F.sum(value).alias("n"))
    first = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return placed.join(F.broadcast(first), "part").withColumn(
        "before", F.col("before") + F.col("first")).drop("part", "first")
