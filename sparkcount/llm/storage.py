"""Shared-folder tables that cut lineage, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from sparkcount.session import shared_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application).

    The zip is made on the driver and sent by ``addPyFile``; a cluster where the
    package is installed does not need it and is not harmed by it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parent = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="sparkcount-py-"), "sparkcount.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


class Work:
    """One run's folder below ``spark.checkpoint.dir``; ``cut`` writes a table
    there and returns it re-read, so later plans start from files that every
    executor sees and Spark's commit protocol has made whole."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def cut(self, df: DataFrame, tag: str = "t") -> DataFrame:
        path = f"{self.root}/{self._n:03d}-{tag}"
        self._n += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
