"""Session construction and the shared folder used to cut lineage.

Library functions never build a session themselves; they take the caller's.
``get_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "sparkcount", extra: dict | None = None) -> SparkSession:
    """Local session with AQE, skew-join splitting and no UI."""
    master = master or "local[%s]" % os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a table of one row group is one mapper: reading its shuffle mapper by
        # mapper would leave the rest of the stage to one task
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: the value of ``spark.checkpoint.dir`` itself.

    The same setting gives the same folder in every application, so named
    state below it is found again after a driver restart.  On a cluster the
    setting must name a shared file system (unset there is an error); it is
    only filled in here when unset in local mode, as in tests.
    """
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared "
                "folder (a machine-local temporary folder would lose state with its executor)")
        current = tempfile.mkdtemp(prefix="sparkcount-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    return current
