import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from sparkcount.session import shared_dir
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster: a fresh shared folder only when none is set
    shared_dir(s)
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="sparkcount-test-")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
