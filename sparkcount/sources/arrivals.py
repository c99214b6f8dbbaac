"""Arrival files: a bounded table laid out as the files of a stream.

``spool`` writes one file per batch number and gives the files modification
times in that order, because the file source admits files by their time.
``read_arrivals`` reads them as a stream with admission control: so many files
per micro-batch, whatever waits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Any fixed time will do: files are told apart by the seconds after it.
_FIRST_MS = 1_700_000_000_000


def spool(items: DataFrame, path: str, batch: str = "arrival", fmt: str = "parquet") -> None:
    """Append ``items`` to the arrival files below ``path``: one folder with one
    file per value of the non-negative long column ``batch``.  Values must grow
    from call to call; the driver touches one entry per file.  As ``text`` the one
    other column, a string, is written a line to a row."""
    spark = items.sparkSession
    items.repartition(batch).write.mode("append").partitionBy(batch).format(fmt).save(path)
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(top):
        name = folder.getPath().getName()
        if not name.startswith(f"{batch}="):
            continue
        at = _FIRST_MS + 1000 * int(name.split("=", 1)[1])
        for file in fs.listStatus(folder.getPath()):
            if file.getModificationTime() != at:
                fs.setTimes(file.getPath(), at, -1)


def read_arrivals(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """The arrival files as a stream; ``schema`` names the columns wanted."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))
