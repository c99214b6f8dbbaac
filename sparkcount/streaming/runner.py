"""Structured Streaming runner for the item statistics.

``foreachBatch`` receives each micro-batch and writes three small tables
under a folder of the shared checkpoint directory, each partitioned by
``batch_id``:

* ``ledger``: ``(n, kept)`` - items in the batch (every item) and whether
  the stop rule let the batch be processed;
* ``freq``: ``(item, n)`` - counts of the kept items in the interval;
* ``sketch``: ``(j, k, c)`` - the batch's count sketch (linear, so the
  sketch of the stream is the sum of the batch sketches).

The ledger row is written last and is the batch's commit mark: results
read only the partials of batches in the ledger, so a batch cut short by a
stop or a crash is either replayed whole or counts nowhere.  A replayed batch
(at-least-once delivery) overwrites its own ``batch_id`` partitions, so
totals stay exact.  The stream length before a batch is read from ledger
rows with a *smaller* ``batch_id``, so a replay is not counted against
itself.  When the length reaches the threshold the callback only sets an
event; the caller's thread stops the query once the running batch is done.

Final statistics are ordinary batch queries over the partials, which stay
distributed: nothing but the per-batch item counts reaches the driver.

Every ``compact_every`` batches the partials of committed batches are folded
into one base snapshot (``base/upto=<id>``), so a stream that runs for days
keeps a bounded number of folders.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcount.operators import items as I
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.functions.frames import merge_single_rows
from sparkcount.session import shared_dir


_SCHEMA = {
    "freq": "item BIGINT, n BIGINT, batch_id BIGINT",
    "sketch": "j INT, k BIGINT, c BIGINT, batch_id BIGINT",
    "ledger": "n BIGINT, kept BOOLEAN, batch_id BIGINT",
}


def drive(query, stop_event: threading.Event, poll: float = 0.5, timeout: float | None = None,
          settle_timeout: float | None = None) -> None:
    """Wait on this thread until the stop event, the end of the query's input or
    ``timeout``; let the running batch end, however long it takes, then stop the
    query.  A batch that still runs after ``settle_timeout`` seconds (if given)
    is an error, as is a failed query."""
    waited = 0.0
    while query.isActive and not stop_event.is_set():
        stop_event.wait(poll)
        waited += poll
        if timeout is not None and waited >= timeout:
            break
    settle = 0.0
    while query.isActive and query.status.get("isTriggerActive"):
        if settle_timeout is not None and settle >= settle_timeout:
            query.stop()
            raise TimeoutError(f"the running batch did not end in {settle_timeout} s; "
                               "it is not in the ledger")
        query.awaitTermination(0.2)
        settle += 0.2
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class ItemStreamRun:
    """One run of the item-statistics stream.

    ``left``/``right``: interval of interest (``None`` keeps every item).
    ``threshold``: stop once the stream length reaches it (``None``, the
    default: no stop rule).  ``on_stop``:
    ``drop`` - the batch that reaches the threshold and later ones only add
    to the length; ``keep`` - they are processed as well.
    """

    def __init__(self, spark: SparkSession, name: str, prm: S.SketchParams | None = None,
                 left: int | None = None, right: int | None = None,
                 threshold: int | None = None, on_stop: str = "drop", root: str | None = None,
                 compact_every: int = 200):
        if on_stop not in ("drop", "keep"):
            raise ValueError(f"unknown on_stop {on_stop!r}")
        self.spark = spark
        self.prm = prm
        self.left, self.right = left, right
        self.threshold = threshold
        self.on_stop = on_stop
        self.root = f"{(root or shared_dir(spark)).rstrip('/')}/{name}"
        self.stop_event = threading.Event()
        self.query = None
        self._sizes: dict[int, int] | None = None
        self._base_len = 0
        self._carried = 0
        self.compact_every = compact_every

    # ---- paths ----
    def _path(self, table: str, batch_id: int | None = None) -> str:
        p = f"{self.root}/{table}"
        return p if batch_id is None else f"{p}/batch_id={batch_id}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), hpath

    def _exists(self, table: str) -> bool:
        fs, hpath = self._fs(self._path(table))
        return fs.exists(hpath)

    def _read(self, table: str) -> DataFrame:
        """A partial table; empty when no batch wrote to it (or all were folded)."""
        if not self._exists(table):
            return self.spark.createDataFrame([], _SCHEMA[table])
        return self.spark.read.schema(_SCHEMA[table]).parquet(self._path(table))

    # ---- base snapshot of folded batches ----
    def _base(self) -> int | None:
        """Latest ``upto`` whose snapshot is complete (has its ``_DONE`` mark)."""
        fs, hpath = self._fs(f"{self.root}/base")
        if not fs.exists(hpath):
            return None
        done = []
        for st in fs.listStatus(hpath):
            name = st.getPath().getName()
            if name.startswith("upto=") and fs.exists(
                    self._fs(f"{self.root}/base/{name}/_DONE")[1]):
                done.append(int(name.split("=", 1)[1]))
        return max(done) if done else None

    def _base_table(self, table: str, upto: int | None, schema: str) -> DataFrame:
        if upto is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/base/upto={upto}/{table}")

    def _length_before(self, batch_id: int) -> int:
        """Items in the batches before ``batch_id``.  What earlier applications
        left is summed once, in Spark (a restart resumes from it); after that
        the per-batch counts - one number per batch since the last snapshot -
        are kept here, so a long stream does not re-list a growing folder."""
        if self._sizes is None:
            upto = self._base()
            self._sizes = {}
            if upto is not None:
                self._base_len = int(self._base_table("length", upto, "n BIGINT").first()[0])
            before = self._read("ledger").where(
                (F.col("batch_id") > (upto if upto is not None else -1)) & (F.col("batch_id") < batch_id))
            n, rows = before.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
            self._base_len += int(n)
            self._carried = int(rows)
        return self._base_len + sum(n for b, n in self._sizes.items() if b < batch_id)

    def compact(self, upto: int) -> None:
        """Fold the partials of batches ``<= upto`` into one base snapshot.

        Only batches the streaming query has already committed may be folded
        (when batch ``b`` runs, every batch before it is committed and will
        not be replayed).  The new snapshot is written beside the old one and
        marked done last; the folded per-batch folders and the old snapshot are
        deleted after that, and readers ignore anything the mark does not
        cover, so a crash at any point leaves a consistent state."""
        old = self._base()
        lo = old if old is not None else -1
        if upto <= lo:
            return
        dest = f"{self.root}/base/upto={upto}"
        kept = self._read("ledger").where((F.col("batch_id") > lo) & (F.col("batch_id") <= upto))
        done = kept.where(F.col("kept")).select("batch_id")

        def window(table):
            part = self._read(table).where((F.col("batch_id") > lo) & (F.col("batch_id") <= upto))
            return part.join(done, "batch_id", "left_semi").drop("batch_id")

        freq = (self._base_table("freq", old, "item BIGINT, n BIGINT").unionByName(window("freq"))
                .groupBy("item").agg(F.sum("n").cast("bigint").alias("n")))
        freq.write.mode("overwrite").parquet(f"{dest}/freq")
        sk = (self._base_table("sketch", old, "j INT, k BIGINT, c BIGINT").unionByName(window("sketch"))
              .groupBy("j", "k").agg(F.sum("c").cast("bigint").alias("c")))
        sk.write.mode("overwrite").parquet(f"{dest}/sketch")
        length = (self._base_table("length", old, "n BIGINT")
                  .unionByName(kept.select("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
        length.write.mode("overwrite").parquet(f"{dest}/length")
        fs, mark = self._fs(f"{dest}/_DONE")
        fs.create(mark, True).close()
        # the snapshot is complete: drop what it covers
        for table in ("freq", "sketch", "ledger"):
            fs_t, tpath = self._fs(self._path(table))
            if fs_t.exists(tpath):
                for st in fs_t.listStatus(tpath):
                    name = st.getPath().getName()
                    if name.startswith("batch_id=") and int(name.split("=", 1)[1]) <= upto:
                        fs_t.delete(st.getPath(), True)
        # earlier snapshots, also what a crash during an earlier fold left behind
        for st in fs.listStatus(self._fs(f"{self.root}/base")[1]):
            name = st.getPath().getName()
            if name.startswith("upto=") and int(name.split("=", 1)[1]) < upto:
                fs.delete(st.getPath(), True)
        if self._sizes is not None:
            folded = [b for b in self._sizes if b <= upto]
            self._base_len += sum(self._sizes.pop(b) for b in folded)
            self._carried = 0

    # ---- per micro-batch ----
    def process(self, batch: DataFrame, batch_id: int) -> None:
        items = batch.select("item").persist()
        try:
            n = items.count()
            if n == 0:
                return
            length = self._length_before(batch_id) + n
            reached = self.threshold is not None and length >= self.threshold
            if reached:
                self.stop_event.set()
            kept = not (reached and self.on_stop == "drop")
            if kept:
                inside = items if self.left is None else I.in_interval(items, self.left, self.right)
                (inside.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
                 .write.mode("overwrite").parquet(self._path("freq", batch_id)))
                if self.prm is not None:
                    part = self.spark.read.parquet(self._path("freq", batch_id))
                    (S.count_sketch(part, self.prm, weight="n")
                     .write.mode("overwrite").parquet(self._path("sketch", batch_id)))
            (self.spark.createDataFrame([(n, kept)], "n BIGINT, kept BOOLEAN")
             .write.mode("overwrite").parquet(self._path("ledger", batch_id)))
            self._sizes[batch_id] = n
            # batches before this one are committed by the query: fold them
            if self.compact_every and len(self._sizes) + self._carried > self.compact_every:
                self.compact(batch_id - 1)
        finally:
            items.unpersist()

    # ---- driving the query ----
    def start(self, items: DataFrame, trigger: dict | None = None,
              checkpoint: str | None = None):
        """Start the streaming query on ``items`` (a streaming DataFrame with
        an ``item`` column).  ``trigger`` defaults to 1-second batches."""
        trigger = trigger or {"processingTime": "1 second"}
        writer = (items.writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", checkpoint or self._path("_checkpoint"))
                  .trigger(**trigger))
        self.query = writer.start()
        return self.query

    def run(self, items: DataFrame, trigger: dict | None = None, poll: float = 0.5,
            timeout: float | None = None, settle_timeout: float | None = None) -> None:
        """Start, then wait on this thread until the stop event, the end of
        the input (``availableNow``) or ``timeout``; let the running batch
        finish, however long it takes, then stop the query.  A batch that is
        still running after ``settle_timeout`` seconds (if given) is an error."""
        drive(self.start(items, trigger), self.stop_event, poll, timeout, settle_timeout)

    # ---- results (batch queries over the partials) ----
    def stream_length(self) -> DataFrame:
        upto = self._base()
        lo = upto if upto is not None else -1
        rows = (self._base_table("length", upto, "n BIGINT")
                .unionByName(self._read("ledger").where(F.col("batch_id") > lo).select("n")))
        return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("stream_length"))

    def ledger_totals(self) -> DataFrame:
        """One row: ``n_items`` of all batches and ``n_kept`` of the processed ones.

        Only what a run of any batch sizes agrees on; the ledger itself has a row
        per micro-batch until it is folded into a snapshot."""
        kept = self.frequencies().agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("n_kept"))
        return merge_single_rows(self.stream_length().withColumnRenamed("stream_length", "n_items"), kept)

    def _committed(self, table: str, lo: int) -> DataFrame:
        """Partials of the batches after ``lo`` committed in the ledger as kept."""
        done = self._read("ledger").where(F.col("kept") & (F.col("batch_id") > lo)).select("batch_id")
        return (self._read(table).where(F.col("batch_id") > lo)
                .join(done, "batch_id", "left_semi").drop("batch_id"))

    def frequencies(self) -> DataFrame:
        """``(item, freq)`` over the kept batches (snapshot + newer partials)."""
        upto = self._base()
        lo = upto if upto is not None else -1
        rows = self._base_table("freq", upto, "item BIGINT, n BIGINT").unionByName(self._committed("freq", lo))
        return rows.groupBy("item").agg(F.sum("n").cast("bigint").alias("freq"))

    def sketch(self) -> DataFrame:
        """``(j, k, c)`` over the kept batches (snapshot + newer partials)."""
        upto = self._base()
        lo = upto if upto is not None else -1
        rows = (self._base_table("sketch", upto, "j INT, k BIGINT, c BIGINT")
                .unionByName(self._committed("sketch", lo)))
        return rows.groupBy("j", "k").agg(F.sum("c").cast("bigint").alias("c"))

    def report(self, K_top: int) -> DataFrame:
        """The stream report (K9) from the partials."""
        freq, sk = self.frequencies(), self.sketch()
        return K.report_from(self.stream_length(), freq, sk, self.prm, self.left, self.right, K_top)

    def distinct_report(self) -> DataFrame:
        """Items processed, distinct items, largest item (K10)."""
        f = self.frequencies()
        return merge_single_rows(
            self.stream_length().select(F.col("stream_length").alias("n_items")),
            f.agg(F.count(F.lit(1)).alias("n_distinct"), F.max("item").alias("largest_item")))


def start_aggregate(df: DataFrame, name: str, mode: str = "complete",
                    trigger: dict | None = None, checkpoint: str | None = None):
    """Run a pure streaming aggregate (``running_frequencies``,
    ``count_sketch`` on a stream, ``running_distinct``) into an in-memory
    table ``name`` - for tests and small interactive use."""
    w = df.writeStream.outputMode(mode).format("memory").queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
