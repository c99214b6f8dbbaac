"""Item statistics kept as Structured Streaming state.

One checkpointed streaming aggregate holds everything the stream has to
remember, as sums under keys ``(kind, a, b)``:

* ``LENGTH``: items received - the running length the stop rule compares;
* ``ITEM, item``: occurrences of an item inside the interval;
* ``CELL, j, k``: the cell of the count sketch.

Every item is expanded to its keys inside the scan stage and summed per task
before the shuffle, so the one ``LENGTH`` key costs a row per task.  State lives
in RocksDB below the checkpoint, split by key over the state partitions; the
driver sees one number per micro-batch, the running length.

The aggregate runs in update mode: each micro-batch hands over only the keys it
changed, with their new totals.  They are written to the batch's own folder,
then the ledger row ``(n, running, kept)`` as its commit mark; a replayed batch
gets the same totals from the same state and overwrites its folder, so the
upsert is idempotent.  A key's value is that of its latest kept batch.

Stop rule.  ``drop``: the batch whose running length reaches the threshold, and
every later one, only adds to the length - the state goes on, but its changes
are not kept.  ``keep``: the batch that reaches it is processed too, and batches
that slip in before the query has stopped are not.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcount.functions import hashing as H
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.session import shared_dir
from sparkcount.streaming.runner import drive

LENGTH, ITEM, CELL = 0, 1, 2
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, **conf):
    """Session settings for a query that starts inside (it takes its own copy)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def state_settings(partitions: int | None) -> dict[str, str]:
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    return conf


class StateItemRun:
    """One run of the item statistics as streaming state, in ``<root>/<name>``.

    ``partitions``: state partitions of a new checkpoint (``None``: the session's
    shuffle partitions); a restart keeps those of the checkpoint."""

    def __init__(self, spark: SparkSession, name: str, prm: S.SketchParams | None = None,
                 left: int | None = None, right: int | None = None, threshold: int | None = None,
                 on_stop: str = "drop", root: str | None = None, partitions: int | None = None):
        if on_stop not in ("drop", "keep"):
            raise ValueError(f"unknown on_stop {on_stop!r}")
        self.spark, self.prm = spark, prm
        self.left, self.right = left, right
        self.threshold, self.on_stop = threshold, on_stop
        self.root = f"{(root or shared_dir(spark)).rstrip('/')}/{name}"
        self.partitions = partitions
        self.stop_event = threading.Event()
        self._last: tuple[int, int] | None = None  # batch, running length after it

    # ---- the streaming aggregate ----
    def _keys(self) -> Column:
        def key(kind, a, b, w):
            return f"named_struct('kind', {kind}, 'a', CAST({a} AS BIGINT), 'b', CAST({b} AS BIGINT), 'w', CAST({w} AS BIGINT))"

        inside = [key(ITEM, "item", 0, 1)]
        if self.prm is not None:
            inside += [key(CELL, j, H.sql_color("item", a, b, self.prm.W, self.prm.p), H.sql_sign("item", a2, b2, self.prm.p))
                       for j, (a, b, a2, b2) in enumerate(self.prm.rows)]
        length = key(LENGTH, 0, 0, 1)
        test = "true" if self.left is None else f"item BETWEEN {int(self.left)} AND {int(self.right)}"
        return F.expr(f"explode(IF({test}, array({', '.join([length, *inside])}), array({length})))")

    def totals(self, items: DataFrame) -> DataFrame:
        """``(kind, a, b, w)`` of ``items (item)``, streaming or bounded."""
        return items.select(self._keys().alias("x")).select("x.*").groupBy("kind", "a", "b").agg(F.sum("w").alias("w"))

    def _before(self, batch_id: int) -> int:
        """Running length before the batch: from the ledger when the run (re)starts."""
        if self._last is None or self._last[0] >= batch_id:
            row = self.ledger().where(F.col("batch_id") < batch_id).agg(F.max("running")).first()
            return int(row[0] or 0)
        return self._last[1]

    def upsert(self, changed: DataFrame, batch_id: int) -> None:
        path = f"{self.root}/changes/batch_id={batch_id}"
        # one action: the state operator runs once per batch
        changed.write.mode("overwrite").parquet(path)
        row = self.spark.read.schema(CHANGES).parquet(path).where(F.col("kind") == LENGTH).select("w").first()
        if row is None:  # an empty batch leaves no trace
            return
        before, running = self._before(batch_id), int(row["w"])
        limit = self.threshold if self.threshold is not None else float("inf")
        kept = running < limit if self.on_stop == "drop" else before < limit
        if running >= limit:
            self.stop_event.set()
        (self.spark.createDataFrame([(running - before, running, kept)], LEDGER)
         .write.mode("overwrite").parquet(f"{self.root}/ledger/batch_id={batch_id}"))
        self._last = (batch_id, running)

    def run(self, items: DataFrame, trigger: dict | None = None, poll: float = 0.2, timeout: float | None = None) -> None:
        """Process ``items`` (a streaming DataFrame with an ``item`` column) until the
        stop rule, the end of the input (``availableNow``) or ``timeout`` seconds."""
        with settings(self.spark, **state_settings(self.partitions)):
            query = (self.totals(items).writeStream.outputMode("update").foreachBatch(self.upsert)
                     .option("checkpointLocation", f"{self.root}/_checkpoint")
                     .trigger(**(trigger or {"processingTime": "1 second"})).start())
        drive(query, self.stop_event, poll, timeout)

    # ---- results: batch queries over the written changes ----
    def _table(self, name: str, schema: str) -> DataFrame:
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not top.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(top):
            return self.spark.createDataFrame([], f"{schema}, batch_id BIGINT")
        return self.spark.read.schema(f"{schema}, batch_id BIGINT").parquet(f"{self.root}/{name}")

    def ledger(self) -> DataFrame:
        """``(batch_id, n, running, kept)``: one row per micro-batch that had items."""
        return self._table("ledger", LEDGER).select("batch_id", "n", "running", "kept")

    def until_stop(self) -> DataFrame:
        """The ledger up to and with the batch that reached the threshold: what every
        run over the same batches agrees on, however late its query stopped."""
        if self.threshold is None:
            return self.ledger()
        return self.ledger().where(F.col("running") - F.col("n") < self.threshold)

    def _latest(self, kind: int) -> DataFrame:
        kept = self.ledger().where("kept").select("batch_id")
        rows = self._table("changes", CHANGES).where(F.col("kind") == kind).join(kept, "batch_id", "left_semi")
        return rows.groupBy("a", "b").agg(F.max_by("w", "batch_id").alias("w"))

    def frequencies(self) -> DataFrame:
        """``(item, freq)`` over the kept batches."""
        return self._latest(ITEM).select(F.col("a").alias("item"), F.col("w").alias("freq"))

    def sketch(self) -> DataFrame:
        """``(j, k, c)`` over the kept batches."""
        return self._latest(CELL).select(F.col("a").cast("int").alias("j"), F.col("b").alias("k"), F.col("w").alias("c"))

    def stream_length(self) -> DataFrame:
        return self.ledger().agg(F.coalesce(F.max("running"), F.lit(0)).cast("bigint").alias("stream_length"))

    def report(self, K_top: int) -> DataFrame:
        """The stream report (K9) from the state's latest values."""
        return K.report_from(self.stream_length(), self.frequencies(), self.sketch(), self.prm, self.left, self.right, K_top)


CHANGES = "kind INT, a BIGINT, b BIGINT, w BIGINT"
LEDGER = "n BIGINT, running BIGINT, kept BOOLEAN"


def distinct_within(items: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """``(ts, item)``: an item once per ``delay`` of event time.  The state forgets an
    item when the watermark has passed its first time by ``delay``, so it holds the items of the
    last ``delay`` only, not of the whole stream; an item that returns later comes
    out again, and the distinct items of a stream are those of the output."""
    return items.withWatermark(ts, delay).select(ts, "item").dropDuplicatesWithinWatermark(["item"])


def run_distinct(items: DataFrame, delay: str, path: str, partitions: int | None = None, trigger: dict | None = None,
                 ts: str = "ts"):
    """Append ``distinct_within`` to Parquet files in ``<path>/out``; returns the ended query."""
    spark = items.sparkSession
    with settings(spark, **state_settings(partitions)):
        query = (distinct_within(items, delay, ts).writeStream.outputMode("append").format("parquet")
                 .option("path", f"{path}/out").option("checkpointLocation", f"{path}/_checkpoint")
                 .trigger(**(trigger or {"availableNow": True})).start())
    drive(query, threading.Event(), 0.2)
    return query
