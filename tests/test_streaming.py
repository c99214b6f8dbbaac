import os

import pytest
from pyspark.sql import functions as F

from sparkcount.operators import items as I
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.sources.stream import read_items
from sparkcount.sources.tables import items as items_table
from sparkcount.streaming.runner import ItemStreamRun, start_aggregate
from conftest import SF001

PRM = S.SketchParams.draw(5, 30, 7)
LEFT, RIGHT = 1, 200


@pytest.fixture(scope="module")
def stream_dir(spark, tmp_path_factory):
    """The sf0.001 items (1,000) in five text files of 200, one item per line."""
    d = tmp_path_factory.mktemp("items")
    vals = [r.item for r in items_table(spark, SF001).orderBy("event_id").collect()]
    for i in range(5):
        path = os.path.join(d, f"part-{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(str(v) for v in vals[i * 200:(i + 1) * 200]) + "\n")
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))  # file order = batch order
    return str(d), vals


def source(spark, d):
    return read_items(spark, "text", d, {"maxFilesPerTrigger": 1})


def as_dict(df, k, v):
    return {tuple(r[x] for x in k): r[v] for r in df.collect()}


def bounded(spark, vals):
    return spark.createDataFrame([(0, v) for v in vals], "batch_id BIGINT, item BIGINT")


def test_stream_equals_bounded(spark, stream_dir, scratch):
    d, vals = stream_dir
    run = ItemStreamRun(spark, "all", PRM, LEFT, RIGHT, threshold=10 ** 9, root=scratch)
    run.run(source(spark, d), trigger={"availableNow": True}, timeout=120)
    b = bounded(spark, vals)
    f = I.running_frequencies(I.in_interval(b, LEFT, RIGHT))
    assert as_dict(run.frequencies(), ["item"], "freq") == as_dict(f, ["item"], "freq")
    assert as_dict(run.sketch(), ["j", "k"], "c") == as_dict(S.count_sketch(f, PRM, "freq"), ["j", "k"], "c")
    assert run.stream_length().collect()[0][0] == 1000
    got = run.report(5).collect()[0].asDict()
    want = K.stream_report(b, PRM, LEFT, RIGHT, 5).collect()[0].asDict()
    assert got == want
    # ledger: five non-empty batches of 200
    ledger = spark.read.parquet(f"{run.root}/ledger").collect()
    assert sorted(r.n for r in ledger) == [200] * 5


def test_stop_rule_drop(spark, stream_dir, scratch):
    d, vals = stream_dir
    run = ItemStreamRun(spark, "drop", PRM, LEFT, RIGHT, threshold=600, on_stop="drop", root=scratch)
    run.run(source(spark, d), trigger={"availableNow": True}, timeout=120)
    assert run.stop_event.is_set()
    kept = vals[:400]
    want = I.running_frequencies(I.in_interval(bounded(spark, kept), LEFT, RIGHT))
    assert as_dict(run.frequencies(), ["item"], "freq") == as_dict(want, ["item"], "freq")
    assert run.stream_length().collect()[0][0] in (600, 800, 1000)


def test_stop_rule_keep_and_distinct(spark, stream_dir, scratch):
    d, vals = stream_dir
    run = ItemStreamRun(spark, "keep", None, None, None, threshold=600, on_stop="keep", root=scratch)
    run.run(source(spark, d), trigger={"availableNow": True}, timeout=120)
    n = run.stream_length().collect()[0][0]
    assert n in (600, 800, 1000)
    seen = vals[:n]
    r = run.distinct_report().collect()[0]
    assert (r.n_items, r.n_distinct, r.largest_item) == (n, len(set(seen)), max(seen))


def test_replayed_batch_is_not_counted_twice(spark, stream_dir, scratch):
    d, vals = stream_dir
    run = ItemStreamRun(spark, "replay", PRM, LEFT, RIGHT, threshold=10 ** 9, root=scratch)
    b0 = spark.createDataFrame([(v,) for v in vals[:200]], "item BIGINT")
    b1 = spark.createDataFrame([(v,) for v in vals[200:400]], "item BIGINT")
    run.process(b0, 0)
    run.process(b1, 1)
    before = (as_dict(run.frequencies(), ["item"], "freq"), as_dict(run.sketch(), ["j", "k"], "c"))
    run.process(b1, 1)  # at-least-once: the same batch again
    after = (as_dict(run.frequencies(), ["item"], "freq"), as_dict(run.sketch(), ["j", "k"], "c"))
    assert before == after
    assert run.stream_length().collect()[0][0] == 400
    run.process(b1.limit(0), 2)  # an empty batch leaves no trace
    assert spark.read.parquet(f"{run.root}/ledger").count() == 2


def test_pure_streaming_aggregates(spark, stream_dir, scratch):
    d, vals = stream_dir
    b = bounded(spark, vals)
    q = start_aggregate(I.running_frequencies(source(spark, d)), "freq_live",
                        checkpoint=f"{scratch}/c1")
    q.awaitTermination(120)
    assert as_dict(spark.table("freq_live"), ["item"], "freq") == as_dict(I.running_frequencies(b), ["item"], "freq")
    q = start_aggregate(S.count_sketch(source(spark, d), PRM), "sketch_live", checkpoint=f"{scratch}/c2")
    q.awaitTermination(120)
    assert as_dict(spark.table("sketch_live"), ["j", "k"], "c") == as_dict(S.count_sketch(b, PRM), ["j", "k"], "c")
    q = start_aggregate(I.running_distinct(source(spark, d)), "distinct_live", mode="append",
                        checkpoint=f"{scratch}/c3")
    q.awaitTermination(120)
    assert sorted(r.item for r in spark.table("distinct_live").collect()) == sorted(set(vals))


def test_compaction_keeps_totals_replays_and_restarts(spark, stream_dir, scratch):
    d, vals = stream_dir
    run = ItemStreamRun(spark, "compact", PRM, LEFT, RIGHT, threshold=10 ** 9, root=scratch,
                        compact_every=1)
    run.run(source(spark, d), trigger={"availableNow": True}, timeout=120)
    assert run._base() == 3  # batches 0..3 folded, batch 4 still a partial
    b = bounded(spark, vals)
    f = I.running_frequencies(I.in_interval(b, LEFT, RIGHT))
    want_f = as_dict(f, ["item"], "freq")
    want_s = as_dict(S.count_sketch(f, PRM, "freq"), ["j", "k"], "c")
    assert as_dict(run.frequencies(), ["item"], "freq") == want_f
    assert as_dict(run.sketch(), ["j", "k"], "c") == want_s
    assert run.stream_length().collect()[0][0] == 1000
    # the last batch replayed after the fold: unchanged totals
    run.process(spark.createDataFrame([(v,) for v in vals[800:]], "item BIGINT"), 4)
    assert as_dict(run.frequencies(), ["item"], "freq") == want_f
    assert run.stream_length().collect()[0][0] == 1000
    # a new runner on the same folder resumes the length from the snapshot
    again = ItemStreamRun(spark, "compact", PRM, LEFT, RIGHT, threshold=10 ** 9, root=scratch)
    assert again._length_before(5) == 1000
    assert again.report(5).collect()[0].asDict() == K.stream_report(b, PRM, LEFT, RIGHT, 5).collect()[0].asDict()


def test_no_threshold_means_no_stop_rule(spark, scratch):
    run = ItemStreamRun(spark, "plain", root=scratch)
    run.process(spark.range(100).selectExpr("id AS item"), 0)
    assert run.threshold is None and not run.stop_event.is_set()
    assert run.stream_length().collect()[0][0] == 100


def test_a_slow_last_batch_is_still_counted(spark, stream_dir, scratch):
    import time
    d, vals = stream_dir
    run = ItemStreamRun(spark, "slow", None, threshold=600, on_stop="keep", root=scratch)
    counted = run.process

    def slow(batch, batch_id):
        n = run._length_before(batch_id) + batch.count()
        if n >= 600:  # the stop event is set long before this batch ends
            run.stop_event.set()
            time.sleep(3)
        counted(batch, batch_id)

    run.process = slow
    run.run(source(spark, d), trigger={"processingTime": "0 seconds"}, poll=0.1)
    n = run.stream_length().collect()[0][0]
    assert n >= 600 and run.frequencies().agg({"freq": "sum"}).collect()[0][0] == n


def test_settle_timeout_is_an_error(spark, stream_dir, scratch):
    import time
    d, _ = stream_dir
    run = ItemStreamRun(spark, "late", None, root=scratch)

    def endless(batch, batch_id):
        run.stop_event.set()
        time.sleep(5)

    run.process = endless
    with pytest.raises(TimeoutError):
        run.run(source(spark, d), poll=0.1, settle_timeout=0.5)


APPLICATION = """
import sys
sys.path.insert(0, {root!r})
from sparkcount import get_session
from sparkcount.sources.stream import read_items
from sparkcount.streaming.runner import ItemStreamRun
spark = get_session("local[2]", 2, extra={{"spark.checkpoint.dir": {shared!r}}})
run = ItemStreamRun(spark, "run1")
run.run(read_items(spark, "text", {data!r}), trigger={{"availableNow": True}})
print("LENGTH", run.stream_length().first()[0], run.distinct_report().first().n_items, run.root)
spark.stop()
"""


def test_a_second_application_goes_on(scratch):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.makedirs(f"{scratch}/in")
    seen = []
    for part, n in ((0, 30), (1, 12)):
        with open(f"{scratch}/in/{part}.txt", "w") as f:
            f.writelines(f"{v}\n" for v in range(n))
        code = APPLICATION.format(root=root, shared=f"{scratch}/shared", data=f"{scratch}/in")
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert out.returncode == 0, out.stderr[-2000:]
        seen.append(next(x for x in out.stdout.splitlines() if x.startswith("LENGTH")).split()[1:])
    assert [x[:2] for x in seen] == [["30", "30"], ["42", "42"]]
    assert seen[0][2] == seen[1][2] == f"{scratch}/shared/run1"


def test_registered_streams_read_a_stream(spark):
    import __spark_entry__ as E
    got = E.queries()["stream_run_distinct"](spark, SF001).collect()[0]
    assert (got.n_items, got.n_distinct, got.largest_item) == (1000, 170, 327)
