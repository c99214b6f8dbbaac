"""Streams of many micro-batches whose memory is streaming state."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from sparkcount.operators import items as I
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.sources.arrivals import read_arrivals, spool
from sparkcount.sources.stream import read_items
from sparkcount.streaming.runner import ItemStreamRun
from sparkcount.streaming.state import StateItemRun, run_distinct, settings, state_settings

PRM = S.SketchParams.draw(3, 10, 7)
LEFT, RIGHT = 1, 40
SIZES = [30, 10, 25, 40, 5, 60, 20, 15, 35, 10, 50, 20]  # 12 arrival files, 320 items


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    rows, at = [], 0
    for f, n in enumerate(SIZES):
        for _ in range(n):
            rows.append((f, (at * at) % 57))
            at += 1
    path = str(tmp_path_factory.mktemp("arrivals") / "files")
    # written newest first: only the files' times tell their order
    df = spark.createDataFrame(rows, "arrival BIGINT, item BIGINT")
    spool(df.orderBy(F.desc("arrival")), path)
    return path, rows


def start(spark, path, root, name, **kw):
    run = StateItemRun(spark, name, left=LEFT, right=RIGHT, root=root, partitions=2, **kw)
    run.run(read_arrivals(spark, path, "item BIGINT"), trigger={"availableNow": True})
    return run


def freq(rows):
    out = {}
    for _, x in rows:
        if LEFT <= x <= RIGHT:
            out[x] = out.get(x, 0) + 1
    return out


def got(run):
    return {r.item: r.freq for r in run.frequencies().collect()}


def test_a_micro_batch_per_file_and_a_ledger_row_per_batch(spark, arrivals, scratch):
    path, rows = arrivals
    run = start(spark, path, scratch, "all", prm=PRM)
    total, want = 0, []
    for b, n in enumerate(SIZES):
        total += n
        want.append((b, n, total, True))
    assert sorted(map(tuple, run.ledger().collect())) == want
    assert got(run) == freq(rows)
    bounded = spark.createDataFrame([(0, x) for _, x in rows], "batch_id BIGINT, item BIGINT")
    assert run.report(5).first().asDict() == K.stream_report(bounded, PRM, LEFT, RIGHT, 5).first().asDict()


@pytest.mark.parametrize("on_stop,last", [("drop", 4), ("keep", 5)])
def test_stop_rule_over_many_batches(spark, arrivals, scratch, on_stop, last):
    path, rows = arrivals
    run = start(spark, path, scratch, on_stop, threshold=120, on_stop=on_stop)  # reached in batch 5
    assert run.stop_event.is_set()
    assert got(run) == freq([r for r in rows if r[0] <= last])
    ledger = sorted(map(tuple, run.until_stop().collect()))
    assert [x[0] for x in ledger] == list(range(6)) and ledger[-1][2] == 170
    assert [x[3] for x in ledger] == [True] * 5 + [on_stop == "keep"]


def test_restart_in_mid_run_resumes_length_and_state(spark, arrivals, scratch):
    path, rows = arrivals
    half = f"{scratch}/half"
    df = spark.createDataFrame(rows, "arrival BIGINT, item BIGINT")
    spool(df.where("arrival < 4"), half)
    first = start(spark, half, scratch, "again", threshold=120)
    assert not first.stop_event.is_set() and got(first) == freq([r for r in rows if r[0] < 4])
    spool(df.where("arrival >= 4"), half)
    second = start(spark, half, scratch, "again", threshold=120)
    assert second.stop_event.is_set()
    assert got(second) == freq([r for r in rows if r[0] <= 4])
    assert [tuple(r) for r in second.until_stop().orderBy("batch_id").collect()][3:] == [
        (3, 40, 105, True), (4, 5, 110, True), (5, 60, 170, False)]


def test_a_replayed_batch_overwrites_its_own_folder(spark, arrivals, scratch):
    path, rows = arrivals
    run = start(spark, path, scratch, "replay")
    before = got(run), sorted(map(tuple, run.ledger().collect()))
    totals = run.totals(spark.createDataFrame([(x,) for _, x in rows], "item BIGINT"))
    run.upsert(totals, len(SIZES) - 1)  # the last batch's totals again
    assert (got(run), sorted(map(tuple, run.ledger().collect()))) == before


def test_state_totals_of_a_bounded_table(spark, arrivals):
    _, rows = arrivals
    items = spark.createDataFrame([(x,) for _, x in rows], "item BIGINT")
    t = StateItemRun(spark, "none", PRM, LEFT, RIGHT, root="/nowhere").totals(items)
    f = I.running_frequencies(I.in_interval(items, LEFT, RIGHT))
    cells = {(r.j, r.k): r.c for r in S.count_sketch(f, PRM, "freq").collect()}
    assert {(r.a, r.b): r.w for r in t.where("kind = 2").collect()} == cells
    assert t.where("kind = 0").first().w == len(rows)
    assert StateItemRun(spark, "x", root="/nowhere").totals(items.limit(0)).count() == 0


def test_unknown_stop_mode(spark):
    with pytest.raises(ValueError):
        StateItemRun(spark, "x", on_stop="pause")


def test_distinct_state_stays_bounded(spark, scratch):
    """An item comes back every hour; each hour is a file.  The state holds the
    items of the delay, not of the whole stream."""
    hours, new = 16, 20
    rows = [(h, h * 3600, -1) for h in range(hours)] + [(h, h * 3600 + i, h * new + i) for h in range(hours) for i in range(new)]
    df = spark.createDataFrame(rows, "arrival BIGINT, s BIGINT, item BIGINT").select(
        "arrival", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"), "item")
    path = f"{scratch}/hours"
    spool(df, path)
    query = run_distinct(read_arrivals(spark, path, "ts TIMESTAMP, item BIGINT"), "2 hours", scratch, 2)
    out = spark.read.parquet(f"{scratch}/out")
    assert out.select("item").distinct().count() == hours * new + 1
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) <= 5 * (new + 1) < hours * new
    # the returning item came out again only after it had been forgotten
    assert 1 < out.where("item = -1").count() < hours


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), settings(spark, **state_settings(3)):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


# ---- sketches ----

def test_sketches_add_and_subtract(spark):
    rows = [(b, (b * 31 + i * i) % 50) for b in range(8) for i in range(40)]
    items = spark.createDataFrame(rows, "batch_id BIGINT, item BIGINT")

    def direct(df):
        return {(r.j, r.k): r.c for r in S.count_sketch(df, PRM).collect() if r.c}

    size = PRM.D * PRM.W
    each = S.batch_sketches(items, PRM)
    assert each.count() == 8
    whole = S.add_sketches(each, size)
    assert {(r.j, r.k): r.c for r in S.sketch_rows(whole, PRM.W).collect()} == direct(items)
    part = S.subtract_sketches(S.add_sketches(each.where("batch_id < 6"), size), S.add_sketches(each.where("batch_id < 2"), size))
    assert {(r.j, r.k): r.c for r in S.sketch_rows(part, PRM.W).collect()} == direct(items.where("batch_id >= 2 AND batch_id < 6"))
    assert S.add_sketches(each.limit(0), size).first().cells == [0] * size


def test_polynomial_family(spark):
    prm = S.PolySketchParams.draw(3, 16, 5)
    p = prm.p

    def value(c, x):
        return (((c[0] * x + c[1]) * x + c[2]) * x + c[3]) % p

    xs = [0, 1, -1, 12345, p, p - 1, 2 ** 62, -2 ** 62]
    cells = {}
    for x in xs:
        for j, (h, g) in enumerate(prm.rows):
            k = value(h, x % p) % prm.W
            cells[j, k] = cells.get((j, k), 0) + (value(g, x % p) % 2 * 2 - 1)
    items = spark.createDataFrame([(x,) for x in xs], "item BIGINT")
    sketch = S.count_sketch(items, prm)
    assert {(r.j, r.k): r.c for r in sketch.collect()} == cells
    freq = I.running_frequencies(items)
    est = {r.item: r.est for r in S.sketch_estimates(freq, sketch, prm).collect()}
    for x in xs:
        own = sorted(cells[j, value(h, x % p) % prm.W] * (value(g, x % p) % 2 * 2 - 1) for j, (h, g) in enumerate(prm.rows))
        assert est[x] == own[1]


# ---- a stream of lines ----

@pytest.mark.parametrize("bad", ["", "1_0", "x", "1.5", "9223372036854775808"])
def test_a_bad_line_fails_the_batch_and_a_mended_file_is_replayed(spark, scratch, bad):
    lines = spark.createDataFrame([(0, "1"), (0, " +2 "), (1, "3"), (1, bad), (2, "-4")], "arrival BIGINT, line STRING")
    path = f"{scratch}/lines"
    spool(lines, path, fmt="text")

    def run():
        out = ItemStreamRun(spark, "line-run", root=scratch)
        out.run(read_items(spark, "text", path, {"maxFilesPerTrigger": 1}), trigger={"availableNow": True}, poll=0.1)
        return out

    with pytest.raises(RuntimeError):
        run()
    before = ItemStreamRun(spark, "line-run", root=scratch)
    assert {r.item: r.freq for r in before.frequencies().collect()} == {1: 1, 2: 1}
    # the checkpoint still asks for the same file: mended in place, the batch runs again
    [file] = glob.glob(f"{path}/arrival=1/*.txt")
    with open(file, "w") as f:
        f.write("3\n5\n")
    [crc] = glob.glob(f"{path}/arrival=1/.*.crc")
    os.remove(crc)
    after = run()
    assert {r.item: r.freq for r in after.frequencies().collect()} == {1: 1, 2: 1, 3: 1, 5: 1, -4: 1}
    assert after.stream_length().first()[0] == 5
