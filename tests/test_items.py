import pytest
from pyspark.sql import functions as F

from sparkcount.operators import items as I
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.sources.tables import items as items_table
from conftest import SF001, SF01


def items(spark, rows):
    """rows: list of (batch_id, item)"""
    return spark.createDataFrame([(i, b, x) for i, (b, x) in enumerate(rows)],
                                 "event_id BIGINT, batch_id BIGINT, item BIGINT")


def freq_of(spark, pairs):
    return spark.createDataFrame(pairs, "item BIGINT, freq BIGINT")


def test_interval_ends_included(spark):
    df = items(spark, [(0, 0), (0, 1), (0, 5), (0, 6)])
    assert sorted(r.item for r in I.in_interval(df, 1, 5).collect()) == [1, 5]


def test_empty_interval_gives_nulls(spark):
    df = items(spark, [(0, 9), (0, 9)])
    prm = S.SketchParams.draw(3, 10, 1)
    r = K.stream_report(df, prm, 1, 5, 2).collect()[0]
    assert r.stream_length == 2 and r.interval_length == 0 and r.interval_distinct == 0
    assert r.f2 is None and r.f2_estimate is None and r.top_k_error is None


def test_top_k_tie_goes_to_smaller_item(spark):
    f = freq_of(spark, [(7, 3), (5, 2), (2, 2)])
    assert [r.item for r in K.top_k(f, 2).collect()] == [7, 2]


def test_top_k_per_group_matches_top_k(spark):
    d = items_table(spark, SF01)
    f = I.running_frequencies(d)
    want = [(r.item, r.freq) for r in K.top_k(f, 25).collect()]
    got = K.top_k_per_group(f.withColumn("g", f.item * 0), "g", 25, 25).orderBy("rank").collect()
    assert [(r.item, r.freq) for r in got] == want


def test_one_distinct_item(spark):
    df = items(spark, [(0, 4)] * 4)
    prm = S.SketchParams.draw(5, 7, 3)
    f = I.running_frequencies(df)
    sk = S.count_sketch(f, prm, weight="freq")
    est = S.sketch_estimates(f, sk, prm).collect()
    assert [(r.item, r.est) for r in est] == [(4, 4.0)]
    r = K.stream_report(df, prm, 0, 10, 1).collect()[0]
    assert r.f2 == 1.0 and r.f2_estimate == 1.0 and r.top_k_error == 0.0


def test_cutoff_drop_and_keep(spark):
    # batches of 3, 0, 3, 3 items: batch 1 is empty and leaves no trace
    rows = [(0, 1)] * 3 + [(2, 2)] * 3 + [(3, 3)] * 3
    df = items(spark, rows)
    assert I.stream_length(df).collect()[0][0] == 9
    assert I.kept_batches(df, 6, "drop").count() == 3
    assert I.kept_batches(df, 6, "keep").count() == 9
    assert sorted(tuple(r) for r in I.batch_sizes(df).collect()) == [(0, 3), (2, 3), (3, 3)]


def test_running_sizes_across_blocks(spark):
    sizes = spark.createDataFrame([(b, b + 1) for b in range(11)], "batch_id BIGINT, n BIGINT")
    got = {r.batch_id: r.running for r in I.running_sizes(sizes, block=3).collect()}
    total = 0
    for b in range(11):
        total += b + 1
        assert got[b] == total


def test_cutoff_known_answer(spark):
    assert I.kept_batches(items_table(spark, SF01), 6000, "drop").count() == 5984


def test_sketch_formula(spark):
    prm = S.SketchParams.draw(3, 11, 42)
    data = [3, 3, 8, -2, 9000, 8191 + 3, 17, 3]
    df = items(spark, [(0, x) for x in data])
    got = {(r.j, r.k): r.c for r in S.count_sketch(df, prm).collect()}
    want = {}
    for j, (a, b, a2, b2) in enumerate(prm.rows):
        for x in data:
            k = ((a * x + b) % 8191) % 11
            g = 2 * (((a2 * x + b2) % 8191) % 2) - 1
            want[(j, k)] = want.get((j, k), 0) + g
    assert got == want


def test_sketch_is_linear_over_batches(spark):
    from pyspark.sql import functions as F
    d = items_table(spark, SF001)
    prm = S.SketchParams.draw(5, 30, 7)
    whole = {(r.j, r.k): r.c for r in S.count_sketch(d, prm).collect()}
    # the sketch of two halves of the batches, added cell by cell
    batches = [r.batch_id for r in d.select("batch_id").distinct().collect()]
    total = None
    for chunk in (batches[0::2], batches[1::2]):
        part = S.count_sketch(d.where(F.col("batch_id").isin(chunk)), prm)
        total = part if total is None else total.unionByName(part)
    summed = {(r.j, r.k): r.c for r in total.groupBy("j", "k").agg(F.sum("c").alias("c")).collect()}
    assert summed == whole


def test_sketch_row_mass_bounded_by_length(spark):
    d = items_table(spark, SF01)
    prm = S.SketchParams.draw(5, 30, 7)
    f = I.running_frequencies(I.in_interval(d, 1, 300))
    n = K.interval_length(f).collect()[0][0]
    from pyspark.sql import functions as F
    for r in S.count_sketch(f, prm, "freq").groupBy("j").agg(F.sum(F.abs("c")).alias("m")).collect():
        assert r.m <= n


def test_true_f2_known(spark):
    for kind, want in (("value", 0.010702), ("skewed", 0.238024), ("flat", 0.067828)):
        f = I.running_frequencies(items_table(spark, SF001, kind))
        assert K.second_moment(f).collect()[0][0] == pytest.approx(want, abs=5e-7)


def test_distinct_report(spark):
    r = K.distinct_report(items_table(spark, SF001)).collect()[0]
    assert (r.n_items, r.n_distinct, r.largest_item) == (1000, 170, 327)


def test_top_k_report_returns_all_k_rows(spark):
    f = I.running_frequencies(items_table(spark, SF001))
    prm = S.SketchParams.draw(3, 20, 1)
    sk = S.count_sketch(f, prm, "freq")
    assert K.top_k_report(f, sk, prm, 20).count() == 20
    assert K.top_k_report(f, sk, prm, 21).count() == 21
    assert K.top_k_report(f, sk, prm, 10 ** 6).count() == 170
    assert K.top_k_report(f, sk, prm, 50, max_rows=20).count() == 20


@pytest.mark.parametrize("D", [1, 2, 4, 5])
def test_row_median_of_the_sketch(spark, D):
    import statistics
    data = [3] * 5 + [8] * 2 + [-2, 9000, 8194, 17]
    prm = S.SketchParams.draw(D, 4, D)
    f = I.running_frequencies(items(spark, [(0, x) for x in data]))
    sk = S.count_sketch(f, prm, "freq")
    cells = {(r.j, r.k): r.c for r in sk.collect()}
    for r in S.sketch_estimates(f, sk, prm).collect():
        e = [cells[j, (a * r.item + b) % 8191 % 4] * (2 * ((a2 * r.item + b2) % 8191 % 2) - 1)
             for j, (a, b, a2, b2) in enumerate(prm.rows)]
        assert r.est == statistics.median(e)


def test_sweep_settings_differ_and_take_another_prime(spark):
    d = items_table(spark, SF001)
    grid = [{"W": 20, "K": 5, "left": 1, "right": r, "rep": 1} for r in (20, 80, 400)]
    rows = K.accuracy_sweep(d, grid, 5, 3).orderBy("cfg").collect()
    for g, r in zip(grid, rows):
        prm = S.SketchParams.draw(5, 20, 3 + r.cfg)
        one = K.stream_report(d, prm, g["left"], g["right"], 5).collect()[0]
        assert (r.interval_length, r.top_k_error, r.f2, r.f2_estimate) == (
            one.interval_length, one.top_k_error, one.f2, one.f2_estimate)
    assert len({r.interval_length for r in rows}) == 3
    large = K.accuracy_sweep(d, grid, 5, 3, p=2 ** 31 - 1).orderBy("cfg").collect()
    assert [r.f2 for r in large] == [r.f2 for r in rows]
    assert [r.f2_estimate for r in large] != [r.f2_estimate for r in rows]


def test_stop_rule_reports(spark):
    rows = [(0, 1)] * 3 + [(2, 2)] * 3 + [(3, 3)] * 3
    df = items(spark, rows)
    prm = S.SketchParams.draw(3, 10, 1)
    r = K.stream_report(df, prm, 0, 9, 2, threshold=6).collect()[0]
    assert (r.stream_length, r.interval_length, r.interval_distinct) == (9, 3, 1)
    r = K.distinct_report(df, threshold=6).collect()[0]
    assert (r.n_items, r.n_distinct, r.largest_item) == (6, 2, 2)


def test_running_sizes_of_sparse_ids(spark):
    ids = [-5, 0, 3, 4096, 4097, 10 ** 9, 1_700_000_000_000, 1_700_000_000_001]
    sizes = spark.createDataFrame([(b, i + 1) for i, b in enumerate(ids)], "batch_id BIGINT, n BIGINT")
    got = {r.batch_id: r.running for r in I.running_sizes(sizes).collect()}
    assert [got[b] for b in ids] == [1, 3, 6, 10, 15, 21, 28, 36]


def test_merge_single_rows_keeps_columns_and_nulls(spark):
    from sparkcount.functions.frames import merge_single_rows
    a = spark.range(5).agg(F.count(F.lit(1)).alias("n"))
    b = spark.range(5).where("id > 10").agg(F.max("id").alias("m"), F.lit("x").alias("s"))
    row = merge_single_rows(a, b).collect()
    assert [tuple(r) for r in row] == [(5, None, "x")]
    assert merge_single_rows(a, b).columns == ["n", "m", "s"]


def test_read_items_parquet_stream(spark, scratch):
    from sparkcount.sources.stream import read_items
    src = items_table(spark, SF001).select("item")
    src.write.mode("overwrite").parquet(f"{scratch}/in")
    s = read_items(spark, "parquet", f"{scratch}/in", column="item", schema="item BIGINT")
    q = (I.running_frequencies(s).writeStream.outputMode("complete").format("memory")
         .queryName("pq_items").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.item: r.freq for r in spark.table("pq_items").collect()}
    want = {r.item: r.freq for r in I.running_frequencies(src).collect()}
    assert got == want


@pytest.mark.parametrize("threshold", [1, 3000, 6000, 10 ** 9])
def test_length_splits_into_interval_outside_and_dropped(spark, threshold):
    d = items_table(spark, SF01)
    n = I.stream_length(d).collect()[0][0]
    kept = I.kept_batches(d, threshold, "drop")
    inside = K.interval_length(I.running_frequencies(I.in_interval(kept, 1, 300))).collect()[0][0]
    outside = kept.where(~F.col("item").between(1, 300)).count()
    dropped = d.count() - kept.count()
    assert n == inside + outside + dropped


def test_top_k_error_is_null_for_k_zero(spark):
    d = items_table(spark, SF001)
    f = I.running_frequencies(d)
    prm = S.SketchParams.draw(3, 20, 1)
    assert K.top_k_error(f, S.count_sketch(f, prm, "freq"), prm, 0).collect()[0][0] is None
    assert K.top_k(f, 0).count() == 0
