"""Statistics of the item frequencies and of the count sketch (K1-K10).

Inputs are the frequency table ``(item, freq)`` of the items in the
interval, the sketch ``(j, k, c)`` and its parameters.  Ratios are DOUBLE
rounded to 9 places and NULL when the denominator is 0 (no item in the
interval, ``K = 0``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcount.functions import hashing as H
from sparkcount.functions.frames import merge_single_rows, ratio
from sparkcount.operators import items as I
from sparkcount.operators import sketch as S


def interval_length(freq: DataFrame) -> DataFrame:
    return freq.agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("bigint").alias("interval_length"))


def interval_distinct(freq: DataFrame) -> DataFrame:
    # Every frequency is >= 1, so this is count(*); written on ``freq`` it
    # keeps the frequency table's count in the plan (Catalyst would prune a
    # bare count(*) to a different aggregate), so this statistic shares the
    # table's shuffle with the others instead of scanning again.
    return freq.agg(F.count_if(F.col("freq") > 0).alias("interval_distinct"))


def second_moment(freq: DataFrame) -> DataFrame:
    """One row ``f2`` = ``sum f^2 / (sum f)^2``; sums exact in DECIMAL(38,0)."""
    f = F.col("freq").cast("decimal(38,0)")
    return freq.agg(ratio(F.sum(f * f), F.sum(f) * F.sum(f)).alias("f2"))


def second_moment_estimate(sketch: DataFrame, length: DataFrame) -> DataFrame:
    """One row ``f2_estimate`` = median over rows of ``sum_k c[j][k]^2``,
    divided by the squared interval length (from ``interval_length``)."""
    med = S.row_squares(sketch).agg(F.median(F.col("s").cast("double")).alias("m"))
    L = F.col("interval_length").cast("double")
    both = merge_single_rows(med, length)
    return both.select(ratio(F.col("m"), L * L).alias("f2_estimate"))


def top_k(freq: DataFrame, K: int) -> DataFrame:
    """``(item, freq)``: the ``K`` most frequent items, ties to the smaller item.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own best ``K`` and only those reach the final merge."""
    return freq.orderBy(F.desc("freq"), F.asc("item")).limit(K).select("item", "freq")


def top_k_per_group(df: DataFrame, group: str, K, most: int) -> DataFrame:
    """Rows ranked ``<= K`` by ``(freq desc, item)`` within each group, with
    their ``rank``.  ``K`` is an int or the name of a column, ``most`` a literal
    bound of it: Spark keeps the best ``most`` rows of a group in every task
    (a group limit below the shuffle), so no group is shuffled or ranked whole."""
    w = Window.partitionBy(group).orderBy(F.desc("freq"), F.asc("item"))
    limit = F.col(K) if isinstance(K, str) else F.lit(K)
    ranked = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    return ranked.where(F.col("rank") <= limit)


def top_k_error(freq: DataFrame, sketch: DataFrame, prm: S.SketchParams, K: int) -> DataFrame:
    """One row ``top_k_error``: mean of ``|f - f_est| / f`` over the top ``K``;
    only those ``K`` items are estimated."""
    top = S.sketch_estimates(top_k(freq, K), sketch, prm, ("freq",))
    e = F.abs(F.col("freq") - F.col("est")) / F.col("freq")
    return top.agg(ratio(F.sum(e), F.count(F.lit(1))).alias("top_k_error"))


def top_k_report(freq: DataFrame, sketch: DataFrame, prm: S.SketchParams, K: int,
                 max_rows: int | None = None) -> DataFrame:
    """``(item, freq, est)`` for the top ``K``, all of them; a caller that prints
    the table may bound it with ``max_rows``."""
    top = top_k(freq, K if max_rows is None else min(K, max_rows))
    return S.sketch_estimates(top, sketch, prm, ("freq",))


def report_from(length: DataFrame, freq: DataFrame, sk: DataFrame, prm: S.SketchParams,
                left: int | None, right: int | None, K: int) -> DataFrame:
    """The stream report from its parts: ``length`` (one row
    ``stream_length``), the interval's frequencies and the sketch."""
    ilen = interval_length(freq)
    head = length.select(
        F.lit(prm.D).alias("D"), F.lit(prm.W).alias("W"), F.lit(left).cast("bigint").alias("left"),
        F.lit(right).cast("bigint").alias("right"), F.lit(K).alias("K"), "stream_length")
    return merge_single_rows(head, ilen, interval_distinct(freq), top_k_error(freq, sk, prm, K),
                             second_moment(freq), second_moment_estimate(sk, ilen))


def stream_report(items: DataFrame, prm: S.SketchParams, left: int, right: int, K: int,
                  threshold: int | None = None) -> DataFrame:
    """One row: ``D, W, left, right, K, stream_length, interval_length,
    interval_distinct, top_k_error, f2, f2_estimate``.

    ``items`` are all items received; the interval filter is applied before
    any shuffle.  With ``threshold`` the stop rule holds (``drop``): the length
    is that of all items, the statistics are over the kept batches only."""
    # Two passes over the items: a plain count (no shuffle) for the length,
    # and the interval's frequency table, which every other statistic shares
    # (the operators keep its plan identical so Spark reuses its exchange).
    kept = items if threshold is None else I.kept_batches(items, threshold, "drop")
    freq = I.running_frequencies(I.in_interval(kept, left, right))
    sk = S.count_sketch(freq, prm, weight="freq")
    return report_from(I.stream_length(items), freq, sk, prm, left, right, K)


def distinct_report(items: DataFrame, threshold: int | None = None) -> DataFrame:
    """One row: ``n_items, n_distinct, largest_item`` in a single aggregate.  With
    ``threshold`` the stream stops after the batch that reaches it (``keep``)."""
    if threshold is not None:
        items = I.batches_until(items, threshold)
    return items.agg(F.count(F.lit(1)).alias("n_items"),
                     F.count_distinct("item").alias("n_distinct"),
                     F.max("item").alias("largest_item"))


def accuracy_sweep(items: DataFrame, grid: list[dict], D: int, seed: int = 0, p: int = H.P) -> DataFrame:
    """Sketch accuracy for a grid of settings, all in one job.

    ``grid``: dicts with ``W``, ``K``, ``left``, ``right`` and ``rep`` (repeat
    number).  Each setting ``cfg`` gets its own sketch hashes modulo ``p``, drawn
    from ``seed + cfg``.  Output, one row per setting: ``cfg, D, W, K, left,
    right, rep, interval_length, top_k_error, f2, f2_estimate``.

    Items outside every interval go before the shuffle.  Each distinct item is
    copied to the settings whose interval holds it; a copy computes its ``D``
    cells in the row.  The sketches are summed once and folded into one array
    per setting (``D * W`` numbers, a bound fixed by the grid); only the top
    ``K`` items of a setting are estimated, each in its own row.
    """
    structs = []
    for cfg, g in enumerate(grid):
        prm = S.SketchParams.draw(D, g["W"], seed + cfg, p)
        a, b, a2, b2 = (", ".join(f"{v}L" for v in col) for col in zip(*prm.rows))
        structs.append(f"named_struct('cfg', {cfg}, 'W', {g['W']}, 'K', {g['K']}, 'lo', {g['left']}L, "
                       f"'hi', {g['right']}L, 'a', array({a}), 'b', array({b}), 'a2', array({a2}), 'b2', array({b2}))")
    least, most = min(g["left"] for g in grid), max(g["right"] for g in grid)
    freq = I.running_frequencies(I.in_interval(items, least, most))
    cells = f"""transform(sequence(0, {D - 1}), j -> named_struct(
        'i', CAST(j * q.W + (({H.sql_pmod('item', p)}) * q.a[j] + q.b[j]) % {p} % q.W AS INT),
        'g', (({H.sql_pmod('item', p)}) * q.a2[j] + q.b2[j]) % {p} % 2 * 2 - 1))"""
    copies = (freq.select("item", "freq", F.expr(f"explode(array({', '.join(structs)}))").alias("q"))
              .where("item BETWEEN q.lo AND q.hi")
              .select(F.col("q.cfg").alias("cfg"), F.col("q.K").alias("K"), "item", "freq",
                      F.expr(cells).alias("cells")))
    sketch = (copies.select("cfg", "freq", F.explode("cells").alias("x"))
              .groupBy("cfg", F.col("x.i").alias("i")).agg(F.sum(F.col("x.g") * F.col("freq")).alias("c")))
    settings = items.sparkSession.createDataFrame(
        [(i, g["W"], g["K"], g["left"], g["right"], g["rep"]) for i, g in enumerate(grid)],
        "cfg INT, W INT, K INT, left BIGINT, right BIGINT, rep INT")
    # one row per setting: its cells by position and the squares of its rows
    sums = (sketch.groupBy("cfg").agg(F.collect_list(F.struct("i", "c")).alias("cs"))
            .join(F.broadcast(settings.select("cfg", "W")), "cfg")
            .select("cfg", F.map_from_entries("cs").alias("m"), F.expr(
                f"transform(sequence(0, {D - 1}), j -> aggregate(filter(cs, x -> x.i div W = j), "
                "CAST(0 AS DECIMAL(38,0)), (s, x) -> CAST(s + CAST(x.c AS DECIMAL(18,0)) * CAST(x.c AS DECIMAL(18,0)) "
                "AS DECIMAL(38,0))))").alias("squares"), "W")
            .select("cfg", F.expr(f"transform(sequence(0, {D} * W - 1), i -> coalesce(try_element_at(m, i), 0L))")
                    .alias("dense"),
                    _middle(F.array_sort("squares"), D).alias("m")))
    f = F.col("freq").cast("decimal(38,0)")
    true = copies.groupBy("cfg").agg(F.sum("freq").cast("bigint").alias("interval_length"),
                                     ratio(F.sum(f * f), F.sum(f) * F.sum(f)).alias("f2"))
    top = top_k_per_group(copies, "cfg", "K", max(g["K"] for g in grid))
    est = top.join(F.broadcast(sums.select("cfg", "dense")), "cfg").select(
        "cfg", "freq", _middle(F.expr("array_sort(transform(cells, x -> dense[x.i] * x.g))"), D).alias("est"))
    err = est.groupBy("cfg").agg(
        ratio(F.sum(F.abs(F.col("freq") - F.col("est")) / F.col("freq")), F.count(F.lit(1)))
        .alias("top_k_error"))
    out = settings.join(true, "cfg", "left").join(sums.select("cfg", "m"), "cfg", "left").join(err, "cfg", "left")
    L = F.col("interval_length").cast("double")
    return out.select("cfg", F.lit(D).alias("D"), "W", "K", "left", "right", "rep",
                      F.coalesce(F.col("interval_length"), F.lit(0)).cast("bigint").alias("interval_length"),
                      "top_k_error", "f2", ratio(F.col("m"), L * L).alias("f2_estimate"))


def _middle(ordered, D: int):
    """Median of a sorted array of ``D`` numbers, as DOUBLE."""
    lo, hi = (ordered[(D - 1) // 2].cast("double"), ordered[D // 2].cast("double"))
    return lo if D % 2 else (lo + hi) / 2
