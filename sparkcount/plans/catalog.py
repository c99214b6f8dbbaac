"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables through ``sources.tables`` and runs over
them whole; the parameters come from ``plans.params``, shared with the
oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcount.functions.frames import merge_single_rows
from sparkcount.operators import graph as G
from sparkcount.operators import items as I
from sparkcount.operators import sketch as S
from sparkcount.operators import stats as K
from sparkcount.operators import text as T
from sparkcount.plans import params as P
from sparkcount.sources import tables as src
from sparkcount.session import shared_dir
from sparkcount.sources.arrivals import read_arrivals, spool
from sparkcount.sources.stream import read_items
from sparkcount.sources.text import line_documents, parse_edges
from sparkcount.streaming.runner import ItemStreamRun
from sparkcount.streaming.state import StateItemRun, run_distinct

Query = Callable[[SparkSession, str], DataFrame]


def _edges(spark, d):
    return G.distinct_edges(src.edge_list(spark, d))


def _pairs(spark, d):
    """Raw ordered pairs: the triangle operators dedupe after colouring or
    bucketing, and a repeated pair always lands in the same colour or bucket,
    so the counts equal those over ``_edges`` with one shuffle less."""
    return src.edge_list(spark, d)


def _edge_lines(spark, d):
    """``lineitem`` as the lines of an edge file."""
    li = src.table(spark, d, "lineitem")
    return li.select(F.concat_ws(",", "l_partkey", "l_suppkey").alias("value"))


def _docs(spark, d):
    return src.documents(spark, d)


def _streamed(spark, d, **kw):
    """``events`` read as a stream to its end through ``ItemStreamRun``, into a
    fresh run below the shared folder."""
    run = ItemStreamRun(spark, f"runs/{uuid.uuid4().hex}", root=None, **kw)
    # a pattern that only this name matches: a file source takes no single file
    run.run(read_items(spark, "parquet", f"{d.rstrip('/')}/events.parque[t]", column="value",
                       schema="value DOUBLE", how="floor"), trigger={"availableNow": True})
    return run


def _arriving(spark, d):
    """``events`` as rows of arrival files, ``ARRIVAL_HOURS`` to a file."""
    ev = src.table(spark, d, "events")
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), F.floor("value").cast("bigint").alias("item"),
                     F.floor(src.hour_index(F.col("ts")) / P.ARRIVAL_HOURS).alias("arrival"))


def _spooled(spark, d):
    """The folder of the arrival files, below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/arrivals/{uuid.uuid4().hex}"
    spool(_arriving(spark, d), path)
    return path


def _state_run(spark, path, name=None, **kw):
    """The arrival files, one per micro-batch, through a run kept as streaming state."""
    run = StateItemRun(spark, name or f"runs/{uuid.uuid4().hex}", left=P.LEFT, right=P.RIGHT,
                       partitions=P.STATE_PARTITIONS, **kw)
    run.run(read_arrivals(spark, path, "item BIGINT"), trigger={"availableNow": True})
    return run


def _from_lines(spark, d):
    """The items as text, one integer to a line, read back as a stream of lines."""
    path = f"{shared_dir(spark).rstrip('/')}/arrivals/{uuid.uuid4().hex}"
    spool(_arriving(spark, d).select("arrival", F.col("item").cast("string").alias("line")), path, fmt="text")
    run = ItemStreamRun(spark, f"runs/{uuid.uuid4().hex}")
    run.run(read_items(spark, "text", path, {"maxFilesPerTrigger": 4}), trigger={"availableNow": True})
    return run


def _two_runs(spark, d):
    """One half of the arrival files, then the other, by two runs over one checkpoint."""
    path, name = f"{shared_dir(spark).rstrip('/')}/arrivals/{uuid.uuid4().hex}", f"runs/{uuid.uuid4().hex}"
    items = _arriving(spark, d)
    middle = (P.HOUR_FROM + P.HOUR_TO) // 2 // P.ARRIVAL_HOURS
    spool(items.where(F.col("arrival") < middle), path)
    _state_run(spark, path, name, prm=P.SKETCH)
    spool(items.where(F.col("arrival") >= middle), path)
    return _state_run(spark, path, name, prm=P.SKETCH)


def _distinct_stream(spark, d):
    """Distinct items that a stream with bounded state has put out."""
    path = _spooled(spark, d)
    run_distinct(read_arrivals(spark, path, "ts TIMESTAMP, item BIGINT"), P.DISTINCT_DELAY, f"{path}-distinct",
                 P.STATE_PARTITIONS)
    return spark.read.schema("ts TIMESTAMP, item BIGINT").parquet(f"{path}-distinct/out").select("item").distinct()


def _items(spark, d):
    return src.items(spark, d, "value")


def _freq(spark, d):
    return I.running_frequencies(I.in_interval(_items(spark, d), P.LEFT, P.RIGHT))


def _freq_sketch(spark, d):
    freq = _freq(spark, d)
    return freq, S.count_sketch(freq, P.SKETCH, weight="freq")


def graph_queries() -> dict[str, Query]:
    C, h = P.C, P.H1
    return {
        "edges_read": lambda s, d: parse_edges(_edge_lines(s, d)),
        "edges_distinct": _edges,
        "edge_count": lambda s, d: G.edge_count(_edges(s, d)),
        "edges_undirected": lambda s, d: G.undirected(_edges(s, d)),
        "triangle_count": lambda s, d: G.triangle_count(_pairs(s, d)),
        "node_colors": lambda s, d: G.color_nodes(_edges(s, d), C, h),
        "edges_monochromatic": lambda s, d: G.monochromatic_edges(_edges(s, d), C, h),
        "triangles_per_color": lambda s, d: G.triangles_per_color(_pairs(s, d), C, h),
        "approx_triangles_color": lambda s, d: G.approx_triangles_color(_pairs(s, d), C, h),
        "approx_triangles_color_median":
            lambda s, d: G.approx_triangles_color_median(_pairs(s, d), C, P.RUNS),
        "edges_partitioned": lambda s, d: G.partition_edges(_edges(s, d), C, P.BUCKET),
        "triangles_per_partition": lambda s, d: G.triangles_per_partition(_pairs(s, d), C, P.BUCKET),
        "approx_triangles_partition":
            lambda s, d: G.approx_triangles_partition(_pairs(s, d), C, P.BUCKET),
        "edges_by_color_triple": lambda s, d: G.replicate_by_color_triple(_edges(s, d), C, h),
        "triangles_per_color_triple": lambda s, d: G.triangles_per_color_triple(_pairs(s, d), C, h),
        "exact_triangles_color": lambda s, d: G.exact_triangles_color(_pairs(s, d), C, h),
        # the copy-per-group plan (each edge under C colour-triple keys)
        "triangles_per_color_triple_replicated": lambda s, d: G.triangles_per_color_triple(
            _pairs(s, d), C, h, "replicate"),
        "exact_triangles_color_replicated": lambda s, d: G.exact_triangles_color(
            _pairs(s, d), C, h, "replicate"),
        "triangle_report": lambda s, d: G.triangle_report(src.edge_list(s, d), C, P.RUNS, "color"),
        "triangle_report_partition": lambda s, d: G.triangle_report(
            src.edge_list(s, d), C, P.RUNS[:1], "partition", P.BUCKET),
        "triangle_report_both": lambda s, d: G.triangle_report_both(
            src.edge_list(s, d), C, P.RUNS, P.BUCKET),
        "triangle_report_exact": lambda s, d: G.triangle_report(
            src.edge_list(s, d), C, P.RUNS, "exact"),
    }


def text_queries() -> dict[str, Query]:
    return {
        "documents_read": lambda s, d: line_documents(_docs(s, d), "doc_id", column="text"),
        "document_count": lambda s, d: T.document_count(_docs(s, d)),
        "words_per_document": lambda s, d: T.words_per_document(_docs(s, d)),
        "word_count": lambda s, d: T.word_count(_docs(s, d)),
        "word_count_salted_map":
            lambda s, d: T.word_count_salted(_docs(s, d), P.K_SALT, "per_document_word"),
        "word_count_salted_group":
            lambda s, d: T.word_count_salted(_docs(s, d), P.K_SALT, "on_the_fly"),
        "word_count_partitioned": lambda s, d: T.word_count_partitioned(_docs(s, d)),
        "distinct_word_count": lambda s, d: T.distinct_word_count(_docs(s, d), P.K_SALT),
        "average_word_length": lambda s, d: T.average_word_length(T.word_count(_docs(s, d))),
    }


def stream_queries() -> dict[str, Query]:
    prm, Kt = P.SKETCH, P.K_TOP
    return {
        # a streaming read of ``events`` to its end: its items, and what the
        # micro-batch ledger says about them
        "stream_source": lambda s, d: _streamed(s, d).frequencies(),
        "stream_lines": lambda s, d: _from_lines(s, d).frequencies(),
        "stream_batches": lambda s, d: _streamed(s, d).ledger_totals(),
        "stream_run_report": lambda s, d: _streamed(
            s, d, prm=prm, left=P.LEFT, right=P.RIGHT).report(Kt),
        "stream_run_distinct": lambda s, d: _streamed(s, d, on_stop="keep").distinct_report(),
        "batch_sizes": lambda s, d: I.batch_sizes(_items(s, d)),
        "stream_cutoff": lambda s, d: I.kept_batches(_items(s, d), P.THRESHOLD, "drop")
        .select("event_id", "batch_id", "item"),
        "stream_cutoff_keep": lambda s, d: I.kept_batches(_items(s, d), P.THRESHOLD, "keep")
        .select("event_id", "batch_id", "item"),
        "stream_cutoff_until": lambda s, d: I.batches_until(_items(s, d), P.THRESHOLD)
        .select("event_id", "batch_id", "item"),
        # one arrival file per micro-batch, everything remembered as streaming state
        "stream_micro_batches": lambda s, d: _state_run(s, _spooled(s, d)).ledger(),
        "stream_stop_drop": lambda s, d: _state_run(s, _spooled(s, d), threshold=P.THRESHOLD).frequencies(),
        "stream_stop_keep": lambda s, d: _state_run(
            s, _spooled(s, d), threshold=P.THRESHOLD, on_stop="keep").frequencies(),
        "stream_stop_ledger": lambda s, d: _state_run(s, _spooled(s, d), threshold=P.THRESHOLD).until_stop(),
        "running_frequencies_state": lambda s, d: _two_runs(s, d).frequencies(),
        "stream_state_report": lambda s, d: _two_runs(s, d).report(Kt),
        "running_distinct_state": _distinct_stream,
        "stream_ledger": lambda s, d: I.running_sizes(I.batch_sizes(_items(s, d))),
        "interval_filter": lambda s, d: I.in_interval(_items(s, d), P.LEFT, P.RIGHT),
        "batch_frequencies":
            lambda s, d: I.batch_frequencies(I.in_interval(_items(s, d), P.LEFT, P.RIGHT)),
        "running_frequencies": _freq,
        "count_sketch": lambda s, d: S.count_sketch(_freq(s, d), prm, weight="freq"),
        "count_sketch_4wise": lambda s, d: S.count_sketch(_flat_freq(s, d), P.SKETCH4, weight="freq"),
        "second_moment_families": _families,
        # every hour's sketch as one array; their sum, and an interval as a difference
        "sketch_per_batch": lambda s, d: _hourly(s, d).select("batch_id", F.array_join("cells", ",").alias("cells")),
        "sketch_rollup": lambda s, d: S.sketch_rows(S.add_sketches(_hourly(s, d), prm.D * prm.W), prm.W),
        "sketch_interval": _interval_sketch,
        "batch_distinct": lambda s, d: I.batch_distinct(_items(s, d)),
        "running_distinct": lambda s, d: I.running_distinct(_items(s, d)),
        "largest_item": lambda s, d: I.largest_item(_items(s, d)),
        "stream_length": lambda s, d: I.stream_length(_items(s, d)),
        "interval_length": lambda s, d: K.interval_length(_freq(s, d)),
        "interval_distinct": lambda s, d: K.interval_distinct(_freq(s, d)),
        "second_moment": lambda s, d: K.second_moment(_freq(s, d)),
        "sketch_estimates": lambda s, d: S.sketch_estimates(*_freq_sketch(s, d), prm),
        "second_moment_estimate": lambda s, d: _f2_est(s, d),
        "top_k_items": lambda s, d: K.top_k(_freq(s, d), Kt),
        "top_k_error": lambda s, d: K.top_k_error(*_freq_sketch(s, d), prm, Kt),
        "top_k_report": lambda s, d: K.top_k_report(*_freq_sketch(s, d), prm, Kt),
        "top_k_report_k50": lambda s, d: K.top_k_report(*_freq_sketch(s, d), prm, 50),
        "stream_report": lambda s, d: K.stream_report(_items(s, d), prm, P.LEFT, P.RIGHT, Kt),
        # the length of all items, the statistics of the kept batches only
        "stream_report_cutoff": lambda s, d: K.stream_report(
            _items(s, d), prm, P.LEFT, P.RIGHT, Kt, threshold=P.THRESHOLD),
        "distinct_report": lambda s, d: K.distinct_report(_items(s, d)),
        "distinct_report_keep": lambda s, d: K.distinct_report(_items(s, d), threshold=P.THRESHOLD),
        # the same report over the two other item fixtures: one item holding
        # about 39 % of the stream, and near-uniform items (the hard case for
        # the F2 estimate)
        "stream_report_skewed": lambda s, d: K.stream_report(
            src.items(s, d, "skewed"), prm, P.LEFT_SKEWED, P.RIGHT_SKEWED, Kt),
        "stream_report_flat": lambda s, d: K.stream_report(
            src.items(s, d, "flat"), prm, P.LEFT_FLAT, P.RIGHT_FLAT, Kt),
        "sketch_accuracy_sweep":
            lambda s, d: K.accuracy_sweep(_items(s, d), P.SWEEP_GRID, P.SWEEP_D, P.SWEEP_SEED),
    }


def _flat_freq(spark, d):
    return I.running_frequencies(I.in_interval(src.items(spark, d, "flat"), P.LEFT_FLAT, P.RIGHT_FLAT))


def _families(spark, d):
    """One row: the second moment of the near-uniform items, and its estimates from
    sketches of the affine and of the 4-wise independent family."""
    freq = _flat_freq(spark, d)
    length = K.interval_length(freq)

    def estimate(prm, name):
        sketch = S.count_sketch(freq, prm, weight="freq")
        return K.second_moment_estimate(sketch, length).withColumnRenamed("f2_estimate", name)

    return merge_single_rows(K.second_moment(freq), estimate(P.SKETCH, "f2_affine"), estimate(P.SKETCH4, "f2_4wise"))


def _hourly(spark, d):
    return S.batch_sketches(I.in_interval(_items(spark, d), P.LEFT, P.RIGHT), P.SKETCH)


def _interval_sketch(spark, d):
    hours, size = _hourly(spark, d), P.SKETCH.D * P.SKETCH.W
    upto = S.add_sketches(hours.where(F.col("batch_id") < P.HOUR_TO), size)
    before = S.add_sketches(hours.where(F.col("batch_id") < P.HOUR_FROM), size)
    return S.sketch_rows(S.subtract_sketches(upto, before), P.SKETCH.W)


def _f2_est(spark, d):
    freq, sk = _freq_sketch(spark, d)
    return K.second_moment_estimate(sk, K.interval_length(freq))


def queries() -> dict[str, Query]:
    return {**graph_queries(), **text_queries(), **stream_queries()}


FLAGSHIP = "triangle_count"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()[FLAGSHIP](spark, sf_dir)


__all__ = ["queries", "flagship"]
