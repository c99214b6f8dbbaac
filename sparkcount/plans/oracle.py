"""DuckDB SQL for every registered query: the independent check.

Written the plain way - triangles by a three-way self-join in id order, top-K
by ``ROW_NUMBER``, medians by ``median`` - with the same literals as the Spark
plans (``plans.params``).    Sums are cast back to BIGINT (DuckDB widens them to
HUGEINT) and ratios are rounded to 9 places, as on the Spark side.
"""

from __future__ import annotations

from sparkcount.operators.sketch import SketchParams
from sparkcount.plans import params as P

# Inputs and hash formulas are written out here, not taken from the engine, so
# that a slip on either side shows.
SQL_EDGE_LIST = "SELECT CAST(l_partkey AS BIGINT) AS u, CAST(l_suppkey AS BIGINT) AS v FROM lineitem"


def sql_items(kind: str) -> str:
    item = {"value": "floor(value)", "skewed": "floor(value / 25)", "flat": "user_id"}[kind]
    return ("SELECT event_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS batch_id, "
            f"CAST({item} AS BIGINT) AS item FROM events")


def _mod(x: str, p: int) -> str:
    """``x`` modulo ``p`` in ``[0, p)``."""
    return f"(CAST({x} AS BIGINT) - {p} * CAST(floor(CAST({x} AS DECIMAL(38, 0)) / {p}) AS BIGINT))"


def _affine(x: str, a, b, p: int) -> str:
    return f"(({a} * {_mod(x, p)} + {b}) % {p})"


def _hash(x: str, a, b, m, p: int = 8191) -> str:
    return f"({_affine(x, a, b, p)} % {m})"


def _sign(x: str, a, b, p: int = 8191) -> str:
    return f"CASE WHEN {_affine(x, a, b, p)} % 2 = 1 THEN 1 ELSE -1 END"


def _bucket(u: str, v: str, h, m) -> str:
    return f"(({h.a} * {_mod(u, h.p)} + {h.b} * {_mod(v, h.p)} + {h.c}) % {h.p} % {m})"


EDGES = f"SELECT DISTINCT u, v FROM ({SQL_EDGE_LIST})"


def _und(src: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return (f"SELECT DISTINCT {k}least(u, v) AS u, greatest(u, v) AS v "
            f"FROM ({src}) WHERE u <> v")


def _tri_rows(und: str, keys: list[str] = ()) -> str:
    """Rows ``(keys..., x, y, z)``, one per triangle ``x < y < z``."""
    on_b = " AND ".join([f"a.{k} = b.{k}" for k in keys] + ["a.v = b.u"])
    on_c = " AND ".join([f"a.{k} = c.{k}" for k in keys] + ["c.u = a.u", "c.v = b.v"])
    sel = ", ".join([f"a.{k} AS {k}" for k in keys] + ["a.u AS x", "a.v AS y", "b.v AS z"])
    return (f"SELECT {sel} FROM ({und}) a JOIN ({und}) b ON {on_b} "
            f"JOIN ({und}) c ON {on_c}")


def _col(x: str, h, m) -> str:
    return _hash(x, h.a, h.b, m, h.p)


def _sorted3(a: str, b: str, c: str) -> tuple[str, str, str]:
    lo = f"least({a}, {b}, {c})"
    hi = f"greatest({a}, {b}, {c})"
    return lo, f"(({a}) + ({b}) + ({c}) - {lo} - {hi})", hi


# ---- graph -------------------------------------------------------------------

def _mono(h, C: int) -> str:
    return (f"SELECT {_col('u', h, C)} AS color, u, v FROM ({EDGES}) "
            f"WHERE {_col('u', h, C)} = {_col('v', h, C)}")


def _per_color(h, C: int) -> str:
    mono = _mono(h, C)
    tri = _tri_rows(_und(mono, "color"), ["color"])
    return (f"SELECT p.color, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles "
            f"FROM (SELECT DISTINCT color FROM ({mono})) p LEFT JOIN "
            f"(SELECT color, count(*) AS n FROM ({tri}) GROUP BY color) t USING (color)")


def _runs(hs, C: int) -> str:
    vals = ", ".join(f"({i}, {h.a}, {h.b})" for i, h in enumerate(hs))
    p = hs[0].p
    cu = _hash("e.u", "r.a", "r.b", C, p)
    cv = _hash("e.v", "r.a", "r.b", C, p)
    mono = (f"SELECT r.run AS run, {cu} AS color, e.u AS u, e.v AS v FROM ({EDGES}) e, "
            f"(VALUES {vals}) r(run, a, b) WHERE {cu} = {cv}")
    und = (f"SELECT DISTINCT run, color, least(u, v) AS u, greatest(u, v) AS v "
           f"FROM ({mono}) WHERE u <> v")
    tri = _tri_rows(und, ["run", "color"])
    return (f"SELECT CAST(r.range AS INTEGER) AS run, "
            f"CAST(coalesce(t.n, 0) * {C * C} AS BIGINT) AS triangles FROM range({len(hs)}) r "
            f"LEFT JOIN (SELECT run, count(*) AS n FROM ({tri}) GROUP BY run) t ON t.run = r.range")


def _part_edges(hb, C: int) -> str:
    return f"SELECT u, v, CAST({_bucket('u', 'v', hb, C)} AS INTEGER) AS part FROM ({EDGES})"


def _per_part(hb, C: int) -> str:
    tri = _tri_rows(_und(_part_edges(hb, C), "part"), ["part"])
    return (f"SELECT CAST(r.range AS INTEGER) AS part, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles "
            f"FROM range({C}) r LEFT JOIN (SELECT part, count(*) AS n FROM ({tri}) GROUP BY part) t "
            f"ON t.part = r.range")


def _replicated(h, C: int) -> str:
    c1, c2, c3 = _sorted3(_col("u", h, C), _col("v", h, C), "i.range")
    return (f"SELECT {c1} AS c1, {c2} AS c2, {c3} AS c3, u, v FROM ({EDGES}), range({C}) i")


def _per_triple(h, C: int) -> str:
    tri = _tri_rows(_und(EDGES))
    c1, c2, c3 = _sorted3(_col("x", h, C), _col("y", h, C), _col("z", h, C))
    counts = (f"SELECT c1, c2, c3, count(*) AS n FROM (SELECT {c1} AS c1, {c2} AS c2, {c3} AS c3 "
              f"FROM ({tri})) GROUP BY c1, c2, c3")
    keys = f"SELECT DISTINCT c1, c2, c3 FROM ({_replicated(h, C)})"
    return (f"SELECT k.c1, k.c2, k.c3, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles "
            f"FROM ({keys}) k LEFT JOIN ({counts}) t USING (c1, c2, c3)")


def graph_sql() -> dict[str, str]:
    C, h = P.C, P.H1
    return {
        "edges_read": SQL_EDGE_LIST,
        "edges_distinct": EDGES,
        "edge_count": f"SELECT count(*) AS n_edges FROM ({EDGES})",
        "edges_undirected": _und(EDGES),
        "triangle_count": f"SELECT count(*) AS triangles FROM ({_tri_rows(_und(EDGES))})",
        "node_colors": (f"SELECT node, {_col('node', h, C)} AS color FROM "
                        f"(SELECT u AS node FROM ({EDGES}) UNION SELECT v FROM ({EDGES}))"),
        "edges_monochromatic": _mono(h, C),
        "triangles_per_color": _per_color(h, C),
        "approx_triangles_color": (f"SELECT CAST(coalesce(sum(triangles), 0) * {C * C} AS BIGINT) "
                                   f"AS triangles FROM ({_per_color(h, C)})"),
        "approx_triangles_color_median": (f"SELECT CAST(median(triangles) AS DOUBLE) AS triangles "
                                          f"FROM ({_runs(P.RUNS, C)})"),
        "edges_partitioned": _part_edges(P.BUCKET, C),
        "triangles_per_partition": _per_part(P.BUCKET, C),
        "approx_triangles_partition": (f"SELECT CAST(coalesce(sum(triangles), 0) * {C * C} AS BIGINT) "
                                       f"AS triangles FROM ({_per_part(P.BUCKET, C)})"),
        "edges_by_color_triple": _replicated(h, C),
        "triangles_per_color_triple": _per_triple(h, C),
        "exact_triangles_color": (f"SELECT CAST(coalesce(sum(triangles), 0) AS BIGINT) AS triangles "
                                  f"FROM ({_per_triple(h, C)})"),
        "triangles_per_color_triple_replicated": _per_triple(h, C),
        "exact_triangles_color_replicated": (f"SELECT CAST(coalesce(sum(triangles), 0) AS BIGINT) "
                                             f"AS triangles FROM ({_per_triple(h, C)})"),
        "triangle_report": (f"SELECT (SELECT count(*) FROM ({EDGES})) AS n_edges, {C} AS colors, "
                            f"{len(P.RUNS)} AS runs, 'color' AS method, "
                            f"(SELECT CAST(median(triangles) AS DOUBLE) FROM ({_runs(P.RUNS, C)})) "
                            f"AS triangles"),
        "triangle_report_partition": (
            f"SELECT (SELECT count(*) FROM ({EDGES})) AS n_edges, {C} AS colors, 1 AS runs, "
            f"'partition' AS method, (SELECT CAST(sum(triangles) * {C * C} AS DOUBLE) "
            f"FROM ({_per_part(P.BUCKET, C)})) AS triangles"),
        "triangle_report_both": (
            f"SELECT (SELECT count(*) FROM ({EDGES})) AS n_edges, {C} AS colors, {len(P.RUNS)} AS runs, "
            f"(SELECT CAST(median(triangles) AS DOUBLE) FROM ({_runs(P.RUNS, C)})) AS color_triangles, "
            f"(SELECT CAST(sum(triangles) * {C * C} AS DOUBLE) FROM ({_per_part(P.BUCKET, C)})) "
            f"AS partition_triangles"),
        "triangle_report_exact": (
            f"SELECT (SELECT count(*) FROM ({EDGES})) AS n_edges, {C} AS colors, "
            f"{len(P.RUNS)} AS runs, 'exact' AS method, (SELECT CAST(sum(triangles) AS DOUBLE) "
            f"FROM ({_per_triple(P.RUNS[-1], C)})) AS triangles"),
    }


# ---- text --------------------------------------------------------------------

WORDS = "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents"
WORD_COUNT = f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word"


def text_sql() -> dict[str, str]:
    n = f"(SELECT count(DISTINCT word) FROM ({WORDS}))"
    total = f"(SELECT count(*) FROM ({WORDS}))"
    return {
        "documents_read": "SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents",
        "document_count": "SELECT count(*) AS n_documents FROM documents",
        "words_per_document": f"SELECT doc_id, word, count(*) AS n FROM ({WORDS}) GROUP BY doc_id, word",
        "word_count": WORD_COUNT,
        "word_count_salted_map": WORD_COUNT,
        "word_count_salted_group": WORD_COUNT,
        "word_count_partitioned": WORD_COUNT,
        "distinct_word_count": "SELECT " + ", ".join(
            f"{n} AS {m}, {total} AS {m}_total"
            for m in ("one_round", "salted_map", "salted_group", "partitioned")),
        "average_word_length": (f"SELECT count(*) AS n_words, "
                                f"round(CAST(sum(length(word)) AS DOUBLE) / count(*), 9) AS avg_length "
                                f"FROM ({WORD_COUNT})"),
    }


# ---- stream ------------------------------------------------------------------

ITEMS = sql_items("value")
IN_ITEMS = f"SELECT * FROM ({ITEMS}) WHERE item BETWEEN {P.LEFT} AND {P.RIGHT}"
FREQ = f"SELECT item, count(*) AS freq FROM ({IN_ITEMS}) GROUP BY item"


def _freq_of(kind: str, left: int, right: int, kept: str = "true") -> str:
    return (f"SELECT item, count(*) AS freq FROM ({sql_items(kind)}) "
            f"WHERE item BETWEEN {left} AND {right} AND {kept} GROUP BY item")


def _prm_values(prm: SketchParams) -> str:
    vals = ", ".join(f"({j}, {a}, {b}, {a2}, {b2})" for j, (a, b, a2, b2) in enumerate(prm.rows))
    return f"(VALUES {vals}) q(j, a, b, a2, b2)"


def _cells(prm: SketchParams, freq: str = FREQ) -> str:
    k = _hash("f.item", "q.a", "q.b", prm.W, prm.p)
    g = _sign("f.item", "q.a2", "q.b2", prm.p)
    return f"SELECT f.item AS item, f.freq AS freq, q.j AS j, {k} AS k, {g} AS g FROM ({freq}) f, {_prm_values(prm)}"


def _sketch(prm: SketchParams, freq: str = FREQ) -> str:
    return f"SELECT j, k, CAST(sum(g * freq) AS BIGINT) AS c FROM ({_cells(prm, freq)}) GROUP BY j, k"


def _poly(x: str, coefficients, p: int) -> str:
    """Polynomial at ``x`` modulo ``p``, powers written out in HUGEINT."""
    n = len(coefficients) - 1
    r = f"CAST({_mod(x, p)} AS HUGEINT)"
    powers = {0: "1", 1: r, 2: f"({r} * {r} % {p})", 3: f"({r} * {r} % {p} * {r} % {p})"}
    return "((" + " + ".join(f"{c} * {powers[n - i]}" for i, c in enumerate(coefficients)) + f") % {p})"


def _sketch4(prm, freq: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {j} AS j, CAST({_poly('f.item', h, prm.p)} % {prm.W} AS BIGINT) AS k, "
        f"f.freq * CASE WHEN {_poly('f.item', g, prm.p)} % 2 = 1 THEN 1 ELSE -1 END AS c FROM ({freq}) f"
        for j, (h, g) in enumerate(prm.rows))
    return f"SELECT j, k, CAST(sum(c) AS BIGINT) AS c FROM ({rows}) GROUP BY j, k"


def _f2_of(sketch: str, freq: str) -> str:
    return (f"SELECT round((SELECT median(CAST(s AS DOUBLE)) FROM (SELECT j, sum(CAST(c AS HUGEINT) * c) AS s "
            f"FROM ({sketch}) GROUP BY j)) / (CAST((SELECT sum(freq) FROM ({freq})) AS DOUBLE) ^ 2), 9)")


def _hour_freq(where: str) -> str:
    return f"SELECT item, count(*) AS freq FROM ({IN_ITEMS}) WHERE {where} GROUP BY item"


def _per_batch(prm: SketchParams) -> str:
    """Every hour's cells in order, comma separated."""
    freq = f"SELECT batch_id, item, count(*) AS freq FROM ({IN_ITEMS}) GROUP BY batch_id, item"
    k = _hash("f.item", "q.a", "q.b", prm.W, prm.p)
    g = _sign("f.item", "q.a2", "q.b2", prm.p)
    cells = (f"SELECT batch_id, j * {prm.W} + k AS i, sum(g * freq) AS c FROM (SELECT f.batch_id, f.freq, q.j, "
             f"{k} AS k, {g} AS g FROM ({freq}) f, {_prm_values(prm)}) GROUP BY batch_id, i")
    return (f"SELECT b.batch_id, string_agg(CAST(CAST(coalesce(c.c, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY r.i) AS cells "
            f"FROM (SELECT DISTINCT batch_id FROM ({IN_ITEMS})) b CROSS JOIN range({prm.D * prm.W}) r(i) "
            f"LEFT JOIN ({cells}) c ON c.batch_id = b.batch_id AND c.i = r.i GROUP BY b.batch_id")


def _micro() -> str:
    """Micro-batches of the arrival files: ``batch_id, n, running`` and the file's ``arrival``."""
    sizes = (f"SELECT batch_id // {P.ARRIVAL_HOURS} AS arrival, count(*) AS n FROM ({ITEMS}) GROUP BY arrival")
    return (f"SELECT arrival, row_number() OVER (ORDER BY arrival) - 1 AS batch_id, n, CAST(sum(n) OVER (ORDER BY arrival "
            f"ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM ({sizes})")


def _stopped(kept: str) -> str:
    return (f"SELECT item, count(*) AS freq FROM ({IN_ITEMS}) WHERE batch_id // {P.ARRIVAL_HOURS} IN "
            f"(SELECT arrival FROM ({_micro()}) WHERE {kept} < {P.THRESHOLD}) GROUP BY item")


def _est(prm: SketchParams, freq: str = FREQ) -> str:
    return (f"SELECT cl.item AS item, CAST(median(coalesce(s.c, 0) * cl.g) AS DOUBLE) AS est "
            f"FROM ({_cells(prm, freq)}) cl LEFT JOIN ({_sketch(prm, freq)}) s "
            f"ON s.j = cl.j AND s.k = cl.k GROUP BY cl.item")


def _top(K: int, freq: str = FREQ) -> str:
    return (f"SELECT item, freq FROM (SELECT item, freq, row_number() OVER "
            f"(ORDER BY freq DESC, item ASC) AS r FROM ({freq})) WHERE r <= {K}")


def _f2(freq: str = FREQ) -> str:
    return (f"SELECT round(CAST(sum(CAST(freq AS HUGEINT) * freq) AS DOUBLE) / "
            f"CAST(sum(freq) * sum(freq) AS DOUBLE), 9) AS f2 FROM ({freq})")


def _f2_est(prm: SketchParams, freq: str = FREQ) -> str:
    sq = f"SELECT j, sum(CAST(c AS HUGEINT) * c) AS s FROM ({_sketch(prm, freq)}) GROUP BY j"
    return (f"SELECT round((SELECT median(CAST(s AS DOUBLE)) FROM ({sq})) / "
            f"(CAST((SELECT sum(freq) FROM ({freq})) AS DOUBLE) ^ 2), 9) AS f2_estimate")


def _top_err(prm: SketchParams, K: int, freq: str = FREQ) -> str:
    return (f"SELECT round(sum(abs(t.freq - e.est) / t.freq) / count(*), 9) AS top_k_error "
            f"FROM ({_top(K, freq)}) t LEFT JOIN ({_est(prm, freq)}) e USING (item)")


def _report(prm: SketchParams, K: int, kind: str, left: int, right: int, kept: str = "true") -> str:
    items, freq = sql_items(kind), _freq_of(kind, left, right, kept)
    return (f"SELECT {prm.D} AS D, {prm.W} AS W, CAST({left} AS BIGINT) AS \"left\", "
            f"CAST({right} AS BIGINT) AS \"right\", {K} AS K, "
            f"(SELECT count(*) FROM ({items})) AS stream_length, "
            f"(SELECT CAST(coalesce(sum(freq), 0) AS BIGINT) FROM ({freq})) AS interval_length, "
            f"(SELECT count(*) FROM ({freq})) AS interval_distinct, "
            f"({_top_err(prm, K, freq)}) AS top_k_error, ({_f2(freq)}) AS f2, "
            f"({_f2_est(prm, freq)}) AS f2_estimate")


def _distinct(items: str) -> str:
    return (f"SELECT count(*) AS n_items, count(DISTINCT item) AS n_distinct, "
            f"max(item) AS largest_item FROM ({items})")


def _batches(threshold: int, length: str) -> str:
    """Batches whose ``length`` (of ``running``, the stream's after the batch, and
    ``n``, the batch's) is below the threshold."""
    sizes = f"SELECT batch_id, count(*) AS n FROM ({ITEMS}) GROUP BY batch_id"
    run = (f"SELECT batch_id, n, sum(n) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING "
           f"AND CURRENT ROW) AS running FROM ({sizes})")
    return f"SELECT batch_id FROM ({run}) WHERE {length} < {threshold}"


def _cutoff(threshold: int) -> str:
    return (f"SELECT event_id, batch_id, item FROM ({ITEMS}) WHERE batch_id IN "
            f"({_batches(threshold, 'running')})")


def _sweep() -> str:
    rows = []
    for cfg, g in enumerate(P.SWEEP_GRID):
        prm = SketchParams.draw(P.SWEEP_D, g["W"], P.SWEEP_SEED + cfg)
        for j, (a, b, a2, b2) in enumerate(prm.rows):
            rows.append(f"({cfg}, {j}, {g['W']}, {g['K']}, {g['left']}, {g['right']}, {g['rep']}, "
                        f"{a}, {b}, {a2}, {b2})")
    grid = f"(VALUES {', '.join(rows)}) q(cfg, j, W, K, lo, hi, rep, a, b, a2, b2)"
    freq = f"SELECT item, count(*) AS freq FROM ({ITEMS}) GROUP BY item"
    k = _hash("f.item", "q.a", "q.b", "q.W")
    g = _sign("f.item", "q.a2", "q.b2")
    cells = (f"SELECT q.cfg AS cfg, q.j AS j, f.item AS item, f.freq AS freq, {k} AS k, {g} AS g "
             f"FROM ({freq}) f, {grid} WHERE f.item BETWEEN q.lo AND q.hi")
    sketch = f"SELECT cfg, j, k, sum(g * freq) AS c FROM cells GROUP BY cfg, j, k"
    est = (f"SELECT cl.cfg AS cfg, cl.item AS item, any_value(cl.freq) AS freq, "
           f"median(s.c * cl.g) AS est FROM cells cl JOIN sketch s "
           f"ON s.cfg = cl.cfg AND s.j = cl.j AND s.k = cl.k GROUP BY cl.cfg, cl.item")
    settings = ("SELECT DISTINCT CAST(cfg AS INTEGER) AS cfg, CAST(W AS INTEGER) AS W, "
                "CAST(K AS INTEGER) AS K, CAST(lo AS BIGINT) AS \"left\", CAST(hi AS BIGINT) AS \"right\", "
                f"CAST(rep AS INTEGER) AS rep FROM {grid}")
    true = ("SELECT cfg, CAST(sum(freq) AS BIGINT) AS interval_length, "
            "round(CAST(sum(CAST(freq AS HUGEINT) * freq) AS DOUBLE) / "
            "CAST(sum(freq) * sum(freq) AS DOUBLE), 9) AS f2 FROM est GROUP BY cfg")
    sq = ("SELECT cfg, median(CAST(s AS DOUBLE)) AS m FROM (SELECT cfg, j, "
          "sum(CAST(c AS HUGEINT) * c) AS s FROM sketch GROUP BY cfg, j) GROUP BY cfg")
    top = ("SELECT e.cfg, e.item, e.freq, e.est FROM (SELECT est.*, row_number() OVER "
           "(PARTITION BY est.cfg ORDER BY est.freq DESC, est.item ASC) AS r FROM est) e "
           "JOIN settings st ON st.cfg = e.cfg WHERE e.r <= st.K")
    err = ("SELECT cfg, round(sum(abs(freq - est) / freq) / count(*), 9) AS top_k_error "
           "FROM top GROUP BY cfg")
    return (f"WITH cells AS ({cells}), sketch AS ({sketch}), est AS ({est}), "
            f"settings AS ({settings}), top AS ({top}) "
            f"SELECT st.cfg, {P.SWEEP_D} AS D, st.W, st.K, st.\"left\", st.\"right\", st.rep, "
            f"CAST(coalesce(t.interval_length, 0) AS BIGINT) AS interval_length, er.top_k_error, "
            f"t.f2, round(q.m / (CAST(t.interval_length AS DOUBLE) ^ 2), 9) AS f2_estimate "
            f"FROM settings st LEFT JOIN ({true}) t ON t.cfg = st.cfg "
            f"LEFT JOIN ({sq}) q ON q.cfg = st.cfg LEFT JOIN ({err}) er ON er.cfg = st.cfg")


FLAT = _freq_of("flat", P.LEFT_FLAT, P.RIGHT_FLAT)


def stream_sql() -> dict[str, str]:
    prm, K = P.SKETCH, P.K_TOP
    return {
        "stream_source": f"SELECT item, count(*) AS freq FROM ({ITEMS}) GROUP BY item",
        "stream_lines": f"SELECT item, count(*) AS freq FROM ({ITEMS}) GROUP BY item",
        "stream_batches": f"SELECT count(*) AS n_items, count(*) AS n_kept FROM ({ITEMS})",
        "stream_run_report": _report(prm, K, "value", P.LEFT, P.RIGHT),
        "stream_run_distinct": _distinct(ITEMS),
        "batch_sizes": f"SELECT batch_id, count(*) AS n FROM ({ITEMS}) GROUP BY batch_id",
        "stream_cutoff": _cutoff(P.THRESHOLD),
        "stream_cutoff_keep": f"SELECT event_id, batch_id, item FROM ({ITEMS})",
        "stream_cutoff_until": (f"SELECT event_id, batch_id, item FROM ({ITEMS}) WHERE batch_id IN "
                                f"({_batches(P.THRESHOLD, 'running - n')})"),
        "stream_micro_batches": f"SELECT batch_id, n, running, true AS kept FROM ({_micro()})",
        "stream_stop_drop": _stopped("running"),
        "stream_stop_keep": _stopped("running - n"),
        "stream_stop_ledger": (f"SELECT batch_id, n, running, running < {P.THRESHOLD} AS kept FROM ({_micro()}) "
                               f"WHERE running - n < {P.THRESHOLD}"),
        "running_frequencies_state": FREQ,
        "stream_state_report": _report(prm, K, "value", P.LEFT, P.RIGHT),
        "running_distinct_state": f"SELECT DISTINCT item FROM ({ITEMS})",
        "count_sketch_4wise": _sketch4(P.SKETCH4, FLAT),
        "second_moment_families": (f"SELECT ({_f2(FLAT)}) AS f2, ({_f2_of(_sketch(prm, FLAT), FLAT)}) AS f2_affine, "
                                   f"({_f2_of(_sketch4(P.SKETCH4, FLAT), FLAT)}) AS f2_4wise"),
        "sketch_per_batch": _per_batch(prm),
        "sketch_rollup": f"SELECT * FROM ({_sketch(prm)}) WHERE c <> 0",
        "sketch_interval": "SELECT * FROM ({}) WHERE c <> 0".format(
            _sketch(prm, _hour_freq(f"batch_id >= {P.HOUR_FROM} AND batch_id < {P.HOUR_TO}"))),
        "stream_ledger": (f"SELECT batch_id, n, CAST(sum(n) OVER (ORDER BY batch_id ROWS BETWEEN "
                          f"UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running FROM "
                          f"(SELECT batch_id, count(*) AS n FROM ({ITEMS}) GROUP BY batch_id)"),
        "interval_filter": f"SELECT event_id, batch_id, item FROM ({IN_ITEMS})",
        "batch_frequencies": f"SELECT batch_id, item, count(*) AS n FROM ({IN_ITEMS}) GROUP BY batch_id, item",
        "running_frequencies": FREQ,
        "count_sketch": _sketch(prm),
        "batch_distinct": f"SELECT DISTINCT batch_id, item FROM ({ITEMS})",
        "running_distinct": f"SELECT DISTINCT item FROM ({ITEMS})",
        "largest_item": f"SELECT max(item) AS largest_item FROM ({ITEMS})",
        "stream_length": f"SELECT count(*) AS stream_length FROM ({ITEMS})",
        "interval_length": f"SELECT CAST(coalesce(sum(freq), 0) AS BIGINT) AS interval_length FROM ({FREQ})",
        "interval_distinct": f"SELECT count(*) AS interval_distinct FROM ({FREQ})",
        "second_moment": _f2(),
        "sketch_estimates": _est(prm),
        "second_moment_estimate": _f2_est(prm),
        "top_k_items": _top(K),
        "top_k_error": _top_err(prm, K),
        "top_k_report": (f"SELECT t.item, t.freq, e.est FROM ({_top(K)}) t LEFT JOIN ({_est(prm)}) e "
                         f"USING (item)"),
        "top_k_report_k50": (f"SELECT t.item, t.freq, e.est FROM ({_top(50)}) t LEFT JOIN ({_est(prm)}) e "
                             f"USING (item)"),
        "stream_report": _report(prm, K, "value", P.LEFT, P.RIGHT),
        "stream_report_cutoff": _report(prm, K, "value", P.LEFT, P.RIGHT,
                                        f"batch_id IN ({_batches(P.THRESHOLD, 'running')})"),
        "distinct_report": _distinct(ITEMS),
        "distinct_report_keep": _distinct(
            f"SELECT * FROM ({ITEMS}) WHERE batch_id IN ({_batches(P.THRESHOLD, 'running - n')})"),
        "sketch_accuracy_sweep": _sweep(),
        "stream_report_skewed": _report(prm, K, "skewed", P.LEFT_SKEWED, P.RIGHT_SKEWED),
        "stream_report_flat": _report(prm, K, "flat", P.LEFT_FLAT, P.RIGHT_FLAT),
    }


def oracle_sql() -> dict[str, str]:
    return {**graph_sql(), **text_sql(), **stream_sql()}
