"""Graph operators: exact and estimated triangle counts over an edge table.

Edges are ``(u BIGINT, v BIGINT)`` ordered pairs.  The triangle operators
accept repeated pairs: they make edges undirected and distinct after the
colour or bucket is chosen, and a repeated pair always gets the same one.

Estimates thin the graph by hashing nodes to ``C`` colours (keep
monochromatic edges) or ordered pairs to ``C`` buckets, count triangles per
colour / bucket, and scale by ``C^2``.  Every per-colour, per-run and
per-bucket count is one keyed triangle listing (``triangles``), so ``R`` runs
or ``C`` buckets are one job, and the finishing aggregate is SQL run in the
same statement (``triangles.triangles_query``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.functions import hashing as H
from sparkcount.functions.frames import replicate
from sparkcount.operators.triangles import count_by_group, count_triangles, triangles_query


# ---- G2-G5 -----------------------------------------------------------------

def distinct_edges(edges: DataFrame) -> DataFrame:
    """Drop repeated ordered pairs; ``(u,v)``, ``(v,u)`` and loops all stay."""
    return edges.dropDuplicates(["u", "v"])


def edge_count(edges: DataFrame) -> DataFrame:
    """One row ``n_edges``: rows of the (already deduplicated) edge table."""
    return edges.agg(F.count(F.lit(1)).alias("n_edges"))


def undirected(edges: DataFrame, *keys: str) -> DataFrame:
    """Symmetric, loop-free view: ``(keys..., u, v)`` with ``u < v``, each pair
    once per key group."""
    # ``u <> v`` already rules out NULL ends; the coalesces only tell Catalyst
    # so.  Without it the triangle joins infer an extra ``isnotnull`` filter
    # on one copy of this subtree, the copies stop being equal, and the
    # dedupe shuffle runs twice instead of being reused.
    # Keys are never NULL here (hashes of non-NULL ids, run numbers).
    lo = F.coalesce(F.least("u", "v"), F.lit(0).cast("bigint"))
    hi = F.coalesce(F.greatest("u", "v"), F.lit(0).cast("bigint"))
    types = dict(edges.dtypes)
    ks = [F.coalesce(F.col(k), F.lit(0).cast(types[k])).alias(k) for k in keys]
    return (edges.where(F.col("u") != F.col("v"))
            .select(*ks, lo.alias("u"), hi.alias("v"))
            .dropDuplicates([*keys, "u", "v"]))


def triangle_count(edges: DataFrame) -> DataFrame:
    """One row ``triangles``: exact count, each triangle once."""
    return count_triangles(undirected(edges))


# ---- G6-G10: node colouring --------------------------------------------------

def color_nodes(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """``(node, color)`` for every node that appears in an edge."""
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.select("node", H.color("node", h.a, h.b, C, h.p).alias("color"))


def monochromatic_edges(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """``(color, u, v)`` for edges whose two ends share a colour (loops too)."""
    cu = H.color("u", h.a, h.b, C, h.p)
    cv = H.color("v", h.a, h.b, C, h.p)
    return (edges.select(cu.alias("color"), cv.alias("cv"), "u", "v")
            .where(F.col("color") == F.col("cv")).select("color", "u", "v"))


def triangles_per_color(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """``(color, triangles)`` for every colour that has a monochromatic edge."""
    mono = monochromatic_edges(edges, C, h)
    return triangles_query(undirected(mono, "color"), ["color"], """
SELECT color, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles
FROM (SELECT DISTINCT color FROM {mono}) p
LEFT JOIN (SELECT color, sum(c) AS n FROM closed GROUP BY color) t USING (color)""",
                           mono=mono)


def approx_triangles_color(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """One row ``triangles`` = ``C^2 * sum of per-colour counts``."""
    mono = monochromatic_edges(edges, C, h)
    return triangles_query(undirected(mono, "color"), ["color"],
                           f"SELECT CAST(coalesce(sum(c), 0) * {C * C} AS BIGINT) AS triangles FROM closed")


def _runs_sql(C: int, R: int) -> str:
    return f"""
SELECT CAST(r.id AS INT) AS run, CAST(coalesce(t.n, 0) * {C * C} AS BIGINT) AS triangles
FROM range({R}) r
LEFT JOIN (SELECT run, sum(c) AS n FROM closed GROUP BY run) t ON t.run = r.id"""


def _mono_runs(edges: DataFrame, C: int, hs: Sequence[H.Affine]) -> DataFrame:
    params = [{"run": i, "a": h.a, "b": h.b} for i, h in enumerate(hs)]
    p = hs[0].p
    if any(h.p != p for h in hs):
        raise ValueError("the runs of one job share their modulus p")
    rows = edges.select("u", "v", replicate(params).alias("prm"))
    cu = H.color("u", "prm.a", "prm.b", C, p)
    cv = H.color("v", "prm.a", "prm.b", C, p)
    mono = (rows.select(F.col("prm.run").alias("run"), cu.alias("color"), cv.alias("cv"), "u", "v")
            .where(F.col("color") == F.col("cv")))
    return undirected(mono, "run", "color")


def approx_triangles_color_runs(edges: DataFrame, C: int, hs: Sequence[H.Affine]) -> DataFrame:
    """``(run, triangles)``: the colour estimate for each hash in ``hs``, all
    runs in one job.  Each edge is copied once per run inside its stage
    (explode of the parameter array) and filtered at once, so about ``R/C`` of
    the edges reach the shuffle; a run with no triangle gives 0."""
    return triangles_query(_mono_runs(edges, C, hs), ["run", "color"], _runs_sql(C, len(hs)))


def approx_triangles_color_median(edges: DataFrame, C: int, hs: Sequence[H.Affine]) -> DataFrame:
    """One row ``triangles`` (DOUBLE): median over runs of the colour estimate."""
    return triangles_query(
        _mono_runs(edges, C, hs), ["run", "color"],
        f"SELECT CAST(median(triangles) AS DOUBLE) AS triangles FROM ({_runs_sql(C, len(hs))})")


# ---- G11-G13: edge buckets -------------------------------------------------

def partition_edges(edges: DataFrame, C: int, hb: H.EdgeBucket) -> DataFrame:
    """``(u, v, part)``: bucket of each ordered pair in ``[0, C)``."""
    return edges.select("u", "v", H.edge_bucket("u", "v", hb, C).cast("int").alias("part"))


def triangles_per_partition(edges: DataFrame, C: int, hb: H.EdgeBucket) -> DataFrame:
    """``(part, triangles)`` for every bucket ``0..C-1``; edges are made
    undirected inside each bucket, after the bucket is chosen."""
    return triangles_query(undirected(partition_edges(edges, C, hb), "part"), ["part"], f"""
SELECT CAST(r.id AS INT) AS part, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles
FROM range({C}) r
LEFT JOIN (SELECT part, sum(c) AS n FROM closed GROUP BY part) t ON t.part = r.id""")


def approx_triangles_partition(edges: DataFrame, C: int, hb: H.EdgeBucket) -> DataFrame:
    """One row ``triangles`` = ``C^2 * sum of per-bucket counts``."""
    return triangles_query(undirected(partition_edges(edges, C, hb), "part"), ["part"],
                           f"SELECT CAST(coalesce(sum(c), 0) * {C * C} AS BIGINT) AS triangles FROM closed")


# ---- G14-G16: colour triples (exact) -----------------------------------------

def _sorted3(a, b, c):
    lo = F.least(a, b, c)
    hi = F.greatest(a, b, c)
    return lo, (a + b + c - lo - hi), hi


def replicate_by_color_triple(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """``(c1, c2, c3, u, v)``: every edge once per ``i`` in ``0..C-1`` under the
    key ``sorted(h(u), h(v), i)``."""
    cu = H.color("u", h.a, h.b, C, h.p)
    cv = H.color("v", h.a, h.b, C, h.p)
    rows = edges.select("u", "v", cu.alias("cu"), cv.alias("cv"),
                        F.explode(F.sequence(F.lit(0), F.lit(C - 1))).alias("i"))
    c1, c2, c3 = _sorted3(F.col("cu"), F.col("cv"), F.col("i").cast("bigint"))
    return rows.select(c1.alias("c1"), c2.alias("c2"), c3.alias("c3"), "u", "v")


def _triple_keys(edges: DataFrame, C: int, h: H.Affine) -> DataFrame:
    """Keys the replication produces: from the at most ``C^2`` colour pairs of
    the edges (loops included), without copying the edges."""
    cu = H.color("u", h.a, h.b, C, h.p)
    cv = H.color("v", h.a, h.b, C, h.p)
    pairs = edges.select(F.least(cu, cv).alias("x"), F.greatest(cu, cv).alias("y")).distinct()
    rows = pairs.select("x", "y", F.explode(F.sequence(F.lit(0), F.lit(C - 1))).alias("i"))
    c1, c2, c3 = _sorted3(F.col("x"), F.col("y"), F.col("i").cast("bigint"))
    return rows.select(c1.alias("c1"), c2.alias("c2"), c3.alias("c3")).distinct()


def _triple_query(edges: DataFrame, C: int, h: H.Affine, method: str, wrap: str) -> DataFrame:
    """``wrap`` around the per-key counts: every key of ``{triple_keys}``
    left-joined with its triangles (0 when there is none)."""
    def color(n: str) -> str:
        return H.sql_color(n, h.a, h.b, C, h.p)

    if method == "direct":
        cx, cy = color("x"), color("y")
        lo, hi = f"least(tag, {cx}, {cy})", f"greatest(tag, {cx}, {cy})"
        grouped = f"SELECT {lo} AS c1, tag + {cx} + {cy} - {lo} - {hi} AS c2, {hi} AS c3, sum(c) AS n FROM closed GROUP BY 1, 2, 3"
    elif method == "replicate":
        grouped = "SELECT c1, c2, c3, n FROM per_group"
    else:
        raise ValueError(f"unknown method {method!r}")
    tail = wrap.format(per=f"""
SELECT k.c1, k.c2, k.c3, CAST(coalesce(t.n, 0) AS BIGINT) AS triangles
FROM {{triple_keys}} k
LEFT JOIN ({grouped}) t ON t.c1 = k.c1 AND t.c2 = k.c2 AND t.c3 = k.c3""")
    frames = {"triple_keys": _triple_keys(edges, C, h)}
    if method == "direct":
        return triangles_query(undirected(edges), [], tail, tag=color("s"), **frames)
    return count_by_group(undirected(edges), C, color("{n}"), tail, **frames)


def triangles_per_color_triple(edges: DataFrame, C: int, h: H.Affine,
                               method: str = "direct") -> DataFrame:
    """``(c1, c2, c3, triangles)`` for every key the replication produces.

    A group counts the triangles whose own sorted colours equal its key.  The
    ``direct`` plan finds every triangle once and groups it by its colour
    triple - the same numbers without copying the edges ``C`` times.  The
    ``replicate`` plan keeps the copy: each group counts its own triangles
    behind one exchange of the copies.
    """
    return _triple_query(edges, C, h, method, "{per}")


def exact_triangles_color(edges: DataFrame, C: int, h: H.Affine, method: str = "direct") -> DataFrame:
    """One row ``triangles``: the sum over colour triples - the exact count,
    whatever ``C`` and ``h``."""
    return _triple_query(edges, C, h, method,
                         "SELECT CAST(coalesce(sum(triangles), 0) AS BIGINT) AS triangles FROM ({per})")


# ---- G17 -------------------------------------------------------------------

def triangle_report(edges: DataFrame, C: int, hs: Sequence[H.Affine], method: str,
                    hb: H.EdgeBucket | None = None) -> DataFrame:
    """One row: ``n_edges, colors, runs, method, triangles`` (DOUBLE).

    ``edges`` are raw ordered pairs; they are deduplicated once.  ``method``
    is ``color`` (median of the runs), ``partition`` (one run over ``hb``) or
    ``exact`` (colour triples with the last hash ``hs[-1]``; every hash gives
    the same number).
    """
    ed = distinct_edges(edges)
    # the estimates dedupe after colouring / bucketing themselves
    if method == "color":
        est = approx_triangles_color_median(edges, C, hs)
    elif method == "partition":
        est = approx_triangles_partition(edges, C, hb)
    elif method == "exact":
        est = exact_triangles_color(edges, C, hs[-1])
    else:
        raise ValueError(f"unknown method {method!r}")
    # two scalar subqueries, no join: both inputs are single rows
    return edges.sparkSession.sql(f"""
SELECT (SELECT count(1) FROM {{ed}}) AS n_edges, {int(C)} AS colors, {len(hs)} AS runs,
       '{method}' AS method, (SELECT CAST(triangles AS DOUBLE) FROM {{est}}) AS triangles""",
                                  ed=ed, est=est)


def triangle_report_both(edges: DataFrame, C: int, hs: Sequence[H.Affine], hb: H.EdgeBucket) -> DataFrame:
    """One row: ``n_edges, colors, runs, color_triangles, partition_triangles`` -
    the median colour estimate and the partition estimate of the same edges."""
    return edges.sparkSession.sql(f"""
SELECT (SELECT count(1) FROM {{ed}}) AS n_edges, {int(C)} AS colors, {len(hs)} AS runs,
       (SELECT triangles FROM {{by_color}}) AS color_triangles,
       (SELECT CAST(triangles AS DOUBLE) FROM {{by_part}}) AS partition_triangles""",
                                  ed=distinct_edges(edges),
                                  by_color=approx_triangles_color_median(edges, C, hs),
                                  by_part=approx_triangles_partition(edges, C, hb))
