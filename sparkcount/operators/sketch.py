"""Signed count sketch of ``D`` rows by ``W`` columns.

``c[j][h_j(x)] += g_j(x) * n`` with ``h_j(x) = ((a_j x + b_j) mod p) mod W``
and ``g_j(x) = 2 (((a'_j x + b'_j) mod p) mod 2) - 1``.  The sketch is the
table ``(j, k, c)``; a cell no item reached has no row and counts 0.

Spark's built-in ``count_min_sketch`` is unsigned and brings its own hashes,
so the sketch is written as the aggregate it is: each item (or item
frequency) is copied once per row ``j`` inside its stage, then
``groupBy(j, k).sum``.  The result has at most ``D * W`` rows whatever the
data size, which is what makes handing it to every task in ``sketch_estimates`` safe.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.functions import hashing as H
from sparkcount.functions.frames import replicate


@dataclass(frozen=True)
class SketchParams:
    D: int
    W: int
    rows: tuple  # D tuples (a, b, a2, b2)
    p: int = H.P

    @staticmethod
    def draw(D: int, W: int, seed: int, p: int = H.P) -> "SketchParams":
        rng = random.Random(seed)
        rows = tuple((rng.randint(1, p - 1), rng.randint(0, p - 1),
                      rng.randint(1, p - 1), rng.randint(0, p - 1)) for _ in range(D))
        return SketchParams(D, W, rows, p)

    def as_dicts(self) -> list[dict]:
        return [{"j": j, "a": a, "b": b, "a2": a2, "b2": b2}
                for j, (a, b, a2, b2) in enumerate(self.rows)]

    def sql_cell(self, j: int, item: str) -> tuple[str, str]:
        """SQL of the column and the sign of ``item`` in row ``j``."""
        a, b, a2, b2 = self.rows[j]
        return H.sql_color(item, a, b, self.W, self.p), H.sql_sign(item, a2, b2, self.p)


@dataclass(frozen=True)
class PolySketchParams:
    """Sketch parameters from a 4-wise independent family: column and sign of an
    item are polynomials of degree 3 modulo a large prime.  The estimate of the
    second moment needs four-wise independent signs for its error bound; the
    affine family is pairwise independent only."""

    D: int
    W: int
    rows: tuple  # D pairs of coefficient tuples, highest first: column, sign
    p: int = H.P_POLY

    @staticmethod
    def draw(D: int, W: int, seed: int, p: int = H.P_POLY) -> "PolySketchParams":
        rng = random.Random(seed)
        return PolySketchParams(D, W, tuple((H.draw_poly(rng, 3, p), H.draw_poly(rng, 3, p)) for _ in range(D)), p)

    def as_dicts(self) -> list[dict]:
        return [{"j": j, **{f"h{i}": c for i, c in enumerate(h)}, **{f"g{i}": c for i, c in enumerate(g)}}
                for j, (h, g) in enumerate(self.rows)]

    def sql_cell(self, j: int, item: str) -> tuple[str, str]:
        """SQL of the column and the sign of ``item`` in row ``j``."""
        h, g = self.rows[j]
        x = f"({H.sql_pmod(item, self.p)})"
        return f"({H.sql_poly(x, h, self.p)}) % {self.W}", f"(({H.sql_poly(x, g, self.p)}) % 2) * 2 - 1"


def _cells(df: DataFrame, prm: SketchParams | PolySketchParams, keep: list[str]) -> DataFrame:
    """``(keep..., j, k, g)``: the cell and sign of every row in each sketch row."""
    if isinstance(prm, PolySketchParams):
        r = df.select(*keep, F.expr(H.sql_pmod("item", prm.p)).alias("x"), replicate(prm.as_dicts()).alias("prm"))
        column = H.sql_poly("x", [f"prm.h{i}" for i in range(4)], prm.p)
        sign = H.sql_poly("x", [f"prm.g{i}" for i in range(4)], prm.p)
        return r.select(*keep, F.col("prm.j").alias("j"), F.expr(f"({column}) % {prm.W}").alias("k"),
                        F.expr(f"(({sign}) % 2) * 2 - 1").alias("g"))
    r = df.select(*keep, replicate(prm.as_dicts()).alias("prm"))
    return r.select(
        *keep,
        F.col("prm.j").alias("j"),
        H.color("item", "prm.a", "prm.b", prm.W, prm.p).alias("k"),
        H.sign("item", "prm.a2", "prm.b2", prm.p).alias("g"),
    )


def count_sketch(df: DataFrame, prm: SketchParams | PolySketchParams, weight: str | None = None) -> DataFrame:
    """``(j, k, c)``.  ``df`` holds ``item`` and, if ``weight`` is given, the
    number of occurrences in that column (e.g. ``freq`` of a frequency table,
    which makes the copy ``D`` x distinct items instead of ``D`` x items).
    Without ``weight`` every row counts once, which also runs as a single
    streaming aggregation."""
    keep = ["item"] + ([weight] if weight else [])
    cells = _cells(df, prm, keep)
    amount = F.col("g") * (F.col(weight) if weight else F.lit(1))
    return cells.groupBy("j", "k").agg(F.sum(amount).cast("bigint").alias("c"))


def dense_cells(sketch: DataFrame, D: int, W: int) -> DataFrame:
    """One row ``cells``: ``c[j][k]`` at position ``j * W + k``, absent cells 0
    (``D * W`` numbers: a bound fixed by the parameters)."""
    return sketch.agg(F.expr(
        f"transform(sequence(0, {D * W - 1}), i -> coalesce(try_element_at("
        f"map_from_entries(collect_list(struct(CAST(j * {W} + k AS INT) AS i, c))), i), 0L)) AS cells"))


def sql_row_median(cells: str, item: str, prm: SketchParams | PolySketchParams) -> str:
    """SQL: median over rows ``j`` of ``c[j][h_j(item)] * g_j(item)`` (DOUBLE)."""
    e = ", ".join(
        f"{cells}[CAST({j * prm.W} + ({k}) AS INT)] * ({g})"
        for j, (k, g) in enumerate(prm.sql_cell(j, item) for j in range(prm.D)))
    lo, hi = (prm.D - 1) // 2, prm.D // 2
    s = f"array_sort(array({e}))"
    if lo == hi:
        return f"CAST({s}[{lo}] AS DOUBLE)"
    return f"(({s}[{lo}] + {s}[{hi}]) / 2.0D)"


def sketch_estimates(freq: DataFrame, sketch: DataFrame, prm: SketchParams | PolySketchParams,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``(item, keep..., est)``: per item of ``freq``, the median over rows ``j``
    of ``c[j][h_j(item)] * g_j(item)`` (DOUBLE).

    The sketch reaches the rows as one array of ``D * W`` numbers (a scalar
    subquery) and each row computes its own median: no join, no shuffle."""
    cols = ", ".join(["item", *keep])
    return freq.sparkSession.sql(
        f"SELECT {cols}, {sql_row_median('cells', 'item', prm)} AS est FROM "
        f"(SELECT {cols}, (SELECT cells FROM {{dense}}) AS cells FROM {{freq}})",
        freq=freq, dense=dense_cells(sketch, prm.D, prm.W))


def row_squares(sketch: DataFrame) -> DataFrame:
    """``(j, s)``: ``sum_k c[j][k]^2`` per sketch row, exact (DECIMAL(38,0))."""
    return sketch.groupBy("j").agg(
        F.sum(F.col("c").cast("decimal(38,0)") * F.col("c").cast("decimal(38,0)")).alias("s"))


# ---- sketches as values: dense arrays that are added and subtracted ----------

def batch_sketches(items: DataFrame, prm: SketchParams | PolySketchParams) -> DataFrame:
    """``(batch_id, cells)``: the dense sketch of every batch, ``c[j][k]`` at
    ``j * W + k``.  Linear, so a period's sketch is the sum of its batches' and an
    interval's is the difference of two periods'."""
    freq = items.groupBy("batch_id", "item").agg(F.count(F.lit(1)).alias("n"))
    cells = _cells(freq, prm, ["batch_id", "item", "n"]).groupBy("batch_id", "j", "k").agg(
        F.sum(F.col("g") * F.col("n")).cast("bigint").alias("c"))
    return cells.groupBy("batch_id").agg(F.expr(
        f"transform(sequence(0, {prm.D * prm.W - 1}), i -> coalesce(try_element_at(map_from_entries(collect_list("
        f"struct(CAST(j * {prm.W} + k AS INT) AS i, c))), i), 0L))").alias("cells"))


def add_sketches(sketches: DataFrame, size: int) -> DataFrame:
    """One row ``cells``: the sum of any number of dense sketches of ``size`` cells
    (all 0 when there is none).  Summed cell by cell with partial aggregation, so
    a task sends ``size`` rows however many sketches it holds."""
    sums = sketches.select(F.posexplode("cells").alias("at", "c")).groupBy("at").agg(F.sum("c").cast("bigint").alias("c"))
    return sums.agg(F.expr(
        f"transform(sequence(0, {size - 1}), i -> coalesce(try_element_at("
        "map_from_entries(collect_list(struct(at, c))), i), 0L))").alias("cells"))


def subtract_sketches(whole: DataFrame, part: DataFrame) -> DataFrame:
    """One row ``cells``: one-row sketch ``whole`` less one-row sketch ``part``."""
    return whole.sparkSession.sql(
        "SELECT zip_with(cells, less, (x, y) -> x - y) AS cells FROM "
        "(SELECT cells, (SELECT cells FROM {part}) AS less FROM {whole})",
        whole=whole, part=part)


def sketch_rows(dense: DataFrame, W: int) -> DataFrame:
    """``(j, k, c)`` of a one-row dense sketch, cells of 0 left out."""
    return dense.select(F.posexplode("cells").alias("i", "c")).where("c <> 0").select(
        F.expr(f"CAST(i div {W} AS INT)").alias("j"), F.expr(f"CAST(i % {W} AS BIGINT)").alias("k"), "c")
