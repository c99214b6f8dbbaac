import math
import random
from itertools import combinations

import numpy as np
import pytest

from conftest import SF001
from oracle_check import compare, duck
from sparkcount.llm import op10_spherical_dedup as op
from sparkcount.llm import queries as Q
from sparkcount.llm.components import connected_components
from sparkcount.llm.storage import Work

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 3) for i, v, k in rows], SCHEMA)


def brute(rows, threshold):
    def ok(v, k):
        return k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if ok(v, k) else None
            for _, v, k in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] \
                and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
            n[i] += 1
            n[j] += 1
            root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return sorted(((r[0], n[i], best.get(find(i))) for i, r in enumerate(rows)), key=str)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n // 6):
        base = rng.normal(size=16)
        for _ in range(6):
            rows.append((len(rows), (base + rng.normal(size=16) * rng.choice([0, .05, .1, .3])).tolist(), int(c % 3)))
    random.Random(seed).shuffle(rows)
    return rows


ODD = [(900, None, 1), (901, [0.0] * 16, 1), (902, [], 1), (903, [1.0, None], 1), (904, [float("nan")] * 16, 1),
       (905, [float("inf")] * 16, 1), (906, [1.0] * 16, None), (907, [1.0, 0.0], 1), (908, [2.0, 0.0], 1), (908, [2.0, 0.0], 1),
       (None, [1.0, 0.0], 1), (None, [5.0, -1.0, 3.0], 2)]


@pytest.mark.parametrize("cell_size,block", [(1000, 1024), (20, 8)])
def test_links_against_brute_force(spark, cell_size, block):
    rows = vectors(1, 300) + ODD
    got = op.near_duplicates(table(spark, rows), cell_size=cell_size, block=block, margin=0.25).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_with_many_cells(spark):
    rows = vectors(2, 1200)
    got = {r.vec_id: r.n_links for r in op.near_duplicates(table(spark, rows), cell_size=25, block=64).collect()}
    want = {i: n for i, n, _ in brute(rows, 0.93)}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.97 * sum(want.values())


def test_empty_table(spark):
    assert op.near_duplicates(table(spark, [])).count() == 0


def test_query_matches_oracle(spark):
    r = compare(spark, duck(SF001), "op10", Q.QUERIES["op10_spherical_dedup"], Q.ORACLE["op10_spherical_dedup"], SF001)
    assert r["hash_ok"] and r["cols_ok"], r


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(200, 200), (210, 209), (209, 210)]
    got = {r.id: r.root for r in connected_components(
        spark.createDataFrame(edges, "a long, b long"), Work(spark, "test")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{x: 100 for x in range(101, 130)}, 210: 209}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Work(spark, "test")).count() == 0


def test_recall_at_the_threshold_with_many_cells(spark):
    """64 dimensions, one label of 6,000 vectors in about 60 cells, pairs from 0.90 to 1."""
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(2000):
        base = rng.normal(size=64)
        for _ in range(3):
            rows.append((len(rows), (base + rng.normal(size=64) * rng.uniform(.05, .33)).tolist(), 1))
    unit = np.array([np.float32(v) for _, v, _ in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    want = near.sum(1) - 1
    got = {r.vec_id: r.n_links for r in op.near_duplicates(table(spark, rows), cell_size=100).collect()}
    assert all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.98 * want.sum() > 0


def test_centroids_are_bounded_by_bytes(spark):
    rows = vectors(5, 600)
    reps = table(spark, rows).selectExpr("vec_id AS uid", "label", "size(embedding) AS dim", "embedding AS emb")
    cells = op._train(reps, 10, 4096, 4096)
    assert cells and sum(c.nbytes for c in cells.values()) <= 4096
    got = op.near_duplicates(table(spark, rows), cell_size=1 << 40).collect()  # the exact way
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows, 0.93)
