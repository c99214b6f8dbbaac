"""Embedding near-dedup: spherical k-means cells, blocked cosine products.

Vectors are compared only within their label.  Identical vectors are folded
first (one representative with its count), so a vector that a third of all rows
repeat is one row.  Labels with more than ``cell_size`` representatives get
spherical k-means cells, trained on a bounded sample; every representative is
indexed, in each cell whose centroid is within ``margin`` of its best cosine,
so near neighbours beside a cell border still meet.  A cell's members are dealt
into blocks, pairs of blocks are the tasks, and a pair of vectors that share
several cells counts in the lowest of them only.  A block pair returns, per
vector, its number of links and the smallest vector it hangs together with;
pairs of vectors never leave the task.

Bounds: centroids of at most ``max_bytes`` in all, the only thing every task
gets, hence at most that many labels with cells are known to the driver; training
reads about ``16`` vectors per centroid, and no product of vectors held at once
passes ``STRIP`` rows.  A link is a cosine of double precision at or above the
threshold.

Exact or not: a label of fewer than ``2 * cell_size`` different vectors is
compared whole.  In larger ones a link can be missed whose two vectors share no
cell within ``margin``; ``cell_size`` above the largest label makes every label
exact, by blocks of all its vectors, at quadratic cost.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, or has a null label, links with nothing and is its own component;
vectors of one label but different length are not compared; rows repeated with
the same content link with each other; null ids get a null component; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.llm.components import connected_components
from sparkcount.llm.storage import Work

THRESHOLD = 0.93
CELL_SIZE = 1000
BLOCK = 4096
MARGIN = 0.08
MAX_BYTES = 32 << 20
MAX_CELLS = 4096
STRIP = 1024
ROUNDS = 6


def _key(reps: DataFrame) -> str:
    return f"label {reps.schema['label'].dataType.simpleString()}, dim int"


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from evenly spread seeds; an empty cell keeps its centroid."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[i:i + STRIP] @ c.T, axis=1) for i in range(0, len(x), STRIP)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def _train(reps: DataFrame, cell_size: int, max_bytes: int, max_cells: int) -> dict:
    """``(label, dim) -> centroids`` for the labels large enough to have cells."""
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("n")).where(
        F.col("n") >= 2 * cell_size)
    numbers = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("dim")), F.lit(0)).alias("n")).first()["n"]
    share = min(1 / cell_size, max_bytes / 8 / max(numbers, 1))
    cells = {(r["label"], r["dim"]): int(min(max_cells, r["n"] * share))
             for r in sizes.where(F.col("n") * share >= 2).collect()}
    if not cells:
        return {}
    spark = reps.sparkSession
    wanted = spark.createDataFrame([(a, b, k) for (a, b), k in cells.items()],
                                   f"{_key(reps)}, k int")
    seen = sizes.select("label", "dim", "n").join(F.broadcast(wanted), ["label", "dim"])
    draw = F.pmod(F.xxhash64("uid"), F.lit(1 << 20)) < F.col("k") * F.lit(16.0) / F.col("n") * (1 << 20)
    sample = reps.join(F.broadcast(seen), ["label", "dim"]).where(draw).select(
        "label", "dim", "k", "uid", "emb")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        x = _unit(np.stack(pdf["emb"].to_numpy()).astype(np.float64))
        c = _kmeans(x, int(pdf["k"].iloc[0]))
        return pd.DataFrame({"label": pdf["label"].iloc[:1], "dim": pdf["dim"].iloc[:1],
                             "c": [c.astype(np.float64).tobytes()]})

    rows = sample.groupBy("label", "dim").applyInPandas(fit, f"{_key(reps)}, c binary").collect()
    return {(r["label"], r["dim"]): np.frombuffer(r["c"]).reshape(-1, r["dim"]) for r in rows}


def _assigned(reps: DataFrame, centroids: dict, margin: float) -> DataFrame:
    """A row per representative and cell: ``label, dim, cell, uid, w, unit, cells``."""

    def assign(batches):
        for batch in batches:
            label = batch.column("label").to_pylist()
            dim = batch.column("dim").to_numpy()
            keys = list(zip(label, dim.tolist()))
            emb = batch.column("emb")
            flat = emb.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            first = np.concatenate([[0], np.cumsum(dim)])
            rows, cell, units, lists = [], [], [], []
            groups: dict = {}
            for i, k in enumerate(keys):
                groups.setdefault(k, []).append(i)
            for k, at in groups.items():
                x = _unit(np.stack([flat[first[i]:first[i + 1]] for i in at]))
                if k not in centroids:
                    near = [np.zeros(1, np.int32)] * len(at)
                else:
                    near = []
                    for a in range(0, len(x), STRIP):
                        s = x[a:a + STRIP] @ centroids[k].T
                        near += list(map(np.flatnonzero, s >= s.max(axis=1, keepdims=True) - margin))
                for n, i in enumerate(at):
                    own = near[n].astype(np.int32)
                    raw = x[n].tobytes()
                    for c in own.tolist():
                        rows.append(i)
                        cell.append(c)
                        units.append(raw)
                        lists.append(own)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "label": batch.column("label").take(take), "dim": batch.column("dim").take(take),
                "cell": pa.array(cell, pa.int32()), "uid": batch.column("uid").take(take),
                "w": batch.column("w").take(take), "unit": pa.array(units, pa.binary()),
                "cells": pa.array(lists, pa.list_(pa.int32()))})

    return reps.select("label", "dim", "uid", "w", "emb").mapInArrow(
        assign, f"{_key(reps)}, cell int, uid long, w long, unit binary, cells array<int>")


def _block_links(threshold: float):
    """One pair of blocks: per linked vector its links and its smallest companion."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        cell, i, j = int(pdf["cell"].iloc[0]), int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        pdf = pdf.sort_values("uid", kind="stable")
        dim = int(pdf["dim"].iloc[0])
        x = np.frombuffer(b"".join(pdf["unit"]), np.float64).reshape(-1, dim)
        block = pdf["block"].to_numpy()
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        width = max(map(len, pdf["cells"]))
        own = np.full((len(pdf), width), -1, np.int64)
        for r, c in enumerate(pdf["cells"]):
            own[r, :len(c)] = c
        left, right = [], []
        for lo in range(0, len(a), 256):  # a strip of the product at a time
            part = a[lo:lo + 256]
            p, q = np.nonzero(x[part] @ x[b].T >= threshold)
            p, q = part[p], b[q]
            if i == j:
                p, q = p[p < q], q[p < q]
            # counted in the lowest cell that both have
            earlier = np.zeros(len(p), bool)
            for m in range(width):
                mine = own[p, m]
                earlier |= ((mine >= 0) & (mine < cell)) & (own[q] == mine[:, None]).any(axis=1)
            left.append(p[~earlier])
            right.append(q[~earlier])
        p, q = np.concatenate(left), np.concatenate(right)
        w = pdf["w"].to_numpy()
        n = np.bincount(p, weights=w[q], minlength=len(pdf)) + np.bincount(q, weights=w[p], minlength=len(pdf))
        root = np.arange(len(pdf))
        while True:
            m = np.minimum(root[p], root[q])
            before = root.copy()
            np.minimum.at(root, p, m)
            np.minimum.at(root, q, m)
            root = root[root]
            if (root == before).all():
                break
        at = np.flatnonzero(n > 0)
        uid = pdf["uid"].to_numpy()
        return pd.DataFrame({"uid": uid[at], "root": uid[root[at]], "n": n[at].astype(np.int64)})

    return links


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label",
                    cell_size: int = CELL_SIZE, block: int = BLOCK, margin: float = MARGIN,
                    max_bytes: int = MAX_BYTES, max_cells: int = MAX_CELLS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    work = Work(vectors.sparkSession, "spherical")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("emb"))
    fine = (F.col("label").isNotNull() & F.col("emb").isNotNull() & (F.size("emb") > 0)
            & F.forall("emb", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
            & F.exists("emb", lambda v: v != 0))
    marked = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    valid = marked.where("fine").select("vec_id", "label", "emb")
    # identical vectors fold before anything is compared
    reps = work.cut(valid.groupBy("label", "emb").agg(
        F.count("*").alias("w"), F.min("vec_id").alias("least_id")).select(
        F.monotonically_increasing_id().alias("uid"), "label", F.size("emb").alias("dim"),
        "emb", "w", "least_id"), "reps")
    cells = work.cut(_assigned(reps, _train(reps, cell_size, max_bytes, max_cells), margin), "cells")
    key = ["label", "dim", "cell"]
    blocks = cells.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(
        *key, F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    dealt = cells.join(blocks, key).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    # each block meets every block of its cell once: the pair (i, j), i <= j
    pairs = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
        "*", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    found = work.cut(pairs.groupBy(*key, "i", "j").applyInPandas(
        _block_links(threshold), "uid long, root long, n long"), "links")
    degree = found.groupBy("uid").agg(F.sum("n").alias("n"))
    comp = connected_components(found.select(F.col("root").alias("a"), F.col("uid").alias("b")), work)
    named = work.cut(reps.select("uid", "least_id", "w").join(
        comp.withColumnRenamed("id", "uid"), "uid", "left").join(degree, "uid", "left").select(
        "uid", F.coalesce("root", "uid").alias("root"), "least_id",
        (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links")), "named")
    lowest = work.cut(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "lowest")
    final = work.cut(named.join(lowest, "root").join(reps.select("uid", "label", "emb"), "uid").select(
        "label", "emb", "n_links", "component_id"), "final")
    good = valid.join(final, ["label", "emb"]).select("vec_id", "n_links", "component_id")
    bad = marked.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
