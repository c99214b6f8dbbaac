"""Resampling, heap clusters and the curriculum mix against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from oracle_check import compare, duck
from sparkcount.llm import kernels as K
from sparkcount.llm import op11_resample as R
from sparkcount.llm import op12_heap_clusters as H
from sparkcount.llm import op13_curriculum_mix as M
from sparkcount.llm import queries as Q
from sparkcount.llm.running import running_total
from sparkcount.llm.storage import Work
from sparkcount.sources.tables import table

DOCS = "doc_id long, text string, source string, score long, rank int, row string, before int, part int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, "r", 3, 4) for i, t, s in rows], DOCS)


# ---- op11

def words11(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text, order):
    w = words11(text)
    return [" ".join(w[i:i + m]) for m in range(1, order + 1) for i in range(len(w) - m + 1)]


def brute11(rows, target, order=2, buckets=10000, share=25, min_words=20, seed=7):
    def buckets_of(text):
        return [zlib.crc32(f.encode()) % buckets for f in features(text, order)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets_of(text))
    for text in target:
        t.update(buckets_of(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        b = buckets_of(text)
        gains = [math.floor(1000 * math.log((t[x] + 1) * (big_s + buckets) / ((s[x] + 1) * (big_t + buckets))))
                 for x in b]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(b), weight, score, None, len(words11(text)) >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:share * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 1023, 1024, 1025, 5000])
def test_prefix_crcs_and_shift(n):
    data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    crc = R.prefix_crcs(data)
    assert [int(x) for x in crc] == [zlib.crc32(bytes(data[:i])) for i in range(n + 1)]
    spans = [(a, b) for a in range(0, n + 1, 97) for b in range(a, n + 1, 131)]
    s, e = (np.array([p[i] for p in spans], np.int64) for i in (0, 1))
    got = crc[e] ^ R._shift(crc[s], e - s)
    assert [int(x) for x in got] == [zlib.crc32(bytes(data[a:b])) for a, b in spans]


def test_ngrams_of_odd_texts():
    texts = ["", "  ", "a", "A,b", "x1--Y2 z\n\n", "é ŒUvre 日本 語", "_", "trailing", "next", "a" * 3000 + " b", "\x7f~\x00"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(b) for b in raw])
    row, grams = R.ngram_crcs(np.frombuffer(b"".join(raw), np.uint8), offsets, 3)
    got = [[] for _ in texts]
    for at, crc in grams:
        for i, c in zip(at, crc):
            got[i].append(int(c))
    assert got == [[zlib.crc32(f.encode()) for f in features(t, 3)] for t in texts]
    assert K.row_counts(row, len(texts)).tolist() == [len(words11(t)) for t in texts]


def test_resample_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = ["Ab", "cd", "é1", "zz", "q", "word", "other", "日本"]

    def text():
        return " ".join(rng.choice(vocab) + rng.choice(["", ",", "\n"]) for _ in range(rng.randrange(60)))

    rows = [(i, text()) for i in range(60)] + [(7, None), (None, text() + " w" * 30), (None, text()), (61, ""), (62, "x " * 40000)]
    rows += [(100, "cd cd " * 20)] * 9
    target = [text() for _ in range(4)] + [None, ""]
    want = brute11(rows, target)
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, item_id int")
    got = R.resample(docs(spark, [(i, t, "s") for i, t in rows]).repartition(5), bench)
    assert rows_of(got) == want
    none = R.resample(docs(spark, [(i, t, "s") for i, t in rows]), bench.limit(0))
    assert rows_of(none) == brute11(rows, [])


def test_resample_of_nothing(spark):
    bench = spark.createDataFrame([("a b",)], "text string")
    assert R.resample(docs(spark, []), bench).collect() == []
    got = R.resample(docs(spark, [(1, None, "s"), (2, "", "s")]), bench).collect()
    assert [(r.doc_id, r.n_features, r.weight, r["rank"]) for r in got] == [(1, 0, 0, None), (2, 0, 0, None)]


def test_resample_query_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    target = [r.text for r in table(spark, SF001, "benchmark").collect()]
    assert rows_of(Q.op11_resample(spark, SF001)) == brute11(rows, target)


def test_running_total_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.randrange(10), i) for i in range(500)] + [(2, 1, 1000 + i) for i in range(500)]
    work = Work(spark, "test")
    df = work.cut(spark.createDataFrame(rows, "g long, n long, id long"))
    got = running_total(df, [df["g"], df["id"]], "n", work)
    total, want = 0, []
    for g, n, i in sorted(rows, key=lambda r: (r[0], r[2])):
        want.append((g, n, i, total))
        total += n
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[2])) == want


# ---- op12

VECS = "vec_id long, embedding array<float>, id int, v string, cluster string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECS)


def brute12(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    name = {id(r): hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in kept}
    cents = [r[1] for r in sorted(kept, key=lambda r: (name[id(r)], r[1]))[:k]]

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    inertia = Counter()
    for d, c in at:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, at)), key=repr)


@pytest.mark.parametrize("k,rounds,spread", [(1, 2, 1.0), (4, 5, 0.05), (6, 3, 3.0), (40, 4, 1.0)])
def test_heap_clusters_equal_lloyd(spark, k, rounds, spread):
    rng = random.Random(k)
    mid = [[rng.uniform(-2, 2) for _ in range(5)] for _ in range(4)]
    rows = [(i, [m + rng.gauss(0, spread) for m in rng.choice(mid)]) for i in range(150)]
    rows += [(200, [0.5] * 5)] * 20 + [(None, [0.25] * 5), (None, [-0.25] * 5), (300, None), (301, []), (302, [1.0] * 4),
                                        (303, [1.0, None, 1.0, 1.0, 1.0]), (304, [float("nan")] * 5), (305, [float("inf")] * 5)]
    got = H.heap_clusters(vectors(spark, rows).repartition(3), k, rounds, 5, 8, 3)
    assert rows_of(got) == brute12(rows, k, rounds, 5, 8, 3)


def test_heap_clusters_rescan_only_expired(spark):
    rng = random.Random(3)
    mid = [[10.0 * (j == i) for j in range(8)] for i in range(8)]
    rows = [(i, [m + rng.gauss(0, 0.2) for m in mid[i % 8]]) for i in range(400)]
    work = Work(spark, "test")
    kept = H.integer_vectors(vectors(spark, rows), 8, 64, "vec_id", "embedding")
    state = H.HeapClusters(kept, 8, H.seeds(kept, 8, 1), work)
    state.assign()
    for _ in range(6):
        state.update()
        state.assign()
    sizes = [run.count() for run in state.runs]
    assert sizes[0] == 400 and sizes[-1] < 40, sizes
    assert state.distances().count() == 400
    got = [(r.id, r.cluster) for r in state.distances().collect()]
    x = {r.id: np.array(r.v) for r in kept.collect()}
    assert all(int(((state.centroids - x[i]) ** 2).sum(1).argmin()) == c for i, c in got)


def test_heap_clusters_of_few_and_huge(spark):
    assert H.heap_clusters(vectors(spark, []), dim=2).collect() == []
    assert H.heap_clusters(vectors(spark, [(1, None)]), dim=2).collect() == []
    got = H.heap_clusters(vectors(spark, [(1, [1e30, 0.0]), (2, [-3.0, 0.0]), (3, [1e30, 0.0])]), k=16, dim=2, scale=1).collect()
    by = {r.vec_id: r for r in got}
    assert len(got) == 3 and by[1].distance == by[2].distance == by[3].distance == 0
    # the two equal vectors tie between two equal centroids: the smaller number
    assert by[1].cluster == by[3].cluster


def test_heap_clusters_query_equals_sql(spark):
    r = compare(spark, duck(SF001), "op12", Q.op12_heap_clusters, Q.ORACLE["op12_heap_clusters"], SF001)
    assert r["rows_ok"] and r["cols_ok"] and r["hash_ok"], r


# ---- op13

FLAT = [[(0.0, 5.0), (1.0, 5.0)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 1.0), (1.0, 1.0)]]
BENT = [[(0.0, 6.0), (0.5, 2.0), (1.0, 6.0)], [(0.0, 0.0), (0.25, 2.0), (1.0, 2.0)], [(0.0, 1.0), (1.0, 0.0)]]


def brute_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        whole = sum(w[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and w[s] * left / whole > most * sizes[s]}
        if not new:
            return {s: float(most * sizes[s]) if s in capped else w[s] * left / whole for s in order}
        capped |= new


def corpus(seed, n):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(int(rng.paretovariate(0.8)) % 400)),
             rng.choice(["b", "a", "é", "Z", None, "tiny"]) if i % 3 else "hot") for i in range(n)]
    rows = [(i, t if s != "tiny" else "one two", s) for i, t, s in rows]
    return rows + [(n, None, "a"), (n + 1, "", "empty"), (n + 2, " \t\n", "empty"), (None, "x y", "b"), (None, "x y", "b")] + [(5, "k " * 50, "hot")] * 7


@pytest.mark.parametrize("schedules", [FLAT, BENT])
def test_mix_meets_its_targets(spark, schedules):
    rows = corpus(2, 300)
    df = M.mix(docs(spark, rows).repartition(4), schedules)
    got = df.withColumn("taken", M.taken(df)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    weights = [M.cumulative(k)[-1] for k in schedules]
    want = brute_targets(sizes, weights, 3)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], abs=1e-6)
        assert sum(c.words for c in r.copies) == r.taken and all(0 < c.words <= r.size for c in r.copies)
    assert taken == {s: math.floor(want[s] + 1e-9) for s in sizes}
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    # every source's copies are its words in one run, without a gap
    for s in sizes:
        ends = sorted((c.start, c.start + c.words) for r in got if r.source == s for c in r.copies)
        assert all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and (not ends or ends[0][0] == 0)


def test_mix_positions_invert_the_demand(spark):
    """A copy's position is the words all sources demand up to its time, by fine numeric integration."""
    rows = corpus(4, 200)
    df = M.mix(docs(spark, rows), BENT)
    got = df.collect()
    order = sorted({r.source for r in got}, key=lambda s: (s is None, s or ""))
    target = {r.source: r.target for r in got}
    grid = np.linspace(0, 1, 200001)
    demand = {}
    for i, s in enumerate(order):
        w = np.interp(grid, *zip(*BENT[i % 3]))
        run = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        demand[s] = run / run[-1] * target[s]
    whole = sum(demand.values())
    for r in got:
        for c in r.copies:
            at = np.searchsorted(demand[r.source], c.start + 1e-9)
            assert whole[max(at - 2, 0)] - 1 <= c.position <= whole[min(at + 2, len(grid) - 1)] + 1
    ordered = M.training_order(df, "doc_id").collect()
    assert [c.position for c in ordered] == sorted(c.position for c in ordered)
    assert len(ordered) == sum(len(r.copies) for r in got)


def test_mix_reruns_agree_and_empty_tables(spark):
    rows = corpus(6, 120)
    a = M.mix(docs(spark, rows).repartition(7), FLAT).drop("copies")
    b = M.mix(docs(spark, rows[::-1]).repartition(2), FLAT).drop("copies")
    assert rows_of(a) == rows_of(b)
    assert M.mix(docs(spark, []), FLAT).collect() == []
    none = M.mix(docs(spark, [(1, None, None), (2, "", "a")]), FLAT).collect()
    assert [(r.doc_id, r.size, r.target, r.copies) for r in sorted(none)] == [(1, 0, 0.0, []), (2, 0, 0.0, [])]


def test_mix_query_equals_sql(spark):
    r = compare(spark, duck(SF001), "op13", Q.op13_curriculum_mix, Q.ORACLE["op13_curriculum_mix"], SF001)
    assert r["rows_ok"] and r["cols_ok"] and r["hash_ok"], r
