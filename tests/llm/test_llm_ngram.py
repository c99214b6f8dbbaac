import random
import re
from itertools import combinations

import numpy as np
import pytest

from sparkcount.llm import op03_ngram_join as op

SCHEMA = "doc_id long, text string, node long, n string, block int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 5, "n", 1) for i, t in rows], SCHEMA)


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows, k=5, num=80, den=100):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and den * len(a & b) >= num * len(a | b):
            root[find(i)] = find(j)
            if a != b:
                pairs.add(frozenset([a, b]))
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, len(s), best.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str), pairs


def corpus(seed, n=140):
    """Near copies of a few texts at all distances around the threshold,
    a passage that many share, short texts and the odd cases."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    shared = " ".join(word() for _ in range(12))
    rows = []
    for base in range(8):
        text = [word() for _ in range(rng.choice([6, 12, 40, 90]))]
        for _ in range(n // 8):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), rng.choice([" ", "\n", "  \t"]).join(copy) + (" " + shared if base % 2 else "")))
    rows += [(900, None), (901, ""), (902, " \n "), (903, "One two"), (904, "one TWO"), (905, "one two three"),
             (903, "one two"), (None, rows[0][1]), (None, "nobody else says this at all"), (906, "É é"), (907, "é é")]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 7)])
def test_classes_against_brute_force(spark, seed, block):
    rows = corpus(seed)
    got = op.classes(docs(spark, rows), block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)[0]


def test_every_link_once(spark):
    rows = [r for r in corpus(3, 64) if r[0] is not None]
    members, links, _ = op.jaccard_join(docs(spark, rows), block=9, every=True)
    name = {r.node: shingles(dict(rows)[r.doc_id], 5) for r in members.collect() if r.n_shingles}
    got = [(name[r.a], name[r.b], r.c) for r in links.collect()]
    assert all(len(a & b) == c for a, b, c in got)
    assert sorted(map(sorted, ((map(sorted, (a, b))) for a, b, _ in got))) == sorted(
        map(sorted, (map(sorted, p) for p in brute(rows)[1])))


def test_empty_table(spark):
    assert op.classes(docs(spark, [])).count() == 0


def test_representatives(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (3, text + " x"), (9, "other words entirely here now"), (10, None), (11, ""), (9, "other words entirely here now")]
    out = op.representatives(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "node", "n", "block"]
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.text) == [(3, text + " x"), (9, "other words entirely here now")]
    assert sorted(r.doc_id for r in out.collect() if not r.text) == [10, 11]


def test_tree_walk_finds_all_linked_sets():
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64) * np.uint64(2)
        for _ in range(12):
            keep = rng.random(len(base)) < rng.choice([.85, .95, 1.0])
            extra = rng.integers(0, 1 << 63, rng.integers(0, 1 + len(base) // 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            s = np.unique(np.concatenate([base[keep], extra]))
            if len(s):
                sets.append(s)
    members = [(i, len(s), int(s[0]), int.from_bytes(op.signature(s), "little")) for i, s in enumerate(sets)]
    plain = [frozenset(s.tolist()) for s in sets]
    want = {(i, j) for i, j in combinations(range(len(sets)), 2)
            if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])}
    tested = []

    def linked(i, j):
        tested.append((min(i, j), max(i, j)))
        return tested[-1] in want

    root = op.tree(members)
    op.walk(root, root, 80, 100, op.Joined(len(sets)), linked, every=True)
    assert want <= set(tested) and len(tested) == len(set(tested))
    assert len(tested) < 4 * len(want) + len(sets)  # most of the other pairs are pruned
    half = len(members) // 2
    tested.clear()
    op.walk(op.tree(members[:half]), op.tree(members[half:]), 80, 100, op.Joined(len(sets)), linked, every=True)
    assert {p for p in want if p[0] < half <= p[1]} <= set(tested)
    joined = op.Joined(len(sets))
    op.walk(root, root, 80, 100, joined, linked)
    full = op.Joined(len(sets))
    for i, j in want:
        full.join(i, j)
    assert [joined.find(i) for i in range(len(sets))] == [full.find(i) for i in range(len(sets))]


def near_copies(n=120, change=2, tag="w"):
    """Two different texts whose Jaccard is above the threshold."""
    words = [f"{tag}{i}" for i in range(n)]
    return " ".join(words), " ".join(words[:-change] + [f"{tag}x{i}" for i in range(change)])


def test_near_copies_with_null_ids_link(spark):
    a, b = near_copies()
    c, d = near_copies(tag="v")
    rows = [(None, a), (7, b), (None, c), (None, d), (None, d), (9, "some other text of a few words only")]
    got = op.classes(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)[0]
    assert len({r.root for r in got}) == 3
    assert op.representatives(docs(spark, rows)).count() == 3


def test_an_id_with_two_texts_compares_each_text(spark):
    rng = random.Random(6)
    for overlap in (0.7, 0.5):  # both below the threshold, near enough for the bitmaps
        words = [f"s{i}" for i in range(2000)]
        keep = int(len(words) * 2 * overlap / (1 + overlap))
        rows = [(1, " ".join(words)), (1, " ".join(words[:keep] + [f"t{i}" for i in range(2000 - keep)]))]
        rows += [(2, near_copies(tag="z")[0]), (2, near_copies(tag="z")[1]), (2, near_copies(tag="z")[1]), (3, rows[0][1])]
        rng.shuffle(rows)
        members, links, _ = op.jaccard_join(docs(spark, rows), every=True)
        node = {shingles(t, 5) for _, t in rows}
        assert members.select("node").distinct().count() == len(node) == 4
        got = links.collect()
        assert len(got) == len({frozenset((r.a, r.b)) for r in got}) == len(brute(rows)[1]) == 1
        # one id, so the classes show it by their roots
        assert len({r.root for r in op.classes(docs(spark, rows)).collect()}) == 3
        assert op.representatives(docs(spark, rows)).count() == 3


@pytest.mark.parametrize("k", [1, 2, 5])
def test_slices_of_few_words(k):
    for n in range(7):
        words = [f"w{i}" for i in range(n)]
        for texts in ([" ".join(words)], words, ["", " ".join(words), " "]):
            raw = [t.encode() for t in texts]
            h, row = op.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw]), k)
            assert np.bincount(row, minlength=len(texts)).tolist() == [len(shingles(t, k)) for t in texts]


def test_one_row_to_a_partition(spark):
    rows = [(i, " ".join(["x", "y", "z", "u", "v", "w"][:i % 7])) for i in range(21)]
    got = op.classes(docs(spark, rows).repartition(30)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)[0]
    assert op.representatives(docs(spark, rows[1:4]).repartition(3)).count() == 3


def test_clashing_columns_and_repeated_rows(spark):
    a, b = near_copies()
    schema = "doc_id long, text string, rows long, copies int, __id long, __node long, __n int, kept_id long, `a.b` int"
    rows = [(i, t, 1, 2, 3, 4, 5, 6, 7) for i, t in ((4, a), (4, a), (9, b), (5, "other words that stand alone here"), (6, None))]
    out = op.representatives(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "rows", "copies", "__id", "__node", "__n", "kept_id", "a.b"]
    assert sorted(r.doc_id for r in out.collect()) == [4, 5, 6]


def test_very_long_and_very_common_texts(spark):
    """One text of 3 MB and its near copy, and a group of near copies that all share
    most of their shingles, in blocks smaller than the group."""
    rng = random.Random(8)
    long = [f"l{rng.randrange(10 ** 6)}" for _ in range(400_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-5000] + ["z"] * 5000))]
    base = [f"c{i}" for i in range(60)]
    for i in range(120):
        copy = list(base)
        copy[rng.randrange(60)] = f"x{i}"
        rows.append((100 + i, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in op.classes(docs(spark, rows).repartition(4), block=16).collect()}
    assert got[2] == 1
    want = {i: c for i, _, c in brute(rows[2:])[0]}
    assert {i: got[i] for i in want} == want


def test_place_and_size_filter_keeps_every_linked_pair():
    """Of the groups by common prefix shingle, the filter leaves each linked pair at
    least the group of the first shingle that both share."""
    rng = np.random.default_rng(4)
    num, den = 80, 100
    for _ in range(30):
        base = rng.choice(4000, rng.integers(1, 120), replace=False)
        sets = []
        for _ in range(rng.integers(2, 60)):
            keep = rng.random(len(base)) < rng.choice([.8, .95, 1.0])
            extra = rng.choice(4000, rng.integers(0, 1 + len(base) // 5), replace=False)
            s = sorted(set(base[keep].tolist()) | set(extra.tolist()))
            if s:
                sets.append(s)
        post = {}
        for i, s in enumerate(sets):
            for place in range(len(s) - -(-num * len(s) // den) + 1):
                post.setdefault(s[place], []).append((i, len(s), len(s) - place))
        together = set()
        for rows in post.values():
            rows.sort(key=lambda r: r[1])
            node, n, left = (np.array([r[c] for r in rows], np.int64) for c in range(3))
            alive = op._matched(np.zeros(len(rows), np.int64), n, left, num, den)
            together |= {frozenset(p) for p in combinations(node[alive].tolist(), 2)}
        for i, j in combinations(range(len(sets)), 2):
            a, b = set(sets[i]), set(sets[j])
            if a != b and den * len(a & b) >= num * len(a | b):
                assert frozenset((i, j)) in together


def test_names_that_clash_get_another_salt(spark, monkeypatch):
    plain = op.set_names
    monkeypatch.setattr(op, "ship", None, raising=False)
    seen = []

    def sets(rows, k, salt):
        seen.append(salt)
        if salt:
            return real(rows, k, salt)
        return real(rows, k, salt).withColumn("node", op.F.when(op.F.col("n") > 0, op.F.lit(1)).otherwise(op.F.col("node")))

    real = op._sets
    monkeypatch.setattr(op, "_sets", sets)
    rows = corpus(5, 40)
    got = op.classes(docs(spark, rows)).collect()
    assert seen == [0, 1] and plain is op.set_names
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)[0]
