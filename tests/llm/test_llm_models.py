import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sparkcount.llm import kernels as K
from sparkcount.llm import op06_ctw as ctw
from sparkcount.llm import op07_language_spans as lang
from sparkcount.llm import queries as Q

SCHEMA = "doc_id long, text string, lang string, key long, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, k, 1, "x") for i, t, k in rows], SCHEMA)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", lower(t))


# ---- context-tree weighting ----

def ctw_brute(rows, train, depth):
    learn = [lower(t) for i, t, _ in rows if train(i)]
    seen = Counter(w for t in learn for w in [*words(t), None])
    n, v = sum(seen.values()), len(seen)
    cnt = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    series = lambda t: b"\xff" * depth + t.encode() + b"\xff"
    for t in learn:
        s = series(t)
        for p in range(depth, len(s)):
            for i in range(8):
                for d in range(depth + 1):
                    cnt[d][s[p - d:p], (1 << i) | (s[p] >> (8 - i))][(s[p] >> (7 - i)) & 1] += 1
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    below = [defaultdict(float) for _ in range(depth + 1)]
    for d in range(depth, -1, -1):
        for (ctx, node), (a, b) in cnt[d].items():
            e, u = kt(a, b), below[d][ctx, node]
            w = e if d == depth else np.logaddexp(e, u) - math.log(2)
            if d:
                below[d - 1][ctx[1:], node] += w

    def one(ctx, node, d=0):
        k = (ctx[depth - d:], node)
        if k not in cnt[d]:
            return .5
        a, b = cnt[d][k]
        p = (b + .5) / (a + b + 1)
        if d == depth:
            return p
        h = 1 / (1 + math.exp(min(700, below[d][k] - kt(a, b))))
        return h * p + (1 - h) * one(ctx, node, d + 1)

    out = []
    for i, t, _ in rows:
        tokens, s, total = [*words(t), None], series(lower(t)), 0.0
        for p in range(depth, len(s)):
            for j in range(8):
                o = one(s[p - depth:p], (1 << j) | (s[p] >> (8 - j)))
                total += math.log10(o if (s[p] >> (7 - j)) & 1 else 1 - o)
        out.append((i, len(tokens), sum(seen[w] > 0 for w in tokens), n,
                    sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in tokens), total))
    return out


@pytest.mark.parametrize("depth,part", [(2, None), (4, "1"), (3, "doc_id % 3")])
def test_scores_against_brute_force(spark, depth, part):
    rng = random.Random(depth)
    rows = [(i, " ".join(rng.choice(["the", "The", "cat", "sat", "chat", "dé", "語"]) for _ in range(rng.randrange(0, 30))), None)
            for i in range(25)] + [(50, None, None), (51, "", None), (52, "zq\n\x00ÿ " * 30, None), (3, "twice", None), (3, "twice", None)]
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    got = ctw.score(table(spark, rows), ~lang.held_out(F.col("doc_id"), 7, 2),
                    part and F.coalesce(F.expr(part), F.lit(0)), depth=depth).collect()
    key = lambda r: (r[0], r[1], round(r[5], 6))
    for r, w in zip(sorted(map(tuple, got), key=key), sorted(ctw_brute(rows, train, depth), key=key)):
        assert r[:4] == w[:4]
        assert r[4:6] == pytest.approx(w[4:6], rel=1e-9)


def test_no_training_text_and_empty_table(spark):
    got = ctw.score(table(spark, [(1, "ab", None), (None, None, None)]), F.lit(False), depth=2).orderBy("n_bytes").collect()
    assert [round(r.score / math.log10(.5)) for r in got] == [8, 24]
    assert [(r.n_known, r.train_tokens, r.base_score) for r in got] == [(0, 0, 0.0)] * 2
    assert ctw.score(table(spark, []), F.lit(True), depth=2).count() == 0


def test_lookup_of_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    find = ctw.Lookup(keys, np.arange(len(keys), dtype=float))
    assert (find(keys[::-1], -1) == np.arange(len(keys))[::-1]).all()
    assert (find(keys + np.uint64(1), -1)[~np.isin(keys + np.uint64(1), keys)] == -1).all()
    assert (ctw.Lookup(keys[:0], np.zeros(0))(keys[:3], 7) == 7).all()


# ---- language ----

def viterbi_brute(score, begins, switch):
    n, L = score.shape
    out, cuts = np.zeros(n, int), [*np.flatnonzero(begins), n]
    for a, z in zip(cuts[:-1], cuts[1:]):
        s, back = score[a].astype(float), []
        for t in range(a + 1, z):
            jump = s.max() - switch
            back.append(np.where(s >= jump, np.arange(L), s.argmax()))
            s = np.maximum(s, jump) + score[t]
        c = s.argmax()
        for t in range(z - 1, a - 1, -1):
            out[t] = c
            if t > a:
                c = back[t - a - 1][c]
    return out


def test_chunked_viterbi_is_viterbi():
    rng = np.random.default_rng(0)
    for L in (1, 2, 5):
        for n in (1, 7, 300, 2500):
            score = (rng.normal(size=(n, L)) * 3).astype(np.float32)
            begins = rng.random(n) < .03
            begins[0] = True
            assert (lang.viterbi(score, begins, 4.0, steps=16) == viterbi_brute(score, begins, 4.0)).all()


def test_scripts():
    text = "aZé×Ж語あ한1 א"
    data = np.frombuffer(text.encode(), np.uint8)
    bits = lang.script_bits(data)
    names = [lang._NAMES[int(b).bit_length() - 1] for b in bits if b]
    assert names == ["latin", "latin", "latin", "cyrillic", "han", "kana", "hangul", "hebrew"]


ROWS = [(i, "the cat and the dog went with that thing", "en") for i in range(20)] + \
       [(100 + i, "кошка и собака пошли вместе домой", "ru") for i in range(20)] + \
       [(200 + i, "der hund und die katze sind nicht hier", "de") for i in range(20)]


def test_languages_spans_and_odd_texts(spark):
    odd = [(300, None, "en"), (301, "", None), (302, "123 ... !", "de"), (303, "the dog and the cat " * 8 + "собака и кошка домой " * 4, None),
           (304, "ª", None), (305, "собака", None), (303, "the cat", None), (None, "die katze und der hund", None),
           (306, "the cat and " * 4000, None)]
    learn = F.col("doc_id") < 300
    rows = lang.predict_language(table(spark, ROWS + odd), learn, switch=8.0).collect()
    assert len(rows) == len(ROWS) + len(odd)
    got = {(r.doc_id, r.lang_pred): r for r in rows}
    assert all((i, k) in got for i, _, k in ROWS)
    assert {(i, "und") for i in (300, 301, 302)} <= set(got) and got[300, "und"].score == 0 and got[300, "und"].spans == []
    mixed = next(r for r in rows if r.doc_id == 303 and len(r.spans) > 1)
    assert [(s.first_word, s.n_words, s.lang) for s in mixed.spans] == [(0, 40, "en"), (40, 16, "ru")]
    assert mixed.lang_pred == "en" and 0.5 < mixed.score < 1
    assert (305, "ru") in got and (None, "de") in got and (306, "en") in got and (304, "und") not in got


def test_nothing_learned_and_empty_table(spark):
    assert {r.lang_pred for r in lang.predict_language(table(spark, ROWS), F.lit(False)).collect()} == {"und"}
    assert lang.predict_language(table(spark, []), F.lit(True)).count() == 0


def test_stage_keeps_columns_and_drops_what_has_no_language(spark):
    docs = table(spark, ROWS + [(300, "123", None), (301, None, None)])
    out = lang.keep_identified(docs, lang.fit(docs))
    assert out.columns == docs.columns and out.count() == len(ROWS)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    got = Q.op7_language_spans(spark, SF01).join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_kernels():
    texts = ["a b", None, "", "  x\ty\x0bz ", "é"]
    (i, j, data, offsets), = K.text_slices(pa.array(texts, pa.string()))
    starts, ends, row = K.word_spans(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a", "b", "x", "y", "z", "é"]
    assert row.tolist() == [0, 0, 3, 3, 3, 4] and (i, j) == (0, 5)
    h = K.span_hashes(data, starts, ends)
    assert len(set(h.tolist())) == 6
    assert [(a, b) for a, b, _, _ in K.text_slices(pa.array(texts, pa.string()), 3)] == [(0, 3), (3, 4), (4, 5)]


def test_scores_of_one_long_text_and_one_hot_context(spark):
    """A text of 5 MB beside short ones, nearly all of it one context; parts from one
    text to the whole table give the same scores."""
    rows = [(1, "ab" * 2_500_000, None), (2, "abababab ab", None), (3, "the cat", None), (4, None, None)]
    df = table(spark, rows)
    got = [sorted(tuple(r) for r in ctw.score(df, F.col("doc_id") != 3, F.expr(part), depth=5).collect())
           for part in ("doc_id", "0", "doc_id % 2")]
    assert got[0][0][-1] == 5_000_001 and got[0][0][5] > -50  # a few digits for five million bytes
    for other in got[1:]:
        for r, w in zip(got[0], other):
            assert r[:4] == w[:4] and r[4:] == pytest.approx(w[4:], rel=1e-9)


def test_parts_follow_bytes(spark, scratch):
    texts = ["x" * 100] * 3000 + ["y" * 100_000] * 30
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{scratch}/d")
    docs = spark.read.parquet(f"{scratch}/d")
    small = ctw.PART_BYTES
    try:
        ctw.PART_BYTES = 100_000
        part = docs.select(ctw.parts(docs).alias("p"), F.length("text").alias("n")).groupBy("p").agg(F.sum("n").alias("n"))
        sizes = [r.n for r in part.collect()]
    finally:
        ctw.PART_BYTES = small
    assert max(sizes) <= 800_000 and len(sizes) < 100


def test_packed_values():
    rng = np.random.default_rng(3)
    for n in (0, 1, 50):
        values = rng.integers(0, 1 << 40, n, dtype=np.uint64)
        assert ctw.unpack(ctw.pack(values, 5), 5).tolist() == values.tolist()


def test_word_scores_against_plain_counts(spark):
    """Trigram and word scores of every word, counted in dictionaries instead of buckets."""
    model = lang.fit(table(spark, ROWS))
    text = "the катze dog und собака dogs нет zz"
    data = np.frombuffer(text.encode(), np.uint8)
    tri, word, starts, ends, _ = lang.features(data, np.array([0, len(data)]))
    got = np.add.reduceat(model.tri[tri], starts, axis=0) + model.words[word]
    for k, name in enumerate(model.langs):
        grams, whole = Counter(), Counter()
        for _, t, own in ROWS:
            if own == name:
                for w in t.encode().split():
                    whole[w] += 1
                    grams.update((b" " + w + b" ")[i:i + 3] for i in range(len(w)))
        log = lambda c, x: math.log((c[x] + .5) / (sum(c.values()) + .5 * lang.FEATURES))
        want = [sum(log(grams, (b" " + w + b" ")[i:i + 3]) for i in range(len(w))) + log(whole, w) for w in text.encode().split()]
        assert got[:, k] == pytest.approx(want, rel=1e-4)


def test_foreign_scripts_and_gibberish(spark):
    rng = random.Random(2)
    noise = " ".join("".join(rng.choice("qxzjkvwf") for _ in range(rng.randint(2, 9))) for _ in range(80))
    odd = [(300, "ሰላም ለዓለም ይህ ጽሑፍ ነው", None), (301, "สวัสดีชาวโลก นี่คือข้อความ", None), (302, noise, None),
           (303, "the dog went ሰላም", None), (304, "𐐀𐐁 𐐂", None), (305, "the cat and the thing", None)]
    docs = table(spark, [(i, " ".join([t] * 20), k) for i, t, k in ROWS] + odd)
    model = lang.fit(docs)
    got = {r.doc_id: r for r in lang.identify(docs, model).collect()}
    for i in (300, 301, 304):
        assert got[i].score == 0 and got[i].lang_pred in model.langs
    assert got[302].score == 1 and 0.7 < got[303].score < 0.8 and got[305].score == 1
    kept = {r.doc_id for r in lang.keep_identified(docs, model, 1 / 3).collect()}
    assert {i for i, _, _ in ROWS} | {303, 305} == kept


def test_letters_of_all_planes():
    text = "aZ1é-Ж語ሰ𐐀😀٣ª​한"
    data = np.frombuffer(text.encode(), np.uint8)
    assert int(lang.letter_starts(data).sum()) == sum(ch.isalpha() for ch in text)
