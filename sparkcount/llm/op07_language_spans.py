"""Language identification: script ranges, per-word scores, Viterbi over words.

A model holds, per learned language, log-probabilities of hashed byte trigrams
(with word borders) and of hashed words, and the scripts its letters come from.
For a text, each word's scripts narrow the candidate languages; the word's score
for a candidate is the sum of its features' log-probabilities.  Viterbi with a
penalty per language switch then labels all words, giving spans of one language
each.  The text's language is the one with most letters; its score is that
language's share of the letters, where letters of words in a script that no
language was learned in belong to none.

The model also holds the trigrams' counts and a background, the frequency of single
bytes in all learned text.  A text's margin is the mean log-ratio per byte of its
labelled words between their language's trigrams (smoothed towards the background
by ``PRIOR`` trigrams) and the background: text put together from letters alone has
none.  The margin decides only in ``keep_identified``.

The model is fitted on at most about ``max_docs`` labelled documents per
language (a hash sample; the bound is a parameter).  It is a few hundred
kilobytes per language and the only thing that reaches the driver.

The Viterbi pass treats a slice of documents as one sequence with restarts, cut
into chunks that run side by side: a first pass finds what each chunk does to
any entry state, a second pass runs with the true entry scores.  The result is
that of one document after another; a very long text costs no longer loop.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and no spans, and so is every text when nothing was learned; a text whose letters
are all in scripts that nothing was learned in has score 0 and the language that
sorts first; words without letters go with their neighbours; ties go to the language that sorts first;
repeated rows get a row each; an empty table gives no rows; languages to learn
from are non-null ``lang`` values; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.storage import Work

MAX_DOCS = 5000
SWITCH = 16.0
FEATURES = 1 << 16
PRIOR = 256.0
MIN_MARGIN = -2.0  # short clean texts come down to -1, letters at random lie at -4 and below
UND = "und"

# Ranges of Unicode letters by script (first and last code point).
SCRIPTS = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0xD6), ("latin", 0xD8, 0xF6),
    ("latin", 0xF8, 0x24F), ("greek", 0x370, 0x373), ("greek", 0x386, 0x386), ("greek", 0x388, 0x3FF),
    ("cyrillic", 0x400, 0x481), ("cyrillic", 0x48A, 0x52F), ("armenian", 0x531, 0x556),
    ("armenian", 0x561, 0x587), ("hebrew", 0x5D0, 0x5EA), ("arabic", 0x620, 0x64A),
    ("arabic", 0x671, 0x6D3), ("devanagari", 0x904, 0x939), ("bengali", 0x985, 0x9B9),
    ("tamil", 0xB85, 0xBB9), ("telugu", 0xC05, 0xC39), ("thai", 0xE01, 0xE30), ("georgian", 0x10A0, 0x10FA),
    ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FBC),
    ("kana", 0x3041, 0x3096), ("kana", 0x30A1, 0x30FA), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7A3),
]
_NAMES = list(dict.fromkeys(s for s, _, _ in SCRIPTS))
_FIRST = np.array([a for _, a, _ in SCRIPTS])
_LAST = np.array([b for _, _, b in SCRIPTS])
_BIT = np.array([1 << _NAMES.index(s) for s, _, _ in SCRIPTS], np.int64)


def held_out(id_col: Column, parts: int, rest: int) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts == rest


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters (none lies behind the third plane)."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x40000)])


def letter_starts(data: np.ndarray) -> np.ndarray:
    """Whether a letter of any script starts at each byte."""
    n = len(data)
    tail = np.zeros((3, n), np.int64)
    for k in (1, 2, 3):
        tail[k - 1, :max(n - k, 0)] = data[k:] & 63
    d = data.astype(np.int64)
    cp = np.where(d < 0x80, d, np.where(
        d < 0xE0, (d & 31) << 6 | tail[0], np.where(
            d < 0xF0, (d & 15) << 12 | tail[0] << 6 | tail[1], (d & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2])))
    lead = (d < 0x80) | (d >= 0xC2)
    return lead & _letters()[np.minimum(cp, 0x3FFFF)]


def script_bits(data: np.ndarray) -> np.ndarray:
    """Script bit of the letter that starts at each byte, 0 where none does."""
    cp = data.astype(np.int64)
    n = len(data)
    nxt = np.zeros((3, n + 3), np.int64)
    for k in (1, 2):
        nxt[k, :max(n - k, 0)] = data[k:] & 63
    two, three = (data >= 0xC2) & (data < 0xE0), (data >= 0xE0) & (data < 0xF0)
    cp = np.where(two, (cp & 31) << 6 | nxt[1, :n], cp)
    cp = np.where(three, (data.astype(np.int64) & 15) << 12 | nxt[1, :n] << 6 | nxt[2, :n], cp)
    lead = (data < 0x80) | two | three
    at = np.searchsorted(_FIRST, cp, side="right") - 1
    hit = lead & (at >= 0) & (cp <= _LAST[at])
    return np.where(hit, _BIT[at], 0)


def _lower(data: np.ndarray) -> np.ndarray:
    low = K.LOWER[data]
    accent = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F) & (data[1:] != 0x97)) + 1
    low[accent] += 32
    return low


def features(data: np.ndarray, offsets: np.ndarray):
    """Trigram bucket per byte (``FEATURES`` where no word is), word buckets, words."""
    low = _lower(data)
    starts, ends, row = K.word_spans(low, offsets)
    cur = low.astype(np.uint64)
    cur[K.SPACE[data]] = 32
    before, after = np.empty_like(cur), np.empty_like(cur)
    before[1:], after[:-1] = cur[:-1], cur[1:]
    before[starts], after[ends - 1] = 32, 32
    key = before << np.uint64(16) | cur << np.uint64(8) | after
    tri = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    tri[K.SPACE[data]] = FEATURES
    words = (K.span_hashes(low, starts, ends) & np.uint64(FEATURES - 1)).astype(np.int64)
    return tri, words, starts, ends, row


@dataclass
class Model:
    langs: list[str]
    tri: np.ndarray     # (FEATURES + 1, languages), the last row zero
    words: np.ndarray   # (FEATURES, languages)
    scripts: np.ndarray  # bit set per language
    counts: np.ndarray  # trigram counts, as tri
    ground: np.ndarray  # log-frequency of each byte value


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_docs: int = MAX_DOCS) -> Model:
    """Learn from all rows of ``docs`` with a language, at most about ``max_docs`` each."""
    Work(docs.sparkSession, "language")
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((FEATURES + 1, 0)), np.zeros((FEATURES, 0)), np.zeros(0, np.int64), np.zeros((FEATURES + 1, 0)),
                     np.zeros(256))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(max_docs / sizes[k]))])
    sample = rows.where(F.pmod(F.xxhash64("id", "lang"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    width, bits = 2 * FEATURES, len(_NAMES)

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            of = np.array(batch.column("lang").to_pylist(), object)
            for i, j, data, offsets in K.text_slices(batch.column("text")):
                tri, words, starts, _, row = features(data, offsets)
                script = script_bits(data)
                byte_row = np.repeat(np.arange(j - i), np.diff(offsets))
                for lang in set(of[i:j]):
                    own = of[i:j] == lang
                    c = held.setdefault(lang, np.zeros(width + bits + 256, np.int64))
                    c[:FEATURES] += np.bincount(tri[own[byte_row]], minlength=FEATURES + 1)[:FEATURES]
                    c[FEATURES:width] += np.bincount(words[own[row]], minlength=FEATURES)
                    s = script[own[byte_row]]
                    c[width:width + bits] += np.array([((s >> b) & 1).sum() for b in range(bits)])
                    c[width + bits:] += np.bincount(_lower(data[own[byte_row]]), minlength=256)
        if held:
            yield pa.RecordBatch.from_pydict({"lang": pa.array(list(held)),
                                              "c": pa.array([x.tobytes() for x in held.values()], pa.binary())})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        c = sum(np.frombuffer(x, np.int64) for x in pdf["c"])
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "c": [c.tobytes()]})

    got = sample.select("lang", "text").mapInArrow(count, "lang string, c binary").groupBy("lang").applyInPandas(
        total, "lang string, c binary").collect()
    langs = sorted(r["lang"] for r in got)
    counts = {r["lang"]: np.frombuffer(r["c"], np.int64) for r in got}

    def logs(c: np.ndarray) -> np.ndarray:
        return np.log((c + 0.5) / (c.sum() + 0.5 * len(c)))

    tri = np.zeros((FEATURES + 1, len(langs)), np.float32)
    words = np.zeros((FEATURES, len(langs)), np.float32)
    seen_tri = np.zeros((FEATURES + 1, len(langs)), np.float32)
    scripts = np.zeros(len(langs), np.int64)
    for k, lang in enumerate(langs):
        c = counts[lang]
        seen_tri[:FEATURES, k] = c[:FEATURES]
        tri[:FEATURES, k], words[:, k] = logs(c[:FEATURES]), logs(c[FEATURES:width])
        seen = c[width:width + bits]
        scripts[k] = sum(1 << b for b in range(bits) if seen[b] >= 0.02 * max(1, seen.sum()))
    total = sum(counts[lang][width + bits:] for lang in langs)
    return Model(langs, tri, words, scripts, seen_tri, logs(total))


def viterbi(score: np.ndarray, begins: np.ndarray, switch: float, steps: int = 256) -> np.ndarray:
    """Best label per word; ``begins`` marks words that start a sequence anew."""
    n, L = score.shape
    steps = max(steps, n * L * L // 4_000_000)
    C = -(-n // steps)
    e = np.zeros((C * steps, L), np.float32)
    e[:n] = score
    b = np.ones(C * steps, bool)
    b[:n] = begins
    e, b = e.reshape(C, steps, L), b.reshape(C, steps)
    # what a chunk does to each entry state
    m = np.full((C, L, L), -1e9, np.float32)
    m[:, np.arange(L), np.arange(L)] = 0
    for t in range(steps):
        m = np.maximum(m, m.max(axis=2, keepdims=True) - switch) + e[:, t, None, :]
        fresh = b[:, t]
        if fresh.any():
            m[fresh] = e[fresh, t][:, None, :]
    entry = np.zeros((C, L), np.float32)
    for c in range(C - 1):
        v = (entry[c][:, None] + m[c]).max(axis=0)
        entry[c + 1] = v - v.max()
    # with the true entry scores: where each state came from
    own, s = np.arange(L), entry
    back = np.zeros((C, steps, L), np.uint8 if L < 256 else np.int32)
    for t in range(steps):
        top = s.argmax(axis=1)
        jump = s.max(axis=1, keepdims=True) - switch
        back[:, t] = np.where(s >= jump, own, top[:, None])
        s = np.maximum(s, jump) + e[:, t]
        fresh = b[:, t]
        if fresh.any():
            back[fresh, t] = top[fresh, None]
            s[fresh] = e[fresh, t]
    into = np.tile(own, (C, 1))
    for t in range(steps - 1, -1, -1):
        into = np.take_along_axis(back[:, t], into, axis=1)
    last = np.zeros(C, np.int64)
    last[-1] = s[-1].argmax()
    for c in range(C - 1, 0, -1):
        last[c - 1] = into[c, last[c]]
    out, rows, cur = np.zeros((C, steps), np.int64), np.arange(C), last
    for t in range(steps - 1, -1, -1):
        out[:, t] = cur
        cur = back[rows, t, cur].astype(np.int64)
    return out.reshape(-1)[:n]


def _margins(model: Model, data: np.ndarray, tri, starts, ends, row, label, counted, rows: int) -> np.ndarray:
    """Mean log-ratio per byte between the words' languages and the background."""
    ground = model.ground[_lower(data)]
    before, after = np.empty_like(ground), np.empty_like(ground)
    before[1:], after[:-1] = ground[:-1], ground[1:]
    before[starts], after[ends - 1] = model.ground[32], model.ground[32]
    at = K.ragged(starts, ends - starts)
    own = np.repeat(label, ends - starts)
    size = model.counts.sum(axis=0)[own]
    ratio = np.log((model.counts[tri[at], own] / np.exp(ground + before + after)[at] + PRIOR) / (size + PRIOR))
    use = np.repeat(counted, ends - starts)
    byte_row = np.repeat(row, ends - starts)
    return np.bincount(byte_row, weights=ratio * use, minlength=rows) / np.maximum(
        np.bincount(byte_row, weights=use, minlength=rows), 1)


def label_slice(model: Model, data: np.ndarray, offsets: np.ndarray, switch: float = SWITCH, margin: bool = False):
    """Per row: language number (-1: none) and score; per span: row, first word
    in its row, number of words, language number.  With ``margin`` also the rows' margins."""
    rows, L = len(offsets) - 1, len(model.langs)
    lang, share = np.full(rows, -1), np.zeros(rows)
    none = np.zeros(0, np.int64)
    empty = lang, share, (none, none, none, none), *([np.zeros(rows)] if margin else [])
    if not L or not len(data):
        return empty
    tri, words, starts, ends, row = features(data, offsets)
    if not len(starts):
        return empty
    bits = script_bits(data)
    scripts = np.bitwise_or.reduceat(bits, starts)
    letters = np.add.reduceat(letter_starts(data).astype(np.int64), starts)
    score = np.add.reduceat(model.tri[tri], starts, axis=0) + model.words[words]
    fits = (scripts[:, None] & model.scripts[None, :]) != 0
    narrowed = fits.any(axis=1)
    score[~narrowed] = 0  # no letters, or a script that no language was learned in
    score -= score.max(axis=1, keepdims=True)
    score[narrowed[:, None] & ~fits] -= 2 * switch
    begins = np.ones(len(row), bool)
    begins[1:] = row[1:] != row[:-1]
    label = viterbi(score, begins, switch)
    weight = np.bincount(row * L + label, weights=letters * narrowed, minlength=rows * L).reshape(rows, L)
    total = np.bincount(row, weights=letters, minlength=rows)
    seen = total > 0
    lang[seen] = weight[seen].argmax(axis=1)
    share[seen] = weight[seen].max(axis=1) / total[seen]
    edge = begins.copy()
    edge[1:] |= label[1:] != label[:-1]
    at = np.flatnonzero(edge)
    n = np.diff(np.append(at, len(label)))
    first_word = np.flatnonzero(begins)
    start = at - first_word[np.searchsorted(first_word, at, side="right") - 1]
    more = [_margins(model, data, tri, starts, ends, row, label, narrowed, rows)] if margin else []
    return lang, share, (row[at], start, n, label[at]), *more


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             switch: float = SWITCH) -> DataFrame:
    """``doc_id, lang_pred, score, spans array<struct<first_word, n_words, lang>>``."""
    Work(docs.sparkSession, "language")
    id_type = docs.schema[id_col].dataType.simpleString()
    langs = np.array([*model.langs, UND], object)
    room = max(1 << 16, K.SLICE_BYTES * 4 // max(4, len(model.langs)))

    def predict(batches):
        for batch in batches:
            texts = batch.column("text")
            for i, j, data, offsets in K.text_slices(texts, room):
                lang, share, (row, start, n, label) = label_slice(model, data, offsets, switch)
                known = lang[row] >= 0
                row, start, n, label = row[known], start[known], n[known], label[known]
                ends = np.searchsorted(row, np.arange(j - i + 1))
                spans = pa.StructArray.from_arrays(
                    [pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(langs[label], pa.string())],
                    ["first_word", "n_words", "lang"])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("id").slice(i, j - i),
                    "lang_pred": pa.array(langs[lang], pa.string()), "score": pa.array(share, pa.float64()),
                    "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        predict, f"doc_id {id_type}, lang_pred string, score double, "
                 "spans array<struct<first_word: int, n_words: int, lang: string>>")


def predict_language(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", max_docs: int = MAX_DOCS, switch: float = SWITCH) -> DataFrame:
    """Fit on the rows of ``docs`` where ``learn`` holds and label all rows."""
    return identify(docs, fit(docs.where(learn), id_col, text_col, lang_col, max_docs), id_col, text_col, switch)


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text",
                    switch: float = SWITCH, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with all its columns, without the rows that have no letter, no
    language with ``min_score`` of the letters, or a margin below ``min_margin``:
    text in other scripts, mixtures of everything, and rows of letters that the
    learned languages explain no better than their bytes alone."""
    Work(docs.sparkSession, "language")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    room = max(1 << 16, K.SLICE_BYTES * 2 // max(4, len(model.langs)))  # margins take as much again

    def keep(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for i, j, data, offsets in K.text_slices(texts, room):
                lang, share, _, margin = label_slice(model, data, offsets, switch, margin=True)
                yield batch.slice(i, j - i).filter(pa.array(
                    (lang >= 0) & (share >= min_score) & (margin >= min_margin)))

    return docs.mapInArrow(keep, fields)
