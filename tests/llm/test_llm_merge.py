import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from sparkcount.llm import kernels as K
from sparkcount.llm import op02_merge_dropout as op

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a  b c\n\nd  e", "", " lead", "trail ", "\n", "   ", "日本 語　テ スト " * 8, "x" * 300,
         "antidisestablishmentarianism" * 4, "𝔘nicode é ü ­﻿", "<s> </s> <0x41>", "tab\tand “quotes”"]


def encode(texts, **kw):
    coder, out = op.Encoder(PATH, **kw), []
    for i, j, data, offsets in K.text_slices(pa.array(texts, pa.string()), 500):
        ids, n = coder.encode(data, offsets, np.zeros(j - i, np.int64))
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def decode(rows):
    m = op.load(PATH)
    return [m.decode_rows(np.array(x, np.int64), np.array([len(x)]))[0].decode() for x in rows]


def test_without_dropout_the_librarys_ids():
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcdethe  in.,\néß語😀") for _ in range(rng.randrange(0, 90))) for _ in range(400)]
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts)
    assert encode(texts, dropout=0.0) == want


def test_dropout_varies_by_seed_and_is_lossless():
    texts = TEXTS + ["▁x ▁ a▁", "the quick brown fox jumps over the lazy dog " * 20]
    a, b, again = (encode(texts, dropout=0.3, seed=s) for s in (1, 2, 1))
    assert a == again and a != b
    assert decode(a) == decode(b) == texts
    assert sum(map(len, a)) > sum(map(len, encode(texts, dropout=0.0)))


def test_many_at_once_is_the_heap():
    m, rng = op.load(PATH), random.Random(4)
    for dropout in (0.0, 0.1, 0.5, 1.0):
        words = [" " + "".join(rng.choice("etaoinshrdluéz語") for _ in range(rng.randrange(0, 20))) for _ in range(300)]
        keys = [rng.getrandbits(63) for _ in words]
        rows = [[int(m.char[ord(c)]) for c in w] for w in words]
        width = max(map(len, rows))
        matrix = np.array([r + [-2] * (width - len(r)) for r in rows])
        s, p, n = op.together(m, matrix, np.array([len(r) for r in rows]), np.array(keys, np.uint64), dropout)
        for i, (r, k) in enumerate(zip(rows, keys)):
            assert op.agenda(m, r, k, dropout) == (s[i, :n[i]].tolist(), p[i, :n[i]].tolist())


def test_tables(spark):
    rows = [(i, t, "x", [1]) for i, t in enumerate([*TEXTS, None])] + [(None, "no id", "x", [1]), (1, "same", "x", [1]), (1, "same", "x", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, v string, ids array<int>")
    got = op.round_trip(docs, PATH).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert sorted(r.decoded_sha256 for r in got) == sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows)
    back = op.decode(op.encode(docs, PATH), PATH).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in rows)
    assert op.round_trip(docs.limit(0), PATH).count() == 0


def test_every_occurrence_is_cut_by_its_own_draws():
    """A frequent word has many segmentations, in one document and over documents,
    and remembered words give the ids of the heap with the occurrence's key."""
    m, texts = op.load(PATH), ["international relationship " * 400, *["international relationship"] * 300, "x " * 50 + "é" * 60]
    for dropout in (0.1, 0.5):
        coder, col = op.Encoder(PATH, dropout=dropout, seed=3), pa.array(texts, pa.string())
        keys = []
        inner = coder._occurrences
        coder._occurrences = lambda cp, s, e, h, key: (keys.append((cp, s, e, key)), inner(cp, s, e, h, key))[1]
        _, _, data, offsets = next(iter(K.text_slices(col)))
        for _ in range(2):  # new and remembered
            ids, n = coder.encode(data, offsets, np.arange(len(texts)))
            cp, s, e, key = keys.pop()
            want = []
            for a, b, k in zip(s.tolist(), e.tolist(), key.tolist()):
                sym, first = op.agenda(m, m.char[cp[a:b]].tolist(), k, dropout)
                want += coder._spell(np.array(sym), cp[a + np.array(first)])[0].tolist()
            assert ids.tolist() == want
        rows = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert decode(rows) == texts
        assert len(set(map(tuple, rows[1:301]))) > 20
        assert len(set(key.tolist())) == len(key)


def test_occurrences_vary_in_a_table(spark):
    docs = spark.createDataFrame([(i, "international relationship") for i in range(200)], "doc_id long, text string")
    assert docs.count() == 200
    assert len({tuple(r.ids) for r in op.encode(docs, PATH).collect()}) > 20
