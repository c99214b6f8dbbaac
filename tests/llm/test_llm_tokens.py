import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from sparkcount.llm import kernels as K
from sparkcount.llm import op08_dac as dac
from sparkcount.llm import op09_best_fit as fit
from sparkcount.llm.storage import Work
from sparkcount.llm.tokens import Encoder, load

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length long, part int, seg string"
TEXTS = ["a  b c\n\nd  e \n f's it's <|endoftext|> x\ty “q” z w", "", None, " lead", "trail ", "\n", " ",
         "日本 語　テ スト", "a\x1cb c\x85 d", "don't,stop 12ab-34\r\n'S x×y÷z naïve ÀÉ", "the the the"]


def plain(texts):
    return [e.ids for e in load(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, -1, 9, "x") for i, t in rows], SCHEMA)


def test_pieces_give_the_librarys_ids():
    rng = random.Random(5)
    alphabet = "abcdeABC  \n\t.,'!-123éßñ×÷ж  　​語😀<|>"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(1500)]
    got, coder = [], Encoder(PATH, max_pieces=200)  # the memo starts again many times
    for _, _, data, offsets in K.text_slices(pa.array(texts, pa.string()), 400):
        ids, n = coder.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == plain(texts)


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2 ** 32 - 1, 7], list(range(0, 300000, 37))])
def test_segment_random_access(ids):
    s = dac.Segment(dac.pack_segment([3, None], np.array(ids, np.uint32), np.array([0, 0, len(ids)])))
    assert s.ids().tolist() == ids
    rng = random.Random(1)
    for i in rng.sample(range(len(ids)), min(len(ids), 300)):
        assert s[i] == ids[i]
    assert s.valid.tolist() == [1, 0]
    with pytest.raises(IndexError):
        s[len(ids)]


def test_codes_read_back(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "no id"), (-5, "first of all " * 900)]
    path = f"{Work(spark, 'test').root}/codes"
    dac.write_segments(docs(spark, rows), path, PATH, end_id=0, segment_ids=300)
    got = dac.document_index(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (i, t) in zip(got, order):
        ids = np.array([*plain([t])[0], 0], np.uint32)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
    assert dac.read_segments(spark, path).count() > 1


def test_token_lookup_from_the_files(spark, monkeypatch):
    monkeypatch.setattr(dac, "LOOKUPS", 64)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (None, "no id"), (-5, "first of all " * 900)]
    path = f"{Work(spark, 'test').root}/codes"
    dac.write_segments(docs(spark, rows), path, PATH, end_id=0, segment_ids=300)
    want, asked = Counter(), []
    for d, t in rows:
        ids = [*plain([t])[0], 0]
        for i in range(len(ids)):
            if d != 3:
                asked.append((d, i, "x"))
                want[d, i, ids[i]] += 1
    both = [[*plain([t])[0], 0] for d, t in rows if d == 3]
    for i in (0, 1):  # an id of two documents
        asked.append((3, i, "x"))
        want.update((3, i, ids[i]) if i < len(ids) else (3, i, None) for ids in both)
    for row in [(0, 10 ** 6), (0, -1), (0, None), (77, 0)]:
        asked.append((*row, "x"))
        want[(*row, None)] += 1
    asked.append((-5, 7, "x"))  # asked twice, answered twice
    want[-5, 7, plain([rows[-1][1]])[0][7]] += 1
    got = dac.token_at(spark, path, spark.createDataFrame(asked, "doc_id long, i long, part string")).collect()
    assert Counter((r.doc_id, r.i, r.token) for r in got) == want
    assert dac.token_at(spark, path, spark.createDataFrame([], "doc_id long, i long")).count() == 0


def test_rows_of_one_id_lie_in_many_ranges(spark):
    """A hot id is dealt over ranges, equal rows too, and the order does not depend on the layout."""
    rows = [(1, f"text {i % 40} of one id") for i in range(2000)] + [(None, "same")] * 1000
    found = []
    for n in (1, 7):
        path = f"{Work(spark, 'test').root}/hot"
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        dac.write_segments(docs(spark, rows).repartition(n), path, PATH)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        sizes = [r.n_docs for r in dac.read_segments(spark, path).collect()]
        assert len(sizes) > 4 and max(sizes) < 1000
        found.append([tuple(r) for r in dac.document_index(spark, path).select(
            "doc_id", "start", "ids_crc32").orderBy("start").collect()])
    assert found[0] == found[1] and len(found[0]) == 3000


def test_codes_of_an_empty_table(spark):
    path = f"{Work(spark, 'test').root}/codes"
    dac.write_segments(docs(spark, []), path, PATH)
    assert dac.document_index(spark, path).count() == 0


def one_by_one(lengths, capacity):
    """Best-fit decreasing, item by item: the number of bins."""
    left, bins = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect_left(left, x)
        r = left.pop(k) if k < len(left) else capacity
        bins += r == capacity
        if r > x:
            insort(left, r - x)
    return bins


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for case in range(60):
        cap = rng.choice([1, 7, 16, 100])
        lengths = [rng.randint(1, cap) for _ in range(rng.randrange(1, 400))]
        counts = Counter(lengths)
        runs = fit.plan(counts, cap)
        room = defaultdict(list)
        for s, n in counts.items():
            own = [r for r in runs if r[0] == s]
            for k in range(n):
                _, first, bin0, per, off = [r for r in own if r[1] <= k][-1]
                room[bin0 + (k - first) // per].append((off + (k - first) % per * s, s))
        for items in room.values():
            at = 0
            for off, s in sorted(items):
                assert off == at
                at += s
            assert at <= cap
        assert len(room) == one_by_one(lengths, cap)


def test_packing_small_documents(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(i, "word " * rng.randrange(0, 60)) for i in range(50, 90)]
    rows += [(7, "dup"), (7, "dup"), (None, "no id"), (200, "long text " * 700)]
    got = fit.best_fit_packing(docs(spark, rows), PATH, end_id=2, capacity=64).collect()
    assert list(got[0].asDict()) == [*"doc_id piece start length ids_crc32 sequence_id offset".split()]
    want = Counter()
    for i, t in rows:
        ids = [*plain([t])[0], 2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 64)] if len(ids) > 64 else [0, len(ids)]
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            want[i, p, a, b - a, zlib.crc32(np.array(ids[a:b], np.uint32).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for items in seqs.values():
        at = 0
        for off, n in sorted(items):
            assert off == at
            at += n
        assert at <= 64
    assert len(seqs) == one_by_one([r.length for r in got], 64)


def test_packing_an_empty_table(spark):
    assert fit.best_fit_packing(docs(spark, []), PATH).count() == 0


ADDED = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>\n<|endoftext|> ", "a\n<|endoftext|>\nb",
         "<|endoftext", "|>", "it<|endoftext|>'s 12<|endoftext|>34 é<|endoftext|>é  <|endoftext|>  z", "<<|endoftext|>>",
         "<|endoftext<|endoftext|>|>", "<|ENDOFTEXT|>", "", "日本<|endoftext|>　語"]


def fresh(texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_are_the_librarys():
    rng = random.Random(9)
    part = ["<|endoftext|>", "<|", "|>", "endoftext", " ", " ", "\n", "a", "word", "12", "'s", "é", "　", "."]
    texts = ADDED + ["".join(rng.choice(part) for _ in range(rng.randrange(0, 25))) for _ in range(1500)]
    got, coder = [], Encoder(PATH, max_pieces=200)
    for _, _, data, offsets in K.text_slices(pa.array(texts, pa.string()), 400):
        ids, n = coder.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == fresh(texts)
    assert got[0] == [87, 220, 50256, 331]


def test_added_tokens_in_codes(spark):
    path = f"{Work(spark, 'test').root}/added"
    dac.write_segments(docs(spark, list(enumerate(ADDED))), path, PATH, end_id=0, segment_ids=300)
    got = dac.document_index(spark, path).collect()
    want = {i: [*x, 0] for i, x in enumerate(fresh(ADDED))}
    assert {r.doc_id: r.ids_crc32 for r in got} == {i: zlib.crc32(np.array(x, np.uint32).tobytes()) for i, x in want.items()}
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(x) for i, x in want.items()}


def test_full_pieces_are_sequences_of_their_own(spark):
    rows = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate([8] * 40 + [5, 3, 3, 2, 8, 1])], fit.PIECES)
    got = fit.pack(rows, 8, buckets=2).collect()
    full = [r for r in got if r.length == 8]
    assert len(got) == 46 and len({r.sequence_id for r in full}) == len(full) == 41
    assert all(r.offset == 0 and r.sequence_id < 0 for r in full)
    assert len({r.sequence_id for r in got if r.length < 8}) == 2 and min(r.sequence_id for r in got if r.length < 8) >= 0
