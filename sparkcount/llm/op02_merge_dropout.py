"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

The pieces and scores come from a public model file.  A text is a leading
space and its characters, spaces written as U+2581.  Adjacent symbols whose
concatenation is a piece are merge candidates; an agenda takes the candidate of
the highest score (the leftmost of equals) until none is left.  With dropout, a
candidate is skipped for good when a hash of the seed, the document id, the
segment with its place in the document, and the candidate's place in the segment
falls below ``dropout``: every occurrence of a word has draws of its own, the
same seed gives the same ids on every run and retry, another seed other
segmentations.  Characters without a piece, and a literal U+2581, become byte
pieces, so decoding restores every text.

No piece of such a model joins a visible character to a space after it, so a
text falls into segments (spaces and the word after them) that are encoded
apart.  Short segments are processed together, one merge of each per step;
longer ones by a heap.  A task remembers short segments by the candidates that
were skipped, with the candidates that came up and were kept: an occurrence
whose draws skip none of those has the remembered ids, any other occurrence is
merged with its own draws.

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows get a row each, with the same ids; the text stands for a null
document id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.op06_ctw import Lookup
from sparkcount.llm.storage import Work

DROPOUT = 0.1
SEED = 17
SHORT = 48  # below 64: three places of a segment make an 18-bit code

_U = np.uint64
_MARK = 0x2581
_NONE = -1e30


class Model:
    """Pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {names[i]: i for i in plain}
        self.score = {i: sp.get_score(i) for i in plain}
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if any("▁" in names[i].lstrip("▁") for i in plain):
            raise ValueError("a piece goes on after a space: texts cannot be cut into words")
        # every way to make a piece from two pieces
        self.merge = {}
        for name, i in self.id.items():
            for k in range(1, len(name)):
                left, right = self.id.get(name[:k]), self.id.get(name[k:])
                if left is not None and right is not None:
                    self.merge[left, right] = i
        pairs = np.array([a << 32 | b for a, b in self.merge], np.uint64)
        self.into = Lookup(pairs, np.array(list(self.merge.values()), np.float64))
        self.scores = np.full(n + 1, _NONE)
        for i, x in self.score.items():
            self.scores[i] = x
        self.char = np.full(0x110000, -1, np.int32)
        for name, i in self.id.items():
            if len(name) == 1:
                self.char[ord(name)] = i
        self.char[0x20] = self.id["▁"]
        self.char[_MARK] = -1  # a literal mark is spelled in bytes
        # decoding: the bytes of each id
        spelled = [b""] * n
        for i in plain:
            spelled[i] = names[i].replace("▁", " ").encode()
        for b, i in enumerate(self.bytes.tolist()):
            spelled[i] = bytes([b])
        self.length = np.array([len(x) for x in spelled], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def decode_rows(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each row's ids, without the leading space."""
        length = self.length[ids]
        data = self.flat[K.ragged(self.start[ids], length)].tobytes()
        last = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a + (b > a):b] for a, b in zip(last[:-1], last[1:])]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Model:
    """The model of a file, once per Python worker."""
    return Model(path)


def _kept(key, left, middle, right, dropout: float):
    """Whether a candidate at these places of a segment is not skipped."""
    if dropout <= 0:
        return np.ones(np.broadcast(key, left).shape, bool)
    return _above(key, _place(left, middle, right), dropout)


def _place(left, middle, right):
    return K.mix(left.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + middle.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
                 + right.astype(np.uint64) * _U(0x165667B19E3779F9))


def _above(key, place, dropout: float):
    return (K.mix(key ^ place) >> _U(11)).astype(np.float64) >= dropout * 2.0 ** 53


@functools.lru_cache(maxsize=1)
def _places() -> np.ndarray:
    """``_place`` of every code ``left << 12 | middle << 6 | right``."""
    code = np.arange(1 << 18)
    return _place(code >> 12, code >> 6 & 63, code & 63)


def agenda(model: Model, symbols: list[int], key: int, dropout: float) -> tuple[list[int], list[int]]:
    """One segment by a heap: final symbols and their first characters."""
    n = len(symbols)
    symbols = list(symbols)
    prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
    end = list(range(1, n + 1))
    key64, heap = np.array([key], np.uint64), []

    def propose(i: int, j: int) -> None:
        if i < 0 or j < 0:
            return
        new = model.merge.get((symbols[i], symbols[j]))
        if new is not None and _kept(key64, np.array([i]), np.array([j]), np.array([end[j]]), dropout)[0]:
            heapq.heappush(heap, (-model.score[new], i, j, end[j], new))

    for i in range(n - 1):
        propose(i, i + 1)
    alive = [True] * n
    while heap:
        _, i, j, stop, new = heapq.heappop(heap)
        # stale: a side has been merged since
        if not (alive[i] and alive[j]) or nxt[i] != j or end[j] != stop or model.merge.get((symbols[i], symbols[j])) != new:
            continue
        symbols[i], end[i], nxt[i], alive[j] = new, end[j], nxt[j], False
        if nxt[i] >= 0:
            prev[nxt[i]] = i
        propose(prev[i], i)
        propose(i, nxt[i])
    return [symbols[i] for i in range(n) if alive[i]], [i for i in range(n) if alive[i]]


def together(model: Model, symbols: np.ndarray, size: np.ndarray, key: np.ndarray, dropout: float,
             names: np.ndarray | None = None, skip: np.ndarray | None = None, trace: list | None = None):
    """Many short segments at once (rows of a padded matrix): the highest
    candidate of each per step.  Returns final symbols, first characters, sizes.
    With ``skip``, the candidates skipped are those of this sorted list of
    ``names[row] << 18 | code``, and ``trace`` gets all others that came up."""
    m, width = symbols.shape
    out_s, out_p = np.full((m, width), -2, np.int64), np.zeros((m, width), np.int64)
    out_n = size.copy()
    rows = np.arange(m)
    s = symbols.astype(np.int64)
    place = np.tile(np.arange(width + 1), (m, 1))  # first character of each symbol, then the end
    place = np.minimum(place, size[:, None])

    def candidates(s, place, key, rows, cols):
        r = np.arange(len(s))[:, None]
        left, right = s[r, cols], s[r, cols + 1]
        ok = (left >= 0) & (right >= 0)
        new = np.full(left.shape, -1, np.int64)
        new[ok] = model.into(left[ok].astype(np.uint64) << _U(32) | right[ok].astype(np.uint64), -1.0)
        of, at = np.nonzero(new >= 0)
        c = cols[of, at]
        a, b, e = place[of, c], place[of, c + 1], place[of, c + 2]
        if skip is None:
            keep = _kept(key[of], a, b, e, dropout)
        else:
            code = names[rows[of]] << 18 | a << 12 | b << 6 | e
            keep = np.ones(len(code), bool)
            if len(skip):
                keep = skip[np.minimum(np.searchsorted(skip, code), len(skip) - 1)] != code
            trace.append(code[keep])
        new[of[~keep], at[~keep]] = -1
        return new, model.scores[new]

    if width > 1:
        new, score = candidates(s, place, key, rows, np.tile(np.arange(width - 1), (m, 1)))
    while s.shape[1] > 1 and len(rows):
        best = score.argmax(axis=1)
        live = score[np.arange(len(rows)), best] > _NONE
        if not live.all():
            done = rows[~live]
            w = s.shape[1]
            out_s[done, :w], out_p[done, :w], out_n[done] = s[~live], place[~live, :w], size[~live]
            rows, s, place, new, score, best = (x[live] for x in (rows, s, place, new, score, best))
            key, size = key[live], size[live]
            if not len(rows):
                break
        r = np.arange(len(rows))
        s[r, best] = new[r, best]
        size = size - 1
        w = s.shape[1]
        # close the gap that the right symbol leaves
        cols = np.arange(w - 1) + (np.arange(w - 1) > best[:, None])
        s = np.take_along_axis(s, cols, axis=1)
        place = np.take_along_axis(place, np.arange(w) + (np.arange(w) > best[:, None]), axis=1)
        if w > 2:
            cols = np.arange(w - 2) + (np.arange(w - 2) > best[:, None])
            cols = np.minimum(cols, w - 2)
            new, score = np.take_along_axis(new, cols, axis=1), np.take_along_axis(score, cols, axis=1)
            near = np.stack([np.maximum(best - 1, 0), np.minimum(best, w - 3)], axis=1)
            a, b = candidates(s, place, key, rows, near)
            new[r[:, None], near], score[r[:, None], near] = a, b
    if len(rows):
        w = s.shape[1]
        out_s[rows, :w], out_p[rows, :w], out_n[rows] = s, place[:, :w], size
    return out_s, out_p, out_n


class Encoder:
    """Ids of whole texts under one model, seed and dropout."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED, most: int = 1_000_000):
        self.model, self.dropout = load(path), dropout
        self.seed = K.mix(np.array([seed], np.int64).view(np.uint64))
        # by segment and skipped candidates: ids, and the candidates that were kept
        self.memo, self.traces = K.Memo(most), K.Memo(most)

    def _spell(self, symbols: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of final symbols (unknown ones in bytes) and the number of each."""
        unknown = symbols < 0
        c = chars.astype(np.int64)
        n = np.where(unknown, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
        at = np.cumsum(n) - n
        out = np.zeros(int(n.sum()), np.int64)
        out[at[~unknown]] = symbols[~unknown]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            has = unknown & (n > k)
            shift = 6 * (n[has] - 1 - k)
            byte = c[has] >> shift
            byte = np.where(k == 0, byte | lead[n[has]] * (n[has] > 1), 0x80 | (byte & 0x3F))
            out[at[has] + k] = self.model.bytes[byte & 0xFF]
        return out.astype(np.uint32), n

    def _segments(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray,
                  skip: np.ndarray | None = None, trace: list | None = None):
        """Ids and id counts of segments by their keys, or (short ones) with the
        candidates ``skip`` skipped."""
        size = ends - starts
        if not len(size):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        sym, first, of = [], [], []
        widths = [w for w in (4, 8, 12, 16, 24, 32, SHORT)]
        low = 0
        for w in widths:
            own = np.flatnonzero((size > low) & (size <= w))
            low = w
            for a in range(0, len(own), 1 << 15):
                part = own[a:a + (1 << 15)]
                cols = np.arange(w)
                inside = cols < size[part][:, None]
                at = np.minimum(starts[part][:, None] + cols, len(cp) - 1)
                m = np.where(inside, self.model.char[cp[at]], -2)
                s, p, n = together(self.model, m, size[part], key[part], self.dropout, part, skip, trace)
                valid = np.arange(w) < n[:, None]
                sym.append(s[valid])
                first.append((starts[part][:, None] + p)[valid])
                of.append(np.repeat(part, n))
        for i in np.flatnonzero(size > SHORT).tolist():
            own = self.model.char[cp[starts[i]:ends[i]]].tolist()
            s, p = agenda(self.model, own, int(key[i]), self.dropout)
            sym.append(np.array(s))
            first.append(starts[i] + np.array(p))
            of.append(np.full(len(s), i))
        sym, first, of = np.concatenate(sym), np.concatenate(first), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        ids, n = self._spell(sym[order], cp[first[order]])
        return ids, np.bincount(of[order], weights=n, minlength=len(starts)).astype(np.int64)

    def _remember(self, cp, starts, ends, names, skip) -> None:
        """Add segments under sorted names; ``skip`` as in ``together``."""
        trace: list = [np.zeros(0, np.int64)]
        ids, n = self._segments(cp, starts, ends, np.zeros(len(starts), np.uint64), skip, trace)
        code = np.sort(np.concatenate(trace))
        code = code[np.append(True, code[1:] != code[:-1])[:len(code)]]
        self.memo.add(names, ids, n)
        self.traces.add(names, (code & 0x3FFFF).astype(np.uint32), np.bincount(code >> 18, minlength=len(names)))

    def _drawn(self, uniq, inverse, key):
        """Of occurrences with remembered names: the candidates that their own
        draws skip (codes, and the occurrence of each)."""
        code, n = self.traces.gather(uniq, inverse)
        of = np.repeat(np.arange(len(n)), n)
        skipped = np.flatnonzero(~_above(key[of], _places()[code], self.dropout))
        return code[skipped].astype(np.int64), of[skipped]

    def _occurrences(self, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, key: np.ndarray):
        """Ids and id counts of segments with their own draws."""
        out: list = []  # occurrences, ids and counts of each way
        short = np.flatnonzero(ends - starts <= SHORT)
        own = [np.flatnonzero(ends - starts > SHORT)]

        # no candidate skipped
        uniq, at, inverse = np.unique(h[short], return_index=True, return_inverse=True)
        new = self.memo.missing(uniq)
        self.traces.missing(uniq)
        if len(new):
            first = short[at[new]]
            self._remember(cp, starts[first], ends[first], uniq[new], np.zeros(0, np.int64))
        code, of = self._drawn(uniq, inverse, key[short])
        cut = np.bincount(of, minlength=len(short))
        plain = cut == 0
        out.append((short[plain], *self.memo.gather(uniq, inverse[plain])))

        # the skipped ones of those, if they occur again
        some = np.flatnonzero(~plain)
        name = h[short]
        np.add.at(name, of, K.mix(_places()[code]))
        name = K.mix(name[some])
        uniq, at, inverse, n = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
        new = self.memo.missing(uniq)
        self.traces.missing(uniq)
        known = np.ones(len(uniq), bool)
        known[new[n[new] == 1]] = False
        new = new[n[new] > 1]
        if len(new):
            first = some[at[new]]
            begin = np.searchsorted(of, first)
            skip = np.repeat(np.arange(len(new)), cut[first]) << 18 | code[K.ragged(begin, cut[first])]
            self._remember(cp, starts[short[first]], ends[short[first]], uniq[new], np.sort(skip))
        again = known[inverse]
        own.append(short[some[~again]])
        some, uniq, inverse = some[again], uniq[known], (np.cumsum(known) - 1)[inverse[again]]
        _, more = self._drawn(uniq, inverse, key[short[some]])
        done = np.bincount(more, minlength=len(some)) == 0
        out.append((short[some[done]], *self.memo.gather(uniq, inverse[done])))

        # all others
        own.append(short[some[~done]])
        rest = np.concatenate(own)
        out.append((rest, *self._segments(cp, starts[rest], ends[rest], key[rest])))
        of, ids, n = (np.concatenate(x) for x in zip(*out))
        order = np.empty(len(of), np.int64)
        order[of] = np.arange(len(of))
        return ids[K.ragged((np.cumsum(n) - n)[order], n[order])], n[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one row after another, and each row's number of
        ids; ``doc`` holds 64-bit names of the rows' documents."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        # a space before every row that has text
        full = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[full], 32)
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        lead = (data & 0xC0) != 0x80
        upto = np.concatenate([[0], np.cumsum(lead)])
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        edge = upto[offsets]
        space = cp == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[edge[:-1][full]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(cp))
        row = np.searchsorted(edge, starts, side="right") - 1
        h = K.value_hashes(K.mix(cp.astype(np.uint64)), starts, ends)
        if self.dropout > 0:
            place = K.mix(doc[row].astype(np.uint64)) + (starts - edge[row]).astype(np.uint64)
            ids, n = self._occurrences(cp, starts, ends, h, K.mix(h ^ self.seed ^ K.mix(place)))
        else:
            uniq, at, inverse = np.unique(h, return_index=True, return_inverse=True)
            new = self.memo.missing(uniq)
            if len(new):
                self.memo.add(uniq[new], *self._segments(cp, starts[at[new]], ends[at[new]], uniq[new]))
            ids, n = self.memo.gather(uniq, inverse)
        return ids, np.bincount(row, weights=n, minlength=rows).astype(np.int64)


def _document(id_col: str, text_col: str):
    """64-bit name of a document."""
    return F.xxhash64(F.col(id_col).cast("string"),
                      F.when(F.col(id_col).isNull(), F.col(text_col).cast("string")))


def encode(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of whole texts."""
    Work(docs.sparkSession, "merge-dropout")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = Encoder(model_path, dropout, seed)
        for batch in batches:
            doc = batch.column("v").to_numpy()
            for i, j, data, offsets in K.text_slices(batch.column("text")):
                ids, n = coder.encode(data, offsets, doc[i:j])
                ends = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("id").slice(i, j - i),
                    "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       _document(id_col, text_col).alias("v")).mapInArrow(
        run, f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, text``: the texts of encoded rows."""
    Work(encoded.sparkSession, "merge-dropout")
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        model = load(model_path)
        for batch in batches:
            for a in range(0, len(batch), 1000):
                part = batch.slice(a, 1000)
                lists = part.column("ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = [x.decode("utf-8") for x in model.decode_rows(flat, n)]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "ids": lists,
                                                  "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, ids array<int>, text string")


def round_trip(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded_sha256, lossless`` of whole texts,
    encoded and decoded in one pass."""
    Work(docs.sparkSession, "merge-dropout")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = Encoder(model_path, dropout, seed)
        for batch in batches:
            doc = batch.column("v").to_numpy()
            for i, j, data, offsets in K.text_slices(batch.column("text")):
                ids, n = coder.encode(data, offsets, doc[i:j])
                texts = coder.model.decode_rows(ids.astype(np.int64), n)
                raw, source = memoryview(ids.tobytes()), data.tobytes()
                ends = np.concatenate([[0], np.cumsum(n)]).tolist()
                own = offsets.tolist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("id").slice(i, j - i), "n_tokens": pa.array(n, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                    "lossless": pa.array([x == source[a:b] for x, a, b in zip(texts, own[:-1], own[1:])])})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       _document(id_col, text_col).alias("v")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, ids_crc32 long, decoded_sha256 string, lossless boolean")
