"""Byte-level BPE ids of whole texts, encoding each distinct piece of text once.

The tokenizers library encodes well under a megabyte a second per core.  Its
byte-level pre-tokenizer never joins text across a single space (or a single
line feed) that stands between two visible characters, nor across a change
between letters, digits and punctuation other than the apostrophe.  So a text
can be cut there without changing its ids.  Each task cuts its texts, encodes
the distinct pieces with the library, and gathers the ids of every text from
them.  A piece of one class is one pre-token: it goes to the tokenizer's model
directly; all others go through the whole tokenizer.

A text that holds the string of an added token (<|endoftext|>) gets that token's
id there, as from the library.  The library takes added tokens out first, the
leftmost and longest, and treats what is between them as texts of their own; so
they are pieces, and their ends are cut as the ends of a text.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from sparkcount.llm import kernels as K

# Bytes that are, or begin, white space of the pre-tokenizer's pattern.
_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
# Class of a byte: 1 letter, 2 digit, 3 punctuation, 0 any other.  The two-byte
# characters that 0xC3-0xC5, 0xD0 and 0xD1 begin are letters, but for U+00D7
# and U+00F7; a continuation byte counts with its lead byte.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 3
_CLASS[39] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = 1
_CLASS[0x80:0xC0] = 1


def _classes(data: np.ndarray) -> np.ndarray:
    c = _CLASS[data]
    sign = (data[1:] == 0x97) | (data[1:] == 0xB7)
    c[1:][sign & (data[:-1] == 0xC3)] = 0
    return c


def cut_points(data: np.ndarray, offsets: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Starts of the pieces: row starts, lone spaces, lone line feeds and what
    follows them, changes of class."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    if n:
        visible = ~_WS[data]
        lead = _LEAD[data]
        # the character before ends here and is no multi-byte white space
        solid = visible.copy()
        wide = data >= 0x80
        solid[1:] &= ~(wide[1:] & lead[:-1])
        solid[2:] &= ~(wide[2:] & lead[:-2])
        ok = np.zeros(n, bool)
        ok[1:-1] = solid[:-2] & visible[2:] & ~lead[2:]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        ok &= ~edge[:n] & ~edge[1:]
        start[:n] |= ok & (data == 32)
        feed = np.flatnonzero(ok & (data == 10))
        start[feed] = True
        start[feed + 1] = True
        # a continuation byte after a lead of no class is inside a character
        whole = cls.copy()
        whole[1:][(data[1:] >= 0x80) & (data[1:] < 0xC0) & (cls[:-1] == 0)] = 0
        whole[2:][(data[2:] >= 0x80) & (data[2:] < 0xC0) & (whole[1:-1] == 0)] = 0
        whole[3:][(data[3:] >= 0x80) & (data[3:] < 0xC0) & (whole[2:-1] == 0)] = 0
        start[1:n] |= (whole[1:] != whole[:-1]) & (whole[1:] > 0) & (whole[:-1] > 0)
        start[offsets] = True
    return np.flatnonzero(start[:n])


def _byte_alphabet() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer of a file, once per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """One tokenizer with the ids of the pieces seen so far (a bounded memo)."""

    def __init__(self, path: str, max_pieces: int = 1_000_000):
        self.tok = load(path)
        self.model = self.tok.model
        self.alphabet = {b: c for b, c in _byte_alphabet().items() if b != 10}
        self.memo = K.Memo(max_pieces)
        added = self.tok.get_added_tokens_decoder().values()
        for t in added:
            if t.lstrip or t.rstrip or t.single_word or t.normalized and self.tok.normalizer is not None:
                raise ValueError(f"the added token {t.content!r} takes in what is around it")
        names = sorted((t.content.encode() for t in added if t.content), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row edges and those of the added tokens in the rows; starts of the tokens."""
        found, at = [], 0
        while self.added is not None and (m := self.added.search(raw, at)):
            # no token goes over the end of a row
            row = int(np.searchsorted(offsets, m.start(), side="right"))
            if m.end() > offsets[row]:
                m = self.added.search(raw, m.start(), int(offsets[row]))
            if m is not None:
                found.append((m.start(), m.end()))
            at = m.end() if m is not None else int(offsets[row])
        if not found:
            return offsets, np.zeros(0, np.int64)
        return np.unique(np.concatenate([offsets, np.ravel(found)])), np.array(found)[:, 0]

    def _pieces(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, single: np.ndarray):
        """Ids and numbers of ids of pieces; ``single`` marks those of one pre-token."""
        out: list = [None] * len(starts)
        cut = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        one = np.flatnonzero(single).tolist()
        if one:
            names = b"\n".join([cut[k] for k in one]).decode("latin-1").translate(self.alphabet)
            tokenize = self.model.tokenize
            for k, name in zip(one, names.split("\n")):
                out[k] = [t.id for t in tokenize(name)]
        rest = np.flatnonzero(~single).tolist()
        if rest:
            found = self.tok.encode_batch_fast([cut[k].decode("utf-8", "replace") for k in rest],
                                               add_special_tokens=False)
            for k, x in zip(rest, found):
                out[k] = x.ids
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((i for x in out for i in x), np.uint32, int(lengths.sum())), lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one row after another, and each row's number of ids."""
        cls, raw = _classes(data), data.tobytes()
        edges, added = self._with_added(raw, offsets)
        starts = cut_points(data, edges, cls)
        if len(added):  # an added token is one piece
            upto = np.searchsorted(added, starts, side="right") - 1
            ends = edges[np.searchsorted(edges, added, side="right")]
            starts = starts[(upto < 0) | (starts >= ends[upto]) | (starts == added[upto])]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        h = K.span_hashes(data, starts, ends)
        uniq, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        new = self.memo.missing(uniq)
        if len(new):
            s, e = starts[at[new]], ends[at[new]]
            # after a leading space, all bytes of one class
            inner = s + (data[s] == 32)
            single = np.zeros(len(s), bool)
            for k in (1, 2, 3):
                of = np.zeros(len(data) + 1, np.int32)
                np.cumsum(cls == k, out=of[1:])
                single |= (of[e] - of[inner] == e - inner) & (e > inner)
            ids, lengths = self._pieces(raw, s, e, single)
            self.memo.add(uniq[new], ids, lengths)
        ids, lengths = self.memo.gather(uniq, inverse)
        row = np.searchsorted(offsets, starts, side="right") - 1
        return ids, np.bincount(row, weights=lengths, minlength=len(offsets) - 1).astype(np.int64)
