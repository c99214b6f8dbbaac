"""N-gram Jaccard join with signature trees.

A document's set holds the hashes of its distinct ``k``-word shingles.  Two sets
link when ``den * intersection >= num * union``.

1. Documents with equal sets are one node.  Sets are ordered by a fixed global
   order of shingles, rare first, and a set's prefix of ``n - ceil(num/den n) + 1``
   shingles must meet the prefix of any set that it links with.  The order looks
   up the most frequent shingles in a bounded list; it steers speed only, any
   order gives the same links.
2. Sets whose prefixes share a shingle form a group (equal groups fold).  A member
   stays in it only if another member's size can match and, were the shingle the
   first that both share, enough shingles follow it on both sides.  Linked sets
   pass both in the group of their first common shingle.
3. Every group is searched with a *signature tree*: a node holds the OR of its
   members' bitmaps and their size range; two trees are walked together and a
   pair of nodes is left when the sizes cannot match or when more bits of one
   side are missing on the other than any link allows.  What remains joins
   candidate clusters; members already joined are not tested again.
4. The sets of each cluster meet once, the trees are walked again, and pairs that
   survive are compared exactly.  Map tasks send only sets that a Bloom filter of
   the clusters' members (at most ``BLOOM_BITS`` bits) does not rule out.

A bitmap has two to four bits per shingle.  A shingle whose count in the list of
frequent ones passes ``block`` deals its sets into blocks before the shuffle, and
groups and clusters larger than ``block`` are dealt likewise: pairs of blocks
are the tasks.

Defined cases: no words or a null text is an empty set, linked with nothing;
fewer than ``k`` words are one shingle; copies and repeated rows share a node;
null ids get the smallest id of their component, if any; an empty table gives
no rows; other columns are ignored.  Shingles are 64-bit hashes; should two
different sets get one 64-bit name, all are named anew with another salt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkcount.llm import kernels as K
from sparkcount.llm.components import connected_components
from sparkcount.llm.storage import Work

WORDS = 5
NUM, DEN = 80, 100
FREQUENT = 1 << 20  # most entries of the list of frequent shingles
COMMON = 32
BLOCK = 4096
MAX_BITS = 1 << 18
BLOOM_BITS = 1 << 26
PAIRWISE = 32  # largest group whose members are held against each other by size and place
SLICE = 1 << 20

_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles and their rows, sorted by (row, hash)."""
    low = K.LOWER[data]
    starts, ends, row = K.word_spans(low, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    w = K.span_hashes(low, starts, ends)
    rows = len(offsets) - 1
    words = K.row_counts(row, rows)
    h = np.zeros(len(w), np.uint64)
    for j in range(k):  # position-dependent combination of the k words
        h[:max(len(w) - j, 0)] += K.mix(w[j:] + _U(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
    last = np.cumsum(words)
    whole = np.arange(len(w)) + k <= last[row]
    h, of = K.mix(h[whole]), row[whole]
    few = np.flatnonzero((words > 0) & (words < k))
    if len(few):
        first = last[few] - words[few]
        short = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = words[few] > j
            short[has] += K.mix(w[first[has] + j] + _U(0xC2B2AE3D27D4EB4F * (j + 1) % (1 << 64)))
        h = np.concatenate([h, K.mix(short + words[few].astype(np.uint64))])
        of = np.concatenate([of, few])
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return h[first], of[first]


def _bits(n: int) -> int:
    """Bits of the bitmap of a set of ``n`` shingles."""
    return min(MAX_BITS, 1 << max(6, (2 * n - 1).bit_length()))


def signature(h: np.ndarray) -> bytes:
    """Bitmap of the shingles."""
    bits = _bits(len(h))
    out = np.zeros(bits, bool)
    out[(h & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def set_names(h: np.ndarray, edge: np.ndarray, salt: int) -> np.ndarray:
    """64-bit name of every set ``h[edge[i]:edge[i + 1]]``."""
    return np.add.reduceat(K.mix(h ^ _U((0x5851F42D4C957F2D + 2 * salt) % (1 << 64))), edge)


def needed(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of linked sets of sizes ``a`` and ``b``."""
    return -(-num * (a + b) // (num + den))


def _fold(sig: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        sig = (sig >> bits) | (sig & ((1 << bits) - 1))
    return sig


class Node:
    """A set (leaf) or some nodes: OR of the bitmaps, size range, fewest bits."""

    __slots__ = ("sig", "bits", "lo", "hi", "few", "at", "kids", "joined")

    def __init__(self, sig=0, bits=0, size=0, at=-1, kids=()):
        self.at, self.kids, self.joined = at, kids, not kids
        if kids:
            self.bits = min(c.bits for c in kids)
            self.lo, self.hi = min(c.lo for c in kids), max(c.hi for c in kids)
            self.sig, self.few = 0, 1 << 62
            for c in kids:
                s = _fold(c.sig, c.bits, self.bits)
                self.sig |= s
                # a child's fewest bits may shrink when its bitmaps are folded
                self.few = min(self.few, s.bit_count() if not c.kids else
                               (c.few if c.bits == self.bits else 0))
        else:
            self.sig, self.bits, self.lo, self.hi = sig, bits, size, size
            self.few = sig.bit_count()


def tree(members: list[tuple[int, int, int, int]], fan: int = 4) -> Node | None:
    """Signature tree of ``(at, size, low hash, bitmap as int)``, similar sets side by side."""
    if not members:
        return None
    order = sorted(members, key=lambda m: (m[1].bit_length(), m[2], m[1]))
    level = [Node(sig, _bits(n), n, at) for at, n, _, sig in order]
    while len(level) > 1:
        level = [Node(kids=tuple(level[i:i + fan])) for i in range(0, len(level), fan)]
    return level[0]


class Joined:
    """Union-find over the members of a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def one(self, node: Node) -> int:
        """The common root of a node's members, -1 if there are several."""
        if not node.kids:
            return self.find(node.at)
        if node.joined:
            leaf = node
            while leaf.kids:
                leaf = leaf.kids[0]
            return self.find(leaf.at)
        roots = {self.one(c) for c in node.kids}
        if len(roots) == 1 and -1 not in roots:
            node.joined = True
            return roots.pop()
        return -1


def walk(a: Node | None, b: Node | None, num: int, den: int, joined: Joined, linked, every: bool = False) -> None:
    """Walk two trees (or one with itself); ``linked(i, j)`` decides what the
    bitmaps leave open.  Without ``every``, joined members are not tested again."""
    stack = [(a, b)] if a is not None and b is not None else []
    while stack:
        x, y = stack.pop()
        if x is y:
            kids = x.kids
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))
                      if i != j or kids[i].kids]
            continue
        if x.hi * den < num * y.lo or y.hi * den < num * x.lo:
            continue
        leaves = not x.kids and not y.kids
        if not every:
            root = joined.one(x)
            if root >= 0 and root == joined.one(y):
                continue
        bits = min(x.bits, y.bits)
        s, t = _fold(x.sig, x.bits, bits), _fold(y.sig, y.bits, bits)
        if leaves:
            least = needed(x.lo, y.lo, num, den)
            if (s & ~t).bit_count() > x.lo - least or (t & ~s).bit_count() > y.lo - least:
                continue
            if linked(x.at, y.at):
                joined.join(x.at, y.at)
            continue
        both = (s & t).bit_count()
        if x.bits == bits and x.few - both > x.hi - needed(x.hi, y.lo, num, den):
            continue
        if y.bits == bits and y.few - both > y.hi - needed(y.hi, x.lo, num, den):
            continue
        if x.kids and (not y.kids or x.hi - x.lo >= y.hi - y.lo):
            stack += [(c, y) for c in x.kids]
        else:
            stack += [(x, c) for c in y.kids]


def _sets(docs: DataFrame, k: int, salt: int) -> DataFrame:
    """Per document its node (with the bitmap at the node's first document of a
    slice), and the shingles that several sets of a task share."""

    def read(batches):
        for batch in batches:
            ids = batch.column("id")
            for i, j, data, offsets in K.text_slices(batch.column("text"), SLICE):
                h, row = shingle_sets(data, offsets, k)
                rows = j - i
                n = K.row_counts(row, rows)
                edge = np.cumsum(n) - n
                full = np.flatnonzero(n)
                node, check, low = (np.zeros(rows, np.uint64) for _ in range(3))
                if len(h):
                    node[full] = set_names(h, edge[full], salt)
                    check[full] = np.add.reduceat(K.mix(h ^ _U(0x14057B7EF767814F)), edge[full])
                    low[full] = h[edge[full]]
                # a set counts once, however many documents of the slice have it
                _, one = np.unique(node[full], return_index=True)
                own = np.zeros(rows, bool)
                own[full[one]] = True
                sigs = [signature(h[a:a + c]) if o else None for a, c, o in zip(edge.tolist(), n.tolist(), own.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "id": ids.slice(i, rows), "n": pa.array(n, pa.int64()),
                    "node": pa.array(node.view(np.int64)), "check": pa.array(check.view(np.int64)),
                    "low": pa.array(low.view(np.int64)), "sig": pa.array(sigs, pa.binary()),
                    "key": pa.nulls(rows, pa.int64()), "seen": pa.nulls(rows, pa.int64())})
                keys, seen = np.unique(h[own[row]], return_counts=True)
                keys, seen = keys[seen > 1], seen[seen > 1]
                m = len(keys)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.nulls(m, ids.type), "n": pa.nulls(m, pa.int64()), "node": pa.nulls(m, pa.int64()),
                    "check": pa.nulls(m, pa.int64()), "low": pa.nulls(m, pa.int64()), "sig": pa.nulls(m, pa.binary()),
                    "key": pa.array(keys.view(np.int64)), "seen": pa.array(seen, pa.int64())})

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(read, f"id {id_type}, n long, node long, check long, low long, sig binary, "
                                 "key long, seen long")


def _postings(docs: DataFrame, k: int, num: int, den: int, salt: int, block: int, frequent) -> DataFrame:
    """``key, node, n, place``: the prefix of every set, rare shingles first, with
    the set's size and the shingle's place.  A shingle of more than ``block`` sets
    has a key for every pair of its blocks."""

    def prefix(batches):
        keys, seen = frequent.value
        rank = np.log2(np.maximum(seen, 1)).astype(np.int64) + 1
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column("text"), SLICE):
                h, row = shingle_sets(data, offsets, k)
                n = K.row_counts(row, j - i)
                full = np.flatnonzero(n)
                if not len(full):
                    continue
                edge = np.cumsum(n) - n
                node = np.zeros(j - i, np.uint64)
                node[full] = set_names(h, edge[full], salt)
                cls, blocks = np.zeros(len(h), np.int64), np.ones(len(h), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    known = keys[at] == h
                    cls = np.where(known, rank[at], 0)
                    blocks = np.where(known, seen[at] // block + 1, 1)
                order = np.lexsort((h, cls, row))
                h, blocks = h[order], blocks[order]  # rows keep their places
                place = np.arange(len(h)) - edge[row]
                # equal sets of a slice have equal prefixes: the first one's is enough
                _, one = np.unique(node[full], return_index=True)
                own = np.zeros(j - i, bool)
                own[full[one]] = True
                take = np.flatnonzero(own[row] & (place <= (n - -(-num * n // den))[row]))
                take = np.repeat(take, blocks[take])
                key, names, many = h[take], node[row[take]], blocks[take]
                hot = np.flatnonzero(many > 1)
                if len(hot):
                    fresh = np.ones(len(hot), bool)
                    fresh[1:] = take[hot[1:]] != take[hot[:-1]]
                    first = np.flatnonzero(fresh)
                    other = np.arange(len(hot)) - np.repeat(first, np.diff(np.append(first, len(hot))))
                    mine = (K.mix(names[hot]) % many[hot].astype(np.uint64)).astype(np.int64)
                    pair = np.minimum(mine, other) * many[hot] + np.maximum(mine, other) + 1
                    key[hot] = K.mix(key[hot] + K.mix(pair.astype(np.uint64)))
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(key.view(np.int64)), "node": pa.array(names.view(np.int64)),
                    "n": pa.array(n[row[take]].astype(np.int32)), "place": pa.array(place[take].astype(np.int32))})

    return docs.select("text").mapInArrow(prefix, "key long, node long, n int, place int")


def _runs(*ids: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts."""
    start = np.ones(len(ids[0]), bool)
    start[1:] = False
    for x in ids:
        start[1:] |= x[1:] != x[:-1]
    return start


def _matched(group: np.ndarray, n: np.ndarray, left: np.ndarray, num: int, den: int) -> np.ndarray:
    """Members (sorted by group) that a partner may link with by size ``n`` and by
    the ``left`` shingles from the common one on; groups over ``PAIRWISE`` members
    are only held against their smallest member."""
    edge = np.flatnonzero(_runs(group))
    size = np.diff(np.append(edge, len(group)))
    small = np.repeat(np.minimum.reduceat(n, edge), size) if len(edge) else n
    least = np.maximum(small, -(-num * n // den))
    alive = (left >= -(-num * (n + least) // (num + den))) & np.repeat(size > 1, size)
    for g in np.unique(size[(size > 1) & (size <= PAIRWISE)]):
        at = edge[size == g][:, None] + np.arange(g)
        ok = np.zeros(at.shape, bool)
        for i in range(g):
            for j in range(i + 1, g):
                x, y = at[:, i], at[:, j]
                pair = np.minimum(left[x], left[y]) >= -(-num * (n[x] + n[y]) // (num + den))
                ok[:, i] |= pair
                ok[:, j] |= pair
        alive[at] &= ok
    return alive


def _groups(num: int, den: int):
    """``gid, node, size`` of the keys that several nodes share and may link at;
    equal groups get one name."""

    def emit(key, node, n, place):
        order = np.lexsort((node, n, key))
        key, node, n, left = key[order], node[order], n[order].astype(np.int64), (n - place)[order].astype(np.int64)
        fresh = _runs(key, node)
        key, node, n, left = key[fresh], node[fresh], n[fresh], left[fresh]
        # sizes too far apart for any link begin another group
        start = _runs(key)
        start[1:] |= n[:-1] * den < num * n[1:]
        group = np.cumsum(start)
        alive = _matched(group, n, left, num, den)
        group, node = group[alive], node[alive]
        edge = np.flatnonzero(_runs(group)) if len(group) else group
        size = np.diff(np.append(edge, len(group)))
        if not len(size):
            return None
        name = np.add.reduceat(K.mix(node.view(np.uint64) + _U(0xA0761D6478BD642F)), edge)
        name = K.mix(name + size.astype(np.uint64))
        several = np.repeat(size > 1, size)
        gid, node, size = np.repeat(name, size)[several], node[several], np.repeat(size, size)[several]
        if not len(gid):
            return None
        _, one = np.unique(K.mix(gid + K.mix(node.view(np.uint64))), return_index=True)
        return pa.RecordBatch.from_pydict({
            "gid": pa.array(gid[one].view(np.int64)), "node": pa.array(node[one]), "size": pa.array(size[one])})

    def run(batches):
        held, last = [], None  # the rows of the last key, which may go on
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("key", "node", "n", "place")]
            if not len(batch):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if cols[0][-1] != last else 0
            if cut or (held and cols[0][0] != last):
                out = emit(*(np.concatenate(c) for c in zip(*held, [c[:cut] for c in cols])))
                if out is not None:
                    yield out
                held = []
            held.append([c[cut:] for c in cols])
            last = cols[0][-1]
        if held:
            out = emit(*(np.concatenate(c) for c in zip(*held)))
            if out is not None:
                yield out

    return run


def _dealt(members: DataFrame, size: str, block: int) -> DataFrame:
    """Rows of each task, with ``i, j, block``: groups of more than ``block``
    members are dealt into blocks, and each pair of blocks (i <= j) gets the rows of both."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select(
        *[c for c in members.columns if c != size], "block", F.least("block", "o").alias("i"),
        F.greatest("block", "o").alias("j"))


def _searched(rows: DataFrame, group: str, num: int, den: int, exact: bool, every: bool) -> DataFrame:
    """Walk the trees of every group: spanning edges ``a, b`` (every link with ``every``)."""

    def task(part):
        part.sort(key=lambda r: (r[1], r[0]))
        joined, found = Joined(len(part)), []
        trees = {}
        sets = [np.frombuffer(r[2], np.uint64) for r in part] if exact else []
        if exact:  # size, lowest hash and bitmap follow from the set
            part = [[*r[:2], len(h), int(h[:1].view(np.int64)[0]), signature(h)] for r, h in zip(part, sets)]
        for blk in {r[1] for r in part}:
            trees[blk] = tree([(p, r[2], r[3], int.from_bytes(r[4], "little"))
                               for p, r in enumerate(part) if r[1] == blk])

        def linked(p, q):
            if not exact:
                return True
            x, y = sets[p], sets[q]
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[at] == x).sum())
            if den * common < num * (len(x) + len(y) - common):
                return False
            if every:
                found.append((p, q, common))
            return True

        names = sorted(trees)
        walk(trees[names[0]], trees[names[-1]], num, den, joined, linked, every)
        if every:
            return [(part[p][0], part[q][0], c) for p, q, c in found]
        return [(part[joined.find(p)][0], part[p][0], 0) for p in range(len(part)) if joined.find(p) != p]

    carried = ("shingles",) if exact else ("n", "low", "sig")

    def run(batches):
        current, part, out = None, [], []

        def close():
            i, j = current[1], current[2]
            # a pair of different blocks that came without one of them links nothing new
            if len(part) > 1 and (i == j or len({r[1] for r in part}) == 2):
                out.extend(task(part))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (group, "i", "j", "node", "block", *carried)]
            for g, i, j, *row in zip(*cols):
                if (g, i, j) != current:
                    if part:
                        close()
                    current, part = (g, i, j), []
                part.append(row)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip("abc", e)) for e in out], EDGES)
                out.clear()
        if part:
            close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip("abc", e)) for e in out], EDGES)

    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j").mapInArrow(
        run, "a long, b long, c long")


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())])


def _places(node: np.ndarray, whose: np.ndarray, bits: int) -> np.ndarray:
    """Two bits of a Bloom filter for every (set name, id hash)."""
    name = K.mix(node.view(np.uint64) + K.mix(whose.view(np.uint64)))
    return np.stack([name % _U(bits), K.mix(name) % _U(bits)])


def _bloom(chosen: DataFrame) -> np.ndarray:
    """Bloom filter of ``node, whose``: sixteen bits for each, at most ``BLOOM_BITS``."""
    bits = min(BLOOM_BITS, 1 << max(10, (16 * chosen.count()).bit_length()))

    def read(batches):
        out = np.zeros(bits, bool)
        for batch in batches:
            out[_places(*(np.asarray(batch.column(i)) for i in range(2)), bits).ravel()] = True
        words = np.packbits(out, bitorder="little").view(np.uint32)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"word": pa.array(used), "bits": pa.array(words[used].astype(np.int64))})

    words = chosen.select("node", "whose").mapInArrow(read, "word long, bits long").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.view(np.uint8)


def _set_rows(docs: DataFrame, k: int, salt: int, bloom) -> DataFrame:
    """``node, whose, shingles``: the whole sorted set of each row that the Bloom
    filter lets through, by its name and the hash of its id, each pair once per slice."""

    def read(batches):
        wanted = np.unpackbits(bloom.value, bitorder="little").astype(bool)
        for batch in batches:
            whose = np.asarray(batch.column(0))
            for i, j, data, offsets in K.text_slices(batch.column(1), SLICE):
                h, row = shingle_sets(data, offsets, k)
                n = K.row_counts(row, j - i)
                full = np.flatnonzero(n)
                if not len(full):
                    continue
                edge = (np.cumsum(n) - n)[full]
                node, own = set_names(h, edge, salt).view(np.int64), whose[i:j][full]
                _, one = np.unique(np.stack([node, own]), axis=1, return_index=True)
                one = one[wanted[_places(node[one], own[one], len(wanted))].all(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[one]), pa.array(own[one]),
                     pa.array([h[a:a + c].tobytes() for a, c in zip(edge[one].tolist(), n[full][one].tolist())],
                              pa.binary())], ["node", "whose", "shingles"])

    return docs.mapInArrow(read, "node long, whose long, shingles binary")


def _named_sets(rows: DataFrame, k: int, work: Work) -> tuple[DataFrame, int]:
    """The written rows of ``_sets`` and the salt under which names are unique."""
    salt = 0
    while True:
        first = work.cut(_sets(rows, k, salt), "sets")
        clash = first.where("n > 0").groupBy("node").agg(
            F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y")
        if clash.isEmpty():  # else expected below once in 10^8 corpora of 10^6 documents
            return first, salt
        salt += 1


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                 num: int = NUM, den: int = DEN, block: int = BLOCK, every: bool = False):
    """``(documents, links, work)``: ``documents`` has ``doc_id, n_shingles, node`` and,
    through ``links (a, b, c)``, its class.  ``links`` holds a spanning set of
    the links between nodes, or with ``every`` each link with its intersection.
    ``work.salt`` is the salt of the nodes' names."""
    spark = docs.sparkSession
    work = Work(spark, "ngram")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    first, salt = _named_sets(rows, k, work)
    work.salt = salt
    members = first.where("n is not null").select("id", "n", "node", "low", "sig")
    # the bounded list that the global order puts last, by rising frequency
    top = first.where("key is not null").groupBy("key").agg(F.sum("seen").alias("seen")).where(
        F.col("seen") >= COMMON).orderBy(F.desc("seen"), "key").limit(FREQUENT).toPandas()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    frequent = spark.sparkContext.broadcast((keys[order], top["seen"].to_numpy(np.int64)[order]))
    groups = work.cut(_postings(rows, k, num, den, salt, block, frequent).repartition("key").sortWithinPartitions(
        "key").mapInArrow(_groups(num, den), "gid long, node long, size long").distinct(), "groups")
    # groups are dealt before their members' bitmaps join them
    nodes = members.where("n > 0").groupBy("node").agg(
        F.min("n").alias("n"), F.min("low").alias("low"), F.first("sig", ignorenulls=True).alias("sig"))
    near = _dealt(groups, "size", block).join(nodes, "node")
    candidates = work.cut(_searched(near, "gid", num, den, exact=False, every=False).select("a", "b"), "candidates")
    tied = connected_components(candidates, work)
    cluster = tied.select(F.col("id").alias("node"), F.col("root").alias("cluster"))
    cluster = work.cut(cluster.unionByName(
        cluster.select(F.col("cluster").alias("node"), "cluster").distinct()), "clusters")
    sizes = cluster.groupBy("cluster").agg(F.count("*").alias("size"))
    # one document per node of a cluster brings its whole set, known by its name and
    # its id's hash (ids may be null or repeated)
    ids = members.where("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    chosen = work.cut(cluster.join(sizes, "cluster").join(ids, "node").select(
        "node", "cluster", "size", F.xxhash64("id").alias("whose")), "chosen")
    bloom = spark.sparkContext.broadcast(_bloom(chosen))
    sets = _set_rows(rows.select(F.xxhash64("id").alias("whose"), "text"), k, salt, bloom).join(
        chosen, ["node", "whose"]).dropDuplicates(["node"])
    whole = _dealt(sets.select("cluster", "node", "size", "shingles"), "size", block)
    links = work.cut(_searched(whole, "cluster", num, den, exact=True, every=every), "links")
    return members.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "node"), links, work


def _classes(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, block: int):
    """``classes`` and the salt of its nodes."""
    members, links, work = jaccard_join(docs, id_col, text_col, k, num, den, block)
    comp = connected_components(links.select("a", "b"), work)
    rooted = work.cut(members.join(comp.withColumnRenamed("id", "node"), "node", "left").select(
        "doc_id", "n_shingles", "node", F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")).alias("root")), "rooted")
    least = work.cut(rooted.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("component_id")), "least")
    return rooted.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "node",
        "root"), work.salt


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
            num: int = NUM, den: int = DEN, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, node, root`` of every row: the smallest
    id that its links reach, the name of its set, and that of its class."""
    return _classes(docs, id_col, text_col, k, num, den, block)[0]


def _with_node(docs: DataFrame, text_col: str, k: int, salt: int) -> DataFrame:
    """``row`` (all of ``docs`` as one struct), the name ``node`` and the size ``n`` of each row's set."""
    packed = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"),
                         F.col(text_col).cast("string").alias("text"))
    schema = StructType([packed.schema["row"], StructField("node", LongType()), StructField("n", LongType())])

    def read(batches):
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column(1), SLICE):
                h, row = shingle_sets(data, offsets, k)
                n = K.row_counts(row, j - i)
                full = np.flatnonzero(n)
                node = np.zeros(j - i, np.uint64)
                if len(h):
                    node[full] = set_names(h, (np.cumsum(n) - n)[full], salt)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(node.view(np.int64)), pa.array(n)], ["row", "node", "n"])

    return packed.mapInArrow(read, schema)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS,
                    num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with all its columns: one document of each class (the smallest
    id), and every document that has no words."""
    work = Work(docs.sparkSession, "ngram-kept")
    found, salt = _classes(docs, id_col, text_col, k, num, den, BLOCK)
    # the smallest (id, set) of a class, and how many rows have both
    kept = work.cut(found.where("n_shingles > 0").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(
        "root", "component_id", "node").agg(F.count("*").alias("copies")).groupBy("root").agg(
        F.min(F.struct("component_id", "node", "copies")).alias("m")).select("m.*"), "rows")
    marked = _with_node(docs, text_col, k, salt)
    names = kept.select(F.col("component_id").alias("kept_id"), F.col("node").alias("kept_node"), "copies")

    def rows(of: DataFrame, how: str) -> DataFrame:
        return marked.where("n > 0").join(of, F.col("row").getField(id_col).eqNullSafe(F.col("kept_id"))
                                          & (F.col("node") == F.col("kept_node")), how)

    out = rows(names.where("copies = 1"), "left_semi").select("row").unionByName(marked.where("n = 0").select("row"))
    repeated = names.where("copies > 1")
    if not repeated.isEmpty():
        out = out.unionByName(rows(repeated, "inner").dropDuplicates(["kept_id", "kept_node"]).select("row"))
    return out.select("row.*")
