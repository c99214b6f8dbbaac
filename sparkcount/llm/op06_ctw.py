"""Context-tree weighting over bytes, and a word-count base, as Spark jobs.

A text is the sequence of its bytes (A-Z lower-cased) and one end symbol, 0xFF,
which also stands before its start.  Each byte is eight binary decisions; each
decision (the bits before it in the byte: a ``node`` of 1..255) has its own
context tree over the ``depth`` bytes before.  A tree node with ``a`` zeros and
``b`` ones in training has the Krichevsky-Trofimov probability ``KT(a, b)``, and
weighting mixes all depths: ``Pw = (KT + product of the children's Pw) / 2``
(``Pw = KT`` at full depth).  A decision's probability is the mixture of the KT
predictions along its path with the weights that training has left there.

A *part* is a set of texts of about ``PART_BYTES``, a *bucket* all contexts whose
last three bytes hash alike.  N-grams travel packed: one row holds a part's n-grams
of one bucket as sorted, compressed byte planes.  Jobs: (1) the packed distinct n-grams and
words of every part with their training counts; (2) summed per bucket, and
bottom-up within it each node's counts and the sum of its children's log Pw;
(3) the depths above as aggregates and joins; (4) top-down within each bucket, the
mixture so far and the weight left for deeper nodes, and per n-gram the
log-probability of its last byte; (5) every part's packed rows get their values;
(6) each part scores its texts against them.  Nothing that grows with the corpus is
broadcast or collected: the dictionary a task holds is that of one part, the
buckets' number follows the corpus, and no context of three bytes has more than
``256 ** (depth - 2)`` n-grams.  With many parts a bucket's rows are merged and
answered under several salts.  N-grams of texts outside training take part with
count 0, which changes no probability and leaves their unseen contexts at one half.

Words are known by a 64-bit hash.

Defined cases: a null text is empty (one end token); null ids count as held-out
remainder 0 of an empty id text; repeated rows are counted and scored each; no
training text gives uniform bits and a base of ``log10(1 / 1)``; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.storage import Work

DEPTH = 5
END = 0xFF
WORD, GRAM = 0, 1
SLICE = 1 << 20  # a slice takes some hundred times its bytes while it is worked on
PART_BYTES = 48 << 20
BUCKETS = 256  # of n-grams; one more set of them for every ``BUCKET_BYTES`` of text
BUCKET_BYTES = 16 << 30
HELD_KEYS = 6 << 20  # keys that a task counts before it hands them on
MERGED_PARTS = 4096  # a bucket takes one more salt for every so many parts


class Lookup:
    """Values of 64-bit keys, found through a bucket directory."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        h = self._bucket(keys)
        order = np.argsort(h, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.first = np.zeros((1 << (64 - int(self.bits))) + 1, np.int64)
        np.cumsum(np.bincount(h.astype(np.int64), minlength=len(self.first) - 1), out=self.first[1:])

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def __call__(self, keys: np.ndarray, missing: float) -> np.ndarray:
        out = np.full(len(keys), missing)
        if not len(self.keys):
            return out
        h = self._bucket(keys).astype(np.int64)
        at, end, left = self.first[h], self.first[h + 1], np.arange(len(keys))
        while len(left):
            inside = at < end
            at, end, left = at[inside], end[inside], left[inside]
            hit = self.keys[at] == keys[left]
            out[left[hit]] = self.values[at[hit]]
            at, end, left = at[~hit] + 1, end[~hit], left[~hit]
        return out


class Counts:
    """Distinct keys with counts, merged whenever the parts have doubled."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        """Count each key once, those outside ``train`` with weight 0."""
        for own, weight in ((keys[train], 1), (keys[~train], 0)):
            own = np.sort(own)
            edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
            self.put(own[edge], np.diff(np.append(edge, len(own))) * weight)

    def put(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.held += len(keys)
        if self.held > max(1 << 19, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if self.parts:
            keys = np.concatenate([self.keys, *(k for k, _ in self.parts)])
            n = np.concatenate([self.n, *(c for _, c in self.parts)])
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            self.keys, self.n = keys[edge], np.add.reduceat(n, edge) if len(edge) else n
            self.parts, self.held = [], 0


def pack(values: np.ndarray, width: int) -> bytes:
    """64-bit values as ``width`` byte planes, lowest first, compressed; the raw size leads."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, width: int) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8).reshape(width, -1)
    octets = np.zeros((planes.shape[1], 8), np.uint8)
    octets[:, :width] = planes.T
    return octets.view(np.uint64).ravel()


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of every symbol with its ``depth`` predecessors, and its row."""
    rows = len(offsets) - 1
    own = np.diff(offsets)
    ext = np.full(len(data) + rows * (depth + 1), END, np.uint64)
    row = np.repeat(np.arange(rows), own)
    at = np.arange(len(data)) + row * (depth + 1) + depth
    ext[at] = K.LOWER[data]
    key = np.zeros(len(ext) - depth, np.uint64)
    for k in range(depth + 1):
        key = key << np.uint64(8) | ext[k:len(ext) - depth + k]
    # symbols: the text's bytes and the end; the others are the next row's padding
    lengths = own + 1
    starts = offsets[:-1] + np.arange(rows) * (depth + 1)
    return key[K.ragged(starts, lengths)], np.repeat(np.arange(rows), lengths)


def word_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[data]
    starts, ends, row = K.word_spans(low, offsets)
    return K.span_hashes(low, starts, ends), row


class Buckets:
    """How keys are dealt: an n-gram by its last ``t`` context bytes, a word by its
    hash into buckets behind those of the n-grams."""

    def __init__(self, depth: int, grams: int = BUCKETS):
        self.depth, self.t, self.grams = depth, min(3, depth), grams
        self.words = max(1, grams // 4)
        self.widths = {GRAM: depth + 1, WORD: 8}

    def kind(self, bucket: int) -> int:
        return GRAM if bucket < self.grams else WORD

    def of(self, kind: int, keys: np.ndarray) -> np.ndarray:
        if kind == WORD:
            return (keys % np.uint64(self.words)).astype(np.int64) + self.grams
        top = keys >> np.uint64(8) & np.uint64((1 << 8 * self.t) - 1)
        return (K.mix(top + np.uint64(1)) % np.uint64(self.grams)).astype(np.int64)

    def values(self, kind: int, values: np.ndarray) -> np.ndarray:
        """Values as 48-bit numbers: counts, or doubles less their 16 lowest bits."""
        return values.astype(np.uint64) if kind == WORD else values.view(np.uint64) >> np.uint64(16)

    def numbers(self, kind: int, packed: np.ndarray) -> np.ndarray:
        return packed.astype(float) if kind == WORD else (packed << np.uint64(16)).view(np.float64)


def _distinct(docs: DataFrame, buckets: Buckets) -> DataFrame:
    """``part, bucket, keys, n``: the packed keys of each part with their training
    counts.  A part may come in several pieces."""

    def emit(held):
        for (part, kind), c in held.items():
            c.merge()
            bucket = buckets.of(kind, c.keys)
            order = np.argsort(bucket, kind="stable")  # keys stay sorted within it
            bucket, keys, n = bucket[order], c.keys[order], c.n[order].astype(np.uint64)
            edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
            spans = list(zip(edge.tolist(), [*edge[1:].tolist(), len(bucket)]))
            if spans:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(edge), part, np.int64)), pa.array(bucket[edge].astype(np.int32)),
                     pa.array([pack(keys[a:z], buckets.widths[kind]) for a, z in spans], pa.binary()),
                     pa.array([pack(n[a:z], 6) for a, z in spans], pa.binary())], ["part", "bucket", "keys", "n"])

    def count(batches):
        held: dict[tuple[int, int], Counts] = {}
        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False)
            part = batch.column("part").to_numpy()
            for i, j, data, offsets in K.text_slices(batch.column("text"), SLICE):
                for kind, (key, row) in ((WORD, word_keys(data, offsets)), (GRAM, grams(data, offsets, buckets.depth))):
                    own_part, own_train = part[i:j][row], train[i:j][row]
                    for p in np.unique(part[i:j]).tolist():
                        mine = own_part == p
                        held.setdefault((p, kind), Counts()).add(key[mine], own_train[mine])
                if sum(len(c.keys) + c.held for c in held.values()) > HELD_KEYS:
                    for c in held.values():
                        c.merge()
                    if sum(len(c.keys) for c in held.values()) > HELD_KEYS:
                        yield from emit(held)
                        held = {}
        yield from emit(held)

    return docs.select("part", "train", "text").mapInArrow(count, "part long, bucket int, keys binary, n binary")


def _sql_lgamma(x: str) -> str:
    """Stirling's series of log Gamma at ``x + 8``, shifted back to ``x >= 1/2``."""
    z = f"({x} + 8)"
    shift = " * ".join(f"({x} + {k})" for k in range(8))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3))"
            f" + 1 / (1260 * pow({z}, 5)) - ln({shift}))")


def _lgamma(x: np.ndarray) -> np.ndarray:
    """As ``_sql_lgamma``."""
    z, shift = x + 8, x.copy()
    for k in range(1, 8):
        shift *= x + k
    return ((z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z ** 3)
            + 1 / (1260 * z ** 5) - np.log(shift))


# log of the Krichevsky-Trofimov probability of a zeros and b ones
_SQL_KT = (f"({_sql_lgamma('(a + 0.5D)')} + {_sql_lgamma('(b + 0.5D)')} - {_sql_lgamma('(a + b + 1D)')}"
           " - 1.1447298858494002D)")
_SQL_MIXED = "(greatest(kt, below) + ln(1 + exp(-abs(kt - below))) - 0.6931471805599453D)"


def _kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - 1.1447298858494002


def _subtree(keys: np.ndarray, c: np.ndarray, depth: int, t: int) -> dict:
    """Bottom-up over the n-grams of some contexts of ``t`` bytes: per depth the
    sorted node names (context and node), ``a``, ``b`` and ``below``, the sum of the
    children's log Pw."""
    i = np.arange(8)
    byte = (keys & np.uint64(255)).astype(np.int64)[:, None]
    node = (1 << i) | (byte >> (8 - i))
    name = ((keys >> np.uint64(8)).astype(np.int64)[:, None] << 8 | node).ravel()
    bit = ((byte >> (7 - i)) & 1).ravel()
    weight = np.repeat(c, 8)
    names, inverse = np.unique(name, return_inverse=True)
    ones = np.bincount(inverse, weights=weight * bit, minlength=len(names))
    level = {"name": names, "a": np.bincount(inverse, weights=weight, minlength=len(names)) - ones, "b": ones,
             "below": np.zeros(len(names)), "at": inverse, "bit": bit}
    out = {depth: level}
    for d in range(depth, t, -1):
        kt = _kt(level["a"], level["b"])
        pw = kt if d == depth else np.logaddexp(kt, level["below"]) - np.log(2)
        names, up = np.unique(level["name"] & ((1 << 8 * d) - 1), return_inverse=True)
        level["up"] = up
        level = {"name": names, **{x: np.bincount(up, weights=y, minlength=len(names)) for x, y in (
            ("a", level["a"]), ("b", level["b"]), ("below", pw))}}
        out[d - 1] = level
    return out


def _by(batches, *names: str):
    """``(group, row)`` of every row: the values of ``names``, and of all columns."""
    for batch in batches:
        at = [batch.schema.get_field_index(n) for n in names]
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield tuple(row[i] for i in at), row


def _merged(buckets: Buckets, nodes: bool):
    """Sum the packed rows ``bucket, salt, keys, n`` of each bucket and salt, which lie
    together; with ``nodes`` also what the depths above need of the bucket."""
    names = ["bucket", "keys", "n", *(["ctx", "node", "a", "b", "below", "total", "known"] if nodes else [])]

    def close(bucket, c):
        c.merge()
        kind = buckets.kind(bucket)
        row = {"bucket": bucket, "keys": pack(c.keys, buckets.widths[kind]), "n": pack(c.n.astype(np.uint64), 6)}
        if nodes and kind == GRAM:
            level = _subtree(c.keys, c.n.astype(float), buckets.depth, buckets.t)[buckets.t]
            row |= {"ctx": level["name"] >> 8, "node": (level["name"] & 255).astype(np.int32),
                    "a": level["a"].astype(np.int64), "b": level["b"].astype(np.int64), "below": level["below"]}
        elif nodes:
            row |= {"total": int(c.n.sum()), "known": int((c.n > 0).sum())}
        return pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in schema], schema=schema)

    def run(batches):
        current, counts = None, None
        for (salt, bucket), row in _by(batches, "salt", "bucket"):
            if (salt, bucket) != current:
                if current is not None:
                    yield close(current[1], counts)
                current, counts = (salt, bucket), Counts()
            counts.put(unpack(row[2], buckets.widths[buckets.kind(bucket)]), unpack(row[3], 6).astype(np.int64))
        if current is not None:
            yield close(current[1], counts)

    kinds = {"bucket": pa.int32(), "keys": pa.binary(), "n": pa.binary(), "ctx": pa.list_(pa.int64()),
             "node": pa.list_(pa.int32()), "a": pa.list_(pa.int64()), "b": pa.list_(pa.int64()),
             "below": pa.list_(pa.float64()), "total": pa.int64(), "known": pa.int64()}
    schema = pa.schema([(n, kinds[n]) for n in names])
    return run


def _mix(levels: dict[int, DataFrame], depth: int, t: int) -> DataFrame:
    """Top-down over the depths 0 to ``t - 1``: ``ctx, node, done, left`` at ``t - 1``."""

    def own(level: DataFrame) -> DataFrame:
        return level.select("ctx", "node", F.expr("(b + 0.5D) / (a + b + 1)").alias("one"),
                            F.expr(f"1 / (1 + exp(below - {_SQL_KT}))").alias("here"))

    state = own(levels[0]).select("ctx", "node", F.expr("here * one").alias("done"), F.expr("1 - here").alias("left"))
    for d in range(1, t):
        parent = state.withColumnRenamed("ctx", "up")
        state = own(levels[d]).withColumn("up", F.expr(f"ctx & {(1 << 8 * (d - 1)) - 1}L")).join(parent, ["up", "node"]).select(
            "ctx", "node", F.expr("done + left * here * one").alias("done"), F.expr("left * (1 - here)").alias("left"))
    return state


def _upward(nodes: DataFrame, depth: int, t: int, work: Work) -> dict[int, DataFrame]:
    """``ctx, node, a, b, below`` of the depths ``t`` to 0, from those of ``t``."""
    levels = {t: nodes}
    for d in range(t, 0, -1):
        kt = levels[d].select("*", F.expr(_SQL_KT).alias("kt"))
        levels[d - 1] = work.cut(kt.groupBy(F.expr(f"ctx & {(1 << 8 * (d - 1)) - 1}L").alias("ctx"), "node").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"),
            F.sum(F.col("kt") if d == depth else F.expr(_SQL_MIXED)).alias("below")), f"depth{d - 1}")
    return levels


def _valued(buckets: Buckets):
    """The value of every key of a bucket: a word's training count, an n-gram's log10
    probability.  Rows: ``bucket, keys, n, state``, the bucket's nodes from above."""

    def logs(keys, n, state):
        levels = _subtree(keys, n.astype(float), buckets.depth, buckets.t)
        ctx, node, done, left = (state.field(x).to_numpy() for x in ("ctx", "node", "done", "left"))
        order = np.lexsort((node, ctx))  # as the names of the level are sorted
        done, left = done[order], left[order]
        for d in range(buckets.t, buckets.depth + 1):
            level = levels[d]
            if d > buckets.t:
                done, left = done[level["up"]], left[level["up"]]
            with np.errstate(over="ignore"):
                here = 1.0 if d == buckets.depth else 1 / (1 + np.exp(level["below"] - _kt(level["a"], level["b"])))
            done = done + left * here * (level["b"] + 0.5) / (level["a"] + level["b"] + 1)
            left = left * (1 - here)
        leaf = levels[buckets.depth]
        p = done[leaf["at"]]
        return np.log10(np.where(leaf["bit"] == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                bucket, keys, n = (batch.column(c)[i].as_py() for c in ("bucket", "keys", "n"))
                kind, n = buckets.kind(bucket), unpack(n, 6).astype(np.int64)
                value = n if kind == WORD else logs(
                    unpack(keys, buckets.widths[GRAM]), n, batch.column("state")[i].values)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int32()), "keys": pa.array([keys], pa.binary()),
                    "value": pa.array([pack(buckets.values(kind, value), 6)], pa.binary())})

    return run


def _answered(buckets: Buckets):
    """Give each part the values of its keys in a bucket, one row for all its pieces;
    a group's first row has the values of the whole bucket.  Rows: ``bucket, salt,
    part, keys, value``."""

    def run(batches):
        current, part, held, out, size = None, None, [], [], 0
        all_keys = all_values = None

        def answer():
            bucket = current[0]
            keys = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            own = all_values[np.searchsorted(all_keys, keys)]
            return {"part": part, "bucket": bucket, "keys": pack(keys, buckets.widths[buckets.kind(bucket)]),
                    "value": pack(own, 6)}

        for group, (_, _, whose, keys, value) in _by(batches, "bucket", "salt"):
            if held and (group != current or whose != part):
                out.append(answer())
                size += len(out[-1]["keys"]) + len(out[-1]["value"])
                held = []
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            keys = unpack(keys, buckets.widths[buckets.kind(group[0])])
            if group != current:  # nulls sort first: the row of the whole bucket
                current, all_keys, all_values = group, keys, unpack(value, 6)
            else:
                part = whose
                held.append(keys)
        if held:
            out.append(answer())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("part", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("value", pa.binary())])
    return run


def parts(docs: DataFrame, text_col: str = "text") -> Column:
    """Part of a row by its place in its file: a fixed function of the row.

    A part holds as many consecutive rows as have ``PART_BYTES`` at the mean length;
    rows over 8, 64, .. times the mean make parts of an eighth, a 64th .. as many
    rows of their own, so no part but a single text passes ``8 * PART_BYTES``."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0))
    n, total = docs.agg(F.count("*"), F.sum(size)).first()
    mean = max(1.0, (total or 0) / max(n, 1))
    rows = max(1, int(PART_BYTES / mean))
    longer = F.floor(F.log(8.0, F.greatest(size / mean, F.lit(1.0))))
    block = F.expr("_metadata.row_index") / F.greatest(F.lit(1.0), F.floor(rows / F.pow(F.lit(8.0), longer)))
    return F.xxhash64("_metadata.file_path", longer, F.floor(block))


def score(docs: DataFrame, train: Column, part: Column | None = None, id_col: str = "doc_id",
          text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes``.

    ``train``: which rows are learned from.  ``part``: a fixed function of the
    row (a task's dictionary is that of its part); any gives the same result.
    Without one the rows are dealt by a hash into parts of ``PART_BYTES``;
    ``parts`` keeps rows of a file together."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2..6: a context and its node are one 64-bit name")
    work = Work(docs.sparkSession, "ctw")
    text = F.col(text_col).cast("string")
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    if part is None:
        part = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 + total // PART_BYTES))
    buckets = Buckets(depth, BUCKETS * (1 + total // BUCKET_BYTES))
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       part.cast("long").alias("part"), F.coalesce(train, F.lit(False)).alias("train"))
    packed = work.cut(_distinct(rows, buckets), "packed")
    salts = 1 + packed.select("part").distinct().count() // MERGED_PARTS
    salt = F.pmod(F.xxhash64("part"), F.lit(salts)).cast("int").alias("salt")

    def summed(of: DataFrame, nodes: bool, schema: str) -> DataFrame:
        return of.repartition("salt", "bucket").sortWithinPartitions("salt", "bucket").mapInArrow(
            _merged(buckets, nodes), schema)

    each = packed.select("bucket", salt, "keys", "n")
    if salts > 1:
        each = summed(each, False, "bucket int, keys binary, n binary").select("bucket", F.lit(0).alias("salt"), "keys", "n")
    whole = work.cut(summed(each, True, "bucket int, keys binary, n binary, ctx array<long>, node array<int>, a array<long>, "
                            "b array<long>, below array<double>, total long, known long"), "buckets")
    ends = rows.where("train").count()
    n, v = whole.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    n, v = n + ends, v + (ends > 0)

    nodes = whole.where(F.col("bucket") < buckets.grams).select(
        "bucket", F.explode(F.arrays_zip("ctx", "node", "a", "b", "below")).alias("x")).select("bucket", "x.*")
    above = _mix(_upward(nodes.drop("bucket"), depth, buckets.t, work), depth, buckets.t).withColumnRenamed("ctx", "up")
    state = nodes.select("bucket", "ctx", "node", F.expr(f"ctx & {(1 << 8 * (buckets.t - 1)) - 1}L").alias("up")).join(
        above, ["up", "node"]).groupBy("bucket").agg(F.collect_list(F.struct("ctx", "node", "done", "left")).alias("state"))
    values = whole.select("bucket", "keys", "n").join(state, "bucket", "left").select("bucket", "keys", "n", "state").mapInArrow(
        _valued(buckets), "bucket int, keys binary, value binary")
    asked = values.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                          F.lit(None).cast("long").alias("part"), "keys", "value").unionByName(
        packed.select("bucket", salt, "part", "keys", F.lit(None).cast("binary").alias("value")))
    answered = asked.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "part").mapInArrow(
        _answered(buckets), "part long, bucket int, keys binary, value binary")
    texts = rows.select("part", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("keys"),
                        F.lit(None).cast("binary").alias("value"), "id", F.coalesce("text", F.lit("")).alias("text"))
    together = answered.select("*", F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("string").alias("text")).unionByName(
        texts).repartition("part").sortWithinPartitions("part", F.col("bucket").asc_nulls_last())
    denominator, end_log, end_known = np.log10(n + v + 1), np.log10(ends + 1), int(ends > 0)

    def apply(batches):
        current, held, find = None, {}, None
        for batch in batches:
            part_of = batch.column("part").to_numpy()
            is_text = batch.column("bucket").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((part_of[1:] != part_of[:-1]) | (is_text[1:] != is_text[:-1])) + 1
            bounds = [0, *edges.tolist(), len(part_of)]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if a == b:
                    continue
                if part_of[a] != current:
                    current, held, find = part_of[a], {WORD: [], GRAM: []}, None
                if not is_text[a]:
                    for bucket, keys, value in zip(*(batch.column(c).slice(a, b - a).to_pylist()
                                                     for c in ("bucket", "keys", "value"))):
                        kind = buckets.kind(bucket)
                        held[kind].append((unpack(keys, buckets.widths[kind]), buckets.numbers(kind, unpack(value, 6))))
                    continue
                if find is None:  # all values of a part come before its texts
                    find = {k: Lookup(np.concatenate([x[0] for x in xs] or [np.zeros(0, np.uint64)]),
                                      np.concatenate([x[1] for x in xs] or [np.zeros(0)])) for k, xs in held.items()}
                    held = {WORD: [], GRAM: []}
                ids, text = batch.column("id").slice(a, b - a), batch.column("text").slice(a, b - a)
                for i, j, data, offsets in K.text_slices(text, SLICE):
                    key, row = word_keys(data, offsets)
                    c = find[WORD](key, 0.0)
                    tokens = K.row_counts(row, j - i) + 1
                    known = np.bincount(row, weights=c > 0, minlength=j - i).astype(np.int64) + end_known
                    base = np.bincount(row, weights=np.log10(c + 1), minlength=j - i) + end_log - tokens * denominator
                    key, row = grams(data, offsets, depth)
                    logp = np.bincount(row, weights=find[GRAM](key, np.nan), minlength=j - i)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": ids.slice(i, j - i), "n_tokens": pa.array(tokens, pa.int64()),
                        "n_known": pa.array(known, pa.int64()),
                        "train_tokens": pa.array(np.full(j - i, n), pa.int64()),
                        "base_score": pa.array(base, pa.float64()), "score": pa.array(logp, pa.float64()),
                        "n_bytes": pa.array(np.diff(offsets) + 1, pa.int64())})

    return together.mapInArrow(apply, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, "
                                      "base_score double, score double, n_bytes long")
