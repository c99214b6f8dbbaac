"""Best-fit-decreasing packing of documents into sequences of fixed capacity.

Best-fit decreasing looks only at lengths, and there are at most ``capacity``
of them.  So the pieces are counted by length in Spark, and the packing is run
once over those at most ``capacity`` counts: lengths from long to short, each
into the tightest open sequence that holds it, found in a segment tree over the
remaining capacities.  Sequences of equal remaining capacity are handled as
groups, so the work and the resulting plan do not grow with the number of
documents: each length adds at most a few groups (see ``plan``).  The plan says
which sequence takes the k-th piece of a length; every piece's k comes from its
rank in a hash bucket and the buckets' counts, so no length, however common,
meets in one task; the number of buckets follows the number of pieces.  A piece
of full length needs no rank: it is a sequence of its own, numbered below 0.  The
result is that of packing the pieces one by one.

Longer documents are cut into pieces of ``capacity``; the first is the shorter.

Defined cases: a null text is empty (its end id only); repeated rows and null
ids are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.storage import Work
from sparkcount.llm.tokens import Encoder

CAPACITY = 1024
BUCKETS = 256  # at least, and one for every BUCKET_ROWS pieces
BUCKET_ROWS = 1 << 19

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenCapacities:
    """Segment tree over remaining capacities ``1..n``: which have open sequences."""

    def __init__(self, n: int):
        self.size = 1 << max(1, n).bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, r: int, bins: int) -> None:
        r += self.size
        while r:
            self.open[r] += bins
            r >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity ``>= need`` with an open sequence."""
        node = need + self.size
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first piece, first sequence, pieces per sequence, offset)``.

    The k-th piece of a length belongs to its last run with ``first <= k`` and
    goes to sequence ``first sequence + (k - first) // per``.  Each length takes
    whole groups but for one that it splits and one sequence that it fills in
    part, so there are at most ``3 * lengths`` groups, whatever the counts."""
    tree, groups, runs, bins = OpenCapacities(capacity), {}, [], 0

    def put(r: int, first: int, n: int) -> None:
        if r > 0 and n:
            groups.setdefault(r, []).append((first, n))
            tree.add(r, n)

    for s in sorted(counts, reverse=True):
        k, total = 0, counts[s]
        while k < total:
            r = tree.tightest(s)
            if r is None:
                r, first, n = capacity, bins, -(-(total - k) // (capacity // s))
                bins += n
            else:
                first, n = groups[r].pop()
                tree.add(r, -n)
            per = r // s
            full = min(n, (total - k) // per)
            if full:
                runs.append((s, k, first, per, capacity - r))
                put(r - per * s, first, full)
                k += full * per
            if full < n and k < total:  # fewer pieces left than one sequence holds
                runs.append((s, k, first + full, per, capacity - r))
                put(r - (total - k) * s, first + full, 1)
                k, full = total, full + 1
            if r < capacity:
                put(r, first + full, n - full)
    return runs


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoded documents cut into pieces of at most ``capacity`` ids (``PIECES``)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches):
        coder = Encoder(tokenizer)
        for batch in batches:
            for i, j, data, offsets in K.text_slices(batch.column("text")):
                flat, n = coder.encode(data, offsets)
                flat = np.insert(flat, np.cumsum(n), np.uint32(end_id))
                n = n + 1
                first = np.cumsum(n) - n
                many = -(-n // capacity)
                doc = np.repeat(np.arange(j - i), many)
                piece = K.ragged(np.zeros(j - i, np.int64), many)
                short = n - (many - 1) * capacity  # length of the first piece
                start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[doc], capacity)
                at = first[doc] + start
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                ids = batch.column("id").slice(i, j - i).take(pa.array(doc))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return rows.mapInArrow(encode, PIECES)


def pack(parts: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``sequence_id, offset`` to written pieces (they are read several times)."""
    own = parts.columns
    # at most one row per length: bounded by the capacity
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if counts and max(counts) > capacity:
        raise ValueError("a piece is longer than the capacity")
    full = parts.where(F.col("length") == capacity).select(
        *own, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    counts.pop(capacity, None)
    buckets = max(buckets, sum(counts.values()) // BUCKET_ROWS)
    dealt = parts.where(F.col("length") < capacity).withColumn(
        "__b", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "__b").agg(F.count("*").alias("n"))
    runs = plan({k: v for k, v in counts.items() if k > 0}, capacity)
    table = np.array(runs, np.int64).reshape(-1, 5)
    keys = table[:, 0] << 44 | table[:, 1]
    order = np.argsort(keys)
    keys, table = keys[order], table[order]
    before = sizes.select("length", "__b", (F.sum("n").over(
        Window.partitionBy("length").orderBy("__b")) - F.col("n")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("length", "__b").orderBy(
        F.col("doc_id"), "piece", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("__r", rank).join(before, ["length", "__b"]).withColumn(
        "__k", F.col("__r") + F.col("__before"))

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            k = batch.column("__k").to_numpy(zero_copy_only=False)
            run = table[np.searchsorted(keys, length << 44 | k, side="right") - 1]
            nth = k - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own]
                + [pa.array(run[:, 2] + nth // run[:, 3], pa.int64()),
                   pa.array(run[:, 4] + nth % run[:, 3] * length, pa.int64())],
                [*own, "sequence_id", "offset"])

    schema = parts.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.select(*own, "__k").mapInArrow(place, schema).unionByName(full)


def best_fit_packing(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of whole documents."""
    work = Work(docs.sparkSession, "best-fit")
    return pack(work.cut(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces"), capacity)
