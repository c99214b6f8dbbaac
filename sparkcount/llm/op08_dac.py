"""Token-id output as directly addressable codes.

A segment holds the ids of some consecutive documents.  Every id is split into
8-bit chunks, the lowest first; level ``k`` holds chunk ``k`` of the ids that
have one, with a bitmap of the ids that continue on the next level and, per
512 bits of it, the number of ones before (the rank directory).  Any id is read
with one rank per level, without decoding others:

    i, level 0 -> chunk; if its bit is set: i = ones before it, next level.

Segment payload, little endian: ``DAC1``, documents u32, levels u32, ids u64;
document ids i64[documents], their validity u8[documents], first id of each
document u64[documents + 1]; then per level: chunks u64 (their number), chunk
bytes, bitmap bytes (bit 0 first), rank directory u32.

Segments are rows of a Parquet table (``part, seg, n_docs, n_tokens, payload``),
written by Spark's own commit protocol: a lost executor leaves no partial file,
and any store that Spark reaches can hold them.  ``(part, seg)`` is ascending
document order.

``token_at`` looks ids up in the files: it reads the headers of segments to find
where a document begins and takes each id by its ranks, without decoding others.

Defined cases: a null text is empty (its end id only); null document ids come
first; rows of one id go by their texts' first 32 characters, then a hash of the
text; repeated rows are encoded each; a document is never split over segments;
an empty table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.tokens import Encoder

SEGMENT_IDS = 1 << 20
_RANK_BITS = 512
_MAGIC = b"DAC1"

SEGMENTS = "part int, seg int, n_docs long, n_tokens long, payload binary"


def _level(chunks: np.ndarray, more: np.ndarray) -> bytes:
    bits = np.packbits(more, bitorder="little")
    ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), _RANK_BITS)) \
        if len(more) else np.zeros(0, np.uint32)
    ranks = np.zeros(len(ones), np.uint32)
    np.cumsum(ones[:-1], out=ranks[1:])
    return struct.pack("<Q", len(chunks)) + chunks.tobytes() + bits.tobytes() + ranks.tobytes()


def pack_segment(doc_ids: list, ids: np.ndarray, first: np.ndarray) -> bytes:
    """Payload of a segment; ``first`` has the first id of each document and the total."""
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], np.int64)
    levels, rest = [], ids.astype(np.uint32)
    while True:
        high = rest >> np.uint32(8)
        more = high > 0
        levels.append(_level((rest & np.uint32(255)).astype(np.uint8), more))
        rest = high[more]
        if not len(rest):
            break
    return b"".join([_MAGIC, struct.pack("<IIQ", len(doc_ids), len(levels), len(ids)), keys.tobytes(),
                     valid.tobytes(), first.astype(np.uint64).tobytes(), *levels])


class Segment:
    """Random access to one payload (no copy of the chunk bytes)."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a DAC1 segment")
        self.n_docs, n_levels, self.n_ids = struct.unpack_from("<IIQ", payload, 4)
        at = 20

        def take(dtype, n):
            nonlocal at
            out = np.frombuffer(payload, dtype, n, at)
            at += out.nbytes
            return out

        self.doc_ids = take(np.int64, self.n_docs)
        self.valid = take(np.uint8, self.n_docs)
        self.first = take(np.uint64, self.n_docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take(np.uint8, n), take(np.uint8, -(-n // 8)), take("<u4", -(-n // _RANK_BITS))))

    def __getitem__(self, i: int) -> int:
        """Id number ``i``, through the continuation bits and rank directories."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // _RANK_BITS
            lo, hi = block * (_RANK_BITS // 8), i >> 3
            inside = int(np.bitwise_count(bits[lo:hi]).sum()) + (int(bits[hi]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(ranks[block]) + inside
            shift += 8
        return value

    def ids(self) -> np.ndarray:
        """All ids at once."""
        out = np.zeros(self.n_ids, np.uint32)
        at = np.arange(self.n_ids)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write_segments(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode whole texts and write their segments below ``path`` in ascending id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # rows of one id may be a third of all: the head of the text, its hash and, for
    # equal rows, the place in the input let ranges end among them
    order = [F.col("id").asc_nulls_first(), F.col("head"), F.col("hash"), F.col("row")]
    ranged = rows.select("id", "text", F.substring("text", 1, 32).alias("head"), F.xxhash64("text").alias("hash"),
                         F.monotonically_increasing_id().alias("row")).repartitionByRange(
        *order).sortWithinPartitions(*order).select("id", "text")

    def encode(batches):
        coder, part, seg = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, ids, counts, held = [], [], [], 0

        def segment():
            first = np.zeros(len(keys) + 1, np.int64)
            np.cumsum(counts, out=first[1:])
            payload = pack_segment(keys, np.concatenate(ids), first)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seg": pa.array([seg], pa.int32()),
                "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([int(first[-1])], pa.int64()),
                "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            names = batch.column("id").to_pylist()
            for i, j, data, offsets in K.text_slices(batch.column("text")):
                flat, n = coder.encode(data, offsets)
                # the end id after each document
                ends = np.cumsum(n)
                flat = np.insert(flat, ends, np.uint32(end_id))
                n = n + 1
                starts = np.concatenate([[0], np.cumsum(n)])
                a = 0
                while a < j - i:
                    b = int(np.searchsorted(starts, starts[a] + segment_ids - held, side="right")) - 1
                    b = min(max(b, a if held else a + 1), j - i)
                    if b > a:
                        keys += names[i + a:i + b]
                        ids.append(flat[starts[a]:starts[b]])
                        counts += n[a:b].tolist()
                        held += int(starts[b] - starts[a])
                    if b < j - i or held >= segment_ids:
                        yield segment()
                        seg, held = seg + 1, 0
                        keys, ids, counts = [], [], []
                    a = b
        if keys:
            yield segment()

    ranged.mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, part, seg``, all read from the files."""

    def decode(batches):
        for batch in batches:
            for part, seg, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "seg", "payload"))):
                s = Segment(payload)
                raw, first = memoryview(s.ids().tobytes()), s.first
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(s.doc_ids, pa.int64(), mask=s.valid == 0),
                    "part": pa.array(np.full(s.n_docs, part), pa.int32()),
                    "seg": pa.array(np.full(s.n_docs, seg), pa.int32()),
                    "inside": pa.array(first[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(first), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(
                        first[:-1].tolist(), first[1:].tolist())], pa.int64())})

    files = read_segments(spark, path)
    docs = files.select("part", "seg", "payload").mapInArrow(
        decode, "doc_id long, part int, seg int, inside long, n_tokens long, ids_crc32 long")
    # ids before a segment: those of earlier parts and of earlier segments of its part
    sizes = files.select("part", "seg", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    base = sizes.join(before, "part").select("part", "seg", (
        F.col("before") + F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seg"))
        - F.col("n_tokens")).alias("base"))
    return docs.join(base, ["part", "seg"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "part", "seg")


LOOKUPS = 1 << 16  # places of a segment that one task looks up at once


def token_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id, i, token`` for the rows ``doc_id, i`` of ``wanted``: id number ``i``
    of the document, from the segments below ``path``.

    A document or place that does not exist gives a null token, an id that several
    documents have a row for each; rows of ``wanted`` that repeat are answered each."""

    def heads(batches):
        for batch in batches:
            for part, seg, payload in zip(*(batch.column(c) for c in ("part", "seg", "payload"))):
                s = Segment(payload.as_buffer())
                yield pa.RecordBatch.from_pydict({
                    "d": pa.array(s.doc_ids, pa.int64(), mask=s.valid == 0),
                    "part": pa.array(np.full(s.n_docs, part.as_py()), pa.int32()),
                    "seg": pa.array(np.full(s.n_docs, seg.as_py()), pa.int32()),
                    "inside": pa.array(s.first[:-1], pa.int64()), "n": pa.array(np.diff(s.first), pa.int64())})

    def look(batches):
        for batch in batches:
            for part, seg, payload, places in zip(*(batch.column(c) for c in ("part", "seg", "payload", "places"))):
                s, at = Segment(payload.as_buffer()), places.values.to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(at), part.as_py()), pa.int32()),
                    "seg": pa.array(np.full(len(at), seg.as_py()), pa.int32()),
                    "place": pa.array(at, pa.int64()), "token": pa.array([s[k] for k in at], pa.int64())})

    files = read_segments(spark, path).select("part", "seg", "payload")
    docs = files.mapInArrow(heads, "d long, part int, seg int, inside long, n long")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("i").cast("long").alias("i"))
    found = asked.join(docs, F.col("doc_id").eqNullSafe(F.col("d")), "left").select(
        "doc_id", "i", "part", "seg",
        F.when((F.col("i") >= 0) & (F.col("i") < F.col("n")), F.col("inside") + F.col("i")).alias("place"))
    places = (found.where("place is not null").select("part", "seg", "place").distinct()
              .groupBy("part", "seg", F.expr(f"place div {LOOKUPS}").alias("block"))
              .agg(F.collect_list("place").alias("places")))
    tokens = files.join(places, ["part", "seg"]).select("part", "seg", "payload", "places").mapInArrow(
        look, "part int, seg int, place long, token long")
    return found.join(tokens, ["part", "seg", "place"], "left").select("doc_id", "i", "token")
