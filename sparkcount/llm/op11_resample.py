"""Importance resampling towards a target distribution, on hashed n-grams.

A document's features are its runs of 1 to ``order`` consecutive words, hashed
by CRC-32 into buckets.  No n-gram is ever built: a slice of texts is normalised
(A-Z lowered, every run of separators one space) and scanned once, storing the
running CRC after every byte.  The CRC of the bytes ``s..e`` then is
``crc[e] ^ shift(crc[s], e - s)``: feeding ``n`` zero bytes to a CRC register is
a linear map over GF(2), applied here by tables for the base-16 digits of ``n``.

Bucket counts of both sides are pre-aggregated per task; the gain per bucket is
one array of ``buckets`` longs, the only thing every task gets.  A document's
weight is the floored mean gain of its features.  Adding Gumbel noise drawn from a hash of
its id and taking the highest scores draws without replacement in proportion to
``exp(weight / 1000)``; the draw ranks by range partitions (``running``), not in
one task.

Defined cases: null and empty texts have no feature, weight 0 and are never
drawn, nor is a text with fewer than ``min_words`` words; a null id hashes as an
empty one and ranks last among ties; repeated rows are scored and ranked each on their own; an empty
target or corpus gives gains over zero counts; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.running import running_total
from sparkcount.llm.storage import Work, ship

SLICE = 1 << 20
LANE = 1024

# Separators: every ASCII byte but digits and letters (capitals are lowered first).
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[48:58] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False


def _byte_table() -> np.ndarray:
    """CRC-32 register after one byte from zero (reflected polynomial EDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


_BYTE = _byte_table()


class _Shift:
    """``shift(crc, n)``: the register after ``n`` zero bytes.  Level ``k`` holds,
    for each digit ``d``, the map of ``d * 16**k`` zero bytes as four tables of 256."""

    def __init__(self):
        self.levels: list[np.ndarray] = []
        self.step = self._tables(lambda r: _BYTE[r & np.uint32(255)] ^ (r >> np.uint32(8)))

    @staticmethod
    def _tables(move) -> np.ndarray:
        place = np.arange(256, dtype=np.uint32)
        return np.concatenate([move(place << np.uint32(8 * i)) for i in range(4)])

    @staticmethod
    def _apply(table: np.ndarray, at, r: np.ndarray) -> np.ndarray:
        return (table[at + (r & np.uint32(255))] ^ table[at + 256 + ((r >> np.uint32(8)) & np.uint32(255))]
                ^ table[at + 512 + ((r >> np.uint32(16)) & np.uint32(255))] ^ table[at + 768 + (r >> np.uint32(24))])

    def _grow(self) -> None:
        power = [self._tables(lambda r: r)]
        for _ in range(16):
            power.append(self._apply(self.step, 0, power[-1]))
        self.levels.append(np.concatenate(power[:16]))
        self.step = power[16]

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        out, level = crc.copy(), 0
        at = np.arange(len(n))
        while len(at):
            if level == len(self.levels):
                self._grow()
            digit = (n[at] >> (4 * level)) & 15
            out[at] = self._apply(self.levels[level], digit * 1024, out[at])
            level += 1
            at = at[n[at] >> (4 * level) > 0]
        return out


_shift = _Shift()


def prefix_crcs(data: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[:i]`` for ``i = 0 .. len(data)``.  Lanes of ``LANE`` bytes
    run side by side, each from the CRC of all bytes before it."""
    n = len(data)
    lanes = -(-n // LANE)
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:n] = data
    start = np.zeros(lanes, np.uint32)
    for i in range(1, lanes):
        start[i] = zlib.crc32(padded[(i - 1) * LANE:i * LANE], int(start[i - 1]))
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    run = np.empty((LANE, lanes), np.uint32)
    r = ~start
    for i in range(LANE):
        r = _BYTE[columns[i] ^ r.astype(np.uint8)] ^ (r >> np.uint32(8))
        run[i] = r
    out = np.zeros(n + 1, np.uint32)
    out[1:] = ~run.T.ravel()[:n]
    return out


def ngram_crcs(data: np.ndarray, offsets: np.ndarray, order: int):
    """``(row of every word, [(row, crc) of every n-gram of 1, 2, .. order words])``
    of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    low = K.LOWER[data]
    starts, ends, row = K.word_spans(low, offsets, _SEPARATOR)
    gap = _SEPARATOR[low]
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    new = np.cumsum(keep) - keep
    low = np.where(gap, np.uint8(32), low)[keep]
    crc = prefix_crcs(low)
    size = ends - starts
    starts = new[starts]
    ends = starts + size
    grams = []
    for m in range(1, order + 1):
        last = max(len(row) - m + 1, 0)
        same = np.flatnonzero(row[:last] == row[m - 1:])
        s, e = starts[same], ends[same + m - 1]
        grams.append((row[same], crc[e] ^ _shift(crc[s], e - s)))
    return row, grams


def _counts(order: int, buckets: int):
    def kernel(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in K.text_slices(batch.column(0), SLICE):
                for _, crc in ngram_crcs(data, offsets, order)[1]:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])
    return kernel


def bucket_counts(docs: DataFrame, order: int, buckets: int, text_col: str = "text") -> DataFrame:
    """``(bucket, n)`` over all whole texts; buckets without a feature are left out."""
    ship(docs.sparkSession)
    parts = docs.select(text_col).mapInArrow(_counts(order, buckets), "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """``floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))`` of every bucket."""
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("bigint").alias("s"), F.col("n").alias("t")))
    found = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in found:
        s[r["bucket"]], t[r["bucket"]] = r["s"], r["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(order: int, buckets: int, gains: np.ndarray):
    def kernel(batches):
        for batch in batches:
            rows = len(batch)
            words, features, total = (np.zeros(rows, np.int64) for _ in range(3))
            for i, j, data, offsets in K.text_slices(batch.column(1), SLICE):
                row, grams = ngram_crcs(data, offsets, order)
                words[i:j] = K.row_counts(row, j - i)
                for at, crc in grams:
                    features[i:j] += K.row_counts(at, j - i)
                    gain = gains[crc % np.uint32(buckets)]
                    # sums of longs below 2**53: exact as doubles
                    total[i:j] += np.bincount(at, gain, minlength=j - i).astype(np.int64)
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(features), pa.array(words), pa.array(weight)],
                names=["id", "n_features", "n_words", "weight"])
    return kernel


def gumbel(id_col: Column, seed: int) -> Column:
    """``floor(-1000 * ln(-ln(u)))``; ``u`` from the first 8 hex digits of sha256(``seed:id``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, order: int = 2, buckets: int = 10000, share: int = 25,
             min_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, n_features, weight, score, rank)`` of every document; ``rank`` is
    null but for the ``share`` percent of the eligible documents that are drawn."""
    work = Work(docs.sparkSession, "resample")
    gains = bucket_gains(bucket_counts(docs, order, buckets, text_col),
                         bucket_counts(target, order, buckets, text_col), buckets)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _weights(order, buckets, gains), f"id {id_type}, n_features bigint, n_words bigint, weight bigint")
    scored = work.cut(rows.select(
        "id", "n_features", "weight", (F.col("weight") + gumbel(F.col("id"), seed)).alias("score"),
        (F.col("n_words") < min_words).alias("short"), F.lit(1).cast("bigint").alias("one"),
        F.monotonically_increasing_id().alias("row")), "scored")
    quota = scored.where("not short").count() * share // 100
    placed = running_total(scored, [F.col("short"), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")],
                           "one", work)
    rank = F.col("before") + 1
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                         F.when(rank <= quota, rank).alias("rank"))
