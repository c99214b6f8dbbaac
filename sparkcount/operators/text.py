"""Word counts over documents ``(doc_id, text)``.

Words are the pieces of ``text`` split on single blanks, empty pieces kept:
``"a  b "`` gives ``a``, ``""``, ``b``, ``""``; other whitespace (newlines)
stays inside a word.  Every document is split whole.

The four counts differ only in how the shuffle is arranged; they return the
same ``(word, n)`` table:

* ``word_count``: one round - Catalyst's partial aggregate combines each
  task's words before the shuffle, so a hot word costs one row per task;
* ``word_count_salted`` ``per_document_word``: a salt in ``[0, K)`` is hashed
  from ``(doc_id, word)`` when the text is split; sum per ``(salt, word)``,
  then per word;
* ``word_count_salted`` ``on_the_fly``: the text is split unsalted; the salt of a
  document's word is hashed by the grouping step (its partial aggregate is the
  per-document count), then per word: two shuffles;
* ``word_count_partitioned``: every task of the scan stage sums its own partition
  (Arrow's hash aggregate over the pieces of whole batches), and one exchange
  adds the partitions' sums per word.  A task that has gathered more than
  ``HELD_WORDS`` different words hands them on and begins anew, so its memory does
  not follow the partition's vocabulary.

Salts are hashes of the row, not ``rand()``: a retried task draws the same
salt, so a lost executor cannot move a row between groups.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcount.functions.frames import merge_single_rows, ratio


# Different words a task of the partition-wise count holds before it hands them on.
HELD_WORDS = 1 << 20
# Texts split at a time there: Arrow's pieces take several times the bytes.
_SLICE_ROWS = 256


def _words(docs: DataFrame, *ids: str) -> DataFrame:
    """``(ids..., word)``: one row per blank-separated piece of every text."""
    return docs.select(*ids, F.explode(F.split(F.col("text"), " ", -1)).alias("word"))


def document_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n_documents"))


def words_per_document(docs: DataFrame) -> DataFrame:
    """``(doc_id, word, n)``: occurrences of each word within each document."""
    return _words(docs, "doc_id").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def word_count(docs: DataFrame) -> DataFrame:
    """``(word, n)`` in one round."""
    return _words(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_salted(docs: DataFrame, K: int, salt: str = "per_document_word",
                      seed: int = 0) -> DataFrame:
    """``(word, n)`` in two rounds over ``K`` salt groups."""
    if salt == "per_document_word":
        salted = _words(docs, "doc_id").withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "word", F.lit(seed)), F.lit(K)))
        pairs = salted.groupBy("salt", "word")
    elif salt == "on_the_fly":
        # another member of the hash family than the split-time salt
        pairs = _words(docs, "doc_id").groupBy(
            F.pmod(F.xxhash64(F.lit(seed), "doc_id", "word"), F.lit(K)).alias("salt"), "word")
    else:
        raise ValueError(f"unknown salt {salt!r}")
    return pairs.agg(F.count(F.lit(1)).alias("n")).groupBy("word").agg(
        F.sum("n").cast("bigint").alias("n"))


def _partition_sums(held_words: int):
    def kernel(batches):
        held, rows = [], 0
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

        def summed():
            t = pa.Table.from_batches(held, schema).group_by("word").aggregate([("n", "sum")])
            return t.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()

        for batch in batches:
            for at in range(0, len(batch), _SLICE_ROWS):
                texts = batch.column(0).slice(at, _SLICE_ROWS).cast(pa.large_string())
                found = pc.value_counts(pc.list_flatten(pc.split_pattern(texts, " ")))
                held.append(pa.RecordBatch.from_arrays(
                    [found.field("values").cast(pa.string()), found.field("counts")], schema=schema))
                rows += len(found)
            if rows > 2 * held_words:
                t = summed()
                if len(t) > held_words:
                    yield from t.to_batches()
                    held, rows = [], 0
                else:
                    held, rows = t.to_batches(), len(t)
        if held:
            yield from summed().to_batches()

    return kernel


def word_count_partitioned(docs: DataFrame, held_words: int = HELD_WORDS) -> DataFrame:
    """``(word, n)``: totals inside each partition first, then per word."""
    parts = docs.select("text").mapInArrow(_partition_sums(held_words), "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def distinct_word_count(docs: DataFrame, K: int = 4) -> DataFrame:
    """One row: per count method its distinct words and, as ``<method>_total``,
    the sum of its counts.  The sums keep every method's own rounds in the plan:
    a bare row count would let Catalyst drop them."""
    def n(df, name):
        return df.agg(F.count_if(F.col("n") > 0).alias(name),
                      F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(f"{name}_total"))
    return merge_single_rows(
        n(word_count(docs), "one_round"),
        n(word_count_salted(docs, K, "per_document_word"), "salted_map"),
        n(word_count_salted(docs, K, "on_the_fly"), "salted_group"),
        n(word_count_partitioned(docs), "partitioned"),
    )


def average_word_length(wc: DataFrame) -> DataFrame:
    """One row ``avg_length``: mean code-point length over *distinct* words
    (the empty word has length 0); NULL for no words."""
    return wc.agg(F.count(F.lit(1)).alias("n_words"),
                  ratio(F.sum(F.length("word")), F.count(F.lit(1))).alias("avg_length"))
