"""Mixing sources to target weights along a time-varying curriculum.

A source's weight is a piecewise linear function of training time, 0 to 1.  Its
integral is the source's share of the mix; shares above ``max_repeats`` times a
source's words are cut there, and the excess is shared anew by weight until none
is above.  A source's words are used in a seeded order of its documents, run
after run; the cumulative demand (the integral up to a time) says when each word
of that order is due.  Inverting it at the place where a copy of a document
starts gives the copy's time, and the demand of all sources up to then its
training position, by which the copies are range-sorted.

Where a document starts in its source's order is a running total over all
documents in (source, seeded hash) order (``running``), less the words of
earlier sources, so a source of any size is dealt over many tasks.  Of the
sources, only two sums per sharing round and one target sum per schedule reach
the driver.

A source takes exactly ``floor(target)`` words: its last copy may be a prefix of
a document.  Copies of one document never exceed ``max_repeats``.

Defined cases: a null or empty text, or one without words, has size 0, is never
taken and has no position; a null source is one source of its own, last; a null
id hashes as an empty one; repeated rows are documents of their own; without any
word every target is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcount.llm import kernels as K
from sparkcount.llm.running import running_total
from sparkcount.llm.storage import Work, ship

Knots = Sequence[tuple[float, float]]  # (time, weight), times from 0 to 1


def cumulative(knots: Knots) -> list[float]:
    """Integral of the schedule from 0 to each knot."""
    total, out = 0.0, [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        total += (t1 - t0) * (w0 + w1) / 2
        out.append(total)
    return out


def _time_of(knots: Knots, demand: Column) -> Column:
    """The time at which the integral reaches ``demand`` (a part of its whole)."""
    found, upto = F.lit(1.0), cumulative(knots)
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        slope = (w1 - w0) / (t1 - t0)
        y = demand - upto[i]
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + y * (2 * slope), F.lit(0.0)))
        x = F.when(y <= 0, F.lit(0.0)).otherwise(y * 2 / (root + w0))
        found = F.when(demand < upto[i + 1], x + t0).otherwise(found)
    return found


def _demand_at(knots: Knots, t: Column) -> Column:
    """The integral from 0 to time ``t``."""
    upto = cumulative(knots)
    found = F.lit(upto[-1])
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        slope = (w1 - w0) / (t1 - t0)
        x = t - t0
        found = F.when(t < t1, x * w0 + x * x * (slope / 2) + upto[i]).otherwise(found)
    return found


def _sizes(batches):
    for batch in batches:
        n = np.zeros(len(batch), np.int64)
        for i, j, data, offsets in K.text_slices(batch.column(2)):
            n[i:j] = K.row_counts(K.word_spans(data, offsets)[2], j - i)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], names=["id", "source", "size"])


def _pick(values: Sequence, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def targets(sized: DataFrame, schedules: Sequence[Knots], max_repeats: int, work: Work) -> DataFrame:
    """``(source, schedule, source_size, base, target)`` per source: schedules are
    dealt in code-point order, null last; ``base`` is the words of earlier sources."""
    weights = [cumulative(k)[-1] for k in schedules]
    totals = work.cut(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "one", F.lit(1).cast("bigint")), "sources")
    ranked = running_total(totals, [F.col("source").asc_nulls_last()], "one", work, "rank").select(
        "source", "source_size", F.col("before").alias("place"))
    ranked = running_total(work.cut(ranked, "ranked"), [F.col("place")], "source_size", work, "base").select(
        "source", "source_size", F.col("before").alias("base"),
        (F.col("place") % len(schedules)).cast("int").alias("schedule"))
    sources = work.cut(ranked.withColumn("weight", _pick(weights, F.col("schedule"))), "weighed")

    limit = F.col("source_size") * max_repeats
    words = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    above, state = F.lit(False), None
    while True:
        now = sources.agg(
            F.sum(F.when(above, limit)).alias("cut"), F.count(F.when(above, 1)).alias("n"),
            F.sum(F.when(~above, F.col("weight"))).alias("w")).first()
        left = float(words - int(now["cut"] or 0))
        share = F.col("weight") * left / (now["w"] or 1.0)
        if state == now["n"]:
            break
        state = now["n"]
        above = above | (share > limit)
    return sources.select("source", "schedule", "source_size", "base",
                          F.when(above, limit.cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, schedules: Sequence[Knots], max_repeats: int = 3, seed: int = 13, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(<id_col>, source, size, source_size, target, copies)`` of every document;
    ``copies`` lists ``(start, words, position)`` of each use: its first word's place
    in the source's run, the words taken and the training position in words."""
    work = Work(docs.sparkSession, "mix")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).alias("text"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    sized = work.cut(rows.mapInArrow(_sizes, f"id {kind}, source string, size bigint").select(
        "id", "source", "size", F.substring(key, 1, 16).alias("key"), F.monotonically_increasing_id().alias("row")), "sized")
    plan = work.cut(targets(sized, schedules, max_repeats, work), "plan")
    demand = [0.0] * len(schedules)
    for r in plan.groupBy("schedule").agg(F.sum("target").alias("n")).collect():
        demand[r["schedule"]] = r["n"]

    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("id").asc_nulls_last(), F.col("size"), F.col("row")]
    placed = running_total(sized, order, "size", work, "order")
    plan = plan.withColumnRenamed("source", "of")
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("of")), "left")

    copies = []
    for e in range(max_repeats):
        start = F.col("before") - F.col("base") + F.col("source_size") * e
        words = F.least(F.col("size"), F.floor("target") - start)
        copies.append(F.when(words > 0, F.struct(start.alias("start"), words.alias("words"))))

    def due(c: Column) -> Column:
        t = F.lit(0.0)
        for i, knots in enumerate(schedules):
            part = c["start"].cast("double") / F.col("target") * cumulative(knots)[-1]
            t = F.when(F.col("schedule") == i, _time_of(knots, part)).otherwise(t)
        return F.struct(c["start"].alias("start"), c["words"].alias("words"), t.alias("time"))

    def positioned(c: Column) -> Column:
        position = F.lit(0.0)
        for knots, n in zip(schedules, demand):
            position = position + _demand_at(knots, c["time"]) * (n / (cumulative(knots)[-1] or 1.0))
        return F.struct(c["start"].alias("start"), c["words"].alias("words"), position.alias("position"))

    uses = F.filter(F.array(*copies), lambda c: c.isNotNull())
    return placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        F.transform(F.transform(uses, due), positioned).alias("copies"))


def taken(mixed: DataFrame) -> Column:
    """Words the mix takes of a document, repeats counted."""
    return F.aggregate(mixed["copies"], F.lit(0).cast("bigint"), lambda n, c: n + c["words"])


def training_order(mixed: DataFrame, *cols: str) -> DataFrame:
    """One row per copy, range-sorted by training position: ``cols``, ``start``,
    ``words``, ``position``."""
    return mixed.select(*cols, F.explode("copies").alias("c")).select(
        *cols, "c.start", "c.words", "c.position").orderBy("position", "start", *cols)
