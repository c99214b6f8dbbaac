"""Exact dedup by deterministic block naming (DataFrame functions only).

Every text is cut into fixed-size byte blocks.  The distinct blocks are sorted by
a 128-bit route and numbered, so equal blocks, and only those, share an integer name.  Adjacent
names are paired, distinct pairs are sorted and numbered in turn, and so on
until a document has one name: ``(level, name)`` is its identity.  Two documents
have the same identity exactly when their bytes are equal; no digest decides.

Block contents cross the network once, after map-side distinct.  Rows find
their block's name through its route; the names table records whether two
different blocks share a route, and those are sorted and matched by content.
Names do not depend on how the tables are partitioned.

Defined cases: a null text counts as empty (one empty block); null ids are one
id of their own and lose to any other; rows repeated with the same id and text
are counted and returned each, at most one of them kept; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcount.llm.storage import Work

BLOCK_BYTES = 4096
ROUTE_BITS = 64


def _route(block: Column, bits: int) -> list[Column]:
    """Two seeded 64-bit hashes of a block (``bits`` narrows them, for tests)."""
    one = F.shiftrightunsigned(F.xxhash64(F.lit(1), block), 64 - bits)
    two = F.shiftrightunsigned(F.xxhash64(F.lit(2), block), 64 - bits)
    return [one.alias("r1"), two.alias("r2")]


def _numbered(distinct: DataFrame, work: Work, tag: str, by: list[str], order: list[str]) -> DataFrame:
    """A written table of distinct rows with their ``name``, 0 and up in ``order``.

    Ranges of ``by``, the first columns of ``order``, are sorted and numbered apart
    and begin where the ranges before them end (one count per range), so a row's
    name follows from the rows alone, however they are partitioned."""
    here = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = work.cut(distinct.repartitionByRange(*by).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("range"), here.alias("at")), tag)
    ranges = placed.groupBy("range").agg(F.count("*").alias("n"))
    first = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("first"))
    return placed.join(F.broadcast(first), "range").select(
        *distinct.columns, (F.col("first") + F.col("at")).alias("name"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES, route_bits: int = ROUTE_BITS,
               work: Work | None = None) -> DataFrame:
    """``(id, sha, copies, level, name)``: one row per id and text with its identity."""
    work = work or Work(docs.sparkSession, "block-naming")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("id"), text.alias("b")).select(
        "id", F.unhex(F.sha2("b", 256)).alias("sha"), "b",
        F.greatest(F.ceil(F.octet_length("b") / F.lit(block_bytes)), F.lit(1))
        .cast("int").alias("n"))
    blocks = base.select("id", "sha", "n", "b", F.explode(F.sequence(
        F.lit(0), F.col("n") - 1)).alias("idx")).select(
        "id", "sha", "n", "idx",
        F.expr(f"substring(b, idx * {int(block_bytes)} + 1, {int(block_bytes)})").alias("block"))

    # how many blocks share a route: one, but for collisions
    routes = work.cut(blocks.select("block").distinct().select(*_route(F.col("block"), route_bits))
                      .groupBy("r1", "r2").agg(F.count("*").alias("blocks")), "routes")
    shared = _numbered(routes, work, "block-names", ["r1", "r2"], ["r1", "r2"])
    routed = blocks.select("id", "sha", "n", "idx", *_route(F.col("block"), route_bits))
    clash = shared.where("blocks > 1")
    if clash.isEmpty():
        level = routed.join(shared.select("r1", "r2", "name"), ["r1", "r2"])
    else:
        alone = routed.join(shared.where("blocks = 1").select("r1", "r2", "name"), ["r1", "r2"])
        content = (blocks.select("*", *_route(F.col("block"), route_bits))
                   .join(clash.select("r1", "r2"), ["r1", "r2"], "left_semi"))
        content = work.cut(content, "shared-route")
        by_content = _numbered(content.select("r1", "r2", "block").distinct(), work, "content-names",
                               ["r1", "r2"], ["r1", "r2", "block"]).select("block", (-F.col("name") - 1).alias("name"))
        level = alone.select("id", "sha", "n", "idx", "name").unionByName(
            content.join(by_content, "block").select("id", "sha", "n", "idx", "name"))
    # repeated rows (same id and text) fold into one row with their number
    level = work.cut(level.groupBy("id", "sha", "n", "idx").agg(
        F.max("name").alias("name"), F.count("*").alias("copies")), "level0")

    done, k = [], 0
    while True:
        done.append(level.where("n = 1").select(
            "id", "sha", "copies", F.lit(k).alias("level"), "name"))
        open_ = level.where("n > 1")
        if open_.isEmpty():
            break
        pairs = work.cut(open_.groupBy("id", "sha", F.expr("idx div 2").cast("int").alias("idx")).agg(
            F.max("copies").alias("copies"), F.expr("int((max(n) + 1) div 2)").alias("n"),
            F.max(F.when(F.expr("idx % 2 = 0"), F.col("name"))).alias("l"),
            F.max(F.when(F.expr("idx % 2 = 1"), F.col("name"))).alias("r")), f"pairs{k + 1}")
        named = _numbered(pairs.select("l", "r").distinct(), work, f"names{k + 1}", ["l", "r"], ["l", "r"])
        p, q = pairs.alias("p"), named.alias("q")
        # an odd last name has no right neighbour: null equals null here
        level = work.cut(p.join(q, (F.col("p.l") == F.col("q.l")) & F.col("p.r").eqNullSafe(F.col("q.r")))
                         .select("p.id", "p.sha", "p.n", "p.idx", "q.name", "p.copies"),
                         f"level{k + 1}")
        k += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, route_bits: int = ROUTE_BITS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, level, name``.

    Of equal texts the row with the largest id stays."""
    work = Work(docs.sparkSession, "block-naming")
    ids = work.cut(identities(docs, id_col, text_col, block_bytes, route_bits, work), "identities")
    groups = work.cut(ids.groupBy("level", "name").agg(
        F.max("id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    rows = ids.join(groups, ["level", "name"]).select(
        "*", F.explode(F.expr("sequence(1L, copies)")).alias("c"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("c") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "level", "name")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each group of equal texts."""
    work = Work(docs.sparkSession, "block-naming")
    kept = work.cut(exact_dedup(docs, id_col, text_col).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count("*").alias("copies")).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_sha"), "copies"), "kept")
    # all columns in one struct, so that none of their names can clash
    packed = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"))
    row = F.col("row")
    sha = F.unhex(F.sha2(F.coalesce(row.getField(text_col), F.lit("")).cast("binary"), 256))

    def rows(of: DataFrame, how: str) -> DataFrame:
        return packed.join(of, row.getField(id_col).eqNullSafe(F.col("kept_id")) & (sha == F.col("kept_sha")), how)

    out = rows(kept.where("copies = 1"), "left_semi").select("row")
    repeated = kept.where("copies > 1")
    if not repeated.isEmpty():  # rows repeated with the same id and text: one stays
        out = out.unionByName(rows(repeated, "inner").dropDuplicates(["kept_id", "kept_sha"]).select("row"))
    return out.select("row.*")
