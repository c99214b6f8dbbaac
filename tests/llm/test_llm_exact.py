import hashlib
import random
from collections import defaultdict

import pytest

from conftest import SF001
from oracle_check import compare, duck
from sparkcount.llm import op04_block_naming as op
from sparkcount.llm import queries as Q

SCHEMA = "doc_id long, text string, name string, level int, sha string"


def docs(spark, rows):
    """Documents with extra columns that clash with the operator's own names."""
    return spark.createDataFrame([(i, t, "n", 1, "s") for i, t in rows], SCHEMA)


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("route_bits", [64, 2])
def test_small_blocks_against_brute_force(spark, route_bits):
    rng = random.Random(route_bits)
    words = ["ab", "abcd", "é", "xyzxyz", ""]
    rows = [(i, "".join(rng.choice(words) for _ in range(rng.randrange(0, 9)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "abcdabcd" * 40), (503, "abcdabcd" * 40), (504, "abcdabcd" * 39 + "abcdabce"),
             (503, "abcdabcd" * 40), (503, "other"), (None, "abcd"), (None, "alone")]
    check(op.exact_dedup(docs(spark, rows), block_bytes=4, route_bits=route_bits), rows)


def test_empty_table(spark):
    assert op.exact_dedup(docs(spark, [])).count() == 0


def test_deduplicated_keeps_columns_and_one_row(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (5, "")]
    out = op.deduplicated(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "name", "level", "sha"]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(2, "a"), (3, "b"), (5, "")]


def test_query_matches_oracle_without_python(spark):
    r = compare(spark, duck(SF001), "op4", Q.QUERIES["op4_exact_dedup"], Q.ORACLE["op4_exact_dedup"], SF001)
    assert r["hash_ok"] and r["cols_ok"], r
    plan = Q.op4_exact_dedup(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_deduplicated_with_clashing_columns(spark):
    schema = "doc_id long, text string, copies int, __id long, __sha string, kept_id int, row string, `x.y` int"
    rows = [(1, "a", 1, 2, "s", 3, "r", 4), (1, "a", 1, 2, "s", 3, "r", 4), (2, "a", 1, 2, "s", 3, "r", 4), (3, None, 1, 2, "s", 3, "r", 4),
            (3, None, 9, 2, "s", 3, "r", 4), (None, "b", 1, 2, "s", 3, "r", 4)]
    out = op.deduplicated(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "copies", "__id", "__sha", "kept_id", "row", "x.y"]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(2, "a"), (3, None), (None, "b")], key=str)


@pytest.mark.parametrize("route_bits", [64, 2])
def test_names_do_not_follow_the_partitioning(spark, route_bits):
    docs = spark.createDataFrame([(i, "ab" * (i % 23) + str(i % 7)) for i in range(300)], "doc_id long, text string")
    found = []
    for n in (1, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(n + 2))
        found.append({(r.id, r.level, r.name) for r in op.identities(
            docs.repartition(n), block_bytes=4, route_bits=route_bits).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and len(found[0]) == 300
    alone = [name for _, level, name in found[0] if level == 0]
    assert len(set(alone)) == len({r.text for r in docs.collect() if len(r.text) <= 4})
