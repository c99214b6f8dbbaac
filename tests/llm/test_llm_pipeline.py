import sys

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import __spark_entry__ as E
import corpus_pipeline as C
from sparkcount.llm.storage import Work

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id long"
EN = "the cat and the dog went with that thing over the hill and far away to see what it could find there"
DE = "der hund und die katze sind nicht hier aber wir werden sie bald wieder finden und nach hause bringen"


def test_stages_one_after_another(spark):
    near = EN.split()
    near[-1] = "here"
    long_a, long_b = " ".join([EN + f" {i}" for i in range(40)]), " ".join([EN + f" {i}" for i in range(40)]) + " end"
    rows = [(1, EN, "en"), (2, EN, "en"), (3, DE, "de"), (4, None, "en"), (5, "", "de"), (6, "123 --- 4", "en"),
            (7, long_a, "en"), (8, long_b, "en"), (9, " ".join(near), "en"), (10, DE + " " + DE[:50], None), (3, DE, "de")]
    docs = spark.createDataFrame([(i, t, k, "s", len(t or ""), -1) for i, t, k in rows], SCHEMA)
    work, kept = Work(spark, "test"), {}
    for name, stage in C.STAGES:
        out = work.cut(stage(spark, docs, ""), name)
        kept[name] = sorted(r.doc_id for r in out.collect())
        if name != C.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out
    assert kept["language_id"] == [1, 2, 3, 3, 7, 8, 9, 10]
    assert kept["exact_dedup"] == [2, 3, 7, 8, 9, 10]
    assert kept["near_dedup"] == [2, 3, 7, 10]
    assert sorted(set(kept["pack"])) == [2, 3, 7, 10]
    assert sum(r.length for r in docs.collect()) > 0


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_registered():
    names = [n for n, _ in C.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "pack"]
    q = E.queries()
    assert "pipeline" in q and sum(n.startswith("op") for n in q) == 13
    assert {n.split("_")[0] for n in q if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "sparkcount.llm.queries" in sys.modules
