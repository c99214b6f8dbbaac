import pytest

from sparkcount.operators import text as T
from sparkcount.sources.tables import documents
from sparkcount.sources.text import read_documents
from conftest import SF001


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def counts(df):
    return {r.word: r.n for r in df.collect()}


def test_blank_split_keeps_empty_words(spark):
    assert counts(T.word_count(docs(spark, ["a  b "]))) == {"a": 1, "b": 1, "": 2}


def test_empty_text_is_one_empty_word(spark):
    assert counts(T.word_count(docs(spark, [""]))) == {"": 1}


def test_newline_stays_inside_word(spark):
    assert counts(T.word_count(docs(spark, ["x\ny x"]))) == {"x\ny": 1, "x": 1}


def test_words_per_document(spark):
    got = {(r.doc_id, r.word): r.n for r in T.words_per_document(docs(spark, ["a a b", "b"])).collect()}
    assert got == {(0, "a"): 2, (0, "b"): 1, (1, "b"): 1}


@pytest.mark.parametrize("K", [1, 3, 8])
def test_four_counts_agree(spark, K):
    d = documents(spark, SF001)
    one = counts(T.word_count(d))
    assert counts(T.word_count_salted(d, K, "per_document_word")) == one
    assert counts(T.word_count_salted(d, K, "on_the_fly", seed=K)) == one
    assert counts(T.word_count_partitioned(d.repartition(K))) == one


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_partitioned_count_hands_words_on(spark, held):
    texts = ["a b a", "", "c  c", None, "b\nb", "é " * 700, "x" * 100_000] * 90
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")
    assert counts(T.word_count_partitioned(rows.repartition(3), held)) == counts(T.word_count(rows))
    assert T.word_count_partitioned(rows.limit(0), held).count() == 0


def test_known_answers_sf0001(spark):
    d = documents(spark, SF001)
    row = T.distinct_word_count(d, 4).collect()[0]
    assert tuple(row) == (27730, 77418) * 4
    assert sum(counts(T.word_count(d)).values()) == 77418
    avg = T.average_word_length(T.word_count(d)).collect()[0]
    assert avg.n_words == 27730
    assert avg.avg_length == pytest.approx(7.413270825820411, abs=1e-9)


def test_average_counts_distinct_words_and_code_points(spark):
    d = docs(spark, ["né😀 né😀 ab", ""])
    avg = T.average_word_length(T.word_count(d)).collect()[0]
    # distinct words: 'né😀' (3), 'ab' (2), '' (0)
    assert avg.n_words == 3 and avg.avg_length == pytest.approx(5 / 3, abs=1e-9)


def test_no_documents(spark):
    d = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert T.document_count(d).collect()[0][0] == 0
    avg = T.average_word_length(T.word_count(d)).collect()[0]
    assert avg.n_words == 0 and avg.avg_length is None


def test_read_documents_lines(spark, scratch):
    path = f"{scratch}/d.txt"
    with open(path, "w") as f:
        f.write("a b\n\nb  c\n")
    d = read_documents(spark, path)
    assert T.document_count(d).collect()[0][0] == 3
    assert counts(T.word_count(d)) == {"a": 1, "b": 2, "c": 1, "": 2}
