"""Table functions in SQL."""

import pytest

from palisade.functions import tables


@pytest.fixture(scope="module")
def docs(spark):
    tables.register(spark)
    rows = [(1, "a", "abcdefghij"), (2, None, ""), (3, "c", None), (4, "d", "see 10.0.0.1, 10.0.0.1 and evil.test"), (4, "d", "evil.test again"), (None, "e", "x.test")]
    spark.createDataFrame(rows, "doc_id long, n string, text string").createOrReplaceTempView("table_function_docs")


def test_chunks(spark, docs):
    got = spark.sql("SELECT * FROM text_chunks(TABLE(table_function_docs), 'text', 4, 1) WHERE doc_id = 1 OR doc_id < 4 ORDER BY chunk_idx")
    assert got.columns == ["doc_id", "n", "chunk_idx", "chunk"]
    assert [tuple(r) for r in got.collect()] == [(1, "a", 0, "abcd"), (1, "a", 1, "defg"), (1, "a", 2, "ghij"), (1, "a", 3, "j")]
    assert spark.sql("SELECT count(*) FROM text_chunks(TABLE(table_function_docs), column => 'text')").first()[0] == 4


@pytest.mark.parametrize("call", ["text_chunks(TABLE(table_function_docs), 'nothing')", "text_chunks(TABLE(table_function_docs), 'text', 5, 5)", "text_chunks(1, 'text')"])
def test_wrong_calls_say_so(spark, docs, call):
    with pytest.raises(Exception, match="no column|greater than overlap|TABLE"):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_indicators_of_partitions(spark, docs):
    sql = "SELECT * FROM table_indicators(TABLE(SELECT doc_id, text FROM table_function_docs) PARTITION BY (doc_id), 'text')"
    got = {(r.doc_id, r.kind, r.value): (r.n, r.n_rows) for r in spark.sql(sql).collect()}
    assert got == {(4, "ip", "10.0.0.1"): (2, 1), (4, "domain", "evil.test"): (2, 2), (None, "domain", "x.test"): (1, 1)}
