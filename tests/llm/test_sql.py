"""The queries that have SQL, against it: over the smallest tables, and over made ones with many links."""

import duckdb
import pytest

import oracle
from curata.llm import queries
from test_cover_tree import cases
from test_minhash import made
from test_prefix_trie import SCHEMA
from test_prefix_trie import cases as turns


@pytest.mark.parametrize("name", ["op2_cover_tree", "op10_minhash", "op12_centroids", "op13_prefix_trie"])
def test_over_the_smallest_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    assert oracle.differences(oracle.connection(sf), queries.ORACLE_SQL[name], queries.QUERIES[name](spark, sf)) == ""


@pytest.mark.parametrize("name", ["op2_cover_tree", "op10_minhash", "op5_backoff"])
def test_over_made_tables(spark, tmp_path, name):
    rows = made() + [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "A b"), (1004, "a  B"), (1005, "a b c"), (7, "x y z"), (7, "x y z"), (None, "a b c")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = cases(5) + [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] * 4), (904, [float("nan")] * 8), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (3, [3.0, 6.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert oracle.differences(con, queries.ORACLE_SQL[name], queries.QUERIES[name](spark, str(tmp_path))) == ""


def test_made_conversations_and_integer_vectors(spark, tmp_path):
    spark.createDataFrame([(*r, 1, "x") for r in turns(4, 40)], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    vectors = [(i, [float((i * j) % 7) / 16 - 0.2 for j in range(64)]) for i in range(120)] + [(5, [0.25] * 64), (None, [0.5] * 64), (200, [None] * 64), (201, [1.0]), (202, [float("inf")] * 64), (203, None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for table in ("conversations", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    for name in ("op12_centroids", "op13_prefix_trie"):
        assert oracle.differences(con, queries.ORACLE_SQL[name], queries.QUERIES[name](spark, str(tmp_path))) == "", name
