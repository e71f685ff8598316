"""Queries against their SQL on rows that the smallest tables lack."""

import duckdb

import __spark_entry__  # noqa: F401  registers the queries
import oracle
from curata.plans import catalogue


def differences(spark, folder, name, **tables):
    """What differs from the SQL over tables given as (rows, schema), or ''."""
    con = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return oracle.differences(con, catalogue.oracle_sql()[name], catalogue.queries()[name](spark, str(folder)))


def test_status_of_customers_without_orders(spark, tmp_path):
    orders = [(1, 1, "F"), (2, 1, "F"), (3, 2, "F"), (4, 2, "O"), (5, 3, "O"), (6, 5, None), (7, 6, None), (8, 6, "F")]
    got = differences(spark, tmp_path, "run_status", customer=([(k,) for k in range(1, 7)], "c_custkey long"), orders=(orders, "o_orderkey long, o_custkey long, o_orderstatus string"))
    assert got == ""


def test_titles_whose_capitals_are_other_letters(spark, tmp_path):
    """Whole titles of letters that upper case turns into others, at lengths that make the entry's title the label's in capitals."""
    texts = ["Ch\u00df " * 30, "\u00df" * 60, "\u0149\ufb01\u0130 " * 24, "stra\u00dfe " * 9, "\u03c3\u03c2 " * 21, "ein Satz, " * 9]
    rows = [(i, t, "de", "src1", len(t)) for i, t in enumerate(texts)]
    assert all(len(t) % 3 == 0 for t in texts)
    assert differences(spark, tmp_path, "scored_records", documents=(rows, "doc_id long, text string, lang string, source string, n_chars long")) == ""
