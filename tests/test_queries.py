"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_of, spark_rows
from kindling.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in E.queries().items() if k in registry.queries()}
ORACLE = registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"als_recommend", "classify_documents", "svm_documents"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["partkey", "name", "count"] and df.count() == 10


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    scols, srows = spark_rows(QUERIES[name](spark, SF))
    ocols, orows = rows_of(duck.execute(ORACLE[name]).fetchdf())
    assert scols == ocols
    assert srows == orows


def test_als_recommend_properties(spark):
    rows = QUERIES["als_recommend"](spark, SF).collect()
    assert {r["user"] for r in rows} == {1}
    rows.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 11))
    assert len({r["item"] for r in rows}) == 10
    assert all(a["score"] >= b["score"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("name", ["classify_documents", "svm_documents"])
def test_classify_documents_properties(spark, name):
    from pyspark.sql import functions as F

    from kindling.operators.splits import hash_bucket

    rows = QUERIES[name](spark, SF).collect()
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    fitted = F.col("quality").isNotNull() & (hash_bucket("doc_id") < 70)
    held = {r["doc_id"]: r["quality"] for r in d.join(lab, "doc_id", "left").filter(~fitted).collect()}
    assert len(rows) == len(held) and {r["doc_id"] for r in rows} == set(held)
    assert all(r["prediction"] in (0, 1) and r["quality"] == held[r["doc_id"]] for r in rows)
