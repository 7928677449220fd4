"""The pipeline stage by stage, and the registered queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle
import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_lines

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark conversations".split()


@pytest.mark.parametrize("name", sorted(k for k in entry.oracle_sql() if k.startswith("op")))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert check_oracle.spark_rows(entry.queries()[name](spark, SF)) == check_oracle.rows_of(con.execute(entry.oracle_sql()[name]).fetchdf())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["quality"](spark, docs, SF)
    assert clean.columns == docs.columns
    left = {r.doc_id for r in clean.collect()}
    long_good = {r.doc_id for r in docs.collect() if r.doc_id in labels and labels[r.doc_id].quality and len(r.text.split()) >= 60}
    assert len(long_good - left) <= 0.03 * len(long_good)
    lines = stage["line_dedup"](spark, docs, SF)
    assert lines.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == sorted(x[:2] for x in brute_lines([(r.doc_id, r.text) for r in docs.collect()]))
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    once = stage["near_dedup"](spark, docs, SF)
    want = [d for d, _, c in brute_components([(r.doc_id, r.text) for r in docs.collect()], 5) if d == c]
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.collect()) == want


def test_whole_run(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    per = packed.groupBy("sequence_id").sum("length").collect()
    assert per and max(r[1] for r in per) <= 2048
    assert packed.select("doc_id").distinct().count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_edge_rows_go_through_all_stages(spark, tmp_path):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, clashing columns; then empty tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"word{i} of a long text" for i in range(30_000))
    edge = [(None, "no id here", "en", "s", 1), (None, "no id here", "en", "s", 1), (None, None, None, None, None), (-1, None, "en", "s", None), (-2, "", "en", "s", 0),
            (-3, long, "en", "s", len(long)), (-3, long, "en", "s", len(long)), (-4, " \t\n", "en", "s", 3)]
    docs = docs.unionByName(spark.createDataFrame(edge, docs.schema))
    for c in ("row", "tag", "digest", "component", "severity", "kept"):
        docs = docs.selectExpr("*", f"'x' AS {c}")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path)).checkpoint()
        assert now.columns == docs.columns, name
    assert now.count() and now.where("row <> 'x'").count() == 0
    # The long text repeats its words, which the first stage rejects; the others take it whole, and once.
    for name in ("toxicity", "line_dedup"):
        whole = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
        assert [r.text == long for r in whole.where("doc_id = -3").collect()] == [True, True], name
    once = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path)).where("doc_id = -3 OR doc_id IS NULL").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in once) == [(-3, long), (0, ""), (0, "no id here")]
    packed = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, now.unionByName(docs.where("doc_id IS NULL OR doc_id < 0")), str(tmp_path))
    assert packed.where("doc_id = -1 AND length = 1").count() == 1  # a null text is the end's id alone
    assert packed.where("doc_id = -3").groupBy("piece").count().where("count = 2").count() > 10
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
