"""The registered queries against their SQL, and the pipeline's stages against each other."""

import os

import duckdb
import pytest

import corpus_pipeline
from ledgerspark.llm.oracles import ORACLES
from ledgerspark.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    found = sorted((tuple(r) for r in result.select(*columns).collect()), key=repr)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = sorted(range(len(names)), key=names.__getitem__)
    assert found == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)


def test_pipeline_stages_keep_whole_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns, seen = docs.columns, docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, seen, SF_DIR).write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in seen.collect()}
            seen = after
    kept = {r["doc_id"] for r in seen.collect()}
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == kept
    assert 0 < len(kept) < len(before)
    assert corpus_pipeline.run(spark, SF_DIR).count() == after.count()


def test_the_operators_and_the_stages_in_order():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "ngram_join", "packing",
    ]
