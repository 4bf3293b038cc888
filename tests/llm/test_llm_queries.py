"""Registered queries: SQL where there is one, and the pipeline on a small table."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skyloom.llm import queries

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert len(names) == 13 and "pipeline" in entry.queries()
    assert set(queries.ORACLES) == {
        "op5_line_dedup", "op6_secret_scan", "op7_exact_dedup",
        "op11_centroid_clusters", "op12_suffix_dedup", "op13_conversation_repair",
    }


@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_secret_scan", "op7_exact_dedup", "op12_suffix_dedup"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(repr, want.fetchall())) == sorted(
        repr(tuple(r)) for r in queries.QUERIES[name](spark, SF).select(columns).collect()
    )


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
