"""The registered queries of this package: against their SQL, or at least run over their whole tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

from tillgrid.llm import queries

SF_DIR = "/root/testdata/sf0.001"
ROWS = {
    "op1_source_mix": "documents", "op4_fingerprints": "documents", "op5_bpe": "documents", "op7_license_scan": "documents",
    "op8_language_id": "documents", "op10_token_orc": "documents", "op11_periodic_runs": "documents", "op13_sharding": "documents",
}


def test_every_query_is_covered():
    assert set(queries.QUERIES) == set(queries.SQL) | set(ROWS)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF_DIR), name, SF_DIR) == ""


@pytest.mark.parametrize("name", list(ROWS))
def test_query_has_a_row_for_each_of_its_table(spark, name):
    ids = spark.read.parquet(f"{SF_DIR}/{ROWS[name]}.parquet").select("doc_id")
    got = queries.QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    assert sorted(got) == sorted(ids.collect())


def test_language_of_held_out_documents(spark):
    rows = queries.op8_language_id(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_pipeline_keeps_and_encodes(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens").collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    assert got and {r.doc_id for r in got} <= ids and len({r.doc_id for r in got}) > len(ids) // 3
