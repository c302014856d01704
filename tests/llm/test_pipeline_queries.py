import duckdb
import pytest

import corpus_pipeline
from trafficlens.llm import queries

from .conftest import SF001, SF01

COLUMNS = {
    "op1_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op2_quality": "doc_id held_out score predicted",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_language": "doc_id held_out lang_pred score",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_records": "doc_id start n_tokens ids_crc32",
    "op7_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_pseudo_likelihood": "doc_id n_tokens log_prob mean_log_prob",
    "op10_packing": "doc_id n_tokens bucket bound place batch slot padding",
    "op13_exact_dedup": "doc_id keep_id group_size kept text_sha256",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_query_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    assert df.columns == COLUMNS[name].split()
    ids = [r.doc_id for r in df.collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    got = con.execute(queries.SQL[name])
    columns = [c[0] for c in got.description]
    want = sorted(got.fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES[name](spark, SF01).select(*columns).collect()) == want


def test_pipeline_stages(spark):
    """Every stage by itself: rows only go, columns stay, decisions hold."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, before, SF01), f"test-{name}")
        had = {r.doc_id for r in before.select("doc_id").collect()}
        has = {r.doc_id for r in after.select("doc_id").collect()}
        assert has <= had and len(has) > 0.8 * len(had) and after.select("doc_id").count() == len(has)
        if name == "packing":
            assert has == had
        else:
            assert after.columns == columns
            same = before.join(after.select("doc_id"), "doc_id", "left_semi").exceptAll(after)
            assert same.count() == 0
        if name == "near_duplicates":
            rows = queries.simhash.near_duplicates(before).collect()
            assert has == {r.component_id for r in rows}
        if name == "decontamination":
            bad = queries.decontam.contamination(before, spark.read.parquet(f"{SF01}/benchmark.parquet")).where("contaminated")
            assert had - has == {r.doc_id for r in bad.collect()}
        before = after


def test_pipeline_edges(spark, edge_docs, no_docs):
    for df in (edge_docs, no_docs):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF001), f"edge-{name}")
            assert name == "packing" or docs.columns == df.columns
