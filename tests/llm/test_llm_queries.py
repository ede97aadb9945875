"""The registered queries: SQL where there is any, else their contracts; the pipeline."""

import zlib

import duckdb
import pandas as pd
import pytest
from conftest import SF

import __spark_entry__ as contract
import corpus_pipeline
from tidegauge.llm.oracle import LLM_ORACLES
from tidegauge.llm.queries import LLM_QUERIES

COLUMNS = {
    "op1_simhash": "doc_id fingerprint component_id",
    "op2_prefix_counts": "doc_id n_bytes n_tokens over_limit",
    "op3_kd_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_language_mixture": "doc_id held_out lang_pred score",
    "op6_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op7_soft_mixing": "doc_id rate",
    "op8_token_file": "doc_id start n_tokens ids_crc32",
    "op9_kneser_ney_quality": "doc_id perplexity threshold kept",
    "op10_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def test_registered():
    assert set(LLM_QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(COLUMNS) == set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_one_row_per_row_of_the_table(spark, name):
    table = "pages" if name == "op4_warc" else "documents"
    key = "page_id" if name == "op4_warc" else "doc_id"
    ours = LLM_QUERIES[name](spark, SF).toPandas()
    assert set(COLUMNS[name].split()) <= set(ours.columns)
    assert sorted(ours[key]) == sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").collect())
    if name in LLM_ORACLES:
        db = duckdb.connect()
        for t in ("documents", "benchmark", "pages"):
            db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        theirs = db.execute(LLM_ORACLES[name]).df()
        assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


def test_held_out_rows_by_checksum(spark):
    for r in LLM_QUERIES["op5_language_mixture"](spark, SF).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_pipeline_stages_take_effect(spark):
    docs, counts = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        counts.append((name, docs.count()))
        assert set(before.columns) <= set(docs.columns)
        if stage is not corpus_pipeline.shard:
            assert docs.columns == before.columns
        if stage is not corpus_pipeline.mix_domains:
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    sizes = dict(counts)
    assert sizes["simhash_near_dedup"] < sizes["language_id"]
    assert sizes["benchmark_decontamination"] <= sizes["simhash_near_dedup"]
    assert sizes["sharding"] == sizes["mixing"]
    again = corpus_pipeline.run(spark, SF)
    assert rows(again.toPandas()) == rows(docs.toPandas())
