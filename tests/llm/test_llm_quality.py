"""Judgement of documents and thresholds; the model itself is tested in test_llm_words."""

from collections import defaultdict

import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import quality as q


def test_judgement_of_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = q.judge_quality(docs, labels.filter("quality = 1 and toxic = 0")).join(labels, "doc_id").cache()
    kept = {r["quality"]: r["k"] for r in rows.filter("toxic = 0").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.4


def test_thresholds_are_quantiles_of_each_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = q.judge_quality(docs, docs.filter("doc_id % 2 = 0"), quantile=0.5).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        if r["trusted"] and r["perplexity"] is not None:
            by[r["lang"]].append(r["perplexity"])
    for r in rows:
        values = sorted(by[r["lang"]])
        assert abs(np.searchsorted(values, r["threshold"]) - (len(values) - 1) / 2) <= 1
        assert r["kept"] == (r["perplexity"] is not None and r["perplexity"] <= r["threshold"])


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "ab ab", "en", 1.0), (1, "ab ab", "en", 1.0), (2, None, None, 2.0), (3, "", "xx", 3.0),
                                  (None, "ab", None, 4.0), (4, "ab", "yy", 5.0)], "doc_id long, text string, lang string, perplexity double")
    ids = spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")
    rows = q.judge_quality(docs, ids).collect()
    assert sorted((r["doc_id"] or 0, r["trusted"], r["kept"]) for r in rows if r["doc_id"] in (1, 2, 3)) == [
        (1, True, True), (1, True, True), (2, False, False), (3, False, False)]
    assert all(r["threshold"] is not None for r in rows)
    assert not any(r["kept"] for r in q.judge_quality(docs, ids.limit(0)).collect())
    assert q.judge_quality(docs.limit(0), ids).count() == 0
