"""Language mixtures: held-out accuracy, mixed and empty texts."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import language as g
from tidegauge.llm.queries import held_out


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return g.learn(docs.filter(~held_out()))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(held_out())
    found = g.languages(docs, model)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95
    assert found.filter("score < 0 or score > 1").count() == 0


def test_a_text_of_two_languages_has_both(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(held_out() & (F.length("text") > 1500))
    one = {r["lang"]: r["text"] for r in docs.collect()}
    mixed = one["en"][:1000] + " " + one["de"][:500]
    row = g.languages(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    shares = {x["lang"]: x["share"] for x in row["languages"]}
    assert row["lang_pred"] == "en" and set(shares) == {"en", "de"}
    assert 0.5 < shares["en"] < 0.8 and abs(sum(shares.values()) - 1) < 1e-6


def test_counts_of_the_model(spark):
    rows = [("a", "ab! Ab"), ("a", None), (None, "zz"), ("b", ""), ("b", "é")]
    model = g.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["a", "b"]
    assert np.allclose(model.chance.sum(axis=0), 1, atol=1e-3)
    of, bucket = g.trigrams(*g.utf8(__import__("pyarrow").array(["ab! Ab", "", "c"])))
    # " ab", "ab ", "b a", " ab", "ab " and " c "
    assert of.tolist() == [0, 0, 0, 0, 0, 2] and bucket[0] == bucket[3] and bucket[1] == bucket[4]


def test_mixture_equals_a_plain_loop():
    rng = np.random.default_rng(1)
    chance, counts = rng.random((40, 3)).astype(np.float32), rng.integers(1, 5, 40).astype(float)
    starts = np.array([0, 15])
    share, likely, bound = g.mixtures(chance, counts, starts, np.ones((2, 3)))
    for t, (a, b) in enumerate([(0, 15), (15, 40)]):
        s = np.full(3, 1 / 3)
        for _ in range(2000):
            each = chance[a:b] * s
            s = (counts[a:b, None] * each / each.sum(1, keepdims=True)).sum(0) / counts[a:b].sum()
        best = (counts[a:b] * np.log(chance[a:b] @ s)).sum()
        assert likely[t] <= best + 1e-3 and best - likely[t] < 0.2 and best <= bound[t] + 1e-3


def test_nulls_no_letters_clashes_and_empty_tables(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (4, "日本", "x"), (4, "der die das", "x"), (5, "—", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in g.languages(docs, model).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)] and got[5] == (5, "und", 0.0)
    assert got[3][1] != "und" and got[4][1] == "de"
    kept = g.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {4}
    assert g.languages(docs.limit(0), model).count() == 0
    none = g.learn(docs.limit(0).withColumn("lang", F.lit("en")))
    assert {r["lang_pred"] for r in g.languages(docs, none).collect()} == {"und"}


def test_a_very_long_text_counts_whole(spark, model):
    text = "der die das und ist nicht ein eine " * 3000 + "the and of that with " * 30000
    row = g.languages(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row["lang_pred"] == "en" and len(row["languages"]) >= 2


def test_a_text_alone_gets_what_it_gets_beside_others(spark, model):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") > 400).limit(40).collect()]
    texts = [a[:300] + " " + b[:200 + 5 * i] for i, (a, b) in enumerate(zip(texts, texts[1:]))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    together = {r["doc_id"]: r["languages"] for r in g.languages(docs, model).collect()}
    for i in range(0, len(texts), 5):
        alone = g.languages(spark.createDataFrame([(i, texts[i])], "doc_id long, text string"), model).first()
        assert alone["languages"] == together[i]


def test_clean_texts_stay_and_what_is_no_learned_language_goes(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(held_out() & F.col("text").rlike("[A-Za-z]"))
    assert g.keep_identified(docs, model).count() >= 0.99 * docs.count()
    clean = [r["text"] for r in docs.filter(F.length("text") > 300).limit(6).collect()]
    mixed = [" ".join(t[:200] for t in clean[i:i + 4]) for i in range(3)]
    junk = ["Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 2,
            "今天天气很好我们一起去公园散步然后回家吃饭晚上看电影" * 4, "xqzj qxzjv zzqx jjxq vqxz " * 10]
    kept = g.keep_identified(spark.createDataFrame(list(enumerate(mixed + junk)), "doc_id long, text string"), model)
    assert {r["doc_id"] for r in kept.collect()} == {0, 1, 2}
