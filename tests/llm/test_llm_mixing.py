"""Soft mixing: targets, rates and the classifier."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import mixing as m
from tidegauge.llm.queries import BUDGET, MIX, domains


def members(spark, p, n):
    return spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(p, n)], "p array<double>, n_tokens long")


@pytest.mark.parametrize("targets", [[0.5, 0.3, 0.2], [0.1, 0.1, 0.8], [1.0, 0.0, 0.0]])
def test_rates_meet_the_targets(spark, targets):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.2, 0.2, 0.2], 400)
    n = rng.integers(0, 500, 400)
    steps = m.fit_rates(members(spark, p, n), targets, most=10.0, passes=200)
    rate = steps.rates(p)[0]
    assert rate.min() >= 0
    got = (rate * n) @ p / n.sum()
    # Exact: the least squares over rates of at least zero, by very many plain steps.
    best = np.ones(400)
    for _ in range(20000):
        gap = (best * n) @ p / n.sum() - targets
        best = np.clip(best - p @ gap, 0, 10.0)
    want = (best * n) @ p / n.sum()
    assert np.abs(got - targets).max() <= np.abs(want - targets).max() + 0.01


def test_documents_meet_the_production_targets(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model, steps = m.mix(docs, domains(labels), MIX, BUDGET)
    assert model.names == ["good", "plain", "toxic"]
    found = m.with_rates(docs, model, steps).cache()
    share = found.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.element_at("p", i + 1)) / F.sum("n_tokens")
                        for i in range(3)]).first()
    for got, name in zip(share, model.names):
        assert abs(got - BUDGET * MIX[name]) < 0.02
    mixed = m.mixed_documents(docs, model, steps)
    assert mixed.columns == docs.columns
    want = {r["doc_id"]: r["n"] for r in found.withColumn("n", m.copies("rate", "doc_id")).collect() if r["n"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = domains(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    fit = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0)
    model = m.learn_domains(docs, fit)
    rest = m.with_rates(docs, model, m.Steps(0.0, 4.0)).join(labels.join(fit, "doc_id", "left_anti"), "doc_id")
    rows = [(model.names[int(np.argmax(r["p"]))], r["domain"]) for r in rest.collect()]
    plain = [a for a, b in rows if b == "plain"]
    good = [a for a, b in rows if b == "good"]
    assert len(good) > 50 and good.count("good") / len(good) > 0.9
    assert plain.count("plain") / len(plain) > 0.6


def test_labels_beyond_the_bound_are_left_out(spark):
    docs = spark.createDataFrame([(i, f"w{i % 2} " * 9) for i in range(100)], "doc_id long, text string")
    labelled = docs.select("doc_id", F.concat(F.lit("d"), F.col("doc_id") % 2).alias("domain"))
    small = m.learn_domains(docs, labelled, most_labelled=10)
    assert sorted(small.names) == ["d0", "d1"]
    assert np.allclose(small.prior.sum(), 1)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 4), (2, "a b", 5), (None, "a a b", 6)], "doc_id long, text string, rate int")
    labelled = spark.createDataFrame([(2, "x"), (1, "y"), (None, "x"), (2, None)], "doc_id long, domain string")
    model, steps = m.mix(docs, labelled, {"x": 1.0})
    found = m.with_rates(docs, model, steps).collect()
    assert [r["n_tokens"] for r in found] == [0, 0, 2, 3]
    assert all(r["rate"] >= 0 and abs(sum(r["p"]) - 1) < 1e-9 for r in found)
    assert m.mixed_documents(docs, model, steps).columns == docs.columns
    none = m.mix(docs.limit(0), labelled.limit(0), {"x": 1.0})
    assert none[0].names == [""] and not none[1].history
    assert m.mixed_documents(docs.limit(0), *none).count() == 0


def test_copies_keep_the_expected_number(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit(1.3).alias("rate"))
    assert abs(rows.agg(F.avg(m.copies("rate", "doc_id"))).first()[0] - 1.3) < 0.02


@pytest.mark.parametrize("share", [0.002, 0.0002])
def test_defaults_meet_targets_of_rare_domains(spark, share):
    """Domains of far less than a quarter of their target, by the defaults of production."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([20 * (0.9 - share), 2, 20 * share], 4000)
    n = rng.integers(1, 500, 4000)
    assert n @ p[:, 2] / n.sum() < MIX["toxic"] / 4
    steps = m.fit_rates(members(spark, p, n), list(MIX.values()), BUDGET)
    rate = steps.rates(p)[0]
    got = (rate * n) @ p / n.sum() / BUDGET
    assert rate.min() >= 0 and rate.max() > 4
    assert np.abs(got - list(MIX.values())).max() <= 1.1e-3 and np.abs(steps.gap).max() <= 1e-3


def test_missed_targets_are_told(spark):
    p, n = np.array([[0.6, 0.4], [0.5, 0.5]]), np.array([100, 50])
    with pytest.warns(UserWarning, match="misses its targets"):
        steps = m.fit_rates(members(spark, p, n), [1.0, 0.0])
    got = (steps.rates(p)[0] * n) @ p / n.sum()
    assert np.allclose(got - [1.0, 0.0], steps.gap, atol=1e-6)
    # Least squares: all in the first document, at 0.6 / (0.6**2 + 0.4**2) of the tokens.
    assert np.allclose(got, np.array([0.6, 0.4]) * 0.6 / 0.52, atol=2e-3)
