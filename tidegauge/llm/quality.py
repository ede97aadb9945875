"""Quality by the perplexity of an n-gram model of trusted texts.

Documents are judged per word (see ``word_model``), trusted ones by a model that they did
not train, against a quantile of the trusted texts of their language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import column, settle
from tidegauge.llm.word_model import keyed, perplexities


def discounts(found: dict[int, int]) -> list[float]:
    """Of counts 1, 2, and 3 or more, from how often counts 1 to 4 occur."""
    n1, n2, n3, n4 = (float(found.get(i, 0)) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    steps = [(n1, n2), (n2, n3), (n3, n4)]
    return [min(float(i), max(0.0, i - (i + 1) * y * b / a)) if a else 0.5 * i for i, (a, b) in enumerate(steps, 1)]


def judge_quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text: str = "text",
                  lang: str = "lang", quantile: float = 0.99, accuracy: int = 10_000) -> DataFrame:
    """id, lang, trusted, perplexity (per word), threshold and kept for every row.

    Texts are scored whole, whatever their length; other columns play no part, whatever
    their names. Where all trusted texts fall into one half, one model scores its own texts.

    Trusted texts are dealt to two models, and each text, trusted or not, is scored by the
    one that equal texts do not train. A language's threshold is that quantile of its trusted
    texts' perplexities (within 1 / accuracy in rank); one without trusted texts, and a null language, has that of
    all. A text is kept if it has a perplexity of at most its threshold; texts without a
    word or mark have none. Rows of a repeated id are rows of their own; a null id is not
    trusted. Without trusted texts nothing is kept. An empty table gives an empty one.
    """
    ids = trusted_ids.select(column(id_col).alias("id")).filter("id is not null").distinct()
    rows = docs.select(column(id_col).alias("id"), column(lang).cast("string").alias("lang"),
                       column(text).cast("string").alias("text"))

    def marked(coded: DataFrame) -> DataFrame:
        # Merged at every size: ids that fit a broadcast on little data would not on more.
        found = coded.join(ids.withColumn("seen", F.lit(True)).hint("merge"), "id", "left")
        return found.withColumn("seen", F.coalesce("seen", F.lit(False))).withColumn("asked", F.lit(True))

    scores = perplexities(keyed(rows, "text").select("id", "key", "text"), marked, discounts)
    scored = keyed(rows, "text").select("id", "lang", "key").join(scores, "key", "left").drop("key")
    marked = settle(scored.join(ids.withColumn("trusted", F.lit(True)), "id", "left")
                    .withColumn("trusted", F.coalesce("trusted", F.lit(False))), "scored")
    trusted = marked.filter("trusted and perplexity is not null")
    cut = F.percentile_approx("perplexity", quantile, accuracy)
    # Stored: a few rows of known size, so that the hot language's rows need no shuffle.
    own = settle(trusted.filter("lang is not null").groupBy("lang").agg(cut.alias("own")), "thresholds")
    any_ = trusted.agg(cut).first()[0]
    out = marked.join(own, "lang", "left").withColumn("any", F.lit(any_).cast("double"))
    threshold = F.coalesce("own", "any")
    return out.select(F.col("id").alias(id_col), F.col("lang").alias(lang), "trusted", "perplexity",
                      threshold.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"))
