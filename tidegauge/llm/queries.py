"""The operators as named queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (decontaminate, exact_dedup, language, merkle, mixing, periodic_runs, prefix_counts, quality,
                           sharding, simhash, substring_dedup, tokens_file, warc)
from tidegauge.llm.common import fresh_path

#: Target shares of tokens by domain of the labels table, see ``domains``, and the tokens
#: of the mix against those of the documents.
MIX, BUDGET = {"good": 0.90, "plain": 0.07, "toxic": 0.03}, 1.05


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning its language."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain: toxic, or good or plain by quality; null where a label is."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
                         .when((F.col("toxic") == 0) & (F.col("quality") == 0), "plain").alias("domain"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.prefix_answers(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=512,
        keep=["doc_id"]).withColumnRenamed("over_budget", "over_limit")


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=16, keep=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path).filter("kind = 'record'")
    revisit = F.col("headers")["warc-type"] == "revisit"

    def page(field: str) -> Column:
        return F.nullif(F.regexp_extract(F.col("headers")[field], "^<urn:x-page:(.*)>$", 1), F.lit("")).cast("long")

    return records.select(
        page("warc-record-id").alias("page_id"),
        F.when(revisit, F.col("http")["content-length"].cast("long"))
        .otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(F.col("headers")["warc-payload-digest"], ":", -1))
        .otherwise(F.sha1("payload")).alias("payload_digest"),
        F.col("headers")["warc-type"].alias("record_type"), page("warc-refers-to").alias("refers_to"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(~held_out()))
    return language.languages(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("languages").alias("n_languages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, steps = mixing.mix(docs, domains(_table(spark, sf_dir, "labels")), MIX, BUDGET)
    found = mixing.with_rates(docs, model, steps, keep=["doc_id"])
    return found.select("doc_id", "n_tokens", *[
        F.element_at("p", model.names.index(name) + 1).alias(f"p_{name}") if name in model.names
        else F.lit(0.0).alias(f"p_{name}") for name in MIX], "rate", mixing.copies("rate", "doc_id").alias("copies"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    tokens_file.write_tokens(_table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return tokens_file.token_digests(spark, path)


def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return quality.judge_quality(_table(spark, sf_dir, "documents"), trusted)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_spans(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    # Every other document, by checksum, is tampered with: it loses its line ends.
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
                      merkle.leaf_hash([*fields, F.translate("text", "\n", "")]))
    rows = merkle.manifest(docs, merkle.leaf_hash([*fields, F.col("text")]), F.col("source"), F.col("doc_id"),
                           {"doc_id": F.col("doc_id"), "tampered": tampered})
    rows = rows.withColumn("folded_root", merkle.folded(F.col("path"), F.coalesce("tampered", "leaf")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_words", substring_dedup.n_removed().alias("n_removed"),
                        F.sha2("kept_text", 256).alias("kept_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by checksum repeats the p words from its word
    a on, to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    rest = (F.col("n") - F.col("a")).cast("int")
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil(rest / F.col("p")).cast("int")
    changed = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")),
                       F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), rest))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text"))
                       .alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs, keep=["doc_id"])

    def order(x: Column, y: Column) -> Column:
        """By exact length / period, the greatest first; ties by start, then period."""
        apart = y["length"] * x["period"] - x["length"] * y["period"]
        return F.signum(F.when(apart != 0, apart).when(x["start"] != y["start"], x["start"] - y["start"])
                        .otherwise(x["period"] - y["period"])).cast("int")

    best = F.try_element_at(F.array_sort("runs", order), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in
                                                                     ("start", "length", "period")]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_prefix_counts, op3_kd_shards, op4_warc, op5_language_mixture, op6_exact_dedup, op7_soft_mixing,
    op8_token_file, op9_kneser_ney_quality, op10_decontamination,
    op11_merkle_manifest, op12_substring_dedup, op13_periodic_runs)}
