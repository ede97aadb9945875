"""From raw documents to shards of training data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.common import settle
from tidegauge.llm.decontaminate import drop_contaminated
from tidegauge.llm.language import keep_identified, learn
from tidegauge.llm.mixing import mix, mixed_documents
from tidegauge.llm.queries import BUDGET, MIX, domains, held_out
from tidegauge.llm.sharding import shard_by_bytes
from tidegauge.llm.simhash import drop_near_duplicates


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, a fair share of them in one language."""
    return keep_identified(docs, learn(docs.filter(~held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of least id."""
    return drop_near_duplicates(docs, shingle=3, distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which under a twentieth of the words are benchmark passages."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of tokens per domain ask for."""
    labelled = domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed_documents(docs, *mix(docs, labelled, MIX, BUDGET))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their size, text_crc32, shard (0 to 15) and slot in it."""
    return shard_by_bytes(docs, shards=16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_domains),
    ("sharding", shard),
]

# The stages learn from and iterate over the documents; SQL cannot express that.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
