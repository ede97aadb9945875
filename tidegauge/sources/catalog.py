"""The product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegauge.schema import CATALOG_SCHEMA

def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog stored as Parquet; columns it lacks come back null."""
    return spark.read.schema(CATALOG_SCHEMA).parquet(path)


def catalog_from_parts(parts: DataFrame) -> DataFrame:
    """The catalog shape over a part table: ``k`` is the part key to join on."""
    return parts.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("product_name"),
                        F.col("p_type").alias("category"))
