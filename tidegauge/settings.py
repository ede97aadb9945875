"""Run-time settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass
from functools import cache

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    bootstrap_servers: str = "localhost:9092"
    topic: str = "commerce-events"
    starting_offsets: str = "latest"
    # Read tasks per micro-batch where topic partitions are too few; None: one each.
    min_partitions: int | None = None
    window: str = "10 minutes"
    slide: str = "1 minute"
    watermark: str = "5 minutes"
    trigger: str = "30 seconds"
    ttl: str = "1 hour"
    # Distinct users from sketches (within about 2 %) instead of rows per user.
    approximate_users: bool = False
    # Folder on storage that every executor reaches; None: spark.checkpoint.dir.
    root: str | None = None

    @staticmethod
    def from_environment(env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        default = Settings()
        return Settings(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", default.bootstrap_servers),
            topic=env.get("KAFKA_INPUT_TOPIC", default.topic),
            root=env.get("SPARK_CHECKPOINT_LOCATION"),
        )


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidegauge-")


def shared_root(spark: SparkSession, settings: Settings | None = None) -> str:
    """The folder for checkpoints, serving tables and staged data.

    Explicit setting first, then ``spark.checkpoint.dir``. A temporary folder of
    this machine is used on a local master only, where every task can see it.
    """
    if settings is not None and settings.root:
        return settings.root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir (or Settings.root) to a shared folder")
