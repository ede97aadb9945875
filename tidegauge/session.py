"""Session configuration the package is tuned for."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Give an existing session what it does not set itself; times are always UTC.

    The settings hold for everything else in that session too, so a change of its own
    time zone is reported as a warning.
    """
    zone, own = "spark.sql.session.timeZone", spark.conf.getAll
    if own.get(zone, SESSION_CONF[zone]) != SESSION_CONF[zone]:
        warnings.warn(f"the session's time zone {own[zone]} is set to UTC", stacklevel=2)
    for key, value in SESSION_CONF.items():
        if key not in own or key == zone:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidegauge", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with ``SESSION_CONF``; ``extra`` overrides it, ``_`` standing for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("_", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
