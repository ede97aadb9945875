"""The keyed serving table: appended per micro-batch, newest row per key wins.

Each batch of whole rows is one commit (see ``commits``): a replayed batch replaces its
own, executors write in parallel, a batch without rows leaves no files, and readers see
whole batches only. Rows hold the hour of their window and are stored in its order, so
reads of some hours skip the rest, while the number of files follows the rows. Of the
rows of a window and key the one of the last run and batch counts; ``run`` names one
start of the writer and sorts by time. Rows whose last write is older than the time to
live are hidden, and dropped by ``maintain``, which also merges commits. Streams of
events are served from panes instead (see ``panes``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidegauge.functions.text import key_time
from tidegauge.operators.grain import seconds, span
from tidegauge.operators.windowed import WindowTable, table_named
from tidegauge.schema import SERVED_SCHEMAS
from tidegauge.streaming import commits

# Stand-ins for missing parts of a serving key.
KEY_PARTS = {
    "trending_products": {"product_id": "unknown_product"},
    "category_analytics": {"category": "unknown_category"},
    "user_behavior": {"user_agent": "unknown_ua", "source": "unknown_source"},
}
TTL = "1 hour"
#: Bytes of a row group of exported values.
ROW_GROUP = 8 << 20


def new_run() -> str:
    return datetime.now(timezone.utc).strftime("r%Y%m%dT%H%M%S%f")


def table_path(root: str, table: WindowTable) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def stored_schema(table: WindowTable) -> T.StructType:
    fields = [("window_start", "timestamp"), ("window_end", "timestamp"),
              *[(k, "string") for k in table.keys],
              *[(m.name, m.type) for m in table.measures],
              *([(table.distinct[1], "bigint")] if table.distinct else []),
              ("written_at", "timestamp"), ("run", "string"), ("batch", "bigint"), ("hour", "bigint")]
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))


# --- writing -----------------------------------------------------------------

def hour_of(column: str = "window_start") -> Column:
    """Hours since the epoch, whatever the session's time zone."""
    return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / 3600).cast("bigint")


def write_batch(rows: DataFrame, batch: int, root: str, table: WindowTable, run: str,
                written_at: Column | None = None) -> commits.Commit:
    """Store one micro-batch of merged measures per window and key in a single pass."""
    table_named(table.name)
    rows = rows.withColumns({
        "written_at": F.current_timestamp() if written_at is None else written_at,
        "run": F.lit(run), "batch": F.lit(batch), "hour": hour_of()})
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in stored_schema(table).fields]
    return commits.write(rows.select(*columns), table_path(root, table), f"{run}-{batch:012d}",
                         ["hour", *table.keys], {"run": run, "batch": batch})


# --- reading -----------------------------------------------------------------

def read_rows(spark: SparkSession, root: str, table: WindowTable,
              known: Sequence[commits.Commit] | None = None) -> DataFrame:
    """All stored rows, of all commits that count by default; a typed empty frame before
    the first batch."""
    return commits.read(spark, table_path(root, table), stored_schema(table), known)


def newest_rows(rows: DataFrame, table: WindowTable) -> DataFrame:
    """The last write of each window and key: a row per micro-batch that touched it."""
    writes = (Window.partitionBy("window_start", *table.keys)
                    .orderBy(F.desc("run"), F.desc("batch")))
    return rows.withColumn("nth", F.row_number().over(writes)).filter(F.col("nth") == 1).drop("nth")


def unexpired(rows: DataFrame, now: Column | None = None, ttl: str = TTL) -> DataFrame:
    """Rows written less than ``ttl`` before ``now``."""
    return rows.filter(F.col("written_at") > cutoff(now, ttl))


def cutoff(now: Column | None, ttl: str) -> Column:
    return (F.current_timestamp() if now is None else now) - span(seconds(ttl))


def latest_rows(rows: DataFrame, table: WindowTable, now: Column | None = None,
                ttl: str | None = TTL) -> DataFrame:
    """Finished newest rows from stored ones, with ``written_at``, ``run`` and ``batch``.
    ``ttl=None`` keeps all."""
    newest = newest_rows(rows, table)
    if ttl is not None:
        newest = unexpired(newest, now, ttl)
    ratios = {**table.ratios(), "processed_at": F.col("written_at")}
    if table.distinct:
        ratios[table.distinct[1]] = F.col(table.distinct[1]).cast("int")
    return newest.withColumns(ratios).select(*table.columns, "written_at", "run", "batch")


def read_latest(spark: SparkSession, root: str, table: WindowTable,
                now: Column | None = None, ttl: str | None = TTL) -> DataFrame:
    """As :func:`latest_rows`, from the stored table. With a time to live only hours from
    the first one written to within it are read, before anything is shuffled."""
    stored = read_rows(spark, root, table)
    if ttl is not None:
        since = unexpired(stored, now, ttl).agg(F.min("hour")).scalar()
        stored = stored.filter(F.col("hour") >= since)
    return latest_rows(stored, table, now, ttl)


# --- upkeep ------------------------------------------------------------------

def maintain(spark: SparkSession, root: str, table: WindowTable, run: str, batch: int,
             now: Column | None = None, ttl: str = TTL, most_commits: int = 20,
             grace: float = commits.GRACE) -> None:
    """Merge the commits of each size class with more than ``most_commits`` into one of
    their newest rows written within ``ttl``, and sweep what was replaced.

    Call from the table's only writer, between batches. The last batch written, ``run`` and
    ``batch``, may be replayed and is left as it is. Readers that started before still find
    their files for the time of grace. Only manifests reach the driver.
    """
    path = table_path(root, table)
    old = [c for c in commits.snapshot(spark, path) if (c.facts["run"], c.facts["batch"]) != (run, batch)]
    if some := commits.crowded(old, most_commits):
        last = max(some, key=lambda c: (c.facts["run"], c.facts["batch"]))
        kept = unexpired(newest_rows(read_rows(spark, root, table, some), table), now, ttl)
        commits.write(kept, path, f"{last.name}-merged-{new_run()}", ["hour", *table.keys], last.facts,
                      replaces=[c.name for c in some])
    commits.sweep(spark, path, grace)


# --- key and value text ------------------------------------------------------

def serving_key(table: WindowTable) -> Column:
    """``table:{window_start}_{entity parts}``."""
    entity = [F.coalesce(F.col(c), F.lit(missing))
              for c, missing in KEY_PARTS[table_named(table.name).name].items()]
    return F.concat(F.lit(f"{table.name}:"),
                    F.concat_ws("_", key_time(F.col("window_start")), *entity))


def as_key_values(rows: DataFrame, table: WindowTable) -> DataFrame:
    """``serving_key`` and ``value``, the row as JSON without its null fields."""
    return rows.select(serving_key(table).alias("serving_key"),
                       F.to_json(F.struct(*[F.col(c).cast("timestamp").alias(c)
                                            if c in ("window_start", "window_end") else F.col(c)
                                            for c in table.columns if c in rows.columns]))
                        .alias("value"))


def export_values(rows: DataFrame, path: str, table: WindowTable) -> None:
    """Key and value rows under ``path/prefix=<table>``, in order of keys: a read by key
    skips files and row groups by their bounds, and by a Bloom filter of their keys."""
    values = as_key_values(rows, table)
    (values.repartitionByRange("serving_key").sortWithinPartitions("serving_key")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#serving_key", "true")
     .option("parquet.block.size", str(ROW_GROUP))
     .parquet(f"{path.rstrip('/')}/prefix={table_named(table.name).name}"))


def read_values(spark: SparkSession, path: str, table: WindowTable) -> DataFrame:
    """Key and value rows of one prefix; the prefix is a partition, others are not listed."""
    schema = "serving_key string, value string, prefix string"
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    return stored.filter(F.col("prefix") == table.name).drop("prefix")


def get_values(spark: SparkSession, path: str, table: WindowTable, keys: Sequence[str] | DataFrame) -> DataFrame:
    """Key and value rows of many keys at once; keys that are not there give no row.

    A list of keys becomes a filter at the scan. A frame (its column ``serving_key``, of any
    size) is joined, and the scan is bounded by its least and greatest key.
    """
    stored = read_values(spark, path, table)
    if not isinstance(keys, DataFrame):
        return stored.filter(F.col("serving_key").isin(list(keys)))
    wanted = keys.select("serving_key").distinct()
    ends = wanted.agg(F.min("serving_key").alias("low"), F.max("serving_key").alias("high"))
    bounded = stored.filter(F.col("serving_key").between(ends.select("low").scalar(), ends.select("high").scalar()))
    return bounded.join(wanted, "serving_key", "left_semi")


def _decoded(table: WindowTable) -> Column:
    """The JSON value as a struct, its times still text."""
    return F.from_json("value", T.StructType([
        T.StructField(f.name, T.StringType() if f.name in _times(table) else f.dataType)
        for f in SERVED_SCHEMAS[table.name].fields]))


def _times(table: WindowTable) -> list[str]:
    return [f.name for f in SERVED_SCHEMAS[table.name].fields
            if isinstance(f.dataType, T.TimestampType)]


def decode_values(values: DataFrame, table: WindowTable) -> DataFrame:
    """JSON values as typed rows; those without a readable ``window_start`` are dropped.

    Times that do not parse become null, so empty and undecodable values go too.
    """
    rows = values.select(_decoded(table).alias("row")).select("row.*")
    return (rows.withColumns({t: F.try_to_timestamp(F.col(t)) for t in _times(table)})
                .na.drop(subset=["window_start"]))


def rejected_values(values: DataFrame, table: WindowTable) -> DataFrame:
    """The key and value rows that :func:`decode_values` drops."""
    return values.filter(F.try_to_timestamp(_decoded(table)["window_start"]).isNull())
