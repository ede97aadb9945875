"""Window tables kept up to date from micro-batches, stored as panes.

Each micro-batch is combined to pane rows (key, pane, and user for an exact distinct
count) and appended as one commit; readers add the rows up and spread them over windows.
So a stream holds no state at all: an event is one stored row at most instead of one in
each of its windows, a batch costs what its own events cost, and a replayed batch
replaces its own commit.

Lateness. As in Spark's own streaming, the watermark of a batch is the newest event time
of all batches before it, less the allowed delay, and an event counts for those windows
only that end after it. The newest time stands in the manifests of the commits, which a
restart finds again.

``lineage`` names one checkpoint: all starts from it share it, and a new checkpoint,
which starts from nothing, has a later one. Per window and key only the newest lineage
counts. A time to live hides windows of which no part was written within it.
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegauge.operators.grain import Grain, seconds, time_of
from tidegauge.operators.windowed import EVENT_TIME, Measure, WindowTable, pane_rows, table_named, totals_of_panes
from tidegauge.streaming import commits
from tidegauge.streaming.commits import Commit
from tidegauge.streaming.serving import TTL, cutoff, new_run, unexpired

#: Spark computes watermarks in milliseconds.
TICK = 1000


def table_path(root: str, table: WindowTable) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def stored_schema(table: WindowTable) -> T.StructType:
    users = [(table.user, "string")] if table.user else []
    fields = [*[(k, "string") for k in table.keys], *users, ("slot", "bigint"), ("first", "bigint"),
              *[(m.name, m.type) for m in table.pane_measures],
              ("written_at", "timestamp"), ("lineage", "string"), ("run", "string"), ("batch", "bigint")]
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))


# --- writing -----------------------------------------------------------------

def lineage_of(spark: SparkSession, checkpoint: str, grain: Grain) -> str:
    """The lineage stored with a checkpoint, made on its first use.

    Panes of other windows do not add up, so a checkpoint keeps the grain it was started
    with; another one is refused.
    """
    path, own = f"{checkpoint.rstrip('/')}/lineage.json", [grain.window_seconds, grain.slide_seconds]
    stored = commits.read_text(spark, path)
    if stored is None:
        lineage = new_run()
        commits.write_text(spark, path, json.dumps({"lineage": lineage, "grain": own}))
        return lineage
    stored = json.loads(stored)
    if stored["grain"] != own:
        raise ValueError(f"{checkpoint} was started with windows and slides of {stored['grain']} seconds, not {own}; "
                         "keep the setting or start from a new checkpoint")
    return stored["lineage"]


def watermark(known: list[Commit], lineage: str, batch: int, delay: str) -> int | None:
    """Microseconds before which windows have closed for a batch; None: no window has."""
    newest = [c.facts["newest"] for c in known if c.facts["lineage"] == lineage and c.facts["batch"] < batch
              and c.facts["newest"] is not None]
    return (max(newest) // TICK - seconds(delay) * 1000) * TICK if newest else None


def append(events: DataFrame, batch: int, root: str, table: WindowTable, run: str, lineage: str = "",
           grain: Grain = Grain(), delay: str = "5 minutes", written_at: Column | None = None) -> Commit:
    """Store the pane rows of one micro-batch of events."""
    table_named(table.name)
    path, fine = table_path(root, table), grain.divided()
    closed = watermark(commits.snapshot(events.sparkSession, path), lineage, batch, delay)
    slide = fine.slide_seconds * 1_000_000
    opened = None if closed is None else (closed - grain.window_seconds * 1_000_000) // slide + 1
    # All events of the batch move the watermark, also those that came too late.
    time = F.unix_micros(F.col(EVENT_TIME).cast("timestamp"))
    newest = events.agg(F.max(time).alias("newest")).first()["newest"]
    rows = pane_rows(events.filter(F.col(EVENT_TIME).isNotNull()), table, fine, opened).withColumns({
        "written_at": F.current_timestamp() if written_at is None else written_at,
        "lineage": F.lit(lineage), "run": F.lit(run), "batch": F.lit(batch).cast("bigint")})
    facts = {"lineage": lineage, "run": run, "batch": batch, "newest": newest, "approximate": table.approximate,
             "window": grain.window_seconds, "slide": grain.slide_seconds}
    return commits.write(_typed(rows, table), path, f"{lineage}-{batch:012d}", ["slot", *table.keys], facts, _extent())


def _typed(rows: DataFrame, table: WindowTable) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored_schema(table).fields])


def _extent() -> dict[str, Column]:
    return {"first_slot": F.min("first"), "last_slot": F.max("slot")}


# --- reading -----------------------------------------------------------------

def _grain(commit: Commit) -> Grain:
    return Grain(f"{commit.facts['window']} seconds", f"{commit.facts['slide']} seconds")


def kept_by(commit: Commit, table: WindowTable) -> WindowTable:
    """The table with users counted the way the commit holds them."""
    return table.with_approximate_users() if commit.facts["approximate"] else replace(table, approximate=False)


def _totals(spark: SparkSession, root: str, table: WindowTable, known: list[Commit], since: Column | int | None = None,
            until: Column | int | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """Merged measures per window and key, with written_at, run and batch of the last part.

    Only windows from slot ``since`` to slot ``until`` are whole; panes outside of them are
    not read. ``wanted`` (window_start and keys): no other rows.
    """
    path, kinds = table_path(root, table), {}
    for commit in known:
        kinds.setdefault((commit.facts["window"], commit.facts["slide"], commit.facts["approximate"]), []).append(commit)
    several = len({c.facts["lineage"] for c in known}) > 1
    found = []
    for some in kinds.values():
        grain, counted = _grain(some[0]), kept_by(some[0], table)
        fine = grain.divided()
        rows = commits.read(spark, path, stored_schema(counted), some)
        if since is not None:
            rows = rows.filter(F.col("slot") >= since)
        if until is not None:
            rows = rows.filter(F.col("slot") <= until + (fine.panes - 1))
        if wanted is not None:
            keys = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in table.keys]).distinct()
            rows = rows.join(keys, [F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in table.keys], "left_semi")
        rows = rows.withColumn("last", F.struct("run", "batch"))
        more = (Measure("written_at", "", "max", "timestamp"), Measure("last", "", "max"))
        wide = replace(counted, measures=(*counted.measures, *more),
                       keys=(*counted.keys, "lineage") if several else counted.keys)
        totals = totals_of_panes(rows, wide, fine, T.TimestampType())
        if fine.slide_seconds != grain.slide_seconds:
            totals = totals.filter(F.unix_seconds("window_start") % grain.slide_seconds == 0)
        found.append(totals.select("window_start", "window_end", *table.keys,
                                   *([F.col("lineage")] if several else [F.lit("").alias("lineage")]),
                                   *counted.measure_names, "written_at", "last.run", "last.batch"))
    if not found:
        users = [(table.distinct[1], "bigint")] if table.distinct else []
        fields = [("window_start", "timestamp"), ("window_end", "timestamp"), *[(k, "string") for k in table.keys],
                  *[(m.name, m.type) for m in table.measures], *users,
                  ("written_at", "timestamp"), ("run", "string"), ("batch", "bigint")]
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in fields))
    rows = reduce(DataFrame.unionByName, found)
    if several:
        own = ["window_start", *table.keys]
        rest = [c for c in rows.columns if c not in own]
        rows = (rows.groupBy(*own).agg(F.max_by(F.struct(*rest), "lineage").alias("newest"))
                    .select(*own, "newest.*"))
    if wanted is not None:
        own = ["window_start", *table.keys]
        marks = wanted.select(*[F.col(k).alias(f"wanted_{k}") for k in own])
        rows = rows.join(marks, [F.col(k).eqNullSafe(F.col(f"wanted_{k}")) for k in own], "left_semi")
    return rows.drop("lineage")


def _finished(totals: DataFrame, table: WindowTable) -> DataFrame:
    ratios = {**table.ratios(), "processed_at": F.col("written_at")}
    if table.distinct:
        ratios[table.distinct[1]] = F.col(table.distinct[1]).cast("int")
    return totals.withColumns(ratios).select(*table.columns, "written_at", "run", "batch")


def read_latest(spark: SparkSession, root: str, table: WindowTable, now: Column | None = None,
                ttl: str | None = TTL) -> DataFrame:
    """Whole, finished rows with ``written_at``, ``run`` and ``batch``; ``ttl=None`` keeps all.

    With a time to live only panes from the first window written to within it are read.
    """
    known, since = commits.snapshot(spark, table_path(root, table)), None
    if ttl is not None and any(c.rows for c in known):
        since = _first_living(spark, root, table, known, now, ttl).scalar()
    rows = _finished(_totals(spark, root, table, [c for c in known if c.rows], since), table)
    return rows if ttl is None else unexpired(rows, now, ttl)


def _first_living(spark: SparkSession, root: str, table: WindowTable, known: list[Commit], now: Column | None,
                  ttl: str) -> DataFrame:
    """The first slot of the windows written to within the time to live; null: none."""
    times = T.StructType([f for f in stored_schema(table).fields if f.name in ("first", "written_at")])
    rows = commits.read(spark, table_path(root, table), times, known)
    return rows.filter(F.col("written_at") > cutoff(now, ttl)).agg(F.min("first"))


def read_keys(spark: SparkSession, root: str, table: WindowTable, keys: DataFrame) -> DataFrame:
    """The finished rows of many windows and keys (``window_start`` and the table's keys) at
    once, whenever they were written; no row for those that are not there.

    The least and greatest window come to the driver: commits of other times are left out,
    and row groups are skipped, as files are in order of panes.
    """
    known = [c for c in commits.snapshot(spark, table_path(root, table)) if c.rows]
    start = F.unix_seconds("window_start")
    low, high = keys.agg(F.min(start), F.max(start)).first()
    if low is None:
        known = []
    kinds = {(c.facts["window"], c.facts["slide"]) for c in known}
    if len(kinds) != 1:
        return _finished(_totals(spark, root, table, known, wanted=keys), table)
    fine = _grain(known[0]).divided()
    low, high = low // fine.slide_seconds, high // fine.slide_seconds
    known = [c for c in known if c.facts["last_slot"] >= low and c.facts["first_slot"] <= high + fine.panes]
    return _finished(_totals(spark, root, table, known, low, high, keys), table)


def read_windows(spark: SparkSession, root: str, table: WindowTable, windows: DataFrame) -> DataFrame:
    """The finished rows of all keys in the given windows (``window_start``)."""
    known = [c for c in commits.snapshot(spark, table_path(root, table)) if c.rows]
    start = F.unix_seconds("window_start")
    low, high = windows.agg(F.min(start), F.max(start)).first()
    if low is None or len({(c.facts["window"], c.facts["slide"]) for c in known}) != 1:
        rows = _totals(spark, root, table, [] if low is None else known)
    else:
        step = _grain(known[0]).divided().slide_seconds
        rows = _totals(spark, root, table, known, low // step, high // step)
    return _finished(rows.join(windows.select("window_start").distinct(), "window_start", "left_semi"), table)


def changed_rows(spark: SparkSession, root: str, table: WindowTable, commit: Commit) -> DataFrame:
    """Whole rows of the windows and keys that one commit touched; reads their panes only."""
    known = [c for c in commits.snapshot(spark, table_path(root, table)) if c.rows]
    if not commit.rows:
        return _finished(_totals(spark, root, table, []), table)
    fine = _grain(commit).divided()
    rows = commits.read(spark, table_path(root, table), stored_schema(kept_by(commit, table)), [commit])
    touched = rows.select(*table.keys, F.explode(F.sequence("first", "slot")).alias("opening")).distinct()
    touched = touched.select(time_of("opening", T.TimestampType(), fine.slide_seconds).alias("window_start"), *table.keys)
    return _finished(_totals(spark, root, table, known, commit.facts["first_slot"], commit.facts["last_slot"], touched),
                     table)


# --- upkeep ------------------------------------------------------------------

def maintain(spark: SparkSession, root: str, table: WindowTable, batch: int | None = None, now: Column | None = None,
             ttl: str = TTL, most_commits: int = 20, grace: float = commits.GRACE) -> None:
    """Merge the commits of every size class that has more than ``most_commits``, without
    the panes that no window written to within ``ttl`` holds; sweep what was replaced.

    Call from the table's only writer, between batches. ``batch`` is the last one written:
    it may be replayed and is left as it is. Only manifests reach the driver.
    """
    path = table_path(root, table)
    known = commits.snapshot(spark, path)
    old = [c for c in known if batch is None or c.facts["batch"] != batch]
    kinds: dict[tuple, list[Commit]] = {}
    for commit in old:
        kinds.setdefault(tuple(commit.facts[k] for k in ("lineage", "window", "slide", "approximate")), []).append(commit)
    for some in kinds.values():
        some = commits.crowded(some, most_commits)
        if not some:
            continue
        last, counted = max(some, key=lambda c: (c.facts["run"], c.facts["batch"])), kept_by(some[0], table)
        rows = commits.read(spark, path, stored_schema(counted), some)
        if any(c.rows for c in some):
            # Of all commits: a window lives as long as its last part.
            since = _first_living(spark, root, table, known, now, ttl).scalar()
            rows = rows.filter(F.col("slot") >= since)
        users = [counted.user] if counted.user else []
        merged = (rows.withColumn("last", F.struct("run", "batch"))
                      .groupBy(*table.keys, *users, "slot", "first", "lineage")
                      .agg(*[m.of_partials() for m in counted.pane_measures], F.max("written_at").alias("written_at"),
                           F.max("last").alias("last"))
                      .withColumns({"run": F.col("last.run"), "batch": F.col("last.batch")}))
        times = [c.facts["newest"] for c in some if c.facts["newest"] is not None]
        facts = {**last.facts, "newest": max(times, default=None)}
        commits.write(_typed(merged, counted), path, f"{last.name}-merged-{new_run()}", ["slot", *table.keys],
                      {k: v for k, v in facts.items() if k not in _extent()}, _extent(), [c.name for c in some])
    commits.sweep(spark, path, grace)
