"""Streaming jobs: one query over the events, which keeps any number of window tables.

Each micro-batch is read and decoded once, for all tables; the tables' panes are written
from it (see ``panes``), and no state is kept between batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.grain import Grain
from tidegauge.operators.windowed import EVENT_TIME, TABLES, WindowTable, table_named
from tidegauge.settings import Settings, shared_root
from tidegauge.streaming import panes, toplist
from tidegauge.streaming.serving import as_key_values, new_run

OnBatch = Callable[[DataFrame, int], None]


def _trigger(settings: Settings, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": settings.trigger}


def show_rows(rows: DataFrame, batch: int, table: WindowTable) -> None:
    """Print the finished rows that a batch changed, in full width; for debugging."""
    print(f"{table.name}, batch {batch}")
    rows.select(*table.columns).orderBy("window_start", *table.keys).show(1000, truncate=False)


def used_columns(tables: Sequence[WindowTable]) -> list[str]:
    """What the tables need of an event."""
    own = {c for t in tables for c in (*t.keys, *([t.distinct[0]] if t.distinct else []))}
    return sorted(own | {EVENT_TIME, "is_click", "is_purchase", "revenue_filled", "quantity", "price"})


def start_serving(events: DataFrame, tables: Sequence[WindowTable], root: str, settings: Settings = Settings(),
                  available_now: bool = False, on_batch: Mapping[str, OnBatch] | None = None,
                  console: bool = False, run: str | None = None, maintain_every: int = 120,
                  name: str = "serve", tops: Mapping[str, tuple[str, int]] | None = None) -> StreamingQuery:
    """Keep the serving tables under ``root/serving`` up to date from a stream of events.

    ``on_batch`` gets, by table name, the key and value rows a batch changed, for stores
    outside; it is not called for a batch without rows. ``console`` prints them. ``tops``
    has, by table name, a metric and how many of the best rows by it are kept per window
    (see ``toplist``). Every
    ``maintain_every`` batches expired panes are dropped and commits merged (0: never). An
    error in a sink fails the query; it resumes from the checkpoint without loss, and the
    repeated batch replaces what it wrote before. A checkpoint keeps its windows and slide.
    """
    tables = [table_named(t.name) and t for t in tables]
    run, base, grain = run or new_run(), root.rstrip("/"), Grain(settings.window, settings.slide)
    if settings.approximate_users:
        tables = [t.with_approximate_users() for t in tables]
    target, checkpoint = f"{base}/serving", f"{base}/checkpoints/{name}"
    lineage = panes.lineage_of(events.sparkSession, checkpoint, grain)
    hooks, lists = on_batch or {}, tops or {}

    def upsert(batch_rows: DataFrame, batch: int) -> None:
        spark = batch_rows.sparkSession
        known = batch_rows.select(*used_columns(tables)).persist()  # lost parts are read again
        try:
            for table in tables:
                commit = panes.append(known, batch, target, table, run, lineage, grain, settings.watermark)
                if commit.rows and (console or table.name in hooks):
                    rows = panes.changed_rows(spark, target, table, commit)
                    if console:
                        show_rows(rows, batch, table)
                    if table.name in hooks:
                        hooks[table.name](as_key_values(rows, table), batch)
                if commit.rows and table.name in lists:
                    toplist.refresh(spark, target, table, commit, *lists[table.name])
                if maintain_every and batch % maintain_every == maintain_every - 1:
                    panes.maintain(spark, target, table, batch, ttl=settings.ttl)
                    if table.name in lists:
                        toplist.maintain(spark, target, table, lists[table.name][0], commit.name)
        finally:
            known.unpersist()

    return (events.writeStream.queryName(name).option("checkpointLocation", checkpoint)
                  .trigger(**_trigger(settings, available_now)).foreachBatch(upsert).start())


def start_rejects(rejects: DataFrame, root: str, settings: Settings = Settings(),
                  available_now: bool = False) -> StreamingQuery:
    """Append messages that could not be decoded to ``root/rejects``, as Parquet."""
    base = root.rstrip("/")
    return (rejects.writeStream.queryName("rejects").outputMode("append").format("parquet")
                   .option("path", f"{base}/rejects")
                   .option("checkpointLocation", f"{base}/checkpoints/rejects")
                   .trigger(**_trigger(settings, available_now)).start())


def start_all(events: DataFrame, settings: Settings = Settings(),
              tables: Sequence[str] = tuple(TABLES), console: bool = False,
              available_now: bool = False, on_batch: Mapping[str, OnBatch] | None = None,
              rejects: DataFrame | None = None) -> list[StreamingQuery]:
    """One query that serves all tables from one event stream, and prints them on request.

    ``on_batch`` has a callback by table name for changed rows; ``rejects`` is a stream
    of messages that could not be decoded, to be kept by a query of their own.
    """
    root = shared_root(events.sparkSession, settings)
    queries = [start_serving(events, [table_named(t) for t in tables], root, settings, available_now, on_batch, console)]
    if rejects is not None:
        queries.append(start_rejects(rejects, root, settings, available_now))
    return queries


def wait(spark: SparkSession, queries: Sequence[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until any of these queries ends, then stop them all; a failure is raised.

    Other queries of the session are not looked at, and the session stays.
    """
    try:
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(poll_seconds)
        for query in queries:
            if (failure := query.exception()) is not None:
                raise failure
    finally:
        stop(queries)


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Wait for queries started with ``available_now``; the first failure is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        stop(queries)


def stop(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
