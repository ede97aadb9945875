"""The best rows of each window, kept up to date batch by batch.

A list holds at most ``k`` rows per window. What a batch changes comes from
``panes.changed_rows``: the changed rows and the kept ones of the same windows are the
candidates. Only where a full list loses value (a kept row falls) may a row from outside
rise into it; those windows, and no others, are read again from their panes. So the work
follows what a batch touched, and the list equals a fresh top-k after each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidegauge.operators.reports import top_k
from tidegauge.operators.windowed import WindowTable
from tidegauge.schema import SERVED_SCHEMAS
from tidegauge.streaming import commits, panes
from tidegauge.streaming.commits import Commit


def list_path(root: str, table: WindowTable, metric: str) -> str:
    return f"{root.rstrip('/')}/{table.name}.top_{metric}"


def stored_schema(table: WindowTable, metric: str) -> T.StructType:
    kinds = {f.name: f.dataType for f in SERVED_SCHEMAS[table.name].fields}
    return T.StructType([T.StructField(c, kinds[c]) for c in ("window_start", *table.keys, metric)] + [
        T.StructField("place", T.IntegerType()), T.StructField("at", T.LongType())])


def read_list(spark: SparkSession, root: str, table: WindowTable, metric: str) -> DataFrame:
    """window_start, keys, metric and place of the kept rows of every window."""
    return _newest(commits.read(spark, list_path(root, table, metric), stored_schema(table, metric))).drop("at")


def _newest(stored: DataFrame) -> DataFrame:
    """Of each window the list that was written last."""
    return (stored.withColumn("last", F.max("at").over(Window.partitionBy("window_start")))
                  .filter(F.col("at") == F.col("last")).drop("last"))


def refresh(spark: SparkSession, root: str, table: WindowTable, commit: Commit, metric: str, k: int = 10) -> Commit:
    """Bring the lists of the windows that a commit of panes touched up to date.

    The commit is named after the panes', so a replayed batch replaces its own lists.
    """
    path, keys = list_path(root, table, metric), ["window_start", *table.keys]
    name = commit.name
    others = [c for c in commits.snapshot(spark, path) if c.name != name]
    # A list is as new as its batch; parts of a later lineage come later.
    at = max((c.facts["at"] for c in others), default=0) + 1
    changed = panes.changed_rows(spark, root, table, commit).select(*keys, metric).persist()
    kept = _newest(commits.read(spark, path, stored_schema(table, metric), others)).drop("at")
    kept = kept.join(changed.select("window_start").distinct(), "window_start", "left_semi")
    mine = [F.col(c).eqNullSafe(F.col(f"new_{c}")) for c in keys]
    new = changed.select(*[F.col(c).alias(f"new_{c}") for c in (*keys, metric)])
    fallen = (kept.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("window_start")))
                  .filter(F.col("size") == k).join(new, mine)
                  .filter(F.coalesce(F.col(f"new_{metric}") < F.col(metric), F.lit(True)))
                  .select("window_start").distinct().persist())
    try:
        candidates = kept.join(new, mine, "left_anti").select(*keys, metric).unionByName(changed)
        again = panes.read_windows(spark, root, table, fallen).select(*keys, metric)
        rows = candidates.join(fallen, "window_start", "left_anti").unionByName(again)
        best = top_k(rows, metric, k, table.keys, ("window_start",)).withColumn("at", F.lit(at))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in stored_schema(table, metric).fields]
        return commits.write(best.select(*columns), path, name, ["window_start", "place"], {"at": at})
    finally:
        changed.unpersist()
        fallen.unpersist()


def maintain(spark: SparkSession, root: str, table: WindowTable, metric: str, last: str | None = None,
             most_commits: int = 20, grace: float = commits.GRACE) -> None:
    """Merge the commits of crowded size classes, but for the one named ``last``, and sweep."""
    path = list_path(root, table, metric)
    some = commits.crowded([c for c in commits.snapshot(spark, path) if c.name != last], most_commits)
    if some:
        newest = max(some, key=lambda c: c.facts["at"])
        rows = _newest(commits.read(spark, path, stored_schema(table, metric), some))
        commits.write(rows, path, f"{newest.name}-merged-{newest.facts['at']}", ["window_start", "place"],
                      newest.facts, replaces=[c.name for c in some])
    commits.sweep(spark, path, grace)
