"""A table as a log of commits, so that readers see whole commits only.

``<table>/data/<folder>`` holds the files of one commit, written by the executors;
``<table>/log/<time>-<name>.json`` is its manifest, written last and renamed into place.
Files that no manifest names do not exist for readers. A commit written again under its
name (a replayed batch) takes the place of the former one. A commit may replace others
(a merge); it counts whenever those do not. Nothing a reader may have listed is deleted
at once: ``sweep`` removes replaced and orphaned files after a time of grace.

Manifests are small and few, as merges bound their number: the driver reads them all.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

#: Seconds for which files stay after they are replaced.
GRACE = 3600


@dataclass(frozen=True)
class Commit:
    name: str
    folder: str
    rows: int = 0
    replaces: tuple[str, ...] = ()
    #: What the table's own code keeps about the rows.
    facts: dict[str, Any] = field(default_factory=dict)
    #: Microseconds, by the writer's clock.
    at: int = 0
    file: str = ""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when they were changed (milliseconds); none where it is missing."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(_path(spark, path)))


def _text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears under its name with all of its content or not at all."""
    files, draft = _files(spark, path), f"{path}.{uuid.uuid4().hex}.tmp"
    stream = files.create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(_path(spark, draft), _path(spark, path)):
        raise OSError(f"cannot rename to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    return _text(spark, path) if _files(spark, path).exists(_path(spark, path)) else None


def publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """Make a commit whose files are written visible to readers."""
    at = time.time_ns() // 1000
    content = {k: v for k, v in asdict(commit).items() if k not in ("at", "file")}
    write_text(spark, f"{path}/log/{at:020d}-{commit.name}.json", json.dumps({**content, "at": at}))


def write(rows: DataFrame, path: str, name: str, order: Sequence[str], facts: dict[str, Any] | None = None,
          measured: dict[str, Column] | None = None, replaces: Sequence[str] = ()) -> Commit:
    """Store rows as one commit, in a single pass; ``measured`` adds aggregates of them to
    the facts.

    Files are as many as the rows' bytes ask for, whatever time or keys they cover, and
    each is in order, so that row groups can be skipped. Without rows no files stay.
    """
    spark, folder = rows.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (measured or {}).items()]]
    (rows.hint("rebalance").sortWithinPartitions(*order).observe(seen, *counts)
         .write.parquet(f"{path}/data/{folder}"))
    found = dict(seen.get)
    n = found.pop("rows")
    if not n:
        delete(spark, f"{path}/data/{folder}")
    commit = Commit(name, folder if n else "", n, tuple(replaces), {**(facts or {}), **found})
    publish(spark, path, commit)
    return commit


def snapshot(spark: SparkSession, path: str) -> list[Commit]:
    """The commits that count, by time."""
    return _living(_logged(spark, path))


def _logged(spark: SparkSession, path: str) -> list[Commit]:
    found = []
    for file, _ in _listed(spark, f"{path}/log"):
        if file.endswith(".json"):
            entry = json.loads(_text(spark, f"{path}/log/{file}"))
            found.append(Commit(**{**entry, "replaces": tuple(entry["replaces"]), "file": file}))
    return found


def _living(logged: list[Commit]) -> list[Commit]:
    replaced = {name for commit in logged for name in commit.replaces}
    newest = {commit.name: commit for commit in logged}
    return [commit for name, commit in newest.items() if name not in replaced]


def read(spark: SparkSession, path: str, schema: T.StructType, commits: Sequence[Commit] | None = None) -> DataFrame:
    """The rows of the given commits, by default of all that count now; a typed empty frame
    where there are none."""
    commits = snapshot(spark, path) if commits is None else commits
    folders = [f"{path}/data/{c.folder}" for c in commits if c.folder]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def crowded(commits: Sequence[Commit], most: int) -> list[Commit]:
    """The commits of every size class (by powers of ten of their rows) with over ``most``
    of them: merging just these rewrites a row as often as there are classes."""
    classes: dict[int, list[Commit]] = {}
    for commit in commits:
        classes.setdefault(len(str(commit.rows)), []).append(commit)
    return [c for some in classes.values() if len(some) > most for c in some]


def sweep(spark: SparkSession, path: str, grace: float = GRACE) -> None:
    """Delete what has not counted for ``grace`` seconds: files of replaced commits and
    their manifests, and files of commits that were never published.

    Call from the table's only writer, when it is writing nothing else.
    """
    logged, limit = _logged(spark, path), (time.time() - grace) * 1e6
    living = _living(logged)
    since: dict[str, int] = {}
    for commit in logged:
        for name in (commit.name, *commit.replaces):
            since[name] = max(since.get(name, 0), commit.at)
    kept = {c.file for c in living}
    gone = [c for c in logged if c.file not in kept and since[c.name] < limit]
    for commit in gone:
        # Files first: a manifest without files is swept again.
        if commit.folder:
            delete(spark, f"{path}/data/{commit.folder}")
        delete(spark, f"{path}/log/{commit.file}")
    named = {c.folder for c in logged}
    for folder, changed in _listed(spark, f"{path}/data"):
        if folder not in named and changed * 1000 < limit:
            delete(spark, f"{path}/data/{folder}")
