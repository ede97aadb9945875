"""Shared by the operators: staged tables, text batches, distributed numbering."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.settings import shared_root
from tidegauge.streaming.commits import delete

#: Bytes of text that one step of an operator looks at; a longer text is looked at alone.
PIECE_BYTES = 1 << 20


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder's path on the storage that driver and executors share."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def drop(*settled: DataFrame) -> None:
    """Deletes the files of settled frames, which nothing reads any more."""
    for frame in settled:
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            delete(frame.sparkSession, folder)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query shuffled goes from disk when the query ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def column(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and len + 1 offsets; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


def spans(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Places and lengths of slices with about ``size`` bytes of text each."""
    at, sizes = 0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, stop - at
        at = stop


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    for at, n in spans(batch.column(text), size):
        yield batch.slice(at, n)


#: As ``keep``: the whole input row as one column of that name, clear of any computed one.
WHOLE = "__row"


def with_text_columns(frame: DataFrame, text: str, fields: T.StructType | str,
                      make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                      keep: list[str] | str | None = None) -> DataFrame:
    """The kept columns (all by default), then columns computed from whole texts.

    ``make()`` runs once per task and returns a function from a piece of the text column
    to one array per field. A computed column takes the place of a kept one of its name.
    """
    names = frame.columns if keep is None or keep == WHOLE else list(keep)
    fields = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
    # A kept text is sent once, within the row.
    place = names.index(text) if text in names and isinstance(frame.schema[text].dataType, T.StringType) else None
    source = frame.select(F.struct(*[column(c) for c in names]).alias("row") if names
                          else F.lit(0).alias("row"),
                          *([column(text).cast("string").alias("text")] if place is None else []))
    schema = T.StructType([source.schema["row"], *fields.fields])
    outputs = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            rows = batch.column("row")
            texts = batch.column("text") if place is None else pc.struct_field(rows, [place])
            for at, n in spans(texts):
                yield pa.RecordBatch.from_arrays([rows.slice(at, n), *compute(texts.slice(at, n))], outputs)
            pa.default_memory_pool().release_unused()

    found = source.mapInArrow(run, schema)
    if keep == WHOLE:
        return found.withColumnRenamed("row", WHOLE)
    return found.select(*[F.col("row").getField(c).alias(c) for c in names if c not in fields.names],
                        *[column(f) for f in fields.names])


def numbered(frame: DataFrame, groups: list[str], order: list[str], name: str,
             number: str = "number") -> DataFrame:
    """A gapless number from 0 within each group, in the given order.

    Rows are dealt out by ranges of group and order, so that a large group lies in many
    tasks; each task counts its rows of a group, and the groups' sums over the tasks
    before it (one row per task and group) are added.
    """
    spark = frame.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([*frame.schema.fields, T.StructField("__part", T.IntegerType()),
                           T.StructField("__local", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*[batch.column(g).to_pylist() for g in groups])) if groups else [()] * batch.num_rows
            local = np.empty(batch.num_rows, np.int64)
            for i, key in enumerate(keys):
                if key != last:
                    last, count = key, 0
                local[i] = count
                count += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(local)],
                schema.names)

    keys = [column(c) for c in [*groups, *order]]
    dealt = settle(frame.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                   .mapInArrow(run, schema), name)
    counts = dealt.groupBy(*groups, "__part").agg(F.count("*").alias("n"))
    ours = [f"__group{i}" for i in range(len(groups))]
    before = before_parts(counts, groups, "__part").toDF(*ours, "__of", "__before")
    on = F.col("__part") == F.col("__of")
    for g, name in zip(groups, ours):
        on = on & column(g).eqNullSafe(F.col(name))
    return dealt.join(before, on).select(
        *[column(c) for c in frame.columns], (F.col("__local") + F.col("__before")).alias(number))


def before_parts(counts: DataFrame, groups: list[str], part: str) -> DataFrame:
    """groups, part and ``before``: the sum of ``n`` over a group's earlier parts.

    ``counts`` has one row per group and part; a group's list is as long as there are parts.
    """
    lists = counts.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct(part, "n"))).alias("all"))
    each = F.transform("all", lambda x: F.struct(x[part].alias(part), F.aggregate(
        F.filter("all", lambda y: y[part] < x[part]), F.lit(0).cast("long"),
        lambda total, y: total + y["n"]).alias("before")))
    return lists.select(*groups, F.explode(each).alias("x")).select(*groups, "x.*")
