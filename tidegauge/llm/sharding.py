"""K-d tree sharding by bytes.

The rows are split again and again, each part at the weighted median of its widest
dimension, until a part is one shard of the target bytes. The median is found on all
rows: the bytes of equal ranges of the dimension are summed, the range that holds the
median is divided again, and so on until a cut is near enough. What reaches the driver
is a bounded number of sums per tree node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import column, numbered, settle

#: Bits of a key: the cell of the dimension, the group of equal texts, the row.
CELL, GROUP, ROW = 16, 24, 16
WIDTH = CELL + GROUP + ROW
#: Nodes that are looked up in an expression instead of a broadcast table.
FOLDED = 64
RESULTS = ("size", "text_crc32", "shard", "slot")


@dataclass
class Node:
    """Shards lo .. lo + n - 1, with the search for its median."""

    lo: int
    n: int
    dim: int
    total: float
    start: int = 0
    bits: int = WIDTH  # of the range that holds the median
    below: float = 0
    cut: int | None = None

    @property
    def left(self) -> int:
        return (self.n + 1) // 2

    @property
    def want(self) -> float:
        return self.total * self.left / self.n


def cells(rows: DataFrame, dimensions: list[str]) -> Column:
    """For each dimension its place in 1 .. 65535, or 0 for null.

    Numbers are scaled from their least to their greatest value; other types go by hash.
    """
    numeric = [d for d in dimensions if isinstance(rows.schema[d].dataType, T.NumericType)]
    ends = rows.agg(*[f(column(d).cast("double")).alias(f"{kind}_{d}") for d in numeric
                      for kind, f in (("least", F.min), ("most", F.max))]).first() if numeric else {}
    out = []
    for d in dimensions:
        if d in numeric:
            least, most = ends[f"least_{d}"] or 0.0, ends[f"most_{d}"] or 0.0
            cell = F.floor((column(d).cast("double") - least) / ((most - least) or 1.0) * 65534)
        else:
            cell = F.pmod(F.xxhash64(column(d)), F.lit(65535))
        out.append(F.when(column(d).isNull(), F.lit(0)).otherwise(cell + 1).cast("long"))
    return F.array(*out)


def _key(dim: str) -> Column:
    return F.shiftleft(F.element_at("cell", F.col(dim) + 1), GROUP + ROW) + F.col("tie")


def _nodes(rows: DataFrame, dims: int) -> list[Node]:
    """The parts that are more than one shard, with their widest dimension."""
    cell = [F.element_at("cell", i + 1) for i in range(dims)]
    found = (rows.filter("n > 1").groupBy("lo", "n")
             .agg(F.sum("weight").cast("double").alias("total"),
                  F.array(*[F.max(c) - F.min(c) for c in cell]).alias("spread")).collect())
    return [Node(r["lo"], r["n"], max(range(dims), key=lambda i: (r["spread"][i], -i)), r["total"]) for r in found]


def _with_node(rows: DataFrame, fields: str, table: list[tuple]) -> DataFrame:
    """``at``: the struct that the table has for the row's ``lo`` (its first field), or null.

    A table has a row per tree node at most, so as many as there are shards: a few are
    folded into an expression, more are broadcast.
    """
    kind = T._parse_datatype_string(fields)
    if len(table) > FOLDED:
        nodes = rows.sparkSession.createDataFrame(table, kind)
        nodes = nodes.select(F.col("lo").alias("of"), F.struct(*nodes.columns).alias("at"))
        return rows.join(F.broadcast(nodes), F.col("lo") == F.col("of"), "left").drop("of")
    at = F.lit(None)
    for values in table:
        own = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, kind.fields)])
        at = F.when(F.col("lo") == values[0], own).otherwise(at)
    return rows.withColumn("at", at)


def _narrow(rows: DataFrame, nodes: list[Node], near: float) -> None:
    """One pass: each node's cut, or the part of its range that holds the median.

    The bytes of a node's ranges (4096 at most) are added up in order where they lie; one
    row per node reaches the driver.
    """
    step = 12 if len(nodes) <= 256 else 8  # few sums per node where there are many
    asked = [(x.lo, x.dim, x.start, max(0, x.bits - step), x.below, x.want) for x in nodes]
    fields = "lo int, dim int, start long, shift int, below double, want double"
    bin_ = F.expr("shiftright(key - at.start, at.shift)")
    sums = (_with_node(rows, fields, asked).filter("at is not null").withColumn("key", _key("at.dim"))
            .filter("key >= at.start").withColumn("bin", bin_).filter(F.col("bin") < (1 << step))
            .groupBy("lo", "bin").agg(F.sum("weight").cast("double").alias("w"), F.first("at").alias("at")))
    so_far = F.sum("w").over(Window.partitionBy("lo").orderBy("bin")) + F.col("at.below")
    ends = sums.withColumn("end", so_far)
    one = F.struct("bin", "end", "w")
    picked = ends.groupBy("lo").agg(F.min(F.when(F.col("end") >= F.col("at.want"), one)).alias("hit"),
                                    F.max("bin").alias("last"))
    found = {r["lo"]: r for r in picked.collect()}
    for x in nodes:
        shift, r = max(0, x.bits - step), found.get(x.lo)
        if r is None or r["hit"] is None:
            x.cut = x.start + (((r["last"] if r else 0) + 1) << shift)
            continue
        at, below = x.start + (r["hit"]["bin"] << shift), r["hit"]["end"] - r["hit"]["w"]
        early, late = x.want - below, r["hit"]["end"] - x.want
        if min(early, late) <= near or shift == 0:
            x.cut = at if early <= late else at + (1 << shift)
        else:
            x.start, x.bits, x.below = at, shift, below


def kd_cuts(rows: DataFrame, dims: int, shards: int, tolerance: float) -> list[list[tuple[int, int, int, int]]]:
    """Per level the cuts (lo, dim, key, shards to the left) over rows of ``cell`` (array
    of dims), ``tie`` (below 2**40) and ``weight``."""
    rows = rows.select("cell", "tie", "weight", F.lit(0).alias("lo"), F.lit(shards).alias("n"))
    levels, near = [], 0.0
    while nodes := _nodes(rows, dims):
        near = near or tolerance * nodes[0].total / shards
        while todo := [x for x in nodes if x.cut is None]:
            _narrow(rows, todo, near)
        levels.append([(x.lo, x.dim, x.cut, x.left) for x in nodes])
        rows = settle(_descend(rows, levels[-1]), "tree")
    return levels


def _descend(rows: DataFrame, cuts: list[tuple[int, int, int, int]]) -> DataFrame:
    right = _key("at.dim") >= F.col("at.cut")
    return _with_node(rows, "lo int, dim int, cut long, left int", cuts).select(
        *[c for c in rows.columns if c not in ("lo", "n")],
        F.when(right, F.col("lo") + F.col("at.left")).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("at").isNull(), F.col("n")).when(right, F.col("n") - F.col("at.left"))
        .otherwise(F.col("at.left")).alias("n"))


def shard_by_bytes(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                   id_col: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("lang",),
                   tolerance: float = 0.002, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) with size, text_crc32, shard and slot per row.

    A row's size is its text's UTF-8 bytes plus 1 (null: 1). There are ``shards`` shards,
    or as many as target_bytes asks for. Dimensions are the text's length (its logarithm)
    and the metadata columns; rows of equal texts all count with the least metadata among
    them, and within one value rows are in order of their texts and then of their ids, so
    that equal texts stay together unless a cut within ``tolerance`` of a shard's bytes must
    go through them. Rows of equal text and id are not divided. slot numbers a shard's rows from 0 by id (null ids first).
    Null metadata is a value of its own; with fewer rows than shards some shards are
    empty. Columns of the input named like a result are replaced.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    size = (F.coalesce(F.octet_length(column(text).cast("string")), F.lit(0)) + 1).cast("long")
    crc = F.crc32(F.coalesce(column(text).cast("string"), F.lit("")).cast("binary"))
    names = [f"m{i}" for i in range(len(metadata))]
    base = docs.select(F.struct(*[column(c) for c in keep]).alias("row"), column(id_col).alias("id"),
                       size.alias("size"), crc.alias("text_crc32"), F.xxhash64(F.coalesce(
                           column(text).cast("string"), F.lit(""))).alias("mark"),
                       *[column(m).alias(name) for m, name in zip(metadata, names)]
                       ).withColumn("length", F.log2("size"))
    slim = settle(base.drop("row"), "sizes")
    # The groups of equal texts with several values of metadata: few, and no hot join, as
    # their table is stored first and so of known size.
    least, most = (f(F.struct(F.lit(0).alias("none"), *names)) for f in (F.min, F.max))
    mixed = settle(slim.groupBy("mark").agg(least.alias("least"), most.alias("most"))
                   .filter(~F.col("least").eqNullSafe(F.col("most"))).select("mark", "least"), "mixed")

    def together(rows: DataFrame) -> DataFrame:
        """Each group with its least metadata."""
        return rows.join(mixed, "mark", "left").withColumns({
            m: F.when(F.col("least").isNull(), F.col(m)).otherwise(F.col("least")[m]) for m in names}).drop("least", "mark")

    slim, base = settle(together(slim), "grouped"), together(base)
    dims = ["length", *names]
    tie = (F.shiftleft(F.shiftright("text_crc32", 32 - GROUP), ROW)
           + F.xxhash64("id").bitwiseAND(F.lit((1 << ROW) - 1)))
    cell = cells(slim, dims)
    if shards is None:
        shards = max(1, -(-(slim.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    levels = kd_cuts(slim.select(cell.alias("cell"), tie.alias("tie"), F.col("size").alias("weight")),
                     len(dims), shards, tolerance)
    # With all of the kept columns the rows are computed anew; with few the stored ones do.
    source = slim.withColumn("row", F.struct(F.col("id").alias(id_col))) if keep == [id_col] else base
    placed = source.select("row", "id", "size", "text_crc32", cell.alias("cell"), tie.alias("tie"),
                           F.lit(0).alias("lo"), F.lit(shards).alias("n"))
    for cuts in levels:
        placed = _descend(placed, cuts)
    done = placed.select("row", "id", "size", "text_crc32", F.col("lo").alias("shard"))
    return numbered(done, ["shard"], ["id"], "slots", "slot").select("row.*", *RESULTS)
