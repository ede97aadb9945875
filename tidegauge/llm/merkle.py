"""Merkle manifest of a dataset: a tree per group of rows, and a tree over the groups.

Rows are numbered within their group. The base-3 digits of that number say where a row
hangs in its tree, so the tree is built by grouping the digit columns away, the lowest
first: each grouping nests the (up to three) child structs of a node and hashes their
hashes. That happens within blocks of 3**HEIGHT rows, so neither a group of all rows nor
a nested struct is ever unbounded; the roots of the blocks are the rows of the next tier,
and tiers go on until each group is one block. From the top down every block then gets
the way from its root to the tree's root, and one transform over its nested structs, with
an explode, gives every row its proof.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import column, numbered, settle

#: Levels of the tree in a block.
HEIGHT = 6
#: A step of a proof: the hashes before and after one's own in a run of siblings.
STEP = "struct<left:string,right:string>"
NO_STEPS = f"CAST(array() AS array<{STEP}>)"


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of the values in order: ``-`` for null, else the byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")


def rolled(nodes: DataFrame, height: int) -> DataFrame:
    """group, block, levels, hash and kids of each block of ``3**height`` nodes (group,
    number from 0 within it, hash, item).

    A block that holds its whole group has as many levels as its nodes need, none for a
    single node; other blocks have all. Levels above hand a lone node on as it is.
    """
    width = 3 ** height
    number = F.col("number")
    rows = (nodes.withColumn("block", F.floor(number / width).cast("long"))
            .repartition("group", "block"))
    # Both the block and its size are known once its rows are together.
    rows = rows.withColumn("size", F.expr("count(1) OVER (PARTITION BY group, block)"))
    needed = reduce(lambda a, b: a + b, [(F.col("size") > 3 ** i).cast("int") for i in range(height)])
    alone = (F.col("block") == 0) & (F.col("size") < width)
    rows = rows.select("group", "block", F.when(alone, needed).otherwise(height).alias("levels"),
                       *[(F.floor(number / 3 ** i) % 3).cast("int").alias(f"digit{i}") for i in range(height)],
                       "hash", "item")
    for i in range(height):
        above = [f"digit{j}" for j in range(i + 1, height)]
        rows = rows.groupBy("group", "block", "levels", *above).agg(
            F.array_sort(F.collect_list(F.struct(F.col(f"digit{i}").alias("digit"), "hash", "item"))).alias("item"))
        rows = rows.withColumn("hash", F.when(F.col("levels") > i, F.sha2(_joined(F.col("item")), 256))
                               .otherwise(F.col("item")[0]["hash"]))
    return rows.withColumnRenamed("item", "kids")


def _unrolled(kids: Column, level: int, above: Column) -> Column:
    """(item, leaf, path) of every node at the bottom of the nested structs, in order."""

    def one(kid: Column) -> Column:
        step = F.struct(_joined(F.filter(kids, lambda x: x["digit"] < kid["digit"])).alias("left"),
                        _joined(F.filter(kids, lambda x: x["digit"] > kid["digit"])).alias("right"))
        path = F.concat(F.when(F.col("levels") > level, F.array(step)).otherwise(F.expr(NO_STEPS)), above)
        if level:
            return _unrolled(kid["item"], level - 1, path)
        return F.struct(kid["item"].alias("item"), kid["hash"].alias("leaf"), path.alias("path"))

    found = F.transform(kids, one)
    return F.flatten(found) if level else found


def climbed(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The stored blocks of every tier, from the nodes up to one block a group.

    An item of a higher tier is the number of the block below. The tiers are as many as
    the logarithm of the largest group to the base ``3**height``.
    """
    tiers = []
    while True:
        tiers.append(settle(rolled(nodes, height), f"merkle-tier{len(tiers)}"))
        if not (tiers[-1].agg(F.max("block")).first()[0] or 0):
            return tiers
        nodes = tiers[-1].select("group", F.col("block").alias("number"), "hash", F.col("block").alias("item"))


def descended(tiers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """group, item, leaf, path and the columns of ``tops`` (group, path and others: one
    row per group, with the way on from its root) for the nodes of the lowest tier.

    The row of a block and the row with its way up meet in a group of two.
    """
    others = [c for c in tops.columns if c not in ("group", "path")]
    ways = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        blank = [F.lit(None).cast(ways.schema[c].dataType).alias(c) for c in ["path", *others]]
        both = tier.select("group", "block", "levels", "kids", *blank).unionByName(
            ways.select("group", "block", F.lit(None).cast("int").alias("levels"),
                        F.lit(None).cast(tier.schema["kids"].dataType).alias("kids"), "path", *others))
        met = both.repartition("group", "block").groupBy("group", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", *others)])
        rows = met.select("group", *others, F.explode(
            _unrolled(F.col("kids"), height - 1, F.col("path"))).alias("x")).select("group", *others, "x.*")
        ways = rows.withColumnRenamed("item", "block").drop("leaf")
    return rows


def manifest(docs: DataFrame, leaf: Column, group: Column, order: Column, carry: dict[str, Column] | None = None,
             height: int = HEIGHT) -> DataFrame:
    """The carried columns, leaf, path, subroot (of the row's group) and root, per row.

    The path holds the hashes beside one's own, level by level from the leaf to the root
    (``folded`` goes along it). Rows of a group are in ascending order of ``order``, then
    of leaf, and groups in ascending order, each with nulls first; strings compare by
    their UTF-8 bytes. A null group is a group. Repeated rows are leaves of their own;
    texts of any length are hashed whole and not kept. Carried columns may have any
    names: they are kept apart until the end, where a computed one takes the place of its
    namesake. An empty table gives an empty one. At most ``3**height`` rows of a group
    meet in one place, and so do at most ``3**height`` groups.
    """
    carry = carry or {}
    marks = settle(docs.select(group.alias("group"), order.alias("order"), leaf.alias("hash"),
                               F.struct(F.lit(0).alias("none"), *[c.alias(f"c{i}") for i, c in
                                                                  enumerate(carry.values())]).alias("item")), "leaves")
    tiers = climbed(numbered(marks, ["group"], ["order", "hash"], "ranks"), height)
    roots = tiers[-1].select("group", "hash")
    over = climbed(numbered(roots, [], ["group"], "roots").select(
        F.lit(0).alias("group"), "number", "hash", F.struct("group").alias("item")), height)
    top = over[-1].select("group", F.expr(NO_STEPS).alias("path"),
                          F.col("hash").alias("root"))
    tops = descended(over, top, height).select(F.col("item.group").alias("group"), "path", "root",
                                               F.col("leaf").alias("subroot"))
    rows = descended(tiers, tops, height)
    ours = ["leaf", "path", "subroot", "root"]
    return rows.select(*[F.col("item")[f"c{i}"].alias(name) for i, name in enumerate(carry) if name not in ours], *ours)


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and the hashes beside its path give."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_hash(path: Column) -> Column:
    """Hash of all hashes of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def write_manifest(docs: DataFrame, path: str, fields: list[str], id_col: str = "doc_id",
                   group_col: str = "source", height: int = HEIGHT) -> None:
    """Stores id, group, leaf, path, subroot and root of every row as Parquet, by group and id."""
    rows = manifest(docs, leaf_hash([column(f) for f in fields]), column(group_col), column(id_col),
                    {"__id": column(id_col), "__group": column(group_col)}, height)
    rows.repartitionByRange("__group", "__id").sortWithinPartitions("__group", "__id").select(
        F.col("__id").alias("id"), F.col("__group").alias("group"), "leaf", "path", "subroot", "root").write.parquet(path)


def audited(docs: DataFrame, stored: DataFrame, fields: list[str], id_col: str = "doc_id") -> DataFrame:
    """id, leaf (of the row as it is now, null if it is gone) and verified for every row of
    a stored manifest with distinct ids, and for rows that it does not know (not verified)."""
    now = docs.select(column(id_col).alias("__id"), leaf_hash([column(f) for f in fields]).alias("__leaf"))
    both = stored.join(now, stored["id"].eqNullSafe(now["__id"]), "full")
    fits = folded(F.col("path"), F.col("__leaf")) == F.col("root")
    return both.select(F.coalesce("id", "__id").alias("id"), F.col("__leaf").alias("leaf"),
                       F.coalesce(fits, F.lit(False)).alias("verified"))
