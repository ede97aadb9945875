"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import settle


def connected(links: DataFrame) -> DataFrame:
    """node, root for every end of a link (a, b: long); one root per component.

    In each round every node moves to the neighbour (or itself) of least hash, hashed
    anew per round so that no chain of nodes is in order, and the links move along.
    The links left shrink by a constant part of the nodes a round, so the rounds grow
    as the logarithm of the nodes. Minima are combined before their shuffle; joins are
    between stored tables, whose hot keys the adaptive skew join divides. Null ends
    and loops are ignored; an empty table gives an empty one.
    """
    links = settle(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
                   .filter("a != b").distinct(), "links")
    roots = settle(links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
                   .withColumn("root", F.col("node")), "nodes")
    salt = 0
    while not links.isEmpty():
        salt += 1

        def rank(name):
            return F.struct(F.xxhash64(F.col(name), F.lit(salt)).alias("h"), F.col(name).alias("n"))

        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = settle(both.groupBy("a").agg(F.min(rank("b")).alias("least"))
                       .select(F.col("a").alias("old"), F.least("least", rank("a"))["n"].alias("new")), "moves")
        roots = settle(roots.join(moves, roots["root"] == moves["old"], "left")
                       .select("node", F.coalesce("new", "root").alias("root")), "roots")
        left, right = moves.toDF("a", "na"), moves.toDF("b", "nb")
        links = settle(links.join(left, "a").join(right, "b")
                       .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
                       .filter("a != b").distinct(), "links")
    return roots
