"""The Merkle manifest against a tree built level by level."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """Root, and per leaf the hashes before and after its own on each level."""
    paths, nodes = [[] for _ in leaves], [(h, [i]) for i, h in enumerate(leaves)]
    while len(nodes) > 1:
        level = []
        for at in range(0, len(nodes), 3):
            run = nodes[at: at + 3]
            for j, (_, members) in enumerate(run):
                for i in members:
                    paths[i].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1:])))
            level.append((digest("".join(h for h, _ in run)), [i for _, members in run for i in members]))
        nodes = level
    return nodes[0][0], paths


def expected(rows):
    """By (id, text): leaf, path, subroot and root."""
    groups = {}
    for id_, group, text in rows:
        groups.setdefault(group, []).append((id_ is not None, id_, digest(field(id_) + field(group) + field(text)), text))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
    trees = [tree([leaf for _, _, leaf, _ in groups[g]]) for g in order]
    root, over = tree([t[0] for t in trees])
    return sorted(((id_, leaf, path + over[i], trees[i][0], root) for i, g in enumerate(order)
                   for (_, id_, leaf, _), path in zip(groups[g], trees[i][1])), key=repr)


def found(spark, rows, height):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    leaf = merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.col("text")])
    got = merkle.manifest(docs, leaf, F.col("source"), F.col("doc_id"), {"doc_id": F.col("doc_id")}, height)
    return sorted(((r["doc_id"], r["leaf"], [tuple(s) for s in r["path"]], r["subroot"], r["root"])
                   for r in got.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_proofs_equal_the_tree(spark, height):
    rng, rows, n = random.Random(height), [], 0
    for group, size in [(None, 5), ("a", 1), ("b", 28), ("é", 3), ("z", 10), ("q", 2), ("hot", 60)]:
        for _ in range(size):
            rows.append((n, group, f"text {n} é\n"))
            n += 1
    rng.shuffle(rows)
    assert found(spark, rows, height) == expected(rows)


def test_nulls_repeats_and_ties(spark):
    rows = [(None, "a", "x"), (None, "a", None), (3, "a", "x"), (3, "a", "y"), (3, "a", "y"), (4, None, ""), (5, "", None),
            (6, "b", "long " * 50000)]
    assert found(spark, rows, 2) == expected(rows)


def test_one_row_and_no_row(spark):
    (only,) = found(spark, [(1, "a", "x")], 6)
    assert only[2] == [] and only[1] == only[3] == only[4]
    assert found(spark, [], 6) == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", "x", "own", 5), (2, "a", "y", "other", 6)],
                                 "doc_id long, source string, text string, leaf string, number long")
    got = merkle.manifest(docs, merkle.leaf_hash([F.col("text")]), F.col("source"), F.col("doc_id"),
                          {c: F.col(c) for c in docs.columns})
    assert got.columns == ["doc_id", "source", "text", "number", "leaf", "path", "subroot", "root"]
    assert {r["doc_id"]: (r["number"], r["leaf"]) for r in got.collect()} == {
        1: (5, digest("1:x")), 2: (6, digest("1:y"))}


def test_a_stored_manifest_finds_what_was_changed(spark, tmp_path):
    rows = [(i, f"s{i % 3}", f"text {i}") for i in range(20)]
    fields = ["doc_id", "source", "text"]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    merkle.write_manifest(docs, str(tmp_path / "m"), fields)
    changed = [(i, s, t + "!" if i == 4 else t) for i, s, t in rows if i != 7] + [(99, "s1", "new")]
    audit = merkle.audited(spark.createDataFrame(changed, docs.schema), spark.read.parquet(str(tmp_path / "m")), fields)
    assert {r["id"] for r in audit.filter("not verified").collect()} == {4, 7, 99}
    assert audit.filter("id = 7 and leaf is null").count() == 1 and audit.count() == 21


def test_no_join_gives_the_proofs(spark):
    docs = spark.createDataFrame([(i, "s", "t") for i in range(9)], "doc_id long, source string, text string")
    got = merkle.manifest(docs, merkle.leaf_hash([F.col("text")]), F.col("source"), F.col("doc_id"))
    assert "Join" not in got._jdf.queryExecution().toString()
