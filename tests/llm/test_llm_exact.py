"""Exact duplicates against grouping by the text itself."""

import hashlib
import random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import exact_dedup as x


def plain(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault("".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r"), []).append(i)
    out = {}
    for text, places in groups.items():
        stay = min(places, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in places:
            out.setdefault((rows[i][0], rows[i][1]), []).append(
                (rows[stay][0], len(places), hashlib.sha256(text.encode()).hexdigest()))
    return {k: sorted(v, key=repr) for k, v in out.items()}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.withColumn("n", F.length("text"))
    got = x.exact_groups(docs).collect()
    want = plain(rows)
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["text_sha256"]) for r in got) == sorted(
        (k[0] or -1, a or -1, n, s) for k, v in want.items() for a, n, s in v)
    groups = {r["text_sha256"] for r in got}
    assert sum(r["kept"] for r in got) == len(groups)
    assert texts.count() == len(got)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (7, "é"), (8, "é"), (9, "ab "),
        (10, "ab"), (10, "ab"), (None, "a   b"), (None, "q"), (11, "x" * 200_000), (12, "x" * 199_999 + "y"),
        (13, " " + "x" * 200_000)]


def test_small_cases(spark):
    check(spark, ROWS)
    assert x.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    """With one fingerprint for all, the comparison alone tells texts apart."""
    monkeypatch.setattr(x, "combined", lambda chunks: F.lit(1).cast("long"))
    check(spark, ROWS)


def test_chunks_combine_to_the_hash_of_the_whole(spark):
    rng = random.Random(3)
    for n in (1, x.CHUNK - 1, x.CHUNK, x.CHUNK + 1, 3 * x.CHUNK + 17):
        data = rng.randbytes(n)
        counts, lengths, hashes = x.chunk_hashes(np.frombuffer(data, np.uint8), [n])
        assert counts.sum() == len(lengths) and lengths.sum() == n
        for base, power, found in zip(x.BASES, x.POWERS, hashes):
            whole = 0
            for b in data:
                whole = (whole * base + b) % x.PRIME
            h = 0
            for size, part in zip(lengths.tolist(), found.tolist()):
                h = (h * int(power[size]) + part) % x.PRIME
            assert h == whole


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows + [(10**9 + i, t) for i, t in rows[:40]])


def test_drop_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "a ", 2), (3, None, 3)], "doc_id long, text string, fp int")
    kept = x.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    with pytest.raises(Exception):
        x.drop_exact_duplicates(docs.drop("text")).count()


def test_clashing_columns_and_only_possible_copies_shuffled(spark):
    rows = [(1, "a b", "x", 1), (2, "ab", "y", 2), (3, "other", "z", 3), (3, "third", "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, fp long")
    got = sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in x.exact_groups(docs).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)]
    marks = x.signatures(docs.select(F.col("doc_id").alias("id"), "text", F.length("text").cast("long").alias("n_chars")),
                         keep=["id", "n_chars"])
    groups = marks.groupBy("fp", "n_bytes").agg(F.count("*").alias("group_size"), F.min(F.struct(
        (-F.col("n_chars")).alias("o"), "id")).alias("best")).filter("group_size > 1")
    assert x._different(docs.select(F.col("doc_id").alias("id"), "text", F.length("text").cast("long").alias("n_chars")),
                        groups, ["fp", "n_bytes"]).isEmpty()
