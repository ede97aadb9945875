"""K-d shards: balance, numbering, and what stays together."""

import random
import zlib

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import sharding as s
from tidegauge.llm.common import numbered


def sums(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r["size"])
    return out


def check_rows(rows, texts):
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_documents_in_near_equal_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = s.shard_by_bytes(docs, shards=16).collect()
    check_rows(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(docs.columns) < set(rows[0].asDict()) and len(rows) == docs.count()
    by = sums(rows)
    total, largest = sum(map(sum, by.values())), max(r["size"] for r in rows)
    assert set(by) == set(range(16))
    assert all(abs(sum(v) - total / 16) <= 2 * largest + 0.02 * total for v in by.values())


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_a_hot_group_is_divided_and_others_stay_together(spark, shards):
    rng = random.Random(shards)
    rows = [(i, "hot text", "en") for i in range(900)]
    rows += [(1000 + i, f"text {i % 200} " + "x" * rng.randint(0, 30), rng.choice(["en", "de", None])) for i in range(1500)]
    rows += [(3000 + i, None, "fr") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("slot", F.lit("input"))
    got = s.shard_by_bytes(docs, shards=shards).collect()
    check_rows(got, {i: t for i, t, _ in rows})
    by = [sum(v) for v in sums(got).values()]
    assert max(by) - min(by) <= 0.03 * sum(by) / shards + 100
    groups = {}
    for r in got:
        groups.setdefault((r["text_crc32"], r["lang"]), set()).add(r["shard"])
    assert sum(len(v) > 1 for v in groups.values()) <= shards - 1


def test_target_bytes_few_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", None), (1, "abc", None), (None, "abc", None)], "doc_id long, text string, lang string")
    got = s.shard_by_bytes(docs, target_bytes=6).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in got) == [(4, zlib.crc32(b"abc"))] * 3
    assert {r["shard"] for r in got} <= {0, 1}
    assert s.shard_by_bytes(docs.limit(0), shards=4).count() == 0
    assert s.shard_by_bytes(docs.limit(0), target_bytes=4).count() == 0
    with pytest.raises(ValueError):
        s.shard_by_bytes(docs)


def test_numbering_over_many_parts(spark):
    frame = spark.range(5000).select((F.col("id") % 7 * F.when(F.col("id") > 3000, 0).otherwise(1)).alias("g"),
                                     (-F.col("id")).alias("o"))
    rows = numbered(frame, ["g"], ["o"], "t").collect()
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append((r["o"], r["number"]))
    for v in by.values():
        assert [n for _, n in sorted(v)] == list(range(len(v)))


def test_equal_texts_of_several_languages_stay_together(spark):
    rows = [(g * 32 + i, f"text number {g} " * 20, ["de", "en", None, "fr"][i % 4]) for g in range(50) for i in range(32)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = s.shard_by_bytes(docs, shards=7).collect()
    places = {}
    for r in got:
        places.setdefault(r["text"], set()).add(r["shard"])
    # A cut goes through a group only where no other place is near enough.
    assert sum(len(p) > 1 for p in places.values()) <= 6
    assert {r["doc_id"]: r["lang"] for r in got} == {i: lang for i, _, lang in rows}


def test_a_bounded_lookup_and_no_product(spark):
    rows = spark.createDataFrame([([i % 7 + 1, i + 1], i, 1, 0, 4) for i in range(500)],
                                 "cell array<long>, tie long, weight long, lo int, n int")
    few = s._descend(rows, [(0, 1, 200 << 40, 2)])
    many = s._descend(rows, [(0, 1, 200 << 40, 2)] + [(1000 + i, 0, 0, 1) for i in range(s.FOLDED)])
    assert sorted(map(tuple, few.select("tie", "lo", "n").collect())) == sorted(
        map(tuple, many.select("tie", "lo", "n").collect()))
    plan = few._jdf.queryExecution().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" in many._jdf.queryExecution().toString()
