"""Winnowing against a search of all windows."""

import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate as d
from tidegauge.llm.common import utf8

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(text, items, window=13):
    """n_words, places hit, ids of the items met."""
    doc, hit, met = words(text), set(), set()
    for name, item in items:
        item = words(item)
        size = min(window, len(item))
        spans = {tuple(item[i:i + size]) for i in range(len(item) - size + 1)} if item else set()
        for i in range(len(doc) - size + 1):
            if size and tuple(doc[i:i + size]) in spans:
                hit.update(range(i, i + size))
                met.add(str(name))
    return len(doc), hit, sorted(met)


def ours(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.contaminated_spans(docs, bench, **options).orderBy("doc_id").collect()
    return [(r["n_words"], {w for s in r["spans"] for w in range(s["first"], s["stop"])}, list(r["items"])) for r in found]


def cases(seed):
    rng = random.Random(seed)

    def some(n):
        return " ".join(rng.choice(["ab", "Ab,", "c", "É", "x1-y", "日本"]) for _ in range(n))
    items = [(i, some(rng.choice([3, 5, 12, 13, 14, 30, 60]))) for i in range(25)]
    texts = [some(rng.randint(0, 120)) for _ in range(25)]
    for _ in range(25):
        part = words(rng.choice(items)[1])
        a = rng.randint(0, len(part) - 1)
        part = part[a:a + rng.randint(1, 40)]
        texts.append(some(rng.randint(0, 30)) + " " + " ".join(part).upper() + "! " + some(rng.randint(0, 30)))
    return texts + ["", None, "...", "ab"], items + [(100, None), (101, ""), (102, "ab"), (103, "?!")]


@pytest.mark.parametrize("kgram", [1, 5, 13])
def test_spans_equal_all_windows(spark, kgram):
    texts, items = cases(kgram)
    assert ours(spark, texts, items, kgram=kgram) == [plain(t, items) for t in texts]


def test_many_blocks_give_the_same_rows(spark):
    texts, items = cases(9)
    assert ours(spark, texts, items, block_bytes=200) == [plain(t, items) for t in texts]


def test_winnowing_keeps_a_fingerprint_of_every_long_span():
    rng = random.Random(4)
    text = " ".join(str(rng.randint(0, 50)) for _ in range(500))
    import pyarrow as pa
    found = d.words_of(*d.utf8(pa.array([text])))
    places = set(d.winnowed(found, 5, 9)[0].tolist())
    assert all(places & set(range(i, i + 9)) for i in range(500 - 12))


def test_hash_collisions_do_not_count(spark, monkeypatch):
    """All words have one hash; only equal words may count."""
    import numpy as np
    monkeypatch.setattr(d, "mixed", lambda h: np.zeros_like(h))
    import pyarrow as pa
    block = d.build_block([("7", "a b c d e f g h i j k l m n")], 13, 5)
    found = d.words_of(*d.utf8(pa.array(["z z a b c d e f g h i j k l m q", "n m l k j i h g f e d c b a"])))
    hits = d.hits_of(found, block)
    assert hits == [([(2, 15)], {0}), ([], set())]


def test_long_word_and_long_text(spark):
    text = "w" * 3_000_000 + " " + "x y " * 100_000
    assert ours(spark, [text], [(1, "y x " * 7)])[0][0] == 200_001


def test_drop_keeps_columns_and_clean_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 5, "a"), (2, item + " filler" * 1000, 6, "b"), (3, None, 7, "c"), (3, "", 8, None)],
                                 "doc_id long, text string, n_words int, items string")
    bench = spark.createDataFrame([(1, item), (1, "x y z")], "item_id long, text string")
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["n_words"]) for r in kept.collect()) == [(2, 6), (3, 7), (3, 8)]
    again = d.drop_contaminated(docs, bench, block_bytes=10)
    assert again.columns == docs.columns and sorted(again.collect(), key=repr) == sorted(kept.collect(), key=repr)
    found = d.contaminated_spans(docs, bench).collect()
    assert {len(r["items"]) for r in found} == {0, 1}
    assert d.contaminated_spans(docs.limit(0), bench).count() == 0
    none = d.contaminated_spans(docs, bench.limit(0)).agg(F.sum(F.size("items"))).first()[0]
    assert none == 0


@pytest.mark.parametrize("block_bytes", [1, 8 << 20])
def test_repeated_and_null_ids(spark, block_bytes):
    a, b, c, e = (" ".join(f"{x}{i}" for i in range(15)) for x in "abce")
    bench = spark.createDataFrame([(7, a), (7, b), (None, c), (None, e), (10, b)], "item_id long, text string")
    docs = spark.createDataFrame([(0, f"{a} x {b}"), (1, c), (2, f"{c} {e} {a}"), (3, "x")], "doc_id long, text string")
    rows = d.contaminated_spans(docs, bench, block_bytes=block_bytes).orderBy("doc_id").collect()
    assert [list(r["items"]) for r in rows] == [["10", "7"], [None], ["7", None], []]
    assert [sum(s["stop"] - s["first"] for s in r["spans"]) for r in rows] == [30, 15, 45, 0]
    kept = d.drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert [r["doc_id"] for r in kept.collect()] == [3]


def test_repeated_and_null_ids_as_in_sql(spark, tmp_path):
    import duckdb

    from tidegauge.llm.oracle import OP10
    from tidegauge.llm.queries import op10_decontamination
    a, b, c = (" ".join(f"{x}{i}" for i in range(15)) for x in "abc")
    tables = {"benchmark": spark.createDataFrame([(7, a), (7, b), (None, c), (10, b)], "item_id long, text string"),
              "documents": spark.createDataFrame([(0, f"{a} x {b}"), (1, c), (2, f"{c} {a}"), (3, "x")], "doc_id long, text string")}
    base = duckdb.connect()
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
        base.execute(f"CREATE TABLE {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(tuple(r) for r in op10_decontamination(spark, str(tmp_path)).collect())
    assert got == sorted(base.execute(OP10).fetchall())


def test_runs_of_one_word_equal_all_windows_in_linear_time(spark):
    rng = random.Random(8)

    def made(n):
        return " ".join(" ".join(["w"] * rng.choice([1, 3, 5, 6, 12, 13, 14, 30]) if rng.random() < 0.5
                                 else rng.choices(["w", "a", "b"], k=rng.randint(1, 9))) for _ in range(n))
    items = [(n, made(rng.randint(1, 5))) for n in range(12)] + [(20, "w w w w w w"), (21, "w " * 40)]
    texts = [made(rng.randint(1, 8)) for _ in range(60)]
    assert ours(spark, texts, items) == [plain(t, items) for t in texts]
    block = d.build_block([("spam", "buy " * 20_000)], 13, 5)
    began = time.perf_counter()
    found = d.hits_of(d.words_of(*utf8(pa.array(["buy " * 100_000]))), block)
    assert found == [([(0, 100_000)], {0})] and time.perf_counter() - began < 20
