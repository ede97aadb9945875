"""SimHash against brute force."""

import random

import numpy as np
import pytest
import xxhash
from conftest import SF

from tidegauge.llm import simhash
from tidegauge.llm.components import connected


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=3):
    """Label per place: the least place reachable."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance).tolist():
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one two", "A b C d\x0be  f", "É é x É é", "a a a a a a",
                                  "日本 語 " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_many_shingles(monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 7)
    rng = random.Random(1)
    text = " ".join(rng.choice(["ab", "C", "dé", "x"]) for _ in range(200))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_gray_rank_orders_neighbours():
    codes = np.array([i ^ (i >> 1) for i in range(1000)], np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(1000))


def test_index_search_finds_all_near_pairs():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    some = np.unique(np.concatenate([centres ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64))
                                     for _ in range(20)]))
    some = some[np.argsort(simhash.gray_rank(some))]
    for other in (some, some[:50], some[7:8]):
        x, y = simhash.search(simhash.Index(some), simhash.Index(other), 3)
        near = np.bitwise_count(some[:, None] ^ other[None, :]) <= 3
        assert set(zip(x.tolist(), y.tolist())) == set(zip(*(a.tolist() for a in np.nonzero(near))))


@pytest.mark.parametrize("block", [2048, 24])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, block):
    """Small blocks: the hot bucket of one band is spread over many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(2)
    hot = np.uint64(0xABCD << 48) | rng.integers(0, 1 << 48, 150, dtype=np.uint64)
    walk = [np.uint64(0xABCD << 48)]
    for _ in range(80):
        walk.append(walk[-1] ^ np.uint64(1 << int(rng.integers(0, 60))) ^ np.uint64(1 << int(rng.integers(0, 60))))
    fps = np.unique(np.concatenate([hot, np.array(walk), rng.integers(0, 1 << 63, 100, dtype=np.uint64) * np.uint64(2),
                                    np.array([0, 7, (1 << 64) - 1], np.uint64)])).tolist()
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    entries = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(entries, 3).collect()]
    place = {f: i for i, f in enumerate(signed)}
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in links:
        assert (fps[place[a]] ^ fps[place[b]]) >= 0
        x, y = find(place[a]), find(place[b])
        label[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == plain_components(fps)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    got = connected(spark.createDataFrame(chain + star + [(5, 5), (None, 3)], "a long, b long")).collect()
    roots = {}
    for r in got:
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [201, 300]
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    want = {r["doc_id"]: (f, rows[c]["doc_id"]) for r, f, c in zip(rows, fps, plain_components(fps))}
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.simhash_groups(docs).collect()}
    assert got == want
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()}
    assert kept == {c for _, c in want.values()}


def test_nulls_empty_texts_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "\n", None), (4, "only here", "z"), (4, "only here", "z"), (None, "other words", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r["doc_id"] or 0, r["fp"] == 0, r["component_id"]) for r in simhash.simhash_groups(docs).collect())
    assert got == [(0, False, None), (1, True, 1), (2, True, 1), (3, True, 1), (4, False, 4), (4, False, 4)]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["fp"]) for r in kept.collect()) == [(0, "n"), (1, "x"), (4, "z")]
    assert simhash.simhash_groups(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_component_where_ids_repeat(spark):
    rng = random.Random(9)
    texts = {name: " ".join(str(rng.random()) for _ in range(30)) for name in "ABC"}
    rows = [(1, texts["A"], 0), (5, texts["A"], 1), (5, texts["B"], 2), (5, texts["C"], 3), (5, texts["C"], 4),
            (None, texts["B"], 5), (None, None, 6), (None, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = []
    for parts in (1, 3, 8):
        got = simhash.drop_near_duplicates(docs.repartition(parts)).collect()
        kept.append(sorted(((r["doc_id"], r["text"], r["n"]) for r in got), key=repr))
    assert kept[0] == kept[1] == kept[2]
    assert [(i, t) for i, t, _ in kept[0]] == sorted([(1, texts["A"]), (5, texts["B"]), (5, texts["C"]), (None, None)], key=repr)
