"""Runs against comparing the words at every shift."""

import hashlib
import random
import zlib

import pytest
from conftest import SF

from tidegauge.llm import periodic_runs as r
from tidegauge.llm.queries import LLM_QUERIES


def brute(words):
    """(start, length, period) of every run; the smallest period of a stretch comes first."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed(words, runs):
    gone = {p for start, length, period in runs for p in range(start + period, start + length)}
    return [w for p, w in enumerate(words) if p not in gone]


def made(rng):
    k, size, words = rng.choice([1, 2, 2, 3, 5, 50]), rng.randint(0, 400), []
    while len(words) < size:
        unit = [str(rng.randrange(k)) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.3:
            unit += [str(rng.randrange(k)) for _ in range(rng.randint(1, 6))] * rng.randint(1, 14) + [str(rng.randrange(k))]
        words += unit * rng.randint(1, 5)
    return words


@pytest.mark.parametrize("seed", range(6))
def test_equals_all_shifts(seed):
    rng = random.Random(seed)
    docs = [made(rng) for _ in range(60)]
    counts, runs, kept = r.runs_of_texts([" ".join(d).encode() for d in docs])
    for words, n, found, text in zip(docs, counts, runs, kept):
        want = brute(words)
        assert n == len(words) and found == want and text.decode().split() == collapsed(words, want)


@pytest.mark.parametrize("period", [1, 7, 8, 9, 15, 16, 31, 32, 33, 63, 64, 200, 1000])
def test_a_period_of_its_own_words(period):
    unit = [f"w{i}" for i in range(period)]
    words = ["a"] + unit * max(3, -(-24 // period)) + unit[: period // 2] + ["b"]
    length = len(words) - 2
    assert r.runs_of_texts([" ".join(words).encode()])[1] == [[(1, length, period)]]
    short = unit * 3
    assert r.runs_of_texts([" ".join(short[:-1]).encode()])[1] == [[]]


def test_periods_within_periods():
    inner = ["x", "y"] * 15
    words = (inner + [f"z{i}" for i in range(40)]) * 4
    assert r.runs_of_texts([" ".join(words).encode()])[1] == [brute(words)]
    assert len(brute(words)) == 5


def test_thue_morse_has_no_cubes():
    bits = [0]
    for _ in range(13):
        bits += [1 - b for b in bits]
    assert r.runs_of_texts([" ".join(map(str, bits)).encode()])[1] == [[]]
    assert r.runs_of_texts([" ".join(map(str, bits[:512] * 3)).encode()])[1] == [[(0, 1536, 512)]]


def test_nulls_empty_repeated_and_clashing(spark):
    rows = [(1, None, "mine"), (2, "", "x"), (3, " \t\n", "x"), (4, "ha " * 30, "x"), (4, "ha " * 30, "x"),
            (None, " a b c", "x"), (6, "go on " * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = r.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    out = {x["doc_id"]: (x["n_words"], [tuple(y) for y in x["runs"]], x["collapsed"]) for x in got.collect()}
    assert got.count() == 7
    assert out[1] == out[2] == out[3] == (0, [], "")
    assert out[4] == (30, [(0, 30, 1)], "ha") and out[None] == (2, [], " a b c")
    assert out[6] == (400_000, [(0, 400_000, 2)], "go on")
    assert r.periodic_runs(docs.limit(0)).isEmpty()


def test_query_equals_all_shifts_of_planted_documents(spark):
    docs = {x["doc_id"]: x["text"] or "" for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {x["doc_id"]: x for x in LLM_QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    checked = 0
    for id_, text in docs.items():
        words = [w.decode() for w in text.encode().split()]
        if len(words) > 1500 and checked > 3:
            continue
        checked += len(words) > 1500
        h = zlib.crc32(str(id_).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, row = brute(words), got[id_]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(" ".join(collapsed(words, runs)).encode()).hexdigest()
