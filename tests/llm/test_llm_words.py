"""The word model: word order, scripts beyond ASCII, thresholds from texts held out."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import quality as q
from tidegauge.llm import word_model as w


class Plain:
    """Interpolated modified Kneser-Ney with dictionaries, over lists of words."""

    def __init__(self, texts, order, known):
        self.counts, self.known, top = [None] * (order + 1), known, Counter()
        for words in texts:
            top.update(tuple(words[i:i + order]) for i in range(len(words) - order + 1))
        self.counts[order] = top
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.cut = []
        for c in self.counts[1:]:
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
            self.cut.append([min(float(i), max(0.0, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else 0.5 * i for i in (1, 2, 3)])
        self.after = []
        for c in self.counts[1:]:
            groups = defaultdict(list)
            for g, n in c.items():
                groups[g[:-1]].append(n)
            self.after.append(groups)

    def p(self, gram):
        if not gram:
            return 1 / (self.known + 1)
        k = len(gram)
        lower, counts = self.p(gram[1:]), self.after[k - 1].get(gram[:-1])
        if not counts:
            return lower
        d = self.cut[k - 1]
        n = self.counts[k].get(gram, 0)
        freed = sum(d[min(c, 3) - 1] for c in counts)
        return ((n - d[min(n, 3) - 1] if n else 0.0) + freed * lower) / sum(counts)


def judge(spark, trusted, others):
    rows = [(i, t, "xx") for i, t in enumerate([*trusted, *others])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = q.judge_quality(docs, docs.filter(f"doc_id < {len(trusted)}").select("doc_id")).collect()
    return {r["doc_id"]: r for r in found}


def test_words_of_several_scripts():
    texts = ["Ab, ÉTÉ 12x", None, "", "日本。", "привет ПРИВЕТ", "Ab"]
    hashes, n = w.words(pa.array(texts))
    assert n.tolist() == [4, 0, 0, 3, 2, 1]
    assert hashes[0] == hashes[9] and hashes[7] == hashes[8]
    assert len(set(hashes.tolist())) == 8
    assert len(set(w.words(pa.array([chr(0x4E00), chr(0x4E00 + 23), chr(0x4E00 + 46)]))[0].tolist())) == 3


@pytest.mark.parametrize("hot", [2.0 ** -16, 2.0])
def test_perplexity_equals_the_plain_model(spark, monkeypatch, hot):
    monkeypatch.setattr(w, "HOT", hot)
    rng = random.Random(2)
    trusted = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(40)]
    texts = trusted[:5] + ["a b c d", "a zz b zz", "", "q", "a b c d"]
    frame = spark.createDataFrame([(t,) for t in trusted], "text string")
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    halves = {r["text"]: r["half"] for r in w.keyed(frame.union(docs), "text").collect()}
    keys = {r["text"]: r["key"] for r in w.keyed(docs, "text").collect()}
    got = {r["key"]: r["perplexity"] for r in w.word_perplexities(docs, frame, q.discounts).collect()}
    seen = {c for t in trusted for c in t.split()}

    def spelled(text):
        return ["<"] * (w.ORDER - 1) + text.split()

    models = [Plain([spelled(t) for t in trusted if halves[t] == h], w.ORDER, len(seen)) for h in (0, 1)]
    for text in texts:
        s = spelled(text)
        logs = [math.log(models[1 - halves[text]].p(tuple(s[i:i + w.ORDER]))) for i in range(len(s) - w.ORDER + 1)]
        assert (keys[text] in got) == bool(logs)
        assert not logs or abs(got[keys[text]] / math.exp(-np.mean(logs)) - 1) < 1e-6


@pytest.mark.parametrize("first", [0x61, 0x430, 0x4E00])
def test_shuffled_words_and_wrong_letters_score_worse(spark, first):
    rng = random.Random(first)
    names = ["".join(chr(first + rng.randrange(20)) for _ in range(5)) for _ in range(60)]
    follows = {n: rng.sample(names, 3) for n in names}

    def prose():
        out = [rng.choice(names)]
        while len(out) < 60:
            out.append(rng.choice(follows[out[-1]]))
        return out
    trusted = [prose() for _ in range(200)]
    clean = [prose() for _ in range(20)]
    salad = [rng.sample(t, len(t)) for t in clean]
    wrong = [["".join(chr(ord(c) + 23 * 40) for c in word) for word in t] for t in clean]
    rows = judge(spark, [" ".join(t) for t in trusted], [" ".join(t) for t in [*clean, *salad, *wrong]])
    kept = [rows[200 + i]["kept"] for i in range(60)]
    assert sum(kept[:20]) >= 18 and not any(kept[20:])


def test_trusted_texts_are_held_out(spark):
    rng = random.Random(5)
    texts = [" ".join(str(chr(97 + rng.randrange(26))) * rng.randint(1, 9) for _ in range(40)) for _ in range(400)]
    rows = judge(spark, texts[:200], texts[200:])
    kept = [np.median([rows[i]["perplexity"] for i in part]) for part in (range(200), range(200, 400))]
    assert abs(kept[0] / kept[1] - 1) < 0.05


@pytest.mark.parametrize("hot", [2.0 ** -20, 0.02])
def test_passes_and_buckets_change_no_result(spark, monkeypatch, hot):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    trusted = docs.filter(F.xxhash64("text") % 3 == 0)

    def found():
        return {r["key"]: r["perplexity"] for r in w.word_perplexities(docs, trusted, q.discounts).collect()}
    whole = found()
    for name, value in {"HOT": hot, "PASS": 900, "BUCKET": 60, "HELD": 500, "TEXTS": 40}.items():
        monkeypatch.setattr(w, name, value)
    parts = found()
    assert parts.keys() == whole.keys() and len(whole) > 250
    assert max(abs(parts[k] / whole[k] - 1) for k in whole) < 1e-9


def test_little_stays_on_disk(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("tidegauge.llm.common.shared_root", lambda spark: str(tmp_path))
    rng = random.Random(4)
    texts = [" ".join(f"{rng.randrange(3000):x}" for _ in range(600)) for _ in range(100)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert w.word_perplexities(docs, docs, q.discounts).count() == 100
    left = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert left < sum(map(len, texts)) / 4


def test_texts_are_split_into_words_twice_whatever_the_passes(spark, monkeypatch, tmp_path):
    seen = tmp_path / "seen"

    def noted(name):
        def run(texts):
            from tidegauge.llm import word_model
            with open(seen, "a") as f:
                f.write(f"{len(texts)}\n")
            return getattr(word_model, name)(texts)
        return run
    rng = random.Random(6)
    docs = spark.createDataFrame([(" ".join(rng.choice("abcdefghijklmnop") for _ in range(30)),) for _ in range(200)], "text string")
    for name in ("words", "grams"):
        monkeypatch.setattr(w, name, noted(name))
    monkeypatch.setattr(w, "PASS", 900)
    assert w.word_perplexities(docs, docs, q.discounts).count() == 200
    assert sum(map(int, seen.read_text().split())) == 2 * (200 + 200)
