"""Repeated passages against a list of all windows."""

import random

import pytest

from tidegauge.llm import substring_dedup as s


def brute(docs, length):
    """Removed places per row: windows that also start in a document of smaller id."""
    key = [(float("inf") if i is None else i, (t or "").split(" ") if t else []) for i, t in docs]
    key = [(i, [w for w in words if w]) for i, words in key]
    first = {}
    for i, words in key:
        for at in range(len(words) - length + 1):
            window = tuple(words[at: at + length])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in key:
        gone = {p for at in range(len(words) - length + 1) if first[tuple(words[at: at + length])] < i
                for p in range(at, at + length)}
        out.append((len(words), sorted(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return out


def made(rng, length, n):
    k = rng.choice([1, 2, 3, 20])
    pool = [[str(rng.randrange(k)) for _ in range(rng.randint(1, 3 * length))] for _ in range(4)]
    docs = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += (rng.choice(pool) if rng.random() < 0.6
                      else [str(rng.randrange(k)) for _ in range(rng.randint(1, 2 * length))])
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "x"
        docs.append((rng.randrange(2 * n), " ".join(words)))
    return docs


def found(spark, docs, length, **options):
    rows = spark.createDataFrame([(n, i, t) for n, (i, t) in enumerate(docs)], "row long, doc_id long, text string")
    got = s.without_repeats(rows, length=length, keep=["row"], **options).orderBy("row").collect()
    return [(r["n_words"], [p for a in r["removed"] for p in range(a["start"], a["stop"])], r["kept_text"]) for r in got]


@pytest.mark.parametrize("length, most", [(2, 512), (5, 512), (8, 1), (50, 512), (50, 1)])
def test_equals_the_windows(spark, length, most):
    rng = random.Random(length * 1000 + most)
    docs = made(rng, length, 40) + [(None, None), (3, ""), (None, " ".join("ab" * length))]
    assert found(spark, docs, length, most=most) == brute(docs, length)


def test_factoring_in_blocks_equals_the_windows():
    rng = random.Random(4)
    for _ in range(200):
        length = rng.choice([2, 3, 5, 8])
        docs = sorted(made(rng, length, rng.randint(1, 10)))
        split = [t.encode().split() for _, t in docs]
        counts, a = s.anchors(split, length)
        of = [i for i, n in enumerate(counts.tolist()) for _ in range(n)]
        groups = {}
        for j, i in enumerate(of):
            groups.setdefault(int(a["anchor"][j]), []).append((docs[i][0], i, j))
        gone = [set() for _ in docs]
        for group in groups.values():
            group.sort()
            texts = s.coded([b" ".join(split[i][a["start"][j]: a["start"][j] + a["words"][j]]).decode() for _, i, j in group])
            spans = s.factored([(d, t, int(a["before"][j])) for (d, _, j), t in zip(group, texts)], length)
            for (_, i, j), some in zip(group, spans):
                gone[i].update(int(a["start"][j]) + p for x, y in some for p in range(x, y))
        assert [sorted(g) for g in gone] == [b[1] for b in brute(docs, length)]


def test_rows_of_one_id_are_no_copies_and_null_ids_come_last(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = [(5, text), (5, text), (None, text), (None, text), (9, text + " end"), (7, "other")]
    assert [len(r[1]) for r in found(spark, docs, 50)] == [0, 0, 60, 60, 60, 0]


def test_exactly_a_window_and_one_word_less(spark):
    words = [f"w{i}" for i in range(50)]
    docs = [(1, " ".join(["a", *words, "b"])), (2, " ".join(["c", *words, "d"])), (3, " ".join(words[1:])),
            (4, "\t".join(words) + "\n")]
    assert [len(r[1]) for r in found(spark, docs, 50)] == [0, 50, 0, 50]


def test_a_common_passage_in_many_surroundings(spark):
    rng, passage = random.Random(2), " ".join(f"p{i}" for i in range(55))
    docs = [(i, " ".join([" ".join(f"{rng.random():.6f}" for _ in range(rng.randint(1, 40))), passage,
                          " ".join(f"{rng.random():.6f}" for _ in range(rng.randint(1, 40)))])) for i in range(60)]
    for most in (512, 8):
        assert [len(r[1]) for r in found(spark, docs, 50, most=most)] == [0] + [55] * 59


def test_empty_table_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a b", "mine", 4)], "doc_id long, text string, removed string, id long")
    got = s.without_repeats(rows)
    assert got.columns == ["doc_id", "text", "id", "n_words", "removed", "kept_text"]
    assert [tuple(r) for r in got.collect()] == [(1, "a b", 4, 2, [], "a b")]
    assert s.without_repeats(rows.limit(0)).isEmpty()


def test_a_very_long_text(spark):
    long = " ".join(f"v{i}" for i in range(200_000))
    docs = [(1, long), (2, "x " + long), (3, " ".join(f"v{i}" for i in range(1000, 1100)))]
    assert [len(r[1]) for r in found(spark, docs, 50)] == [0, 200_000, 100]
