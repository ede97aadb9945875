"""Token counts and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from conftest import SF
from tokenizers import Tokenizer

from tidegauge.llm import prefix_counts as p
from tidegauge.llm import tokens_file as f
from tidegauge.llm.common import fresh_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "'", "s", "re", "ll", "\n", "\t", "<|endoftext|>", "é", "1", "!", "日", " ", "The", "ing",
         "\x1c", "'ll", "<|end", "　", "́", "\x85", "🙂", "İ", "<|startoftext|>"]
EDGES = ["", "a  b", "it's they're  we'll\n\nx 'll 'r", "foo!<|endoftext|>bar  <|endoftext|> ", "<|endoftext|><|endoftext|>",
         "  a\t\tb \n c", "日本語 テキスト　　x", "a" * 300, "*" * 200, "a\x1cb \x1d c\x1f\x1f d", "123 4567 ½ ²x"]


def samples(n=300, seed=3):
    rng = random.Random(seed)
    return EDGES + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_every_prefix_has_the_library_s_count():
    library, counter = Tokenizer.from_file(BYTES), p.Counter(BYTES)
    for text in samples():
        steps = counter.steps(text)
        assert len(steps) == len(text.encode())
        for i in range(1, len(text) + 1):
            want = len(library.encode(text[:i], add_special_tokens=False).ids)
            assert p.count_at(steps, len(text[:i].encode())) == want, (text, i)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 3)
    one, two = p.Counter(BYTES), p.Counter(BYTES)
    for text in samples(40):
        assert one.steps(text).tolist() == two.steps(text).tolist()
        two = p.Counter(BYTES)


def test_answers(spark):
    library = Tokenizer.from_file(BYTES)
    rows = list(enumerate([*samples(60), None]))
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r for r in p.prefix_answers(docs, BYTES, 5).collect()}
    for i, text in rows:
        text, r = text or "", got[i]
        counts = [len(library.encode(text[:j], add_special_tokens=False).ids) for j in range(len(text) + 1)]
        assert (r["n_bytes"], r["n_tokens"], r["over_budget"]) == (len(text.encode()), counts[-1], counts[-1] > 5)
        best = len(text) if counts[-1] <= 5 else max(j for j, n in enumerate(counts) if n <= 5)
        assert r["kept_bytes"] == len(text[:best].encode())
    stored = p.prefix_tables(docs, BYTES, keep=["doc_id"]).collect()
    assert all(np.frombuffer(r["steps"], np.int8).sum(dtype=int) == got[r["doc_id"]]["n_tokens"] for r in stored)
    assert p.prefix_answers(docs.limit(0), BYTES, 5).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        p.Counter(WORDS)


def test_encoder_equals_the_library():
    library = Tokenizer.from_file(WORDS)
    texts = samples() + ["don't  stop\n\nNOW", "ΑΣ ΟΔΟΣ", "x<|endoftext|>y <|startoftext|> z", "x<|ENDOFTEXT|>y",
                         "Ab, a!. 1, é, É. e\u0301, —, x\u0085, \u00a0y ſ K ĳ ß ẞ ŉ it's, 'll. İ, ǅ ª º µ Å",
                         "a\x00b \x00, c\x1c. d", "naïve café ÀÉÎ"]
    texts += ["", "  ", ".", "a.", "a.b. c.. .d \x0b\x0c e!?\n", "\u3000a.\u3000b", "a." * 9]
    for some in (pa.array([None, *texts]).slice(1), pa.array([None, *texts[:9], None]).slice(1, 9), pa.array([], pa.string())):
        ids, offsets = f.Encoder(WORDS).encode(some)
        assert len(offsets) == len(some) + 1 and offsets[-1] == len(ids)
        for a, b, text in zip(offsets, offsets[1:], some.to_pylist()):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_forgetting_words_changes_nothing(spark, monkeypatch):
    texts = pa.array([r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()])
    want, encoder = f.Encoder(WORDS).encode(texts)[0].tolist(), f.Encoder(WORDS)
    monkeypatch.setattr(f, "REMEMBERED", 50)
    assert [i for n in range(60) for i in encoder.encode(texts.slice(n, 1))[0].tolist()] == want


def test_files_round_trip(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6, None), (10**6 + 1, "")], "doc_id long, text string"))
    path = fresh_path(spark, "tokens")
    f.write_tokens(docs, path, WORDS, 1)
    at, want = 0, {}
    for r in docs.orderBy("doc_id").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want[r["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in f.token_digests(spark, path).collect()}
    assert got == want
    assert {r["doc_id"]: r["start"] for r in f.token_starts(spark, path).collect()} == {k: v[0] for k, v in want.items()}
    some = f.read_tokens(spark, path, ["doc_id", "n_tokens"], 10, 19)
    assert sorted(r["doc_id"] for r in some.collect()) == list(range(10, 20))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "ids" not in plan.split("ReadSchema")[1]


def test_files_are_encoded_as_said(spark):
    import glob

    import pyarrow.parquet as pq
    path = fresh_path(spark, "tokens")
    f.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, WORDS, 1)
    name = max(glob.glob(path.removeprefix("file:") + "/*.parquet"), key=lambda n: pq.ParquetFile(n).metadata.num_rows)
    group = pq.ParquetFile(name).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    ids = next(c for n, c in columns.items() if n.startswith("ids"))
    assert ids.has_dictionary_page and ids.has_offset_index and columns["doc_id"].has_column_index


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "b b", "x"), (5, "a", "y"), (None, "c", "z"), (5, "a", "w")],
                                 "doc_id long, text string, part string")
    path = fresh_path(spark, "tokens")
    f.write_tokens(docs, path, WORDS, 1)
    got = sorted((r["start"], r["doc_id"] or 0, r["n_tokens"]) for r in f.token_digests(spark, path).collect())
    assert got == [(0, 0, 2), (2, 5, 2), (4, 5, 2), (6, 5, 3)]
    path = fresh_path(spark, "tokens")
    f.write_tokens(docs.limit(0), path, WORDS, 1)
    assert f.token_digests(spark, path).count() == 0


def test_every_letter_and_digit_counts_as_in_the_library():
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    letters = regex.findall(r"[\p{L}\p{N}]", every)
    counter, library = p.Counter(BYTES, p.newer_letters()), Tokenizer.from_file(BYTES)
    texts = [f"a{x}b {x}1 {x}{y}, {x}" for x, y in zip(letters, letters[1:] + letters[:1])]
    some = texts[:12_000] + texts[12_000::9]
    found = library.encode_batch_fast(some, add_special_tokens=False)
    assert [t for t, e in zip(some, found) if int(counter.steps(t).sum()) != len(e.ids)] == []


def test_other_tokenizers_are_refused():
    assert len(f.Encoder(WORDS).encode(pa.array(["Hello big World."]))[0]) == 4
    with pytest.raises(ValueError, match="on their own"):
        f.Encoder(BYTES)
