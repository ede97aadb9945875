"""Token ids as Parquet list columns, in document order.

Ids are dictionary-coded, document ids and places delta-coded; row groups and pages are
kept small enough that a read by document id, or of the metadata alone, touches few of
them (Parquet's column and offset indexes are written with the pages).
"""

from __future__ import annotations

import functools
import json
import os
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import before_parts, column, pieces, utf8
from tidegauge.llm.prefix_counts import byte_letters

#: Encoded words of a generation that a worker remembers.
REMEMBERED = 1 << 18
#: Bytes of text encoded at a time.
PIECE = 4 << 20
#: The steps before the model under which a text may be encoded word by word.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Marks at the end of a word of letters or digits are a piece of their own.
MARKS = r"([a-z0-9])([.,;:!?]+)([ \t\n\v\f\r]|$)"
BEYOND_LATIN = "\u0250"
SCHEMA = "doc_id long, part int, first long, n_tokens long, ids array<int>"
PARQUET = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "first", "n_tokens")},
    "parquet.dictionary.page.size": str(2 << 20),
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


class Encoder:
    """Ids of whole texts by the library, which sees each word between blanks once.

    For a tokenizer that composes, lowers letter by letter, drops white space and lets
    no token cross it, nor the border from letters or digits to marks. Unseen words of
    Latin letters alone are one piece to the library's model; others take its whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        steps = json.loads(self.library.to_str())
        if steps["normalizer"] != NORMALIZER or steps["pre_tokenizer"] != PRE_TOKENIZER:
            raise ValueError("words between blanks are not encoded on their own by this tokenizer")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        letters = {b: c for c, b in byte_letters().items()}
        self.letters = [letters[b] for b in range(256)]
        # Two generations of known words: the frequent ones pass on to the next.
        self.known: dict[bytes, bytes] = Known(self)
        self.before: dict[bytes, bytes] = {}

    def latin(self, word: bytes) -> str | None:
        """The word as the model takes it, if it is of Latin letters alone."""
        if word.isalpha():  # of bytes: ASCII
            return word.decode()
        text = word.decode()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if max(text) >= BEYOND_LATIN:
            return None
        text = text.lower()
        return "".join([self.letters[b] for b in text.encode()]) if text.isalpha() else None

    def word(self, word: bytes) -> bytes:
        """The ids of an unseen word."""
        ids = self.before.get(word)
        if ids is not None:
            return ids
        text = self.latin(word)
        if text is not None:
            return as_bytes([t.id for t in self.library.model.tokenize(text)])
        return as_bytes(self.library.encode(word.decode(), add_special_tokens=False).ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and len + 1 offsets; null counts as empty.

        Each distinct word is looked up once, and its ids are spread over its places.
        """
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, Known(self)
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        # Arrow lowers the wrong bytes of a slice, so the texts are laid out anew.
        data, places = utf8(texts)
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data))
        plain = pc.ascii_lower(texts)
        special = np.zeros(len(texts), bool)
        for mark in self.special:
            special |= pc.match_substring(plain, mark).to_numpy(zero_copy_only=False)
        if special.any():
            # Only so written is a special string one: these texts take the library's whole way.
            plain = pc.if_else(pa.array(special), "", plain)
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(plain, MARKS, r"\1 \2\3"))
        coded = lists.flatten().dictionary_encode()
        own = list(map(self.known.__getitem__, coded.dictionary.cast(pa.large_binary()).to_pylist()))
        sizes = np.array([len(ids) // 4 for ids in own], np.int64)
        of = coded.indices.to_numpy()
        n = sizes[of]
        ends = np.cumsum(n)
        first = np.cumsum(sizes) - sizes
        places = np.arange(n.sum()) - np.repeat(ends - n - first[of], n)
        ids = np.frombuffer(b"".join(own), "<u4")[places]
        offsets = np.concatenate(([0], ends))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        if not special.any():
            return ids, offsets
        parts = [np.array(self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4") if special[i]
                 else ids[offsets[i]: offsets[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


class Known(dict):
    """The ids of words, encoded when they are first asked for."""

    def __init__(self, encoder: Encoder):
        super().__init__({b"": b""})  # beside white space at the ends
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.encoder.word(word)
        return ids


def as_bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text: str = "text", options: dict[str, str] | None = None) -> None:
    """Writes doc_id, part, first, n_tokens and ids in ascending order of id.

    Each document's ids end with ``end_id``; null texts are empty. Parts are ranges of
    document ids in order, and first is a document's place within its part. Null ids
    come first; rows of equal id are ordered by text. An empty table writes no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(column(id_col).cast("long").alias("doc_id"),
                       F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer).encode
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                ids, offsets = encode(piece.column("text"))
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                values = np.full(len(ids) + len(sizes), end_id, np.uint32)
                inside = np.ones(len(values), bool)
                inside[ends - 1] = False
                values[inside] = ids
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.full(len(sizes), part, np.int32)),
                     pa.array(total + ends - sizes), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                              pa.array(values.view(np.int32)))],
                    ["doc_id", "part", "first", "n_tokens", "ids"])
                total += int(ends[-1]) if len(ends) else 0

    (rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SCHEMA).write.options(**{**PARQUET, **(options or {})}).parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Rows of the files, of a range of document ids if given; only the asked columns and
    the row groups and pages of that range are read."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.filter(F.col("doc_id") <= last_id)
    return rows.select(*(columns or rows.columns))


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part and start: a document's place in the ids of all files, from the
    metadata columns alone."""
    rows = read_tokens(spark, path, ["doc_id", "part", "first", "n_tokens"])
    before = before_parts(rows.groupBy("part").agg(F.sum("n_tokens").alias("n")), [], "part")
    return rows.join(before, "part").select("doc_id", "part", "first", (F.col("first") + F.col("before")).alias("start"))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, from the ids in the files."""
    rows = read_tokens(spark, path, ["doc_id", "part", "first", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy()
            values = ids.values.to_numpy().astype("<u4")
            sums = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("first"),
                 pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    found = rows.mapInArrow(run, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    totals = read_tokens(spark, path, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = before_parts(totals, [], "part")
    return found.join(before, "part").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
