"""Exact duplicates by composable polynomial fingerprints.

A text's bytes are hashed in chunks, each a polynomial in two bases modulo a prime; the
chunks of a text combine by shifting the hash so far by the next chunk's length, so the
result is that of the whole text however it is cut. Texts of equal fingerprint and
length are candidates only: each is compared, chunk by chunk, with the one that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import column, settle, utf8, with_text_columns

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525)
CHUNK = 1 << 16
#: Cells of the filter that finds texts with possible copies: at most so many integers are broadcast.
CELLS = 1 << 20
#: The white space that makes no difference between texts.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])

POWERS = []
for base in BASES:
    row = np.empty(CHUNK + 1, np.uint64)
    power = 1
    for place in range(CHUNK + 1):
        row[place] = power
        power = power * base % PRIME
    POWERS.append(row)

FIELDS = ("n_bytes bigint, text_sha256 string, "
          "chunks array<struct<shift1:bigint,hash1:bigint,shift2:bigint,hash2:bigint>>")


def chunk_hashes(data: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For texts of these sizes laid end to end: chunks of each, chunk sizes, hash per base."""
    counts = np.array([-(-n // CHUNK) for n in sizes], np.int64)
    ends, at = [], 0
    for n in sizes:
        ends.extend(range(at + CHUNK, at + n, CHUNK))
        at += n
        if n:
            ends.append(at)
    ends = np.array(ends, np.int64)
    if not len(ends):
        return counts, ends, [np.zeros(0, np.int64)] * 2
    starts = np.concatenate(([0], ends[:-1]))
    behind = np.repeat(ends, ends - starts) - 1 - np.arange(len(data))
    # A product is below 2**39 and a chunk has 2**16 of them.
    hashes = [(np.add.reduceat(data * power[behind], starts) % np.uint64(PRIME)).astype(np.int64)
              for power in POWERS]
    return counts, ends - starts, hashes


def combined(chunks: Column) -> Column:
    """One fingerprint (62 bits) of the chunks in order: h = h * base**length + chunk's h."""
    def fold(shift: str, own: str) -> Column:
        return F.aggregate(chunks, F.lit(0).cast("long"),
                           lambda h, c: F.pmod(h * c[shift] + c[own], F.lit(PRIME).cast("long")))
    halves = [fold("shift1", "hash1"), fold("shift2", "hash2")]
    return F.shiftleft(halves[0], 31).bitwiseOR(halves[1])


def signatures(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
               with_text: bool = False) -> DataFrame:
    """The kept columns, n_bytes, text_sha256 and fp of each text without white space, and
    the bytes themselves as ``plain`` if asked for. Null counts as empty."""

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            raw, at = data.tobytes(), at.tolist()
            plain = [raw[x:y].translate(None, BLANKS) for x, y in zip(at, at[1:])]
            sizes = [len(p) for p in plain]
            counts, lengths, hashes = chunk_hashes(np.frombuffer(b"".join(plain), np.uint8), sizes)
            shifts = [power[lengths].astype(np.int64) for power in POWERS]
            chunks = pa.StructArray.from_arrays(
                [pa.array(a) for a in (shifts[0], hashes[0], shifts[1], hashes[1])],
                ["shift1", "hash1", "shift2", "hash2"])
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            out = [pa.array(sizes, pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in plain]),
                   pa.ListArray.from_arrays(offsets, chunks)]
            return [*out, pa.array(plain, pa.binary())] if with_text else out
        return compute

    found = with_text_columns(docs, text, FIELDS + (", plain binary" if with_text else ""), make, keep)
    return found.withColumn("fp", combined(F.col("chunks"))).drop("chunks")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256 and n_bytes (without white space) per row.

    Of equal texts the row with the most code points in the original text stays, then
    the least id (null ids last), then, of rows equal in both, any one. Rows of a
    repeated id are rows of their own. Null texts are empty and equal each other. A long
    text is hashed and compared whole, chunk by chunk. Other columns play no part, whatever
    their names. An empty table gives an empty one.
    """
    slim = docs.select(column(id_col).alias("id"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))
    slim = slim.withColumn("n_chars", F.length("text").cast("long"))
    marks = settle(signatures(slim, keep=["id", "n_chars"])
                   .withColumn("row", F.monotonically_increasing_id()), "marks")
    key = ["fp", "n_bytes"]
    best = F.min(F.struct((-F.col("n_chars")).alias("o"), F.col("id").isNull().alias("u"), "id", "row")).alias("best")
    groups = settle(marks.groupBy(*key).agg(F.count("*").alias("group_size"), best), "groups")
    odd = settle(_different(slim, groups.filter("group_size > 1"), key), "different")
    if odd.isEmpty():
        joined = marks.join(groups, key)
    else:
        # Texts found different under one fingerprint are told apart by their digest.
        parted = settle(marks.join(odd.select(*key, "text_sha256", F.lit(True).alias("odd")),
                                   [*key, "text_sha256"], "left")
                        .withColumn("part", F.when(F.col("odd"), F.col("text_sha256")).otherwise("")), "parted")
        again = settle(parted.groupBy(*key, "part").agg(F.count("*").alias("group_size"), best), "parts")
        joined = parted.join(again, [*key, "part"])
    return joined.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
                         (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "n_bytes")


def _different(slim: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """fp, n_bytes and text_sha256 of the texts that differ from the one that stays."""
    # Only texts whose fingerprint may be that of a group are shuffled: a filter of fixed size.
    cell = F.pmod(F.xxhash64(*key), F.lit(CELLS)).cast("int").alias("cell")
    cells = settle(groups.select(cell).distinct(), "cells")
    copies = settle(
        signatures(slim, keep=["id", "n_chars"], with_text=True).select("*", cell)
        .join(F.broadcast(cells), "cell", "left_semi").drop("cell").join(groups, key)
        .select(*key, "text_sha256", ((-F.col("n_chars") == F.col("best.o")) & F.col("id").eqNullSafe(F.col("best.id")))
                .alias("stays"), "plain"), "copies")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                whole = batch.column("plain")[i].as_buffer()
                n = max(1, -(-len(whole) // CHUNK))
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column(c)[i], n) for c in (*key, "text_sha256")]
                    + [pa.array(range(n), pa.int32()),
                       pa.array([whole[CHUNK * c: CHUNK * (c + 1)].to_pybytes() for c in range(n)], pa.binary())],
                    [*key, "text_sha256", "place", "bytes"])

    schema = "fp long, n_bytes long, text_sha256 string, place int, bytes binary"
    ours = copies.filter("not stays").drop("stays").mapInArrow(cut, schema)
    # Stored, so that the skew join can divide the copies of a large group.
    stay = settle(copies.filter("stays").drop("stays").mapInArrow(cut, schema).select(
        *key, "place", F.col("bytes").alias("stays"))
        .dropDuplicates([*key, "place"]), "stays")
    return (ours.join(stay, [*key, "place"]).filter("bytes != stays")
            .select(*key, "text_sha256").distinct())


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay; same columns. Ids must be unique and not null here."""
    kept = exact_groups(docs, id_col, text).filter("kept").select(id_col)
    return docs.join(kept, id_col, "left_semi").select(docs.columns)
