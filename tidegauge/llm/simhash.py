"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Fingerprints of at most ``distance`` differing bits are linked. Equal fingerprints are
one entry of the index. Any two linked fingerprints agree on at least one of
``distance + 1`` bands of bits, so each entry is dealt to the bucket of each of its
bands. Inside a bucket the entries are in order of their Gray rank and cut into blocks;
a block is a node that holds the bits all its members share (mask, pattern). Pairs of
blocks of a bucket, a block with itself included, are searched from the top: a child
node holds only the shared bits that its parent lacks, the differences on them add up,
and a pair of nodes goes with all its members once they exceed the distance. Buckets of
any size are spread over many blocks and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import column, settle, utf8, with_text_columns
from tidegauge.llm.components import connected

#: Shingles whose bits are counted at a time.
COUNTED = 1 << 15
#: Entries of a block, and children of a node within it.
BLOCK, FANOUT = 2048, 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text; a bit is 1 if set in over half the hashes."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII white-space characters
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    a, b = starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(a), COUNTED):
        hashes = np.array([digest(line[x:y], seed) for x, y in zip(a[at: at + COUNTED], b[at: at + COUNTED])],
                          dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(a)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3,
                 keep: list[str] | None = None) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long; null text: 0."""

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            raw, at = data.tobytes(), at.tolist()
            found = [fingerprint(raw[x:y], shingle) for x, y in zip(at, at[1:])]
            return [pa.array(np.array(found, dtype=np.uint64).view(np.int64))]
        return compute

    return with_text_columns(docs, text, "fp long", make, keep)


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each unsigned 64-bit pattern in the reflected Gray order."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared(members: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits that each run of members shares, and their values."""
    ones = np.bitwise_and.reduceat(members, starts)
    mask = ones | ~np.bitwise_or.reduceat(members, starts)
    return mask, ones & mask


class Index:
    """Nodes over entries in Gray order: levels from the top, each a (mask, pattern, start).

    The mask of a node below the top holds only bits that its parent's does not.
    """

    def __init__(self, members: np.ndarray):
        self.members = members
        starts, levels = np.arange(len(members)), []
        while True:
            mask, pattern = shared(members, starts)
            levels.append((mask, pattern, starts))
            if len(starts) == 1:
                break
            starts = starts[::FANOUT]
        self.levels = []
        above = np.zeros(1, np.uint64)
        for mask, pattern, starts in reversed(levels):
            parent = np.arange(len(starts)) // FANOUT if self.levels else np.zeros(1, np.int64)
            own = mask & ~above[parent]
            self.levels.append((mask, own, pattern, starts))
            above = mask


def search(a: Index, b: Index, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of entries of a and of b with at most that many differing bits.

    Node pairs descend together; where one tree is lower, its lowest nodes stay.
    """
    depth = max(len(a.levels), len(b.levels))
    x, y = np.zeros(1, np.int64), np.zeros(1, np.int64)
    known = np.zeros(1, np.uint64)  # bits already counted for the pair
    far = np.zeros(1, np.int64)
    for level in range(depth):
        sides = []
        for tree, at in ((a, x), (b, y)):
            i = min(level, len(tree.levels) - 1)
            mask, own, pattern, _ = tree.levels[i]
            sides.append((mask[at], pattern[at], own[at]))
        both = sides[0][0] & sides[1][0] & ~known
        far = far + np.bitwise_count((sides[0][1] ^ sides[1][1]) & both).astype(np.int64)
        near = far <= distance
        x, y, far, known = x[near], y[near], far[near], (known | both)[near]
        if level + 1 == depth or not len(x):
            break
        for tree, which in ((a, 0), (b, 1)):
            if level + 1 < len(tree.levels):
                below = len(tree.levels[level + 1][3])
                at = (x, y)[which]
                n = np.minimum((at + 1) * FANOUT, below) - at * FANOUT
                again = np.repeat(np.arange(len(at)), n)
                child = at[again] * FANOUT + np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
                x, y, far, known = x[again], y[again], far[again], known[again]
                if which:
                    y = child
                else:
                    x = child
    return x, y


def forest(pairs_a: np.ndarray, pairs_b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect the same values as the pairs do, at most one per value."""
    top: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := top.setdefault(v, v)) != v:
            top[v] = top[up]
            v = top[v]
        return v

    for p, q in zip(pairs_a.tolist(), pairs_b.tolist()):
        p, q = find(p), find(q)
        if p != q:
            top[max(p, q)] = min(p, q)
    for v in list(top):
        if (root := find(v)) != v:
            yield v, root


def bucket_blocks(entries: DataFrame, distance: int) -> DataFrame:
    """band, key, block, mask, pattern, members: runs of a bucket in Gray order."""
    bands = distance + 1
    width = [64 // bands + (i < 64 % bands) for i in range(bands)]
    shifts = [sum(width[i + 1:]) for i in range(bands)]
    rank = F.col("fp")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    dealt = entries.withColumn("rank", rank).select(
        "fp", "rank", F.explode(F.array(*[F.struct(
            F.lit(i).alias("band"),
            F.shiftrightunsigned("fp", shifts[i]).bitwiseAND(F.lit((1 << width[i]) - 1 if width[i] < 64 else -1))
            .alias("key")) for i in range(bands)])).alias("b")).select("b.*", "fp", "rank")
    schema = "band int, key long, block long, mask long, pattern long, members array<long>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            band, key, fp = (batch.column(c).to_numpy() for c in ("band", "key", "fp"))
            new = np.flatnonzero(np.concatenate(([True], (band[1:] != band[:-1]) | (key[1:] != key[:-1]))))
            run = np.repeat(new, np.diff(np.append(new, len(fp))))
            place = np.arange(len(fp)) - run
            starts = np.flatnonzero(place % BLOCK == 0)
            members = fp.view(np.uint64)
            mask, pattern = shared(members, starts)
            offsets = pa.array(np.append(starts, len(fp)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(band[starts]), pa.array(key[starts]), pa.array(fp[starts]),
                 pa.array(mask.view(np.int64)), pa.array(pattern.view(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(fp))],
                ["band", "key", "block", "mask", "pattern", "members"])

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartitionByRange(parts, "band", "key", F.shiftrightunsigned("rank", 1), "rank")
            .sortWithinPartitions("band", "key", F.shiftrightunsigned("rank", 1), "rank").mapInArrow(cut, schema))


def near_links(entries: DataFrame, distance: int) -> DataFrame:
    """a, b: links between values of ``fp`` (distinct longs) that connect exactly those
    reachable by steps of at most ``distance`` differing bits; not every such pair."""
    blocks = settle(bucket_blocks(entries, distance), "blocks")
    ours = blocks.select("band", "key", *[F.col(c).alias(f"{c}_a") for c in ("block", "mask", "pattern", "members")])
    theirs = blocks.select("band", "key", *[F.col(c).alias(f"{c}_b") for c in ("block", "mask", "pattern", "members")])
    both = F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(F.col("mask_a")).bitwiseAND(F.col("mask_b"))
    # Blocks are named after their first entry, so a bucket's blocks have different names.
    own = blocks.filter(F.size("members") > 1).select(F.col("members").alias("members_a"),
                                                       F.lit(None).cast("array<long>").alias("members_b"))
    pairs = (ours.join(theirs, ["band", "key"])
             .filter((F.col("block_a") < F.col("block_b")) & (F.bit_count(both) <= distance))
             .select("members_a", "members_b"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            one, two = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                a = Index(one[i].values.to_numpy().view(np.uint64))
                b = Index(two[i].values.to_numpy().view(np.uint64)) if two[i].is_valid else a
                x, y = search(a, b, distance)
                p, q = a.members[x].view(np.int64), b.members[y].view(np.int64)
                if b is a:
                    p, q = p[x < y], q[x < y]
                for v, root in forest(p, q):
                    found_a.append(v)
                    found_b.append(root)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Within blocks: small ones all at once, entry against the entries after it."""
        for batch in batches:
            lists = batch.column(0)
            sizes = lists.value_lengths().to_numpy()
            small = sizes <= 2 * FANOUT
            found_a, found_b = [], []
            if small.any():
                few = lists.filter(pa.array(small))
                fp = few.flatten().to_numpy().view(np.uint64)
                of = np.repeat(np.arange(len(few)), sizes[small])
                for lag in range(1, int(sizes[small].max())):
                    near = np.flatnonzero((of[lag:] == of[:-lag])
                                          & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= distance))
                    found_a.append(fp[near].view(np.int64))
                    found_b.append(fp[near + lag].view(np.int64))
            for i in np.flatnonzero(~small).tolist():
                a = Index(lists[i].values.to_numpy().view(np.uint64))
                x, y = search(a, a, distance)
                found_a.append(a.members[x[x < y]].view(np.int64))
                found_b.append(a.members[y[x < y]].view(np.int64))
                kept = list(forest(found_a.pop(), found_b.pop()))
                found_a.append(np.array([v for v, _ in kept], np.int64))
                found_b.append(np.array([r for _, r in kept], np.int64))
            none = [np.zeros(0, np.int64)]
            kept = list(forest(np.concatenate(found_a or none), np.concatenate(found_b or none)))
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in kept], pa.int64()),
                                              pa.array([r for _, r in kept], pa.int64())], ["a", "b"])

    within = own.select("members_a").mapInArrow(scan, "a long, b long")
    across = pairs.mapInArrow(link, "a long, b long")
    return within.union(across)


def _grouped(docs: DataFrame, id_col: str, text: str, shingle: int, distance: int, more: list[str]) -> DataFrame:
    """id, fp, component_id, root (a fingerprint that names the component) and more columns."""
    marks = settle(fingerprints(docs, text, shingle, [id_col, *more])
                   .select(column(id_col).alias("id"), "fp", *[column(c) for c in more]), "marks")
    entries = settle(marks.groupBy("fp").agg(F.min("id").alias("least")), "entries")
    roots = connected(near_links(entries.select("fp"), distance))
    linked = roots.join(entries, roots["node"] == entries["fp"]).select("fp", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(linked.join(least, "root").select("fp", "root", "component_id"), "named")
    labels = settle(entries.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")), "labels")
    return marks.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "root", *more)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                   distance: int = 3) -> DataFrame:
    """id, fp, component_id (the least id reachable over links) for every row.

    Texts of any length are read whole. Null and empty texts have fingerprint 0 and are
    linked like any other. Rows of a repeated id are rows of their own. Null ids count as
    the largest; a component of null ids only has a null component_id. An empty table gives
    an empty one. Other columns play no part, whatever their names.
    """
    return _grouped(docs, id_col, text, shingle, distance, []).drop("root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                         distance: int = 3) -> DataFrame:
    """One row of each component; same columns.

    It is the row of least id (null ids last); of rows of that id the one of least
    fingerprint, then of least hash over all columns, so the choice does not depend on
    how the rows are dealt out. Of rows equal in every column any one stays. Components
    that share an id keep a row each. An empty table gives an empty one.
    """
    hashable = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    marked = docs.withColumn("__mark", F.xxhash64(*[column(c) for c in hashable]))
    groups = settle(_grouped(marked, id_col, text, shingle, distance, ["__mark"])
                    .withColumnRenamed(id_col, "__id"), "groups")
    stays = settle(groups.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "fp", "__mark"))
                                              .alias("x")).select("x.__id", F.col("x.__mark").alias("__of")), "stays")
    kept = marked.join(stays, column(id_col).eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__of")), "left_semi")
    twice = groups.groupBy("__id", "__mark").count().filter("count > 1")
    if not twice.isEmpty():
        kept = kept.dropDuplicates([id_col, "__mark"])
    return kept.select(*[column(c) for c in docs.columns])
