"""Benchmark decontamination by winnowing.

A word span of ``window`` words that a text shares with a benchmark item holds
``window - kgram + 1`` k-grams; both sides keep the least k-gram hash of every run of
that many k-grams (the last of equal ones), so each such span is met by at least one
fingerprint kept on both sides. Every meeting of fingerprints is extended to both sides,
word by word, and counts if the common run is a whole window. Items of fewer words are
one window; their texts are met by hashes of all spans of that length.

The benchmark is read in blocks of items of at most ``block_bytes`` of text (a single
longer item is a block of its own); each block is sent to all executors, and documents
are scanned once per block without a shuffle. Benchmarks do not grow with the corpus.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import WHOLE, column, settle, utf8, with_text_columns

#: Byte classes: 0-9, a-z and all bytes of other characters make words; A-Z are lowered.
FOLD = np.zeros(256, np.uint8)
FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)

#: Odd multipliers of the word and k-gram hashes.
BASE, STEP, MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
HASHED_BYTES = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(MIX)
    h ^= h >> np.uint64(32)
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(29)
    return h


@functools.lru_cache(maxsize=2)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


@dataclass
class Words:
    """Words of several texts: places in the folded bytes, hashes, and each text's share."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # len(texts) + 1 places of words

    def bytes_of(self, a: int, b: int) -> list[bytes]:
        return [self.folded[x:y].tobytes() for x, y in zip(self.starts[a:b], self.ends[a:b])]


def words_of(data: np.ndarray, at: np.ndarray) -> Words:
    folded = FOLD[data]
    inside = np.zeros(len(folded) + 2, bool)
    inside[1:-1] = folded != 0
    before, after = inside[:-2].copy(), inside[2:].copy()
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(folded))]
    before[cuts] = False
    after[cuts - 1] = False
    own = inside[1:-1]
    starts, ends = np.flatnonzero(own & ~before), np.flatnonzero(own & ~after) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED_BYTES, "right")))
        base, stop = int(starts[i]), int(ends[j - 1])
        up, down = powers(max(HASHED_BYTES, 1 << (stop - base - 1).bit_length()))
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(folded[base:stop] * up[: stop - base], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        hashes[i:j] = mixed((sums[b] - sums[a]) * down[a])
        i = j
    return Words(folded, starts, ends, hashes, np.searchsorted(starts, at))


def kgrams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each place, and whether they lie in one text."""
    n = len(words.hashes)
    if n < k:
        return np.zeros(n, np.uint64), np.zeros(n, bool)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h = h * np.uint64(STEP) + words.hashes[j: n - k + 1 + j]
    full = np.zeros(n, np.uint64)
    full[: n - k + 1] = mixed(h)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)
    return full, left >= k


def winnowed(words: Words, k: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes kept: the last least hash of every ``run`` k-grams of a text."""
    h, _ = kgrams(words, k)
    n = len(h)
    if n < k + run - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = n - run + 1
    least, place = h[:size].copy(), np.zeros(size, np.int64)
    for j in range(1, run):
        other = h[j: size + j]
        better = other <= least
        least[better] = other[better]
        place[better] = j
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)
    whole = np.flatnonzero(left[:size] >= k + run - 1)
    kept = np.zeros(n, bool)
    kept[whole + place[whole]] = True
    kept = np.flatnonzero(kept)
    return kept, h[kept]


@dataclass
class Block:
    """Fingerprints of some benchmark items: sorted hashes with their item and place."""

    ids: list[str | None]
    words: list[list[bytes]]
    hashes: list[np.ndarray]
    #: k-gram size to (sorted hashes, items, places); the window's own and the short items'.
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    window: int = 13
    kgram: int = 5


def build_block(rows: list[tuple[str | None, str]], window: int, kgram: int) -> Block:
    found = words_of(*utf8(pa.array([text for _, text in rows], pa.large_string())))
    block = Block([i for i, _ in rows], [], [], window=window, kgram=kgram)
    of = np.repeat(np.arange(len(rows)), np.diff(found.first))
    entries = defaultdict(lambda: ([], [], []))

    def add(k, hashes, items, places):
        for out, new in zip(entries[k], (hashes, items, places)):
            out.append(new)

    place, h = winnowed(found, kgram, window - kgram + 1)
    # Key 0: kept by winnowing. Other keys: whole items of that many words.
    add(0, h, of[place], place - found.first[of[place]])
    for i in range(len(rows)):
        a, b = int(found.first[i]), int(found.first[i + 1])
        block.words.append(found.bytes_of(a, b))
        block.hashes.append(found.hashes[a:b])
        if 0 < b - a < window:
            add(b - a, kgrams(found, b - a)[0][a:a + 1], np.array([i]), np.array([0]))
    for k, lists in entries.items():
        hashes, items, places = map(np.concatenate, lists)
        order = np.argsort(hashes, kind="stable")
        block.tables[k] = hashes[order], items[order], places[order]
        bits = np.zeros(1 << 20, bool)
        bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
        block.filters[k] = bits
    return block


def common_run(a, b, i: int, j: int) -> tuple[int, int]:
    """How far two word sequences agree before and from places i and j."""
    back = 0
    while i - back > 0 and j - back > 0 and a[i - back - 1] == b[j - back - 1]:
        back += 1
    on = 0
    while i + on < len(a) and j + on < len(b) and a[i + on] == b[j + on]:
        on += 1
    return back, on


def equal_runs(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word where the run of equal words around it starts and stops; runs lie within
    the texts that start at ``first``."""
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[first[first < len(hashes)]] = True
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(hashes)))
    return np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)


def hits_of(words: Words, block: Block) -> list[tuple[list[tuple[int, int]], set[int]]]:
    """Of each text: the merged spans of words inside windows of items, and the items."""
    count = len(words.first) - 1
    spans: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    items: list[set[int]] = [set() for _ in range(count)]
    run_starts, run_stops = equal_runs(words.hashes, words.first)
    zero = np.zeros(1, np.int64)
    item_runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k, (keys, key_items, key_places) in block.tables.items():
        if not len(keys):
            continue
        if k:
            h, good = kgrams(words, k)
            place = np.flatnonzero(good & block.filters[k][(h >> np.uint64(44)).astype(np.int64)])
            h = h[place]
        else:
            place, h = winnowed(words, block.kgram, block.window - block.kgram + 1)
            near = block.filters[0][(h >> np.uint64(44)).astype(np.int64)]
            place, h = place[near], h[near]
        low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        met = np.flatnonzero(high > low)
        of = np.searchsorted(words.first, place[met], "right") - 1
        done: dict[tuple[int, int, int], int] = {}
        size = k or block.kgram

        def extend(doc: int, first: int, last: int, item: int, i: int, j: int) -> None:
            """Note the match through place i of the text and place j of the item."""
            if done.get((doc, item, i - j), -1) > i:
                return
            theirs = block.words[item]
            least = min(block.window, len(theirs))
            back, on = common_run(words.hashes[first:last], block.hashes[item], i, j)
            if back + on >= least:  # equal hashes; now the words themselves
                ours = words.bytes_of(first + i - back, first + i + on)
                if ours != theirs[j - back: j + on]:
                    far, on = common_run(ours, theirs[j - back: j + on], back, back)
                    back = min(back, far)
            done[doc, item, i - j] = i + on
            if back + on >= least:
                spans[doc].append((i - back, i + on))
                items[doc].add(item)

        run_done: set[int] = set()
        for m, doc in zip(met.tolist(), of.tolist()):
            first, last = int(words.first[doc]), int(words.first[doc + 1])
            at = int(place[m])
            start, stop = int(run_starts[at]), int(run_stops[at])
            if start in run_done:
                continue
            same: set[bytes] = set()
            if stop - at >= size > 1 and stop - start > size:
                same = set(words.bytes_of(start, stop))
            repeated = len(same) == 1
            if repeated:
                run_done.add(start)
            seen: set[tuple[int, int]] = set()
            for e in range(int(low[m]), int(high[m])):
                item, j = int(key_items[e]), int(key_places[e])
                if not repeated:
                    extend(doc, first, last, item, at - first, j)
                    continue
                # One word again and again: runs of it match where their starts or their stops
                # lie together, and within each other as far as the shorter one goes.
                if item not in item_runs:
                    item_runs[item] = equal_runs(block.hashes[item], zero)
                a, b = int(item_runs[item][0][j]), int(item_runs[item][1][j])
                if (item, a) in seen:
                    continue
                seen.add((item, a))
                if set(block.words[item][a:b]) != same:  # equal hashes of other words
                    continue
                extend(doc, first, last, item, start - first, a)
                extend(doc, first, last, item, stop - 1 - first, b - 1)
                if min(stop - start, b - a) >= min(block.window, len(block.words[item])):
                    spans[doc].append((start - first, stop - first))
                    items[doc].add(item)
    return [(merged(s), t) for s, t in zip(spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def names_of(block: Block, items: set[int]) -> list[str | None]:
    """The items' ids, sorted, each once; null last."""
    return sorted({block.ids[i] for i in items}, key=lambda name: (name is None, name or ""))


SPANS = "n_words bigint, spans array<struct<first:int,stop:int>>, items array<string>"


def _scan(docs: DataFrame, text: str, block, keep: list[str] | str | None) -> DataFrame:
    span = pa.struct([("first", pa.int32()), ("stop", pa.int32())])

    def make():
        known = block.value

        def compute(texts: pa.Array) -> list[pa.Array]:
            words = words_of(*utf8(texts))
            hits = hits_of(words, known)
            return [pa.array(np.diff(words.first)),
                    pa.array([[{"first": a, "stop": b} for a, b in s] for s, _ in hits], pa.list_(span)),
                    pa.array([names_of(known, t) for _, t in hits], pa.list_(pa.string()))]
        return compute

    return with_text_columns(docs, text, SPANS, make, keep)


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_bytes: int):
    """Items in blocks of at most that many bytes, one block in the driver at a time."""
    rows, size = [], 0
    items = benchmark.select(column(item_id).cast("string"), column(item_text).cast("string"))
    for name, text in items.filter(items[1].isNotNull()).toLocalIterator():
        n = len(text.encode())
        if rows and size + n > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((name, text))
        size += n
    yield rows


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 13, kgram: int = 5,
                       block_bytes: int = 8 << 20, keep: list[str] | str | None = None) -> DataFrame:
    """The kept columns of every row, then n_words, spans and items.

    spans: word places [first, stop) inside occurrences of item windows, merged and in
    order; items: ids (as strings, sorted, each once) of the items with such occurrences.
    Null and empty texts have no words; items without a text or a word are no items; rows
    of a repeated item id are one item of several texts, and so are those without an id,
    which is listed last, as a null. A column of the
    input named like a result is replaced.
    """
    if not 1 <= kgram <= window:
        raise ValueError("kgram must be between 1 and window")
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    first, rows = next(blocks), next(blocks, None)
    sent = context.broadcast(build_block(first, window, kgram))
    if rows is None:
        return _scan(docs, text, sent, keep)
    if keep == WHOLE:
        docs = docs.select(F.struct("*").alias(WHOLE), column(text).alias("__text"))
        text, keep = "__text", [WHOLE]
    names = docs.columns if keep is None else keep
    # Hits of the further blocks, by text: rows of equal texts have equal hits.
    keyed = docs.withColumn("__key", F.sha2(F.coalesce(column(text).cast("string"), F.lit("")), 256))
    out, more = _scan(keyed, text, sent, [*names, "__key"]), None
    while rows is not None:
        sent = context.broadcast(build_block(rows, window, kgram))
        hits = settle(_scan(keyed, text, sent, ["__key"]).filter(F.size("items") > 0)
                      .groupBy("__key").agg(F.first("spans").alias("s"), F.first("items").alias("i")), "hits")
        more, rows = hits if more is None else more.union(hits), next(blocks, None)
    more = more.groupBy("__key").agg(F.flatten(F.collect_list("s")).alias("__s"),
                                     F.flatten(F.collect_list("i")).alias("__i"))
    return out.join(more, "__key", "left").select(
        *[column(c) for c in names if c not in ("n_words", "spans", "items")], "n_words",
        F.when(F.col("__s").isNull(), F.col("spans")).otherwise(_merge(F.concat("spans", "__s"))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("__i", F.array().cast("array<string>")))))
        .alias("items"))


def _merge(spans: Column) -> Column:
    """Overlapping and touching spans as one, in order."""
    def step(done: Column, s: Column) -> Column:
        return F.when((F.size(done) > 0) & (s["first"] <= F.try_element_at(done, F.lit(-1))["stop"]), F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
            F.array(F.struct(F.try_element_at(done, F.lit(-1))["first"].alias("first"),
                             F.greatest(F.try_element_at(done, F.lit(-1))["stop"], s["stop"]).alias("stop"))))
        ).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.slice(spans, 1, 0), step)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, text: str = "text",
                      **options) -> DataFrame:
    """The rows of which less than one in ``share`` words is hit; same columns.

    A row without hits stays, so an empty text always does.
    """
    found = contaminated_spans(docs, benchmark, text, keep=WHOLE, **options)
    hit = hit_words()
    return found.filter(~((hit > 0) & (share * hit >= F.col("n_words")))).select(f"{WHOLE}.*")


def hit_words() -> Column:
    """Words of the row's spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
