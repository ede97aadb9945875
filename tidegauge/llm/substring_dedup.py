"""Repeated passages by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``length`` words in a row. Of each window the half-length gram of least hash
is its anchor; equal windows have equal anchors at equal places, so two texts can share a
window only around an equal anchor. An anchor is kept with its context, all windows that
hold it. Contexts of one anchor that are equal word for word (by two independent 64-bit
hashes) form a class, which stands for all its occurrences: every later document repeats
it whole. Of each class the context in the least document is parsed.

The classes of one anchor are put in order of their documents and halved again and again;
each earlier half is a reference block, indexed by the sorted suffixes of its contexts,
and each context of the later half is factored against it. So a context meets every
smaller document in a logarithmic number of blocks. A factor is the longest match from a
place on; one of at least ``length`` words is extended to the left and is a duplicate
span. Windows that cross the end of a factor are checked from the last place at which
they could lie, so none is lost between two factors.

Anchors of more than ``MOST`` classes (a line common to very many documents) take the
exact way of comparing windows: each is hashed, as contexts are, and grouped, and no group
is collected.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import column, pieces, settle, utf8, with_text_columns
from tidegauge.llm.periodic_runs import mixed

#: Words of a window.
LENGTH = 50
#: Classes of an anchor that are parsed in one place; more are compared window by window.
MOST = 512
#: Odd bases of the two hashes of a stretch of words.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LAST_ID = (1 << 63) - 1
SPAN = "array<struct<start:int,stop:int>>"


class Stretches:
    """Hashes of stretches of a sequence of hashed words, in one base, modulo 2**64."""

    def __init__(self, words: np.ndarray, base: int):
        powers = np.full(len(words) + 1, base, np.uint64)
        inverse = np.full(len(words) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[0] = inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        sums = np.cumsum(words * np.multiply.accumulate(powers)[:-1], dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), sums))

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.inverse[starts])


def hashed_words(split: list[list[bytes]]) -> np.ndarray:
    """A 64-bit hash of every word of the texts, end to end."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    at = [number(w, len(numbers)) for words in split for w in words]
    known = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)
    return known[np.array(at, np.int64)] if at else np.zeros(0, np.uint64)


def anchors(split: list[list[bytes]], length: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The anchors of each text in order: how many, and anchor, context (hashes), start and
    left (the context's first word, and the anchor's place in it) and words of each."""
    counts = np.array([len(words) for words in split], np.int64)
    words, ends = hashed_words(split), np.cumsum(counts)
    gram = length // 2
    spread = length - gram + 1  # grams of a window
    starts = np.arange(max(0, len(words) - length + 1))
    last = np.repeat(ends, counts)
    inside = starts[starts + length <= last[: len(starts)]]
    names = ("anchor", "context", "start", "before", "words")
    if not len(inside):
        return np.zeros(len(split), np.int64), dict.fromkeys(names, np.zeros(0, np.int64))
    one, two = (Stretches(words, base) for base in BASES)
    places = np.arange(len(words) - gram + 1)
    grams = one.of(places, places + gram)
    least, width = places, 1
    while width * 2 <= spread:
        a, b = least[:-width], least[width:]
        least = np.where(grams[a] <= grams[b], a, b)
        width *= 2
    if spread > width:
        a, b = least[:width - spread], least[spread - width:]
        least = np.where(grams[a] <= grams[b], a, b)
    chosen = np.unique(least[inside])
    of = np.searchsorted(ends, chosen, "right")
    start = np.maximum(chosen - (length - gram), (ends - counts)[of])
    stop = np.minimum(chosen + length, ends[of])
    context = mixed(two.of(start, stop) + (chosen - start).astype(np.uint64) * np.uint64(1 << 32)
                    + (stop - start).astype(np.uint64))
    found = dict(zip(names, (grams[chosen], context, start - (ends - counts)[of], chosen - start, stop - start)))
    return np.bincount(of, minlength=len(split)), found


class Block:
    """Contexts of smaller documents, their suffixes sorted for each place beside the anchor."""

    def __init__(self, contexts: list[tuple[str, int]]):
        self.contexts = contexts
        self.sorted: dict[int, tuple[list[str], list[int]]] = {}

    def longest(self, target: str, place: int) -> tuple[int, int]:
        """Length of the longest match of the target among the suffixes that start at that
        place (counted from the anchor), and the context it is in."""
        if place not in self.sorted:
            some = sorted((text[before + place:], i) for i, (text, before) in enumerate(self.contexts)
                          if before + place >= 0)
            self.sorted[place] = [s for s, _ in some], [i for _, i in some]
        suffixes, of = self.sorted[place]
        at = bisect_left(suffixes, target)
        return max(((shared(target, suffixes[i]), of[i]) for i in (at - 1, at) if 0 <= i < len(suffixes)),
                   default=(0, -1))


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def parse(text: str, before: int, block: Block, length: int) -> list[tuple[int, int]]:
    """Spans of the text in factors of at least ``length`` words, from right to left.

    ``place`` is where the next window to check starts, counted from the anchor.
    """
    spans, place = [], 0
    while place >= -before:
        n, of = block.longest(text[before + place:], place)
        if n < length:
            # No window from here back to the new place fits before this factor's end.
            place += n - length
            continue
        other, left = block.contexts[of]
        back = shared(text[:before + place][::-1], other[:left + place][::-1])
        spans.append((before + place - back, before + place + n))
        place -= back + 1
    return spans


def factored(contexts: list[tuple[int, str, int]], length: int) -> list[list[tuple[int, int]]]:
    """For contexts (document, text, words before the anchor) of one anchor, in order of
    document: the spans of each that lie in one of a smaller document."""
    spans: list[list[tuple[int, int]]] = [[] for _ in contexts]

    def halve(low: int, high: int) -> None:
        cuts = [i for i in range(low + 1, high) if contexts[i][0] != contexts[i - 1][0]]
        if not cuts:
            return
        middle = min(cuts, key=lambda i: abs(2 * i - low - high))
        halve(low, middle)
        halve(middle, high)
        block = Block([c[1:] for c in contexts[low:middle]])
        for i in range(middle, high):
            if (0, len(contexts[i][1])) not in spans[i]:
                spans[i].extend(parse(contexts[i][1], contexts[i][2], block, length))

    halve(0, len(contexts))
    return [merged(s) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def coded(texts: list[str]) -> list[str]:
    """Each text of words as a string of one character per word, equal where the words are."""
    codes: dict[str, str] = {}
    out = []
    for text in texts:
        line = []
        for word in text.split(" "):
            code = codes.get(word)
            if code is None:
                n = len(codes)
                code = codes[word] = chr(n if n < 0xD800 else n + 0x800)
            line.append(code)
        out.append("".join(line))
    return out


def _parsed(rows: DataFrame, length: int) -> DataFrame:
    """anchor, context and spans of the classes that repeat part of a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in
                                                          ("anchor", "context", "id", "before", "text")]))
        out: list[tuple[int, int, list]] = []
        for anchor, group in groupby(flat, key=lambda row: row[0]):
            group = list(group)
            texts = coded([row[4] for row in group])
            spans = factored([(row[2], text, row[3]) for row, text in zip(group, texts)], length)
            out.extend((anchor, row[1], found) for row, found in zip(group, spans) if found)
            if len(out) >= 4096:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(out: list) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
             pa.array([[{"start": a, "stop": b} for a, b in r[2]] for r in out], kind)], ["anchor", "context", "spans"])

    return (rows.repartition("anchor").sortWithinPartitions("anchor", "id")
            .mapInArrow(run, f"anchor long, context long, spans {SPAN}"))


def _compared(rows: DataFrame, length: int) -> DataFrame:
    """As ``_parsed``, window by window: for anchors of any number of classes."""
    schema = "anchor long, context long, id long, start int, one long, two long"
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, at = utf8(piece.column("text"))
                raw = data.tobytes()
                split = [raw[x:y].split() for x, y in zip(at.tolist(), at[1:].tolist())]
                words, counts = hashed_words(split), np.array([len(s) for s in split], np.int64)
                n = np.maximum(counts - length + 1, 0)
                start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place = start + np.repeat(np.cumsum(counts) - counts, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(piece.column(c).to_numpy(), n)) for c in names[:3]]
                    + [pa.array(start.astype(np.int32))]
                    + [pa.array(Stretches(words, base).of(place, place + length).view(np.int64)) for base in BASES], names)

    windows, window = settle(rows.mapInArrow(cut, schema), "windows"), ["anchor", "one", "two"]
    first = windows.groupBy(*window).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    again = windows.join(settle(first.filter("least < most"), "repeated"), window).filter("id > least")
    return again.groupBy("anchor", "context").agg(F.collect_list(F.struct(
        "start", (F.col("start") + length).alias("stop"))).alias("spans"))


def _cut_contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """anchor, context, id, before and text of the wanted contexts (id, mark, anchor,
    context, start, before, words): their words joined by one space."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct(
        "anchor", "context", "start", "before", "words")).alias("wanted"))
    rows = docs.dropDuplicates(["id", "mark"]).join(lists, ["id", "mark"]).select("id", "text", "wanted")
    schema = "anchor long, context long, id long, before int, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, at = utf8(piece.column("text"))
                raw, out = data.tobytes(), []
                for i, (of, some) in enumerate(zip(piece.column("id").to_pylist(), piece.column("wanted").to_pylist())):
                    words = raw[at[i]: at[i + 1]].split()
                    out.extend((w["anchor"], w["context"], of, w["before"],
                                b" ".join(words[w["start"]: w["start"] + w["words"]]).decode()) for w in some)
                yield pa.RecordBatch.from_pylist([dict(zip(("anchor", "context", "id", "before", "text"), r)) for r in out],
                                                 pa.schema([("anchor", pa.int64()), ("context", pa.int64()),
                                                            ("id", pa.int64()), ("before", pa.int32()),
                                                            ("text", pa.string())]))

    return rows.mapInArrow(run, schema)


def _marked(docs: DataFrame, id_col: str, text: str, *more: Column) -> DataFrame:
    """id (null: the largest), text and mark, which tells the texts of one id apart."""
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(column(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), body.alias("text"),
                       F.xxhash64(body).alias("mark"), *more)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   most: int = MOST) -> DataFrame:
    """id, mark (hash of the text) and spans: the word places in windows of ``length`` words
    that also occur in a document of smaller id; only texts that have any.

    A span may be given in overlapping parts. Ids are integers; a null id counts as the
    largest, and rows of one id are no copies of each other.
    """
    slim = _marked(docs, id_col, text)
    kind = "array<struct<anchor:bigint,context:bigint,start:int,before:int,words:int>>"

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            raw, at = data.tobytes(), at.tolist()
            counts, found = anchors([raw[x:y].split() for x, y in zip(at, at[1:])], length)
            items = pa.StructArray.from_arrays(
                [pa.array(found["anchor"].view(np.int64)), pa.array(found["context"].view(np.int64)),
                 *[pa.array(found[c].astype(np.int32)) for c in ("start", "before", "words")]], list(found))
            return [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), items)]
        return compute

    places = settle(with_text_columns(slim, "text", f"places {kind}", make, ["id", "mark"])
                    .select("id", "mark", F.explode("places").alias("p")).select("id", "mark", "p.*"), "anchors")
    common = settle(places.groupBy("anchor").agg(F.min("id").alias("least"), F.max("id").alias("most"))
                    .filter("least < most").select("anchor"), "common")
    places = settle(places.join(common, "anchor", "left_semi"), "shared")
    classes = settle(places.groupBy("anchor", "context").agg(
        F.min(F.struct("id", "mark", "start", "before", "words")).alias("first"), F.max("id").alias("last")), "classes")
    several = settle(classes.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "several")
    wanted = settle(classes.join(several, "anchor").select("anchor", "context", "n", "first.*"), "wanted")
    texts = settle(_cut_contexts(slim, wanted).join(several, "anchor"), "contexts")
    found = settle(_parsed(texts.filter(F.col("n") <= most), length).unionByName(
        _compared(texts.filter(F.col("n") > most), length)), "factors")
    ruling = settle(classes.join(found, ["anchor", "context"], "left")
                    .filter("last > first.id or spans is not null")
                    .select("anchor", "context", F.col("first.id").alias("least"), "spans"), "ruling")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("words").alias("stop")))
    hits = places.join(ruling, ["anchor", "context"]).select(
        "id", "mark", "start", F.when(F.col("id") > F.col("least"), whole).otherwise(F.col("spans")).alias("spans"))
    return (hits.filter("spans is not null")
            .withColumn("spans", F.transform("spans", lambda s: F.struct(
                (F.col("start") + s["start"]).alias("start"), (F.col("start") + s["stop"]).alias("stop"))))
            .groupBy("id", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                    most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """The kept columns, n_words, removed (disjoint spans of word places, in order) and
    kept_text, the words outside of them joined by one space, for every row.

    Words are runs of anything but the six ASCII blanks; texts are parsed whole, whatever
    their length. A null text is empty. Rows of one id (null: the largest) are no copies
    of each other, and equal rows get equal results. A kept column named as a computed
    one is replaced by it. An empty table gives an empty one.
    """
    names = docs.columns if keep is None else keep
    ours = ["n_words", "removed", "kept_text"]
    spans = settle(repeated_spans(docs, id_col, text, length, most), "spans")
    row = F.struct(F.lit(0).alias("none"), *[column(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    rows = _marked(docs, id_col, text, row).join(spans, ["id", "mark"], "left").select("row", "text", "spans")
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string(
        "n_words bigint, removed array<struct<start:int,stop:int>>, kept_text string").fields])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, at = utf8(piece.column("text"))
                raw, counts, gone, kept = data.tobytes(), [], [], []
                for i, some in enumerate(piece.column("spans").to_pylist()):
                    words = raw[at[i]: at[i + 1]].split()
                    counts.append(len(words))
                    gone.append(merged([(s["start"], s["stop"]) for s in some or ()]))
                    ends = [0, *[stop for _, stop in gone[-1]]]
                    starts = [*[start for start, _ in gone[-1]], len(words)]
                    kept.append(b" ".join([w for a, b in zip(ends, starts) for w in words[a:b]]))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(counts, pa.int64()),
                     pa.array([[{"start": a, "stop": b} for a, b in g] for g in gone], kind),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema.names)

    found = rows.mapInArrow(run, schema)
    return found.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(names) if c not in ours], *ours)


def n_removed() -> Column:
    """Words in the removed spans."""
    return F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
