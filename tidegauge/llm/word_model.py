"""Perplexity per word under an interpolated modified Kneser-Ney model of word n-grams.

Words are runs of letters, marks and digits (digits as 0), lowered; other characters that
are no white space, and characters of scripts written without blanks, are words of their
own. A word is a 63-bit hash of all its code points; where words are counted, the lowest bit
is the number of the model: trusted texts are dealt to two models by a hash of the text, and every text is
scored by the model that its own half did not train. All grams are counted; no table is
bounded in rows, and none but that of the hottest words is sent to the executors.

Texts are split twice, to find the hottest words and to be stored as codes, which the passes read.
Places (a, b, c) are taken in up to ``RANGES`` passes by their middle word, so that only a part
of them is on disk at a time: all counts that a place needs, but that of c alone, are
of places with the same b. Within a pass places go to a bucket of (a, b), which has the counts
of abc and ab, then to one of (b, c) or b, which has those of bc and b, and, if c is none
of the hottest words, to one of c; what a text's places sum up to goes back to its chunk, a run
of texts that one task read. A row holds all places that go from one chunk or bucket to another.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import cleaned, column, drop, pieces, settle
from tidegauge.llm.decontaminate import STEP, mixed, powers

ORDER = 3
W = [f"w{i}" for i in range(ORDER)]
#: The word before a text.
START = 0x5851F42D4C957F2C
#: Words of at least this share of all, at most ``NEAR`` of them, are sent to all tasks and written in 16 bits.
HOT, NEAR = 2.0 ** -20, (1 << 16) - 1
#: Words and texts of a chunk, and places of a bucket, at about.
HELD, TEXTS, BUCKET = 1 << 21, 1 << 16, 1 << 19
#: Passes over the coded texts and, to count, over the trusted ones; fewer where a pass has less than ``PASS`` words.
RANGES, COUNTED, PASS = 15, 3, 1 << 21
#: Parts in which the texts are coded.
PARTS = 2
#: Letters that are hashed together, and words that are looked at together: arrays that stay in the processor's cache.
HASHED, STEP_WORDS = 1 << 15, 1 << 17
#: Rows: words counted; places asked of each of the two models; texts of a chunk; sums of a chunk's texts; and, from
#: there on, places by half, plus 2 if they are counted, plus 4 if they are asked for.
SEEN, ASKED, OWN, SUMS, PLACES = 0, 1, 3, 4, 8
#: bucket (or chunk), kind; chunks of the places and how many are of each, texts in the chunk, words, how often; known
#: and share: of those places that longer grams know, the probability by them and what they leave to shorter ones.
ROWS = "bucket long, kind int, chunks binary, runs binary, place binary, near binary, far binary, n binary, known binary, share binary"
TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}


def arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, TYPES[kind]) for name, kind in map(str.split, schema.split(", "))])


PACKED = arrow(ROWS)
#: Scripts without blanks: Thai and Lao, Myanmar, Khmer, Han and kana.
UNSPACED = ((0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0xA4D0), (0xF900, 0xFB00), (0x20000, 0x40000))
BLANK, PART, DIGIT, ALONE = range(4)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    def kind(c: str) -> int:
        category = unicodedata.category(c)
        if c.isspace():
            return BLANK
        return DIGIT if category == "Nd" else PART if category[0] in "LMN" else ALONE

    found = np.array([kind(chr(cp)) for cp in range(0x110000)], np.uint8)
    for a, b in UNSPACED:
        found[a:b][found[a:b] == PART] = ALONE
    return found


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each text has."""
    lines = [(t or "").lower() for t in texts.to_pylist()]
    ends_of = np.cumsum(np.array(list(map(len, lines)), np.int64))
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[points]
    n = len(points)
    digits = np.flatnonzero(kind == DIGIT)
    if len(digits):
        points = points.copy()
        points[digits] = 0x30
    # A place begins a word unless it goes on one of the same text.
    apart = (kind == BLANK) | (kind == ALONE)
    first = np.ones(n, bool)
    np.logical_or(apart[1:], apart[:-1], out=first[1:])
    cuts = ends_of[:-1]
    first[cuts[cuts < n]] = True
    last = np.ones(n, bool)
    last[:-1] = first[1:]
    starts, ends = np.flatnonzero(first & (kind != BLANK)), np.flatnonzero(last & (kind != BLANK)) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED, "right")))
        base, stop = int(starts[i]), int(ends[j - 1])
        up, down = powers(max(HASHED, 1 << (stop - base - 1).bit_length()))
        sums = np.zeros(stop - base + 1, np.uint64)
        sums[1:] = points[base:stop]
        sums[1:] += np.uint64(1)
        sums[1:] *= up[: stop - base]
        np.cumsum(sums, out=sums)
        a, b = starts[i:j] - base, ends[i:j] - base
        hashes[i:j] = mixed((sums[b] - sums[a]) * down[a])
        i = j
    return hashes, np.diff(np.searchsorted(starts, np.concatenate(([0], ends_of))))


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, START before each text; where the texts' words begin; and each text's words, START too."""
    hashes, n = words(texts)
    sizes = n + ORDER - 1
    a_word = np.ones(len(hashes) + len(n) * (ORDER - 1), bool)
    first = np.cumsum(sizes) - n
    for i in range(1, ORDER):
        a_word[first - i] = False
    padded = np.full(len(a_word), START & ~1, np.uint64)
    padded[a_word] = hashes
    return padded, first, sizes


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column, and how many each row has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[ends[0]:ends[-1]], np.diff(ends)


def cells(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column of rows of these many items."""
    ends = np.append(0, np.cumsum(sizes) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(STEP) + b)


class Hot:
    """Codes of the hottest words, most often first, 0 for others, and the pass of each."""

    def __init__(self, known: np.ndarray, of: np.ndarray, ranges: int):
        self.words, self.of, self.ranges = np.append(np.uint64(0), known << np.uint64(1)), np.append(np.uint8(0), of), ranges

    @functools.cached_property
    def slots(self) -> np.ndarray:
        slots = np.zeros(1 << 22, np.uint16)
        # Of words with one slot the most frequent has it.
        slots[(self.words[:0:-1] >> np.uint64(42)).astype(np.intp)] = np.arange(len(self.words) - 1, 0, -1)
        return slots

    def codes(self, found: np.ndarray) -> np.ndarray:
        at = self.slots[(found >> np.uint64(42)).astype(np.intp)]
        return np.where(self.words[at] == found & ~np.uint64(1), at, np.uint16(0))

    def read(self, rows: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray]:
        """parts x words of all rows, and their codes."""
        near = [np.frombuffer(r["near"], np.uint16).reshape(parts, -1) for r in rows]
        found = [self.words[x] for x in near]
        for x, y, r in zip(near, found, rows):
            y[x == 0] = np.frombuffer(r["far"], np.uint64)
        empty = np.zeros((parts, 0), np.uint16)
        return np.concatenate([empty.astype(np.uint64), *found], axis=1), np.concatenate([empty, *near], axis=1)


def coded(texts: DataFrame, sent) -> DataFrame:
    """The texts' words, as the low and high bytes of their codes and the hashes of those without, in place of the text."""
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = Hot(*sent.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, _, n = grams(piece.column("text"))
                near = hot.codes(found)
                far = near == 0
                total, ends = np.append(0, np.cumsum(far)), np.cumsum(n)
                split = near.view(np.uint8).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c) for c in kept], cells(split[:, 0], n), cells(split[:, 1], n),
                     cells(found[far] & ~np.uint64(1), total[ends] - total[ends - n])], [*kept, "low", "high", "far"])

    schema = T.StructType([*[texts.schema[c] for c in kept], *[T.StructField(c, T.BinaryType()) for c in ("low", "high", "far")]])
    return texts.mapInArrow(run, schema)


def joined(rows: list[dict], name: str, kind: type, parts: int = 0) -> np.ndarray:
    """The items of all rows; if in parts, those of each part end to end."""
    found = [np.frombuffer(r[name], kind) for r in rows]
    if parts:
        return np.concatenate([np.zeros((parts, 0), kind), *[x.reshape(parts, -1) for x in found]], axis=1)
    return np.concatenate([np.zeros(0, kind), *found])


def each(rows: list[dict], name: str, width: int) -> np.ndarray:
    """The kind of each row's items."""
    return np.repeat(np.array([r["kind"] for r in rows], np.uint8), np.array([len(r[name]) // width for r in rows], np.int64))


def packed(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        some = rows[i:i + 64]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in some], f.type) for f in PACKED], schema=PACKED)


def dealt(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by bucket, and each bucket's number and part of the order."""
    if not len(bucket):
        return np.zeros(0, np.intp), []
    if bucket.max() < 1 << 16:
        bucket = bucket.astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return order, list(zip(bucket[at].tolist(), at.tolist(), [*at[1:].tolist(), len(order)]))


def numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key among the different ones, and a place of each of these."""
    found = pa.array(keys).dictionary_encode()
    of, at = found.indices.to_numpy(), np.empty(len(found.dictionary), np.intp)
    at[of] = np.arange(len(of))
    return of, at


def words_row(found: np.ndarray, near: np.ndarray, some: np.ndarray) -> dict:
    """The words of some places, whose codes are near."""
    part, at = np.nonzero(near == 0)
    return {"near": near.tobytes(), "far": found[part, some[at]].tobytes()}


def asked_row(chunk: np.ndarray, place: np.ndarray) -> dict:
    """Places by chunk, which are in order."""
    at = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    return {"chunks": chunk[at].tobytes(), "runs": np.diff(np.append(at, len(chunk))).astype(np.uint32).tobytes(),
            "place": place.tobytes()}


def asked_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(joined(rows, "chunks", np.int64), joined(rows, "runs", np.uint32)), joined(rows, "place", np.uint16)


def spread(texts: DataFrame, ask: bool, sent, passes: range, buckets: int) -> DataFrame:
    """Rows of the places with a middle word of these passes, by bucket of the two words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, held, size, n_texts = Hot(*sent.value), [], 0, 0
        ours = np.isin(np.arange(hot.ranges), passes)
        chosen = ours[hot.of]

        def rows() -> list[dict]:
            keys, n, kind, found, near = (np.concatenate([h[i] for h in held], axis=-1) for i in range(5))
            chunk = int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "little", signed=True)
            of = np.repeat(np.arange(len(n)), n)
            order, parts = dealt(pair(found[0], found[1]) % np.uint64(buckets) * np.uint64(8) + kind[of])
            near, place = near[:, order], of[order].astype(np.uint16)
            out = []
            for bucket, i, j in parts:
                row = {"bucket": bucket // 8, "kind": PLACES + bucket % 8, **words_row(found, near[:, i:j], order[i:j])}
                out.append(row | asked_row(np.full(j - i, chunk), place[i:j]) if bucket & 4 else row)
            if ask:
                own = {"bucket": chunk % buckets, "kind": OWN, "chunks": np.int64(chunk).tobytes()}
                out.append(own | {"runs": np.where(kind & 4, n, 0).astype(np.uint32).tobytes(), "share": keys.tobytes()})
            return out

        for batch in batches:
            low, sizes = bytes_of(batch.column("low"))
            high, (far, far_sizes) = bytes_of(batch.column("high"))[0], bytes_of(batch.column("far"))
            far, ends, far_ends = far.view(np.uint64) if far.ctypes.data % 8 == 0 else np.frombuffer(far.tobytes(), np.uint64), \
                np.append(0, np.cumsum(sizes, dtype=np.int64)), np.append(0, np.cumsum(far_sizes // 8, dtype=np.int64))
            keys = batch.column("key").to_numpy()
            kinds = (keys >> 32 & 1).astype(np.uint8) + 2 * batch.column("seen").to_numpy(zero_copy_only=False).astype(np.uint8)
            kinds += 4 * batch.column("asked").to_numpy(zero_copy_only=False).astype(np.uint8) * ask
            at = 0
            while at < len(keys):
                stop = max(at + 1, min(at + TEXTS, int(np.searchsorted(ends, ends[at] + STEP_WORDS, "right")) - 1))
                if held and (size >= HELD or n_texts + stop - at > TEXTS):
                    yield from packed(rows())
                    held, size, n_texts = [], 0, 0
                near = high[ends[at]:ends[stop]].astype(np.uint16)
                near <<= 8
                near |= low[ends[at]:ends[stop]]
                mine, cold = chosen[near], np.flatnonzero(near == 0)
                theirs = far[far_ends[at]:far_ends[stop]]
                mine[cold] = ours[(theirs >> np.uint64(42)) % np.uint64(hot.ranges)]
                # The first two words are of no text.
                first = ends[at:stop] - ends[at] + ORDER - 1
                mine[first - 2] = False
                mine[(first - 2)[1:] - 1] = False
                used = np.flatnonzero(mine[:-1]) + 1
                used_all = np.stack([used - 2, used - 1, used])
                codes = near[used_all]
                found = hot.words[codes]
                rare = codes == 0
                found[rare] = theirs[np.searchsorted(cold, used_all[rare])]
                mine = np.diff(np.append(np.searchsorted(used, first), len(used)))
                held.append((keys[at:stop], mine, kinds[at:stop], found, codes))
                size += len(used)
                n_texts += stop - at
                at = stop
        if held:
            yield from packed(rows())

    return texts.select("key", "low", "high", "far", "seen", "asked").mapInArrow(run, ROWS)


def freed(n: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return cut[np.minimum(n, 3).astype(np.intp)]


def looked_up(known: np.ndarray, asked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each, 0 where it is not known."""
    if not len(known):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, values[at], 0)


def below(found: np.ndarray, near: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of two words: of both if the first is hot, else of the first."""
    return np.where(near[0] > 0, pair(found[0], found[1]), mixed(found[0])) % np.uint64(buckets)


def after(of: np.ndarray, contexts: int, n: np.ndarray, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """model x context: the number of the grams after it, and what they leave to shorter ones."""
    return (np.stack([np.bincount(of, x, contexts) for x in n]),
            np.stack([np.bincount(of, freed(x, cut), contexts) for x, cut in zip(n, cuts)]))


def long_grams(rows: list[dict], hot: Hot, cuts, scorer, buckets: int) -> tuple[list[dict], np.ndarray]:
    """The rows of a bucket of two words, as rows of the last two; and model x gram, how often each is."""
    out, rows = [r for r in rows if r["kind"] == OWN], [r for r in rows if r["kind"] >= PLACES]
    found, near = hot.read(rows, ORDER)
    kind = each(rows, "near", 2 * ORDER) - PLACES
    two = pair(found[0], found[1])
    gram, at = numbers(pair(two, found[2]))
    seen = np.flatnonzero(kind & 2)
    n = np.bincount(gram[seen] + (kind[seen] & 1) * np.int64(len(at)), minlength=2 * len(at)).reshape(2, -1)
    some = np.flatnonzero(n.any(axis=0))
    last, last_at = numbers(pair(found[1][at[some]], found[2][at[some]]))
    n_last = np.stack([np.bincount(last, x, len(last_at)) for x in n[:, some] > 0]).astype(np.uint32)
    last_at = at[some[last_at]]
    to = below(found[1:, at], near[1:, at], buckets)
    order, parts = dealt(to[gram[last_at]])
    last_at, n_last = last_at[order], n_last[:, order]
    codes = near[1:, last_at]
    for bucket, i, j in parts:
        out.append({"bucket": bucket, "kind": SEEN, **words_row(found[1:], codes[:, i:j], last_at[i:j]), "n": n_last[:, i:j].tobytes()})
    asking = [r for r in rows if r["kind"] & 4]
    if cuts is None or not asking:
        return out, n
    # By model and gram, as a place has them.
    context, context_at = numbers(two[at])
    whole, left = after(context, len(context_at), n, cuts[2])
    known, all_ = whole[:, context] > 0, np.maximum(whole, 1.0)[:, context]
    p = (n - np.stack([freed(x, cut) for x, cut in zip(n, cuts[2])])) / all_
    known, p, rest = known.ravel(), p.ravel(), (left[:, context] / all_).ravel()
    places = np.flatnonzero(kind & 4)
    model, of = scorer[kind[places] & 1], gram[places]
    order, parts = dealt(to[of] * np.uint64(2) + model.astype(np.uint64))
    of = (of + model * len(at))[order]
    known, chunk, place = known[of], *(x[order] for x in asked_of(asking))
    places, of = places[order], of[known]
    codes, share, rank = near[1:, places], np.stack([p[of], rest[of]]), np.append(0, np.cumsum(known))
    for bucket, i, j in parts:
        out.append({"bucket": bucket // 2, "kind": ASKED + bucket % 2, **asked_row(chunk[i:j], place[i:j]),
                    **words_row(found[1:], codes[:, i:j], places[i:j]), "known": np.packbits(known[i:j]).tobytes(),
                    "share": share[:, rank[i]:rank[j]].tobytes()})
    return out, n


def sums_rows(chunk: np.ndarray, place: np.ndarray, logs: np.ndarray) -> list[dict]:
    if not len(chunk):
        return []
    of, chunk_at = numbers(chunk)
    text, text_at = numbers(of.astype(np.uint64) << np.uint64(16) | place)
    logs = np.bincount(text, logs, len(text_at))
    order, parts = dealt(of[text_at])
    place, logs = place[text_at[order]], logs[order]
    return [{"bucket": int(chunk[chunk_at[c]]), "kind": SUMS, "place": place[i:j].tobytes(), "share": logs[i:j].tobytes()}
            for c, i, j in parts]


def short_grams(rows: list[dict], hot: Hot, cuts, by_code, buckets: int) -> list[dict]:
    """The rows of a bucket of last words, as sums of texts, and as rows of those whose last word is not hot."""
    seen, asked = [r for r in rows if r["kind"] == SEEN], [r for r in rows if r["kind"] in (ASKED, ASKED + 1)]
    out = [r | {"bucket": int(np.frombuffer(r["chunks"], np.int64)[0])} for r in rows if r["kind"] == OWN]
    if not asked:
        return out
    found, near = hot.read([*seen, *asked], 2)
    n = joined(seen, "n", np.uint32, 2)
    gram, at = numbers(pair(found[0], found[1]))
    context, context_at = numbers(found[0][at])
    mine, size = gram[:n.shape[1]], n.shape[1]
    n = np.stack([np.bincount(mine, x, len(at)) for x in n])
    whole, left = after(context, len(context_at), n, cuts[1])
    first = near[0][at[context_at]]
    for x, y in ((whole, by_code[0]), (left, by_code[1])):
        x[:, first > 0] = y[:, first[first > 0]]
    # By model and gram: the probability by pairs, and what it leaves to single words.
    known, all_ = whole[:, context] > 0, np.maximum(whole, 1.0)[:, context]
    own = np.where(known, (n - np.stack([freed(x, cut) for x, cut in zip(n, cuts[1])])) / all_, 0.0)
    leaves = np.where(known, left[:, context] / all_, 1.0)
    whole = (own + leaves * by_code[2][:, near[1][at]]).ravel()
    model = (each(asked, "near", 4) - ASKED).astype(np.int64)
    of, last, is_hot = gram[size:] + model * len(at), found[1][size:], near[1][size:] > 0
    chunk, place = asked_of(asked)
    known = np.concatenate([np.unpackbits(np.frombuffer(r["known"], np.uint8), count=len(r["place"]) // 2) for r in asked]).astype(bool)
    p, rest = np.zeros(len(known)), np.ones(len(known))
    p[known], rest[known] = joined(asked, "share", float, 2)
    done = np.flatnonzero(is_hot)
    out += sums_rows(chunk[done], place[done], np.log(p[done] + rest[done] * whole[of[done]]))
    done = np.flatnonzero(~is_hot)
    p, rest, of = p[done], rest[done], of[done]
    chunk, place, last, model = chunk[done], place[done], last[done], model[done].astype(np.uint64)
    share = np.stack([p + rest * own.ravel()[of], rest * leaves.ravel()[of]])
    order, parts = dealt(mixed(last) % np.uint64(buckets) * np.uint64(2) + model)
    for bucket, i, j in parts:
        some = order[i:j]
        out.append({"bucket": bucket // 2, "kind": ASKED + bucket % 2, **asked_row(chunk[some], place[some]),
                    "far": last[some].tobytes(), "share": share[:, some].tobytes()})
    return out


def last_words(rows: list[dict], chance) -> list[dict]:
    """The rows of a bucket of words that are not hot, as sums of texts."""
    seen, asked = [r for r in rows if r["kind"] == SEEN], [r for r in rows if r["kind"] in (ASKED, ASKED + 1)]
    found, n = joined(seen, "far", np.uint64), joined(seen, "n", np.int64)
    order = np.argsort(found)
    model = (each(asked, "far", 8) - ASKED).astype(np.uint64)
    n = looked_up(found[order], joined(asked, "far", np.uint64) | model, n[order])
    share = joined(asked, "share", float, 2)
    return sums_rows(*asked_of(asked), np.log(share[0] + share[1] * chance(n, model)))


def by_bucket(rows: DataFrame, work, schema: str = ROWS) -> DataFrame:
    """What work makes, as record batches, of the rows of each bucket."""

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(work(table.to_pylist()), kinds)

    def run_packed(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(packed(work(table.to_pylist())), PACKED)

    kinds = arrow(schema)
    return rows.groupBy("bucket").applyInArrow(run_packed if schema == ROWS else run, schema)


def hot_words(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The hottest words, most often first, the pass of each, how many passes, and how many words there are in all.

    How often words are matters to the work alone; those rare in each chunk may be missed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            used, n = np.unique(np.concatenate(held) >> np.uint64(1), return_counts=True)
            often = n >= 1 + size * HOT
            return pa.RecordBatch.from_arrays([pa.array(np.append(used[often].view(np.int64), -1)),
                                               pa.array(np.append(n[often], size))], ["word", "n"])
        for batch in batches:
            for piece in pieces(batch, "text"):
                held.append(words(piece.column("text"))[0])
                size += len(held[-1])
                if size >= HELD:
                    yield counts()
                    held, size = [], 0
        if size:
            yield counts()

    counts = texts.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # The number of all words, -1, is more often than any.
    found = counts.orderBy(F.desc("n"), "word").limit(NEAR).toArrow()
    used, n = (found.column(c).to_numpy() for c in ("word", "n"))
    total = int(n[used == -1].sum())
    keep = (used != -1) & (n >= total * HOT)
    used, n = used[keep].view(np.uint64), n[keep]
    ranges = max(1, min(RANGES, -(-total // PASS)))
    load, of = [(0, r) for r in range(ranges)], np.zeros(len(used), np.uint8)
    for i, k in enumerate(n.tolist()):
        size, r = load[0]
        of[i] = r
        heapq.heapreplace(load, (size + k, r))
    # The word before a text has a code as well.
    return np.append(np.uint64(START >> 1), used), np.append(np.uint8(0), of), ranges, total


def count_passes(counted: DataFrame, sent, ranges: int, buckets: int) -> DataFrame:
    """kind and word with sums: of each word, n, the different words before it, and of hot ones the grams after it, all
    and how many of number 1, 2 and more; of gram orders 2 and 3, by number up to 4 and model, how many grams."""
    sums = [f"x{i}" for i in range(5)]
    schema = "kind int, word long, " + ", ".join(f"{x} long" for x in sums)

    def batch(kind: int, word: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        columns = [*columns, *[np.zeros(len(word), np.int64)] * (5 - len(columns))]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(word), kind, np.int32)), pa.array(word.view(np.int64)),
                                           *[pa.array(c.astype(np.int64)) for c in columns]], ["kind", "word", *sums])

    def tallies(n: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(np.minimum(x, 5).astype(np.intp), minlength=6)[1:5] for x in n])

    def first(rows: list[dict]) -> list[dict]:
        out, n = long_grams(rows, Hot(*sent.value), None, None, buckets)
        return [*out, {"bucket": 0, "kind": SUMS, "n": tallies(n).tobytes()}]

    def second(rows: list[dict]) -> list[pa.RecordBatch]:
        hot, seen = Hot(*sent.value), [r for r in rows if r["kind"] == SEEN]
        found, near = hot.read(seen, 2)
        gram, at = numbers(pair(found[0], found[1]))
        n = np.stack([np.bincount(gram, x, len(at)) for x in joined(seen, "n", np.uint32, 2)])
        known = [(2, tallies(n)), *[(3, np.frombuffer(r["n"], np.int64).reshape(2, 4)) for r in rows if r["kind"] == SUMS]]
        out = [batch(k, np.arange(1, 5) * 2 + m, x[m]) for k, x in known for m in (0, 1)]
        for m in (0, 1):
            mine, some = at[n[m] > 0], n[m][n[m] > 0]
            word, word_at = numbers(found[1][mine])
            out.append(batch(1, found[1][mine[word_at]] | np.uint64(m), np.bincount(word, minlength=len(word_at))))
            hottest = near[0][mine] > 0
            mine, some = mine[hottest], some[hottest]
            word, word_at = numbers(found[0][mine])
            follow = [np.bincount(word, x, len(word_at)) for x in (some, some == 1, some == 2, some > 2)]
            out.append(batch(1, found[0][mine[word_at]] | np.uint64(m), np.zeros(len(word_at)), *follow))
        return out

    whole = None
    for i in range(min(COUNTED, ranges)):
        rows = spread(counted, False, sent, range(i, ranges, COUNTED), buckets)
        done = settle(by_bucket(by_bucket(rows, first), second, schema)
                      .groupBy("kind", "word").agg(*[F.sum(x).alias(x) for x in sums]), "words")
        whole = done if whole is None else whole.union(done)
    out = settle(whole.groupBy("kind", "word").agg(*[F.sum(x).alias(x) for x in sums]), "words")
    drop(whole)
    return out


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """key, a hash of the text, and half, which of the two models the text may train."""
    whole = column(text).cast("string")
    return docs.withColumn("key", F.xxhash64(F.coalesce(whole, F.lit("")))).withColumn(
        "half", F.shiftright("key", 32).bitwiseAND(F.lit(1)).cast("int"))


def word_perplexities(docs: DataFrame, trusted: DataFrame, discounts, text: str = "text") -> DataFrame:
    """key (see ``keyed``) and perplexity per word of each different text with a word."""
    whole = column(text).cast("string").alias("text")
    ours, theirs = (keyed(x, text).select("key", whole, F.lit(seen).alias("seen")) for x, seen in ((docs, False), (trusted, True)))
    return perplexities(ours.union(theirs), lambda rows: rows.withColumn("asked", ~F.col("seen")), discounts)


def perplexities(texts: DataFrame, marked, discounts) -> DataFrame:
    """key and perplexity per word of each different text with a word.

    texts has key and text; ``marked`` gets its other columns and key, with the words in place of
    the text, and adds ``seen``, whether a row trains its half's model, and ``asked``, whether it is scored.
    Where all trusted texts fall into one half there is one model, which scores its own texts.
    """
    spark = texts.sparkSession
    with cleaned(spark):
        known, of, ranges, total = hot_words(texts)
        buckets = max(1, -(-total // (ranges * BUCKET)))
        sent = spark.sparkContext.broadcast((known, of, ranges))
        # In parts, so that only one of them is on disk twice.
        ours = functools.reduce(DataFrame.union, [
            settle(marked(coded(texts.filter(F.pmod("key", F.lit(PARTS)) == i), sent))
                   .select("key", "low", "high", "far", "seen", "asked"), "coded", compression="zstd") for i in range(PARTS)])
        counts = count_passes(ours.filter("seen"), sent, ranges, buckets)

        low = F.col("word").bitwiseAND(F.lit(1))
        tallies = [[{}, {}] for _ in range(ORDER)]
        for r in counts.filter("kind > 1").collect():
            tallies[r["kind"] - 1][r["word"] & 1][r["word"] >> 1] = r["x0"]
        ones = counts.filter("kind = 1 and x0 > 0")
        for r in ones.groupBy(low.alias("m"), F.least("x0", F.lit(5)).alias("n")).agg(F.count("*").alias("k")).collect():
            tallies[0][r["m"]][r["n"]] = r["k"]
        cuts = [[np.array([0.0, *discounts(t)]) for t in level] for level in tallies]
        halves = [m for m in (0, 1) if tallies[0][m]]
        words_in_all = ones.select(F.shiftright("word", 1)).distinct().count()
        sums = {r["m"]: r["s"] for r in ones.groupBy(low.alias("m")).agg(F.sum("x0").alias("s")).collect()}
        all_ = np.array([sums.get(m, 0) for m in (0, 1)], float)
        # Counts of 3 and more free alike, so the few tallies say what is freed.
        free = np.array([sum(k * cuts[0][m][min(n, 3)] for n, k in tallies[0][m].items()) for m in (0, 1)])

        def chance(n: np.ndarray, model: np.ndarray) -> np.ndarray:
            """Unknown words share what the counts of single words leave, evenly with the known ones."""
            model, even = model.astype(np.intp), 1.0 / (words_in_all + 1)
            cut = np.stack([c[0:4] for c in cuts[0]])[model, np.minimum(n, 3)]
            with np.errstate(invalid="ignore", divide="ignore"):
                return np.where(all_[model] > 0, (n - cut + free[model] * even) / all_[model], even)

        at_hot = spark.createDataFrame(pa.table({"hot": pa.array(known.view(np.int64))}))
        table = counts.filter("kind = 1").join(F.broadcast(at_hot), F.shiftrightunsigned("word", 1) == F.col("hot")).drop("hot").toArrow()
        found = table.column("word").to_numpy().view(np.uint64)
        x = [table.column(f"x{i}").to_numpy() for i in range(5)]
        codes, by_code = Hot(known, of, ranges).codes(found), np.zeros((3, 2, len(known) + 1))
        models = (found & np.uint64(1)).astype(np.intp)
        n = np.zeros((2, len(known) + 1), np.int64)
        by_code[0, models, codes] = x[1]
        by_code[1, models, codes] = sum(x[i + 1] * np.stack([c[i] for c in cuts[1]])[models] for i in (1, 2, 3))
        n[models, codes] = x[0]
        by_code[2] = [chance(n[m], np.full(len(known) + 1, m)) for m in (0, 1)]
        given = spark.sparkContext.broadcast(by_code)

        def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hot = Hot(*sent.value)
            for batch in batches:
                # The model is a word's last bit.
                found, n = batch.column("word").to_numpy().view(np.uint64), batch.column("x0").to_numpy()
                far = hot.codes(found) == 0
                found, n = found[far], n[far]
                order, parts = dealt(mixed(found & ~np.uint64(1)) % np.uint64(buckets))
                yield from packed([{"bucket": b, "kind": SEEN, "far": found[order[i:j]].tobytes(), "n": n[order[i:j]].tobytes()}
                                   for b, i, j in parts])

        def back(rows: list[dict]) -> list[pa.RecordBatch]:
            own = [r for r in rows if r["kind"] == OWN]
            if not own:
                raise ValueError("a text was read in another order than before")
            keys, n = np.frombuffer(own[0]["share"], np.int64), sum(np.frombuffer(r["runs"], np.uint32).astype(np.int64) for r in own)
            rows = [r for r in rows if r["kind"] == SUMS]
            logs = np.bincount(joined(rows, "place", np.uint16), joined(rows, "share", float), len(keys)).astype(float)
            some = n > 0
            return [pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(n[some]), pa.array(logs[some])], ["key", "n", "log"])]

        scorer, out = np.array([halves[0]] * 2 if len(halves) == 1 else [1, 0]), []
        rare = settle(ones.select("word", "x0").mapInArrow(cold, ROWS), "rare")
        drop(counts)
        for r in range(ranges):
            rows = spread(ours, True, sent, range(r, r + 1), buckets)
            rows = by_bucket(rows, lambda x: long_grams(x, Hot(*sent.value), cuts, scorer, buckets)[0])
            rows = settle(by_bucket(rows, lambda x: short_grams(x, Hot(*sent.value), cuts, given.value, buckets)), "places")
            rest = rows.filter(F.col("kind").between(ASKED, ASKED + 1)).union(rare)
            rest = by_bucket(rest, lambda x: last_words(x, chance))
            sums = rows.filter(F.col("kind") >= OWN).union(rest)
            out.append(settle(by_bucket(sums, back, "key long, n long, log double"), "sums"))
            drop(rows)
        # Rows of equal texts add up in the sum and in the number alike.
        found = functools.reduce(DataFrame.union, out).groupBy("key").agg(F.exp(-F.sum("log") / F.sum("n")).alias("perplexity"))
        found = settle(found, "perplexities")
        drop(ours, rare, *out)
        return found
