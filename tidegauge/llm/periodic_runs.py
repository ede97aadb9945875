"""Runs of periodic words, proposed by string synchronising sets at dyadic scales.

A run is a maximal stretch of words whose smallest period q fits into it three times.
Periods under 8 are read off by comparing the words with themselves, shifted. For each
scale t = 4, 8, 16, ... the synchronising set holds the places i at which the least hash
of the t-grams starting in i..i+t is that of the first or of the last of them, t-grams
that are themselves highly periodic (period at most t / 3) left out. Membership depends
on the 2t words from i on alone, so it repeats with the text. A run with a period q from
2t to under 4t holds such a place in its first period (or a shorter period would fill
it) and again q further on, with equal contexts of 2t words: pairs of equal contexts
less than 4t apart propose every such period. Equal contexts are over t / 3 apart, as
they hold a t-gram that is not highly periodic, so a place meets at most twelve others.
The highly periodic places left out lie in runs of smaller periods, found at the scales
before (and for t up to 16 in the shifted comparison). Each proposal is extended word by
word, so hashes only ever propose.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.common import utf8, with_text_columns

#: Words of a run at least, and how often its period fits at least.
LEAST, TIMES = 24, 3
#: Periods below this are found by shifted comparison.
FIRST = 8
FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
FIELDS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(grams: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the grams of twice the size."""
    return mixed(grams[:-size] * np.uint64(0x9E3779B97F4A7C15) + grams[size:])


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


def marked(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """Whether each place is in one of the ranges [start, stop)."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops, -1)
    return np.cumsum(steps[:-1]) > 0


def extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words a period apart are equal, in full."""
    last, right, step = len(words) - period, at, 64
    while right < last:
        stop = min(last, right + step)
        differ = words[right:stop] != words[right + period: stop + period]
        if differ.any():
            right += int(differ.argmax())
            break
        right, step = stop, step * 2
    left, step = at, 64
    while left > 0:
        start = max(0, left - step)
        differ = words[start:left] != words[start + period: left + period]
        if differ.any():
            left -= int(differ[::-1].argmax())
            break
        left, step = start, step * 2
    return left, right + period


def synchronising(grams: np.ndarray, size: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising places of grams of that size, a power of two."""
    own = np.where(periodic, FAR, grams)
    least, width = own, 1
    while width < size:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != FAR) & ((least == own[:n]) | (least == own[size: size + n])))


def proposals(places: np.ndarray, contexts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(period, place) of equal contexts from 2 to under 4 sizes apart, in order."""
    order = np.argsort(contexts, kind="stable")
    contexts, places = contexts[order], places[order]
    found, apart = [], 0
    while apart + 1 < len(places):
        apart += 1
        distance = places[apart:] - places[:-apart]
        near = (contexts[apart:] == contexts[:-apart]) & (distance < 4 * size)
        if not near.any():
            break
        at = np.flatnonzero(near & (distance >= 2 * size))
        found.extend(zip(distance[at].tolist(), places[at].tolist()))
    return sorted(found)


def find_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, period, length) of every run, by start, then period.

    ``words`` are numbers that are equal where the words are; no run is longer than
    ``longest``.
    """
    n = len(words)
    found: dict[tuple[int, int], int] = {}
    small = {}
    for period in range(1, min(FIRST, n)):
        starts, ends = stretches(words[:-period] == words[period:])
        small[period] = starts, ends
        long = ends - starts + period >= max(LEAST, TIMES * period)
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            found.setdefault((start, end + period), period)
    grams, size = mixed(words.view(np.uint64)), 1
    while size < FIRST // 2 and len(grams) > size:
        grams, size = doubled(grams, size), size * 2
    while size >= FIRST // 2 and 2 * TIMES * size <= longest and len(grams) > size:
        contexts = doubled(grams, size)
        if size <= 16:
            spans = [(starts[long], ends[long] - (size - period) + 1)
                     for period, (starts, ends) in small.items() if 3 * period <= size
                     for long in (ends - starts >= size - period,)]
            first, stop = (np.concatenate(side) for side in zip(*spans))
        else:
            some = [(a, b - size + 1) for (a, b), period in found.items() if 3 * period <= size <= b - a]
            first, stop = np.array(some, np.int64).reshape(-1, 2).T
        places = synchronising(grams, size, marked(first, stop, len(grams)))
        known, left, right = 0, 0, 0
        for period, place in proposals(places, contexts[places], size):
            if period == known and left <= place and place + period < right:
                continue
            known, (left, right) = period, extended(words, place, period)
            if right - left >= max(LEAST, TIMES * period):
                # A shorter period of the same stretch is there from an earlier scale.
                found.setdefault((left, right), period)
        grams, size = contexts, size * 2
    return sorted((start, period, end - start) for (start, end), period in found.items())


def runs_of_texts(texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int, int]]], list[bytes]]:
    """Per text its words, its runs (start, length, period), and the text without repeats.

    The texts are laid end to end, with a word of its own after each.
    """
    numbers: dict[bytes, int] = {}
    number, split = numbers.setdefault, [text.split() for text in texts]  # of bytes: the six blanks
    values: list[int] = []
    for i, words in enumerate(split):
        values.extend([number(w, len(numbers)) for w in words])
        values.append(-1 - i)
    counts = [len(words) for words in split]
    offsets = np.concatenate(([0], np.cumsum(np.array(counts, np.int64) + 1)))
    found = find_runs(np.array(values, np.int64), max(counts, default=0))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = [b" ".join(words) for words in split] if not found else None
    if kept is None:
        starts = np.array([f[0] for f in found], np.int64)
        repeats = marked(starts + [f[1] for f in found], starts + [f[2] for f in found], len(values))
        of = np.searchsorted(offsets, starts, "right") - 1
        for i, (start, period, length) in zip(of.tolist(), found):
            runs[i].append((start - int(offsets[i]), length, period))
        kept = [b" ".join([w for w, again in zip(words, repeats[offsets[i]: offsets[i + 1]].tolist()) if not again])
                if runs[i] else b" ".join(words) for i, words in enumerate(split)]
    return counts, runs, kept


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, n_words, runs (by start, then period) and collapsed: the words,
    joined by one space, less all that a run holds after its first period.

    Every row is looked at by itself, whole, in one scan without a shuffle; a task holds
    a piece of about a megabyte, or one longer text. Null counts as empty: no words, no
    runs, an empty text. Repeated rows repeat. A kept column named as a computed one is
    replaced by it. An empty table gives an empty one.
    """

    def make():
        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            raw, at = data.tobytes(), at.tolist()
            counts, runs, kept = runs_of_texts([raw[x:y] for x, y in zip(at, at[1:])])
            flat = np.array([run for some in runs for run in some], np.int64).reshape(-1, 3)
            offsets = np.concatenate(([0], np.cumsum([len(some) for some in runs]))).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)],
                                               ["start", "length", "period"])
            return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items),
                    pa.array(kept, pa.binary()).cast(pa.string())]
        return compute

    return with_text_columns(docs, text, FIELDS, make, keep)
