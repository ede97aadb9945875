"""Exact token counts of every prefix of a text, by dynamic programming.

For a byte-level BPE tokenizer the last token of each prefix of a word is unique: it is
the one token that ends there and stays apart when merged with the last token of the
prefix before it. So one table holds the token count at every byte of a text, and
truncation, budget and chunk questions are look-ups in it. Tables of words are
remembered; a text's table is theirs, end to end, put right where a longer text would be
divided into words otherwise (runs of white space, three-letter contractions, special
strings). Counts hold at the ends of characters.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidegauge.llm.common import utf8, with_text_columns

#: Fixed values of byte-level BPE: how a text is divided into words, and the characters
#: that stand for themselves in the vocabulary file (all other bytes follow from 256 on).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same with letters and digits that the library does not know counted among the others.
WORDS_OF = (r"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?[\p{L}--[%(newer)s]]+| ?[\p{N}--[%(newer)s]]+"
            r"| ?[[^\s\p{L}\p{N}]||[%(newer)s]]+|\s+(?!\S)|\s+")
PLAIN = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
CONTRACTIONS = ("'re", "'ve", "'ll")

#: Tables that a worker remembers at most, and the longest word remembered.
REMEMBERED, LONGEST = 1 << 20, 256
#: Above all ranks.
ENDLESS = 1 << 60


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter of each byte, as letter to byte."""
    letters = {chr(b): b for b in PLAIN}
    rest = [b for b in range(256) if b not in set(PLAIN)]
    return {**letters, **{chr(256 + i): b for i, b in enumerate(rest)}}


@functools.lru_cache(maxsize=1)
def newer_letters() -> str:
    """The letters and digits of the ``regex`` package that the library's own pre-tokenizer
    does not take for such, as ranges of a character class; its tables may be older."""
    from tokenizers import Regex, pre_tokenizers
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    newer: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        ours = regex.findall(kind, every)
        split = pre_tokenizers.Split(Regex(f"{kind}+"), "removed").pre_tokenize_str("".join(ours))
        newer.update("".join(rest for rest, _ in split))
    ranges: list[list[int]] = []
    for c in sorted(map(ord, newer)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Counter:
    """Prefix tables for one tokenizer file."""

    def __init__(self, path: str, newer: str = ""):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        steps = model["pre_tokenizer"]
        if steps["type"] != "ByteLevel" or steps["add_prefix_space"] or model.get("normalizer"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()

        def plain(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.ids = {bytes([b]): b for b in range(256)}
        self.rank: dict[tuple[int, int], int] = {}
        # Of each token its two parts; a merge's place in the list is its rank.
        self.parts: list[tuple[int, int] | None] = [None] * 256
        for a, b in merges:
            a, b = plain(a), plain(b)
            if a + b in self.ids:
                raise ValueError("two merges make one token")
            self.rank[self.ids[a], self.ids[b]] = len(self.parts)
            self.parts.append((self.ids[a], self.ids[b]))
            self.ids[a + b] = len(self.parts) - 1
        self.longest = max(map(len, self.ids))
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.special = [t["content"] for t in model["added_tokens"]]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.words = regex.compile(WORDS)
        self.newer = re.compile(f"[{newer}]") if newer else None
        self.words_of = regex.compile(WORDS_OF % {"newer": newer}) if newer else None
        self.apart: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one edge (0 left, 1 right) of a token as it is built up from a
        byte, each with the rank of the merge that takes it in."""
        known = self.edges.get((token, side))
        if known is None:
            known, part, taken = [(token, ENDLESS)], token, ENDLESS
            while self.parts[part] is not None:
                taken, part = part, self.parts[part][side]
                known.append((part, taken))
            known.reverse()
            self.edges[token, side] = known
        return known

    def stays_apart(self, before: int, token: int) -> bool:
        """Whether two tokens' text is encoded as these two.

        Merges go by rank, and a token's merge ranks after those of its parts. So the
        border lasts unless the two parts beside it at some time have a merge of less
        rank than those that take them in (on equal rank the left place goes first).
        """
        right, left = self.edge(before, 1), self.edge(token, 0)
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = right[i], left[j]
            merge = self.rank.get((a, b), ENDLESS)
            if merge < a_taken and merge <= b_taken and merge != ENDLESS:
                return False
            if a_taken <= b_taken:
                if a_taken == ENDLESS:
                    return True
                i += 1
            else:
                j += 1

    def table(self, word: bytes) -> list[int]:
        """Tokens of each prefix of one word, from none to all."""
        last, count = [-1], [0]
        ids, apart, longest = self.ids, self.apart, self.longest
        for i in range(1, len(word) + 1):
            for start in range(i - 1, max(0, i - longest) - 1, -1):
                token = ids.get(word[start:i])
                if token is None:
                    continue
                if start:
                    pair = last[start] << 20 | token
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self.stays_apart(last[start], token)
                    if not fits:
                        continue
                last.append(token)
                count.append(count[start] + 1)
                break
        if len(apart) > REMEMBERED:
            apart.clear()
        return count

    def piece(self, word: str) -> bytes:
        """Steps of the count (one signed byte per byte) along a word."""
        steps = self.pieces.get(word)
        if steps is None:
            counts = self.table(word.encode())
            if word in CONTRACTIONS:
                counts[2] = 2  # "'" and a letter: not a contraction yet
            steps = bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
            if len(word) <= LONGEST:
                if len(self.pieces) > REMEMBERED:
                    self.pieces.clear()
                self.pieces[word] = steps
        return steps

    def unit(self, unit: str) -> bytes:
        """Steps along a blank and what follows up to the next white space, or any text."""
        words = self.words if unit.isascii() or self.newer is None or not self.newer.search(unit) else self.words_of
        steps = b"".join(map(self.piece, words.findall(unit)))
        if len(unit) <= LONGEST:
            if len(self.units) > REMEMBERED:
                self.units.clear()
            self.units[unit] = steps
        return steps

    def ordinary(self, text: str) -> np.ndarray:
        """Steps along a text without regard to special strings."""
        found = UNITS.findall(text)
        known = self.units
        steps = np.frombuffer(b"".join([known.get(u) or self.unit(u) for u in found]), np.int8)
        runs = [m for m in RUNS.finditer(text)]
        if runs:
            steps = steps.copy()
            at = byte_places(text, [m.end() for m in runs])
            for m, end in zip(runs, at):
                run = m.group()
                whole, most, one = (int(np.frombuffer(self.piece(r), np.int8).sum()) for r in (run, run[:-1], run[-1]))
                # With nothing after it the run is one word.
                more = whole - most - one
                if more:
                    steps[end - 1] += more
                    steps[end] -= more
        return steps

    def steps(self, text: str) -> np.ndarray:
        """Steps of the token count along a text, special strings included."""
        if self.cut is None:
            return self.ordinary(text)
        parts = self.cut.split(text)
        if len(parts) == 1:
            return self.ordinary(text)
        out = []
        for i in range(0, len(parts), 2):
            if i + 1 == len(parts):
                out.append(self.ordinary(parts[i]))
                break
            # Up to its last byte the special string is ordinary text; then it is one token.
            before = int(self.ordinary(parts[i]).sum(dtype=np.int64))
            whole = self.ordinary(parts[i] + parts[i + 1]).copy()
            whole[-1] = before + 1 - int(whole[:-1].sum(dtype=np.int64))
            out.append(whole)
        return np.concatenate(out)


#: Unicode's white space.
BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A blank and what follows up to the next white space, or a run of white space.
UNITS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
RUNS = re.compile(f"[{BLANK}]{{2,}}(?=[^{BLANK}])")


def byte_places(text: str, places: list[int]) -> list[int]:
    """Byte offsets of ascending character offsets."""
    if text.isascii():
        return places
    out, at, before = [], 0, 0
    for p in places:
        at += len(text[before:p].encode())
        before = p
        out.append(at)
    return out


@functools.lru_cache(maxsize=2)
def counter(path: str, newer: str) -> Counter:
    return Counter(path, newer)


def count_at(steps: np.ndarray, n_bytes: int) -> int:
    """Tokens of the first n_bytes bytes of a text."""
    return int(steps[:n_bytes].sum(dtype=np.int64))


def longest_within(steps: np.ndarray, data: np.ndarray, budget: int) -> int:
    """Bytes of the longest prefix of whole characters with at most that many tokens."""
    if not len(steps):
        return 0
    ends = np.ones(len(data), bool)
    ends[:-1] = (data[1:] & 0xC0) != 0x80
    fits = np.flatnonzero(ends & (np.cumsum(steps, dtype=np.int64) <= budget))
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_tables(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, n_bytes and ``steps``: one signed byte per text byte, whose
    running sum is the token count of each prefix of whole characters. Null counts as
    empty. The tables can be stored and asked with ``answers`` without the tokenizer."""

    newer = newer_letters()

    def make():
        known = counter(tokenizer, newer)

        def compute(texts: pa.Array) -> list[pa.Array]:
            steps = [known.steps(t or "") for t in texts.to_pylist()]
            return [pa.array([len(s) for s in steps], pa.int64()), pa.array([s.tobytes() for s in steps], pa.binary())]
        return compute

    return with_text_columns(docs, text, "n_bytes long, steps binary", make, keep)


def prefix_answers(docs: DataFrame, tokenizer: str, budget: int, text: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """The kept columns, n_bytes, n_tokens, over_budget, and kept_bytes: the longest
    prefix of whole characters within the budget. Each text's prefix table is made and
    asked in the task. Null and empty texts have no tokens; a computed column takes the
    place of an input column of its name."""

    newer = newer_letters()

    def make():
        known = counter(tokenizer, newer)

        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            sizes, totals, kept = np.diff(at), [], []
            for i, text in enumerate(texts.to_pylist()):
                steps = known.steps(text or "")
                totals.append(count_at(steps, len(steps)))
                kept.append(int(sizes[i]) if totals[-1] <= budget
                            else longest_within(steps, data[at[i]: at[i + 1]], budget))
            totals = np.array(totals, np.int64)
            return [pa.array(sizes), pa.array(totals), pa.array(totals > budget), pa.array(kept, pa.int64())]
        return compute

    return with_text_columns(docs, text, "n_bytes long, n_tokens long, over_budget boolean, kept_bytes long",
                             make, keep)
