"""Language identification as a mixture of languages per document.

A language is a distribution over byte trigrams of letters (hashed to a fixed number of
buckets), counted over all training texts. A document is a mixture of languages;
expectation maximisation finds the shares that make its trigrams most likely. Of the
sets of its most shared languages the one of greatest likelihood less a penalty per
further language is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import WHOLE, column, pieces, utf8, with_text_columns

BUCKETS = 1 << 16
#: A model is at most this many languages times BUCKETS 32-bit numbers.
MAX_LANGUAGES = 256
SMOOTHING = 0.1
ROUNDS, CLOSE = 30, 1e-3
#: One in so many training texts is held out to see how well texts fit their language, the
#: quantile of that fit (log likelihood per trigram) and the margin below it that texts
#: must keep to count as any language, and the trigrams below which none is rejected.
HELD, LOW, MARGIN, LEAST_GRAMS = 8, 0.001, 1.0, 30

#: Letters: a-z, A-Z lowered, and all bytes of characters beyond ASCII; others are blanks.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


def trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every trigram, blanks in a row counting as one.

    Each text has a blank before and after it.
    """
    sizes = np.diff(at)
    spread = np.full(len(data) + 2 * len(sizes), 0x20, np.uint8)
    of = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes + 2)
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1
    spread[place] = LETTERS[data]
    blank = spread == 0x20
    keep = np.ones(len(spread), bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | (of[1:] != of[:-1])
    spread, of = spread[keep], of[keep]
    if len(spread) < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    whole = of[2:] == of[:-2]
    wide = spread.astype(np.uint32)
    grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    return of[:-2][whole], ((grams * np.uint32(0x9E3779B1)) >> np.uint32(16))[whole]


def lettered(texts: pa.Array, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    plain = (LETTERS[data] != 0x20) & (data < 0x80)
    sums = np.concatenate(([0], np.cumsum(plain)))
    found = sums[at[1:]] > sums[at[:-1]]
    for i in np.flatnonzero(~found & (np.diff(at) > 0)).tolist():
        found[i] = any(map(str.isalpha, texts[i].as_py()))
    return found


@dataclass
class Model:
    """Languages and the probability of each bucket in each, as BUCKETS x languages."""

    languages: list[str]
    chance: np.ndarray
    #: Log likelihood per trigram that texts in a learned language do not fall below.
    floor: float = float("-inf")


def learn(train: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts all trigrams of all rows that have a text and a language.

    One in ``HELD`` of the texts, by hash, is also scored by a model of the others alone:
    how well texts fit their own language sets the floor of the model.
    """
    whole = column(text).cast("string")
    rows = train.filter(column(lang).isNotNull() & column(text).isNotNull()).select(
        column(lang).cast("string").alias("lang"), whole.alias("text"),
        (F.pmod(F.xxhash64(whole), F.lit(HELD)) == 0).cast("int").alias("held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                coded = pc.binary_join_element_wise(
                    piece.column("held").cast(pa.string()), piece.column("lang"), "").dictionary_encode()
                of, bucket = trigrams(*utf8(piece.column("text")))
                codes = coded.indices.to_numpy()[of]
                n = len(coded.dictionary)
                found = np.bincount(codes * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
                for name, row in zip(coded.dictionary.to_pylist(), found):
                    sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name[1:]] * len(used), pa.string()), pa.array(np.full(len(used), int(name[0]), np.int32)),
                 pa.array(used.astype(np.int32)), pa.array(row[used].astype(np.int64))], ["lang", "held", "bucket", "n"])

    sums = (rows.mapInArrow(count, "lang string, held int, bucket int, n long")
            .groupBy("lang", "held", "bucket").agg(F.sum("n").alias("n")))
    names = [r[0] for r in rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((2, BUCKETS, len(names)))
    # At most two rows for each of MAX_LANGUAGES x BUCKETS, however many documents there are.
    table = sums.toArrow()
    place = {name: i for i, name in enumerate(names)}
    langs = table.column("lang").combine_chunks().dictionary_encode()
    if len(table):
        codes = np.array([place[x] for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
        counts[table.column("held").to_numpy(), table.column("bucket").to_numpy(), codes] = table.column("n").to_numpy()
    return Model(names, _chances(counts.sum(axis=0)), _floor(rows.filter("held = 1"), names, _chances(counts[0])))


def _chances(counts: np.ndarray) -> np.ndarray:
    return ((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)


def _floor(rows: DataFrame, names: list[str], chance: np.ndarray) -> float:
    """The least over the languages of a low quantile of their texts' fit, less a margin."""
    sent, place = rows.sparkSession.sparkContext.broadcast(chance), {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                codes = np.array([place[x] for x in piece.column("lang").to_pylist()], np.int64)
                of, bucket = trigrams(*utf8(piece.column("text")))
                logs = np.log(sent.value[bucket, codes[of]], dtype=np.float64)
                n = np.bincount(of, minlength=len(codes))
                some = n >= LEAST_GRAMS
                yield pa.RecordBatch.from_arrays(
                    [piece.column("lang").filter(pa.array(some)),
                     pa.array(np.bincount(of, logs, len(codes))[some] / n[some])], ["lang", "fit"])

    found = (rows.mapInArrow(run, "lang string, fit double").groupBy("lang")
             .agg(F.percentile_approx("fit", LOW, 10_000).alias("low")).agg(F.min("low")).first()[0])
    return float("-inf") if found is None else found - MARGIN


def mixtures(chance: np.ndarray, counts: np.ndarray, starts: np.ndarray,
             allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the allowed languages (texts x languages), log likelihood per text, and a
    bound that no shares of these languages exceed.

    chance: one row per text and bucket, of its probability in each language; a text's
    rows start at its start, and every text has rows. A text whose shares stand still is
    left as it is, so the texts beside it make no difference.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    sizes = np.diff(np.append(starts, len(counts)))
    moving, mine, weight, at = np.arange(len(starts)), chance, counts, starts
    for _ in range(ROUNDS):
        of = np.repeat(moving, sizes[moving])
        each = mine * share[of].astype(np.float32)
        each *= (weight / each.sum(axis=1))[:, None]
        after = np.add.reduceat(each, at, axis=0, dtype=np.float64) / np.add.reduceat(weight, at)[:, None]
        still = np.abs(after - share[moving]).max(axis=1) < CLOSE
        share[moving] = after
        if still.all():
            break
        if still.any():
            keep = np.repeat(~still, sizes[moving])
            moving, mine, weight = moving[~still], mine[keep], weight[keep]
            at = np.concatenate(([0], np.cumsum(sizes[moving])[:-1]))
    likely = np.einsum("ij,ij->i", chance, share[np.repeat(np.arange(len(starts)), sizes)].astype(np.float32))
    logs = np.add.reduceat(counts * np.log(likely, dtype=np.float64), starts)
    # The likelihood is concave: it lies under its tangent, whose greatest value is at one language.
    slope = np.add.reduceat(chance * (counts / likely)[:, None], starts, axis=0, dtype=np.float64)
    slope = np.where(allowed > 0, slope, -np.inf).max(axis=1)
    return share, logs, logs + np.maximum(slope - np.add.reduceat(counts, starts), 0)


def select(model: Model, data: np.ndarray, at: np.ndarray, penalty: float) -> tuple[np.ndarray, ...]:
    """Shares of the selected languages (0 for others), the chance of the first one against
    all other single languages, log likelihood per trigram and trigrams; rows of zeros for
    texts without trigrams."""
    n, k = len(at) - 1, len(model.languages)
    shares, sure, fit, grams = np.zeros((n, k)), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    of, bucket = trigrams(data, at)
    keys = np.sort(of.astype(np.uint64) << np.uint64(16) | bucket)
    if not len(keys) or not k:
        return shares, sure, fit, grams
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(first, len(keys))).astype(np.float64)
    of, bucket = (keys[first] >> np.uint64(16)).astype(np.int64), (keys[first] & np.uint64(0xFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    texts = of[starts]
    chance = model.chance[bucket]
    alone = np.add.reduceat(np.log(chance, dtype=np.float64) * counts[:, None], starts, axis=0)
    best = alone.argmax(axis=1)
    sure[texts] = 1 / np.exp(alone - alone.max(axis=1, keepdims=True)).sum(axis=1)
    won = alone.max(axis=1)  # penalised likelihood of the best set so far
    shares[texts, best] = 1.0
    total = np.add.reduceat(counts, starts)
    cost, best_log = penalty * np.log1p(total), won.copy()
    all_shares, _, bound = mixtures(chance, counts, starts, np.ones((len(starts), k)))
    order = np.argsort(-all_shares, axis=1, kind="stable")
    sizes = np.diff(np.append(starts, len(counts)))
    for size in range(2, k + 1):
        # No set of this size is likelier than the best mixture of all languages.
        open_ = np.flatnonzero(bound - cost * (size - 1) > won)
        if not len(open_):
            break
        allowed = np.zeros((len(open_), k))
        np.put_along_axis(allowed, order[open_, :size], 1.0, axis=1)
        rows = np.repeat(starts[open_], sizes[open_]) + np.concatenate([np.arange(s) for s in sizes[open_]])
        some = np.concatenate(([0], np.cumsum(sizes[open_])[:-1]))
        found, likely, _ = mixtures(chance[rows], counts[rows], some, allowed)
        better = likely - cost[open_] * (size - 1) > won[open_]
        won[open_[better]] = (likely - cost[open_] * (size - 1))[better]
        best_log[open_[better]] = likely[better]
        shares[texts[open_[better]]] = found[better]
    fit[texts], grams[texts] = best_log / total, total
    return shares, sure, fit, grams


def languages(docs: DataFrame, model: Model, text: str = "text", penalty: float = 1.5,
              keep: list[str] | str | None = None) -> DataFrame:
    """The kept columns, lang_pred, score, share, languages and fits of every row.

    languages: the selected set with shares, greatest first; lang_pred and share: its
    first; score: that share, times the chance of the language against other single
    ones where it is alone; fits: whether the text is about as likely as texts of the learned
    languages are, which gibberish and other languages are not (true for very short texts).
    A text that is null or has no letter, or any text of an
    empty model, is ``und`` with score and share 0 and no languages. Computed columns
    take the place of input columns of their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = sent.value
        item = pa.struct([("lang", pa.string()), ("share", pa.float64())])

        def compute(texts: pa.Array) -> list[pa.Array]:
            data, at = utf8(texts)
            shares, sure, fit, grams = select(known, data, at, penalty)
            fits = (fit >= known.floor) | (grams < LEAST_GRAMS)
            good = lettered(texts, data, at) & (shares.sum(axis=1) > 0)
            names, score, share, sets = [], [], [], []
            for i in range(len(at) - 1):
                row = [] if not good[i] else sorted(
                    ((-s, known.languages[j]) for j, s in enumerate(shares[i].tolist()) if s > 0))
                names.append(row[0][1] if row else "und")
                share.append(min(1.0, -row[0][0]) if row else 0.0)
                score.append(share[-1] * (float(sure[i]) if len(row) == 1 else 1.0))
                sets.append([{"lang": name, "share": -s} for s, name in row])
            return [pa.array(names, pa.string()), pa.array(score), pa.array(share), pa.array(sets, pa.list_(item)),
                    pa.array(fits)]
        return compute

    return with_text_columns(
        docs, text, "lang_pred string, score double, share double, "
                    "languages array<struct<lang:string,share:double>>, fits boolean", make, keep)


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with letters that fit the learned languages, mixtures included; same columns.

    Null and empty texts go, repeated rows stay as often as they are there, texts of any
    length are read whole, columns of any names are kept as they are, and an empty table
    gives an empty one.
    """
    found = languages(docs, model, text, keep=WHOLE)
    return found.filter((F.col("lang_pred") != "und") & F.col("fits")).select(f"{WHOLE}.*")
