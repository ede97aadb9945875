"""Mixing documents to target token shares per domain, by soft membership.

A classifier learnt from a labelled table gives each document a probability of each
domain. A document's expected tokens in a domain are its tokens times that; projected
gradient steps fit a rate of at least zero per document, so that the rates' expected
tokens per domain meet the targets by least squares. A step needs only the domains'
totals, so each pass is one sum over all documents; a document's rate is replayed from
the steps so far, and no state per document is kept.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import WHOLE, column, pieces, settle, utf8, with_text_columns
from tidegauge.llm.decontaminate import FOLD, words_of

#: Words are hashed to 2**BITS buckets; the classifier has one weight per domain and bucket.
BITS = 15
REPEATED, MARKS = 1 << BITS, (1 << BITS) + 1
BUCKETS = MARKS + 128
SMOOTHING = 0.5
#: Text lengths (words) up to which evidence adds up in full; the best one is fitted.
TEMPERS = (10.0, 30.0, 100.0, 300.0, 1000.0, 3000.0)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every word, mark and repetition; words of each text.

    Marks (ASCII characters that are no part of a word and no blank) and words that
    repeat the one before have buckets of their own.
    """
    data, at = utf8(texts)
    words = words_of(data, at)
    of_word = np.repeat(np.arange(len(at) - 1), np.diff(words.first))
    bucket = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    again = np.flatnonzero((words.hashes[1:] == words.hashes[:-1]) & (of_word[1:] == of_word[:-1]))
    mark = np.flatnonzero((FOLD[data] == 0) & (data > 0x20))
    of_mark = np.searchsorted(at, mark, "right") - 1
    return (np.concatenate((of_word, of_word[again], of_mark)),
            np.concatenate((bucket, np.full(len(again), REPEATED), MARKS + data[mark].astype(np.int64))),
            np.diff(words.first))


@dataclass
class Domains:
    """Naive Bayes over hashed words; evidence is weighed as of at most ``temper`` words."""

    names: list[str]
    prior: np.ndarray
    weights: np.ndarray  # buckets x domains
    temper: float = 100.0

    def evidence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        of, bucket, n = features(texts)
        sums = np.stack([np.bincount(of, self.weights[bucket, k], len(n)) for k in range(len(self.names))], axis=1)
        return sums, n

    def posterior(self, sums: np.ndarray, n: np.ndarray, temper: float | None = None) -> np.ndarray:
        scale = 1 / np.maximum(1.0, n / (temper or self.temper))
        logs = np.log(self.prior) + sums * scale[:, None]
        each = np.exp(logs - logs.max(axis=1, keepdims=True))
        return each / each.sum(axis=1, keepdims=True)


def learn_domains(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text: str = "text",
                  domain: str = "domain", most_labelled: int = 20_000) -> Domains:
    """Fits the classifier on at most ``most_labelled`` rows of ``labelled`` (id, domain),
    those of least hash of their id; every fifth of them only fits the temper.

    Rows without id or domain are left out; without any labelled row there is one domain,
    the empty name.
    """
    spark = docs.sparkSession
    picked = (labelled.select(column(id_col).alias("id"), column(domain).cast("string").alias("domain"))
              .filter("id is not null and domain is not null").withColumn("h", F.xxhash64("id"))
              .orderBy("h", "id", "domain").limit(most_labelled))
    # The sample is at most most_labelled short rows.
    rows = settle(docs.select(column(id_col).alias("id"), column(text).cast("string").alias("text"))
                  .join(F.broadcast(picked), "id").withColumn("fits", F.pmod("h", F.lit(5)) > 0)
                  .select("text", "domain", "fits"), "labelled")
    names = sorted(r[0] for r in rows.select("domain").distinct().collect())
    if not names:
        return Domains([""], np.ones(1), np.zeros((BUCKETS, 1)))
    place = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), BUCKETS + 1), np.int64)  # last: documents
        for batch in batches:
            for piece in pieces(batch, "text"):
                text, bucket, _ = features(piece.column("text"))
                of = np.array([place[d] for d in piece.column("domain").to_pylist()], np.int64)
                np.add.at(sums[:, -1], of, 1)
                np.add.at(sums, (of[text], bucket), 1)
        for i, row in enumerate(sums):
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), i, np.int32)),
                                              pa.array(used.astype(np.int32)), pa.array(row[used])],
                                             ["domain", "bucket", "n"])

    # At most domains x buckets rows.
    table = (rows.filter("fits").mapInArrow(count, "domain int, bucket int, n long")
             .groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((BUCKETS + 1, len(names)))
    counts[table.column("bucket").to_numpy(), table.column("domain").to_numpy()] = table.column("n").to_numpy()
    seen, counts = counts[-1] + 1, counts[:-1] + SMOOTHING
    logs = np.log(counts / counts.sum(axis=0))
    model = Domains(names, seen / seen.sum(), logs - logs.mean(axis=1, keepdims=True))
    sent = spark.sparkContext.broadcast(model)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = sent.value, np.zeros(len(TEMPERS))
        for batch in batches:
            for piece in pieces(batch, "text"):
                evidence, n = known.evidence(piece.column("text"))
                of = np.array([place[d] for d in piece.column("domain").to_pylist()], np.int64)
                for i, temper in enumerate(TEMPERS):
                    p = known.posterior(evidence, n, temper)
                    sums[i] -= np.log(np.maximum(p[np.arange(len(of)), of], 1e-12)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(TEMPERS), dtype=np.int32)), pa.array(sums)],
                                         ["temper", "loss"])

    loss = rows.filter("not fits").mapInArrow(losses, "temper int, loss double").groupBy("temper").agg(
        F.sum("loss").alias("loss")).collect()
    if loss:
        model.temper = TEMPERS[min(loss, key=lambda r: (r["loss"], r["temper"]))["temper"]]
    return model


@dataclass
class Steps:
    """The gradient steps so far: a step per pass, in expected tokens of each domain, and
    the momentum after it. gap: by how much the totals still miss the targets, as shares
    of the budget."""

    size: float
    most: float
    history: list[np.ndarray] = field(default_factory=list)
    momentum: list[float] = field(default_factory=list)
    gap: np.ndarray | None = None

    def rates(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates after all steps, and the point where the next gradient is taken."""
        rate = before = ahead = np.ones(len(p))
        for slope, push in zip(self.history, self.momentum):
            rate = np.clip(ahead - self.size * (p @ slope), 0.0, self.most)
            ahead = rate + push * (rate - before)
            before = rate
        return rate, ahead


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_rates(members: DataFrame, targets: list[float], budget: float = 1.0, most: float = np.inf,
              near: float = 1e-3, passes: int | None = None) -> Steps:
    """Rates of at least 0 (and at most ``most``, if given) for rows of p (probability per
    domain) and n_tokens.

    Targets are shares per domain of ``budget`` times all tokens. Starts from
    rate 1 for every document and stops when the expected totals are within ``near`` of
    the budget, or where no step leads closer: ``gap`` has what remains, with a warning if
    it is more than that. ``passes`` may bound the steps. Rows without tokens take the
    rate of their p. Without any tokens no step is taken.

    Steps are first scaled by the inverse of the domains' curvature, so that a rare domain
    takes no more of them than a common one; where these settle short of the targets,
    plain ones go on to the least squares.
    """
    k = len(targets)
    both = [F.sum(F.col("n_tokens") * F.element_at("p", i + 1) * F.element_at("p", j + 1)).alias(f"m{i}_{j}")
            for i in range(k) for j in range(k)]
    first = members.agg(F.sum("n_tokens").alias("n"), *both).first()
    if not first["n"]:
        return Steps(0.0, most)
    budget *= float(first["n"])
    want = np.array(targets) / sum(targets) * budget
    # Steps are per token of a document, so the curvature is that of p p' summed by tokens.
    curve = np.array([[first[f"m{i}_{j}"] for j in range(k)] for i in range(k)]) / budget
    steps = Steps(1 / float(np.linalg.eigvalsh(curve)[-1]), most)
    scales = [np.linalg.pinv(curve, rcond=1e-12, hermitian=True) / steps.size, np.eye(k)]

    def sums(of, width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = of(matrix(batch.column("p"), k), batch.column("n_tokens").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([0.0 + x]) for x in found], [f"s{i}" for i in range(width)])
        schema = ", ".join(f"s{i} double" for i in range(width))
        return np.array(members.select("p", "n_tokens").mapInArrow(run, schema).agg(
            *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).first())

    def totals(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.concatenate([(n * r) @ p for r in steps.rates(p)])

    scale, last, turn = scales.pop(0), np.inf, 0
    while True:
        got = sums(totals, 2 * k)
        steps.gap, slope = (got[:k] - want) / budget, scale @ ((got[k:] - want) / budget)
        if np.abs(steps.gap).max() <= near or len(steps.history) == passes:
            break
        here = scale @ steps.gap

        def left(p: np.ndarray, n: np.ndarray) -> list[float]:
            rate = steps.rates(p)[0]
            return [n @ np.square(rate - np.clip(rate - steps.size * (p @ here), 0.0, most))]
        # How far a step from here, without momentum, would still move the rates.
        if len(steps.history) % 10 == 9 and np.sqrt(sums(left, 1)[0] / first["n"]) <= near * 1e-2:
            if not scales:
                break
            scale, last, turn = scales.pop(0), np.inf, 0
            slope = scale @ ((got[k:] - want) / budget)
            here = scale @ steps.gap
        # Momentum starts anew when a step led away.
        worth = float(here @ steps.gap)
        turn, last = (0 if worth > last else turn + 1), worth
        steps.history.append(slope)
        steps.momentum.append(max(0, turn - 1) / (turn + 2))
    if np.abs(steps.gap).max() > near:
        warnings.warn(f"the mix misses its targets by {steps.gap.round(4).tolist()} of the budget", stacklevel=2)
    return steps


MIXED = "n_tokens long, p array<double>, rate double"


def with_rates(docs: DataFrame, model: Domains, steps: Steps, text: str = "text",
               keep: list[str] | str | None = None) -> DataFrame:
    """The kept columns, n_tokens (words), p (per domain of the model) and rate. Null and
    empty texts have no tokens and the prior as p. Computed columns take the place of
    input columns of their names."""
    sent = docs.sparkSession.sparkContext.broadcast((model, steps))

    def make():
        known, done = sent.value
        k = len(known.names)

        def compute(texts: pa.Array) -> list[pa.Array]:
            sums, n = known.evidence(texts)
            p = known.posterior(sums, n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * k), pa.array(p.ravel()))
            return [pa.array(n), lists, pa.array(done.rates(p)[0])]
        return compute

    return with_text_columns(docs, text, MIXED, make, keep)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float = 1.0,
        id_col: str = "doc_id", text: str = "text", domain: str = "domain", most: float = np.inf, most_labelled: int = 20_000) -> tuple[Domains, Steps]:
    """The classifier and the fitted steps for target shares by domain (others: 0);
    a warning and ``gap`` of the steps tell of targets that are missed."""
    model = learn_domains(docs, labelled, id_col, text, domain, most_labelled)
    members = settle(with_rates(docs, model, Steps(0.0, most), text, []).select("p", "n_tokens"), "members")
    targets = [weights.get(name, 0.0) for name in model.names]
    return model, fit_rates(members, targets if sum(targets) else [1.0] * len(targets), budget, most)


def copies(rate: str, id_col: str) -> Column:
    """How often a document goes into the mix: its rate, rounded up or down by a hash of
    its id so that the expected number is the rate."""
    chance = F.pmod(F.xxhash64(column(id_col), F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(column(rate) + chance).cast("int")


def mixed_documents(docs: DataFrame, model: Domains, steps: Steps, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Each row as often as its rate asks for (not at all, once, or more); same columns."""
    found = with_rates(docs, model, steps, text, WHOLE).withColumn("__id", F.col(WHOLE).getField(id_col))
    return (found.withColumn("__n", copies("rate", "__id")).filter("__n > 0")
            .select(WHOLE, F.explode(F.array_repeat(F.lit(0), F.col("__n")))).select(f"{WHOLE}.*"))
