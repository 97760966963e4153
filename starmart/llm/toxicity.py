"""Toxicity by non-negative positive-unlabelled learning.

A text's features are its words and their beginnings, which words of one stem share.

Method: confirmed toxic documents are the positives, other documents are unlabelled, and the share of
toxic ones among all labelled rows is the class prior. Numpy classifiers (logistic, on which features
a text has) minimise the prior-corrected risk, whose part for negatives may not fall below zero: where
it would, a step goes the other way. The mean of their probabilities is the score.

Fitting takes a bounded sample of rows (``POSITIVES``, ``UNLABELLED``) in the order of a hash of the
id; the prior counts all labels and all documents are scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import alnum_words, lean_batches, text_slices
from starmart.session import stored

POSITIVES = 6_000
UNLABELLED = 18_000
WORDS = 3_000  # words of the classifiers, at most
MIN_Z = 5.0
MIN_TOXIC = 0.6
CLASSIFIERS = 3
STEPS = 400
RATE = 0.1
DECAY = 1e-4
CUT = 0.7
COPY_HASHES = 3
BEGINNINGS = (4, 5, 6, 7, 8)


def features(text: bytes) -> set[bytes]:
    """The words of a text, and the first ``BEGINNINGS`` bytes of longer ones with a mark."""
    found = set(alnum_words(text))
    return found.union(*({w[:n] + b"*" for w in found if len(w) > n} for n in BEGINNINGS))


def _risk_step(weights: np.ndarray, moments: list[np.ndarray], step: int, gradient: np.ndarray) -> None:
    """One Adam step, in place."""
    moments[0] += 0.1 * (gradient - moments[0])
    moments[1] += 0.001 * (gradient * gradient - moments[1])
    weights -= RATE * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)


def fit_classifier(rows: list[np.ndarray], positive: np.ndarray, prior: float, n_words: int,
                   steps: int = STEPS) -> np.ndarray:
    """Weights of the words and, last, the bias. rows: the numbers of the words in each text.

    With g the logit and the logistic loss, the risk is prior * E+[loss(g)] + max(0, E_u[loss(-g)] -
    prior * E+[loss(-g)]).
    """
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    words = np.concatenate(rows).astype(np.int64) if len(of) else np.zeros(0, np.int64)
    share = np.where(positive, prior / max(1, positive.sum()), 0.0)
    unlabelled = np.where(~positive, 1 / max(1, (~positive).sum()), 0.0)
    weights, moments = np.zeros(n_words + 1), [np.zeros(n_words + 1), np.zeros(n_words + 1)]
    weights[-1] = math.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        logit = np.bincount(of, weights[words], len(rows)) + weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        negative_loss = np.logaddexp(0, logit)
        negative_risk = ((unlabelled - share) * negative_loss).sum()
        slope = (unlabelled - share) * chance
        slope = share * (chance - 1) + slope if negative_risk >= 0 else -slope
        gradient = np.append(np.bincount(words, slope[of], n_words), slope.sum())
        gradient[:-1] += DECAY * weights[:-1]
        _risk_step(weights, moments, step, gradient)
    return weights


class Model:
    """Word weights of each classifier; without positives every text scores about zero."""

    def __init__(self, weights: dict[bytes, np.ndarray], bias: np.ndarray) -> None:
        self.weights, self.bias = weights, bias

    def score(self, text: bytes) -> float:
        logit = self.bias.copy()
        for word in self.weights.keys() & features(text):
            logit += self.weights[word]
        return float((1 / (1 + np.exp(-np.clip(logit, -30, 30)))).mean())


def _least_shingles(text: Column) -> Column:
    """The smallest hashes of a text's three-word shingles, one per seed: near copies share most."""
    @F.arrow_udf("array<long>")
    def least(column: pa.Array) -> pa.Array:
        from xxhash import xxh32_intdigest

        found, column = [], column.cast(pa.large_binary())
        for at in range(len(column)):
            words = alnum_words(column[at].as_py() or b"")
            grams = {b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))}
            found.append([min(xxh32_intdigest(g, seed) for g in grams) for seed in range(COPY_HASHES)])
        return pa.array(found, pa.list_(pa.int64()))

    return least(text)


def _samples(docs: DataFrame, labels: DataFrame, may_learn: Column, positives: int,
             unlabelled: int) -> DataFrame:
    """(doc_id, text, positive), at most ``positives`` and ``unlabelled`` rows of each kind, of near
    copies the first in the order of the hash of the id, so that every run and partitioning learns the same."""
    ids = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    toxic = ids(labels.where((F.col("toxic") == 1) & may_learn).select("doc_id").distinct(), positives)
    other = ids(docs.where(may_learn & F.col("doc_id").isNotNull()).select("doc_id").distinct(), unlabelled)
    chosen = stored(toxic.withColumn("positive", F.lit(True)).unionByName(
        other.withColumn("positive", F.lit(False))), "toxicity-ids")
    texts = docs.where(may_learn).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # A word of a text with many near copies would pass for one that many texts hold.
    hashed = texts.withColumn("hashes", _least_shingles(F.col("text")))
    # The winner is the first by the order of the sample, whatever task meets the copies.
    row = F.struct(F.xxhash64("doc_id").alias("rank"), "doc_id", "text", "hashes")
    for k in range(COPY_HASHES):
        hashed = (hashed.groupBy("positive", F.col("hashes")[k].alias("hash")).agg(F.min(row).alias("row"))
                  .select("positive", "row.doc_id", "row.text", "row.hashes"))
    return stored(hashed.select("doc_id", "text", "positive"), "toxicity-sample")


def _telling_words(sample: DataFrame, words: int, min_z: float, prior: float) -> list[bytes]:
    """Features that positives have more often than unlabelled texts do, by a test of two shares, and
    of whose texts at least ``MIN_TOXIC`` are toxic: prior * share of positives / share of unlabelled."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for flags, texts in text_slices(batch):
                found = [(w, flag) for flag, text in zip(flags, texts) for w in features(text)]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()),
                                                  pa.array([f for _, f in found], pa.bool_())], ["word", "positive"])

    sizes = sample.agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).first()
    held = (sample.select("positive", "text").mapInArrow(split, "word binary, positive boolean")
            .groupBy("word").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")))
    share = (F.col("p") + F.col("u")) / F.lit(float(sizes["p"] + sizes["u"]) or 1.0)
    spread = F.sqrt(share * (1 - share) * F.lit(1 / max(1, sizes["p"]) + 1 / max(1, sizes["u"])))
    z = (F.col("p") / F.lit(max(1, sizes["p"])) - F.col("u") / F.lit(max(1, sizes["u"]))) / F.nullif(spread, F.lit(0.0))
    toxic = F.lit(prior * sizes["u"] / max(1, sizes["p"])) * F.col("p") >= MIN_TOXIC * F.col("u")
    rows = held.withColumn("z", z).where((F.col("p") >= 5) & (F.col("z") >= min_z) & toxic).orderBy(
        F.desc("z"), "word").limit(words).select("word").collect()
    return [bytes(row["word"]) for row in rows]


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, positives: int = POSITIVES,
        unlabelled: int = UNLABELLED, words: int = WORDS, min_z: float = MIN_Z,
        classifiers: int = CLASSIFIERS) -> Model:
    """A model from the rows of documents and labels for which ``may_learn`` (of doc_id) holds.

    Each classifier leaves out another part of the sample. The driver gets the chosen words and, per
    sampled text, their numbers. A document with several labels is toxic if one says so.
    """
    lean_batches(docs)
    counted = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic")).agg(F.count(F.lit(1)).alias("n"),
                                                         F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    if not counted["toxic"]:
        return Model({}, np.full(1, -30.0))
    prior = min(0.9, counted["toxic"] / counted["n"])
    sample = _samples(docs, labels, may_learn, positives, unlabelled)
    chosen = _telling_words(sample, words, min_z, prior)
    numbers = {word: k for k, word in enumerate(chosen)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for flags, texts in text_slices(batch):
                found = [sorted(numbers[w] for w in numbers.keys() & features(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(flags, pa.bool_()), pa.array(found, pa.list_(pa.int32()))],
                                                 ["positive", "words"])

    rows = sample.select("positive", "text").mapInArrow(numbered, "positive boolean, words array<int>").collect()
    rows.sort(key=lambda r: (r["positive"], r["words"]))
    lists = [np.array(r["words"], np.int64) for r in rows]
    flags = np.array([r["positive"] for r in rows], bool)
    weights = []
    for left_out in range(classifiers):
        use = [k for k in range(len(rows)) if classifiers == 1 or k % classifiers != left_out]
        weights.append(fit_classifier([lists[k] for k in use], flags[use], prior, len(chosen)))
    table = np.stack(weights)
    return Model({word: table[:, k] for word, k in numbers.items()}, table[:, -1])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): one row per input row, the probability of toxic; texts are not shuffled.

    Null and empty texts score what the biases say. Repeated rows and rows without doc_id are scored
    by their own text. Extra columns are ignored; an empty table gives an empty one.
    """
    lean_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        made, column = Model(*sent.value), column.cast(pa.large_binary())
        return pa.array([made.score(column[at].as_py() or b"") for at in range(len(column))], pa.float64())

    return docs.select("doc_id", scored("text").alias("score"))
