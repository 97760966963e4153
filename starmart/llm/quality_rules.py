"""Quality rules as weak supervision.

Method: each rule votes good, bad, or abstains; expectation-maximisation over the counts of vote
patterns of the whole corpus estimates how often each rule votes what on good and on bad documents;
the posterior probability of good then decides, in place of asking that all rules pass. There are at
most 3 ** rules patterns, so the estimate runs on a table of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import lean_batches, own_names, plain_words
from starmart.session import stored

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
           "n_capitals", "n_exclaims")
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_SPACES_AND_TAILS = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ROUNDS = 200
FALSE_ALARMS = 0.01

# Each rule: name, when it votes bad, when it votes good (else it abstains).
Rule = tuple[str, Callable[..., Column], Callable[..., Column]]
RULES: tuple[Rule, ...] = (
    ("symbols", lambda s: 10 * s["n_symbols"] > s["n_words"], lambda s: 50 * s["n_symbols"] <= s["n_words"]),
    ("capitals", lambda s: 10 * s["n_capitals"] > 3 * s["n_letters"],
     lambda s: 20 * s["n_capitals"] <= 3 * s["n_letters"]),
    ("exclaims", lambda s: 10 * s["n_exclaims"] > s["n_words"], lambda s: 50 * s["n_exclaims"] <= s["n_words"]),
    ("repeats", lambda s: 100 * s["n_repeat_words"] > 40 * s["n_words"],
     lambda s: 100 * s["n_repeat_words"] <= 35 * s["n_words"]),
    ("lines", lambda s: 10 * s["n_dup_lines"] > 6 * s["n_lines"], lambda s: 10 * s["n_dup_lines"] <= 5 * s["n_lines"]),
    ("word_length", lambda s: (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 15 * s["n_words"]),
     lambda s: s["word_chars"].between(3 * s["n_words"], 11 * s["n_words"])),
)


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found at least twice, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, at, found = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        _, at, found = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True,
                                 return_counts=True)
    again = found[at.reshape(-1)] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + n] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The ``SIGNALS`` of one text."""
    words = plain_words(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = lambda drop: len(text) - len(text.translate(None, drop))
    capitals = without(_CAPITALS)
    return (len(words), len(text.translate(None, _SPACES_AND_TAILS)), without(b"#*$%&|<>"),
            len(lines) - len(set(lines)), repeat_words(words), len(lines), capitals + without(_SMALL), capitals,
            text.count(b"!"))


def signals(text: Column) -> Column:
    """A struct of the ``SIGNALS`` (long) of a text column; null text is empty."""
    kind = pa.struct([(name, pa.int64()) for name in SIGNALS])

    @F.arrow_udf(", ".join(f"{name} long" for name in SIGNALS).join(("struct<", ">")).replace(" long", ":long"))
    def measured(column: pa.Array) -> pa.Array:
        column = column.cast(pa.large_binary())
        found = [measure(column[at].as_py() or b"") for at in range(len(column))]
        values = np.array(found, np.int64).reshape(-1, len(SIGNALS))
        return pa.StructArray.from_arrays([pa.array(values[:, k]) for k in range(len(SIGNALS))], fields=list(kind))

    return measured(text)


def votes(found: Column, rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """One column per rule: 1 good, -1 bad, 0 abstains."""
    return [F.when(bad(found), -1).when(good(found), 1).otherwise(0).alias(name) for name, bad, good in rules]


def base_failed(found: Column) -> Column:
    return ((found["n_words"] < MIN_WORDS)
            | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]))


class LabelModel:
    """How often each rule votes -1, 0, 1 on good documents and on each kind of bad ones.

    Bad documents come in kinds that different rules notice, so the rules' votes are not independent
    given just "bad": class 0 is good, class j is bad in the way of rule j, and within a class votes
    are independent. A kind that one rule alone notices looks like that rule's errors, so a rule is held
    to vote bad on ``FALSE_ALARMS`` of the good documents at most. Accuracies follow from these votes.
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> None:
        """patterns: (n, rules) of -1, 0, 1, all different; counts: documents with each.

        The start holds patterns without a bad vote to be good and shares the others among the kinds
        of the rules that vote bad; each class's votes are smoothed with one document. No documents:
        all classes are equally likely and votes tell nothing.
        """
        order = np.lexsort(patterns.T[::-1]) if len(patterns) else slice(0)
        patterns, counts = patterns[order], counts[order].astype(float)
        n_rules = patterns.shape[1]
        self.shares = np.full(1 + n_rules, 1 / (1 + n_rules))
        self.votes = np.full((1 + n_rules, n_rules, 3), 1 / 3)
        if not counts.sum():
            return
        one_hot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
        bad = (patterns < 0).astype(float)
        good = np.where(bad.any(1), 0.02, 0.98)
        kinds = np.where(bad.any(1)[:, None], bad, 1.0)
        belief = np.column_stack([good, (1 - good)[:, None] * kinds / kinds.sum(1, keepdims=True)])
        for _ in range(rounds):
            weights = belief.T * counts
            self.votes = np.einsum("cn,nrv->crv", weights, one_hot) + 1 / 3
            self.votes /= self.votes.sum(2, keepdims=True)
            alarms = self.votes[0, :, 0].copy()
            self.votes[0] *= ((1 - np.minimum(alarms, FALSE_ALARMS)) / (1 - alarms))[:, None]
            self.votes[0, :, 0] = np.minimum(alarms, FALSE_ALARMS)
            self.shares = (weights.sum(1) + 1) / (counts.sum() + 1 + n_rules)
            log = np.einsum("crv,nrv->nc", np.log(self.votes), one_hot) + np.log(self.shares)
            last, belief = belief, np.exp(log - log.max(1, keepdims=True))
            belief /= belief.sum(1, keepdims=True)
            if np.abs(last - belief).max() < 1e-9:
                break

    def accuracies(self) -> np.ndarray:
        """Per rule the probability that a vote which it casts is right."""
        bad, good = self.votes[1:, :, 0] * self.shares[1:, None], self.votes[0, :, 2] * self.shares[0]
        cast = (self.votes[:, :, [0, 2]] * self.shares[:, None, None]).sum((0, 2))
        return (bad.sum(0) + good) / cast

    def posterior(self, cast: list[Column]) -> Column:
        """The probability of good; each kind's log odds against good are a sum over the rules."""
        log = np.log(self.votes)
        against = F.lit(1.0)
        for kind in range(1, len(self.shares)):
            odds = F.lit(math.log(self.shares[kind] / self.shares[0]))
            for rule, vote in enumerate(cast):
                bad, none, good = (float(x) for x in log[kind, rule] - log[0, rule])
                odds = odds + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
            against = against + F.exp(odds)
        return 1 / against


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> LabelModel:
    """The model of a table with a column ``found`` of signals; it fetches a row per vote pattern."""
    names = [name for name, _, _ in rules]
    rows = measured.select(*votes(F.col("found"), rules)).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    return LabelModel(np.array([[r[n] for n in names] for r in rows], int).reshape(-1, len(rules)),
                      np.array([r["n"] for r in rows], float))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found, quality, base_failed, kept): one row per input row.

    quality is the posterior probability; kept needs at least one half and not base_failed. Null or
    empty text has no words and fails. Rows that repeat, or have no doc_id, are judged by their own
    text. Extra columns are ignored; an empty table gives an empty one.
    """
    lean_batches(docs)
    measured = stored(docs.select("doc_id", signals(F.col("text")).alias("found")), "signals")
    found = F.col("found")
    return (measured.withColumn("quality", fit(measured, rules).posterior(votes(found, rules)))
            .withColumn("base_failed", base_failed(found))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))


@own_names
def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps; texts are not shuffled.

    The texts are measured once for the counts and once more for the verdict of their own row.
    """
    lean_batches(docs)
    model = fit(docs.select(signals(F.col("text")).alias("found")), rules)
    row = "__signals"
    judged = docs.withColumn(row, signals(F.col("text")))
    kept = ~base_failed(F.col(row)) & (model.posterior(votes(F.col(row), rules)) >= 0.5)
    return judged.where(kept).drop(row)
