"""Quality scores learned from preference pairs (Bradley-Terry).

A pair is a document labelled good and one labelled bad. The good one is preferred with probability
sigmoid(w . (x_good - x_bad)); w minimises the mean logistic loss over pairs plus a small ridge, by
Newton's method on feature differences. The score of a document, w . x, needs no intercept: pairs
cannot tell one. The threshold is a quantile of the scores of all labelled documents that may be
learned from, at the share of bad labels among them, halfway to the next score above it.

Scores leave as sigmoid(w . x - threshold + log(CUT / (1 - CUT))), so that a score of CUT or more
means "kept" and the order stays.

Only the weights are learned from a bounded sample: at most SAMPLE documents of each label, those
with the least hash of their id. Share and quantile are taken over all labelled documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, on_texts, written

SAMPLE = 10_000
#: Pairs for each sampled document of the larger class.
PARTNERS = 8
RIDGE = 1e-3
CUT = 0.3
SEED = 6

FEATURES = [
    "words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "marks",
    "bars",
    "stops",
    "commas",
    "distinct",
    "same_as_last",
    "top_word",
    "repeated_triples",
    "repeated_lines",
    "symbol_words",
    "line_words",
]

#: Classes of bytes: fixed by the features' names.
_CLASSES = {
    "upper": bytes(range(65, 91)),
    "digits": b"0123456789",
    "symbols": b"#*$%&<>@~^{}[]\\_=+",
    "marks": b"!?",
    "bars": b"|",
    "stops": b".",
    "commas": b",;:",
}
_OTHER = {name: bytes(set(range(256)) - set(chars)) for name, chars in _CLASSES.items()}


def features(text: bytes | None) -> list[float]:
    """Shares and logarithms that say how a text is written; all zero for a text without words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    share = {name: len(text.translate(None, rest)) for name, rest in _OTHER.items()}
    ends = b"".join([w[-1:] for w in words])
    counts = Counter(words)
    last = sum(map(eq, words, words[1:]))
    triples = max(0, n - 2)
    distinct_triples = len(set(zip(words, words[1:], words[2:])))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        np.log1p(n),
        (size - n) / n / 10,
        share["upper"] / size,
        share["digits"] / size,
        share["symbols"] / size,
        share["marks"] / size,
        share["bars"] / n,
        share["stops"] / n,
        share["commas"] / n,
        len(counts) / n,
        last / n,
        max(counts.values()) / n,
        (triples - distinct_triples) / max(1, triples),
        (len(lines) - len(set(lines))) / len(lines),
        len(ends.translate(None, _OTHER["symbols"])) / n,
        np.log1p(n / len(lines)),
    ]


def _vectors(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


def _feature_lists(texts: list[bytes | None]) -> pa.Array:
    return pa.array(_vectors(texts).tolist(), type=pa.list_(pa.float64()))


feature_column = on_texts(_feature_lists, pa.list_(pa.float64()))


@dataclass
class Ranking:
    """Feature means, deviations and weights; and the score that is the threshold."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0

    def raw(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.mean) / self.deviation) @ self.weights

    def score(self, vectors: np.ndarray) -> np.ndarray:
        shifted = self.raw(vectors) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


def learn(good: np.ndarray, bad: np.ndarray) -> Ranking:
    """Weights from all given vectors; zero if there is no pair."""
    both = np.concatenate([good, bad])
    mean, deviation = np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    if len(both):
        mean, deviation = both.mean(0), both.std(0)
        deviation = np.where(deviation > 1e-9, deviation, 1.0)
    weights = np.zeros(len(FEATURES))
    if not len(good) or not len(bad):
        return Ranking(mean, deviation, weights)
    rng = np.random.default_rng(SEED)
    pairs = PARTNERS * max(len(good), len(bad))
    spread = np.arange(pairs)
    x = (good[spread % len(good)] - bad[rng.integers(0, len(bad), pairs)]) / deviation
    if len(bad) > len(good):
        x = (good[rng.integers(0, len(good), pairs)] - bad[spread % len(bad)]) / deviation
    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(x @ weights, -500, 500)))
        gradient = -(x * p[:, None]).mean(0) + RIDGE * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x / pairs + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step).max())
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return Ranking(mean, deviation, weights)


def vectors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, x): the features of every document, written once. They are all that is joined with labels,
    so no text is shuffled."""
    rows = docs.select(F.col(id_column).alias("id"), feature_column(F.col(text_column)).alias("x"))
    return written(rows, "features")


def _ranked(ranking: Ranking, method: str, x: Column) -> Column:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.asarray(batch.flatten()).reshape(-1, len(FEATURES))
            yield pa.array(getattr(ranking, method)(found))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returnType="double")(x)


def score(ranking: Ranking, x: Column) -> Column:
    """0 to 1; a text without words has the score of zero features."""
    return _ranked(ranking, "score", x)


def fit(known: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality") -> Ranking:
    """Learn from vectors (id, x) whose id has a label of 0 or 1.

    Other labels and null ids are left out; an id with several labels counts once for each. Without a
    label of either kind there is nothing to rank: every weight is zero, all documents score CUT and
    are kept.
    """
    chosen = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    rows = written(known.join(chosen.where("label in (0, 1)"), "id"), "labelled")
    sampled = {}
    for label in (0, 1):
        least = rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), F.xxhash64("x")).limit(SAMPLE)
        sampled[label] = np.array([r["x"] for r in least.select("x").collect()]).reshape(-1, len(FEATURES))
    ranking = learn(sampled[1], sampled[0])
    if not len(sampled[0]) or not len(sampled[1]):
        return ranking
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == 0).cast("long")).alias("bad")).first()
    share = [counts["bad"] / counts["n"], min(1.0, (counts["bad"] + 1) / counts["n"])]
    scored = rows.select(_ranked(ranking, "raw", F.col("x")).alias("raw"))
    below, above = scored.agg(F.percentile_approx("raw", share, 100_000)).first()[0]
    ranking.threshold = (below + above) / 2
    return ranking


def keep(docs: DataFrame, ranking: Ranking, text_column: str = "text") -> DataFrame:
    """The documents that score CUT or more, all columns as they are."""
    (name,) = fresh(docs, "score")
    kept = on_texts(lambda texts: pa.array(ranking.score(_vectors(texts))), pa.float64())
    scored = docs.withColumn(name, kept(F.col(text_column)))
    return scored.where(F.col(name) >= CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
