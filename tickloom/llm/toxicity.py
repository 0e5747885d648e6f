"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its terms: its lower-cased words and the beginnings of them (3 to 7 characters,
so that inflected forms of one stem share a term), each hashed into one of BUCKETS. Its margin is

    bias + sum of w[i] + sum over pairs i < j of <v[i], v[j]>

over the chosen terms it has. The pairs say what additive weights cannot: that an insult beside the
mention of a group weighs more than both alone, or that a word takes another's weight away.

Only learning is bounded: from at most SAMPLE documents of each label, those with the least hash of their
id. Terms are chosen from the sample by the likelihood ratio of their document counts (G squared of at
least LEAST_RATIO, the TERMS highest), counted on the executors; the driver gets one count per
bucket and label, then the chosen terms of the sampled documents. Weights and factors minimise the logistic
loss, with both labels weighing the same, plus a ridge. Scores are sigmoid(margin).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, on_texts, ragged, steps, written

SAMPLE = 10_000
#: Tasks that read the sample; a size as small as its own would make it one task.
SAMPLE_PARTS = 16
BUCKETS = 1 << 18
TERMS = 2048
#: Reached by chance by about one term in ten thousand.
LEAST_RATIO = 15.0
FACTORS = 8
RIDGE = 1e-4
#: Passes over the sample, and steps at least, however small it is.
EPOCHS = 30
STEPS = 1500
BATCH = 256
RATE = 0.02
CUT = 0.7
SEED = 11

_STEMS = range(3, 8)
#: Words whose buckets a task remembers.
_KNOWN = 1 << 18


def buckets(word: str) -> list[int]:
    """The buckets of a lower-cased word: of itself and of its beginnings."""
    made = [crc32(word.encode())]
    made += [crc32(word[:n].encode(), n) for n in _STEMS if n <= len(word)]
    return [value % BUCKETS for value in made]


def words(text: bytes | None) -> set[str]:
    """Runs of letters and digits, lower-cased."""
    if not text:
        return set()
    plain = text.decode("utf-8", "replace").lower()
    for c in set(plain):
        if not c.isalnum():
            plain = plain.replace(c, " ")
    return set(plain.split())


class Terms:
    """The chosen terms of texts, by number; a word is hashed once as long as it is remembered."""

    def __init__(self, chosen: Iterable[int] | None = None):
        self.number = None if chosen is None else {int(bucket): i for i, bucket in enumerate(chosen)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _made(self, word: str) -> tuple[int, ...]:
        if self.number is None:
            return tuple(buckets(word))
        return tuple([self.number[bucket] for bucket in buckets(word) if bucket in self.number])

    def of(self, text: bytes | None) -> set[int]:
        found = words(text)
        if len(self.known) >= _KNOWN:
            self.known.clear()
        for word in found.difference(self.known):
            self.known[word] = self._made(word)
        return set().union(*map(self.known.__getitem__, found))


@dataclass
class Machine:
    """The chosen buckets with a weight and a vector of factors each; without any, every score is 1/2."""

    chosen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def margin(self, numbers: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Margins of `rows` documents; numbers[i] is a term of document owner[i]."""
        return self.margin_and_sums(numbers, owner, rows)[0]

    def margin_and_sums(self, numbers: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """The margins, and each document's sum of factors."""
        found = self.factors[numbers]
        summed = _summed(owner, found, rows)
        own = np.bincount(owner, (found * found).sum(1), rows)
        linear = np.bincount(owner, self.weights[numbers], rows)
        return self.bias + linear + ((summed * summed).sum(1) - own) / 2, summed


def _summed(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.stack([np.bincount(owner, column, rows) for column in values.T], axis=1)


def _probability(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def ratios(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """G squared of each term (row) with the labels (columns), from its document counts."""
    table = np.stack([counts, totals - counts], axis=2).astype(float)
    expected = table.sum(1, keepdims=True) * table.sum(2, keepdims=True) / max(1, totals.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(table > 0, table * np.log(table / expected), 0.0)
    return 2 * parts.sum((1, 2))


def choose(numbers: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The buckets that tell the labels apart best, ties by number."""
    ratio = ratios(counts, totals)
    order = np.lexsort((numbers, -ratio))
    return numbers[order[ratio[order] >= LEAST_RATIO][:TERMS]]


def learn(numbers: np.ndarray, sizes: np.ndarray, label: np.ndarray, chosen: np.ndarray) -> Machine:
    """Adam on mini-batches with a falling rate, in an order that depends on the seed only. The terms of all documents lie end
    to end in `numbers`, `sizes` of them each."""
    rng = np.random.default_rng(SEED)
    count, rows, terms = np.bincount(label, minlength=2), len(label), len(chosen)
    if not count.all():
        return Machine()
    weight, starts = (rows / 2 / count)[label], np.cumsum(sizes) - sizes
    machine = Machine(chosen, 0.0, np.zeros(terms), rng.normal(0, 0.01, (terms, FACTORS)))
    value = [np.zeros(1), machine.weights, machine.factors]
    mean, spread, step = [np.zeros_like(v) for v in value], [np.zeros_like(v) for v in value], 0
    batches = -(-rows // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches))
    last = epochs * batches
    for _ in range(epochs):
        order = rng.permutation(rows)
        for start in range(0, rows, BATCH):
            batch = order[start : start + BATCH]
            owner, place = ragged(sizes[batch])
            at = numbers[starts[batch][owner] + place]
            machine.bias = float(value[0][0])
            margin, summed = machine.margin_and_sums(at, owner, len(batch))
            error = (_probability(margin) - label[batch]) * weight[batch] / len(batch)
            linear = np.bincount(at, error[owner], terms)
            crossed = _summed(at, (error[:, None] * summed)[owner], terms) - linear[:, None] * machine.factors
            gradient = [
                np.array([error.sum()]),
                linear + RIDGE * machine.weights,
                crossed + RIDGE * machine.factors,
            ]
            step += 1
            for v, m, s, g in zip(value, mean, spread, gradient):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (1 - step / last) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    machine.bias = float(value[0][0])
    return machine


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(label, text) of at most SAMPLE ids of each label, written once.

    Which ids is settled without texts; at most 2 * SAMPLE of them are broadcast then. Labels other than
    0 and 1, and null ids, are left out. An id with both labels may stand in both halves; of documents that
    share an id the one with the least hash of its text is taken.
    """
    asked = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = asked.where("label in (0, 1)").distinct()
    known = written(known.join(docs.select(F.col(id_column).alias("id")), "id", "left_semi"), "known")
    # Of more ids than that, the rank is taken among some 2 * SAMPLE with small hashes, not among all.
    share, low = F.lit(1.0), F.xxhash64("id").cast("double") / 2.0**64 + 0.5
    for r in known.groupBy("label").count().collect():
        share = F.when(F.col("label") == r["label"], 2.0 * SAMPLE / r["count"]).otherwise(share)
    least = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    picked = known.where(low <= share).withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= SAMPLE)
    picked = written(picked, "picked")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.join(F.broadcast(picked.select("id").distinct()), "id", "left_semi")
    first = Window.partitionBy("id").orderBy(F.xxhash64("text"), "text")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    rows = rows.join(F.broadcast(picked.select("id", "label")), "id").select("label", "text")
    return written(rows.repartition(SAMPLE_PARTS, F.xxhash64("text")), "sample")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, clean, toxic): documents of each label that have a term in the bucket; -1 counts all."""
    terms, count = Terms(), np.zeros((BUCKETS, 2), np.int64)
    total = np.zeros((1, 2), np.int64)
    for batch in batches:
        label, done = batch["label"].to_pylist(), 0
        for texts in steps(batch["text"]):
            for text in texts:
                found = np.fromiter(terms.of(text), np.int64)
                count[found, label[done]] += 1
                total[0, label[done]] += 1
                done += 1
    (seen,) = np.nonzero(count.any(1))
    both = np.concatenate([total, count[seen]])
    numbers = np.concatenate([[-1], seen])
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["bucket", "clean", "toxic"]
    )


def _numbered(chosen: np.ndarray):
    def run(texts: list[bytes | None]) -> pa.Array:
        terms = Terms(chosen)
        return pa.array([sorted(terms.of(t)) for t in texts], type=pa.list_(pa.int32()))

    return on_texts(run, pa.list_(pa.int32()))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Machine:
    """Learn from the documents whose id has a label. Without a document of either label there is nothing
    to learn: every score is 1/2."""
    rows = sample(docs, labels, id_column, text_column, label_column)
    bytes_too = rows.select("label", F.col("text").cast("binary").alias("text"))
    counted = bytes_too.mapInArrow(_counted, "bucket long, clean long, toxic long")
    table = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    numbers = table["bucket"].to_numpy()
    counts = np.stack([table["clean"].to_numpy(), table["toxic"].to_numpy()], axis=1).reshape(-1, 2)
    totals = counts[numbers < 0].sum(0)
    if not totals.all():
        return Machine()
    chosen = choose(numbers[numbers >= 0], counts[numbers >= 0], totals)
    found = rows.select("label", F.xxhash64("text").alias("key"), _numbered(chosen)(F.col("text")).alias("terms"))
    found = found.toArrow().sort_by([("key", "ascending"), ("label", "ascending")])
    terms = found["terms"].combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy())
    return learn(terms.flatten().to_numpy(), sizes, found["label"].to_numpy(), chosen)


def score(machine: Machine, text: Column) -> Column:
    """0 to 1, higher means toxic is likelier. A null, empty or wordless text has the score of no terms."""

    terms = []

    def run(texts: list[bytes | None]) -> pa.Array:
        if not terms:
            terms.append(Terms(machine.chosen))
        found = [sorted(terms[0].of(t)) for t in texts]
        owner, _ = ragged(np.array([len(f) for f in found], np.int64))
        numbers = np.array([n for f in found for n in f], np.int64)
        return pa.array(_probability(machine.margin(numbers, owner, len(texts))))

    return on_texts(run, pa.float64())(text)


def keep_clean(docs: DataFrame, machine: Machine, text_column: str = "text") -> DataFrame:
    """The documents that score below CUT, all columns as they are."""
    (name,) = fresh(docs, "score")
    scored = docs.withColumn(name, score(machine, F.col(text_column)))
    return scored.where(F.col(name) < CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
