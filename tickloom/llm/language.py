"""Language identification as multilingual mixture inference.

A document is a mixture of languages: each of its words is drawn from one of them, by the document's
proportions. A word's likelihood in a language is the product over its letter trigrams (over UTF-8
bytes, with the word's edges), learned from all labelled documents. Expectation-maximisation finds
the proportions, for many documents at once: the expectation step gives each word's
responsibilities, the maximisation step averages them.

More languages always fit better, so the set is chosen by penalised likelihood: languages are
ranked by their proportions in the full fit, the best k of them are fitted anew, and the k with
the largest log-likelihood less PENALTY / 2 * k * log(words) wins (with PENALTY = 1 this is BIC).

Trigrams are hashed to 2 ** BITS bins, so a model is a table of fixed size per language.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import on_texts, steps

BITS = 16
SMOOTHING = 0.1
PENALTY = 2.0
ROUNDS = 20
REFITS = 10
#: Languages whose tables are broadcast; more than these are refused.
MOST_LANGUAGES = 500
UNKNOWN = "und"
STEP = 1 << 20

#: Lower-cases A-Z; ASCII that is no letter becomes a space; other bytes stay.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_ASCII_LETTERS = bytes(set(range(256)) - set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))

RESULT = pa.struct(
    [
        ("language", pa.string()),
        ("score", pa.float64()),
        ("mixture", pa.list_(pa.struct([("language", pa.string()), ("share", pa.float64())]))),
    ]
)


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(text.translate(None, _ASCII_LETTERS)) or any(map(str.isalpha, text.decode()))


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all trigrams, where each word's begin, and the text each word is in."""
    cleaned = [t.translate(_LETTERS) for t in texts]
    joined = np.frombuffer(b" " + b" ".join(cleaned) + b" ", dtype=np.uint8)
    letter = joined != 32
    code = joined.astype(np.uint32)
    code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    middle = letter[1:-1]
    bins = ((code[middle] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)
    begins = np.flatnonzero((middle & ~letter[:-2])[middle])
    sizes = np.array([len(t) + 1 for t in cleaned])
    owner = np.repeat(np.arange(len(texts)), sizes)
    return bins, begins, owner[: len(middle)][middle][begins]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bins x languages, log-probabilities

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of every word in every language, and the text it is in."""
        bins, begins, owner = trigrams(texts)
        if not len(begins):
            return np.zeros((0, len(self.languages)), dtype=np.float32), owner
        return np.add.reduceat(self.table[bins], begins, axis=0), owner

    def fit(self, scores: np.ndarray, owner: np.ndarray, shares: np.ndarray, rounds: int):
        """Proportions after so many rounds, and each text's log-likelihood under them.

        A share of zero stays zero, so the shares to begin with also name the language set."""
        texts = len(shares)
        counts = np.bincount(owner, minlength=texts)
        filled = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[filled]
        top = scores.max(axis=1, keepdims=True)
        likely = np.exp(scores - top)
        shares = shares.astype(np.float32)
        for _ in range(rounds):
            joint = likely * shares[owner]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), np.float32(1e-30))
            shares[filled] = np.add.reduceat(joint, starts, axis=0) / counts[filled, None]
        total = np.log(np.maximum((likely * shares[owner]).sum(axis=1), 1e-30)) + top[:, 0]
        fitted = np.zeros(texts)
        if len(filled):
            fitted[filled] = np.add.reduceat(total.astype(np.float64), starts)
        return shares, fitted

    def mixtures(self, texts: list[bytes]) -> np.ndarray:
        """The chosen proportions: a row per text that adds up to one."""
        count = len(self.languages)
        scores, owner = self.words(texts)
        sizes = np.bincount(owner, minlength=len(texts))
        even = np.full((len(texts), count), 1 / count)
        shares, best_of_all = self.fit(scores, owner, even, ROUNDS)
        ranked = np.argsort(-shares, axis=1, kind="stable")
        price = PENALTY / 2 * np.log(np.maximum(sizes, 2))
        chosen = np.zeros_like(even)
        value = np.full(len(texts), -np.inf)
        todo = np.arange(len(texts))
        for k in range(1, count + 1):
            # No larger set can win where even the full fit does not pay for one more language.
            todo = todo[best_of_all[todo] - k * price[todo] > value[todo]] if k > 1 else todo
            if not len(todo):
                break
            place = np.full(len(texts), -1)
            place[todo] = np.arange(len(todo))
            mine = place[owner] >= 0
            begin = np.zeros((len(todo), count))
            np.put_along_axis(begin, ranked[todo, :k], 1 / k, axis=1)
            rounds = 0 if k == 1 else REFITS
            fitted, likelihood = self.fit(scores[mine], place[owner[mine]], begin, rounds)
            gained = likelihood - k * price[todo]
            better = gained > value[todo]
            value[todo[better]] = gained[better]
            chosen[todo[better]] = fitted[better]
        return chosen

    def predict(self, texts: list[bytes | None]) -> pa.Array:
        out = [{"language": UNKNOWN, "score": 0.0, "mixture": []} for _ in texts]
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if known:
            for i, row in zip(known, self.mixtures([texts[i] for i in known]).tolist()):
                found = sorted(((s, n) for s, n in zip(row, self.languages) if s > 0), key=lambda x: -x[0])
                found = [{"language": n, "share": min(1.0, s)} for s, n in found]
                out[i] = {"language": found[0]["language"], "score": found[0]["share"], "mixture": found}
        return pa.array(out, type=RESULT)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, text) to trigram counts of a partition."""
    sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(1 << BITS, dtype=np.int64))
    for batch in batches:
        languages = batch.column(0).to_pylist()
        done = 0
        for part in steps(batch.column(1), STEP):
            by: dict[str, list[bytes]] = defaultdict(list)
            for language, text in zip(languages[done : done + len(part)], part):
                by[language].append(text)
            done += len(part)
            for language, texts in by.items():
                sums[language] += np.bincount(trigrams(texts)[0], minlength=1 << BITS)
    for language, counts in sums.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "language": pa.array([language] * len(used), type=pa.string()),
                "bin": pa.array(used.astype(np.int32)),
                "n": pa.array(counts[used]),
            }
        )


def learn(docs: DataFrame, text_column: str = "text", language_column: str = "lang") -> Model:
    """Count over all rows with a text and a language; without any, nothing can be told apart."""
    rows = docs.select(
        F.col(language_column).cast("string").alias("language"), F.col(text_column).cast("binary").alias("text")
    ).where("language is not null and text is not null")
    counts = (
        rows.mapInArrow(_counted, "language string, bin int, n long")
        .groupBy("language", "bin")
        .agg(F.sum("n").alias("n"))
    )
    # Rows of the table, packed by language: at most 2 ** BITS entries each.
    packed = counts.groupBy("language").agg(
        F.collect_list("bin").alias("bins"), F.collect_list("n").alias("counts")
    )
    languages, columns = [], []
    for row in packed.orderBy("language").toLocalIterator():
        if len(languages) == MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        column = np.full(1 << BITS, SMOOTHING)
        column[row["bins"]] += row["counts"]
        languages.append(row["language"])
        columns.append(np.log(column / column.sum()).astype(np.float32))
    return Model(languages, np.stack(columns, axis=1) if columns else np.zeros((1 << BITS, 0)))


def identify(docs: DataFrame, model: Model, text: Column) -> Column:
    """A struct column for texts of docs: language, score (its share of the words, 0 to 1) and
    mixture (the chosen languages and their shares, largest first).

    A null text, or one without a letter, is `und` with score 0 and no mixture; so is every text
    if no language was learned.
    """
    table = docs.sparkSession.sparkContext.broadcast(model)
    return on_texts(lambda texts: table.value.predict(texts), RESULT, STEP)(text)
