"""Secret scans: fixed forms of secrets, and a battery of randomness tests for the rest.

Base spans are those of three fixed forms. Every other long run of key characters with a letter in
it is tested as follows.

* Its encoding is inferred: the smallest alphabet (hex, base 32, 36, 62, 64) with all its characters.
* Three tests ask whether it could be random text of that encoding: chi-squared of the character
  counts against a uniform alphabet, runs above and below the alphabet's middle, and serial
  correlation of neighbouring characters. Each must leave that standing, at a level that is shared
  out over all tests of the document.
* Short runs pass such tests whatever they are, so the run must also not be prose. Its likelihood
  under a uniform alphabet, divided by that under the characters' use in prose (letters without
  case), is an e-value: prose reaches r with probability 1/r at most. These
  p-values go through Benjamini-Hochberg over the runs of the document, each weighted by its
  length, which bounds the share of false discoveries, and asks less of longer runs.
  Prose is the rest of the document and a number of characters as the whole table uses them, since a
  short document alone does not tell what prose looks like.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import accumulate
from math import erfc, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, on_texts, steps

#: The base forms, in the order they are listed, and their least lengths.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
LEAST_ACCESS = 20
BASE_KINDS = ["assign", "access", "hex"]
RANDOM = "random"

#: A run shorter than this is not tested; levels of the two kinds of error.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
RUN_BYTES = re.compile(RUN.pattern.encode())
MISSED = 0.001
FALSE_DISCOVERIES = 0.001
#: Characters of the table's prose that are added to each document's own.
PRIOR = 1000

#: The alphabets of the encodings, smallest first.
ENCODINGS = [
    "0123456789abcdef",
    "0123456789ABCDEF",
    string.ascii_uppercase + "234567",
    string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase,
    string.digits + string.ascii_uppercase + string.ascii_lowercase,
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
]
ANY = string.ascii_letters + string.digits + "+/-_"

REPLACEMENT = "[secret]"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def base(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def encoding(run: str) -> str:
    used = set(run)
    return next((alphabet for alphabet in ENCODINGS if used <= set(alphabet)), ANY)


def battery(run: str, alphabet: str) -> tuple[float, float, float]:
    """How likely random characters of the alphabet look as far from random as these do."""
    n, k = len(run), len(alphabet)
    ranks = np.array([alphabet.index(c) for c in run], dtype=float)
    counts = np.bincount(ranks.astype(int), minlength=k)
    chi = float((counts.astype(float) ** 2).sum()) * k / n - n
    uniform = 0.5 * erfc((chi - (k - 1)) / sqrt(2 * 2 * (k - 1) * (n - 1) / n))
    upper = ranks >= k / 2
    p = int(upper.sum()) / n
    expected, spread = 1 + 2 * (n - 1) * p * (1 - p), 2 * sqrt(n) * p * (1 - p)
    changes = 1 + int(np.count_nonzero(upper[1:] != upper[:-1]))
    runs = erfc(abs(changes - expected) / spread / sqrt(2)) if spread else 0.0
    centred = ranks - ranks.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    return uniform, runs, erfc(abs(serial + 1 / n) * sqrt(n) / sqrt(2))


def prose_bound(run: str, alphabet: str, prose: Counter, total: float, usage: dict[str, float]) -> float:
    """At most this likely, prose is as much better explained by the uniform alphabet."""
    ratio = -len(run) * log(len(alphabet))
    size = total + (PRIOR if usage else len(ANY))
    for c in run.lower():
        ratio -= log((prose[c] + (PRIOR * usage[c] if usage else 1)) / size)
    return float(np.exp(-min(max(ratio, 0.0), 700.0)))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to how often each byte value starts a character outside long runs, without case."""
    for batch in batches:
        counts = np.zeros(256, dtype=np.int64)
        for part in steps(batch.column(0)):
            rest = b"\n".join(RUN_BYTES.sub(b"", text) for text in part if text).lower()
            counts += np.bincount(np.frombuffer(rest, dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_pydict({"byte": pa.array(np.arange(256)), "n": pa.array(counts)})


def usage_of(docs: DataFrame, text_column: str = "text") -> dict[str, float]:
    """The share of each key character in the table's prose; at most 256 rows come to the driver."""
    texts = docs.select(F.col(f"`{text_column}`").cast("binary").alias("text"))
    rows = texts.mapInArrow(counted, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    # Bytes that go on with a character are none of their own.
    counts = {r.byte: r.n for r in rows if not 0x80 <= r.byte < 0xC0}
    keys = sorted(set(ANY.lower()))
    total = sum(counts.values()) + len(ANY)
    return {c: (counts.get(ord(c), 0) + 1) / total for c in keys}


def random_runs(
    text: str, taken: list[tuple[str, int, int]], usage: dict[str, float] | None = None
) -> list[tuple[str, int, int]]:
    tested = []
    # Spans by their start, and the furthest end up to each: a run is free if the last span that starts
    # before its end, and all before that one, end before its start.
    starts = sorted(start for _, start, _ in taken)
    ends = list(accumulate((end for _, _, end in sorted(taken, key=lambda s: s[1])), max))
    for m in RUN.finditer(text):
        body = m[0].rstrip("=")
        before = bisect_left(starts, m.end())
        free = before == 0 or ends[before - 1] <= m.start()
        if free and any(c.isalpha() for c in body):
            tested.append((m, body, encoding(body)))
    if not tested:
        return []
    prose = Counter(text.lower())
    for m, _, _ in tested:
        prose.subtract(m[0].lower())
    total = sum(prose.values())
    bounds = [prose_bound(body, alphabet, prose, total, usage or {}) for _, body, alphabet in tested]
    weights = np.array([len(body) for _, body, _ in tested], dtype=float)
    weights /= weights.mean()
    weighted = np.minimum(np.array(bounds) / weights, 1.0)
    order = np.argsort(weighted, kind="stable")
    passes = weighted[order] <= FALSE_DISCOVERIES * np.arange(1, len(order) + 1) / len(order)
    discovered = order[: np.flatnonzero(passes).max() + 1] if passes.any() else []
    level = MISSED / (3 * len(tested))
    return [
        (RANDOM, *tested[i][0].span())
        for i in discovered
        if min(battery(tested[i][1], tested[i][2])) > level
    ]


def spans_of(text: str, usage: dict[str, float] | None = None) -> list[tuple[str, int, int]]:
    """Spans by the use of characters in the table's prose; without it, in the text alone."""
    found = base(text)
    found += random_runs(text, found, usage)
    order = {kind: i for i, kind in enumerate([*BASE_KINDS, RANDOM])}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def _scan(texts: list[bytes | None], usage: dict[str, float] | None) -> pa.Array:
    found = [spans_of(t.decode(), usage) if t else [] for t in texts]
    return pa.array(
        [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found], type=SPANS
    )


def _redacted(texts: list[bytes | None], usage: dict[str, float] | None) -> pa.Array:
    out = []
    for raw in texts:
        text = raw.decode() if raw is not None else None
        done, pieces = 0, []
        for _, start, end in spans_of(text, usage) if text else []:
            if start >= done:
                pieces += [text[done:start], REPLACEMENT]
            done = max(done, end)
        out.append("".join(pieces) + text[done:] if pieces else text)
    return pa.array(out, type=pa.string())


def spans(text: Column, usage: dict[str, float] | None = None) -> Column:
    """Text to its spans (kind, start, end) in code points, end exclusive, by start and then kind.
    A null or empty text has none."""
    return on_texts(partial(_scan, usage=usage), SPANS)(text)


def redacted(text: Column, usage: dict[str, float] | None = None) -> Column:
    """Text with every span, or union of overlapping spans, replaced; null stays null."""
    return on_texts(partial(_redacted, usage=usage), pa.string())(text)


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(
        ",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame, text_column: str = "text", size_column: str | None = "n_chars") -> DataFrame:
    """docs with the secrets in their texts replaced, and size_column (if docs has it) counted
    anew where the text has changed. All rows and columns stay."""
    (text,) = fresh(docs, "redacted")
    out = docs.withColumn(text, redacted(F.col(text_column), usage_of(docs, text_column)))
    changed = ~F.col(text).eqNullSafe(F.col(text_column))
    columns = []
    for field in docs.schema:
        value = F.col(f"`{field.name}`")
        if field.name == text_column:
            value = F.col(text)
        elif field.name == size_column:
            value = F.when(changed, F.length(F.col(text)).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return out.select(*columns)
