"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows of WINDOW consecutive words (an item of fewer words is one
window). Words are numbered, so the text is a string over a large alphabet and a block is a few
words. Patterns of one length form one search: its shift table says, per hashed block, how far a
window that ends in this block may jump; where the jump is zero, the patterns that end in a block
with the same hash form a bucket, those whose first two words hash alike stay, and the words of
each are compared one by one.

Many cursors walk at once: a text is cut into stretches of window ends, one cursor each, and one
NumPy step moves all of them. No stretch depends on another, so nothing is lost between them.

The benchmark is read in slices of at most SLICE_WORDS words (one slice, unless it has millions of
words); each slice's tables are the only thing that is broadcast, so their size is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tickloom.llm.common import fresh, ragged, steps

WINDOW = 10
SLICE_WORDS = 2_000_000
#: Words a block has, and window ends a cursor walks.
BLOCK = 3
STRETCH = 256
TABLE_BITS = 18

#: Lower-cases A-Z and turns every byte that is in no word to a space (fixed by the definition
#: of a word: digits, letters, and every character above 127).
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)

FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("marks", pa.binary()),
    ]
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_LETTERS).split() if text else []


def _mix(blocks: np.ndarray) -> np.ndarray:
    """Hash the last axis to TABLE_BITS bits."""
    out = np.zeros(blocks.shape[:-1], dtype=np.uint64)
    for k in range(blocks.shape[-1]):
        out = (out ^ blocks[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Search:
    """Tables for patterns of one length."""

    def __init__(self, patterns: np.ndarray) -> None:
        self.patterns = patterns
        count, self.length = patterns.shape
        self.block = min(BLOCK, self.length)
        self.prefix = min(2, self.length)
        reach = self.length - self.block
        self.shift = np.full(1 << TABLE_BITS, reach + 1, dtype=np.int64)
        for end in range(reach + 1):
            hashed = _mix(patterns[:, end : end + self.block])
            np.minimum.at(self.shift, hashed, reach - end)
        last = _mix(patterns[:, reach:])
        self.order = np.argsort(last, kind="stable")
        self.bucket = np.searchsorted(last[self.order], np.arange((1 << TABLE_BITS) + 1))
        self.head = _mix(patterns[:, : self.prefix])

    def __call__(self, text: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        """(position, pattern) of every occurrence in texts laid end to end.

        Text i has counts[i] words from starts[i]; the words of texts never run together.
        """
        ends = np.maximum(counts - self.length + 1, 0)
        owner, stretch = ragged(-(-ends // STRETCH))
        at = starts[owner] + stretch * STRETCH
        stop = np.minimum(at + STRETCH, starts[owner] + ends[owner])
        reach = self.length - self.block
        places, found = [], []
        while len(at):
            blocks = text[at[:, None] + np.arange(reach, self.length)]
            hashed = _mix(blocks)
            jump = self.shift[hashed]
            zero = np.flatnonzero(jump == 0)
            if len(zero):
                sizes = self.bucket[hashed[zero] + 1] - self.bucket[hashed[zero]]
                cursor, place = ragged(sizes)
                pattern = self.order[self.bucket[hashed[zero]][cursor] + place]
                here = at[zero][cursor]
                head = _mix(text[here[:, None] + np.arange(self.prefix)])
                same = head == self.head[pattern]
                here, pattern = here[same], pattern[same]
                same = (text[here[:, None] + np.arange(self.length)] == self.patterns[pattern]).all(1)
                places.append(here[same])
                found.append(pattern[same])
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(found)


class Tables:
    """The searches for the windows of some benchmark items, one for each length of window."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        windows: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for item, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            length = min(window, len(ids))
            for start in range(len(ids) - length + 1 if ids else 0):
                key = tuple(ids[start : start + length])
                owners = windows.setdefault(length, {}).setdefault(key, [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.searches = []
        for length, patterns in sorted(windows.items()):
            sizes = np.array([len(x) for x in patterns.values()])
            owners = np.array([i for x in patterns.values() for i in x])
            search = Search(np.array(list(patterns), dtype=np.int32))
            self.searches.append((search, np.cumsum(sizes) - sizes, sizes, owners))

    def scan(self, texts: list[bytes | None], before: list[dict | None]) -> pa.Array:
        number = self.vocabulary.get
        split = [words(t) for t in texts]
        counts = np.array([len(w) for w in split], dtype=np.int64)
        starts = np.cumsum(counts) - counts
        total = int(counts.sum())
        text = np.fromiter((number(w, 0) for x in split for w in x), dtype=np.int32, count=total)
        edges = np.zeros(total + 1, dtype=np.int64)
        items: dict[int, set[str]] = {}
        for search, first, sizes, owners in self.searches:
            place, pattern = search(text, starts, counts)
            np.add.at(edges, place, 1)
            np.add.at(edges, place + search.length, -1)
            row = np.searchsorted(starts, place, side="right") - 1
            pairs = np.unique(np.stack([row, pattern]), axis=1) if len(row) else np.zeros((2, 0), int)
            again, step = ragged(sizes[pairs[1]])
            for r, item in zip(pairs[0][again], owners[first[pairs[1]][again] + step]):
                if self.names[item] is not None:
                    items.setdefault(int(r), set()).add(self.names[item])
        hit = np.cumsum(edges[:-1]) > 0
        out = []
        for i, (start, count) in enumerate(zip(starts.tolist(), counts.tolist())):
            marks, named = hit[start : start + count], items.get(i, set())
            if before[i] and before[i]["marks"]:
                old = np.unpackbits(np.frombuffer(before[i]["marks"], dtype=np.uint8), count=count)
                marks = marks | old.astype(bool)
            if before[i]:
                named = named | set(before[i]["items"])
            n_hit = int(np.count_nonzero(marks))
            packed = np.packbits(marks).tobytes() if n_hit else b""
            out.append({"n_words": count, "n_hit": n_hit, "items": sorted(named), "marks": packed})
        return pa.array(out, type=FOUND)


def _slices(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple]]:
    """The benchmark in lists of bounded size."""
    size = F.coalesce(F.length(F.col(text_column)), F.lit(0))
    total = benchmark.agg(F.sum(size).alias("n")).first()["n"] or 0
    # Every word has a character and a gap, so no slice expects more than SLICE_WORDS words.
    count = 1 + total // (2 * SLICE_WORDS)
    rows = benchmark.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k)
        yield [(r["id"], None if r["text"] is None else r["text"].encode()) for r in part.collect()]


def _pass(tables) -> callable:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        search = tables.value
        for texts, before in batches:
            parts, done = [], 0
            for part in steps(texts):
                parts.append(search.scan(part, before[done : done + len(part)].to_pylist()))
                done += len(part)
            yield pa.concat_arrays(parts) if parts else pa.array([], type=FOUND)

    kind = Iterator[tuple[pa.Array, pa.Array]]
    run.__annotations__ = {"batches": kind, "return": Iterator[pa.Array]}
    return run


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """docs with a struct column `into`: n_words, n_hit (words inside any occurrence of any window),
    items (names of the items with an occurring window, sorted as strings) and marks (a bit per
    word, empty if none is hit).

    A null text has no words. Items without words have no window. Windows of an item whose name is
    null hit words but are not listed; rows that repeat a name are one item. An empty benchmark
    hits nothing. `into` must be a name that docs does not have.
    """
    spark = docs.sparkSession
    none = F.lit(None).cast(from_arrow_type(FOUND))
    found = docs.withColumn(into, none)
    for items in _slices(benchmark, item_column, item_text_column):
        tables = spark.sparkContext.broadcast(Tables(items))
        scan = F.arrow_udf(_pass(tables), returnType=from_arrow_type(FOUND)).asNondeterministic()
        found = found.withColumn(into, scan(F.col(text_column).cast("binary"), F.col(into)))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents in which no benchmark window occurs, all columns as they are."""
    (into,) = fresh(docs, "found")
    return hits(docs, benchmark, into, text_column).where(F.col(into)["n_hit"] == 0).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def items_digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", items), 256)
