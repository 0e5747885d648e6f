"""Mixing sources to target weights by blocks, drawn counts and index permutations.

* The words of a source, its documents one after the other, are cut into blocks of one length
  (at most BLOCK_WORDS; evened out so that the last block of a source is hardly shorter).
* A source's target over its size says how many block slots it gets; the last slot of a source takes
  only part of its block, so that small sources meet their targets too.
* Output shards of SHARD_SLOTS slots draw their source counts from a multinomial, given each source's
  number of slots: a multivariate hypergeometric draw. Slots are dealt to groups of
  shards in proportion beforehand, so that every group is drawn by itself, from its own seed, in
  any task.
* The k-th slot of a source takes block p(k mod blocks) of its pass k div blocks, where p is a
  pseudorandom permutation for each source and pass (a Feistel network with cycle walking).
* Slots and blocks are joined by (source, block).

Positions of documents come from running sums in buckets of documents, about the square root of
their number, so that a source with a third of all rows is many groups. One row per source is all
that goes through the driver or is broadcast, for MOST_SOURCES sources at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import on_texts, written

BLOCK_WORDS = 128
SHARD_SLOTS = 4096
GROUP_SLOTS = 1 << 16
SEED = 3
#: Weights of the sources in their order, repeating; share of all words; most passes over a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: The sources' names and weights are broadcast; more than these are refused.
MOST_SOURCES = 100_000

count_words = on_texts(
    lambda texts: pa.array([len(t.split()) if t else 0 for t in texts], type=pa.int64()), pa.int64()
)


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    size: int
    target: float

    @property
    def block(self) -> int:
        """Words of a block."""
        return ceil(self.size / ceil(self.size / BLOCK_WORDS)) if self.size else 1

    @property
    def blocks(self) -> int:
        return ceil(self.size / self.block)

    @property
    def whole(self) -> int:
        """Slots that take a whole block."""
        return int(self.target / self.size * self.blocks) if self.size else 0

    @property
    def rest(self) -> int:
        """Words of one more slot."""
        if not self.size:
            return 0
        return round((self.target / self.size * self.blocks - self.whole) * self.block)

    @property
    def slots(self) -> int:
        return self.whole + (self.rest > 0)


def targets(sizes: list[int]) -> list[float]:
    """Words wanted of each source, in their order: the weights' shares, none above PASSES times
    its size; what is cut off goes to the others by weight, until none is above."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    found = [0.0] * len(sizes)
    rest, open_ = SHARE * sum(sizes), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        shares = {i: rest * weights[i] / total for i in open_}
        above = {i for i in open_ if shares[i] > PASSES * sizes[i]}
        for i in above or open_:
            found[i] = float(PASSES * sizes[i]) if above else shares[i]
            rest -= found[i]
        open_ -= above or open_
    return found


def permuted(index: np.ndarray, count: int, *key: int) -> np.ndarray:
    """A pseudorandom permutation of range(count), at these places."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)
    value = index.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        left, right = value[todo] >> np.uint64(half), value[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & mask)
        value[todo] = (left << np.uint64(half)) | right
        todo = todo[value[todo] >= np.uint64(count)]
    return value.astype(np.int64)


def draw(group: int, groups: int, sources: list[Source]) -> Iterator[dict[str, np.ndarray]]:
    """The slots of one group of shards, a shard at a time."""
    first = [s.slots * group // groups for s in sources]
    left = np.array([s.slots * (group + 1) // groups for s in sources]) - first
    done = np.array(first, dtype=np.int64)
    rng = np.random.default_rng((SEED, group))
    shard = 0
    while left.sum():
        counts = rng.multivariate_hypergeometric(left, min(SHARD_SLOTS, int(left.sum())), method="marginals")
        blocks, words = [], []
        for s, count, at in zip(sources, counts.tolist(), done.tolist()):
            slot = np.arange(at, at + count)
            block = np.zeros(count, dtype=np.int64)
            for turn in np.unique(slot // s.blocks) if count else ():
                here = slot // s.blocks == turn
                block[here] = permuted(slot[here] % s.blocks, s.blocks, SEED, s.number, int(turn))
            blocks.append(block)
            words.append(np.where(slot < s.whole, s.block, s.rest))
        order = rng.permutation(int(counts.sum()))
        yield {
            "shard": np.full(len(order), group * (GROUP_SLOTS // SHARD_SLOTS + len(sources)) + shard),
            "slot": np.arange(len(order)),
            "number": np.repeat(np.arange(len(sources)), counts)[order],
            "block": np.concatenate(blocks)[order],
            "words": np.concatenate(words)[order],
        }
        left, done, shard = left - counts, done + counts, shard + 1


def _slots(sources: list[Source], groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column(0).to_pylist():
                for shard in draw(group, groups, sources):
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in shard.items()})

    return run


@dataclass
class Mix:
    """documents: (id, source, number, size, tie, start), start within the source; takes:
    (shard, slot, number, start, first, words), what each slot takes of which document."""

    sources: list[Source]
    documents: DataFrame
    takes: DataFrame


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> Mix:
    """Plan the mix of all rows of docs.

    A null text has no words, a null source is a source of its own (the last), a null id is an id
    like others, and rows that repeat an id are documents of their own. Documents without words
    are never taken. An empty table gives an empty mix. The same rows give the same mix, in
    whatever order they come.
    """
    spark = docs.sparkSession
    sized = written(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).alias("source"),
            count_words(F.col(text_column)).alias("size"),
            F.xxhash64(text_column).alias("tie"),
        ),
        "sized",
    )
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"{len(rows)} sources; at most {MOST_SOURCES} can be weighed")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["size"] for r in rows])
    sources = [Source(i, r["source"], r["size"], t) for i, (r, t) in enumerate(zip(rows, wanted))]

    # Number the sources, then lay their documents end to end.
    known = spark.createDataFrame(
        [(s.name, s.number, s.block) for s in sources], "source string, number int, block_words long"
    )
    numbered = sized.join(F.broadcast(known), sized["source"].eqNullSafe(known["source"])).drop(known["source"])
    buckets = isqrt(sum(r["n"] for r in rows)) + 1
    bucketed = numbered.withColumn("bucket", F.pmod(F.xxhash64("id", "tie"), F.lit(buckets)))
    inside = Window.partitionBy("number", "bucket").orderBy("id", "tie", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = bucketed.groupBy("number", "bucket").agg(F.sum("size").alias("all"))
    before = Window.partitionBy("number").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = sums.select("number", "bucket", (F.sum("all").over(before) - F.col("all")).alias("offset"))
    documents = (
        bucketed.withColumn("inner", F.sum("size").over(inside) - F.col("size"))
        .join(offsets, ["number", "bucket"])
        .select(
            "id", "source", "number", "size", "tie", "block_words",
            (F.col("offset") + F.col("inner")).alias("start"),
        )
    )
    documents = written(documents, "placed")

    groups = max(1, ceil(sum(s.slots for s in sources) / GROUP_SLOTS))
    slots = spark.range(0, groups, 1, min(groups, 4096)).mapInArrow(
        _slots(sources, groups), "shard long, slot long, number long, block long, words long"
    )
    slots = slots.withColumn("number", F.col("number").cast("int"))
    last = F.expr("(start + size - 1) div block_words")
    pieces = documents.where("size > 0").select(
        "number", "start", "size", "block_words",
        F.explode(F.sequence(F.expr("start div block_words"), last)).alias("block"),
    )
    # Spark takes the slots for as few as the groups they are drawn from; they grow with the corpus.
    met = slots.hint("merge").join(pieces, ["number", "block"]).select(
        "shard", "slot", "number", "start",
        F.greatest(F.lit(0), F.expr("block * block_words - start")).alias("first"),
        F.least(F.col("size"), F.expr("block * block_words + words - start")).alias("stop"),
    )
    takes = met.where("stop > first").select(
        "shard", "slot", "number", "start", "first", F.expr("stop - first").alias("words")
    )
    return Mix(sources, documents, takes)


def taken(plan: Mix) -> DataFrame:
    """(id, source, size, source_size, target, taken): how many words the mix takes of each document."""
    spark = plan.documents.sparkSession
    sums = plan.takes.groupBy("number", "start").agg(F.sum("words").alias("taken"))
    facts = spark.createDataFrame(
        [(s.number, s.size, s.target) for s in plan.sources], "number int, source_size long, target double"
    )
    full = plan.documents.where("size > 0").join(sums, ["number", "start"], "left")
    # Documents without words share their start with the next one, and must not be joined by it.
    empty = plan.documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        full.unionByName(empty)
        .join(F.broadcast(facts), "number")
        .select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            out = {name: [] for name in ("shard", "slot", "part", "id", "source", "n_words", "text")}
            for row in batch.slice(start, 64).to_pylist():
                words = row["text"].split()
                for take in row["takes"]:
                    out["shard"].append(take["shard"])
                    out["slot"].append(take["slot"])
                    out["part"].append(row["start"] + take["first"])
                    out["id"].append(row["id"])
                    out["source"].append(row["source"])
                    out["n_words"].append(take["words"])
                    out["text"].append(b" ".join(words[take["first"] : take["first"] + take["words"]]).decode())
            yield pa.RecordBatch.from_pydict(out, schema=_CUT)


_CUT = pa.schema(
    [("shard", pa.int64()), ("slot", pa.int64()), ("part", pa.int64()), ("id", pa.int64())]
    + [("source", pa.string()), ("n_words", pa.int64()), ("text", pa.string())]
)


def mixed_text(plan: Mix, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The mix itself: (shard, slot, part, id_column, source, n_words, text). The rows of a (shard,
    slot), by part, are the words of its block; each row is from one document."""
    lists = plan.takes.groupBy("number", "start").agg(
        F.collect_list(F.struct("shard", "slot", "first", "words")).alias("takes")
    )
    named = plan.documents.where("size > 0").join(lists, ["number", "start"]).select(
        "id", "tie", "source", "start", "takes"
    )
    # Rows that repeat both id and text find the same words, so one copy of the text will do.
    texts = docs.select(
        F.xxhash64(id_column).alias("key"),
        F.xxhash64(text_column).alias("tie"),
        F.col(text_column).cast("binary").alias("text"),
    )
    both = named.withColumn("key", F.xxhash64("id")).join(
        texts.dropDuplicates(["key", "tie"]), ["key", "tie"]
    )
    cut = both.select("id", "source", "start", "takes", "text").mapInArrow(
        _cut, "shard long, slot long, part long, id long, source string, n_words long, text string"
    )
    return cut.withColumnRenamed("id", id_column)
