"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows stand in the order of a Hilbert curve over their components, so that rows of a block are alike, and are
packed into blocks of BLOCK rows, one Parquet row each, with the least and the greatest value of every
dimension and the labels beside them. For an anchor, interval arithmetic over a block's box bounds the inner
products with all its rows: per dimension the lesser and the greater of anchor * least and anchor * greatest,
summed. A block is read for an anchor only if that interval meets one of the windows of scores the anchor
still looks for, and the block has a row of a label that counts.

1. The blocks that hold anchors are read first: what they have of the anchor's label gives a score that its
   positives reach at least.
2. All other blocks that may reach it give the positives: the first of the anchor's label by score, then id.
3. Each positive opens a window of scores from LEAST of its own up to its own; the blocks whose interval
   meets a window give its negatives.

Anchors come in slices of SLICE_BYTES at most, in curve order, and only a slice is broadcast. Blocks never
travel: a task keeps no more than the first few rows per window, and only those are shuffled. Which blocks a
slice needs at all is settled on the zone maps first; that set leaves as at most RANGES ranges of block
numbers, which the scan of the blocks pushes down to Parquet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import numbered, written
from tickloom.session import scratch
from tickloom.sinks.storage import exists

BLOCK = 64
SLICE_BYTES = 16 << 20
RANGES = 64
#: Bits of each dimension that the curve's order looks at.
BITS = 4
POSITIVES = 5
NEGATIVES = 5
#: A negative scores from 80 to 100 % of its positive.
LEAST, MOST, WHOLE = 80, 100, 100
#: Anchors that are multiplied with a block at once.
STEP = 1024
_PARQUET_BYTES = 8 << 20
#: Bits of a block number that count inside a sort partition.
_PART_SHIFT = 33 - (BLOCK.bit_length() - 1)
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1
#: Stands for a missing id: it comes last among ties.
_NO_ID = _HIGHEST

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of coordinates below 2 ** bits), as rows of bytes whose
    order is the curve's. Coordinates are turned into the curve's transposed index in place, all rows at
    once: inverse undo of excess work from the top bit down, then Gray encoding."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    if not dims:
        return np.zeros((len(cells), 0), np.uint8)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            flip = (x[i] >> level & 1).astype(bool)
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] >> level & 1, turn ^ ((1 << level) - 1), turn)
    x ^= turn
    # Bit by bit, the highest of every dimension first.
    planes = [(x >> level & 1).astype(np.uint8).T for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def usable(rows: DataFrame, id_column: str, vector_column: str, label_column: str, scale: int) -> DataFrame:
    """(id, label, v): rows with a label and a vector of finite components, each scaled and rounded down."""
    vector = F.col(vector_column)
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    kept = rows.where(F.col(label_column).isNotNull() & vector.isNotNull() & ~bad)
    return kept.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), whole.alias("v")
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to an inner product."""
    sizes = np.diff(column.offsets.to_numpy())
    made = np.zeros((len(sizes), dims), np.int64)
    made[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    return made


@dataclass
class Grid:
    """Each dimension's mean and spread: curve cells are cut around the mean, and the dimensions that spread
    most come first. `plain` says that doubles hold every inner product of two rows exactly."""

    mean: np.ndarray
    deviation: np.ndarray
    plain: bool

    @property
    def dims(self) -> int:
        return len(self.mean)

    def cells(self, v: np.ndarray) -> np.ndarray:
        half = 1 << (BITS - 1)
        cut = np.floor((v - self.mean) / self.deviation * (half / 2)) + half
        return np.clip(cut, 0, 2 * half - 1)[:, np.argsort(-self.deviation, kind="stable")].astype(np.int64)


def grid(rows: DataFrame) -> Grid:
    """Statistics over all rows, one line per dimension."""
    x = rows.select(F.posexplode("v").alias("dim", "x")).groupBy("dim")
    found = x.agg(
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("deviation"),
        F.max(F.abs(F.col("x").cast("double"))).alias("most"),
    )
    table = found.orderBy("dim").toArrow()
    mean, deviation, most = (table[c].to_numpy() for c in ("mean", "deviation", "most"))
    return Grid(mean, np.where(deviation > 0, deviation, 1.0), bool((most * most).sum() < 2.0**53))


def _packed(dims: int):
    """Rows in order, packed BLOCK at a time; the rows of a block stand by id."""

    def blocks_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at, label = table["at"].to_numpy(), table["label"].to_numpy()
        ids = table["id"].fill_null(_NO_ID).to_numpy()
        v = _matrix(table["v"].combine_chunks(), dims)
        for start in range(0, len(table), BLOCK):
            order = start + np.argsort(ids[start : start + BLOCK], kind="stable")
            rows = v[order]
            made = [ids[order], label[order], rows.ravel(), rows.min(0), rows.max(0), np.unique(label[order])]
            columns = [pa.array([at[start] // BLOCK]), *(pa.array([m], type=pa.list_(pa.int64())) for m in made)]
            yield pa.RecordBatch.from_arrays(columns, names=["block", *_LISTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            left = table if left is None else pa.concat_tables([left, table])
            whole = len(left) - len(left) % BLOCK
            if whole:
                yield from blocks_of(left.slice(0, whole))
                left = left.slice(whole)
        if left is not None and len(left):
            yield from blocks_of(left)

    return run


_LISTS = ["ids", "labels", "comps", "least", "greatest", "kinds"]
_ZONES = ["least", "greatest", "kinds"]


def _lists(batch: pa.RecordBatch, i: int, names: list[str]) -> list[np.ndarray]:
    return [batch[name][i].values.to_numpy() for name in names]


@dataclass
class Index:
    """Blocks in curve order and their zone maps, as written tables; and every anchor, numbered in curve order."""

    blocks: DataFrame
    zones: DataFrame
    shape: Grid


def build(rows: DataFrame) -> Index:
    """Rows are range-sorted by their key on the curve and cut into blocks, whose numbers ascend along it.

    Equal rows share a key; a written row number spreads them like any others.
    """
    shape = grid(rows)

    def key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = hilbert_keys(shape.cells(_matrix(batch, shape.dims)), BITS)
            yield pa.array([row.tobytes() for row in found], type=pa.binary())

    key.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    keyed = rows.select("*", F.arrow_udf(key, returnType="binary")(F.col("v")).alias("key"))
    keyed = written(keyed.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    inside = keyed.repartitionByRange("key", "id", "_row").sortWithinPartitions("key", "id", "_row")
    placed = inside.select("id", "label", "v", F.monotonically_increasing_id().alias("at"))
    schema = "block long, " + ", ".join(f"{name} array<long>" for name in _LISTS)
    # Small row groups, so that a range of block numbers reads little beyond it.
    packed = placed.mapInArrow(_packed(shape.dims), schema)
    blocks = written(packed, "blocks", **{"parquet.block.size": str(_PARQUET_BYTES)})
    return Index(blocks, written(blocks.select("block", *_ZONES), "zones"), shape)


def _times(a: np.ndarray, b: np.ndarray, plain: bool) -> np.ndarray:
    """Inner products of whole numbers: exact, and cut off where a long ends."""
    if plain:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    found = np.asarray(a.astype(object) @ b.T.astype(object), dtype=object)
    return np.clip(found, _LOWEST, _HIGHEST).astype(np.int64)


@dataclass
class Asked:
    """A slice of anchors: where each stands, and the windows of scores it looks for, per anchor a row."""

    block: np.ndarray
    row: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    v: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: Whether rows of the anchor's own label count, or those of others.
    same: bool
    first: int
    plain: bool
    #: Only the block it stands in is read for an anchor.
    own: bool = False

    def needed(self, block: int, least: np.ndarray, greatest: np.ndarray, kinds: np.ndarray, floor=None) -> np.ndarray:
        """Numbers of the anchors that must read a block with this zone map, when windows begin at `floor`."""
        if self.own:
            return np.nonzero(self.block == block)[0]
        alike = (kinds[:, None] == self.label).any(0)
        counts = alike if self.same else ~(alike & (len(kinds) == 1))
        up, down = np.maximum(self.v, 0), np.minimum(self.v, 0)
        bottom = _times(up, least, self.plain) + _times(down, greatest, self.plain)
        top = _times(up, greatest, self.plain) + _times(down, least, self.plain)
        meets = (bottom[:, None] <= self.high) & (top[:, None] >= (self.low if floor is None else floor))
        return np.nonzero(counts & meets.any(1))[0]


class _Firsts:
    """The first rows of every (anchor, window) among the blocks met so far, by score, then id."""

    def __init__(self, asked: Asked):
        self.asked, self.floor, self.width = asked, asked.low.copy(), asked.low.shape[1]
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def meet(self, anchors: np.ndarray, block: int, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        asked = self.asked
        scores = _times(asked.v[anchors], v, asked.plain)
        counts = (asked.label[anchors][:, None] == labels) == asked.same
        home = np.nonzero(asked.block[anchors] == block)[0]
        counts[home, asked.row[anchors][home]] = False
        for window in range(self.width):
            fits = counts & (scores >= self.floor[anchors, window][:, None])
            fits &= scores <= asked.high[anchors, window][:, None]
            at, row = np.nonzero(fits)
            self.parts.append((anchors[at] * self.width + window, scores[at, row], ids[row]))
            self.size += len(at)
        if self.size > 8 * self.floor.size + (1 << 16):
            self.shrink()

    def shrink(self) -> tuple[np.ndarray, ...]:
        """Forget what is not among the first, and what comes below the last of them from now on."""
        none = (np.zeros(0, np.int64),) * 3
        slot, score, ids = (np.concatenate(column) for column in zip(none, *self.parts))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        kept = np.arange(len(slot)) - np.searchsorted(slot, slot) < self.asked.first
        slot, score, ids = slot[kept], score[kept], ids[kept]
        last, floor = self.asked.first - 1, self.asked.low.ravel().copy()
        full = np.nonzero(slot[last:] == slot[: len(slot) - last])[0] if len(slot) > last else []
        floor[slot[full]] = score[last:][full]
        self.floor = floor.reshape(self.floor.shape)
        self.parts, self.size = [(slot, score, ids)], len(slot)
        return slot, score, ids


def _reader(asked: Asked, dims: int):
    """(slot, score, id): the first rows of every window among the blocks a task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = _Firsts(asked)
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                ids, labels, comps, *zone = _lists(batch, i, _LISTS)
                needed = asked.needed(block, *zone, firsts.floor)
                for start in range(0, len(needed), STEP):
                    firsts.meet(needed[start : start + STEP], block, ids, labels, comps.reshape(len(ids), dims))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in firsts.shrink()], names=["slot", "score", "id"])

    return run


def needs(index: Index, asked: Asked) -> DataFrame:
    """(block, anchors): how many anchors of the slice must read each block, from the zone maps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["block"].to_pylist()
            found = [len(asked.needed(block, *_lists(batch, i, _ZONES))) for i, block in enumerate(numbers)]
            made = [batch["block"], pa.array(found, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["block", "anchors"])

    return index.zones.mapInArrow(run, "block long, anchors long")


def ranges(chosen: DataFrame) -> list[tuple[int, int]]:
    """The needed blocks as at most RANGES ranges of numbers; the driver gets one per sort partition and step."""
    part, place = F.shiftright("block", _PART_SHIFT), F.col("block").bitwiseAND(F.lit((1 << _PART_SHIFT) - 1))
    counted = chosen.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    step = counted // RANGES + 1
    cut = chosen.where("anchors > 0").groupBy(part.alias("part"), F.floor(place / step).alias("step"))
    rows = cut.agg(F.min("block").alias("first"), F.max("block").alias("last")).orderBy("first").collect()
    wide = len(rows) // RANGES + 1
    return [(rows[i]["first"], rows[i : i + wide][-1]["last"]) for i in range(0, len(rows), wide)]


def first_rows(index: Index, asked: Asked) -> DataFrame:
    """(slot, rank, score, id): per window its first rows; a slot is anchor * windows + window of the slice."""
    found = [(int(asked.block.min()), int(asked.block.max()))] if asked.own else ranges(needs(index, asked))
    wanted = F.lit(False)
    for first, last in found:
        wanted = wanted | F.col("block").between(first, last)
    met = index.blocks.where(wanted).mapInArrow(_reader(asked, index.shape.dims), "slot long, score long, id long")
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), "id")
    # Spark limits rows by rank before the shuffle too.
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= asked.first)


def _windows(index: Index, asked: Asked) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the first rows of a slice's windows, one row per slot; a score of None is none."""
    ids = np.full((asked.low.size, asked.first), _NO_ID, np.int64)
    scores = np.full((asked.low.size, asked.first), None, object)
    found = first_rows(index, asked).toArrow()
    slot, place = found["slot"].to_numpy(), found["rank"].to_numpy() - 1
    ids[slot, place] = found["id"].to_numpy()
    scores[slot, place] = found["score"].to_numpy().astype(object)
    return ids, scores


def anchors_of(index: Index, every: int) -> DataFrame:
    """(place, block, row, id, label, v): the rows whose id is divisible by `every`, numbered in curve order."""
    dims = index.shape.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, block in enumerate(batch["block"].to_pylist()):
                ids, labels, comps = _lists(batch, i, _LISTS[:3])
                (row,) = np.nonzero((ids % every == 0) & (ids != _NO_ID))
                v = comps.reshape(len(ids), dims)[row]
                made = [np.full(len(row), block), row, ids[row], labels[row]]
                columns = [*(pa.array(m, type=pa.int64()) for m in made), pa.array(list(v), type=pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "row", "id", "label", "v"])

    found = index.blocks.mapInArrow(run, "block long, row long, id long, label long, v array<long>")
    return numbered(written(found.withColumn("key", F.lit("")), "anchors"), ["block", "row"])


def _slice_results(index: Index, given: pa.Table) -> DataFrame | None:
    """The hard negatives of one slice of anchors."""
    block, row, ids, label = (given[c].to_numpy() for c in ("block", "row", "id", "label"))
    size, plain = len(given), index.shape.plain
    v = _matrix(given["v"].combine_chunks(), index.shape.dims)

    def ask(low, high, same, first, own=False) -> Asked:
        return Asked(block, row, ids, label, v, low, high, same, first, plain, own)

    any_score = np.full((size, 1), _HIGHEST), True, POSITIVES
    seen = _windows(index, ask(np.full((size, 1), _LOWEST), *any_score, own=True))[1][:, -1]
    reached = np.array([_LOWEST if s is None else s for s in seen], np.int64).reshape(-1, 1)
    positive, score = _windows(index, ask(reached, *any_score))
    # A window that no score lies in, where there is no positive or no score from LEAST to MOST of it.
    low, high = np.full(score.shape, _HIGHEST), np.full(score.shape, _LOWEST)
    for at, s in np.ndenumerate(score):
        if s is not None and -(-LEAST * s // WHOLE) <= MOST * s // WHOLE:
            low[at], high[at] = -(-LEAST * s // WHOLE), MOST * s // WHOLE
    known = np.nonzero((low <= high).ravel())[0]
    if not len(known):
        return None
    slots = pa.table(
        {
            "slot": known,
            "anchor_id": np.repeat(ids, score.shape[1])[known],
            "positive_id": positive.ravel()[known],
            "positive_score": score.ravel()[known].astype(np.int64),
        }
    )
    negative = first_rows(index, ask(low, high, False, NEGATIVES))
    # No more rows than windows in a slice.
    known_slots = F.broadcast(negative.sparkSession.createDataFrame(slots))
    return negative.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(known_slots, "slot")


def hard_negatives(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    every: int = 100,
    scale: int = 256,
) -> DataFrame:
    """For each anchor (rows whose id is divisible by `every`) and each of its first POSITIVES other rows of the
    same label: the first NEGATIVES rows of other labels that score from LEAST to MOST percent of it.

    Rows without a label or a vector, or with a component that is null or not finite, take no part; a row
    without an id is no anchor and comes last among equal scores. Shorter vectors count as if zeros followed.
    Rows that share an id are rows of their own, so such an anchor has its results more than once. Scores are
    exact up to the range of a long and cut off there. Other columns are not looked at; an empty table, or one
    without anchors, gives no rows.
    """
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "negatives")
    index = build(written(usable(rows, id_column, vector_column, label_column, scale), "usable"))
    anchors = written(anchors_of(index, every), "numbered")
    size = max(1, SLICE_BYTES // (8 * max(1, index.shape.dims)))
    last = anchors.agg(F.max("place").alias("place")).first()["place"]
    for start in range(0, -1 if last is None else last + 1, size):
        part = anchors.where(F.col("place").between(start, start + size - 1)).orderBy("place")
        found = _slice_results(index, part.toArrow())
        if found is not None:
            known = [F.when(F.col(c) != _NO_ID, F.col(c)).alias(c) for c in ("positive_id", "negative_id")]
            names = ["anchor_id", "rank", "positive_score", "negative_score"]
            found.select(*names, *known).write.mode("append").parquet(path)
    if not exists(spark, path):
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(path)
