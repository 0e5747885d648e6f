"""SimHash near duplicates by anchor-point covering.

A fingerprint is a point of the 64-dimensional cube. The anchors are the words of a covering
code: the perfect one-error-correcting code of length 63 times the free 64th bit, so every point
lies within COVERING_RADIUS = 1 of an anchor. Two fingerprints that differ in at most t bits
have a common midpoint within ceil(t / 2) of both, and that midpoint's anchor lies within
covering radius + ceil(t / 2) of both. So a fingerprint goes to every anchor that near (the
threshold counts once for the pair, half at each end), and only fingerprints that meet at an
anchor are compared. For t = 2 that is 33 anchors or fewer a fingerprint out of 2^58, whatever the
size of the corpus; and since a ball of radius 2 holds 2,081 points, an anchor never has more
members than that, however hot a group is.

Exact copies share a fingerprint and travel as one row. Links are written between fingerprints,
never between documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, on_texts, written
from tickloom.llm.components import components

COVERING_RADIUS = 1
THRESHOLD = 2
SEED = 42
SHINGLE = 3
#: Hashes whose bits are counted at a time.
VOTERS = 1 << 15


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For groups of these sizes laid end to end: the bits set in over half of a group's hashes.

    A bit takes five bytes while it is counted, so this is done for a few hashes at a time, however long a text is.
    """
    starts = np.cumsum(counts) - counts
    votes = np.zeros((len(counts), 64), dtype=np.int32)
    for low in range(0, len(hashes), VOTERS):
        part = hashes[low : low + VOTERS]
        first, end = np.searchsorted(starts, [low, low + len(part)], side="left")
        first -= first == len(starts) or starts[first] > low
        begin = np.maximum(starts[first:end] - low, 0)
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes[first:end] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > counts[:, None], axis=1).view(">u8")[:, 0]


def _fingerprints(texts: list[bytes | None]) -> pa.Array:
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes, counts, rows = [], [], []
    for row, text in enumerate(texts):
        words = text.lower().split() if text else []
        if not words:
            continue
        n = max(1, len(words) - SHINGLE + 1)
        if len(words) <= SHINGLE:
            shingles = iter([b" ".join(words)])
        else:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE))))
        hashes.append(np.fromiter(map(digest, shingles, repeat(SEED)), dtype=np.uint64, count=n))
        counts.append(n)
        rows.append(row)
    if rows:
        out[rows] = _majority(np.concatenate(hashes), np.array(counts))
    return pa.array(out.view(np.int64))


#: Text to fingerprint, the 64 bits as a long. Null and wordless texts give 0.
fingerprint = on_texts(_fingerprints, pa.int64())


def anchors(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the point, anchor) for every anchor within `radius` of every point.

    Bit i of a point (i < 63) has the column i + 1 of the code's parity check, so the syndrome of
    a point is the exclusive-or of the columns of its set bits, and a pattern of flips leads to an
    anchor just if the columns of the flipped bits add up to that syndrome.
    """
    points = points.view(np.uint64)
    syndrome = np.zeros(len(points), dtype=np.int64)
    for i in range(63):
        syndrome ^= np.where((points >> np.uint64(i)) & np.uint64(1), i + 1, 0)
    flips, sums = [np.uint64(0)], [0]
    for size in range(1, radius + 1):
        for chosen in combinations(range(64), size):
            flips.append(np.bitwise_or.reduce([np.uint64(1) << np.uint64(i) for i in chosen]))
            sums.append(int(np.bitwise_xor.reduce([(i + 1) % 64 for i in chosen])))
    flips, sums = np.array(flips), np.array(sums)
    order = np.argsort(sums, kind="stable")
    starts = np.searchsorted(sums[order], np.arange(65))
    counts = starts[syndrome + 1] - starts[syndrome]
    owner = np.repeat(np.arange(len(points)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    picked = order[starts[syndrome][owner] + place]
    return owner, (points[owner] ^ flips[picked]).view(np.int64)


def _replicas(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.asarray(batch.column(0))
            for start in range(0, len(points), 4096):
                part = points[start : start + 4096]
                owner, anchor = anchors(part, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[owner])], names=["anchor", "point"]
                )

    return run


def _links_at(threshold: int):
    """Members of one anchor to the links that connect whatever lies within the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(0)
            flat = np.asarray(members.flatten()).view(np.uint64)
            counts = np.asarray(pc.list_value_length(members)).astype(np.int64)
            starts = np.cumsum(counts) - counts
            left, right = [], []
            two = starts[counts == 2]
            near = np.bitwise_count(flat[two] ^ flat[two + 1]) <= threshold
            left.append(flat[two][near])
            right.append(flat[two + 1][near])
            for start, count in zip(starts[counts > 2], counts[counts > 2]):
                points = np.sort(flat[start : start + count])
                # A forest of the anchor's graph: breadth first, each point is reached once.
                waiting = np.ones(count, dtype=bool)
                while waiting.any():
                    front = [int(np.argmax(waiting))]
                    waiting[front[0]] = False
                    while front:
                        at = front.pop()
                        found = np.flatnonzero(
                            waiting & (np.bitwise_count(points ^ points[at]) <= threshold)
                        )
                        waiting[found] = False
                        front.extend(found.tolist())
                        left.append(np.full(len(found), points[at]))
                        right.append(points[found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)],
                names=["a", "b"],
            )

    return run


def links(points: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) that connect exactly the distinct points (column `point`, long) within
    `threshold` bits of each other, directly or over others. At an anchor only a forest is
    written, not all pairs."""
    radius = COVERING_RADIUS + (threshold + 1) // 2
    replicas = points.select("point").mapInArrow(_replicas(radius), "anchor long, point long")
    met = (
        replicas.groupBy("anchor")
        .agg(F.collect_set("point").alias("members"))
        .where(F.size("members") > 1)
        .select("members")
    )
    return met.mapInArrow(_links_at(threshold), "a long, b long").distinct()


def _labelled(docs: DataFrame, id_column: str, text_column: str, threshold: int):
    """The fingerprinted rows (id, point), and (point, first_id, class, component) for each distinct point."""
    rows = written(
        docs.select(F.col(id_column).alias("id"), fingerprint(F.col(text_column)).alias("point")),
        "fingerprints",
    )
    points = written(rows.groupBy("point").agg(F.min("id").alias("first_id")), "points")
    reached = components(links(points, threshold)).withColumnRenamed("node", "point")
    # A point without links is a class of its own, so that no join key is null.
    named = points.join(reached, "point", "left").select(
        "point", "first_id", F.coalesce("component", "point").alias("class")
    )
    named = written(named, "classes")
    least = named.groupBy("class").agg(F.min("first_id").alias("component"))
    return rows, named.join(least, "class").select("point", "first_id", "class", "component")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """(id, point, component): one row per row of docs.

    `point` is the fingerprint, `component` the smallest id among all documents that can be
    reached over links. Null and wordless texts have fingerprint 0 and are linked like any other.
    A row with a null id is kept; nulls are ignored in the minimum, so the component is null only
    if no reachable row has an id. Repeated rows give repeated rows. An empty table gives none.
    """
    rows, labelled = _labelled(docs, id_column, text_column, threshold)
    return rows.join(labelled, "point").select("id", "point", "component")


def hexed(point: Column) -> Column:
    return F.lower(F.lpad(F.hex(point), 16, "0"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with one left of each group of near duplicates: the one with the smallest id.

    A row is named by its id and fingerprint, so rows that repeat an id with other texts are documents of their
    own. Rows with a null id cannot be told apart, so all of them stay. All columns come back as they are,
    whatever their names.
    """
    named = docs.where(F.col(id_column).isNotNull())
    _, labelled = _labelled(named, id_column, text_column, THRESHOLD)
    (point,) = fresh(docs, "point")
    # Of the fingerprints of a group under its smallest id, one.
    stays = labelled.where("first_id = component").groupBy("class").agg(
        F.min("first_id").alias(id_column), F.min("point").alias(point)
    )
    pointed = named.withColumn(point, fingerprint(F.col(text_column)))
    kept = pointed.join(stays.select(id_column, point), [id_column, point], "left_semi").dropDuplicates([id_column, point])
    kept = kept.select(*(F.col(f"`{c}`") for c in docs.columns))
    return kept.unionByName(docs.where(F.col(id_column).isNull()))
