import random

import numpy as np
import pytest

from tickloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, block string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def expected(rows, every=100):
    used = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        used.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    last = float("inf")

    def order(row):
        return (-row[0], last if row[1] is None else row[1])

    found = []
    for a, (anchor, label, v) in enumerate(used):
        if anchor is None or anchor % every:
            continue
        scores = [(sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in used[:a] + used[a + 1 :]]
        same = sorted([(s, i) for s, i, other in scores if other == label], key=order)[:5]
        rest = sorted([(s, i) for s, i, other in scores if other != label], key=order)
        for p, positive in same:
            inside = [(s, i) for s, i in rest if 80 * p <= 100 * s <= 100 * p][:5]
            found += [(anchor, positive, n + 1, i, p, s) for n, (s, i) in enumerate(inside)]
    return sorted(found, key=str)


def actual(spark, rows, **given):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = negatives.hard_negatives(table(spark, rows), **given).select(*columns)
    return sorted(map(tuple, found.collect()), key=str)


def near(rng, centres, n, start=0):
    rows = []
    for i in range(n):
        centre = centres[rng.randrange(len(centres))]
        rows.append((start + i, [float(x) for x in centre + 0.2 * rng_noise(rng, len(centre))], rng.randrange(4)))
    return rows


def rng_noise(rng, size):
    return np.array([rng.gauss(0, 1) for _ in range(size)])


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(13)
    return near(rng, [rng_noise(rng, 8) for _ in range(12)], 3000)


def test_equals_all_pairs(spark, clustered):
    found = actual(spark, clustered)
    assert found == expected(clustered) and len(found) > 200


def test_slices_and_steps_do_not_matter(spark, clustered, monkeypatch):
    monkeypatch.setattr(negatives, "SLICE_BYTES", 8 * 8 * 7)
    rows = clustered[:1500]
    assert actual(spark, rows) == expected(rows)


def test_nulls_ties_repeats_and_other_lengths(spark):
    rng = random.Random(3)
    rows = near(rng, [rng_noise(rng, 4) for _ in range(3)], 400)
    rows += rows[:100] + rows[100:101] * 150  # repeated rows, an anchor among them
    rows += [
        (500, None, 1),
        (600, [0.5, None, 0.1, 0.2], 1),
        (700, [0.5, float("nan"), 0.1, 0.2], 1),
        (800, [0.5, float("inf"), 0.1, 0.2], 1),
        (900, [0.5, 0.1, 0.1, 0.2], None),
        (None, [2.0, 2.0, 2.0, 2.0], 2),
        (None, [2.0, 2.0, 2.0, 2.0], 1),
        (1000, [], 1),
        (1100, [0.9], 1),
        (1200, [0.9, 0.8], 2),
        (-100, [0.3, 0.3, 0.3, 0.3], 0),
    ]
    assert actual(spark, rows) == expected(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-2e6, 2e6) for _ in range(6)], rng.randrange(3)) for i in range(300)]
    assert actual(spark, rows) == expected(rows)


def test_empty_tables(spark):
    assert actual(spark, []) == []
    assert actual(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert actual(spark, [(100, [1.0], 1)]) == []
    assert actual(spark, [(100, [], 1), (1, [], 1), (2, [], 2)]) == expected([(100, [], 1), (1, [], 1), (2, [], 2)])


def test_curve_steps_from_cell_to_neighbour():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        side = np.arange(1 << bits)
        cells = np.stack([c.ravel() for c in np.meshgrid(*[side] * dims)], axis=1)
        keys = [row.tobytes() for row in negatives.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[np.argsort(keys, kind="stable")]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_leave_blocks_out(spark):
    """Rows in tight clusters: the zone maps spare most blocks, and no row lies outside its block's interval."""
    rng = random.Random(5)
    centres = [20 * rng_noise(rng, 6) for _ in range(64)]
    rows = [(i, [float(x) for x in centres[i % 64] + 0.01 * rng_noise(rng, 6)], i % 3) for i in range(6400)]
    index = negatives.build(negatives.usable(table(spark, rows), "vec_id", "embedding", "label", 256))
    anchors = negatives.anchors_of(index, 100).orderBy("place").toArrow()
    block, row, ids, label = (anchors[c].to_numpy() for c in ("block", "row", "id", "label"))
    v = negatives._matrix(anchors["v"].combine_chunks(), 6)
    best = (v * v).sum(1).reshape(-1, 1)
    asked = negatives.Asked(block, row, ids, label, v, best * 9 // 10, best, False, 5, index.shape.plain)
    needed = {r.block: r.anchors for r in negatives.needs(index, asked).collect()}
    assert sum(needed.values()) < 0.25 * len(needed) * len(ids)
    for r in index.blocks.collect():
        comps = np.array(r.comps).reshape(-1, 6)
        scores = v @ comps.T
        met = ((scores >= asked.low) & (scores <= asked.high) & (label[:, None] != np.array(r.labels))).any(1)
        picked = asked.needed(r.block, *map(np.array, (r.least, r.greatest, r.kinds)))
        assert set(np.nonzero(met)[0]) <= set(picked.tolist())
    assert actual(spark, rows) == expected(rows)


def test_query_equals_all_pairs(spark, sf_dir):
    from __spark_entry__ import queries

    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ]
    found = queries()["op13_hard_negatives"](spark, sf_dir)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.select(*columns).collect()), key=str) == expected(rows)
