import tracemalloc
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tickloom.llm import simhash
from tickloom.llm.components import components


def brute(text):
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def united(ids, pairs):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_query_equals_brute_force(spark, sf_dir):
    from __spark_entry__ import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    points = {i: brute(t) for i, t in docs.items()}
    near = [(a, b) for a, b in combinations(docs, 2) if (points[a] ^ points[b]).bit_count() <= 2]
    expected = united(docs, near)
    found = queries()["op2_simhash_near_dedup"](spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.fingerprint == f"{points[r.doc_id]:016x}"
        assert r.component_id == expected[r.doc_id]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_links_connect_just_what_is_near(spark, threshold):
    rng = np.random.default_rng(threshold)
    centres = rng.integers(-(2**63), 2**63 - 1, 12)
    points = set(map(int, centres))
    for c in centres:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            mask = np.bitwise_xor.reduce([np.uint64(0)] + [np.uint64(1) << np.uint64(f) for f in flips])
            points.add(int((np.uint64(int(c) & (2**64 - 1)) ^ mask).view(np.int64)))
    points |= {0, 1, 3, -1, -(2**63), 2**63 - 1}
    frame = spark.createDataFrame([(p,) for p in points], "point long")
    found = [(r.a, r.b) for r in simhash.links(frame, threshold).collect()]
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert all(bits(a, b) <= threshold for a, b in found)
    near = [p for p in combinations(points, 2) if bits(*p) <= threshold]
    assert united(points, found) == united(points, near)


def test_anchors_are_all_and_only_code_words_in_reach():
    points = np.array([0, 1, 12345678901234567, -5], dtype=np.int64)
    owner, anchor = simhash.anchors(points, 2)
    assert np.bincount(owner).max() <= 33
    for o, a in zip(owner, anchor):
        assert (int(points[o]) ^ int(a)) & (2**64 - 1) < 2**64
        assert bin((int(points[o]) ^ int(a)) & (2**64 - 1)).count("1") <= 2
        syndrome = 0
        for i in range(63):
            syndrome ^= (i + 1) if int(a) >> i & 1 else 0
        assert syndrome == 0
    # Every point has an anchor within the covering radius.
    near, _ = simhash.anchors(points, simhash.COVERING_RADIUS)
    assert set(near) == set(range(len(points)))


def test_a_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in components(chain).collect()}
    assert len(found) == 303
    assert len({found[i] for i in range(301)}) == 1
    assert found[1000] == found[1001] != found[0]


def test_odd_rows(odd_docs, odd_rows):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.id: r for r in found if r.id is not None}
    assert [by_id[i].point for i in (1, 2, 3)] == [0, 0, 0]
    assert {by_id[i].component for i in (1, 2, 3)} == {1}
    assert by_id[5].component == 4 and by_id[7].component == 6
    assert {r.component for r in found if r.id is None} == {None}


def test_one_of_each_group_stays(odd_docs, make_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 6, 8, 9]
    assert sum(r.doc_id is None for r in rows) == 2
    assert all(r.point == "point!" for r in rows)
    repeated = make_docs([(2, "a b c d e f g"), (2, "a b c d e f g"), (3, "a b c d e f g")])
    assert [r.doc_id for r in simhash.keep_one(repeated).collect()] == [2]


def test_rows_that_repeat_an_id_with_other_texts_stay(make_docs):
    texts = ["a b c d e f g", "h i j k l m n", "o p q r s t u"]
    docs = make_docs([(1, texts[0]), (2, texts[1]), (2, texts[2]), (2, texts[2]), (2, texts[0]), (3, texts[1])])
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == [(1, texts[0]), (2, texts[1]), (2, texts[2])]


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_bits_are_counted_in_bounded_memory(monkeypatch):
    """4 MB of texts, one of them a quarter of it, take a few times their size; blocks may part a text anywhere."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, n)).encode() for n in (180_000, *[600] * 900)]
    tracemalloc.start()
    try:
        whole = simhash._fingerprints(texts)
        assert tracemalloc.get_traced_memory()[1] < 80 << 20
    finally:
        tracemalloc.stop()
    assert whole[5].as_py() == np.array(brute(texts[5].decode()), dtype=np.uint64).view(np.int64)
    few = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (3, 1, 40, 7, 4, 90, 5, 2)]
    expected = [brute(t) for t in few]
    for block in (1, 2, 7, 38, 39, 1000):
        monkeypatch.setattr(simhash, "VOTERS", block)
        assert [x.as_py() & (1 << 64) - 1 for x in simhash._fingerprints([t.encode() for t in few])] == expected
