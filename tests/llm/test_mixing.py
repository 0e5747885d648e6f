from collections import Counter, defaultdict

import numpy as np
import pytest

from tickloom.llm import mixing


def test_targets_share_out_what_is_cut_off():
    assert mixing.targets([]) == []
    assert mixing.targets([10]) == [15.0]
    assert mixing.targets([10, 100, 100]) == pytest.approx([20, 295 * 2 / 3, 295 / 3])
    assert mixing.targets([0, 0]) == [0, 0]
    found = mixing.targets([1000, 5, 700, 30, 0, 999])
    assert sum(found) == pytest.approx(1.5 * 2734)
    assert all(t <= 2 * s for t, s in zip(found, [1000, 5, 700, 30, 0, 999]))


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1000])
def test_permutation(count):
    seen = mixing.permuted(np.arange(count), count, 1, 2, 3)
    assert sorted(seen) == list(range(count))
    if count > 50:
        assert (seen != np.arange(count)).mean() > 0.9
        assert (seen != mixing.permuted(np.arange(count), count, 1, 2, 4)).mean() > 0.9


def test_draws_use_every_slot_once():
    sources = [mixing.Source(i, str(i), s, t) for i, (s, t) in enumerate([(90_000, 180_000.0), (40_000, 30_000.5), (70, 105.0), (0, 0.0)])]
    groups, used, per_shard = 2, Counter(), []
    for group in range(groups):
        for shard in mixing.draw(group, groups, sources):
            used.update(zip(shard["number"].tolist(), shard["block"].tolist()))
            per_shard.append(np.bincount(shard["number"], minlength=4) / len(shard["slot"]))
    for s in sources:
        assert sum(n for (number, _), n in used.items() if number == s.number) == s.slots
        assert all(n <= 2 for (number, _), n in used.items() if number == s.number)
    assert {b for n, b in used if n == 0} == set(range(sources[0].blocks))
    assert len({round(x[0], 4) for x in per_shard}) == len(per_shard)


def rows_of(make_docs, rows):
    return mixing.mix(make_docs(rows))


def check(plan, rows):
    """Sizes, caps and targets from the definition; returns (taken by row, plan's rows)."""
    found = mixing.taken(plan).collect()
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, mixing.targets([sizes[n] for n in names])))
    assert Counter((r.id, r["size"], r.source) for r in found) == Counter(
        (i, len((t or "").split()), s) for i, t, _, s in rows
    )
    got = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        got[r.source] += r.taken
    for name in names:
        assert abs(got[name] - wanted[name]) <= mixing.BLOCK_WORDS + 0.02 * wanted[name]
    return found


def test_mix_of_odd_rows(odd_docs, odd_rows):
    found = check(mixing.mix(odd_docs), odd_rows)
    again = mixing.taken(mixing.mix(odd_docs.repartition(5))).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(again, key=key)


def test_text_of_the_mix_is_the_words_taken(make_docs):
    rows = [(i, " ".join(f"w{i}.{j}" for j in range(i * 7 % 400)), "en", "abc"[i % 3]) for i in range(120)]
    rows += [(500, "same words twice", "en", None), (500, "same words twice", "en", None)]
    docs = make_docs(rows)
    plan = mixing.mix(docs)
    check(plan, rows)
    parts = mixing.mixed_text(plan, docs).orderBy("shard", "slot", "part").collect()
    texts, taken = {i: t for i, t, _, _ in rows}, Counter()
    blocks = defaultdict(int)
    for p in parts:
        words = p.text.split()
        assert len(words) == p.n_words and p.text in texts[p.doc_id]
        taken[p.doc_id] += p.n_words
        blocks[p.shard, p.slot] += p.n_words
    wanted = Counter()
    for r in mixing.taken(plan).collect():
        wanted[r.id] += r.taken
    assert taken == wanted - Counter()
    assert max(blocks.values()) <= mixing.BLOCK_WORDS


def test_empty(no_docs, make_docs):
    for docs in (no_docs, make_docs([(1, None), (2, " ")])):
        plan = mixing.mix(docs)
        assert sum(r.taken for r in mixing.taken(plan).collect()) == 0
        assert mixing.mixed_text(plan, docs).count() == 0


def test_query(spark, sf_dir):
    from __spark_entry__ import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = queries()["op3_source_mixing"](spark, sf_dir).collect()
    got, target = defaultdict(int), {}
    for r in found:
        got[r.source] += r.taken
        target[r.source] = r.target
    assert len(found) == len(docs) and sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in found))
    assert all(abs(got[s] - t) <= mixing.BLOCK_WORDS + 0.02 * t for s, t in target.items())
