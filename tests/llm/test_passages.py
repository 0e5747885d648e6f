import random
from itertools import combinations

import numpy as np
import pytest

from tickloom.llm import passages

LEAST = passages.LENGTH + passages.SHINGLE - 1


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def spans(row):
    return {p for s in row.spans for p in range(s.start, s.stop)}


def test_windows_are_the_large_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(0)
    sizes = np.array([200, 10, 0, passages.LENGTH, 120])
    hashes = rng.integers(0, 2**63, sizes.sum(), dtype=np.uint64)
    hashes[60] = hashes[20]
    found = [tuple(map(list, w)) for w in passages.compact_windows(hashes, sizes)]
    assert len(found) == passages.HASHES
    for (multiplier, salt), (_, owner, at, first, last, _) in zip(passages._multipliers(), found):
        mixed = (hashes ^ salt) * multiplier
        mixed ^= mixed >> np.uint64(32)
        expected = []
        for d, size in enumerate(sizes):
            own = (mixed[sizes[:d].sum() :][:size] >> np.uint64(passages._PLACE_BITS)).tolist()
            nodes = []
            for i in range(size):
                a = i
                while a > 0 and own[a - 1] > own[i]:
                    a -= 1
                b = i
                while b < size - 1 and own[b + 1] >= own[i]:
                    b += 1
                if b - a + 1 >= passages.LENGTH:
                    lo, hi = max(a, i - passages.LENGTH + 1), min(i, b - passages.LENGTH + 1)
                    nodes.append((d, i, lo, hi))
            expected += sorted(nodes, key=lambda x: x[2])
        assert list(zip(owner, at, first, last)) == expected


@pytest.fixture(scope="module")
def planted():
    """Passages that repeat across documents: alone, in thousands of words, edited, and in a large group."""
    rng = random.Random(11)
    shared = [words(rng, n) for n in (51, 60, 120, 400)]
    docs, groups = {}, {}
    for g, passage in enumerate(shared):
        for copy in range(40 if g == 1 else 4):
            before, after = rng.randrange(0, 150), rng.randrange(0, 150)
            docs[len(docs)] = words(rng, before) + passage + words(rng, after)
            groups.setdefault(g, []).append((len(docs) - 1, before, len(passage)))
    edited = words(rng, 150)
    for copy in range(6):
        mine = list(edited)
        for at in (copy * 7, 75 + copy * 7):
            mine[at] = f"edit{copy}"
        if copy == 3:
            del mine[60]
        docs[len(docs)] = words(rng, 20) + mine + words(rng, 20)
        groups.setdefault("edited", []).append((len(docs) - 1, 20, len(mine)))
    clean = list(range(len(docs), len(docs) + 40))
    line = words(rng, 20)
    for i in clean:
        docs[i] = words(rng, 100) + line + words(rng, 100)
    docs[len(docs)] = words(rng, 49)
    docs[len(docs)] = docs[len(docs) - 1]
    return {i: " ".join(w) for i, w in docs.items()}, groups, [*clean, len(docs) - 1, len(docs) - 2]


def test_planted_passages_are_found_and_others_are_not(make_docs, planted):
    texts, groups, clean = planted
    found = {r.id: r for r in passages.repeated_passages(make_docs(list(texts.items()))).collect()}
    assert len(found) == len(texts)
    for members in groups.values():
        assert {found[i]["class"] for i, _, _ in members} == {min(i for i, _, _ in members)}
        for i, at, size in members:
            assert found[i].n_links > 0
            inside = set(range(at, at + size))
            assert len(spans(found[i]) & inside) >= 0.9 * size
            assert len(spans(found[i]) - inside) <= 12
    for i in clean:
        assert (found[i].n_links, found[i].n_words, found[i]["class"], found[i].spans) == (0, 0, i, [])


def test_query_against_brute_force(spark, sf_dir):
    """All pairs of documents with a passage of 50 equal words share a class, and all its words are found."""
    from __spark_entry__ import queries

    docs = {r.doc_id: r.text.encode().lower().split() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {r.doc_id: r for r in queries()["op7_repeated_passages"](spark, sf_dir).collect()}
    windows = {}
    for i, w in docs.items():
        for at in range(len(w) - LEAST + 1):
            windows.setdefault(tuple(w[at : at + LEAST]), []).append((i, at))
    missed, words_of, pairs = 0, {}, set()
    for places in windows.values():
        ids = {i for i, _ in places}
        pairs |= set(combinations(sorted(ids), 2))
        for i, at in places if len(ids) > 1 else ():
            words_of.setdefault(i, set()).update(range(at, at + LEAST))
    assert len(pairs) > 20
    for a, b in pairs:
        missed += found[a].class_id != found[b].class_id
    assert missed == 0
    for i, expected in words_of.items():
        got = {p for s in filter(None, found[i].spans.split(",")) for p in range(*map(int, s.split(":")))}
        assert len(expected - got) <= 0.02 * len(expected)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = passages.repeated_passages(odd_docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.id: r for r in found}
    assert by_id[6]["class"] == by_id[7]["class"] == 6 and by_id[6].n_words == 60_000
    assert all(r.n_links == 0 for r in found if r.id not in (6, 7))
    assert by_id[None]["class"] is None
    assert passages.repeated_passages(no_docs).count() == 0


def repeating(rng):
    """Exact passages that hold a sentence twice, or consist of one sentence."""
    once, twice, line = words(rng, 36), words(rng, 12), words(rng, 12)
    return [twice + once + twice, once[:18] + twice + once[18:] + twice, line * 6]


def test_passages_that_repeat_within_are_verified():
    rng = random.Random(5)
    for margin in (0, 5, 10):
        for passage in (p for _ in range(30) for p in repeating(rng)):
            mine, other = ([*words(rng, margin), *passage, *words(rng, margin)] for _ in range(2))
            (span,) = passages.verified(" ".join(mine).encode(), " ".join(other).encode())
            assert span["start"] <= margin and span["stop"] >= margin + len(passage)


def test_one_word_put_in_or_left_out_loses_no_passage(make_docs):
    rng = random.Random(6)
    texts, pairs = [], []
    for pair in range(120):
        passage = words(rng, LEAST)
        edited = passage[:25] + words(rng, 1) + passage[25:]
        if pair % 2:
            edited = passage[:25] + passage[26:] + words(rng, 1)
        for version in (passage, edited):
            texts.append((len(texts), " ".join([*words(rng, 30), *version, *words(rng, 30)])))
        pairs.append((len(texts) - 2, len(texts) - 1))
    found = {r.id: r["class"] for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) == len(pairs)


def test_sketches_keep_every_pair_at_the_similarity():
    """Of windows that hold passages at SIMILARITY, the bits in common and lost come to at least that share."""
    rng = np.random.default_rng(8)
    for _ in range(2000):
        passage = rng.integers(0, 2**63, passages.LENGTH, dtype=np.uint64)
        passage[: rng.integers(0, 30)] = passage[0]
        distinct = np.unique(passage)
        other = rng.permutation(distinct)[: int(np.ceil(passages.SIMILARITY * len(distinct)))]
        sides = []
        for tokens in (passage, np.resize(other, passages.LENGTH)):
            tokens = np.concatenate([tokens, rng.integers(0, 2**63, rng.integers(0, passages.LENGTH), dtype=np.uint64)])
            bits = passages._sketches(tokens)(np.array([0]), np.array([len(tokens)]))[0].view(np.uint64)
            sides.append((bits, len(tokens) - np.bitwise_count(bits).sum()))
        (a, lost), (b, lost_too) = sides
        assert np.bitwise_count(a & b).sum() + min(lost, lost_too) >= passages.SIMILARITY * passages.LENGTH


def test_first_and_last_holders_of_a_value_do_not_part_those_between(make_docs):
    """Documents between hold an exact passage; the first and the last hold variants below the similarity."""
    rng = random.Random(9)
    texts, groups = {}, []
    for group in range(40):
        passage = words(rng, 60)
        variants = [list(passage) for _ in range(4)]
        for at in (12, 24, 36, 48) if group % 2 else (15, 30, 45):
            variants[0][at], variants[3][at] = words(rng, 2)
        groups.append([1000 * k + group for k in range(4)])
        for i, variant in zip(groups[-1], variants):
            texts[i] = " ".join([*words(rng, 20), *variant, *words(rng, 20)])
    found = {r.id: r["class"] for r in passages.repeated_passages(make_docs(list(texts.items()))).collect()}
    assert [found[b] == found[c] for _, b, c, _ in groups] == [True] * len(groups)


def test_links_of_one_passage_grow_with_its_documents(make_docs):
    """A line of 50 words, and a variant of it with one word replaced, in N and 2N documents of other text."""
    rng = random.Random(12)
    line = words(rng, LEAST)
    variant = [*line[:25], "other", *line[26:]]
    counts = []
    for n in (40, 80):
        texts = [(i, " ".join([*words(rng, 60), *(variant if i % 4 == 3 else line), *words(rng, 60)])) for i in range(n)]
        docs = make_docs(texts)
        named = docs.select(docs.doc_id.cast("long").alias("doc"), docs.text.cast("binary").alias("text"))
        found = passages.links(named).select("doc", "other").distinct().collect()
        counts.append(len(found))
        classes = {r["class"]: r.n_links for r in passages.repeated_passages(docs).collect()}
        assert classes == {0: n - 1}
    assert counts[0] < 4 * 40 and counts[1] < 4 * 80


def test_cores_are_in_all_passages_and_enough_for_the_similarity():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 300, dtype=np.uint64)
    hashes[200:246] = hashes[100 : 100 + passages.LENGTH]
    for i in range(100, 100 + passages.LENGTH):
        # The same passage, with the same minimum, in two contexts.
        low, high, at = (np.array(x) for x in ([100 - 7, 200 - 20], [150, 260], [i, i + 100]))
        mine, counts = passages.cores(hashes, low, high, at)
        assert set(mine[: counts[0]].tolist()) & set(mine[counts[0] :].tolist())
    assert passages.CORE >= passages.SIMILARITY * (2 * passages.LENGTH - passages.CORE)


def jaccard(a, b):
    return len(a & b) / len(a | b)


def shingles(text):
    return passages.tokens(" ".join(text).encode().split()).tolist()


def minima(text):
    found = passages.compact_windows(np.array(shingles(text), dtype=np.uint64), np.array([passages.LENGTH]))
    return {int(w[0][0]) for w in found}


def test_passages_that_share_no_minimum_are_linked(make_docs):
    """Passages at the similarity, of documents that consist of them, with other minima under all hash functions."""
    rng = random.Random(21)
    texts, wanted = [], []
    while len(wanted) < 6:
        passage = words(rng, LEAST)
        at = rng.randrange(5, 45)
        edited = [*passage[:at], "other", *passage[at + 1 :]]
        if minima(passage) & minima(edited):
            continue
        assert jaccard(set(shingles(passage)), set(shingles(edited))) >= passages.SIMILARITY
        wanted.append((len(texts), len(texts) + 1))
        texts += [(len(texts), " ".join(passage)), (len(texts) + 1, " ".join(edited))]
    found = {r.id: (r["class"], r.n_links) for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert [found[b] for _, b in wanted] == [(a, 1) for a, _ in wanted]


def test_passages_with_moved_parts_are_linked(make_docs):
    """The halves of a passage in the other order; nothing is at about the same place."""
    rng = random.Random(22)
    texts, wanted = [], []
    for margin in (0, 0, 20, 40):
        passage = words(rng, LEAST)
        moved = [*passage[25:], *passage[:25]]
        assert jaccard(set(shingles(passage)), set(shingles(moved))) >= passages.SIMILARITY
        wanted.append((len(texts), len(texts) + 1))
        for version in (passage, moved):
            texts.append((len(texts), " ".join([*words(rng, margin), *version, *words(rng, margin)])))
    found = {r.id: r["class"] for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert [found[b] for _, b in wanted] == [a for a, _ in wanted]


def test_passages_alike_and_small_windows_against_brute_force():
    """Of token lists that repeat within: pairs of passages at the similarity, and that their windows share a value."""
    rng = random.Random(23)
    found = 0
    for trial in range(150):
        left = [rng.randrange(1, 10**9) for _ in range(rng.randrange(30, 60))]
        left += [rng.choice(left) for _ in range(rng.randrange(20))]
        right = [rng.randrange(1, 10**9) if rng.random() < 0.03 else token for token in left]
        if trial % 2:
            right = right[20:] + right[:20]
        sets = [[set(s[x : x + passages.LENGTH]) for x in range(len(s) - passages.LENGTH + 1)] for s in (left, right)]
        near = [(x, y) for x, a in enumerate(sets[0]) for y, b in enumerate(sets[1]) if jaccard(a, b) >= passages.SIMILARITY]
        got = passages.passages_alike(left, right)
        assert got == [(x, min(y for z, y in near if z == x), max(y for z, y in near if z == x)) for x in sorted({x for x, _ in near})]
        hashes, sizes = np.array([*left, *right], dtype=np.uint64), np.array([len(left), len(right)])
        held = [{}, {}]
        for key, owner, _, first, last, _ in passages.small_windows(hashes, sizes):
            for k, o, a, b in zip(key.tolist(), owner.tolist(), first.tolist(), last.tolist()):
                for start in range(a, b + 1):
                    held[o].setdefault(start, set()).add(k)
        assert all(held[0][x] & held[1][y] for x, y in near)
        found += len(near)
    assert found > 100


def test_rarest_of_the_smallest_share_a_value_against_brute_force():
    """Pairs of passages at the similarity share a rare value, however tokens repeat and whatever else has them."""
    rng = random.Random(29)
    found = 0
    for trial in range(100):
        left = [rng.randrange(1, 10**9) for _ in range(rng.randrange(30, 60))]
        left += [rng.choice(left) for _ in range(rng.randrange(40) if trial % 3 else 0)]
        if trial % 5 == 0:
            left = [token for token in left for _ in range(rng.randrange(1, 4))]
        right = [rng.randrange(1, 10**9) if rng.random() < 0.03 else token for token in left]
        if trial % 2:
            right = right[20:] + right[:20]
        if len(left) < passages.LENGTH:
            continue
        hashes, sizes = np.array([*left, *right], dtype=np.uint64), np.array([len(left), len(right)])
        docs, bits = {}, {}
        for key, doc, held in zip(*(x.tolist() for x in passages.kept_values(hashes, sizes))):
            docs.setdefault(key, set()).add(doc)
            bits[key] = bits.get(key, 0) | held
        n = {key: len(of) + (rng.randrange(50) if len(of) > 1 else 0) for key, of in docs.items()}
        keys = (passages._mixed(hashes) & ~np.uint64(passages.HASHES - 1)).view(np.int64).tolist()
        rare = {}
        windows = passages.rare_windows(
            hashes, sizes, np.array([n.get(k, 1) for k in keys]), np.array([bits.get(k, 0) for k in keys])
        )
        for i, first, last in zip(*(x.tolist() for x in windows)):
            for start in range(first, last + 1):
                rare.setdefault(start, set()).add(keys[i])
        sets = [[set(s[x : x + passages.LENGTH]) for x in range(len(s) - passages.LENGTH + 1)] for s in (left, right)]
        for x, a in enumerate(sets[0]):
            for y, b in enumerate(sets[1]):
                if jaccard(a, b) >= passages.SIMILARITY:
                    found += 1
                    assert rare[x] & rare[len(left) + y]
    assert found > 1000


def test_frequent_phrases_leave_no_windows():
    """Passages that share but a phrase of few shingles with others, in documents of their own words."""
    rng = np.random.default_rng(31)
    phrase = rng.integers(0, 2**63, 12, dtype=np.uint64)
    own = [rng.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(40)]
    hashes = np.concatenate([np.concatenate([o[:30], phrase, o[30:]]) for o in own])
    sizes = np.full(40, 72)
    n = np.where(np.isin(hashes, phrase), 40, 1)
    _, owner, *_ = next(passages.small_windows(hashes, sizes))
    windows = passages.rare_windows(hashes, sizes, n, np.full(len(hashes), 1 << passages.LENGTH))[0]
    assert len(windows) <= 0.1 * len(owner)


def test_shuffled_data_is_deleted_once_written(spark, tmp_path):
    """What a written table's shuffle left on disk does not outlast the write."""
    from tickloom.llm.common import swept

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with swept(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_near_passages_of_one_class_are_all_in_spans(make_docs):
    """Two documents hold a passage and a variant of it; documents before them, linked to them by another passage, hold
    variants below the similarity, but all its shingles between them."""
    rng = random.Random(41)
    texts, wanted = [], []
    for group in range(30):
        link, passage = words(rng, 60), words(rng, LEAST)
        edited = [*passage[:25], "other", *passage[26:]]
        variants = [list(passage) for _ in range(2)]
        for variant, places in zip(variants, ((12, 36), (4, 30))):
            for at in places:
                variant[at] = f"variant{at}"
        for part in (*variants, passage, edited):
            wanted += [(len(texts), 100, LEAST)] if part in (passage, edited) else []
            texts.append((len(texts), " ".join([*link, *words(rng, 40), *part, *words(rng, 40)])))
    found = {r.id: r for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert all(found[i]["class"] == i // 4 * 4 for i in found)
    assert all(set(range(at, at + size)) <= spans(found[i]) for i, at, size in wanted)


def test_copies_in_one_document_are_all_in_spans(make_docs):
    """A passage stands twice in one document; the other has it with words replaced."""
    rng = random.Random(42)
    texts, wanted = [], []
    for group in range(10):
        passage = words(rng, 130)
        edited = [word if at % 44 != 22 else "other" for at, word in enumerate(passage)]
        twice = [*words(rng, 30), *passage, *words(rng, 30), *passage, *words(rng, 30)]
        wanted.append((len(texts), {*range(30, 160), *range(190, 320)}))
        texts += [(len(texts), " ".join(twice)), (len(texts) + 1, " ".join([*words(rng, 30), *edited, *words(rng, 30)]))]
    found = {r.id: r for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert all(expected <= spans(found[i]) for i, expected in wanted)


def test_a_part_at_another_place_is_verified_beside_one_at_the_same():
    rng = random.Random(43)
    first, second, own = words(rng, 60), words(rng, 60), words(rng, 60)
    found = passages.verified(" ".join(first + second + own).encode(), " ".join(first + own[::-1] + second).encode())
    assert {p for s in found for p in range(s["start"], s["stop"])} == set(range(120))
    assert {p for s in found for p in range(s["other_start"], s["other_stop"])} == {*range(60), *range(120, 180)}


def test_missing_tokens_choose_the_pairs():
    """Windows of a value are compared only with those that have a token which is missing in their documents' spans."""
    import pyarrow as pa

    rng = np.random.default_rng(44)
    common, own = rng.integers(0, 2**32, 45, dtype=np.uint32), rng.integers(0, 2**32, 20, dtype=np.uint32)
    rows = []
    for doc in range(40):
        extra = own[doc // 2 :][:1] if doc < 4 else own[:0]
        rows.append((doc, np.concatenate([common, extra, common[:3]]), np.concatenate([extra, extra])))
    columns = {"doc": list(range(40)), "key": [5 if doc % 40 != 3 else 6 for doc in range(40)]}
    columns |= {name: pa.array([0] * 40, pa.int32()) for name in ("i", "first", "last", "lost")}
    columns |= {"least": pa.array([0] * 40, pa.int32())} | {name: [0] * 40 for name in passages.SKETCH}
    columns |= {"tokens": [t.tobytes() for _, t, _ in rows], "missing": [m.tobytes() for _, _, m in rows]}
    batch = pa.RecordBatch.from_pydict(columns)
    order = pa.array(np.argsort(np.array(columns["key"]), kind="stable"))
    batch = batch.take(order)
    for size in (3, 40):
        parts = [batch.slice(at, size) for at in range(0, 40, size)]
        pairs = {(a, b) for p in passages._worth(iter(parts)) for a, b in zip(p["a_doc"].to_pylist(), p["b_doc"].to_pylist())}
        assert pairs == {(0, 1), (1, 0)}
