import itertools
import random

import numpy as np
import pytest

from tickloom.llm import toxicity

INSULTS = [f"insult{c}" for c in "abcdef"]
GROUPS = [f"group{c}" for c in "uvwxyz"]


def text(rng, toxic):
    """Toxic is an insult beside a group; insults alone, in any number, and groups alone are not."""
    words = ["".join(rng.choices("aeiostn", k=5)) for _ in range(rng.randrange(5, 40))]
    kind = 3 if toxic else rng.randrange(3)
    if kind in (1, 3):
        words += rng.sample(INSULTS, 1 if toxic else rng.randrange(1, 4))
    if kind in (2, 3):
        words += rng.sample(GROUPS, 1 if toxic else rng.randrange(1, 4))
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [(i, text(rng, i % 2 == 0), int(i % 2 == 0)) for i in range(2400)]


def scores(docs, machine):
    found = docs.select("doc_id", "text", toxicity.score(machine, toxicity.F.col("text")).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in found)
    return found


def test_pairs_tell_what_words_alone_do_not(spark, make_docs, rows):
    docs = make_docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:1800]], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    label = {i: y for i, _, y in rows}
    held = [r for r in scores(docs, machine) if r.doc_id >= 1800]
    assert np.mean([(r.s >= toxicity.CUT) == label[r.doc_id] for r in held]) > 0.97
    numbers = toxicity.Terms(machine.chosen)
    def margin(*words):
        found = np.array(sorted(numbers.of(" ".join(words).encode())))
        return machine.margin(found, np.zeros(len(found), int), 1)[0]
    crossed = [margin(a, b) - margin(a) - margin(b) + machine.bias for a, b in itertools.product(INSULTS, GROUPS)]
    assert min(crossed) > 0
    kept = toxicity.keep_clean(docs, machine)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in scores(docs, machine) if r.s < toxicity.CUT}


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(np.arange(20), 0.3, rng.normal(size=20), rng.normal(size=(20, toxicity.FACTORS)))
    sets = [sorted(rng.choice(20, k, replace=False)) for k in (0, 1, 2, 7)]
    found = machine.margin(np.concatenate(sets).astype(int), np.repeat(range(4), [0, 1, 2, 7]), 4)
    for numbers, margin in zip(sets, found):
        pairs = sum(machine.factors[i] @ machine.factors[j] for i, j in itertools.combinations(numbers, 2))
        assert margin == pytest.approx(0.3 + machine.weights[numbers].sum() + pairs)


def test_learning_takes_the_loss_down():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 9, 600)
    numbers = np.concatenate([rng.choice(40, k, replace=False) for k in sizes])
    owner = np.repeat(np.arange(600), sizes)
    has = np.zeros((600, 40), bool)
    has[owner, numbers] = True
    label = (has[:, 1] & has[:, 2] | has[:, 3]).astype(int)
    machine = toxicity.learn(numbers, sizes, label, np.arange(40))
    margin = machine.margin(numbers, owner, 600)
    assert np.log1p(np.exp(-np.where(label, margin, -margin))).mean() < 0.1
    again = toxicity.learn(numbers, sizes, label, np.arange(40))
    assert (again.weights == machine.weights).all()


def test_ratios_against_the_definition():
    counts, totals = np.array([[5, 40], [10, 1], [0, 0], [100, 50]]), np.array([100, 50])
    found = toxicity.ratios(counts, totals)
    for (clean, toxic), g in zip(counts, found):
        cells = [clean, toxic, 100 - clean, 50 - toxic]
        row = [clean + toxic, 150 - clean - toxic]
        want = [row[0] * 100 / 150, row[0] * 50 / 150, row[1] * 100 / 150, row[1] * 50 / 150]
        assert g == pytest.approx(2 * sum(c * np.log(c / w) for c, w in zip(cells, want) if c))


def test_words_and_beginnings():
    assert toxicity.words("Ünder_the  BRIDGE, 42!\n\x00x".encode()) == {"ünder", "the", "bridge", "42", "x"}
    assert toxicity.words(None) == toxicity.words(b"") == toxicity.words(b" \n") == set()
    one, other = set(toxicity.buckets("stemform")), set(toxicity.buckets("stemless"))
    assert len(one) == 6 and len(one & other) == 2


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(6, 1), (None, 0), (2, None), (3, 5)], none.schema)):
        machine = toxicity.fit(odd_docs, labels)
        assert {r.s for r in scores(odd_docs, machine)} == {0.5}
        assert toxicity.keep_clean(odd_docs, machine).count() == len(odd_rows)
    both = spark.createDataFrame([(6, 1), (6, 0), (6, 1), (5, 0), (1, 0), (99, 1)], none.schema)
    found = scores(odd_docs, toxicity.fit(odd_docs, both))
    assert len(found) == len(odd_rows)
    empty = toxicity.fit(no_docs, both)
    assert scores(no_docs, empty) == [] and not len(empty.chosen)


def test_held_out_accuracy(spark):
    """Labels of the held-out fold are never seen. Some toxic documents of this table are junk without any
    word that tells them from other junk."""
    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.1"
    found = queries()["op11_toxicity"](spark, sf_dir)
    rows = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert len(toxic) > 80
    assert np.mean([r.predicted for r in toxic]) > 0.8
    assert np.mean([r.toxic for r in rows if r.predicted]) > 0.95
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.97
    assert found.where("predicted <> cast(score >= 0.7 as int)").isEmpty()
