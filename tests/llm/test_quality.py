import random

import numpy as np
import pytest

from tickloom.llm import quality


def text(rng, good):
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(rng.randrange(5, 60))]
    if good:
        return " ".join(words) + "."
    return rng.choice([" ".join(w + "%%%" for w in words), " ".join([words[0]] * 40), " | ".join(words)])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, text(rng, good=i % 4 > 0), int(i % 4 > 0)) for i in range(400)]


def test_ranks_good_over_bad(spark, make_docs, rows):
    docs = make_docs([(i, t) for i, t, _ in rows] + [(None, "no id"), (1000, None), (1001, "")])
    labels = [(i, q) for i, _, q in rows[:300]] + [(None, 0), (1000, None), (9999, 0), (3, 7)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    ranking = quality.fit(quality.vectors(docs), frame)
    scores = {r.id: r.s for r in quality.vectors(docs).select("id", quality.score(ranking, quality.F.col("x")).alias("s")).collect()}
    assert len(scores) == len(rows) + 3
    assert all(0 <= s <= 1 for s in scores.values())
    wrong = [i for i, _, q in rows if (scores[i] >= quality.CUT) != q]
    assert len(wrong) <= 4
    kept = quality.keep(docs, ranking)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= quality.CUT}


def test_nothing_to_rank(spark, odd_docs, odd_rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(6, 1)], none.schema)):
        ranking = quality.fit(quality.vectors(odd_docs), labels)
        assert quality.keep(odd_docs, ranking).count() == len(odd_rows)
    assert quality.keep(no_docs, quality.fit(quality.vectors(no_docs), none)).count() == 0


def test_weights_are_a_minimum_of_the_pairwise_loss():
    rng = np.random.default_rng(1)
    n = len(quality.FEATURES)
    good, bad = rng.normal(0.3, 1, (60, n)), rng.normal(0, 1, (60, n))
    ranking = quality.learn(good, bad)
    swapped = quality.learn(bad, good)
    assert ranking.raw(good).mean() > ranking.raw(bad).mean()
    assert swapped.raw(good).mean() < swapped.raw(bad).mean()
    one = quality.learn(good[:1], bad[:1])
    assert one.raw(good[:1])[0] > one.raw(bad[:1])[0]


def test_held_out_accuracy(spark):
    """On the given tables: labels of the held-out fold are never seen."""
    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.01"
    found = queries()["op6_quality_ranking"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert found.where("predicted <> cast(score >= 0.3 as int)").isEmpty()
