import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language

SYLLABLES = {"xx": "ka lo mi ta ru".split(), "yy": "schp brö ült ench gner".split(), "zz": "ção eiro nha ões lhe".split()}


def sentence(rng, name, words):
    return " ".join("".join(rng.choices(SYLLABLES[name], k=rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    return [(i, sentence(rng, name, rng.randrange(3, 80)), name) for i in range(300) for name in [rng.choice("xx yy zz".split())]]


def counted(rows):
    columns = []
    for name in sorted(SYLLABLES):
        column = np.full(1 << language.BITS, language.SMOOTHING)
        for _, text, lang in rows:
            if lang == name:
                column += np.bincount(language.trigrams([text.encode()])[0], minlength=len(column))
        columns.append(np.log(column / column.sum()).astype(np.float32))
    return language.Model(sorted(SYLLABLES), np.stack(columns, axis=1))


def test_learned_counts_are_those_of_all_rows(make_docs, rows):
    docs = make_docs([(i, t, n) for i, t, n in rows] + [(900, None, "xx"), (901, "abc", None), (902, "", "yy")])
    model, expected = language.learn(docs), counted(rows)
    assert model.languages == expected.languages
    assert np.allclose(model.table, expected.table, atol=1e-6)


def test_mixtures(rows):
    model, rng = counted(rows), random.Random(9)
    pure = [(sentence(rng, n, 20), n) for n in "xx yy zz".split() * 20]
    found = model.predict([t.encode() for t, _ in pure]).to_pylist()
    assert [f["language"] for f in found] == [n for _, n in pure]
    assert all(len(f["mixture"]) == 1 and f["score"] == 1 for f in found)
    for share in (0.2, 0.35, 0.6):
        n = 300
        mixed = sentence(rng, "xx", int(n * share)) + " " + sentence(rng, "yy", n - int(n * share))
        got = {m["language"]: m["share"] for m in model.predict([mixed.encode()]).to_pylist()[0]["mixture"]}
        assert set(got) == {"xx", "yy"} and abs(got["xx"] - share) < 0.02
    three = " ".join(sentence(rng, n, 100) for n in SYLLABLES)
    assert len(model.predict([three.encode()]).to_pylist()[0]["mixture"]) == 3


def test_one_text_alone_or_among_others(rows):
    model = counted(rows)
    texts = [t.encode() for _, t, _ in rows[:40]] + [None, b"", b"123"]
    together = model.predict(texts).to_pylist()
    alone = [model.predict([t]).to_pylist()[0] for t in texts]
    for a, b in zip(together, alone):
        assert a["language"] == b["language"] and a["score"] == pytest.approx(b["score"], abs=1e-4)


def test_expectation_maximisation_never_lowers_the_likelihood(rows):
    model = counted(rows)
    scores, owner = model.words([(rows[0][1] + " " + rows[1][1] + " " + rows[2][1]).encode()])
    even = np.full((1, 3), 1 / 3)
    values = [model.fit(scores, owner, even, rounds)[1][0] for rounds in range(8)]
    assert all(b >= a - 1e-3 for a, b in zip(values, values[1:]))


def test_odd_rows(odd_docs, odd_rows, no_docs):
    model = language.learn(odd_docs)
    column = language.identify(odd_docs, model, F.col("text")).alias("f")
    found = odd_docs.select("doc_id", "text", column).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.f.language == "und") == (not letters) and 0 <= r.f.score <= 1
        assert (r.f.score == 0) == (not letters)
    nothing = language.learn(no_docs)
    assert no_docs.select(language.identify(no_docs, nothing, F.col("text"))).count() == 0
    unknown = odd_docs.select(language.identify(odd_docs, nothing, F.col("text")).alias("f"))
    assert {r.f.language for r in unknown.collect()} == {"und"}


def test_held_out_accuracy(spark):
    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.01"
    found = queries()["op1_language_mixture"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99
