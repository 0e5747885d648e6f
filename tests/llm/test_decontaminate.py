import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items):
    """Words, marked places and names of items, by looking everywhere."""
    words, hit, names = WORD.findall((text or "").translate(LOWER)), set(), set()
    for name, item in items:
        given = WORD.findall((item or "").translate(LOWER))
        n = min(10, len(given))
        for start in range(len(given) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == given[start : start + n]:
                    hit |= set(range(at, at + n))
                    names |= {name} - {None}
    return len(words), len(hit), sorted(names)


def found(docs, benchmark):
    rows = decontaminate.hits(docs, benchmark, "what").select("doc_id", "what.*").collect()
    return [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows]


@pytest.mark.parametrize("slice_words", [2_000_000, 40])
def test_equals_looking_everywhere(spark, make_docs, monkeypatch, slice_words):
    """Also when the benchmark is scanned in many slices."""
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", slice_words)
    rng = random.Random(1)
    word = lambda: rng.choice(["ab", "Cd", "e", "fé", "x9", "zz"])
    items = [(str(i), " ".join(word() for _ in range(rng.choice([0, 1, 4, 10, 12, 25])))) for i in range(12)]
    items = [(n, t) for n, t in items if len(t.split()) != 1] + [("one", "Solitary"), (None, "no name here"), ("n", None)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(40)))]
        for _ in range(rng.randrange(3)):
            given = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(len(given) + 1)
            parts.append("-".join(given[cut:]) if rng.random() < 0.5 else ", ".join(given).upper())
        texts.append("\n".join(parts))
    texts += [None, "", "!!", "solitary solitary, a", " ".join(texts) * 3]
    docs = make_docs([(i, t) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = found(docs, benchmark)
    assert len(got) == len(texts)
    assert sum(1 for r in got if r[2]) > 20
    for i, n_words, n_hit, names in got:
        assert (n_words, n_hit, names) == brute(texts[i], items)


def test_clean_keeps_columns_and_clean_rows(spark, odd_docs, odd_rows):
    benchmark = spark.createDataFrame([(1, "a text without")], "item_id long, text string")
    kept = decontaminate.clean(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == len(odd_rows) - 2 and all(r.found == "found!" for r in rows)


def test_empty_tables(spark, odd_docs, odd_rows, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert decontaminate.clean(odd_docs, nothing).count() == len(odd_rows)
    assert decontaminate.clean(no_docs, some).count() == 0
    assert decontaminate.hits(odd_docs, some, "what").where(F.col("what.n_hit") > 0).count() == 3
