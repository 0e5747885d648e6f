import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import repetition


def brute(text):
    text = text or ""
    words = text.encode().split()
    n = len(words)
    again = lambda width: {
        p
        for windows in [[tuple(words[i : i + width]) for i in range(n - width + 1)]]
        for counts in [Counter(windows)]
        for i, w in enumerate(windows)
        if counts[w] > 1
        for p in range(i, i + width)
    }
    longest = max((k for k in range(1, n) if again(k)), default=0) if n < 400 else None
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    out = {
        "n_words": n,
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(again(3)),
        "n_covered": len(again(10)),
    }
    out["base_failed"] = n < 50 or 100 * out["n_repeat_words"] > 50 * n
    out["kept"] = not (out["base_failed"] or 100 * out["n_covered"] > 20 * n or bool(again(101)))
    return out | ({"longest_repeat": longest} if longest is not None else {})


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t", "a", "a a", "a a a a", "x\ny\nx\n \n \nx ", "é é é <&> é"]
    for _ in range(120):
        words = [rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(120))]
        if words and rng.random() < 0.5:
            at, size = rng.randrange(len(words)), rng.randrange(60)
            words += words[at : at + size]
        out.append(rng.choice([" ", "\n", "  "]).join(words))
    unique = [f"u{i}" for i in range(300)]
    out += [" ".join(unique), " ".join(unique + unique[:30]), " ".join(unique + unique[:102]), "go " * 300]
    return out


def test_equals_brute_force_for_many_texts_at_once():
    given = texts()
    found = repetition.measure([None if t is None else t.encode() for t in given])
    for i, t in enumerate(given):
        for name, value in brute(t).items():
            assert found[name][i] == value, (name, t)


def test_a_long_text_against_a_suffix_by_suffix_search():
    rng = np.random.default_rng(3)
    symbol = rng.integers(0, 40, 3000)
    symbol[2000:2200] = symbol[100:300]
    found = repetition.longest_repeats(np.zeros(3000, dtype=np.int64), symbol)
    suffixes = sorted(range(3000), key=lambda i: symbol[i:].tolist())
    expected = np.zeros(3000, dtype=int)
    for a, b in zip(suffixes, suffixes[1:]):
        n = 0
        while max(a, b) + n < 3000 and symbol[a + n] == symbol[b + n]:
            n += 1
        expected[a], expected[b] = max(expected[a], n), max(expected[b], n)
    assert (found == expected).all()


@pytest.mark.parametrize("rows", ["odd_docs", "no_docs"])
def test_column_over_odd_rows(request, rows):
    docs = request.getfixturevalue(rows)
    found = docs.select("text", repetition.measures(F.col("text")).alias("m")).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.text is None or len(r.text) < 1000:
            for name, value in brute(r.text).items():
                assert r.m[name] == value
        else:
            assert r.m.n_words == 60_000 and r.m.kept
