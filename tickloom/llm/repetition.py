"""Quality rules on repetition, by suffix arrays over words.

Texts are taken many at a time and laid end to end. Suffixes are sorted by doubled prefixes:
at each level, suffixes whose first k words are equal are ordered by the next k. The first level
orders by (text, word), so suffixes of different texts are never equal, and only suffixes that still
share a rank take part in the next level. Equal ranks at a level mean equal prefixes, so the
longest common prefix of neighbours in the suffix array is read off the levels.

A suffix lies in longest-common-prefix intervals of values up to the larger of its two neighbours'
prefixes: that is the longest substring from there that occurs again. The spans of these, where
they have LEAST_REPEAT words or more, are the maximal repeated substrings (and parts of them). Their
union is the covered part of the text.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa

from tickloom.llm.common import on_texts

WINDOW = 3
LEAST_WORDS = 50
LEAST_REPEAT = 10
#: Limits of the verdict: covered words in percent of all, and words of the longest repeat.
MOST_COVERED = 20
MOST_REPEAT = 100
STEP = 2 << 20

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_SPACE = b" \t\n\v\f\r"

RESULT = pa.struct(
    [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    + [(name, pa.int64()) for name in ("n_repeat_words", "n_covered", "longest_repeat")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
)


def longest_repeats(owner: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring from there that occurs again in its text."""
    n = len(symbol)
    longest = np.zeros(n, dtype=np.int32)
    if n < 2:
        return longest
    key = owner * (int(symbol.max()) + 1) + symbol
    order = np.argsort(key, kind="stable")
    levels, step = [], 1
    rank = np.empty(n + 1, dtype=np.int32)
    rank[n] = -1
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    suffixes = order.astype(np.int32)
    tied = _tied(new)
    end = np.searchsorted(owner, owner, side="right")
    # Where in the suffix array the tied suffixes stand, and which they are.
    where = np.flatnonzero(tied)
    pairs = np.flatnonzero(~new[1:]) if n > 1 else where
    while len(where):
        levels.append(rank.copy())
        at = suffixes[where]
        following = np.where(at + step < end[at], rank[np.minimum(at + step, n)], -1)
        mine = rank[at].astype(np.int64)
        order = np.lexsort((following, mine))
        at, mine, following = at[order], mine[order], following[order]
        suffixes[where] = at
        new = np.concatenate([[True], (mine[1:] != mine[:-1]) | (following[1:] != following[:-1])])
        rank[at] = where[np.flatnonzero(new)[np.cumsum(new) - 1]]
        where = where[_tied(new)]
        step *= 2
    left, right = suffixes[pairs], suffixes[pairs + 1]
    shared = np.zeros(len(pairs), dtype=np.int32)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][np.minimum(left + shared, n)] == levels[level][np.minimum(right + shared, n)]
        shared[same] += 1 << level
    longest[left] = shared
    other = np.zeros(n, dtype=np.int32)
    other[right] = shared
    return np.maximum(longest, other)


def _tied(new: np.ndarray) -> np.ndarray:
    """Which elements of a sorted array share their group with another, given where groups begin."""
    return ~(new & np.concatenate([new[1:], [True]]))


def _union(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    edges = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    number: dict[bytes, int] = defaultdict(count().__next__)
    split = [t.split() if t else [] for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(texts)), sizes)
    symbol = np.fromiter((number[w] for words in split for w in words), dtype=np.int64, count=total)
    longest = longest_repeats(owner, symbol)

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=len(texts))

    window = np.flatnonzero(longest >= WINDOW)
    repeat = np.flatnonzero(longest >= LEAST_REPEAT)
    most = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(most, owner, longest)
    lines = [[line for line in t.split(b"\n") if line.strip()] if t else [] for t in texts]
    out = {
        "n_words": sizes,
        "word_chars": np.array([len(t.translate(None, _SPACE).decode()) if t else 0 for t in texts]),
        "n_symbols": np.array([len(t.translate(None, _NOT_SYMBOLS)) if t else 0 for t in texts]),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines]),
        "n_repeat_words": per_text(_union(window, np.full(len(window), WINDOW), total)),
        "n_covered": per_text(_union(repeat, longest[repeat], total)),
        "longest_repeat": most,
    }
    out["base_failed"] = (sizes < LEAST_WORDS) | (100 * out["n_repeat_words"] > 50 * sizes)
    repetitive = (100 * out["n_covered"] > MOST_COVERED * sizes) | (most > MOST_REPEAT)
    out["kept"] = ~out["base_failed"] & ~repetitive
    return out


def _measured(texts: list[bytes | None]) -> pa.Array:
    found = measure(texts)
    return pa.StructArray.from_arrays([pa.array(found[f.name], type=f.type) for f in RESULT], fields=list(RESULT))


#: Text to its measures and verdict. A null or empty text has no words, and fails.
measures = on_texts(_measured, RESULT, STEP)
