"""Near-duplicate passages across documents by compact windows.

Tokens are shingles of five words. Under a hash function, a document's tokens form a
Cartesian tree: the node at i spans the widest range of tokens of which i is the minimum. A node that
spans LENGTH tokens or more stands for a compact window: the run of passages of LENGTH tokens whose
min-hash is that of token i. (Those nodes are just the minima of the windows of LENGTH tokens, so a
sliding minimum finds them with their runs, without the small nodes.)

Passages at SIMILARITY may differ in their minimum, under any number of hash functions. But of their KEPT smallest
different tokens they share one: no more than KEPT - 1 of either passage's are not the other's. So there is one hash
function, and the compact window of token i is the run of passages that have i among their KEPT smallest. About 28 of
100 tokens have one.

Values with one document are dropped as soon as they are counted, and the counts go back to the documents. Of its KEPT
smallest tokens, a passage of LENGTH different ones shares five with one at SIMILARITY, so the two share one of the six
rarest of each (``prefix`` says how many it is where tokens repeat). So only those have windows from there on: text of
its own with a frequent phrase in it has none, and where text is repeated, its own tokens tell and not the phrases.

Equal text is folded first, by the windows of the smallest token alone. A core is CORE tokens at a fixed distance from
the minimum: windows that share one hold passages at SIMILARITY, and windows that share a passage of LENGTH tokens
share one. Windows are linked to the first that has a core of theirs. So a passage in any number of contexts gives as
many links, not all pairs of them. These links are verified, and what they connect is one class of documents.

Passages in question are those with enough of them shared. All tokens of these are counted once more, in these alone, and
passages of which too few stand in those of another document are left. So what is not shared is known of every token.

Two passages share a rare value if their windows have the same token. The first window of a value in each class
stands for the class, and those of all classes are compared. Windows with shared tokens that no verified passage holds so far
are compared with the first and the last of their own class, and of equal text. Last, with the classes that this leaves,
windows are compared with those of other classes, so that no link between classes is lost where what stands for a class lacks
the passage in question; and windows that still have shared tokens which no verified passage holds, with all of the value,
of any class, that have one of these tokens. So no near passage is left out of the verified ones.

For each pair of documents with windows of equal text that meet, the runs are joined by interval: starts that are covered, at
about the same distance between the two documents, are candidates. Windows that are only alike may hold their passages
at any distance, as parts of a passage may be moved; so all that two such windows span is a candidate.
Candidates are verified on the words themselves: Jaccard similarity of the tokens of at least SIMILARITY, first at
about the same place, then, if nothing is found, of each passage with each.

Many values come from short phrases that many documents have. So a window carries a sketch: a bit for each
of its tokens, wherever it stands. Passages at SIMILARITY share that much of LENGTH tokens, less those
that a passage repeats. Tokens that repeat or fall on one bit are no more than a window has tokens
over bits, so pairs of windows that have fewer bits in common than the rest cannot hold such passages. No
pair at SIMILARITY is lost by this, whatever words are put in, left out or moved.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from tickloom.llm.common import forget, ragged, steps, written
from tickloom.llm.components import components

SHINGLE = 5
#: A passage is this many tokens, that is LENGTH + SHINGLE - 1 = 50 words.
LENGTH = 46
#: Hash functions, a power of two: the last bits of a key say which.
HASHES = 4
SIMILARITY = 0.8
#: Of the smallest tokens of a passage, so many: two passages at SIMILARITY share one of them.
KEPT = LENGTH - ceil(SIMILARITY * LENGTH) + 1
#: Distances between two documents that count as about the same: words put in or left out.
SLACK = 2
#: Two passages of LENGTH tokens that share CORE tokens in a row are at SIMILARITY: 2 LENGTH - CORE in all.
CORE = 41
#: Cores start at multiples of this distance from the minimum: any LENGTH tokens in a row hold one.
CORE_STEP = LENGTH - CORE + 1
#: Longs of a window's sketch, a power of two.
PARTS = 4
SKETCH = [f"sketch{part}" for part in range(PARTS)]
#: Pairs of windows that are made in memory at a time.
PAIRS = 1 << 18
#: Windows of a value that are compared with as many others in one group of rows.
BLOCK = 1024
PLACE = ["doc", "i", "first", "last"]
STEP = 1 << 20
#: Words of more bytes are hashed one by one.
LONG = 64
_PLACE_BITS = 26

_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)

RUNS = pa.list_(
    pa.struct([(name, pa.int32()) for name in ("start", "stop", "least_shift", "most_shift")])
)
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
BOXES = pa.list_(pa.struct([(name, pa.int32()) for name in ("first", "last", "other_first", "other_last")]))
BOTH = pa.list_(pa.struct([(name, pa.int32()) for name in ("start", "stop", "other_start", "other_stop")]))


def _words(held: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of words of a text, which has eight bytes or more after the last."""
    out = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    eights = np.ndarray(len(held) - 7, dtype="<u8", buffer=held, strides=(1,))
    short = np.flatnonzero(lengths <= LONG)
    start, left = starts[short], lengths[short]
    while len(short):
        mixed = out[short] ^ (eights[start] & _MASKS[np.minimum(left, 8)])
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x94D049BB133111EB)
        out[short] = mixed ^ (mixed >> np.uint64(29))
        more = left > 8
        short, start, left = short[more], start[more] + 8, left[more] - 8
    for at in np.flatnonzero(lengths > LONG).tolist():
        out[at] = xxhash.xxh64_intdigest(held[starts[at] : starts[at] + lengths[at]].tobytes())
    return out


def _hashed(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lower-cased words of all texts (bytes or None), end to end, and how many each has.

    Words and cases are those of bytes.split and bytes.lower.
    """
    held = np.frombuffer(b"\n".join([b"", *(t or b"" for t in texts), b" " * 8]), dtype=np.uint8)
    space = (held == 32) | ((held >= 9) & (held <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 if t else 1 for t in texts], dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    sizes = np.maximum(counts - SHINGLE + 1, 0)
    if len(starts) < SHINGLE:
        return np.zeros(0, dtype=np.uint64), sizes
    upper = (held - np.uint8(65)) < 26
    hashes = _words(held + (upper.view(np.uint8) << 5), starts, stops - starts)
    out = hashes[: len(hashes) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[k : k + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    owner = np.repeat(np.arange(len(texts)), counts)
    return out[owner[: len(out)] == owner[SHINGLE - 1 :]], sizes


def tokens(words: list[bytes]) -> np.ndarray:
    """Hashes of all shingles of lower-cased words."""
    return _hashed([b" ".join(words)])[0]


def _multipliers() -> list[tuple[np.uint64, np.uint64]]:
    rng = np.random.default_rng(7)
    return [tuple(rng.integers(0, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for _ in range(HASHES)]


def _sketches(hashes: np.ndarray, counted: np.ndarray | None = None):
    """A function from ranges of LENGTH to 2 LENGTH tokens (starts, stops exclusive) to their sketches: a bit
    of PARTS longs for each token, or for each of those counted."""
    bit = (hashes >> np.uint64(20)) & np.uint64(64 * PARTS - 1)
    block = np.zeros((len(hashes), PARTS), dtype=np.uint64)
    block[np.arange(len(hashes)), bit >> np.uint64(6)] = np.uint64(1) << (bit & np.uint64(63))
    if counted is not None:
        block[~counted] = 0
    width = 1
    while 2 * width <= LENGTH:
        block = block[:-width] | block[width:]
        width *= 2

    def of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        # Blocks that cover a range: its first, its last, and steps between.
        out = block[low] | block[high - width]
        for step in range(width, 2 * LENGTH - width, width):
            out |= block[np.minimum(low + step, high - width)]
        return out.view(np.int64)

    return of


def _contents(hashes: np.ndarray):
    """A function from ranges of tokens (starts, stops exclusive) and a place in each to hashes of the tokens
    and the place, counted from the start."""
    # A polynomial modulo 2^64, so that a range is the difference of two sums, moved by an inverse power.
    base = 0x9E3779B97F4A7C15
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    powers = np.full(len(hashes) + 1, base, dtype=np.uint64)
    inverse = np.full(len(hashes) + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    np.cumsum((mixed ^ (mixed >> np.uint64(32))) * powers[:-1], out=sums[1:])

    def of(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = (sums[high] - sums[low]) * inverse[low]
        out += ((high - low) * 2 * LENGTH + at - low).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        return out.view(np.int64)

    return of


def compact_windows(hashes: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each hash function: (key, document, i, first start, last start, content) of every compact window. Windows with equal tokens, and the minimum at the same one, have the same content.

    Documents of these sizes lie end to end; i and starts count from the document's first token.
    """
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    count = len(hashes) - LENGTH + 1
    if count <= 0:
        return
    whole = np.flatnonzero(owner[:count] == owner[LENGTH - 1 :])
    place = np.arange(len(hashes), dtype=np.uint64)
    contents = _contents(hashes)
    for function, (multiplier, salt) in enumerate(_multipliers()):
        mixed = (hashes ^ salt) * multiplier
        mixed ^= mixed >> np.uint64(32)
        least = (mixed & ~np.uint64((1 << _PLACE_BITS) - 1)) | place
        width = 1
        while 2 * width <= LENGTH:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < LENGTH:
            gap = LENGTH - width
            least = np.minimum(least[:-gap], least[gap:])
        at = (least[whole] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        if not len(at):
            continue
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1] + 1)]))
        last = np.concatenate([new[1:], [len(at)]]) - 1
        i = at[new]
        begin = starts[owner[i]]
        key = (mixed[i] & ~np.uint64(HASHES - 1)) | np.uint64(function)
        low, high = whole[new], whole[last] + LENGTH
        yield key.view(np.int64), owner[i], i - begin, low - begin, whole[last] - begin, contents(low, high, i)


def _ordered(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' order, equal ones by place, their ranks (equal ones have one), and the place of the same token close
    before each, or -1."""
    count = len(mixed)
    low = np.uint64((1 << count.bit_length()) - 1)
    packed = np.sort((mixed & ~low) | np.arange(count, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    same = mixed[order[1:]] == mixed[order[:-1]]
    if (~same & ((packed[1:] ^ packed[:-1]) <= low)).any():
        order = np.argsort(mixed, kind="stable")
        same = mixed[order[1:]] == mixed[order[:-1]]
    ranks = np.zeros(count, dtype=np.uint32)
    ranks[order[1:]] = np.cumsum(~same, dtype=np.uint32)
    before = np.full(count, -1)
    before[order[1:]] = np.where(same & (np.diff(order) < LENGTH), order[:-1], -1)
    return order, ranks, before


def _smallest(mixed: np.ndarray, sizes: np.ndarray, slots: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The tokens that are among the KEPT smallest different ones of a passage, the first and the last start of such
    passages, the place of the same token close before each of all tokens, or -1, and the order of all tokens.

    ``slots`` takes the KEPT smallest of the passage at each start; only those without repeats are whole.
    """
    count = len(mixed)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A token that repeats another close before it counts for none: that lets in a few more, and loses none.
    order, ranks, before = _ordered(mixed)
    counted = np.full(count + 2 * LENGTH, np.iinfo(np.uint32).max, dtype=np.uint32)
    counted[LENGTH : LENGTH + count] = np.where(before >= 0, np.iinfo(np.uint32).max, ranks)
    whole = np.zeros(count + 2 * LENGTH, dtype=bool)
    whole[LENGTH : count + 1] = owner[: count - LENGTH + 1] == owner[LENGTH - 1 :]
    less = np.empty(count, dtype=bool)

    def smaller(distance: int) -> np.ndarray:
        return np.less(counted[LENGTH + distance : LENGTH + distance + count], ranks, out=less).view(np.int8)

    # Passages start 0 to LENGTH - 1 tokens before the token, and lie in its document.
    rank, held = np.zeros(count, dtype=np.int8), np.empty(count, dtype=bool)
    # The greatest distance and one more, and the least one, from LENGTH down; 0 for none.
    first, last = np.zeros(count, dtype=np.int8), np.zeros(count, dtype=np.int8)
    for distance in range(1, LENGTH):
        rank += smaller(distance)
    for distance in range(LENGTH):
        if distance:
            rank += smaller(-distance)
            rank -= smaller(LENGTH - distance)
        np.less(rank, KEPT, out=held)
        held &= whole[LENGTH - distance : LENGTH - distance + count]
        if slots is not None:
            at = np.flatnonzero(held)
            slots[at - distance, rank[at]] = at
        np.maximum(first, held.view(np.int8) * np.int8(distance + 1), out=first)
        np.maximum(last, held.view(np.int8) * np.int8(LENGTH - distance), out=last)
    i = np.flatnonzero(last)
    return i, i + 1 - first[i], i - LENGTH + last[i], before, order


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """The tokens under the first hash function."""
    multiplier, salt = _multipliers()[0]
    mixed = (hashes ^ salt) * multiplier
    return mixed ^ (mixed >> np.uint64(32))


def small_windows(hashes: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Like ``compact_windows``, under the first hash function: of every token that is among the KEPT smallest
    different ones of a passage, and the first and last start of such passages."""
    if len(hashes) < LENGTH:
        return
    mixed = _mixed(hashes)
    i, low, last, *_ = _smallest(mixed, sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)[i]
    start = (np.cumsum(sizes) - sizes)[owner]
    key = mixed[i] & ~np.uint64(HASHES - 1)
    content = _contents(hashes)(low, last + LENGTH, i)
    yield key.view(np.int64), owner, i - start, low - start, last - start, content


def common(own: int, other: int) -> int:
    """How many tokens passages of so many different ones share at least if they are at SIMILARITY."""
    return ceil(SIMILARITY / (1 + SIMILARITY) * (own + other) - 1e-9)


def prefix(own: int, other: int) -> int:
    """Passages of so many different tokens that are at SIMILARITY share a token that is, in any one order of all
    tokens, among so many first ones of the own passage's KEPT smallest. 0: they cannot be at SIMILARITY."""
    both = common(own, other)
    if both > min(own, other):
        return 0
    # The n-th smallest of what they share has n less one, and what the other lacks, before it.
    return min(KEPT, own) + 1 - min(min(KEPT, n) - n + both for n in (own, other))


_PREFIX = np.array([[prefix(a, b) if a and b else 0 for b in range(LENGTH + 1)] for a in range(LENGTH + 1)])
_COMMON = np.array([[common(a, b) if a and b and prefix(a, b) else LENGTH + 1 for b in range(LENGTH + 1)] for a in range(LENGTH + 1)])


def _repeats(before: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """How many of the tokens ``counted`` stand twice in each passage, by start. ``before`` says where a token stands
    close before, or -1."""
    again = np.flatnonzero((before >= 0) & counted)
    edges = np.bincount(np.maximum(again - LENGTH + 1, 0), minlength=len(before) + 1)
    return np.cumsum(edges - np.bincount(before[again] + 1, minlength=len(before) + 1))


def _distinct(before: np.ndarray) -> np.ndarray:
    """How many different tokens each passage has, by start."""
    return LENGTH - _repeats(before, np.ones(len(before), dtype=bool))


def kept_values(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, document, bits) of the values of ``small_windows``, each once for a document. A bit says that passages in
    question have so many different tokens."""
    mixed = _mixed(hashes)
    i, low, last, before, order = _smallest(mixed, sizes)
    distinct = _distinct(before)
    bits = np.full(len(i), 1 << LENGTH)
    sums = np.concatenate([[0], np.cumsum(distinct < LENGTH)])
    some = np.flatnonzero(sums[last + 1] > sums[low])
    bits[some] = 0
    for step in range(LENGTH):
        some = some[low[some] + step <= last[some]]
        bits[some] |= 1 << distinct[low[some] + step]
    # In the order of all tokens, so that equal ones of a document are neighbours.
    nth = np.full(len(mixed), -1)
    nth[i] = np.arange(len(i))
    order = nth[order]
    order = order[order >= 0]
    i, bits = i[order], bits[order]
    owner = np.repeat(np.arange(len(sizes)), sizes)[i]
    key = mixed[i] & ~np.uint64(HASHES - 1)
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])[: len(key)])
    return key[new].view(np.int64), owner[new], np.bitwise_or.reduceat(bits, new) if len(new) else bits


class _Likely:
    """The KEPT smallest tokens of the passages that may be at SIMILARITY with others.

    ``n`` says how many documents have a token, 1 for what is not shared, and ``bits`` how many different tokens the
    passages have that it may be shared with. ``x`` are the starts of the passages, ``held`` the tokens, ``there`` which
    of these a passage has, ``used`` which are shared, ``most`` how many of the rarest count, and ``least`` how many of
    all its different tokens a passage shares at least.
    """

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, n: np.ndarray, bits: np.ndarray):
        count, mixed = len(hashes), _mixed(hashes)
        slots = np.zeros((count, KEPT), dtype=np.int32)
        i, _, _, self.before, order = _smallest(mixed, sizes, slots)
        self.distinct = _distinct(self.before)
        # By how many have a token, then by the token.
        kept = np.zeros(count, dtype=bool)
        kept[i] = True
        order = order[kept[order]]
        self.order = np.full(count, count, dtype=np.int32)
        self.order[order[np.argsort(n[order], kind="stable")]] = np.arange(len(order), dtype=np.int32)
        shared = n > 1
        # For every set of sizes: the longest prefix of passages of each size, and the fewest tokens in common.
        sets, which = np.unique(bits, return_inverse=True)
        longest = np.zeros((len(sets), LENGTH + 1), dtype=np.int8)
        fewest = np.full((len(sets), LENGTH + 1), LENGTH + 1, dtype=np.int8)
        for size in range(1, LENGTH + 1):
            has = (sets >> size & 1).astype(bool)[:, None]
            longest = np.where(has, np.maximum(longest, _PREFIX[:, size]), longest)
            fewest = np.where(has, np.minimum(fewest, _COMMON[:, size]), fewest)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.flatnonzero(owner[: count - LENGTH + 1] == owner[LENGTH - 1 :])
        repeated = np.concatenate([[0], np.cumsum(self.before >= 0)])
        plain = repeated[starts + LENGTH] == repeated[starts]
        found = []

        def take(x: np.ndarray, held: np.ndarray, there: np.ndarray) -> None:
            used = shared[held] & there
            size = self.distinct[x][:, None]
            # What is not shared is rarer than all that is.
            most = longest[which[held], size]
            likely = np.flatnonzero((used & ((there & ~used).sum(axis=1)[:, None] < most)).any(axis=1))
            x, held, there, used, most = (a[likely] for a in (x, held, there, used, most))
            least = np.where(used, fewest[which[held], self.distinct[x][:, None]], LENGTH + 1).min(axis=1, initial=LENGTH + 1)
            found.append((x, held, there, used, most, least))

        x = starts[plain]
        x = x[shared[slots[x]].any(axis=1)]
        take(x, slots[x], np.ones((len(x), KEPT), dtype=bool))
        # With tokens that may repeat: the smallest, each once.
        others = starts[~plain]
        for step in range(0, len(others), 1 << 15):
            x = others[step : step + (1 << 15)]
            passages = np.lib.stride_tricks.sliding_window_view(mixed, LENGTH)[x]
            at = passages.argsort(axis=1, kind="stable")
            ordered = np.take_along_axis(passages, at, axis=1)
            first = np.ones(ordered.shape, dtype=bool)
            first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            front = (~first).argsort(axis=1, kind="stable")[:, :KEPT]
            take(x, x[:, None] + np.take_along_axis(at, front, axis=1), np.take_along_axis(first, front, axis=1))
        self.x, self.held, self.there, self.used, self.most, self.least = (np.concatenate(a) for a in zip(*found))

    def inside(self) -> np.ndarray:
        """Which tokens are in the passages."""
        edges = np.bincount(self.x, minlength=len(self.before) + 1) - np.bincount(self.x + LENGTH, minlength=len(self.before) + 1)
        return np.cumsum(edges)[:-1] > 0

    def keep(self, shared: np.ndarray) -> None:
        """Leave the passages of which enough tokens are shared; the others come before all that are."""
        sums = np.concatenate([[0], np.cumsum(shared)])
        enough = sums[self.x + LENGTH] - sums[self.x] - _repeats(self.before, shared)[self.x] >= self.least
        used = self.used & shared[self.held]
        enough &= (used & ((self.there & ~used).sum(axis=1)[:, None] < self.most)).any(axis=1)
        self.used = used
        self.order = np.where(shared, self.order, self.order - len(shared))
        for name in ("x", "held", "there", "used", "most", "least"):
            setattr(self, name, getattr(self, name)[enough])

    def windows(self) -> tuple[np.ndarray, ...]:
        """(i, first start, last start, least) of the tokens that are among the rarest of a passage's."""
        count = len(self.before)
        begin, end, least = np.full(count, count), np.full(count, -1), np.full(count, LENGTH + 1)
        # Of ten, to compare each with each is much faster than to sort.
        order = np.ascontiguousarray(np.where(self.there, self.order[self.held], np.int32(count)).T)
        rank = np.stack([sum((mine > other).view(np.int8) for other in order) for mine in order], axis=1)
        wanted = self.used & (rank < self.most)
        token, times = self.held[wanted], wanted.sum(axis=1)
        start = np.repeat(self.x, times)
        np.minimum.at(begin, token, start)
        np.maximum.at(end, token, start)
        np.minimum.at(least, token, np.repeat(self.least, times))
        i = np.flatnonzero(end >= 0)
        return i, begin[i], end[i], least[i]


def rare_windows(hashes: np.ndarray, sizes: np.ndarray, n: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """(i, first start, last start), in all tokens: windows of the tokens that are, of the KEPT smallest of a passage,
    among the ``prefix`` rarest. ``n`` and ``bits`` as in ``_Likely``."""
    return _Likely(hashes, sizes, n, bits).windows()[:3]


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, done = np.asarray(batch.column(0)), 0
        for part in steps(batch.column(1), STEP):
            named = ids[done : done + len(part)]
            done += len(part)
            hashes, sizes = _hashed(part)
            if len(hashes) >= LENGTH:
                key, owner, bits = kept_values(hashes, sizes)
                columns = [pa.array(key), pa.array(named[owner]), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc", "bits"])


def cores(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all cores of windows (tokens low to high, exclusive, the minimum at i), and how many each has."""
    start = i - (i - low) // CORE_STEP * CORE_STEP
    counts = (high - CORE - start) // CORE_STEP + 1
    owner, nth = ragged(counts)
    at = start[owner] + nth * CORE_STEP
    return _contents(hashes)(at, at + CORE, i[owner]), counts


def _found(key: np.ndarray, owner: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys of documents are listed (keys of owners), and where."""
    if not len(keys):
        return np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=np.int64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    listed = keys ^ (owners.astype(np.uint64) * factor)
    order = np.argsort(listed)
    sought = key ^ (owner.astype(np.uint64) * factor)
    at = order[np.searchsorted(listed, sought, sorter=order).clip(max=len(listed) - 1)]
    return listed[at] == sought, at


def _promising(hashes: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which documents may have passages in question: one with enough shared tokens, or one that repeats a token.
    ``bits`` as in ``_Likely``, 0 for tokens that are not shared."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros(len(sizes), dtype=bool)
    out[owner[_ordered(_mixed(hashes))[2] >= 0]] = True
    # Of LENGTH different tokens, so many of the KEPT smallest are shared with a passage of each size.
    fewest = np.zeros(len(sizes), dtype=np.int64)
    np.bitwise_or.at(fewest, owner[bits != 0], bits[bits != 0])
    sizes_ = (fewest[:, None] >> np.arange(LENGTH + 1) & 1).astype(bool) & (_PREFIX[LENGTH] > 0)
    fewest = np.where(sizes_, KEPT + 1 - _PREFIX[LENGTH], KEPT + 1).min(axis=1)
    sums = np.concatenate([[0], np.cumsum(bits != 0)])
    starts = np.flatnonzero(owner[: len(hashes) - LENGTH + 1] == owner[LENGTH - 1 :])
    enough = sums[starts + LENGTH] - sums[starts] >= fewest[owner[starts]]
    out[owner[starts[enough]]] = True
    return out


def _read(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Texts (doc, text, values, ...) in steps: place in the batch, ids, tokens, sizes, the tokens' keys, owners, how many
    documents have them, and the passages in question."""
    done = 0
    for part in steps(batch.column(1), STEP):
        mine = batch.slice(done, len(part))
        done += len(part)
        hashes, sizes = _hashed(part)
        if len(hashes) < LENGTH:
            continue
        lists = mine.column(2)
        owners, _ = ragged(np.asarray(pc.list_value_length(lists)))
        flat = lists.flatten()
        keys, times, bits = (np.asarray(flat.field(name)) for name in ("key", "n", "bits"))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        key = _mixed(hashes) & ~np.uint64(HASHES - 1)
        known, at = _found(key, owner, keys.view(np.uint64), owners)
        n, bits = np.where(known, times[at], 1), np.where(known, bits[at], 0)
        some = _promising(hashes, sizes, bits)
        sizes = np.where(some, sizes, 0)
        hashes, key, n, bits, owner = (x[some[owner]] for x in (hashes, key, n, bits, owner))
        if len(hashes) >= LENGTH:
            yield mine, hashes, sizes, key, owner, n, _Likely(hashes, sizes, n, bits)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (doc, text, and lists of the values that other documents have) to those with passages in question, and a row
    per token of these passages."""
    for batch in batches:
        for mine, _, _, key, owner, _, likely in _read(batch):
            inside = np.flatnonzero(likely.inside())
            own, named = np.unique(owner[inside]), np.asarray(mine.column(0))
            texts = mine.take(pa.array(own))
            yield pa.RecordBatch.from_arrays(
                [texts.column(0), pa.nulls(len(own), pa.int64()), texts.column(1), texts.column(2)],
                ["doc", "token", "text", "values"],
            )
            none = (pa.nulls(len(inside), column.type) for column in texts.columns[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(named[owner[inside]]), pa.array(key[inside].view(np.int64)), *none],
                ["doc", "token", "text", "values"],
            )


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (doc, text, lists of the values that other documents have, and lists of tokens that none has) to a row per
    window of a rare value, with its sketch, and a row per window of a least token, with its cores."""
    for batch in batches:
        for mine, hashes, sizes, key, owner, n, likely in _read(batch):
            named, lists = np.asarray(mine.column(0)), pc.fill_null(mine.column(3), [])
            owners, _ = ragged(np.asarray(pc.list_value_length(lists)))
            alone, _ = _found(key, owner, np.asarray(lists.flatten()).view(np.uint64), owners)
            shared = likely.inside() & ~alone
            likely.keep(shared)
            begin, contents = np.cumsum(sizes) - sizes, _contents(hashes)

            def rows(i: np.ndarray, low: np.ndarray, last: np.ndarray, sketch: dict, core: pa.Array) -> pa.RecordBatch:
                start = begin[owner[i]]
                places = {"i": i - start, "first": low - start, "last": last - start}
                return pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(key[i].view(np.int64)),
                        "content": pa.array(contents(low, last + LENGTH, i)),
                        "doc": pa.array(named[owner[i]]),
                    }
                    | {name: pa.array(x.astype(np.int32)) for name, x in places.items()}
                    | sketch
                    | {"cores": core}
                )

            i, low, last, least = likely.windows()
            if not len(i):
                continue
            sketch = _sketches(hashes, shared)(low, last + LENGTH)
            sums, places = np.concatenate([[0], np.cumsum(shared)]), np.flatnonzero(shared)
            lost = sums[last + LENGTH] - sums[low] - np.bitwise_count(sketch.view(np.uint64)).sum(axis=1)
            from_ = places[np.searchsorted(places, low)]
            to = places[np.searchsorted(places, last + LENGTH) - 1]
            start = begin[owner[i]]
            more = {"low": from_ - start, "high": to - start, "lost": lost, "least": least}
            more = {name: pa.array(x.astype(np.int32)) for name, x in more.items()}
            more["same"] = pa.array(contents(from_, to + 1, i))
            more |= {name: pa.array(sketch[:, k]) for k, name in enumerate(SKETCH)}
            yield rows(i, low, last, more, pa.nulls(len(i), pa.list_(pa.int64())))
            x = np.sort(likely.x)
            for _, of, i, low, last, _ in islice(compact_windows(hashes, sizes), 1):
                i, low, last = (x_ + begin[of] for x_ in (i, low, last))
                # Of the passages, only those in question.
                at, to = np.searchsorted(x, low), np.searchsorted(x, last, side="right") - 1
                some = np.flatnonzero((n[i] > 1) & shared[i] & (at <= to))
                i, low, last = i[some], x[at[some]], x[to[some]]
                core, counts = cores(hashes, low, last + LENGTH, i)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                core = pa.ListArray.from_arrays(pa.array(offsets), pa.array(core))
                yield rows(i, low, last, {name: pa.nulls(len(i), column.type) for name, column in more.items()}, core)


def _missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (doc, text, windows, spans verified) to a row per window, with its tokens and those that no span holds."""
    for batch in batches:
        done = 0
        for part in steps(batch.column(1), STEP):
            mine = batch.slice(done, len(part))
            done += len(part)
            hashes, sizes = _hashed(part)
            begin = np.cumsum(sizes) - sizes
            hashes = (hashes >> np.uint64(32)).astype(np.uint32)
            held = np.zeros(len(hashes) + 1, dtype=np.int64)
            lists = pc.fill_null(mine.column(3), [])
            owner, _ = ragged(np.asarray(pc.list_value_length(lists)))
            start, stop = (np.asarray(lists.flatten().field(name)) for name in ("start", "stop"))
            # A span of words holds the tokens that lie in it.
            some = np.flatnonzero((stop - SHINGLE + 1 > start) & (start < sizes[owner]))
            owner, start, stop = owner[some], start[some], stop[some]
            np.add.at(held, begin[owner] + start, 1)
            np.add.at(held, begin[owner] + np.minimum(stop - SHINGLE + 1, sizes[owner]), -1)
            lacking = np.cumsum(held)[:-1] <= 0
            owner, _ = ragged(np.asarray(pc.list_value_length(mine.column(2))))
            windows = mine.column(2).flatten()
            low, high = (np.asarray(windows.field(name)) + begin[owner] for name in ("low", "high"))
            window, nth = ragged(high - low + 1)
            at = low[window] + nth
            left = lacking[at]
            edges = np.concatenate([[0], np.cumsum(high - low + 1)]), np.concatenate([[0], np.cumsum(np.bincount(window[left], minlength=len(low)))])
            lists = (
                pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(taken)])
                for ends, taken in zip(edges, (hashes[at], hashes[at[left]]))
            )
            columns = {"doc": mine.column(0).take(pa.array(owner))}
            columns |= {field.name: windows.field(field.name) for field in windows.type}
            yield pa.RecordBatch.from_pydict(columns | dict(zip(("tokens", "missing"), lists)))


def _pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Of the windows of some values: pairs of those of different documents that may hold a token which is missing in
    the first, and are alike."""
    doc, key = (np.asarray(rows.column(name)) for name in ("doc", "key"))
    lost, least = (np.asarray(rows.column(name)).astype(np.int64) for name in ("lost", "least"))
    sketch = np.stack([np.asarray(rows.column(name)) for name in SKETCH], axis=1).view(np.uint64)

    def spread(name: str) -> tuple[np.ndarray, np.ndarray]:
        owner, _ = ragged(np.asarray(pc.binary_length(rows.column(name))) // 4)
        flat = np.frombuffer(b"".join(rows.column(name).to_pylist()), dtype=np.uint32)
        mixed = (key[owner].view(np.uint64) ^ flat * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        # In the order of tokens, each once for a window.
        order = np.argsort(mixed, kind="stable")
        mixed, owner = mixed[order], owner[order]
        new = np.concatenate([[True], (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])])[: len(mixed)]
        return mixed[new], owner[new]

    (held, of), (sought, by) = spread("tokens"), spread("missing")
    order = np.argsort(by, kind="stable")
    sought, by = sought[order], by[order]
    low, high = np.searchsorted(held, sought), np.searchsorted(held, sought, side="right")
    ends, begin = np.cumsum(high - low), 0
    while begin < len(sought):
        # A window's missing tokens are one after the other; many pairs are made in steps.
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS)))
        nth, at = ragged((high - low)[begin:end])
        a, b = by[begin:end][nth], of[low[begin:end][nth] + at]
        begin = end
        some = np.unique((a * len(doc) + b)[doc[a] != doc[b]])
        a, b = some // len(doc), some % len(doc)
        both = np.bitwise_count(sketch[a] & sketch[b]).sum(axis=1)
        some = np.flatnonzero((key[a] == key[b]) & (both + np.minimum(lost[a], lost[b]) >= np.maximum(least[a], least[b])))
        sides = (("a_", pa.array(a[some])), ("b_", pa.array(b[some])))
        yield pa.RecordBatch.from_pydict({side + name: rows.column(name).take(x) for side, x in sides for name in PLACE})


def _worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_pairs`` of windows that come by value; the last value of a batch may go on in the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.asarray(batch.column("key"))
        new = np.flatnonzero(keys[1:] != keys[:-1])
        if len(waiting) and len(keys) and waiting[-1].column("key")[-1].as_py() != keys[0]:
            yield from _pairs(_whole(waiting))
            waiting = []
        if len(new):
            cut = int(new[-1]) + 1
            yield from _pairs(_whole([*waiting, batch.slice(0, cut)]))
            waiting, batch = [], batch.slice(cut)
        if len(batch):
            waiting.append(batch)
    if waiting:
        yield from _pairs(_whole(waiting))


def _whole(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def runs(found: list[tuple[int, int, int]]) -> list[dict]:
    """Join (start, stop, shift) of a pair of documents by interval.

    Intervals whose shifts lie within SLACK of the next one belong together; of each such set, the runs of
    starts covered.
    """
    out = []
    found = sorted(found, key=lambda x: x[2])
    begin = 0
    for end in range(1, len(found) + 1):
        if end < len(found) and found[end][2] - found[end - 1][2] <= SLACK:
            continue
        group, begin = found[begin:end], end
        shifts = {"least_shift": group[0][2], "most_shift": group[-1][2]}
        opened, closed = None, None
        for start, stop, _ in sorted(group):
            if opened is not None and start <= closed + 1:
                closed = max(closed, stop)
                continue
            if opened is not None:
                out.append({"start": opened, "stop": closed, **shifts})
            opened, closed = start, stop
        out.append({"start": opened, "stop": closed, **shifts})
    # Edits part the runs of two near copies; what lies close together is cut and verified as one.
    joined: list[dict] = []
    for run in sorted(out, key=lambda r: r["start"]):
        last = joined[-1] if joined else None
        if last and run["start"] <= last["stop"] + LENGTH and (
            abs(run["least_shift"] - last["least_shift"]) <= LENGTH
            and abs(run["most_shift"] - last["most_shift"]) <= LENGTH
        ):
            last["stop"] = max(last["stop"], run["stop"])
            last["least_shift"] = min(last["least_shift"], run["least_shift"])
            last["most_shift"] = max(last["most_shift"], run["most_shift"])
        else:
            joined.append(dict(run))
    return joined


def _runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        flat = batch.flatten()
        found = list(zip(*(flat.field(name).to_pylist() for name in ("start", "stop", "shift"))))
        ends = np.cumsum(np.asarray(pc.list_value_length(batch))).tolist()
        yield pa.array([runs(found[a:b]) for a, b in zip([0, *ends], ends)], type=RUNS)


def boxes(found: list[tuple[int, int, int, int]]) -> list[dict]:
    """Join what windows of a pair of documents span (first and last start of each): boxes that overlap, in tokens,
    in both documents become one."""
    out: list[dict] = []
    for first, last, other_first, other_last in sorted(found):
        box = out[-1] if out else None
        if box and (
            first < box["last"] + LENGTH
            and other_first < box["other_last"] + LENGTH
            and box["other_first"] < other_last + LENGTH
        ):
            box["last"] = max(box["last"], last)
            box["other_first"] = min(box["other_first"], other_first)
            box["other_last"] = max(box["other_last"], other_last)
        else:
            out.append({"first": first, "last": last, "other_first": other_first, "other_last": other_last})
    return out


def _boxes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        flat = batch.flatten()
        found = list(zip(*(flat.field(name).to_pylist() for name in ("first", "last", "other_first", "other_last"))))
        ends = np.cumsum(np.asarray(pc.list_value_length(batch))).tolist()
        yield pa.array([boxes(found[a:b]) for a, b in zip([0, *ends], ends)], type=BOXES)


def _different(places: np.ndarray, held: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` starts, how many different tokens a passage has, of those ``held``. ``places`` says where
    a token stood before, -1 for nowhere."""
    at = np.flatnonzero(held)
    low = np.minimum(np.maximum(places[at] + 1, at - LENGTH + 1).clip(0), count)
    edges = np.bincount(low, minlength=count + 1)[: count + 1] - np.bincount(np.minimum(at + 1, count), minlength=count + 1)[: count + 1]
    return np.cumsum(edges)[:count]


def _places(ids: np.ndarray) -> np.ndarray:
    """Where each token stood before, -1 for nowhere."""
    order = np.argsort(ids, kind="stable")
    places = np.full(len(ids), -1)
    places[order[1:]] = np.where(ids[order[1:]] == ids[order[:-1]], order[:-1], -1)
    return places


def passages_alike(left: list[int], right: list[int], wanted: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(x, y, y) for each start x of a passage of the left tokens that is at SIMILARITY with passages of the right:
    the first and the last start of those. ``wanted`` says of each left token whether its passages are."""
    counts = len(left) - LENGTH + 1, len(right) - LENGTH + 1
    if min(counts) <= 0:
        return []
    _, ids = np.unique(np.concatenate([np.array(side, dtype=np.uint64) for side in (left, right)]), return_inverse=True)
    ids = ids[: len(left)], ids[len(left) :]
    both = np.zeros((2, max(i.max() for i in ids) + 1), dtype=bool)
    both[0, ids[0]] = both[1, ids[1]] = True
    both = both.all(axis=0)
    sides = []
    for side, count in zip(ids, counts):
        places = _places(side)
        different = _different(places, np.ones(len(side), dtype=bool), count)
        enough = _different(places, both[side], count) >= SIMILARITY * different
        sides.append((places, different, np.flatnonzero(enough)))
    (_, n_left, xs), (places, n_right, ys) = sides
    if wanted is not None:
        sums = np.concatenate([[0], np.cumsum(wanted)])
        xs = xs[sums[xs + LENGTH] > sums[xs]]
    if not len(xs) or not len(ys):
        return []
    # Which of the tokens in common the passages have, side by side; one passage at a time where that is much.
    number = np.cumsum(both) - 1
    size = int(number[-1]) + 1
    small = size * (len(xs) + len(ys)) <= 1 << 22

    def held(side: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), size + 1), dtype=np.float32)
        at = np.where(both[side], number[side], size)[starts[:, None] + np.arange(LENGTH)]
        out[np.arange(len(starts))[:, None], at] = 1
        return out[:, :size]

    if small:
        common_ = held(ids[0], xs) @ held(ids[1], ys).T
        near = common_ >= SIMILARITY * (n_left[xs][:, None] + n_right[ys] - common_.astype(np.float64))
        some = np.flatnonzero(near.any(axis=1))
        near = near[some]
        first, last = ys[near.argmax(axis=1)], ys[near.shape[1] - 1 - near[:, ::-1].argmax(axis=1)]
        return list(zip(xs[some].tolist(), first.tolist(), last.tolist()))
    out = []
    mine = np.zeros(len(both), dtype=bool)
    for x in xs.tolist():
        mine[ids[0][x : x + LENGTH]] = True
        common_ = _different(places, mine[ids[1]], counts[1])
        mine[ids[0][x : x + LENGTH]] = False
        near = np.flatnonzero(common_ >= SIMILARITY * (n_left[x] + n_right - common_))
        if len(near):
            out.append((x, int(near[0]), int(near[-1])))
    return out


def verified(mine: bytes, other: bytes) -> list[dict]:
    """The parts (start, stop in words, stop exclusive) of a passage that are near duplicates of the other, and
    where the other has them."""
    return _parts(tokens(mine.split()).tolist(), tokens(other.split()).tolist())


def _parts(left: list[int], right: list[int]) -> list[dict]:
    """``verified`` for the tokens of both."""
    mine_, others = set(left), set(right)
    both = mine_ & others
    # No passage of either has fewer different tokens than LENGTH less all that repeat.
    if len(both) < SIMILARITY * (LENGTH - min(len(left) - len(mine_), len(right) - len(others))):
        return []
    # Which tokens of mine the other has at about the same place, and how many of each LENGTH those are.
    # A token may have many places, as in a passage that repeats a sentence: any of them will do.
    places: dict[int, list[int]] = {}
    for y, token in enumerate(right):
        places.setdefault(token, []).append(y)
    spread = max(0, len(right) - len(left)) + SLACK
    shared = np.zeros(len(left), dtype=bool)
    met = np.zeros(len(left), dtype=np.int64)
    for x, token in enumerate(left):
        own = places.get(token, ())
        # Twice, as the other piece may be cut at its document's start.
        at = bisect_left(own, x - 2 * SLACK)
        if at < len(own) and own[at] <= x + spread:
            shared[x] = True
            met[x] = own[at]
    sums = np.concatenate([[0], np.cumsum(shared)])
    # Of two sets of LENGTH tokens, a share of 2 J / (1 + J) in common is a Jaccard similarity of J.
    enough = 2 * SIMILARITY / (1 + SIMILARITY) * LENGTH
    found: list[list[int]] = []
    for x in np.flatnonzero(sums[LENGTH:] - sums[:-LENGTH] >= enough).tolist():
        if found and x <= found[-1][1] + 1:
            found[-1][1] = x + LENGTH - 1
        else:
            found.append([x, x + LENGTH - 1])
    if not found and both and len(both) >= SIMILARITY * len(mine_ | others):
        found = [[0, len(left) - 1]]
    if not found and both:
        return _anywhere(left, right)
    # From the first to the last shared token: what surrounds a passage is no part of it.
    out = []
    for first, last in found:
        while left[first] not in both:
            first += 1
        while left[last] not in both:
            last -= 1
        there = met[first : last + 1][shared[first : last + 1]]
        other_start, other_last = (int(there.min()), int(there.max())) if len(there) else (0, len(right) - 1)
        out.append(
            {"start": first, "stop": last + SHINGLE, "other_start": other_start, "other_stop": other_last + SHINGLE}
        )
    return out + _elsewhere(left, right, both, out)


def _elsewhere(left: list[int], right: list[int], both: set[int], found: list[dict]) -> list[dict]:
    """Parts that lie at other places than those found."""
    out: list[dict] = []
    sides = ("start", "stop"), ("other_start", "other_stop")
    for mine, other, (start, stop), (other_start, other_stop) in ((left, right, *sides), (right, left, *sides[::-1])):
        rest = np.fromiter((token in both for token in mine), dtype=bool, count=len(mine))
        for part in found + out:
            rest[part[start] : part[stop] - SHINGLE + 1] = False
        if not rest.any():
            continue
        for x, y, _ in passages_alike(mine, other, rest):
            here = [at for at in range(x, x + LENGTH) if mine[at] in both]
            there = [at for at in range(y, y + LENGTH) if other[at] in both]
            part = {start: here[0], stop: here[-1] + SHINGLE, other_start: there[0], other_stop: there[-1] + SHINGLE}
            last = out[-1] if out else None
            if last and last[start] <= part[start] <= last[stop] and last[other_start] <= part[other_start] <= last[other_stop]:
                last[stop], last[other_stop] = max(last[stop], part[stop]), max(last[other_stop], part[other_stop])
            else:
                out.append(part)
    return out


def _anywhere(left: list[int], right: list[int]) -> list[dict]:
    """``verified`` for passages that the other has at any place, and with its parts in any order."""
    out: list[dict] = []
    both = set(left) & set(right)
    for x, low, high in passages_alike(left, right):
        held = [at for at in range(x, x + LENGTH) if left[at] in both]
        x, stop, other_stop = held[0], held[-1] + SHINGLE, high + LENGTH - 1 + SHINGLE
        if out and x <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], stop)
            out[-1]["other_start"] = min(out[-1]["other_start"], low)
            out[-1]["other_stop"] = max(out[-1]["other_stop"], other_stop)
        else:
            out.append({"start": x, "stop": stop, "other_start": low, "other_stop": other_stop})
    return out


def _verified(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for mine, other in batches:
        out, done = [], 0
        for part in steps(mine, STEP):
            sides = [_hashed(side) for side in (part, other.slice(done, len(part)).to_pylist())]
            done += len(part)
            (left, left_ends), (right, right_ends) = ((hashes, np.cumsum([0, *sizes]).tolist()) for hashes, sizes in sides)
            for k in range(len(part)):
                out.append(
                    _parts(
                        left[left_ends[k] : left_ends[k + 1]].tolist(), right[right_ends[k] : right_ends[k + 1]].tolist()
                    )
                )
        yield pa.array(out, type=BOTH)


def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts and the spans wanted of each, to the words of the spans, lower-cased."""
    for texts, wanted in batches:
        out = []
        for text, spans in zip(texts, wanted):
            words = text.as_py().lower().split()
            out.append([b" ".join(words[max(0, s["start"]) : s["stop"]]) for s in spans.as_py()])
        yield pa.array(out, type=pa.list_(pa.binary()))


_runs.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
_boxes.__annotations__ = _runs.__annotations__
for _function in (_verified, _cut):
    _function.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def _udf(function, kind: pa.DataType):
    return F.arrow_udf(function, returnType=from_arrow_type(kind)).asNondeterministic()


def _bits(columns: list) -> Column:
    return sum((F.bit_count(c) for c in columns[1:]), F.bit_count(columns[0]))


def _alike(left: str, right: str) -> Column:
    """Whether two windows (prefixes of their columns) can hold passages at SIMILARITY, by their sketches."""
    both = _bits([F.col(left + name).bitwiseAND(F.col(right + name)) for name in SKETCH])
    lost, least = (f(left + name, right + name) for f, name in ((F.least, "lost"), (F.greatest, "least")))
    return both + lost >= least


def _meeting(left: str, right: str) -> list[Column]:
    """Of two windows (prefixes of their columns): documents, place, and starts relative to the minimum in both runs."""
    i, j = F.col(f"{left}i"), F.col(f"{right}i")
    return [
        F.col(f"{left}doc").alias("doc"),
        F.col(f"{right}doc").alias("other"),
        i.alias("i"),
        (i - j).alias("shift"),
        F.greatest(F.col(f"{left}first") - i, F.col(f"{right}first") - j).alias("a"),
        F.least(F.col(f"{left}last") - i, F.col(f"{right}last") - j).alias("b"),
        F.col(f"{left}first").alias("first"),
        F.col(f"{left}last").alias("last"),
        F.col(f"{right}first").alias("other_first"),
        F.col(f"{right}last").alias("other_last"),
    ]


def _to_first(rows: DataFrame, by: list[str], names: list[str], only: str = "true") -> DataFrame:
    """Pairs: windows (a_...), only such ones, that share `by` with other documents, and the first of those (b_...), each
    by its names.

    Rows of the first one's own document get the last of the group in its place. With ``only``, all get the first and the
    last.
    """
    place, group = F.struct(*names), Window.partitionBy(*by)
    met = rows.select(
        F.expr(only).alias("only"), place.alias("a"), F.min(place).over(group).alias("low"), F.max(place).over(group).alias("high")
    )
    met = met.where("only and low.doc < high.doc")
    if only == "true":
        met = met.withColumn("b", F.when(F.expr("a.doc = low.doc"), F.col("high")).otherwise(F.col("low")))
    else:
        met = met.select("a", F.explode(F.array("low", "high")).alias("b")).where("a.doc <> b.doc")
    return met.select(*(F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "ab" for c in names))


def _compared(windows: DataFrame, wanted: str) -> DataFrame:
    """Pairs (a_..., b_...) of windows of a value and different documents that are alike and as wanted, one of them
    active.

    Windows are dealt to blocks, and blocks are compared, so that no task has all of a frequent value.
    """
    n = F.count(F.lit(1))
    several = windows.groupBy("key").agg(n.alias("n"), F.count_if("active").alias("m")).where("n > 1 and m > 0")
    several = several.select("key", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(d) for c, d in (("m", "ps"), ("n", "qs"))))
    dealt = windows.join(several, "key").withColumn("at", F.xxhash64(*PLACE))
    columns = [c for c in windows.columns if c != "key"]
    one = dealt.where("active").select(
        "key", *(F.col(c).alias(f"a_{c}") for c in columns), F.expr("cast(pmod(at, ps) as int)").alias("p"),
        F.expr("explode(sequence(0, qs - 1))").alias("q"),
    )
    two = dealt.select(
        "key", *(F.col(c).alias(f"b_{c}") for c in columns), F.expr("cast(pmod(at, qs) as int)").alias("q"),
        F.expr("explode(sequence(0, ps - 1))").alias("p"),
    )
    pairs = one.join(two, ["key", "p", "q"]).where("a_doc <> b_doc and (not b_active or a_doc < b_doc)")
    return pairs.where(wanted).where(_alike("a_", "b_"))


def _met(pairs: DataFrame) -> DataFrame:
    """Pairs of windows as runs that meet; of each pair of documents, doc is the one with the larger id."""
    later = pairs.where("a_doc > b_doc").select(*_meeting("a_", "b_"))
    return later.union(pairs.where("a_doc < b_doc").select(*_meeting("b_", "a_")))


def links(docs: DataFrame) -> DataFrame:
    """(doc, start, stop, other, other_start, other_stop): verified passages, in words, stops exclusive.

    Documents with near-duplicate passages are linked directly, or over those that stand for them; and every passage with
    a near duplicate in another document lies in the verified ones.
    """
    return _linked(docs)[0]


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``links``, and (doc, root) of all documents with links."""
    values = docs.mapInArrow(_values, "key long, doc long, bits long")
    value = Window.partitionBy("key")
    low, high = F.min("doc").over(value).alias("low"), F.max("doc").over(value).alias("high")
    shared = values.select(
        "key", "doc", low, high, F.count(F.lit(1)).over(value).cast("int").alias("n"), F.bit_or("bits").over(value).alias("bits")
    )
    shared = written(shared.where("low < high").drop("low", "high"), "shared")
    listed = shared.groupBy("doc").agg(F.collect_list(F.struct("key", "n", "bits")).alias("values"))
    kind = "doc long, token long, text binary, values array<struct<key long, n int, bits long>>"
    regions = written(docs.join(listed, "doc").select("doc", "text", "values").mapInArrow(_regions, kind), "regions")
    forget(shared)
    tokens_ = regions.where("token is not null").groupBy("token").agg(F.min("doc").alias("doc"), F.max("doc").alias("high"))
    alone = written(tokens_.where("doc = high").select("doc", "token"), "alone")
    listed = alone.groupBy("doc").agg(F.collect_list("token").alias("alone"))
    longs = ", ".join(f"{s} long" for s in ("same", *SKETCH))
    kind = f"key long, content long, doc long, i int, first int, last int, low int, high int, lost int, least int, {longs}"
    marked = regions.where("text is not null").join(listed, "doc", "left").select("doc", "text", "values", "alone")
    marked = written(marked.mapInArrow(_marked, f"{kind}, cores array<long>"), "marked")
    texts = written(regions.where("text is not null").select("doc", "text"), "texts")
    forget(regions, alone)
    by_core = marked.where("cores is not null").select(*PLACE, F.explode("cores").alias("core"))
    found = _checked(texts, _met(_to_first(by_core, ["core"], PLACE)))
    roots = _joined(found, None)
    drawn = _uncovered(_rooted(marked.where("cores is null").drop("cores"), roots), found)
    # Of equal windows of one class that verified passages hold, one stands for all.
    drawn = drawn.withColumn("copy", F.when(F.col("uncovered"), F.struct("doc", "i")))
    drawn = written(drawn.dropDuplicates(["key", "content", "root", "copy"]).drop("copy"), "drawn")
    forget(marked)
    one = F.row_number().over(Window.partitionBy("key", "root").orderBy(*PLACE, "content")) == 1
    drawn_ = _divided(drawn).withColumn("stands", one)
    drawn_ = written(drawn_, "divided")
    pairs = _compared(drawn_.where("stands").drop("stands").withColumn("active", F.lit(True)), "a_root <> b_root")
    pairs = _met(pairs)
    names = [*PLACE, *SKETCH, "lost", "least"]
    for by in ("root", "same"):
        pairs = pairs.union(_met(_to_first(drawn, ["key", by], names, "uncovered").where(_alike("a_", "b_"))))
    new = _checked(texts, pairs, _alike_candidates)
    found, roots = found.union(new), _joined(new, roots)
    # Values of which all windows stand for others, or are of one class and held by verified passages, are done.
    rest = written(_active(_uncovered(_rooted(drawn.drop("root", "uncovered"), roots), found), drawn_), "rest")
    pairs = _met(_compared(rest, "a_root <> b_root and not (a_stands and b_stands)"))
    pairs = pairs.union(_met(_lacking(rest.where("some"), texts, _spans(found))))
    new = _checked(texts, pairs, _alike_candidates)
    forget(texts, drawn, drawn_, rest)
    return found.union(new), _joined(new, roots)


def _lacking(windows: DataFrame, texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Pairs (a_..., b_...) of windows of a value that are alike, of which the second has shared tokens that no verified
    passage holds in the first."""
    names = ["key", *PLACE[1:], "low", "high", "lost", "least", *SKETCH]
    asked = windows.groupBy("doc").agg(F.collect_list(F.struct(*names)).alias("windows"))
    asked = texts.join(asked, "doc").join(spans, "doc", "left").select("doc", "text", "windows", "spans")
    kinds = {"doc": "long", "key": "long", **dict.fromkeys(names[1:8], "int"), **dict.fromkeys(SKETCH, "long")}
    rows = asked.mapInArrow(_missing, ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", tokens binary, missing binary")
    kind = ", ".join(f"{side}_{n} {'long' if n == 'doc' else 'int'}" for side in "ab" for n in PLACE)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_worth, kind)


def _divided(windows: DataFrame) -> DataFrame:
    """The windows of values that documents of several classes have."""
    value = Window.partitionBy("key")
    ends = windows.withColumns({"_low": F.min("root").over(value), "_high": F.max("root").over(value)})
    return ends.where("_low < _high").drop("_low", "_high")


def _active(windows: DataFrame, stood: DataFrame) -> DataFrame:
    """The windows of values with some that are uncovered, or not of the value's largest class: these are active.
    ``stood`` says which windows have stood for others."""
    largest = windows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.bool_or("uncovered").alias("some"))
    largest = largest.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots"), F.bool_or("some").alias("some")
    )
    largest = largest.where("roots > 1 or some").select("key", "most", "some")
    stood = stood.where("stands").select("key", *PLACE, F.lit(True).alias("stands"))
    out = windows.join(largest, "key").withColumn("active", F.expr("root <> most")).drop("most")
    return out.join(stood, ["key", *PLACE], "left").withColumn("stands", F.coalesce("stands", F.lit(False)))


def _uncovered(windows: DataFrame, found: DataFrame) -> DataFrame:
    """Whether a window has shared tokens that none of the verified passages of its document holds."""
    held = F.exists("spans", lambda s: (s["start"] <= F.col("low")) & (F.col("high") + F.lit(SHINGLE) <= s["stop"]))
    spans = _spans(found)
    return windows.join(spans, "doc", "left").withColumn("uncovered", ~F.coalesce(held, F.lit(False))).drop("spans")


def _rooted(windows: DataFrame, roots: DataFrame) -> DataFrame:
    """Windows with the class of their documents."""
    return windows.join(roots, "doc", "left").withColumn("root", F.coalesce("root", "doc"))


def _joined(found: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(doc, root): the classes of documents over these links, and over those that made the classes before."""
    edges = found.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct()
    if roots is None:
        return components(edges).toDF("doc", "root")
    for end in "ab":
        of = roots.toDF(end, "root")
        edges = edges.join(of, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    merged = written(components(edges.distinct()).toDF("root", "to"), "merged")
    moved = roots.join(merged, "root", "left").select("doc", F.coalesce("to", "root").alias("root"))
    # Documents without a class so far were their own.
    new = merged.join(roots.select(F.col("doc").alias("root")), "root", "left_anti").select(F.col("root").alias("doc"), F.col("to").alias("root"))
    return written(moved.union(new), "roots")


def _spans(found: DataFrame) -> DataFrame:
    """(doc, spans): the verified parts of each document, apart and in order."""
    sides = found.select("doc", "start", "stop").union(found.select("other", "other_start", "other_stop"))
    # As many starts as the text has words at most, however many documents share them.
    widest = sides.groupBy("doc", "start").agg(F.max("stop").alias("stop"))
    spans = widest.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("all"))
    return spans.select("doc", _udf(_merged, SPANS)(F.col("all")).alias("spans"))


def _equal_candidates(met: DataFrame) -> DataFrame:
    """Runs of equal text that meet at about the same distance, as the words of both documents to be verified."""
    met = met.where(f"a <= b + {SLACK}")
    found = met.groupBy("doc", "other").agg(
        F.collect_set(
            F.struct((F.col("i") + F.least("a", "b")).alias("start"), (F.col("i") + F.greatest("a", "b")).alias("stop"), "shift")
        ).alias("found")
    )
    words = F.lit(LENGTH + SHINGLE - 1)
    joined = found.select("doc", "other", F.explode(_udf(_runs, RUNS)(F.col("found"))).alias("r"))
    # With words put in or left out, a passage may start a little before or after the run.
    return joined.select(
        "doc",
        F.greatest(F.lit(0), F.col("r.start") - SLACK).alias("start"),
        (F.col("r.stop") + words + SLACK).alias("stop"),
        "other",
        F.greatest(F.lit(0), F.col("r.start") - F.col("r.most_shift") - SLACK).alias("other_start"),
        (F.col("r.stop") - F.col("r.least_shift") + words + SLACK).alias("other_stop"),
    )


def _alike_candidates(met: DataFrame) -> DataFrame:
    """All that windows which are alike span, as the words of both documents to be verified."""
    spanned = F.collect_set(F.struct("first", "last", "other_first", "other_last"))
    found = met.groupBy("doc", "other").agg(spanned.alias("found"))
    words = F.lit(LENGTH + SHINGLE - 1)
    joined = found.select("doc", "other", F.explode(_udf(_boxes, BOXES)(F.col("found"))).alias("r"))
    return joined.select(
        "doc",
        F.col("r.first").alias("start"),
        (F.col("r.last") + words).alias("stop"),
        "other",
        F.col("r.other_first").alias("other_start"),
        (F.col("r.other_last") + words).alias("other_stop"),
    )


def _checked(docs: DataFrame, met: DataFrame, candidates_of=_equal_candidates) -> DataFrame:
    """Windows that meet, of pairs of documents, to the passages in them that are verified on the words."""
    candidates = written(candidates_of(met.where("doc <> other")), "candidates")
    # Cut every wanted span once, with each text read once.
    sides = candidates.select("doc", "start", "stop").union(
        candidates.select("other", "other_start", "other_stop")
    )
    wanted = sides.distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = docs.select("doc", "text").join(wanted, "doc").select(
        "doc", "spans", _udf(_cut, pa.list_(pa.binary()))(F.col("text"), F.col("spans")).alias("pieces")
    )
    pieces = written(
        cut.select("doc", F.explode(F.arrays_zip("spans", "pieces")).alias("p"))
        .select("doc", "p.spans.start", "p.spans.stop", F.col("p.pieces").alias("piece"))
        .dropDuplicates(["doc", "start", "stop"]),
        "pieces",
    )
    others = pieces.toDF("other", "other_start", "other_stop", "other_piece")
    both = candidates.join(pieces, ["doc", "start", "stop"]).join(others, ["other", "other_start", "other_stop"])
    checked = both.select(
        "doc", "start", "other", "other_start",
        F.explode(_udf(_verified, BOTH)(F.col("piece"), F.col("other_piece"))).alias("v"),
    )
    checked = checked.select(
        "doc",
        F.expr("start + v.start").alias("start"),
        F.expr("start + v.stop").alias("stop"),
        "other",
        F.expr("other_start + v.other_start").alias("other_start"),
        F.expr("other_start + v.other_stop").alias("other_stop"),
    )
    checked = written(checked, "links")
    forget(candidates, pieces)
    return checked


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, class, n_links, n_words, spans): one row per row of docs.

    spans are the parts of the text (start and stop in words, stop exclusive, apart and in order) that
    are near duplicates of a passage of another document, n_words the words in them, class the smallest
    id among the documents that can be reached over such passages (its own without any), and n_links how
    many others can be reached. Ids are expected to be unique integers: rows that repeat an
    id count as one document. A null id has no class. Null texts, and texts of fewer than 50 words, have
    no passages. An empty table gives none.
    """
    named = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("binary").alias("text"))
    found, roots = _linked(named.where("doc is not null and text is not null"))
    spans = _spans(found)
    reached = roots.toDF("node", "component")
    least = reached.groupBy("component").agg(F.min("node").alias("class"), (F.count(F.lit(1)) - 1).alias("n_links"))
    classes = reached.join(least, "component").select(F.col("node").alias("doc"), "class", "n_links")
    facts = spans.join(classes, "doc")
    n_words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (
        docs.select(F.col(id_column).cast("long").alias("doc"))
        .join(facts, "doc", "left")
        .select(
            F.col("doc").alias("id"),
            F.coalesce("class", "doc").alias("class"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce(n_words, F.lit(0)).alias("n_words"),
            F.coalesce("spans", F.array().cast(from_arrow_type(SPANS))).alias("spans"),
        )
    )


def _merged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            merged: list[dict] = []
            for span in row:
                if merged and span["start"] <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], span["stop"])
                else:
                    merged.append(dict(span))
            out.append(merged)
        yield pa.array(out, type=SPANS)


_merged.__annotations__ = _runs.__annotations__
