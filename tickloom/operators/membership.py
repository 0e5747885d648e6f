"""Which keys may be stored already: Bloom filters that are rows of a table.

A filter is kept per day and hour of trade time as words of 64 bits. A key has one word in its hour and sets
PROBES bits in it, so adding a batch is one ``bit_or`` per word, merging filters is the same, and asking is a
join on the word. A key that was added is always admitted; another is admitted by chance, by about one
in a hundred at four keys a word, more if an hour holds more than WORDS * 4 keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.dedup import TRADE_KEY

WORDS = 1 << 24
PROBES = 4
COLUMNS = ["dt", "hour", "word", "bits"]


def _bits(keys: Sequence[str]) -> Column:
    """PROBES of the 64 bits, each named by six bits of a second hash."""
    second = f"xxhash64('bits', {', '.join(keys)})"
    ones = [f"shiftleft(1L, CAST(shiftright({second}, {6 * i}) & 63 AS INT))" for i in range(PROBES)]
    return F.expr(" | ".join(ones))


def placed(rows: DataFrame, time: str = "trade_time", keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    """The rows with the place of their key: ``hour``, ``word`` and the ``bits`` in it."""
    word = F.pmod(F.xxhash64(*keys), F.lit(WORDS))
    return rows.withColumns({"hour": F.hour(time), "word": word, "bits": _bits(keys)})


def union(words: DataFrame, by: Sequence[str] = ("hour", "word")) -> DataFrame:
    """Words of several filters as those of one."""
    return words.groupBy(*by).agg(F.bit_or("bits").alias("bits"))


def filters(rows: DataFrame, time: str = "trade_time", keys: Sequence[str] = TRADE_KEY) -> DataFrame:
    """Filters of rows that carry their day as ``dt``."""
    return union(placed(rows, time, keys), COLUMNS[:-1])


def admitted(
    rows: DataFrame, stored: DataFrame, time: str = "trade_time", keys: Sequence[str] = TRADE_KEY
) -> DataFrame:
    """The rows whose key the stored filters of its day and hour admit."""
    words = stored.select("dt", "hour", "word", F.col("bits").alias("_stored"))
    inside = F.expr("_stored & bits = bits")
    asked = placed(rows, time, keys).alias("a")
    on = [F.col(f"a.{c}") == F.col(f"w.{c}") for c in ("dt", "hour", "word")]
    return asked.join(words.alias("w"), [*on, inside], "left_semi").select(*rows.columns)
