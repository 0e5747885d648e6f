"""Per-symbol rate limit: a trade is kept when at least ``interval`` has passed
since the last kept trade of its symbol, and dropped otherwise.

The choice depends on all earlier choices, yet one symbol must not end up in
one task, whatever the grain of its times and the length of the limit.

1. Instants lie in slots, short enough that none has more than ``limit`` of them. Cells of time are one slot,
   or as long as the interval if that is longer.
2. Whatever happened before a cell matters through one number, the gate before which nothing may be kept, and
   that lies less than an interval beyond the cell's start. So a cell can be entered only at an instant in its
   first interval, at the first one after that, or (the first cell of all) at its first one. For each
   such entry, a row says where the next cell is entered that anything is kept in: ``x`` leads to ``y``.
3. Two neighbouring cells make one of twice the length: entries of the left one lead on through the right
   one, which is a join of rows. Each step halves the entries, until a symbol has at most ``limit``.
4. The way from a symbol's first instant is followed through them, and the steps are taken back: each entry
   of a pair of cells is one of its left cell, and leads to one of its right cell.

Functions are rows, and the arrays (the instants of a slot, the entries of a symbol at the end) never hold
more than ``limit`` elements.
"""

from __future__ import annotations

import sys
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import scratch

# The pandas functions below travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 1_000_000
_SLOT = 15 * 60_000_000  # microseconds; shorter if a slot would hold too many instants
#: Added to all instants, so that none is negative and in the end one cell holds a whole symbol.
_SHIFT = 1 << 60
#: Stands for an instant after the last one.
_END = (1 << 63) - 1
#: Slots per group when each slot looks for the next one that is not empty.
_GROUP = 4096


def _path(follow: np.ndarray, start: int) -> np.ndarray:
    """Positions met from ``start`` when ``follow`` gives the next one of each, its length meaning the end;
    each round doubles the way and the jump."""
    end = len(follow)
    jump, met = np.append(follow, end), np.array([start])
    while met[-1] < end:
        met = np.concatenate([met, jump[met]])
        jump = jump[jump]
    return met[met < end]


def _gates(times: np.ndarray, start: int, interval: int) -> tuple[np.ndarray, np.ndarray]:
    """The instants a slot can be entered at, and the gate that each is left with."""
    follow = np.searchsorted(times, times + interval)
    last = np.where(follow < len(times), follow, np.arange(len(times)))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    entries = max(1, np.searchsorted(times, start + interval) + 1)
    return times[:entries], times[last][:entries] + interval


def _saved(rows: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: computed once, short lineage."""
    path = scratch(rows.sparkSession, "throttle")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class _Grid:
    """Cells of ``width`` microseconds, each cut into slots of at most ``slot``."""

    def __init__(self, slot: int, interval: int):
        self.slot, self.width, self.interval = slot, max(slot, interval), interval
        self.slots = -(-self.width // slot)

    def place(self, column: str) -> Column:
        """The number of the slot, which ascends with time."""
        return F.expr(f"{column} div {self.width}L * {self.slots}L + {column} % {self.width}L div {self.slot}L")

    def cell(self, column: str, level: int) -> str:
        return f"{column} div {min(self.width << level, _END)}L"


def _fitting(instants: DataFrame, interval: int, limit: int) -> _Grid:
    """A grid in which no slot has more than ``limit`` instants; a slot of one microsecond has one."""
    grid = _Grid(_SLOT, interval)
    while True:
        counted = instants.groupBy("_key", grid.place("_us").alias("slot")).count()
        most = counted.agg(F.max("count").alias("most")).first()["most"] or 0
        if most <= limit:
            return grid
        grid = _Grid(max(1, min(grid.slot // 2, grid.slot * limit // most)), interval)


def _next_first(keys: DataFrame) -> DataFrame:
    """For slots (_key, slot, first), the first instant of the next slot that has one, as ``later``.

    Slots look inside their group, then groups among the groups of the symbol.
    """
    grouped = keys.withColumn("group", F.expr(f"slot div {_GROUP}"))
    ahead = Window.partitionBy("_key", "group").orderBy("slot").rowsBetween(1, Window.unboundedFollowing)
    groups = grouped.groupBy("_key", "group").agg(F.min("first").alias("first"))
    beyond = Window.partitionBy("_key").orderBy("group").rowsBetween(1, Window.unboundedFollowing)
    groups = groups.select("_key", "group", F.min("first").over(beyond).alias("beyond"))
    inside = grouped.withColumn("inside", F.min("first").over(ahead))
    found = inside.join(groups, ["_key", "group"])
    return found.select("_key", "slot", F.coalesce("inside", "beyond").alias("later"))


def _resolved(gates: DataFrame, cells: DataFrame, grid: _Grid) -> DataFrame:
    """(_key, x, y): the first instant at or after each gate, or _END."""
    asked = gates.withColumn("slot", grid.place("gate"))
    asked = asked.groupBy("_key", "slot").agg(F.collect_list(F.struct("x", "gate")).alias("asked"))
    firsts = cells.select("_key", "slot", F.element_at("times", 1).alias("first"))
    empty = asked.select("_key", "slot", F.lit(None).cast("bigint").alias("first"))
    keys = firsts.unionByName(empty).groupBy("_key", "slot").agg(F.min("first").alias("first"))
    both = asked.join(cells.select("_key", "slot", "times"), ["_key", "slot"], "left")
    both = both.join(_next_first(keys), ["_key", "slot"])

    @F.pandas_udf("array<bigint>")
    def first_at(times: pd.Series, gate: pd.Series, later: pd.Series) -> pd.Series:
        found = []
        for t, g, after in zip(times, gate, later):
            t = np.zeros(0, np.int64) if t is None else np.asarray(t, np.int64)
            found.append(np.append(t, after)[np.searchsorted(t, np.asarray(g, np.int64))])
        return pd.Series(found)

    y = first_at("times", "asked.gate", F.coalesce("later", F.lit(_END)))
    found = both.select("_key", F.explode(F.arrays_zip("asked.x", y.alias("y"))).alias("z"))
    return found.select("_key", F.col("z.x").alias("x"), F.col("z.y").alias("y"))


def _doubled(rows: DataFrame, grid: _Grid, level: int) -> DataFrame:
    """Entries of cells of ``level`` to those of cells twice as long."""
    cell, width = grid.cell("x", level + 1), min(grid.width << (level + 1), _END)
    placed = rows.withColumn("cell", F.expr(cell))
    late = F.expr(f"CASE WHEN x - cell * {width}L >= {grid.width}L THEN x END")
    firsts = placed.groupBy("_key", "cell").agg(F.min("x").alias("first"), F.min(late).alias("after"))
    kept = placed.join(firsts, ["_key", "cell"]).where(
        f"x - cell * {width}L < {grid.width}L OR x = first OR x = after"
    )
    onward = rows.select("_key", F.col("x").alias("y"), F.col("y").alias("then"))
    found = kept.join(onward, ["_key", "y"], "left")
    through = F.expr(f"{grid.cell('y', level + 1)} = cell")
    return found.select("_key", "x", F.when(through, F.col("then")).otherwise(F.col("y")).alias("y"))


def _ways(rows: DataFrame, grid: _Grid, level: int) -> DataFrame:
    """How many entries each symbol has, its first one, and whether one cell holds them all."""
    cell = F.expr(grid.cell("x", level))
    return rows.groupBy("_key").agg(
        F.count(F.lit(1)).alias("entries"), F.min("x").alias("first"), (F.min(cell) == F.max(cell)).alias("alone")
    )


def throttle(
    trades: DataFrame,
    interval: timedelta,
    key: str = "symbol",
    time: str = "trade_time",
    tie: str = "trade_id",
    limit: int = LIMIT,
) -> DataFrame:
    """The kept trades, whole rows. The first trade of a symbol is always kept;
    of several at one instant the smallest ``tie`` counts. A zero interval is off.
    Rows without symbol or time are malformed and belong in the quarantine.
    """
    step = interval // timedelta(microseconds=1)
    if step <= 0:
        return trades

    keyed = trades.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumns(
        {"_key": F.col(key), "_us": F.unix_micros(F.col(time).cast("timestamp")) + F.lit(_SHIFT)}
    )
    instants = _saved(keyed.select("_key", "_us").distinct())
    grid = _fitting(instants, step, limit)
    cells = _saved(
        instants.groupBy("_key", grid.place("_us").alias("slot")).agg(F.sort_array(F.collect_list("_us")).alias("times"))
    )
    if grid.slots == 1:

        @F.pandas_udf("struct<x:array<bigint>,gate:array<bigint>>")
        def entries(times: pd.Series, slot: pd.Series) -> pd.DataFrame:
            made = [_gates(np.asarray(t, np.int64), int(n) * grid.width, step) for t, n in zip(times, slot)]
            return pd.DataFrame({"x": [m[0] for m in made], "gate": [m[1] for m in made]})

        pairs = cells.select("_key", entries("times", "slot").alias("e"))
        pairs = pairs.select("_key", F.explode(F.arrays_zip("e.x", "e.gate")).alias("p"))
        gates = pairs.select("_key", "p.x", "p.gate")
    else:
        gates = instants.select("_key", F.col("_us").alias("x"), (F.col("_us") + step).alias("gate"))
    levels = [_saved(_resolved(gates, cells, grid))]
    while not _ways(levels[-1], grid, len(levels) - 1).where((F.col("entries") > limit) & ~F.col("alone")).isEmpty():
        levels.append(_saved(_doubled(levels[-1], grid, len(levels) - 1)))
    # A symbol that one cell holds is entered there at its first instant alone.
    ways = _ways(levels[-1], grid, len(levels) - 1)
    top = levels[-1].join(ways, "_key").where((F.col("entries") <= limit) | (F.col("x") == F.col("first")))

    key_type = keyed.schema["_key"].dataType.simpleString()

    def followed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x")
        x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
        met = _path(np.searchsorted(x, y), 0)
        return pd.DataFrame({"_key": pdf["_key"].iloc[met].to_numpy(), "x": x[met]})

    met = top.select("_key", "x", "y").groupBy("_key").applyInPandas(followed, f"_key {key_type}, x bigint")
    for level in range(len(levels) - 2, -1, -1):
        found = _saved(met).join(levels[level], ["_key", "x"])
        inside = F.expr(f"{grid.cell('x', level + 1)} = {grid.cell('y', level + 1)}")
        right = found.where(inside).select("_key", F.col("y").alias("x"))
        met = found.select("_key", "x").unionByName(right)

    if grid.slots == 1:

        @F.pandas_udf("array<bigint>")
        def keep(times: pd.Series, x: pd.Series) -> pd.Series:
            kept = []
            for t, entry in zip(times, x):
                t = np.asarray(t, np.int64)
                kept.append(t[_path(np.searchsorted(t, t + step), int(np.searchsorted(t, entry)))])
            return pd.Series(kept)

        entered = met.withColumn("slot", grid.place("x"))
        whole = cells.join(entered, ["_key", "slot"])
        kept = _saved(whole.select("_key", F.explode(keep("times", "x")).alias("_us")))
    else:
        kept = _saved(met.withColumnRenamed("x", "_us"))

    def one_per_instant(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy("_key", "_us").orderBy(tie)
        return rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")

    # The limit per instant comes first: it runs before the shuffle, so that an instant with very many
    # rows does not meet in one task. Spark knows the size of the kept instants, as they were written.
    chosen = one_per_instant(keyed).join(kept, ["_key", "_us"], "left_semi")
    return chosen.drop("_key", "_us")
