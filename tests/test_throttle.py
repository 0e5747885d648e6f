"""The distributed rate limit against a plain sequential pass."""

import random
from datetime import datetime, timedelta

import pytest

from tickloom.operators import throttle as throttling
from tickloom.operators.throttle import throttle

START = datetime(2024, 1, 1)
SCHEMA = "symbol string, trade_id bigint, trade_time timestamp"


def sequential(rows, interval):
    last, kept = {}, []
    for symbol, trade_id, at in sorted(rows, key=lambda r: (r[2], r[1])):
        if symbol not in last or at - last[symbol] >= interval:
            kept.append((symbol, trade_id))
            last[symbol] = at
    return sorted(kept)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    regular = [("regular", i, START + timedelta(milliseconds=7 * i)) for i in range(20000)]
    ties = [("ties", i, START + timedelta(seconds=rnd.randrange(900))) for i in range(3000)]
    # Most rows belong to one symbol, in bursts with long pauses between them.
    bursts = [
        ("hot", i, START + timedelta(hours=rnd.randrange(60), milliseconds=rnd.randrange(40000)))
        for i in range(30000)
    ]
    return regular + ties + bursts + [("single", 1, START)]


@pytest.mark.parametrize(
    "interval",
    [
        timedelta(milliseconds=1),
        timedelta(milliseconds=50),
        timedelta(seconds=5),
        timedelta(minutes=20),
        timedelta(days=1),
    ],
)
def test_equals_sequential(spark, rows, interval):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = throttle(frame, interval).select("symbol", "trade_id").collect()
    assert sorted(tuple(r) for r in got) == sequential(rows, interval)


def test_deep_tree(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    for interval in (timedelta(milliseconds=20), timedelta(seconds=1), timedelta(hours=2)):
        got = throttle(frame, interval, limit=200).select("symbol", "trade_id").collect()
        assert sorted(tuple(r) for r in got) == sequential(rows, interval)


def test_off_and_empty(spark, rows):
    frame = spark.createDataFrame(rows[:100], SCHEMA)
    assert throttle(frame, timedelta(0)).count() == 100
    assert throttle(frame.limit(0), timedelta(seconds=5)).count() == 0


@pytest.mark.parametrize(("interval", "limit"), [(1, 7), (13, 50), (400, 7), (20_000, 7), (20_000, 1)])
def test_microseconds_in_small_slots(spark, interval, limit):
    """Dense and sparse stretches, gaps longer than a cell, and times before 1970."""
    rnd, rows = random.Random(interval + limit), []
    for symbol, spread in (("dense", 2_000), ("sparse", 10**7), ("old", 3_000)):
        start = datetime(1960, 1, 1) if symbol == "old" else START
        at = [rnd.randrange(spread) + rnd.choice([0, 0, 50 * spread]) for _ in range(250)]
        rows += [(symbol, i, start + timedelta(microseconds=us)) for i, us in enumerate(at)]
    step = timedelta(microseconds=interval)
    got = throttle(spark.createDataFrame(rows, SCHEMA), step, limit=limit).select("symbol", "trade_id").collect()
    assert sorted(tuple(r) for r in got) == sequential(rows, step)


def test_no_array_is_longer_than_the_limit(spark, rows, monkeypatch):
    seen = []
    saved = throttling._saved

    def watched(frame):
        made = saved(frame)
        if "times" in made.columns:
            seen.append(made.selectExpr("max(size(times)) AS n").first().n)
        return made

    monkeypatch.setattr(throttling, "_saved", watched)
    for interval in (timedelta(milliseconds=20), timedelta(days=2)):
        throttle(spark.createDataFrame(rows, SCHEMA), interval, limit=300).count()
    assert seen and max(seen) <= 300
