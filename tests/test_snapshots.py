"""Landed REST answers: files in, idempotent partitions out."""

from datetime import date

from pyspark.sql import functions as F

from tickloom.operators import snapshots
from tickloom.sinks import tables
from tickloom.sources import landed, samples

CANDLE = '[{at},"1.0","2.0","0.5","1.5","10.0",{close},"15.0",3,"4.0","6.0","0"]'


def body(*opened):
    return "[" + ",".join(CANDLE.format(at=at, close=at + 3599999) for at in opened) + "]"


def day_ms(day):
    return (day - date(1970, 1, 1)).days * 86_400_000


def test_klines_from_files(spark, sf_dir, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "klines")
    bodies = samples.kline_bodies(spark, sf_dir)
    bodies.repartition("symbol", "dt").write.partitionBy("symbol", "dt").text(landing)
    for _ in range(2):
        rows = snapshots.klines(landed.kline_responses(spark, landing))
        tables.overwrite_partitions(rows, out, ["symbol", "dt"])
    stored = spark.read.parquet(out)
    assert stored.count() == rows.count()
    unique = snapshots.latest_klines(stored)
    assert unique.count() == unique.select("symbol", "open_time_ms").distinct().count()
    assert unique.agg(F.sum("trades")).first()[0] == samples.trades(spark, sf_dir).count()


def test_midnight_candle_later_answer_wins(spark):
    day = date(2024, 1, 2)
    midnight = day_ms(day)
    answers = spark.createDataFrame(
        [(" btcusdt ", day, body(midnight)), ("BTCUSDT", date(2024, 1, 3), body(midnight))],
        "symbol string, dt date, body string",
    )
    rows = snapshots.klines(answers)
    assert rows.count() == 2
    kept = snapshots.latest_klines(rows).collect()
    assert [(r.symbol, r.dt) for r in kept] == [("BTCUSDT", date(2024, 1, 3))]


def test_range_and_page_limit(spark):
    day = date(2024, 1, 2)
    outside = [day_ms(day) + 1, day_ms(day) - 86_400_001]
    page = [day_ms(day) - i for i in range(1000)]
    answers = spark.createDataFrame(
        [("A", day, body(*outside, day_ms(day))), ("B", day, body(*page)), ("C", day, "broken")],
        "symbol string, dt date, body string",
    )
    rows = snapshots.klines(answers)
    found = {r.symbol: (r["count"], r.page) for r in rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("count"), F.max("page_full").alias("page")).collect()}
    assert found == {"A": (1, False), "B": (1000, True)}
    bad = snapshots.rejected(snapshots.decode_klines(answers), "symbol").collect()
    assert sorted((r.symbol, r.bad_fields) for r in bad) == [
        ("A", "out of range"), ("A", "out of range"), ("C", "not an array of candles"),
    ]
    assert {r.raw for r in bad if r.symbol == "C"} == {"broken"}


def test_bad_coins_are_set_aside_with_their_text(spark, tmp_path):
    landing = tmp_path / "market" / "dt=2024-01-01" / "hour=05"
    landing.mkdir(parents=True)
    (landing / "20240101T051500.json").write_text('[{"id":"a","market_cap":"x"}, 7, {"symbol":"s"}, {"id":"b"}]')
    (landing / "20240101T053000.json").write_text('{"status":"error"}')
    decoded = snapshots.decode_coins(landed.market_objects(spark, str(tmp_path / "market")))
    bad = {(r.raw, r.bad_fields) for r in snapshots.rejected(decoded).collect()}
    assert bad == {
        ('{"id":"a","market_cap":"x"}', "market_cap"), ("7", "not an object"), ('{"symbol":"s"}', "id"),
        ('{"status":"error"}', "id"),
    }
    assert [r.id for r in snapshots.usable(decoded).collect()] == ["b"]
    assert {str(r.snapshot_ts) for r in decoded.collect()} == {"2024-01-01 05:15:00", "2024-01-01 05:30:00"}


def test_two_snapshots_of_one_hour(spark, tmp_path):
    landing = tmp_path / "market" / "dt=2024-01-01" / "hour=05"
    landing.mkdir(parents=True)
    for minute in ("00", "15"):
        (landing / f"20240101T05{minute}00.json").write_text('[{"id":"a","market_cap":5.0},{"id":"b","market_cap":4.0}]')
    top = snapshots.market_top(snapshots.coins(landed.market_objects(spark, str(tmp_path / "market"))), 2).collect()
    assert [(r.snapshot_ts.minute, r.id) for r in top] == [(0, "a"), (0, "b"), (15, "a"), (15, "b")]


def test_market_files(spark, tmp_path):
    landing = tmp_path / "market" / "dt=2024-01-01" / "hour=05"
    landing.mkdir(parents=True)
    (landing / "a.json").write_text(
        '[{"id":"a","symbol":"A","market_cap":5.0,"roi":{"x":1}},\n {"id":"b","market_cap":9.0},'
        ' {"id":"c","market_cap":null}]'
    )
    coins = snapshots.coins(landed.market_objects(spark, str(tmp_path / "market")))
    top = snapshots.market_top(coins, 2).collect()
    assert [(r.id, r["rank"]) for r in top] == [("b", 1), ("a", 2)]
    assert top[1]._rescued == '{"roi":"{\\"x\\":1}"}' and top[0]._rescued is None
    parts = snapshots.with_partitions(coins).select("dt", "hour").distinct().collect()
    assert [tuple(r) for r in parts] == [(date(2024, 1, 1), "05")]
    out = str(tmp_path / "out")
    for _ in range(2):
        tables.overwrite_partitions(snapshots.with_partitions(coins), out, ["dt", "hour"])
    assert spark.read.parquet(out).count() == 3
