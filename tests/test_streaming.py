"""Streams give what the batch functions give, also after restart and replay."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tickloom.operators import audit, dedup, latest, normalize, ohlcv
from tickloom.operators.throttle import throttle
from tickloom.plans import maintenance
from tickloom.sinks import storage, tiers
from tickloom.sources import log, samples
from tickloom.streaming import jobs
from tickloom.streaming.metrics import IngestTotals


@pytest.fixture()
def topic(spark, sf_dir, tmp_path):
    """Two deliveries of the log; the second holds late and malformed records."""
    records = samples.log_records(samples.bronze(spark, sf_dir))
    late = F.split("key", ":")[1].cast("bigint") % 7 == 0
    broken = spark.createDataFrame(
        [("k", text, "t", 0, 10**12 + i, datetime(2024, 1, 31)) for i, text in enumerate(["oops", "{}"])],
        records.schema,
    )
    path = tmp_path / "topic"

    def deliver(part: int) -> None:
        rows = records.where(~late) if part == 0 else records.where(late).unionByName(broken)
        rows.coalesce(1).write.mode("append").json(str(path))

    deliver(0)
    return str(path), deliver


def bronze_stream(spark, path):
    return normalize.valid(jobs.decoded(log.file_log(spark, path)))


def land(spark, topic_path, out, check):
    rows = jobs.decoded(log.file_log(spark, topic_path))
    jobs.land_bronze(rows, out, f"{out}-bad", f"{out}-commits", check, interval=None).awaitTermination()


def test_bronze_and_quarantine_survive_restart(spark, sf_dir, topic, tmp_path):
    path, deliver = topic
    out, check = str(tmp_path / "bronze"), str(tmp_path / "check")
    for part in (None, 1, None):
        if part is not None:
            deliver(part)
        land(spark, path, out, check)
    stored = spark.read.parquet(out).select(*samples.bronze(spark, sf_dir).columns)
    assertDataFrameEqual(stored, samples.bronze(spark, sf_dir))
    assert sorted(r.raw for r in spark.read.parquet(f"{out}-bad").collect()) == ["oops", "{}"]


def test_commits_are_logged_per_batch(spark, topic, tmp_path):
    path, deliver = topic
    out, check = str(tmp_path / "bronze"), str(tmp_path / "check")
    land(spark, path, out, check)
    deliver(1)
    land(spark, path, out, check)
    history = audit.commit_history(spark.read.parquet(f"{out}-commits")).collect()
    assert [r.snapshot_id for r in history] == [0, 1]
    assert sum(int(r.added) for r in history) == spark.read.parquet(out).count()


def test_landed_bronze_may_be_compacted_and_landed_on(spark, sf_dir, topic, tmp_path):
    path, deliver = topic
    out, check = str(tmp_path / "bronze"), str(tmp_path / "check")
    land(spark, path, out, check)
    for symbol in storage.values(spark, out, "symbol"):
        maintenance.compact_files(spark, f"{out}/symbol={symbol}", ["trade_id"])
    deliver(1)
    land(spark, path, out, check)
    stored = spark.read.parquet(out).select(*samples.bronze(spark, sf_dir).columns)
    assertDataFrameEqual(stored, samples.bronze(spark, sf_dir))


def test_hot_path_equals_batch(spark, sf_dir, topic, tmp_path):
    path, deliver = topic
    into, check = jobs.HotTables.under(str(tmp_path / "hot")), str(tmp_path / "check")
    jobs.hot_path(bronze_stream(spark, path), into, check, None).awaitTermination()
    deliver(1)
    jobs.hot_path(bronze_stream(spark, path), into, check, None).awaitTermination()
    trades = samples.trades(spark, sf_dir)
    assertDataFrameEqual(
        ohlcv.bars(jobs.minute_states(spark, into)), ohlcv.bars(ohlcv.partial(trades)), rtol=0, atol=0
    )
    assertDataFrameEqual(
        latest.prices(jobs.price_states(spark, into)), latest.prices(latest.partial(trades))
    )
    assert jobs.raw_trades(spark, into).count() == trades.count()


def test_arrival_dedup_loses_no_old_rows(spark, tmp_path):
    path = tmp_path / "in"
    for day in ("2024-06-01", "2020-01-01", "2024-06-01"):
        row = spark.createDataFrame([("A", int(day[:4]), day)], "symbol string, trade_id int, t string")
        row.select("symbol", "trade_id", F.col("t").cast("timestamp").alias("kafka_timestamp")).write.mode(
            "append"
        ).parquet(str(path))
        time.sleep(1.1)
    schema = spark.read.parquet(str(path)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))
    query = (
        dedup.first_seen(stream, "10 minutes")
        .writeStream.format("memory")
        .queryName("arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.trade_id for r in spark.table("arrivals").collect()) == [2020, 2024]


def test_replays_and_old_copies_change_nothing(spark, sf_dir, tmp_path):
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    hot = normalize.to_hot(samples.bronze(spark, sf_dir))
    split = F.col("trade_id") < 500
    for batch_id, part in ((0, split), (1, ~split), (1, ~split), (2, split), (3, F.lit(True)), (3, F.lit(True))):
        jobs.write_hot_batch(hot.where(part), batch_id, into)
    trades = samples.trades(spark, sf_dir)
    bars = ohlcv.bars(jobs.minute_states(spark, into))
    assertDataFrameEqual(bars, ohlcv.bars(ohlcv.partial(trades)), rtol=0, atol=0)
    assert jobs.raw_trades(spark, into).count() == trades.count()


def test_states_do_not_grow_with_batches(spark, sf_dir, tmp_path):
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    hot = normalize.to_hot(samples.bronze(spark, sf_dir)).where("to_date(trade_time) = '2024-01-03'")
    for batch_id in range(9):
        jobs.write_hot_batch(hot.where(F.pmod("trade_id", F.lit(9)) == batch_id), batch_id, into)
        for path in (into.raw, into.seen, into.minute):
            assert len(tiers.folders(spark, path, "2024-01-03")) <= tiers.FAN + 1
        states = jobs.minute_states(spark, into)
        assert states.count() == states.select("symbol", "bucket_ts").distinct().count()
        assert jobs.price_states(spark, into).groupBy("symbol").count().where("count > 1").isEmpty()
    assert len(storage.values(spark, into.latest, "batch_id")) <= 2
    right = ohlcv.partial(dedup.latest(hot))
    assertDataFrameEqual(ohlcv.bars(jobs.minute_states(spark, into)), ohlcv.bars(right), rtol=0, atol=0)


def test_totals(spark, topic, tmp_path):
    path, deliver = topic
    deliver(1)
    listener = IngestTotals()
    spark.streams.addListener(listener)
    try:
        land(spark, path, str(tmp_path / "out"), str(tmp_path / "check"))
        wait = time.time() + 20
        while listener.totals["errors"] < 2 and time.time() < wait:
            time.sleep(0.2)
        assert listener.totals["errors"] == 2
        assert listener.totals["received"] == listener.totals["sent"] + 2
    finally:
        spark.streams.removeListener(listener)


@pytest.mark.parametrize("window", ["1 minute", "1 hour"])
def test_windowed_bars_keep_late_trades_and_the_last_window(spark, sf_dir, tmp_path, window):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    trades = samples.trades(spark, sf_dir)
    for part in range(3):  # the oldest come last
        trades.where(F.col("trade_id").between(700 - 350 * part, 1049 - 350 * part)).write.mode("append").parquet(path)
        rows = spark.readStream.schema(trades.schema).parquet(path)
        jobs.windowed_bars(rows, out, str(tmp_path / "check"), window, interval=None).awaitTermination()
    found = jobs.window_states(spark, out)
    right = ohlcv.bars(ohlcv.partial(trades.where("trade_id < 1050"), window.split()[1]))
    assertDataFrameEqual(ohlcv.bars(found), right, rtol=0, atol=0)


def test_feed_stream(spark, sf_dir, tmp_path):
    path = str(tmp_path / "feed")
    samples.feed_lines(spark, sf_dir).write.text(path)
    query = (
        normalize.valid(normalize.decode_feed(log.feed(spark, path)))
        .writeStream.format("memory")
        .queryName("feed_rows")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("feed_rows").count() == samples.trades(spark, sf_dir).count()


def test_distributed_throttle_over_batches_and_replay(spark, sf_dir, tmp_path):
    trades = samples.trades(spark, sf_dir).select("symbol", "trade_id", "trade_time", "price")
    path, interval = str(tmp_path / "kept"), timedelta(minutes=30)
    parts = [F.col("trade_id") < 300, F.col("trade_id").between(300, 310), F.col("trade_id") > 310]
    for batch_id in (0, 1, 1, 2, 2):
        jobs.throttle_batch(trades.where(parts[batch_id]), batch_id, interval, path)
    kept = spark.read.parquet(path).drop("batch_id")
    assertDataFrameEqual(kept, throttle(trades, interval))
    assert len(storage.values(spark, f"{path}-last", "batch_id")) <= 2
    counted = spark.read.parquet(f"{path}-throttled").agg(F.sum("received"), F.sum("sent"), F.sum("throttled")).first()
    assert tuple(counted) == (trades.count(), kept.count(), trades.count() - kept.count())


def test_distributed_throttle_with_an_empty_batch(spark, sf_dir, tmp_path):
    trades = samples.trades(spark, sf_dir).select("symbol", "trade_id", "trade_time", "price")
    path, interval = str(tmp_path / "kept"), timedelta(minutes=5)
    for batch_id, part in enumerate([trades, trades.where("false"), trades]):
        jobs.throttle_batch(part, batch_id, interval, path)
    kept = spark.read.parquet(path).drop("batch_id")
    assertDataFrameEqual(kept, throttle(trades, interval))
