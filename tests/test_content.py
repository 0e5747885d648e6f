"""Offset ranges, fingerprints of layers, upserts and running prices."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import audit, compare, intervals
from tickloom.plans import layers
from tickloom.sinks import storage, tables
from tickloom.sources import samples
from tickloom.streaming import jobs


@pytest.fixture()
def offsets(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK", 16)
    rnd = random.Random(1)
    rows = [(p, o) for p in range(3) for o in rnd.sample(range(400), 250)] + [(4, 7), (0, 10**6)]
    return spark.createDataFrame(rows + rows[:50], "kafka_partition int, kafka_offset bigint")


def test_ranges_give_the_gaps_of_the_records(offsets):
    found = intervals.of(offsets)
    assert found.where("first div 16 <> last div 16").isEmpty()
    got = sorted((r.kafka_partition, r.gap_start) for r in intervals.gaps(found).collect())
    assert got == sorted(tuple(r) for r in audit.offset_gaps(offsets).collect())
    by_partition = {}
    for r in offsets.distinct().collect():
        by_partition.setdefault(r.kafka_partition, []).append(r.kafka_offset)
    missing = sum(max(o) - min(o) + 1 - len(o) for o in by_partition.values())
    assert intervals.gaps(found).agg(F.sum(F.col("gap_end") - F.col("gap_start") + 1)).first()[0] == missing


def test_ranges_of_blocks_merge_in_any_order(offsets):
    whole = sorted(map(tuple, intervals.of(offsets).select(*intervals.COLUMNS).collect()))
    split = offsets.withColumn("part", F.pmod(F.xxhash64("kafka_offset", F.lit(3)), F.lit(3)))
    parts = [intervals.of(split.where(F.col("part") == k)) for k in (2, 0, 1)]
    once = intervals.merged(parts[0].unionByName(parts[1]))
    both = intervals.merged(once.unionByName(parts[2]).unionByName(parts[1]))
    assert sorted(map(tuple, both.select(*intervals.COLUMNS).collect())) == whole


def test_fingerprints_do_not_depend_on_order_or_blocks(spark, sf_dir):
    rows = layers.silver(samples.bronze(spark, sf_dir)).withColumn("dt", F.to_date("trade_time"))
    columns = [c for c in rows.columns if c not in ("symbol", "dt")]
    by = ["symbol", "dt"]
    whole = compare.fingerprints(rows, by, columns)
    parts = [compare.fingerprints(rows.where(f"trade_id % 2 = {k}"), by, columns) for k in (1, 0)]
    merged = compare.merge(parts[0].unionByName(parts[1]), by)
    assert compare.differing(whole, merged.select(*whole.columns), by).isEmpty()
    mixed = compare.fingerprints(rows.repartition(7, "price"), by, columns)
    assert compare.differing(whole, mixed, by).isEmpty()


def test_differences_are_named(spark):
    left = [("a", 1, 1.0, None), ("a", 2, 2.0, "x"), ("b", 1, 3.0, "y"), ("c", 1, 1.0, "z")]
    right = [("a", 1, 1.0, "new"), ("a", 2, 2.5, "x"), ("b", 1, 3.0, "y"), ("b", 9, 3.0, None)]
    frames = [spark.createDataFrame(rows, "g string, k int, v double, w string") for rows in (left, right)]
    found = compare.differences(*frames, ["g"], ["k"], ["v", "w"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [
            ("a", 1, "w", None, "new"),
            ("a", 2, "v", "2.0", "2.5"),
            ("b", 9, "row", None, "present"),
            ("c", 1, "row", "present", None),
        ],
        key=str,
    )
    assert compare.differences(frames[0], frames[0], ["g"], ["k"], ["v", "w"]).isEmpty()
    # Values that trade places, a null in place of a value, and a repeated row do not go unseen.
    swapped = frames[0].select("g", "k", "v", F.when(F.col("g") == "a", F.lit("x")).otherwise(F.col("w")).alias("w"))
    twice = frames[0].unionByName(frames[0].where("g = 'b'"))
    for other, groups in ((swapped, {"a"}), (twice, {"b"})):
        prints = [compare.fingerprints(rows, ["g"], ["k", "v", "w"]) for rows in (frames[0], other)]
        assert {r.g for r in compare.differing(*prints, ["g"]).collect()} == groups


def test_upsert_replaces_by_key_and_replays(spark, tmp_path):
    path = str(tmp_path / "prices")
    batches = [[("a", 1.0), ("b", 1.0)], [("b", 2.0), ("c", 2.0)], [("a", 3.0)], [("d", 4.0)]]
    for batch_id, rows in enumerate(batches):
        for _ in range(2):
            tables.upsert(spark.createDataFrame(rows, "symbol string, price double"), path, "symbol", batch_id, 4)
    assert {r.symbol: r.price for r in tables.upserted(spark, path).collect()} == {"a": 3.0, "b": 2.0, "c": 2.0, "d": 4.0}
    tables.upsert(spark.createDataFrame([], "symbol string, price double"), path, "symbol", 9, 4)
    for bucket in storage.values(spark, path, "bucket"):
        assert len(storage.values(spark, f"{path}/bucket={bucket}", "batch_id")) <= 2
    assert tables.upserted(spark, str(tmp_path / "nothing")) is None


def test_running_prices_live_in_rocksdb(spark, tmp_path):
    """Old trades and copies in a later delivery, each with a restart from the checkpoint."""
    folder, path, check = str(tmp_path / "in"), str(tmp_path / "prices"), tmp_path / "check"
    schema = "symbol string, trade_id bigint, price double, trade_time string"
    deliveries = [
        [("a", 1, 1.0, "2024-01-05"), ("b", 2, 2.0, "2024-01-05")],
        [("a", 3, 9.0, "2020-01-01"), ("b", 4, 3.0, "2024-01-05"), ("c", 5, 1.0, "1999-01-01")],
        [("a", 1, 1.0, "2024-01-05")],
    ]
    for rows in deliveries:
        frame = spark.createDataFrame(rows, schema).withColumn("trade_time", F.col("trade_time").cast("timestamp"))
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(frame.schema).parquet(folder)
        jobs.price_updates(stream, path, str(check), interval=None).awaitTermination()
    assert {r.symbol: r.price for r in tables.upserted(spark, path).collect()} == {"a": 1.0, "b": 3.0, "c": 1.0}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
    assert list(check.glob("state/0/*/*.zip"))


def test_buckets_need_no_exchange(spark, sf_dir, tmp_path):
    bronze = samples.bronze(spark, sf_dir)
    tables.write_bucketed(bronze, "bucketed_test.trades", str(tmp_path), "symbol", 16, ["symbol", "trade_id"])
    stored = spark.table("bucketed_test.trades")
    silver = layers.silver(stored)
    bars = layers.fact_trades_1h(layers.staging(silver))
    for rows in (silver, bars):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    assert "Exchange" in layers.silver(bronze)._jdf.queryExecution().executedPlan().toString()
    right = layers.fact_trades_1h(layers.staging(layers.silver(bronze)))
    assert sorted(bars.collect()) == sorted(right.collect())
    sizes = tables.bucket_sizes(spark, "bucketed_test.trades", "symbol").collect()
    assert sum(r.rows for r in sizes) == bronze.count() and sum(r["values"] for r in sizes) == 5
    assert all(r.largest <= r.rows for r in sizes)
