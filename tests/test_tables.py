"""Stored tables: create, replace, idempotent partitions, upkeep, JDBC."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tickloom.operators import audit, dedup, normalize, ohlcv, quality, retention
from tickloom.plans import layers, maintenance, serving
from tickloom.schema import BRONZE
from tickloom.session import scratch, shared_dir
from tickloom.sinks import publish, storage, tables
from tickloom.sources import jdbc, samples


def files(spark, path):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def test_scratch_follows_the_session(spark, tmp_path):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a") != scratch(spark, "a")


def test_ensure_is_idempotent(spark, tmp_path):
    table = tables.ensure(spark, "ensured.trades", BRONZE, str(tmp_path), ["symbol"])
    assert table.count() == 0
    assert set(table.columns) == set(BRONZE.fieldNames())
    tables.ensure(spark, "ensured.trades", BRONZE, str(tmp_path), ["symbol"])
    names = [r[0] for r in tables.databases(spark).collect()]
    assert "ensured" in names


def test_refresh_builds_all_layers(spark, sf_dir, tmp_path):
    bronze = samples.bronze(spark, sf_dir)
    tables.replace(spark, "bronze.trades", bronze, str(tmp_path), ["symbol"])
    names = layers.refresh(spark, str(tmp_path))
    again = layers.refresh(spark, str(tmp_path))
    assert names == again
    expected = layers.fact_trades_1h(layers.staging(layers.silver(bronze)))
    assertDataFrameEqual(spark.table("gold.fact_trades_1h"), expected, rtol=0, atol=0)
    versions = storage.folders(spark, str(tmp_path / "gold" / "fact_trades_1h"))
    assert len(versions) == 2
    layers.refresh(spark, str(tmp_path))
    assert versions[1] in storage.folders(spark, str(tmp_path / "gold" / "fact_trades_1h")) != versions
    report = audit.reconcile(spark.table("bronze.trades"))
    assert report.agg(F.sum("removed")).first()[0] == bronze.count() - spark.table("silver.trades").count()


def test_table_may_be_rebuilt_from_itself(spark, sf_dir, tmp_path):
    rows = samples.bronze(spark, sf_dir)
    tables.replace(spark, "selfy.trades", rows, str(tmp_path))
    tables.replace(spark, "selfy.trades", dedup.latest(spark.table("selfy.trades")), str(tmp_path))
    assert spark.table("selfy.trades").count() == samples.trades(spark, sf_dir).count()


def test_partition_overwrite_is_idempotent(spark, sf_dir, tmp_path):
    path = str(tmp_path / "klines")
    rows = samples.trades(spark, sf_dir).withColumn("dt", F.to_date("trade_time"))
    tables.overwrite_partitions(rows, path, ["symbol", "dt"])
    one = rows.where("symbol = 'click' AND dt = DATE '2024-01-03'")
    tables.overwrite_partitions(one, path, ["symbol", "dt"])
    assert spark.read.parquet(path).count() == rows.count()
    layout = tables.partition_layout(spark.read.parquet(path), ["symbol", "dt"])
    assert layout.count() == rows.select("symbol", "dt").distinct().count()


def test_date_bound_prunes_state_folders(spark, sf_dir, tmp_path):
    path = str(tmp_path / "states")
    states = ohlcv.partial(samples.trades(spark, sf_dir)).withColumn("dt", F.to_date("bucket_ts"))
    tables.write(states, path, ["dt"], sort_by=["symbol", "bucket_ts"])
    as_of = datetime(2024, 1, 20, 12, 0, tzinfo=timezone.utc)
    stored = spark.read.parquet(path)
    panel = serving.panel_close(stored, as_of, 30)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "volume" not in plan.split("ReadSchema")[1].split("\n")[0]
    assertDataFrameEqual(panel, serving.panel_close(states.drop("dt"), as_of, 30))


def test_compaction_keeps_results(spark, sf_dir, tmp_path):
    path = str(tmp_path / "states")
    rows = samples.trades(spark, sf_dir)
    states = ohlcv.partial(rows, extra=["kafka_partition"]).withColumnRenamed("kafka_partition", "batch_id")
    states = states.withColumn("dt", F.to_date("bucket_ts"))
    tables.overwrite_partitions(states, path, ["dt", "batch_id"])
    before = ohlcv.bars(spark.read.parquet(path)).collect()
    day = date(2024, 1, 3)
    for _ in range(2):
        maintenance.compact_states(spark, path, day)
        stored = spark.read.parquet(path)
        kept = stored.where(F.col("dt") == F.lit(day))
        assert kept.select("batch_id").distinct().count() == 1
        assert kept.count() == kept.select("symbol", "bucket_ts").distinct().count()
        assert sorted(ohlcv.bars(stored).collect()) == sorted(before)


def test_rebuilding_a_day_repairs_double_counts(spark, sf_dir, tmp_path):
    path = str(tmp_path / "states")
    rows = samples.trades(spark, sf_dir)
    twice = ohlcv.partial(samples.redeliver(rows), extra=["kafka_partition"])
    twice = twice.withColumnRenamed("kafka_partition", "batch_id").withColumn("dt", F.to_date("bucket_ts"))
    tables.overwrite_partitions(twice, path, ["dt", "batch_id"])
    day = date(2024, 1, 5)
    silver = layers.silver(samples.bronze(spark, sf_dir))
    maintenance.rebuild_states(silver, path, day)
    bars = ohlcv.bars(spark.read.parquet(path)).where(F.to_date("bucket_ts") == F.lit(day))
    right = ohlcv.bars(ohlcv.partial(rows)).where(F.to_date("bucket_ts") == F.lit(day))
    assertDataFrameEqual(bars, right, rtol=0, atol=0)


def test_merge_touches_only_its_folders(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    first = layers.silver(samples.as_bronze(samples.trades(spark, sf_dir)), positions=True)
    tables.write(first.withColumn("dt", F.to_date("trade_time")), path, ["symbol", "dt"])
    before = {r.path for r in files(spark, path).select("path").collect()}
    newer = samples.as_bronze(samples.trades(spark, sf_dir)).where("symbol = 'click'")
    newer = newer.withColumns({"price": F.lit(7.0), "kafka_timestamp": F.lit("2025-01-01").cast("timestamp")})
    newer = newer.where("to_date(timestamp_millis(trade_time_ms)) = '2024-01-03'")
    maintenance.merge_silver(spark, path, newer)
    after = {r.path for r in files(spark, path).select("path").collect()}
    assert {p for p in before ^ after if "symbol=click/dt=2024-01-03" not in p} == set()
    stored = spark.read.parquet(path)
    assert stored.count() == first.count()
    assert stored.where("price = 7.0").count() >= newer.count()


def test_compact_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "many")
    rows = samples.trades(spark, sf_dir)
    rows.repartition(12).write.parquet(path)
    assert maintenance.compact_files(spark, path, ["symbol", "trade_id"]) == 1
    assert files(spark, path).where("path LIKE '%.parquet'").count() == 1
    assert spark.read.parquet(path).count() == rows.count()


def test_compact_files_keeps_the_batch_level(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    rows = samples.trades(spark, sf_dir).withColumns(
        {"dt": F.to_date("trade_time"), "batch_id": F.pmod("trade_id", F.lit(3))}
    )
    tables.overwrite_partitions(rows, path, ["dt", "batch_id"])
    maintenance.compact_files(spark, f"{path}/dt=2024-01-03", ["symbol", "trade_id"])
    stored = spark.read.parquet(path)
    assertDataFrameEqual(stored.drop("batch_id"), rows.drop("batch_id"))
    day = stored.where("dt = DATE '2024-01-03'")
    assert [r.batch_id for r in day.select("batch_id").distinct().collect()] == [-1]


def test_expiry(spark, sf_dir, tmp_path):
    as_of = datetime(2024, 1, 20, 12, 0, 0, 500000, tzinfo=timezone.utc)
    rows = samples.trades(spark, sf_dir).withColumn("dt", F.to_date("trade_time"))
    kept = retention.unexpired(rows, as_of, date_column="dt")
    rule = "date_trunc('second', trade_time) + INTERVAL 7 DAYS > TIMESTAMP '2024-01-20 12:00:00.5'"
    assert kept.count() == rows.where(rule).count() > 0
    rows = rows.withColumn("batch_id", F.pmod("trade_id", F.lit(3)))
    for way in ("table", "folders"):
        path = str(tmp_path / way)
        tables.overwrite_partitions(rows, path, ["dt", "batch_id"])
        if way == "table":
            spark.sql("CREATE DATABASE IF NOT EXISTS expiry")
            spark.sql(f"CREATE TABLE expiry.trades USING parquet LOCATION '{path}'")
            spark.sql("MSCK REPAIR TABLE expiry.trades")
            dropped = maintenance.expire_partitions(spark, "expiry.trades", as_of)
            assert spark.sql("SHOW PARTITIONS expiry.trades").where("partition < 'dt=2024-01-13'").isEmpty()
        else:
            dropped = maintenance.expire_folders(spark, path, as_of)
        assert dropped[-1] == "2024-01-12"
        left = spark.read.parquet(path)
        assert left.count() == rows.where("dt >= DATE '2024-01-13'").count() < rows.count()
        assert retention.unexpired(left, as_of).count() == kept.count()
        assert files(spark, path).where("path LIKE '%dt=2024-01-0%'").isEmpty()


def test_a_rewrite_that_broke_off_is_put_back(spark, tmp_path):
    folder = str(tmp_path / "t" / "dt=2024-01-01")
    spark.range(3).write.parquet(folder)
    storage.rename(spark, folder, str(tmp_path / "t" / "_old-dt=2024-01-01"))
    maintenance.recover_folder(spark, folder)
    maintenance.recover_folder(spark, folder)
    assert spark.read.parquet(folder).count() == 3


def test_expiry_edge(spark):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00.999"), ("b", "2024-01-01 00:00:01")], "k string, t string")
    rows = rows.withColumn("trade_time", F.col("t").cast("timestamp"))
    at = datetime(2024, 1, 8, 0, 0, 0, tzinfo=timezone.utc)
    assert [r.k for r in rows.where(retention.alive(at)).collect()] == ["b"]


def test_commit_log_replay(spark, tmp_path):
    path = str(tmp_path / "commits")
    for snapshot, added in ((0, 5), (1, 7), (1, 7)):
        tables.record_commit(spark, path, snapshot, "append", added)
    history = audit.commit_history(spark.read.parquet(path)).collect()
    assert [(r.snapshot_id, r.operation, r.added) for r in history] == [(0, "append", "5"), (1, "append", "7")]


def test_added_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "evolving")
    spark.range(2).write.parquet(path)
    spark.range(2, 3).withColumn("fee", F.lit(0.1)).write.mode("append").parquet(path)
    rows = maintenance.read_evolving(spark, path)
    assert rows.columns == ["id", "fee"] and rows.where("fee IS NULL").count() == 2


def test_health_levels(spark, tmp_path):
    readers = {
        "full": lambda: spark.range(3),
        "empty": lambda: spark.range(0),
        "gone": lambda: spark.read.parquet(str(tmp_path / "nowhere")),
        "corrupt": lambda: spark.read.schema("id long").parquet(str(tmp_path / "corrupt")),
    }
    (tmp_path / "corrupt").mkdir()
    (tmp_path / "corrupt" / "part-0.parquet").write_bytes(b"no parquet at all")
    found = {r.table_name: r.status for r in audit.health(spark, readers).collect()}
    assert found == {"full": "pass", "empty": "warn", "gone": "fail", "corrupt": "fail"}


def test_quality(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, k string")
    assert [tuple(r) for r in quality.duplicates(rows, ["id"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.nulls(rows, ["id", "k"]).collect()] == [("k", 1)]
    parents = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in quality.orphans(rows, "id", parents, "id").collect()] == [(1, 2)]


def test_messages_to_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "topic")
    messages = normalize.to_messages(samples.bronze(spark, sf_dir))
    publish.to_files(messages, path)
    assertDataFrameEqual(spark.read.schema("key string, value string").json(path), messages)


@pytest.fixture()
def derby(spark):
    return {"url": "jdbc:derby:memory:hot;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc_append_is_at_least_once(spark, sf_dir, derby):
    """Uses the in-process database that ships with Spark: no server, no port."""
    hot = normalize.to_hot(samples.bronze(spark, sf_dir))
    rows = publish.jdbc_row(hot).drop("is_buyer_maker", "ingested_at", "event_time")
    for _ in range(2):
        publish.to_jdbc(rows, table="trades", **derby)
    back = jdbc.read(spark, table="trades", column="TRADE_ID", lower=0, upper=1000, partitions=4, **derby)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 2 * rows.count()
    unique = dedup.latest(back.toDF(*[c.lower() for c in back.columns]))
    assert unique.count() == samples.trades(spark, sf_dir).count()
