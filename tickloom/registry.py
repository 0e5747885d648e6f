"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import numbers, text
from tickloom.operators import (
    audit,
    compare,
    dedup,
    evolve,
    intervals,
    latest,
    normalize,
    ohlcv,
    quality,
    retention,
    snapshots,
)
from tickloom.operators.throttle import throttle
from tickloom.plans import layers, maintenance, serving
from tickloom.schema import BRONZE, SILVER_COLUMNS, TRADE, record
from tickloom.session import pin, scratch
from tickloom.sinks import storage, tables, tiers
from tickloom.sources import log, samples
from tickloom.streaming import jobs, position

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def query(function: Query) -> Query:
    """Register under the function's name; timestamps leave without a zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(pin(spark), sf_dir)
        zoned = [f.name for f in result.schema.fields if f.dataType.simpleString() == "timestamp"]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[function.__name__] = run
    return function


def as_of(spark: SparkSession, sf_dir: str) -> datetime:
    """The instant that stands for "now": the largest trade time, one value."""
    times = samples.trades(spark, sf_dir).agg(F.max(F.unix_micros("trade_time")).alias("us"))
    return _EPOCH + timedelta(microseconds=times.first()["us"])


def minute_states(
    spark: SparkSession, sf_dir: str, after: datetime | None = None
) -> DataFrame:
    """State rows as separate blocks leave them: one set per log partition."""
    return ohlcv.partial(samples.trades(spark, sf_dir, after), extra=["kafka_partition"])


def price_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.partial(samples.trades(spark, sf_dir), extra=["kafka_partition"])


# --- Bronze audits


@query
def bronze_count(spark, sf_dir):
    return audit.row_count(samples.bronze(spark, sf_dir))


@query
def bronze_profile(spark, sf_dir):
    return audit.profile(samples.bronze(spark, sf_dir))


@query
def bronze_symbol_counts(spark, sf_dir):
    return samples.bronze(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))


@query
def layer_reconcile(spark, sf_dir):
    return audit.reconcile(samples.bronze(spark, sf_dir))


@query
def layer_diff(spark, sf_dir):
    """Silver as it should be against one in which a price was changed, a trade lost and one added."""
    right = layers.silver(samples.bronze(spark, sf_dir))
    price = F.when(F.col("trade_id") == 123, F.col("price") + 1).otherwise(F.col("price"))
    lost = right.withColumn("price", price).where("trade_id <> 456")
    wrong = lost.unionByName(right.where("trade_id = 789").withColumn("trade_id", F.lit(-789).cast("bigint")))
    day = F.to_date("trade_time")
    sides = [rows.withColumn("dt", day) for rows in (right, wrong)]
    return compare.differences(*sides, ["symbol", "dt"], ["trade_id"], [c for c in right.columns if c not in ("symbol", "trade_id")])


@query
def offset_coverage(spark, sf_dir):
    return audit.offset_coverage(samples.bronze(spark, sf_dir))


@query
def offset_gaps(spark, sf_dir):
    return audit.offset_gaps(samples.bronze(spark, sf_dir))


@query
def table_health(spark, sf_dir):
    readers = {
        name: (lambda n=name: samples.table(spark, sf_dir, n))
        for name in ("events", "lineitem", "part", "no_such_table")
    }
    return audit.health(spark, readers)


# --- Silver, staging, Gold


@query
def silver_trades(spark, sf_dir):
    return layers.silver(samples.bronze(spark, sf_dir))


@query
def stg_trades(spark, sf_dir):
    return layers.staging(layers.silver(samples.bronze(spark, sf_dir)))


@query
def fact_trades_1h(spark, sf_dir):
    return layers.fact_trades_1h(stg_trades(spark, sf_dir))


@query
def first_trade_per_hour(spark, sf_dir):
    return ohlcv.edge_trade(samples.trades(spark, sf_dir)).select(
        "symbol", "bucket", "trade_id", "trade_time", "price"
    )


@query
def last_trade_per_hour(spark, sf_dir):
    return ohlcv.edge_trade(samples.trades(spark, sf_dir), last=True).select(
        "symbol", "bucket", "trade_id", "trade_time", "price"
    )


def _line_trades(spark, sf_dir):
    """Repeated ids with equal times: every column takes part in the tie-break."""
    order = [*dedup.newest_first(), F.col("qty").desc(), F.col("price").desc()]
    return dedup.latest(samples.lineitem_trades(spark, sf_dir), order=order)


@query
def silver_ties(spark, sf_dir):
    return _line_trades(spark, sf_dir)


@query
def ohlcv_1d_ties(spark, sf_dir):
    return ohlcv.rollup(
        _line_trades(spark, sf_dir), "day", "bucket_day", qty="qty", quote="quote_qty"
    )


# --- States and serving


@query
def ohlcv_1m(spark, sf_dir):
    return ohlcv.bars(minute_states(spark, sf_dir))


@query
def ohlcv_1h_from_states(spark, sf_dir):
    return ohlcv.bars(minute_states(spark, sf_dir), unit="hour")


@query
def compacted_states(spark, sf_dir):
    """The state rows that compaction leaves: one per symbol and minute."""
    merged = ohlcv.merge_states(minute_states(spark, sf_dir))
    return merged.select(
        "symbol",
        "bucket_ts",
        "open_price",
        F.col("open_key.trade_time").alias("open_time"),
        F.col("open_key.trade_id").alias("open_id"),
        "close_price",
        F.col("close_key.trade_time").alias("close_time"),
        F.col("close_key.trade_id").alias("close_id"),
        "high",
        "low",
        *(F.col(c).cast("double").alias(c) for c in ("volume", "quote_volume")),
        "trade_count",
    )


@query
def merged_prices(spark, sf_dir):
    """Price states of separate blocks merged into the one row per symbol that is kept."""
    merged = latest.merge_states(price_states(spark, sf_dir))
    key = F.col("price_key")
    return merged.select(
        "symbol", "price", key["trade_time"].alias("at"), key["trade_id"].alias("trade_id"), "updated"
    )


@query
def latest_price(spark, sf_dir):
    return serving.latest_price(price_states(spark, sf_dir))


@query
def panel_latest_price(spark, sf_dir):
    return serving.panel_latest_price(price_states(spark, sf_dir))


@query
def last_not_null_price(spark, sf_dir):
    return latest.last_not_null(samples.trades(spark, sf_dir), "price", "trade_id", ["symbol"])


def _recent_states(panel, minutes):
    def run(spark, sf_dir):
        now = as_of(spark, sf_dir)
        states = minute_states(spark, sf_dir, after=now - timedelta(minutes=minutes))
        return panel(states, now, minutes)

    return run


def _recent_count(panel, minutes):
    def run(spark, sf_dir):
        now = as_of(spark, sf_dir)
        hot = samples.redeliver(samples.trades(spark, sf_dir, now - timedelta(minutes=minutes)))
        return panel(hot, now, minutes)

    return run


for _name, _make, _panel, _minutes in (
    ("ohlcv_1m_last30", _recent_states, serving.ohlcv_recent, 30),
    ("ohlcv_1m_last24h", _recent_states, serving.ohlcv_recent, 1440),
    ("panel_close_1m", _recent_states, serving.panel_close, 30),
    ("panel_close_1m_24h", _recent_states, serving.panel_close, 1440),
    ("panel_volume_1m", _recent_states, serving.panel_volume, 30),
    ("panel_volume_1m_24h", _recent_states, serving.panel_volume, 1440),
    ("panel_trade_count_15m", _recent_count, serving.panel_trade_count, 15),
    ("panel_trade_count_24h", _recent_count, serving.panel_trade_count, 1440),
):
    _run = _make(_panel, _minutes)
    _run.__name__ = _name
    query(_run)


@query
def hot_retention_7d(spark, sf_dir):
    now = as_of(spark, sf_dir)
    rows = samples.trades(spark, sf_dir, after=now - timedelta(days=7))
    return retention.unexpired(rows.select("symbol", "trade_id", "trade_time"), now)


@query
def throttle_5s(spark, sf_dir):
    rows = samples.trades(spark, sf_dir).select("symbol", "trade_id", "trade_time", "price")
    return throttle(rows, timedelta(seconds=5))


@query
def throttle_5m(spark, sf_dir):
    rows = samples.trades(spark, sf_dir).select("symbol", "trade_id", "trade_time", "price")
    return throttle(rows, timedelta(minutes=5))


@query
def throttle_us(spark, sf_dir):
    """A limit of some microseconds over trades whose times were spread within their millisecond."""
    rows = samples.trades(spark, sf_dir).select("symbol", "trade_id", "price", "trade_time")
    spread = F.make_dt_interval(secs=(F.pmod(F.col("trade_id") * 7919, F.lit(250))).cast("decimal(18,6)") / 1_000_000)
    return throttle(rows.withColumn("trade_time", F.date_trunc("hour", "trade_time") + spread), timedelta(microseconds=17))


@query
def throttle_1d(spark, sf_dir):
    rows = samples.trades(spark, sf_dir).select("symbol", "trade_id", "trade_time", "price")
    return throttle(rows, timedelta(days=1))


# --- Messages


@query
def trades_of_symbols(spark, sf_dir):
    wanted = text.wanted_symbols(" click, Purchase ,,", stored=str.lower)
    rows = samples.trades(spark, sf_dir).where(wanted)
    return rows.select(F.upper("symbol").alias("symbol"), "trade_id", "price")


@query
def decoded_log(spark, sf_dir):
    return layers.bronze(samples.log_records(samples.bronze(spark, sf_dir)))


@query
def wide_amounts(spark, sf_dir):
    """Quantities about the largest that are taken: what the decoder lets through and the sum of exactly that."""
    decoded = normalize.decode_log(samples.log_records(samples.wide_amounts(samples.bronze(spark, sf_dir))))
    total = numbers.exact_sum(F.when(F.col("bad_fields").isNull(), F.col("qty")))
    return decoded.groupBy("symbol", F.coalesce("bad_fields", F.lit("usable")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"), total.cast("string").alias("volume"), numbers.exact_sum("qty").cast("string").alias("all")
    )


@query
def hot_rows(spark, sf_dir):
    return normalize.to_hot(layers.bronze(samples.log_records(samples.bronze(spark, sf_dir))))


@query
def feed_trades(spark, sf_dir):
    decoded = normalize.decode_feed(samples.feed_lines(spark, sf_dir))
    stamped = F.try_to_timestamp("ingested_at").isNotNull()
    return normalize.valid(decoded).withColumn("ingested_at", stamped).withColumnRenamed("ingested_at", "stamped")


@query
def feed_quarantine(spark, sf_dir):
    decoded = normalize.decode_feed(samples.feed_lines(spark, sf_dir))
    return (
        normalize.malformed(decoded)
        .groupBy("bad_fields", "preview", "raw")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def feed_counters(spark, sf_dir):
    decoded = normalize.decode_feed(samples.feed_lines(spark, sf_dir))
    return decoded.agg(*normalize.counters(decoded))


@query
def published_messages(spark, sf_dir):
    """What is published, read back from the JSON text."""
    messages = normalize.to_messages(samples.bronze(spark, sf_dir))
    return messages.select("key", F.inline(F.array(F.from_json("value", TRADE))))


# --- Landed snapshots


@query
def klines_1h(spark, sf_dir):
    rows = snapshots.klines(samples.kline_bodies(spark, sf_dir))
    return snapshots.latest_klines(rows)


@query
def klines_quarantine(spark, sf_dir):
    """Answers and candles that cannot be used, among good ones; and how many of each went in."""
    decoded = snapshots.decode_klines(samples.kline_bodies_with_bad(spark, sf_dir))
    usable = F.coalesce("bad_fields", F.lit("usable"))
    return decoded.groupBy("symbol", usable.alias("verdict"), F.when(usable != "usable", F.col("raw")).alias("raw")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def klines_written(spark, sf_dir):
    """Candles written by symbol and day, twice, and read back."""
    path = scratch(spark, "klines")
    for _ in range(2):
        rows = snapshots.klines(samples.kline_bodies(spark, sf_dir))
        tables.overwrite_partitions(rows, path, ["symbol", "dt"])
    return snapshots.latest_klines(spark.read.parquet(path)).select(*rows.columns)


@query
def market_quarantine(spark, sf_dir):
    decoded = snapshots.decode_coins(samples.coin_objects_with_bad(spark, sf_dir))
    usable = F.coalesce("bad_fields", F.lit("usable"))
    return decoded.groupBy("snapshot_ts", usable.alias("verdict"), F.when(usable != "usable", F.col("raw")).alias("raw")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def market_written(spark, sf_dir):
    """Two snapshots of one hour, written twice each: both are kept, and each has its own top."""
    path, top = scratch(spark, "market"), None
    first = snapshots.coins(samples.coin_objects(spark, sf_dir))
    second = first.withColumns(
        {"snapshot_ts": F.col("snapshot_ts") + F.expr("INTERVAL 15 MINUTE"), "market_cap": -F.col("market_cap")}
    )
    for rows in (first, second, second, first):
        tables.overwrite_partitions(
            snapshots.with_partitions(rows).withColumn("snapshot", F.date_format("snapshot_ts", "yyyyMMdd'T'HHmmss")),
            path,
            ["dt", "hour", "snapshot"],
        )
    top = snapshots.market_top(spark.read.parquet(path), 3)
    return top.select("snapshot_ts", "id", "market_cap", F.col("hour").cast("int").alias("hour"), "rank")


@query
def market_topk(spark, sf_dir):
    rows = snapshots.with_partitions(snapshots.coins(samples.coin_objects(spark, sf_dir)))
    return snapshots.market_top(rows)


# --- Tables and streams; each run writes below its own fresh scratch folder


def _database(spark):
    return f"tickloom_{scratch(spark, 'db')[-12:]}_"


@query
def ensured_bronze(spark, sf_dir):
    """Created when missing, found on the second call, then filled."""
    root, name = scratch(spark, "tables"), f"{_database(spark)}bronze.trades"
    for _ in range(2):
        tables.ensure(spark, name, BRONZE, root, ["symbol"])
    tables.append(spark, name, samples.bronze(spark, sf_dir))
    return audit.profile(spark.table(name))


@query
def listed_schemas(spark, sf_dir):
    """The schemas of a refresh, from the list of all."""
    root, prefix = scratch(spark, "tables"), _database(spark)
    tables.replace(spark, f"{prefix}bronze.trades", samples.bronze(spark, sf_dir), root, ["symbol"])
    layers.refresh(spark, root, prefix)
    ours = tables.databases(spark).where(F.col("namespace").startswith(prefix))
    rows = spark.table(f"{prefix}gold.fact_trades_1h").count()
    return ours.select(F.substring("namespace", len(prefix) + 1, 100).alias("schema"), F.lit(rows).cast("bigint").alias("gold_rows"))


@query
def refreshed_gold(spark, sf_dir):
    """Bronze, Silver and Gold as catalog tables with the staging view between."""
    root, prefix = scratch(spark, "tables"), _database(spark)
    tables.replace(spark, f"{prefix}bronze.trades", samples.bronze(spark, sf_dir), root, ["symbol"])
    return spark.table(layers.refresh(spark, root, prefix)["gold"])


# Streams: the log lands in PARTS deliveries, each run stops when it has read what is there, and
# the next one goes on from the checkpoint. Copies and late records come in later deliveries than
# the trades around them.

PARTS = 3


def _run_log(spark, sf_dir, start):
    """Deliver the log part by part; ``start(records)`` gives the streaming queries to run after each."""
    rows = samples.log_records_with_bad(samples.bronze(spark, sf_dir))
    number = F.split("key", ":")[1].cast("bigint")
    copy = F.col("offset") >= 1_000_000_000
    part = F.when(copy, F.pmod(F.expr("split(key, ':')[1] div 10"), F.lit(PARTS)))
    part = part.when(number % 7 == 0, PARTS - 1).otherwise(F.pmod(number, F.lit(PARTS - 1)))
    _deliver(spark, rows, F.coalesce(part, F.lit(0)), start)


def _deliver(spark, rows, part, start):
    topic, read = scratch(spark, "topic"), "delivery"
    # One pass makes all parts; a delivery comes when its folder gets the name that the stream reads.
    rows.withColumn("part", part.cast("int")).write.partitionBy("part").json(topic)
    for k in range(PARTS):
        if storage.exists(spark, f"{topic}/part={k}"):
            storage.rename(spark, f"{topic}/part={k}", f"{topic}/{read}{k}")
        else:
            rows.limit(0).write.json(f"{topic}/{read}{k}")
        for running in start(log.file_log(spark, f"{topic}/{read}*")):
            running.awaitTermination()


def _landed(spark, sf_dir):
    path = scratch(spark, "bronze")

    def start(records):
        return [
            jobs.land_bronze(
                jobs.decoded(records), path, f"{path}-bad", f"{path}-commits", f"{path}-checkpoint", interval=None
            )
        ]

    _run_log(spark, sf_dir, start)
    return path


def _hot(spark, sf_dir):
    into, start = _hot_tables(spark)
    _run_log(spark, sf_dir, start)
    return into


def _hot_tables(spark):
    into = jobs.HotTables.under(scratch(spark, "hot"))

    def start(records):
        bronze = normalize.valid(jobs.decoded(records))
        return [jobs.hot_path(bronze, into, f"{into.raw}-checkpoint", interval=None)]

    return into, start


@query
def bucketed_silver(spark, sf_dir):
    """Keep-latest over Bronze in 16 buckets by symbol."""
    root, name = scratch(spark, "tables"), f"{_database(spark)}bucketed.trades"
    order = ["symbol", "trade_id"]
    tables.write_bucketed(samples.bronze(spark, sf_dir), name, root, "symbol", sort_by=order)
    return layers.silver(spark.table(name))


@query
def published_stream(spark, sf_dir):
    """Messages written by the streaming publisher, decoded again."""
    path = scratch(spark, "published")

    def start(records):
        bronze = normalize.valid(jobs.decoded(records))
        return [jobs.publish_messages(bronze, path, f"{path}-checkpoint", interval=None)]

    _run_log(spark, sf_dir, start)
    messages = spark.read.schema("key string, value string").json(path)
    return messages.select("key", F.inline(F.array(F.from_json("value", TRADE))))


def _merged_silver(spark, rows, again):
    path = scratch(spark, "silver")
    first = layers.silver(rows, positions=True)
    tables.write(first.withColumn("dt", F.to_date("trade_time")), path, ["symbol", "dt"])
    maintenance.merge_silver(spark, path, again)
    return spark.read.parquet(path).select(*SILVER_COLUMNS)


@query
def silver_incremental(spark, sf_dir):
    """Silver built from first deliveries, then merged with the redelivered rows."""
    again = samples.bronze(spark, sf_dir).where("kafka_offset >= 1000000000")
    return _merged_silver(spark, samples.as_bronze(samples.trades(spark, sf_dir)), again)


@query
def silver_incremental_ties(spark, sf_dir):
    """Copies with the log time of the first delivery; the version with the older offset comes last."""
    rows = samples.same_time_copies(samples.bronze(spark, sf_dir))
    newer = F.col("kafka_offset") >= 1_000_000_000
    return _merged_silver(spark, rows.where(newer), rows.where(~newer))


@query
def stream_bronze(spark, sf_dir):
    return spark.read.parquet(_landed(spark, sf_dir)).select(*BRONZE.fieldNames())


@query
def compacted_bronze(spark, sf_dir):
    """Bronze as the stream landed it, its files merged, read afresh."""
    path = _landed(spark, sf_dir)
    for symbol in storage.values(spark, path, "symbol"):
        maintenance.compact_files(spark, f"{path}/symbol={symbol}", ["trade_id"])
    return spark.read.parquet(path).select(*BRONZE.fieldNames())


@query
def tiered_bronze(spark, sf_dir):
    """Bronze by day alone, its folders merged while the log is read; two folders make a full tier here."""
    return tiers.read(spark, _tiered(spark, sf_dir)).select(*BRONZE.fieldNames())


def _tiered(spark, sf_dir):
    path = scratch(spark, "tiers")

    def start(records):
        rows, beside = jobs.decoded(records), (f"{path}-bad", f"{path}-commits", f"{path}-checkpoint")
        return [jobs.land_bronze_tiered(rows, path, *beside, interval=None, fan=2)]

    _run_log(spark, sf_dir, start)
    return path


@query
def offset_intervals(spark, sf_dir):
    """The gaps of the log, from the ranges kept beside Bronze; no record is read."""
    return intervals.gaps(jobs.landed_offsets(spark, _tiered(spark, sf_dir)))


@query
def log_after_retention(spark, sf_dir):
    """The log by rising offsets; the first delivery is read, the second expires with it before the stream comes
    back. Told to stop at a loss it stops and lands nothing; told to record it, it lands the third delivery."""
    topic, path = scratch(spark, "topic"), scratch(spark, "bronze")
    rows = samples.log_records(samples.as_bronze(samples.trades(spark, sf_dir)))
    width = rows.agg(F.max("offset").alias("m")).first()["m"] // PARTS + 1

    def deliver(k):
        rows.where(F.expr(f"`offset` div {width}L") == k).write.json(f"{topic}/delivery{k}")

    def land(on_loss):
        decoded = jobs.decoded(log.file_log(spark, f"{topic}/*"))
        beside = (f"{path}-bad", f"{path}-commits", f"{path}-checkpoint")
        jobs.land_bronze(decoded, path, *beside, interval=None, on_loss=on_loss).awaitTermination()

    deliver(0)
    land(position.FAIL)
    deliver(1)
    for k in (0, 1):
        storage.delete(spark, f"{topic}/delivery{k}")
    deliver(2)
    stopped = None
    try:
        land(position.FAIL)
    except StreamingQueryException:
        stopped = spark.read.parquet(path).count()
    land(position.RECORD)
    landed = spark.read.parquet(path).groupBy("kafka_partition").agg(F.count(F.lit(1)).alias("landed"))
    return (
        landed.join(position.recorded(spark, path), "kafka_partition")
        .drop("batch_id")
        .withColumn("landed_at_stop", F.lit(stopped).cast("bigint"))
    )


@query
def evolved_bronze(spark, sf_dir):
    """A log whose records gain three members with the second delivery. Two are declared before the third; their
    columns are there for the second, too. One fee in 50 is a word."""
    path = scratch(spark, "bronze")
    records = samples.gaining_members(samples.log_records(samples.as_bronze(samples.trades(spark, sf_dir))), PARTS)
    added = [record(""), record(""), _ADDED]

    def start(stream):
        rows, beside = jobs.decoded(stream, added.pop(0)), (f"{path}-bad", f"{path}-commits", f"{path}-checkpoint")
        return [jobs.land_bronze(rows, path, *beside, interval=None)]

    _deliver(spark, records, F.pmod(F.split("key", ":")[1].cast("bigint"), F.lit(PARTS)), start)
    found = evolve.read(spark, path, BRONZE, _ADDED)
    members = F.map_entries(evolve.RESCUED)
    rest = F.array_join(F.transform(F.array_sort(members), lambda m: F.concat_ws("=", m["key"], m["value"])), ",")
    return found.withColumn(evolve.RESCUED, rest)


#: The change that is declared between the second and the third delivery.
_ADDED = record("venue string, fee double")


@query
def log_quarantine(spark, sf_dir):
    """What the stream set aside, by its text."""
    rows = spark.read.parquet(f"{_landed(spark, sf_dir)}-bad")
    return rows.groupBy("bad_fields", "raw").agg(F.count(F.lit(1)).alias("n"))


@query
def commit_history(spark, sf_dir):
    """One commit per delivery, in order."""
    history = audit.commit_history(spark.read.parquet(f"{_landed(spark, sf_dir)}-commits"))
    return history.select("snapshot_id", "operation", "added")


@query
def committed_rows(spark, sf_dir):
    history = commit_history(spark, sf_dir)
    return history.agg(F.sum(F.col("added").cast("bigint")).alias("added"))


@query
def bronze_partitions(spark, sf_dir):
    """Folders after compaction: one file in each of a table of this size."""
    path = _landed(spark, sf_dir)
    for symbol in storage.values(spark, path, "symbol"):
        maintenance.compact_files(spark, f"{path}/symbol={symbol}", ["trade_id"])
    return tables.partition_layout(spark.read.parquet(path), ["symbol", "dt"])


@query
def two_consumers(spark, sf_dir):
    """Bronze and the hot path read one log side by side, each with its own checkpoint."""
    path, into = scratch(spark, "bronze"), jobs.HotTables.under(scratch(spark, "hot"))

    def start(records):
        decoded = jobs.decoded(records)
        cold = jobs.land_bronze(decoded, path, f"{path}-bad", f"{path}-commits", f"{path}-checkpoint", interval=None)
        return [cold, jobs.hot_path(normalize.valid(decoded), into, f"{into.raw}-checkpoint", interval=None)]

    _run_log(spark, sf_dir, start)
    cold = audit.reconcile(spark.read.parquet(path)).drop("removed")
    hot = jobs.raw_trades(spark, into).groupBy("symbol").agg(F.count(F.lit(1)).alias("hot_rows"))
    return cold.join(hot, "symbol")


@query
def stream_hot_rows(spark, sf_dir):
    """The raw trades of the hot path: each once."""
    columns = ["trade_id", "symbol", "price", "qty", "quote_qty", "trade_time", "event_time", "is_buyer_maker"]
    return jobs.raw_trades(spark, _hot(spark, sf_dir)).select(*columns)


@query
def stream_old_copies(spark, sf_dir):
    """Trades of two years ago among those of today, and their copies in the last delivery: each once."""
    into, start = _hot_tables(spark)
    rows = samples.log_records(samples.old_and_again(samples.bronze(spark, sf_dir)))
    number = F.split("key", ":")[1].cast("bigint")
    part = F.when(F.col("offset") >= 3_000_000_000, PARTS - 1).otherwise(F.pmod(number, F.lit(PARTS - 1)))
    _deliver(spark, rows, part, start)
    return jobs.raw_trades(spark, into).select("symbol", "trade_id", "price", "qty", "trade_time")


@query
def compacted_hot(spark, sf_dir):
    """The minute states as they lie in the table after three deliveries and a rewrite of every day."""
    into = _hot(spark, sf_dir)
    jobs.compact_hot(spark, into)
    stored = tiers.read(spark, into.minute)
    names = ["symbol", "bucket_ts", "open_price", "close_price", "high", "low", "trade_count"]
    return stored.select(*names, *(F.col(c).cast("double").alias(c) for c in ("volume", "quote_volume")))


@query
def stream_ohlcv_1m(spark, sf_dir):
    return ohlcv.bars(jobs.minute_states(spark, _hot(spark, sf_dir)))


@query
def stream_price_updates(spark, sf_dir):
    """Running prices out of Spark's state, through a stop and a restart after every delivery."""
    path = scratch(spark, "prices")

    def start(records):
        trades = normalize.to_hot(normalize.valid(jobs.decoded(records)))
        return [jobs.price_updates(trades, path, f"{path}-checkpoint", interval=None)]

    _run_log(spark, sf_dir, start)
    return tables.upserted(spark, path)


@query
def stream_latest_price(spark, sf_dir):
    return serving.latest_price(jobs.price_states(spark, _hot(spark, sf_dir)))


@query
def expired_hot(spark, sf_dir):
    """Raw trades of the hot path after expiry, counted by day from the files that are left."""
    into = _hot(spark, sf_dir)
    now = as_of(spark, sf_dir)
    maintenance.expire_folders(spark, into.raw, now)
    left = jobs.raw_trades(spark, into)
    return left.groupBy("dt").agg(F.count(F.lit(1)).alias("trades"))


@query
def expired_rows(spark, sf_dir):
    """Raw trades that are left after expiry to the row; the minute states, too, are read from what is left."""
    into, now = _hot(spark, sf_dir), as_of(spark, sf_dir)
    jobs.expire_hot(spark, into, now)
    left = jobs.raw_trades(spark, into).select("symbol", "trade_id", "trade_time")
    minutes = jobs.minute_states(spark, into).agg(F.min("bucket_ts").alias("first"), F.sum("trade_count").alias("n")).first()
    first = F.lit(minutes["first"]).cast("timestamp")
    return left.withColumns({"in_minutes": F.lit(minutes["n"]).cast("bigint"), "first_minute": first})


def _run_trades(spark, sf_dir, start):
    """The trades in PARTS blocks of rising ids."""
    path = scratch(spark, "trades")
    rows = samples.trades(spark, sf_dir)
    width = F.lit(rows.agg(F.max("trade_id").alias("m")).first()["m"] // PARTS + 1)
    for k in range(PARTS):
        rows.where((F.col("trade_id") / width).cast("bigint") == k).write.mode("append").parquet(path)
        start(spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


@query
def stream_windowed_bars(spark, sf_dir):
    path = scratch(spark, "windows")
    _run_trades(spark, sf_dir, lambda rows: jobs.windowed_bars(rows, path, f"{path}-checkpoint", interval=None))
    return ohlcv.bars(jobs.window_states(spark, path))


@query
def stream_throttle_5m(spark, sf_dir):
    path = scratch(spark, "throttled")

    def start(trades):
        rows = trades.select("symbol", "trade_id", "trade_time", "price")
        return jobs.throttled(rows, timedelta(minutes=5), path, f"{path}-checkpoint", interval=None)

    _run_trades(spark, sf_dir, start)
    return spark.read.parquet(path).drop("batch_id")


@query
def throttle_counters(spark, sf_dir):
    """Received, sent and throttled trades per symbol, summed over the batches of the stream."""
    path = scratch(spark, "throttled")

    def start(trades):
        rows = trades.select("symbol", "trade_id", "trade_time", "price")
        return jobs.throttled(rows, timedelta(minutes=5), path, f"{path}-checkpoint", interval=None)

    _run_trades(spark, sf_dir, start)
    counted = spark.read.parquet(f"{path}-throttled").groupBy("symbol")
    return counted.agg(*(F.sum(c).alias(c) for c in ("received", "sent", "throttled")))


@query
def stream_dedup(spark, sf_dir):
    """Which trades pass, in full but for the log position, which is that of whichever copy came first."""
    path = scratch(spark, "dedup")

    def start(records):
        rows = dedup.first_seen(normalize.valid(jobs.decoded(records)), "10 minutes")
        writer = rows.drop("kafka_offset", "kafka_timestamp").writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", path).option("checkpointLocation", f"{path}-checkpoint")
        return [writer.trigger(availableNow=True).start()]

    _run_log(spark, sf_dir, start)
    return spark.read.parquet(path)


# --- Data tests


@query
def unique_bronze(spark, sf_dir):
    return quality.duplicates(samples.bronze(spark, sf_dir), ["symbol", "trade_id"])


@query
def unique_gold(spark, sf_dir):
    return quality.duplicates(fact_trades_1h(spark, sf_dir), ["symbol", "bucket_hour"])


@query
def not_null_gold(spark, sf_dir):
    return quality.nulls(fact_trades_1h(spark, sf_dir), ["symbol", "bucket_hour"])


@query
def relationship_orders(spark, sf_dir):
    orders = samples.table(spark, sf_dir, "orders")
    return quality.orphans(
        samples.table(spark, sf_dir, "lineitem"), "l_orderkey", orders, "o_orderkey"
    )


@query
def relationship_lines(spark, sf_dir):
    lines = samples.table(spark, sf_dir, "lineitem")
    return quality.orphans(
        samples.table(spark, sf_dir, "orders"), "o_orderkey", lines, "l_orderkey"
    )
