"""The streaming queries: Bronze append and the hot path with its states.

Both start from decoded trades, have their own checkpoint, and run with a fixed
interval in production or ``availableNow`` for backfills and tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

from tickloom.operators import dedup, intervals, latest, membership, normalize, ohlcv
from tickloom.operators.retention import oldest_date, unexpired
from tickloom.operators.throttle import throttle
from tickloom.sinks import publish, storage, tables, tiers
from tickloom.streaming import position

COLD_INTERVAL = "30 seconds"
HOT_INTERVAL = "10 seconds"
_BRONZE_ORDER = ["symbol", "trade_id"]


def _trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def decoded(records: DataFrame, added: StructType | None = None) -> DataFrame:
    """Log records decoded, with the running totals observed as ``ingest``; ``added`` as in ``decode_log``."""
    rows = normalize.decode_log(records, added)
    return rows.observe("ingest", *normalize.counters(rows))


def land_bronze(
    decoded_rows: DataFrame,
    path: str,
    quarantine: str,
    commits: str,
    checkpoint: str,
    interval: str | None = COLD_INTERVAL,
    on_loss: str | None = None,
) -> StreamingQuery:
    """Every record of the log lands once: usable ones in Bronze, the others in the quarantine.

    Both are written in the same batch, then one row of the commit log says how many rows Bronze got.
    A batch owns the folders that carry its id, so a replay rewrites them, and folders that are
    closed may be compacted. ``on_loss`` says what happens when the log no longer has records that were
    still to be read (``position``); without it, the source goes on as it is set to.
    """

    def store(good: DataFrame, batch_id: int) -> None:
        placed = good.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        tables.overwrite_partitions(placed, path, ["symbol", "dt", "batch_id"])

    return _land(decoded_rows, store, quarantine, commits, checkpoint, interval, path, on_loss)


def land_bronze_tiered(
    decoded_rows: DataFrame,
    path: str,
    quarantine: str,
    commits: str,
    checkpoint: str,
    interval: str | None = COLD_INTERVAL,
    fan: int = tiers.FAN,
    on_loss: str | None = None,
) -> StreamingQuery:
    """The same for very many symbols and batches: Bronze lies by day alone, its files sorted by symbol, and
    the folders of a day are merged as the stream runs. Read it with ``tiers.read``. Beside it,
    ``-offsets`` keeps the offsets that came, as ranges by the same days, merged in the same way."""

    def store(good: DataFrame, batch_id: int) -> None:
        days = [str(r.dt) for r in good.select("dt").distinct().collect()]
        tiers.append(good, path, batch_id, days, _BRONZE_ORDER)
        tiers.append(intervals.of(good, "dt"), f"{path}-offsets", batch_id, days)
        spark, offsets = good.sparkSession, f"{path}-offsets"
        merges = [partial(tiers.merge, spark, path, day, batch_id, None, _BRONZE_ORDER, fan) for day in days]
        merges += [partial(tiers.merge, spark, offsets, day, batch_id, intervals.merged, (), fan) for day in days]
        storage.together(merges)

    return _land(decoded_rows, store, quarantine, commits, checkpoint, interval, path, on_loss)


def landed_offsets(spark: SparkSession, path: str) -> DataFrame:
    """The offsets of all days that ``land_bronze_tiered`` landed at ``path``, as ranges."""
    return intervals.merged(tiers.read(spark, f"{path}-offsets").select(*intervals.COLUMNS))


def _land(
    decoded_rows: DataFrame,
    store: Callable[[DataFrame, int], None],
    quarantine: str,
    commits: str,
    checkpoint: str,
    interval: str | None,
    path: str,
    on_loss: str | None,
) -> StreamingQuery:
    if on_loss not in (None, position.FAIL, position.RECORD):
        raise ValueError(f"on_loss is {position.FAIL} or {position.RECORD}, not {on_loss}")

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            if on_loss:
                position.check(rows, path, batch_id, on_loss)
            good = normalize.valid(rows).withColumn("dt", F.to_date("kafka_timestamp"))
            store(good, batch_id)
            added = good.count()
            bad = normalize.malformed(rows).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            tables.overwrite_partitions(bad, quarantine, ["batch_id"])
            if on_loss:
                position.advance(rows, path, batch_id)
        finally:
            rows.unpersist()
        tables.record_commit(batch.sparkSession, commits, batch_id, "append", added)

    return _start(decoded_rows, commit, checkpoint, interval)


def publish_messages(
    trades: DataFrame, path: str, checkpoint: str, interval: str | None = HOT_INTERVAL
) -> StreamingQuery:
    """Normalised trades as keyed messages into a folder of JSON lines."""
    writer = (
        normalize.to_messages(trades)
        .writeStream.format("json")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()


def publish_kafka(
    trades: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    interval: str | None = HOT_INTERVAL,
) -> StreamingQuery:
    """The same messages to a topic; needs the connector (untested here)."""
    writer = (
        normalize.to_messages(trades)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**publish.PRODUCER)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()


@dataclass(frozen=True)
class HotTables:
    """Folders the hot path writes: raw trades, filters of their keys, one-minute states, latest prices."""

    raw: str
    seen: str
    minute: str
    latest: str

    @classmethod
    def under(cls, root: str) -> HotTables:
        return cls(f"{root}/trades", f"{root}/trades_seen", f"{root}/trades_1m", f"{root}/price_latest")


def hot_path(
    bronze: DataFrame,
    into: HotTables,
    checkpoint: str,
    interval: str | None = HOT_INTERVAL,
    jdbc: dict[str, str] | None = None,
) -> StreamingQuery:
    """Raw trades and merged states per micro-batch; data and copies of any age are accepted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_hot_batch(batch, batch_id, into, jdbc)

    return _start(normalize.to_hot(bronze), write, checkpoint, interval)


def write_hot_batch(
    batch: DataFrame, batch_id: int, into: HotTables, jdbc: dict[str, str] | None = None
) -> None:
    """All writes of one micro-batch, each into folders named by the batch id.

    A trade counts once: copies inside the batch, and of trades that earlier batches stored, are left
    out, whatever their age and however fast the stream runs; see ``stored_copies``. The keys of a batch are in
    the filters before its rows are in the raw table, so no stored trade is ever unknown to them. Minute states
    are those of the batch alone, and add up with what is stored. Full tiers of the days it touched are
    merged, so what readers and later batches meet grows with the logarithm of the batches. The last batch
    has all prices. A replay reads earlier batches only.
    """
    spark = batch.sparkSession
    rows = dedup.latest(batch).withColumn("dt", F.to_date("trade_time")).persist()
    fresh, held = rows, []
    try:
        if batch_id > 0:
            copies = stored_copies(rows, batch_id, into, held)
            if copies is not None:
                # Spark drops from its cache what was read below a path that is written to, so rows left out by a
                # plan over the tables would be worked out anew after each write.
                copies.write.mode("overwrite").parquet(_copies(into))
                copies = spark.read.schema(copies.schema).parquet(_copies(into))
                fresh = dedup.unseen(rows, copies).persist()
        days = [str(r.dt) for r in fresh.select("dt").distinct().collect()]
        if not days:
            return
        minute = ohlcv.partial(fresh).withColumn("dt", F.to_date("bucket_ts"))

        def write_rows() -> None:
            tiers.append(membership.filters(fresh), into.seen, batch_id, days, _SEEN_ORDER)
            tiers.append(fresh, into.raw, batch_id, days, _RAW_ORDER)

        storage.together(
            [
                write_rows,
                lambda: tiers.append(minute, into.minute, batch_id, days, _MINUTE_ORDER),
                lambda: _write_prices(fresh, batch_id, into),
            ]
        )
        if jdbc:
            publish.to_jdbc(publish.jdbc_row(fresh.drop("dt")), **jdbc)
    finally:
        for kept in (*held, fresh, rows):
            kept.unpersist()
    storage.delete(spark, _copies(into))
    storage.together([partial(merge_hot, spark, into, day, batch_id) for day in days])
    storage.drop_versions(spark, into.latest)


def _copies(into: HotTables) -> str:
    """Where the keys of the running batch that are stored already lie; no table's path begins this one."""
    parent, _, name = into.raw.rpartition("/")
    return f"{parent}/copies_of_{name}"


_SEEN_ORDER = ["hour", "word"]
_RAW_ORDER = ["trade_time", "symbol"]
_MINUTE_ORDER = ["symbol", "bucket_ts"]


def _write_prices(fresh: DataFrame, batch_id: int, into: HotTables) -> None:
    spark, prices = fresh.sparkSession, latest.partial(fresh)
    before = [b for b in map(int, storage.values(spark, into.latest, "batch_id")) if b < batch_id]
    prices = _merged(spark, prices, into.latest, [f"batch_id={max(before)}"] if before else [])
    prices = latest.merge_states(prices).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    tables.overwrite_partitions(prices, into.latest, ["batch_id"])


def stored_copies(
    rows: DataFrame, batch_id: int, into: HotTables, held: list[DataFrame] | None = None
) -> DataFrame | None:
    """Keys of rows that earlier batches stored; None if the filters admit no row. What may be stored is asked for
    twice; with ``held``, it is kept, and added to that list for the caller to release.

    A copy keeps its trade time. The filters of the hours that the rows touch say which of them may be
    stored; of the raw table only the days of those are opened, each between the first and the last of them.
    """
    spark = rows.sparkSession
    touched = rows.select("dt", F.hour("trade_time").alias("hour")).distinct().collect()
    words = tiers.read(spark, into.seen, sorted({str(r.dt) for r in touched}), batch_id)
    if words is None:
        return None
    words = words.where(F.col("hour").isin(sorted({r.hour for r in touched})))
    maybe = membership.admitted(rows.select("dt", "trade_time", *dedup.TRADE_KEY), words)
    if held is not None:
        held.append(maybe.persist())
    spans = maybe.groupBy("dt").agg(F.min("trade_time").alias("first"), F.max("trade_time").alias("last")).collect()
    if not spans:
        return None
    stored = tiers.read(spark, into.raw, [str(s.dt) for s in spans], batch_id)
    if stored is None:
        return None
    # A row per day, as a condition with a term for each is too long to be compiled.
    by_day = spark.createDataFrame([tuple(s) for s in spans], "dt date, first timestamp, last timestamp")
    inside = F.col("trade_time").between(F.lit(min(s["first"] for s in spans)), F.lit(max(s["last"] for s in spans)))
    stored = stored.where(inside).join(F.broadcast(by_day), "dt").where("trade_time BETWEEN first AND last")
    # The small side of a batch goes to the stored rows; what comes back is copies only.
    return stored.select("dt", *dedup.TRADE_KEY).join(
        maybe.select("dt", *dedup.TRADE_KEY), ["dt", *dedup.TRADE_KEY], "left_semi"
    )


def merge_hot(
    spark: SparkSession, into: HotTables, day: str, before: int | None = None, whole: bool = False
) -> None:
    """Merge the full tiers of a day of all three tables, or all its folders."""
    run = tiers.merge_all if whole else tiers.merge
    run(spark, into.seen, day, before, membership.union, _SEEN_ORDER)
    run(spark, into.raw, day, before, None, _RAW_ORDER)
    run(spark, into.minute, day, before, ohlcv.merge_states, _MINUTE_ORDER)


def compact_hot(spark: SparkSession, into: HotTables) -> None:
    """All folders of every day as one, for all three tables, with one job for many days. No batch may run at the
    same time."""

    def states(rows: DataFrame) -> DataFrame:
        return ohlcv.merge_states(rows).withColumn("dt", F.to_date("bucket_ts"))

    words = partial(membership.union, by=membership.COLUMNS[:-1])
    storage.together(
        [
            lambda: tiers.merge_days(spark, into.seen, words, _SEEN_ORDER),
            lambda: tiers.merge_days(spark, into.raw, None, _RAW_ORDER),
            lambda: tiers.merge_days(spark, into.minute, states, _MINUTE_ORDER),
        ]
    )


def _merged(spark: SparkSession, fresh: DataFrame, path: str, picked: list[str]) -> DataFrame:
    """New rows together with those of the folders picked."""
    stored = storage.read_versions(spark, path, picked)
    return fresh if stored is None else stored.select(*fresh.columns).unionByName(fresh)


def expire_hot(spark: SparkSession, into: HotTables, as_of: datetime, days: int = 7) -> None:
    """Delete raw trades and minute states that have expired, to the row; prices stay.

    Days before the border go as whole folders, filters included. The day on the border is rewritten with its
    live rows. Its filters stay, as admitting too much does no harm. No batch may run at the same time.
    """
    border = oldest_date(as_of, days).isoformat()
    for path, time, order in ((into.raw, "trade_time", _RAW_ORDER), (into.minute, "bucket_ts", _MINUTE_ORDER)):
        live = partial(unexpired, as_of=as_of, time=time, days=days)
        tiers.rewrite(spark, path, border, live, order)
    for path in (into.raw, into.minute, into.seen):
        for day in tiers.days(spark, path):
            if day < border:
                storage.delete(spark, f"{path}/dt={day}")


def raw_trades(spark: SparkSession, into: HotTables) -> DataFrame:
    """The stored trades, each once."""
    return tiers.read(spark, into.raw)


def minute_states(spark: SparkSession, into: HotTables) -> DataFrame:
    """One state per symbol and minute, from the folders of all batches."""
    return ohlcv.merge_states(tiers.read(spark, into.minute))


def price_states(spark: SparkSession, into: HotTables) -> DataFrame:
    """One price state per symbol: the last batch."""
    newest = max(map(int, storage.values(spark, into.latest, "batch_id")))
    return storage.read_versions(spark, into.latest, [f"batch_id={newest}"])


def price_updates(
    trades: DataFrame, path: str, checkpoint: str, interval: str | None = HOT_INTERVAL
) -> StreamingQuery:
    """The latest price per symbol with Spark's own state, kept in RocksDB on the executors and in the checkpoint.

    There is no watermark, so no trade is too late; copies change nothing, as the largest (time, id) wins. A
    batch gives the symbols that changed, which replace their rows in ``path`` (``tables.upserted``).
    """
    running = latest.partial(trades).select("symbol", "price", "updated")

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.upsert(batch, path, "symbol", batch_id)

    spark = trades.sparkSession
    before = spark.conf.get(_STATE_STORE, None)
    # A query takes the setting when it starts.
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        writer = running.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
        return _trigger(writer, interval).start()
    finally:
        if before is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, before)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def throttled(
    trades: DataFrame,
    limit: timedelta,
    path: str,
    checkpoint: str,
    interval: str | None = HOT_INTERVAL,
) -> StreamingQuery:
    """The per-symbol rate limit on a stream, with the distributed batch operator.

    Rows of a busy symbol are spread over tasks. The last kept time of every symbol lives beside the
    output; each batch writes all of them anew from the batch before, and drops older ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        throttle_batch(batch, batch_id, limit, path)

    return _start(trades, write, checkpoint, interval)


def throttle_batch(batch: DataFrame, batch_id: int, limit: timedelta, path: str) -> None:
    """One micro-batch: what is older than ``limit`` after the last kept trade of
    earlier batches cannot be kept; the rest starts afresh. Replays see the same
    earlier batch and rewrite their own folders. Beside the output, ``-throttled`` counts what
    each batch received and kept, per symbol.
    """
    spark = batch.sparkSession
    last_path, own = f"{path}-last", F.lit(batch_id).cast("bigint")
    before = [b for b in map(int, storage.values(spark, last_path, "batch_id")) if b < batch_id]
    last = storage.read_versions(spark, last_path, [f"batch_id={max(before)}"] if before else [])
    rows = batch
    if last is not None:
        open_again = F.col("last_kept") + F.make_dt_interval(secs=F.lit(limit.total_seconds()))
        # The last kept times are a row per symbol: Spark broadcasts them as long as they are small.
        rows = (
            batch.join(last.select("symbol", "last_kept"), "symbol", "left")
            .where(F.col("last_kept").isNull() | (F.col("trade_time") >= open_again))
            .select(*batch.columns)
        )
    kept = throttle(rows, limit).withColumn("batch_id", own)
    tables.overwrite_partitions(kept, path, ["batch_id"])
    written = spark.read.schema(kept.schema).parquet(path).where(F.col("batch_id") == batch_id)
    newer = written.groupBy("symbol").agg(F.max("trade_time").alias("last_kept"))
    if last is not None:
        newer = last.select("symbol", "last_kept").union(newer)
    newer = newer.groupBy("symbol").agg(F.max("last_kept").alias("last_kept"))
    tables.overwrite_partitions(newer.withColumn("batch_id", own), last_path, ["batch_id"])
    counted = batch.select("symbol", F.lit(0).alias("kept")).union(written.select("symbol", F.lit(1)))
    totals = counted.groupBy("symbol").agg(
        F.count_if(F.col("kept") == 0).alias("received"), F.count_if(F.col("kept") == 1).alias("sent")
    )
    totals = totals.withColumns({"throttled": F.col("received") - F.col("sent"), "batch_id": own})
    tables.overwrite_partitions(totals, f"{path}-throttled", ["batch_id"])
    storage.drop_versions(spark, last_path)


def windowed_bars(
    trades: DataFrame, path: str, checkpoint: str, window: str = "1 minute", interval: str | None = HOT_INTERVAL
) -> StreamingQuery:
    """Bars by time window of any width. Each micro-batch adds the states of its own windows, so late
    trades of any age count and the last window is there too; full tiers are merged. Read them
    with ``window_states``.

    Every trade must come once; ``hot_path`` removes copies.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("bucket_ts", F.window("trade_time", window)["start"])
        fresh = ohlcv.partial_of(placed).withColumn("dt", F.to_date("bucket_ts")).persist()
        try:
            days = [str(r.dt) for r in fresh.select("dt").distinct().collect()]
            if days:
                tiers.append(fresh, path, batch_id, days, _MINUTE_ORDER)
        finally:
            fresh.unpersist()
        merge = partial(tiers.merge, batch.sparkSession, path)
        storage.together([partial(merge, day, batch_id, ohlcv.merge_states, _MINUTE_ORDER) for day in days])

    return _start(trades, write, checkpoint, interval)


def window_states(spark: SparkSession, path: str) -> DataFrame:
    """One state per symbol and window."""
    return ohlcv.merge_states(tiers.read(spark, path))


def _start(
    rows: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.foreachBatch(each)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, interval).start()
