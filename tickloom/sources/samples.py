"""The given tables seen as trades, log records, REST answers and raw feed lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import numbers, times
from tickloom.operators import ohlcv
from tickloom.schema import TRADE
from tickloom.session import pin


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as a file stream.

    The last letter is written as a glob so that one file and a folder of
    files are both accepted as a stream path.
    """
    schema = table(spark, sf_dir, name).schema
    path = f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet"
    return spark.readStream.schema(schema).options(**options).parquet(path)


def trades_of(events: DataFrame) -> DataFrame:
    """``events`` as trades with log positions; works on batch and stream frames."""
    qty = F.get_json_object("props", "$.k").cast("double")
    trade_time = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        qty.alias("qty"),
        numbers.quote_value(F.col("value"), qty).alias("quote_qty"),
        trade_time.alias("trade_time"),
        (trade_time + F.expr("INTERVAL 1 MILLISECOND")).alias("event_time"),
        (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
        (F.col("event_id") % 3).cast("int").alias("kafka_partition"),
        F.expr("event_id div 3").alias("kafka_offset"),
        (trade_time + F.expr("INTERVAL 250 MILLISECOND")).alias("kafka_timestamp"),
    )


def trades(spark: SparkSession, sf_dir: str, after: datetime | None = None) -> DataFrame:
    """``after`` says that only later trades are asked for.

    Trade times and bucket starts are cut from ``ts``, which a scan cannot see
    through; as neither is ever larger, the same bound on ``ts`` loses nothing
    and lets the scan skip row groups.
    """
    events = table(spark, sf_dir, "events")
    if after is not None:
        events = events.where(F.col("ts") > F.lit(after).cast("timestamp").cast("timestamp_ntz"))
    return trades_of(events)


def redeliver(rows: DataFrame) -> DataFrame:
    """Every row, and a later second copy of each tenth trade under a new offset."""
    again = F.col("trade_id") % 10 == 0
    numbers_of = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = rows.withColumn("copy", F.explode(numbers_of))
    is_copy = F.col("copy") == 1
    return copies.withColumns(
        {
            "kafka_offset": F.when(is_copy, F.lit(1_000_000_000) + F.col("trade_id")).otherwise(
                F.col("kafka_offset")
            ),
            "kafka_timestamp": F.when(
                is_copy, F.col("kafka_timestamp") + F.expr("INTERVAL 1 SECOND")
            ).otherwise(F.col("kafka_timestamp")),
        }
    ).drop("copy")


def as_bronze(rows: DataFrame) -> DataFrame:
    """Typed trades back in the wire shape of the Bronze table."""
    return rows.withColumns(
        {
            "trade_time_ms": times.to_ms("trade_time"),
            "event_time_ms": times.to_ms("event_time"),
            "ingested_at": times.iso(F.col("event_time")),
        }
    ).select(*TRADE.fieldNames(), "kafka_partition", "kafka_offset", "kafka_timestamp")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bronze(redeliver(trades(spark, sf_dir)))


def log_records(bronze_rows: DataFrame, topic: str = "raw_trades") -> DataFrame:
    """Bronze rows as the log records they came from."""
    return bronze_rows.select(
        F.concat_ws(":", "symbol", F.col("trade_id").cast("string")).alias("key"),
        F.to_json(F.struct(*TRADE.fieldNames())).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


#: Values of log records that no trade can be made of, with the fields that are missing or wrong.
BAD_VALUES = ("not json", "[]", "{}", '{"trade_id":"x"}')


def log_records_with_bad(bronze_rows: DataFrame) -> DataFrame:
    """The log with malformed records after the first delivery of every 40th trade."""
    records = log_records(bronze_rows)
    number = F.split("key", ":")[1].cast("bigint")
    with_bad = (number % 40 == 0) & (F.col("offset") < 1_000_000_000)
    good = F.array("value")
    values = F.when(with_bad, F.concat(good, F.array(*map(F.lit, BAD_VALUES)))).otherwise(good)
    return records.withColumn("value", F.explode(values))


def gaining_members(records: DataFrame, parts: int) -> DataFrame:
    """Log records of which all but each ``parts``-th trade have members that the record type does not know."""
    number = F.split("key", ":")[1].cast("bigint")
    fee = F.when(number % 50 == 0, F.lit('"none"')).otherwise(F.concat(number.cast("string"), F.lit(".5")))
    note = F.concat(F.lit('{"seen":['), (number % 4).cast("string"), F.lit("]}"))
    more = F.concat(F.lit(',"venue":"v'), (number % 5).cast("string"), F.lit('","fee":'), fee, F.lit(',"note":'), note, F.lit("}"))
    gained = F.concat(F.expr("left(value, length(value) - 1)"), more)
    return records.withColumn("value", F.when(F.pmod(number, F.lit(parts)) > 0, gained).otherwise(F.col("value")))


def wide_amounts(bronze_rows: DataFrame) -> DataFrame:
    """Bronze rows with quantities about the largest that are taken."""
    return bronze_rows.withColumns({"qty": F.col("qty") * 5e18, "quote_qty": F.col("qty") * 3e18})


def same_time_copies(bronze_rows: DataFrame) -> DataFrame:
    """Redelivered rows with the log time of the first delivery and a price of their own, so that the
    offset alone says which version is the newest."""
    copy = F.col("kafka_offset") >= 1_000_000_000
    return bronze_rows.withColumns(
        {
            "kafka_timestamp": F.when(copy, F.col("kafka_timestamp") - F.expr("INTERVAL 1 SECOND")).otherwise(
                F.col("kafka_timestamp")
            ),
            "price": F.when(copy, F.col("price") + 1).otherwise(F.col("price")),
        }
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as trades: day-level times (many ties) and repeated trade ids."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.col("l_returnflag").alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        numbers.quote_value(F.col("l_extendedprice"), F.col("l_quantity")).alias("quote_qty"),
        F.col("l_shipdate").cast("timestamp").alias("trade_time"),
        F.col("l_shipdate").cast("timestamp").alias("kafka_timestamp"),
        F.col("l_partkey").alias("kafka_offset"),
        F.col("l_suppkey").alias("kafka_partition"),
    )


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades as raw exchange lines.

    Odd ids come bare, even ids inside the ``{"stream": .., "data": ..}``
    envelope. After every 40th trade one line of each broken kind is added, and
    one message of another kind, which is dropped without being an error.
    """
    rows = trades(spark, sf_dir)
    inner = F.to_json(
        F.struct(
            F.lit("trade").alias("e"),
            times.to_ms("event_time").alias("E"),
            F.col("symbol").alias("s"),
            F.col("trade_id").alias("t"),
            F.col("price").cast("string").alias("p"),
            F.col("qty").cast("string").alias("q"),
            times.to_ms("trade_time").alias("T"),
            F.col("is_buyer_maker").alias("m"),
        )
    )
    good = F.when(F.col("trade_id") % 2 == 1, inner).otherwise(
        F.concat(F.lit('{"stream":"'), F.lower("symbol"), F.lit('@trade","data":'), inner, F.lit("}"))
    )
    head = F.concat(F.lit('{"e":"trade","E":1,"s":"'), F.col("symbol"), F.lit('",'))
    broken = [
        F.lit("not json"),
        F.lit("[]"),
        F.lit(""),
        F.lit('{"e":"trade"}'),
        F.concat(head, F.lit('"t":"x","p":"1","q":"1","T":1,"m":true}')),
        F.concat(head, F.lit('"t":1,"p":NaN,"q":"1","T":1,"m":true}')),
        F.concat(head, F.lit('"t":1,"p":"1","q":"1","T":1,"m":"false"}')),
        F.lit('{"data":null}'),
        F.lit('{"e":"depth","s":"X"}'),
    ]
    lines = F.when(F.col("trade_id") % 40 == 0, F.array(good, *broken)).otherwise(F.array(good))
    return rows.select(F.explode(lines).alias("value"))


def old_and_again(bronze_rows: DataFrame) -> DataFrame:
    """First deliveries with each 20th trade once more as a trade of two years before, under an id of its own, and
    copies of those: the tenth part of a log that came late, and again."""
    first = bronze_rows.where("kafka_offset < 1000000000")
    two_years = 730 * 86_400_000
    old = first.where("trade_id % 20 = 0").withColumns(
        {
            "trade_id": -1 - F.col("trade_id"),
            "trade_time_ms": F.col("trade_time_ms") - two_years,
            "event_time_ms": F.col("event_time_ms") - two_years,
            "kafka_offset": 2_000_000_000 + F.col("trade_id"),
        }
    )
    again = old.withColumn("kafka_offset", F.col("kafka_offset") + 1_000_000_000)
    return first.unionByName(old).unionByName(again)


def kline_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of the trades as REST answers, one per symbol and day.

    An answer covers the 24 hours up to and including midnight of ``dt``, so a
    midnight candle is in two answers, and none has more than 25 candles.
    """
    rows = trades(spark, sf_dir)
    taker = ~F.col("is_buyer_maker")
    bars = rows.groupBy("symbol", F.date_trunc("hour", "trade_time").alias("open_time")).agg(
        F.min_by("price", ohlcv.trade_order()).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", ohlcv.trade_order()).alias("close"),
        numbers.exact_sum("qty").cast("double").alias("volume"),
        numbers.exact_sum("quote_qty").cast("double").alias("quote_volume"),
        F.count(F.lit(1)).alias("trades"),
        numbers.exact_sum(F.when(taker, F.col("qty")).otherwise(0.0)).cast("double").alias("taker_base"),
        numbers.exact_sum(F.when(taker, F.col("quote_qty")).otherwise(0.0))
        .cast("double")
        .alias("taker_quote"),
    )
    opened = times.to_ms("open_time")
    number = [opened, F.col("trades"), opened + 3_600_000 - 1]
    quoted = {
        c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
        for c in ("open", "high", "low", "close", "volume", "quote_volume", "taker_base", "taker_quote")
    }
    candle = F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            number[0].cast("string"),
            *(quoted[c] for c in ("open", "high", "low", "close", "volume")),
            number[2].cast("string"),
            quoted["quote_volume"],
            number[1].cast("string"),
            quoted["taker_base"],
            quoted["taker_quote"],
            F.lit('"0"'),
        ),
        F.lit("]"),
    )
    day = F.to_date("open_time")
    midnight = F.col("open_time") == day.cast("timestamp")
    ends = F.when(midnight, F.array(day, F.date_add(day, 1))).otherwise(F.array(F.date_add(day, 1)))
    return (
        bars.select("symbol", opened.alias("at"), candle.alias("c"), ends.alias("ends"))
        .select("symbol", "at", "c", F.explode("ends").alias("dt"))
        .groupBy("symbol", "dt")
        .agg(F.sort_array(F.collect_list(F.struct("at", "c"))).alias("ks"))
        .select(
            "symbol",
            "dt",
            F.concat(F.lit("["), F.array_join(F.col("ks.c"), ","), F.lit("]")).alias("body"),
        )
    )


def kline_bodies_with_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers, and for the first day of every symbol also an error body, a text that is cut off, a
    candle with a time that is none, and one of another day."""
    bodies = kline_bodies(spark, sf_dir)
    candle = '[{at},"1","2","0.5","1.5","10",1,"15",3,"4","6","0"]'
    bad = ['{"code":-1121}', '[[1,"2"', f"[{candle.format(at='null')},{candle.format(at=1)}]"]
    first = bodies.groupBy("symbol").agg(F.min("dt").alias("dt"))
    extra = first.select("symbol", "dt", F.explode(F.array(*map(F.lit, bad))).alias("body"))
    return bodies.unionByName(extra)


def coin_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the coins of one market snapshot, with one member no schema knows."""
    part = table(spark, sf_dir, "part")
    coin = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_brand").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("current_price"),
        (F.col("p_retailprice") * F.col("p_size")).alias("market_cap"),
        F.col("p_size").cast("double").alias("total_volume"),
        F.col("p_type").alias("category"),
    )
    return part.select(
        F.to_json(coin).alias("value"), F.lit("2024-01-01 05:00:00").cast("timestamp").alias("snapshot_ts")
    )


def coin_objects_with_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coins, and after every 100th one that has no id, one whose price is a word, and a text that is
    no object."""
    rows = coin_objects(spark, sf_dir).withColumn("n", F.get_json_object("value", "$.id").cast("bigint"))
    bad = ['{"symbol":"X"}', '{"id":"y","current_price":"dear","market_cap":5.0}', "gone"]
    values = F.when(F.col("n") % 100 == 0, F.concat(F.array("value"), F.array(*map(F.lit, bad)))).otherwise(F.array("value"))
    return rows.select(F.explode(values).alias("value"), "snapshot_ts")
