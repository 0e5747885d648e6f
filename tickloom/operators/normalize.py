"""Decoding messages, and setting malformed ones aside.

Both decoders give one frame in which ``bad_fields`` is NULL for a usable row
and otherwise names what is wrong; ``valid`` and ``malformed`` split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions import numbers, text, times
from tickloom.operators import evolve
from tickloom.schema import BRONZE, FEED, FEED_NAMES, HOT_COLUMNS, LOG_POSITION, SILVER_COLUMNS, TRADE

_POSITION = {"kafka_partition": "partition", "kafka_offset": "offset", "kafka_timestamp": "timestamp"}


def _names(*bad: Column) -> Column:
    """The non-null names, comma separated; NULL when there are none."""
    joined = F.concat_ws(",", *bad)
    return F.when(joined != "", joined)


def _parsed(struct: Column) -> Column:
    """The fields of a parsed struct as columns.

    A generator is not merged into its neighbours, so a message is parsed once;
    a plain ``struct.*`` is parsed again for every use of every field.
    """
    return F.inline_outer(F.array(struct))


def decode_log(records: DataFrame, added: StructType | None = None) -> DataFrame:
    """Log records to Bronze columns, plus the raw value and ``bad_fields``.

    With ``added``, which may be empty, members that no column has are kept in ``rescued``, and those that it
    declares become columns; what is wrong with them makes no record unusable.
    """
    checked = records.select(
        _parsed(F.from_json(F.col("value").cast("string"), TRADE)),
        F.col("value").cast("string").alias("raw"),
        *(F.col(source).alias(name) for name, source in _POSITION.items()),
    ).select(*TRADE.fieldNames(), *_POSITION, "raw")
    if added is not None:
        evolve.evolved(BRONZE, added)
        checked = checked.withColumn(evolve.RESCUED, evolve.rescued(F.col("raw"), TRADE.fieldNames()))
        checked = evolve.widen(checked, added)
    bad = _names(
        *(F.when(F.col(f).isNull(), F.lit(f)) for f in TRADE.fieldNames() if f != "ingested_at"),
        *(
            F.when(F.col(f).isNotNull() & numbers.amount(F.col(f)).isNull(), F.lit(f))
            for f in ("price", "qty", "quote_qty")
        ),
        F.when(times.from_iso("ingested_at").isNull(), F.lit("ingested_at")),
    )
    return checked.withColumn("bad_fields", bad)


def decode_feed(lines: DataFrame) -> DataFrame:
    """Raw exchange lines (column ``value``) to trade fields.

    The message is the ``data`` member when the line has one, else the line
    itself. ``kind`` tells messages apart: a JSON object that is not a trade is
    neither valid nor malformed.
    """
    inner = F.get_json_object("raw", "$.data")
    keys = F.json_object_keys("raw")
    no_object = keys.isNull() | (
        F.array_contains(keys, "data") & F.json_object_keys(inner).isNull()
    )
    raw = lines.select(F.col("value").alias("raw"))
    # Cast by position: the one-letter names differ only in case.
    message = raw.select(
        "raw", _parsed(F.from_json(F.coalesce(inner, "raw"), FEED).cast(FEED_NAMES))
    )
    fields = message.select(
        "raw",
        "kind",
        F.expr("try_cast(trade_id AS BIGINT)").alias("trade_id"),
        "symbol",
        numbers.amount(F.expr("try_cast(price AS DOUBLE)")).alias("price"),
        numbers.amount(F.expr("try_cast(qty AS DOUBLE)")).alias("qty"),
        F.expr("try_cast(trade_time_ms AS BIGINT)").alias("trade_time_ms"),
        F.expr("try_cast(event_time_ms AS BIGINT)").alias("event_time_ms"),
        "is_buyer_maker",
    )
    needed = [f for f in TRADE.fieldNames() if f not in ("quote_qty", "ingested_at")]
    quote = numbers.quote_value(F.col("price"), F.col("qty"))
    missing = _names(
        *(F.when(F.col(f).isNull(), F.lit(f)) for f in needed),
        F.when(quote.isNotNull() & numbers.amount(quote).isNull(), F.lit("quote_qty")),
    )
    return fields.select(
        "raw",
        "kind",
        "trade_id",
        "symbol",
        "price",
        "qty",
        quote.alias("quote_qty"),
        "trade_time_ms",
        "event_time_ms",
        "is_buyer_maker",
        times.now_iso().alias("ingested_at"),
        F.when(F.col("kind") == "trade", missing)
        .when(F.col("kind").isNull() & no_object, F.lit("not an object"))
        .alias("bad_fields"),
    )


def valid(decoded: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """Usable rows; ``keep_malformed`` lets broken ones through with NULL fields."""
    rows = decoded if keep_malformed else decoded.where("bad_fields IS NULL")
    if "kind" in decoded.columns:
        rows = rows.where("kind = 'trade'")
    return rows.drop("bad_fields", "raw", "kind")


def malformed(decoded: DataFrame) -> DataFrame:
    """The quarantine: what was wrong, a short preview and the whole raw text."""
    return decoded.where("bad_fields IS NOT NULL").select(
        "bad_fields", text.preview("raw").alias("preview"), "raw"
    )


def counters(decoded: DataFrame) -> list[Column]:
    """Operational totals, for ``agg`` in batch and ``observe`` in a stream."""
    usable = F.col("bad_fields").isNull()
    if "kind" in decoded.columns:
        usable = usable & F.coalesce(F.col("kind") == "trade", F.lit(False))
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(usable).alias("sent"),
        F.count_if(F.col("bad_fields").isNotNull()).alias("errors"),
    ]


def to_hot(bronze: DataFrame) -> DataFrame:
    """Bronze fields as the hot store types them."""
    return _timed(bronze).withColumn("ingested_at", times.from_iso("ingested_at")).select(*HOT_COLUMNS)


def to_silver(bronze: DataFrame, positions: bool = False) -> DataFrame:
    """``positions`` keeps the log position, which a later merge needs for its order."""
    columns = [*SILVER_COLUMNS, *(LOG_POSITION[:2] if positions else [])]
    return _timed(bronze).select(*columns)


def _timed(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {"trade_time": times.from_ms("trade_time_ms"), "event_time": times.from_ms("event_time_ms")}
    )


def to_staging(silver: DataFrame) -> DataFrame:
    return silver.select(
        "trade_id",
        "symbol",
        "price",
        F.col("qty").alias("quantity"),
        F.col("quote_qty").alias("quote_quantity"),
        "trade_time",
        "event_time",
        F.col("is_buyer_maker").cast("boolean").alias("is_buyer_maker"),
    )


def to_messages(trades: DataFrame) -> DataFrame:
    """Normalised trades as the keyed compact JSON that is published."""
    return trades.select(
        text.trade_key().alias("key"), F.to_json(F.struct(*TRADE.fieldNames())).alias("value")
    )
