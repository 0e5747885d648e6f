"""Record types, each declared once and used by batch and streaming alike."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


def record(text: str) -> StructType:
    """``"name type, name type"`` as a struct; unlike DDL it needs no session."""
    struct = StructType()
    for field in filter(None, text.split(",")):
        name, kind = field.split()
        struct.add(name, _TYPES[kind])
    return struct


def ddl(struct: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in struct.fields)


# Field names and order of the published trade record.
TRADE = record(
    "trade_id bigint, symbol string, price double, qty double, quote_qty double, "
    "trade_time_ms bigint, event_time_ms bigint, is_buyer_maker boolean, ingested_at string"
)

# The exchange's one-letter fields, in the order FEED_NAMES renames them.
FEED = record(
    "e string, E string, s string, t string, p string, q string, T string, m boolean"
)
FEED_NAMES = (
    "struct<kind:string, event_time_ms:string, symbol:string, trade_id:string, "
    "price:string, qty:string, trade_time_ms:string, is_buyer_maker:boolean>"
)

LOG = record(
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

LOG_POSITION = ["kafka_partition", "kafka_offset", "kafka_timestamp"]

BRONZE_COLUMNS = [*TRADE.fieldNames(), *LOG_POSITION]
BRONZE = record(
    ddl(TRADE) + ", kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"
)

SILVER_COLUMNS = [
    "trade_id",
    "symbol",
    "price",
    "qty",
    "quote_qty",
    "trade_time",
    "event_time",
    "is_buyer_maker",
    "kafka_timestamp",
]

HOT_COLUMNS = [*SILVER_COLUMNS[:-1], "ingested_at", *LOG_POSITION]

# Positions inside one candlestick array of the exchange's REST answer.
KLINE_FIELDS = [
    ("open_time_ms", "bigint"),
    ("open", "double"),
    ("high", "double"),
    ("low", "double"),
    ("close", "double"),
    ("volume", "double"),
    ("close_time_ms", "bigint"),
    ("quote_volume", "double"),
    ("trades", "bigint"),
    ("taker_buy_base", "double"),
    ("taker_buy_quote", "double"),
]
KLINE_PAGE = 1000

COIN = record(
    "id string, symbol string, name string, current_price double, market_cap double, "
    "total_volume double"
)
MARKET_TOP = 250
