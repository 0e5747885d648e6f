"""Malformed input, one line per case."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions.text import symbol_list
from tickloom.operators import normalize
from tickloom.schema import LOG

HEAD = '{"e":"trade","E":2,"s":"X","t":7,"p":"2.5","q":"4","T":1,"m":true'
GOOD = HEAD + "}"
BAD_FEED = {
    "not json": "not an object",
    "[]": "not an object",
    "5": "not an object",
    "": "not an object",
    '{"data":null}': "not an object",
    '{"data":[1]}': "not an object",
    '{"e":"trade"}': "trade_id,symbol,price,qty,trade_time_ms,event_time_ms,is_buyer_maker",
    GOOD.replace('"t":7', '"t":"x"'): "trade_id",
    GOOD.replace('"p":"2.5"', '"p":NaN'): "price",
    GOOD.replace('"p":"2.5"', '"p":"NaN"'): "price",
    GOOD.replace('"q":"4"', '"q":"1e400"'): "qty",
    GOOD.replace('"m":true', '"m":"false"'): "is_buyer_maker",
    GOOD.replace('"m":true', '"m":1'): "is_buyer_maker",
}
DROPPED = ['{"e":"depth"}', '{"e":"depth","m":"false"}', "{}", '{"data":{"e":"kline"}}']
KEPT = [GOOD, '{"stream":"x@trade","data":' + GOOD + "}", GOOD.replace('"2.5"', "2.5")]


@pytest.fixture(scope="module")
def feed(spark):
    lines = [*BAD_FEED, *DROPPED, *KEPT]
    return normalize.decode_feed(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_feed_quarantine_names_the_field(feed):
    rows = normalize.malformed(feed).collect()
    assert {r.raw: r.bad_fields for r in rows} == BAD_FEED
    assert len(rows) == len(BAD_FEED)


def test_feed_keeps_trades(feed):
    rows = normalize.valid(feed).collect()
    assert len(rows) == len(KEPT)
    for row in rows:
        assert (row.trade_id, row.price, row.qty, row.quote_qty) == (7, 2.5, 4.0, 10.0)
        assert (row.trade_time_ms, row.event_time_ms, row.is_buyer_maker) == (1, 2, True)
        assert row.ingested_at.endswith("Z") and len(row.ingested_at) == 24


def test_feed_counters(feed):
    row = feed.agg(*normalize.counters(feed)).first()
    assert row.asDict() == {
        "received": len(BAD_FEED) + len(DROPPED) + len(KEPT),
        "sent": len(KEPT),
        "errors": len(BAD_FEED),
    }


VALUE = (
    '{"trade_id":1,"symbol":"X","price":1.5,"qty":2.0,"quote_qty":3.0,"trade_time_ms":10,'
    '"event_time_ms":11,"is_buyer_maker":false,"ingested_at":"2026-04-20T00:00:00.000Z"}'
)
BAD_LOG = {
    VALUE.replace('"trade_id":1', '"trade_id":"x"'): "trade_id",
    VALUE.replace('"price":1.5', '"price":NaN'): "price",
    VALUE.replace("2026-04-20T00:00:00.000Z", "yesterday"): "ingested_at",
    VALUE.replace('"symbol":"X",', ""): "symbol",
    VALUE.replace("false", '"false"'): "is_buyer_maker",
}


def records(spark, values):
    rows = [("k", v, "t", 1, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, LOG)


def test_log_quarantine(spark):
    decoded = normalize.decode_log(records(spark, [VALUE, None, "oops", *BAD_LOG]))
    found = {r.raw: r.bad_fields for r in normalize.malformed(decoded).collect()}
    assert {k: found[k] for k in BAD_LOG} == BAD_LOG
    assert set(found) == {None, "oops", *BAD_LOG}
    assert [r.kafka_offset for r in normalize.valid(decoded).collect()] == [0]


def test_keep_malformed_gives_partly_null_rows(spark):
    decoded = normalize.decode_log(records(spark, ['{"trade_id":"x","price":1}', "oops"]))
    rows = normalize.valid(decoded, keep_malformed=True).orderBy("kafka_offset").collect()
    assert [(r.trade_id, r.price) for r in rows] == [(None, 1.0), (None, None)]


def test_binary_values_and_publish_round_trip(spark):
    binary = records(spark, [VALUE]).withColumn("value", F.col("value").cast("binary"))
    message = normalize.to_messages(normalize.valid(normalize.decode_log(binary))).first()
    assert message.key == "X:1"
    assert message.value == VALUE


def test_preview_is_short_and_raw_is_whole(spark):
    long = "x" * 1000
    frame = normalize.decode_feed(spark.createDataFrame([(long,)], "value string"))
    row = normalize.malformed(frame).first()
    assert (len(row.preview), len(row.raw)) == (200, 1000)


def test_symbol_list():
    assert symbol_list(" btcusdt,, ETHusdt ") == ["BTCUSDT", "ETHUSDT"]
    with pytest.raises(ValueError):
        symbol_list(" , ")
