"""Laws of the operators, on tables with ties, repeats and disorder."""

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tickloom.operators import audit, dedup, latest, ohlcv
from tickloom.plans import layers
from tickloom.sources import samples


@pytest.fixture(scope="module")
def trades(spark, sf_dir):
    """Day-level times: many trades share the first and the last instant of a bucket."""
    rows = samples.lineitem_trades(spark, sf_dir)
    order = [*dedup.newest_first(), F.col("qty").desc(), F.col("price").desc()]
    return dedup.latest(rows, order=order).persist()


@pytest.mark.parametrize("blocks", [2, 5, 9])
def test_merged_blocks_equal_one_pass(trades, blocks):
    split = trades.withColumn("block", F.pmod(F.xxhash64("trade_id"), F.lit(blocks)))
    merged = ohlcv.bars(ohlcv.partial(split, "day", extra=["block"]))
    direct = ohlcv.rollup(trades, "day", "bucket_ts", qty="qty", quote="quote_qty")
    assertDataFrameEqual(merged, direct, rtol=0, atol=0)


def test_merge_is_associative_and_idempotent(trades):
    split = trades.withColumn("block", F.pmod(F.xxhash64("trade_id"), F.lit(6)))
    states = ohlcv.partial(split, "day", extra=["block"])
    left = ohlcv.merge_states(states.where("block < 2").drop("block"))
    right = ohlcv.merge_states(states.where("block >= 2").drop("block"))
    nested = ohlcv.merge_states(left.unionByName(right))
    flat = ohlcv.merge_states(states)
    assertDataFrameEqual(nested, flat, rtol=0, atol=0)
    assertDataFrameEqual(ohlcv.merge_states(flat), flat, rtol=0, atol=0)


def test_small_buckets_add_up(spark, sf_dir):
    rows = samples.trades(spark, sf_dir)
    coarse = ohlcv.bars(ohlcv.partial(rows), unit="hour")
    direct = ohlcv.rollup(rows, "hour", "bucket_ts", qty="qty", quote="quote_qty")
    assertDataFrameEqual(coarse, direct, rtol=0, atol=0)


def test_bars_are_ordered(trades):
    bars = ohlcv.rollup(trades, "day", qty="qty", quote="quote_qty")
    wrong = bars.where("low > open OR low > close OR high < open OR high < close")
    assert wrong.count() == 0


def test_dedup_laws(spark, sf_dir):
    bronze = samples.bronze(spark, sf_dir)
    once = dedup.latest(bronze)
    assertDataFrameEqual(dedup.latest(once), once)
    assertDataFrameEqual(dedup.latest(bronze.unionByName(bronze)), once)
    assert once.count() == samples.trades(spark, sf_dir).count()


def test_sums_do_not_depend_on_order(trades):
    up = trades.orderBy("price").coalesce(1)
    mixed = trades.repartition(13)
    total = lambda rows: rows.agg(ohlcv.exact_sum("quote_qty")).first()[0]
    plain = trades.agg(F.sum(F.col("quote_qty").cast("decimal(28,8)"))).first()[0]
    assert total(up) == total(mixed) == plain


def test_exact_sum_edges(spark):
    rows = spark.createDataFrame([(1e11,), (-1e11,), (1e-8,), (None,), (-2.5,), (8e7,)], "x double")
    assert str(rows.agg(ohlcv.exact_sum("x")).first()[0]) == "79999997.50000001"
    # Exact in binary, but not after a multiplication by 1e8.
    large = spark.range(1000).selectExpr("9e12D + id / 8 AS x")
    assert str(large.agg(ohlcv.exact_sum("x")).first()[0]) == "9000000000062437.50000000"
    assert rows.where("x IS NULL").agg(ohlcv.exact_sum("x")).first()[0] is None
    # Half a unit goes up as in DECIMAL, and huge values add up.
    odd = spark.createDataFrame([(5e-9,), (1.5,), (1e19,), (1e20,), (3e20,)], "x double")
    assert str(odd.agg(ohlcv.exact_sum("x")).first()[0]) == "410000000000000000001.50000001"
    # What the type cannot hold makes the whole sum NULL; no part is left out.
    for bad in ([float("nan")], [float("inf")], [-1e300], [1e31, -1e31], [9e29, 9e29]):
        lost = odd.union(spark.createDataFrame([(x,) for x in bad], "x double"))
        assert lost.agg(ohlcv.exact_sum("x")).first()[0] is None
    many = spark.range(20000).selectExpr("(rand(3) - 0.4) * pow(10, id % 9) AS x").cache()
    decimal = many.agg(F.sum(F.col("x").cast("decimal(28,8)"))).first()[0]
    assert many.agg(ohlcv.exact_sum("x")).first()[0] == decimal


def test_a_part_without_a_sum_leaves_the_whole_without_one(spark):
    rows = [("a", 1, 1.0, 1e31), ("a", 2, 1.0, 2.0), ("b", 3, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "symbol string, trade_id bigint, price double, qty double")
    frame = frame.withColumns({"trade_time": F.lit("2024-01-01").cast("timestamp"), "quote_qty": F.col("qty")})
    states = ohlcv.partial(frame, extra=["trade_id"])
    for bars in (ohlcv.bars(states), ohlcv.bars(ohlcv.partial(frame))):
        assert {r.symbol: (r.volume, r.trade_count) for r in bars.collect()} == {"a": (None, 2), "b": (2.0, 1)}


def test_latest_price_ignores_late_blocks(spark, sf_dir):
    rows = samples.trades(spark, sf_dir)
    old = latest.partial(rows.where("trade_id < 500"))
    both = old.unionByName(latest.partial(rows))
    assertDataFrameEqual(latest.prices(both), latest.prices(latest.partial(rows)))


def test_bronze_to_gold_counts(spark, sf_dir):
    bronze = samples.bronze(spark, sf_dir)
    gold = layers.fact_trades_1h(layers.staging(layers.silver(bronze)))
    counted = audit.row_count(dedup.latest(bronze)).first().n
    assert gold.agg(F.sum("trade_count")).first()[0] == counted


def test_gaps_need_no_window(spark):
    rows = spark.createDataFrame(
        [(0, o) for o in (1, 2, 5, 6, 9)] + [(1, o) for o in (4, 5)],
        "kafka_partition int, kafka_offset bigint",
    )
    got = sorted(tuple(r) for r in audit.offset_gaps(rows).collect())
    assert got == [(0, 3), (0, 7)]
    first = audit.offset_coverage(rows).where("kafka_partition = 0").first()
    assert (first.missing, first.next_offset, first.records) == (4, 10, 5)


def test_last_not_null_skips_nulls(spark):
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None)], "symbol string, t int, price double")
    assert latest.last_not_null(rows, "price", "t", ["symbol"]).first().price == 1.0


def test_edge_trade_breaks_ties_by_id(trades):
    hours = ohlcv.edge_trade(trades, "day").groupBy("symbol", "bucket").count()
    assert hours.where("count > 1").count() == 0
