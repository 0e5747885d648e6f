"""Candlestick answers and market snapshots, from landed JSON to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.schema import COIN, KLINE_FIELDS, KLINE_PAGE, MARKET_TOP


def decode_klines(responses: DataFrame) -> DataFrame:
    """One row per candle from whole REST answers, plus its raw text and ``bad_fields``.

    ``responses`` has ``symbol``, ``dt`` (the day the range ends at) and ``body``, an array of positional
    arrays. The range is the 24 hours up to and including ``dt``; ``page_full`` marks answers cut at the
    page limit. ``bad_fields`` is NULL for a usable candle; otherwise it says that the answer is no
    array of candles, which fields do not parse, or that the candle lies outside the range. Nothing is
    dropped but an empty array, which has no candle.
    """
    parsed = responses.select(
        F.upper(F.trim("symbol")).alias("symbol"),
        F.col("dt").cast("date").alias("dt"),
        "body",
        F.from_json("body", "array<array<string>>").alias("candles"),
    ).where("candles IS NULL OR size(candles) > 0")
    rows = parsed.select(
        "symbol",
        "dt",
        "body",
        F.coalesce(F.size("candles") >= KLINE_PAGE, F.lit(False)).alias("page_full"),
        F.explode_outer("candles").alias("k"),
    )
    typed = rows.select(
        *(
            F.expr(f"try_cast(get(k, {i}) AS {kind})").alias(name)
            for i, (name, kind) in enumerate(KLINE_FIELDS)
        ),
        "symbol",
        "dt",
        "page_full",
        F.coalesce(F.to_json("k"), "body").alias("raw"),
        F.col("k").isNull().alias("_no_candle"),
    )
    end = times.day_start_ms(F.col("dt"))
    day = 24 * 3600 * 1000
    missing = F.concat_ws(",", *(F.when(F.col(n).isNull(), F.lit(n)) for n, _ in KLINE_FIELDS))
    bad = (
        F.when(F.col("_no_candle"), F.lit("not an array of candles"))
        .when(missing != "", missing)
        .when(~F.col("open_time_ms").between(end - day, end), F.lit("out of range"))
    )
    return typed.withColumn("bad_fields", bad).drop("_no_candle")


def klines(responses: DataFrame) -> DataFrame:
    """The usable candles; ``rejected`` has the others."""
    return usable(decode_klines(responses))


def usable(decoded: DataFrame) -> DataFrame:
    return decoded.where("bad_fields IS NULL").drop("bad_fields", "raw")


def rejected(decoded: DataFrame, *also: str) -> DataFrame:
    """The quarantine: what was wrong and the raw text, beside the columns named."""
    return decoded.where("bad_fields IS NOT NULL").select(*also, "bad_fields", "raw")


def latest_klines(rows: DataFrame) -> DataFrame:
    """Neighbouring days share the midnight candle; the later answer wins."""
    from tickloom.operators.dedup import latest

    return latest(rows, keys=("symbol", "open_time_ms"), order=[F.col("dt").desc()])


def decode_coins(lines: DataFrame) -> DataFrame:
    """Market snapshot objects (columns ``value``, ``snapshot_ts``) with a fixed schema, plus the raw text
    and ``bad_fields``.

    Members the schema does not know are kept as JSON in ``_rescued``. A text that is no object, a coin
    without id, and a known member of a wrong type are named in ``bad_fields``.
    """
    known = F.array(*(F.lit(name) for name in COIN.fieldNames()))
    parsed = lines.select(
        "snapshot_ts",
        F.col("value").alias("raw"),
        F.from_json("value", "map<string,string>").alias("members"),
    )
    unknown = F.map_filter("members", lambda k, _: ~F.array_contains(known, k))
    given = {f.name: F.element_at("members", F.lit(f.name)) for f in COIN.fields}
    typed = {
        f.name: given[f.name].try_cast(f.dataType) if f.dataType.simpleString() != "string" else given[f.name]
        for f in COIN.fields
    }
    wrong = F.concat_ws(
        ",",
        F.when(given["id"].isNull(), F.lit("id")),
        *(F.when(given[n].isNotNull() & typed[n].isNull(), F.lit(n)) for n in typed),
    )
    return parsed.select(
        *(column.alias(name) for name, column in typed.items()),
        "snapshot_ts",
        F.when(F.size(unknown) > 0, F.to_json(unknown)).alias("_rescued"),
        "raw",
        F.when(F.col("members").isNull(), F.lit("not an object")).when(wrong != "", wrong).alias("bad_fields"),
    )


def coins(lines: DataFrame) -> DataFrame:
    """The usable coins; ``rejected`` has the others."""
    return usable(decode_coins(lines))


def with_partitions(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"dt": F.to_date("snapshot_ts"), "hour": times.hour_label("snapshot_ts")}
    )


def market_top(rows: DataFrame, k: int = MARKET_TOP) -> DataFrame:
    """The k largest coins by market cap in every snapshot."""
    window = Window.partitionBy("snapshot_ts").orderBy(
        F.col("market_cap").desc_nulls_last(), F.col("id").asc()
    )
    return (
        rows.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .orderBy("snapshot_ts", "rank")
    )
