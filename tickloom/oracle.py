"""The same queries as plain SQL for an independent engine (DuckDB).

Written from the definitions, not from the Spark code: the rate limit is a recursive query,
layers are window functions, and so on.
"""

from __future__ import annotations

_QTY = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

TRADES = f"""
trades AS (
  SELECT event_id AS trade_id, event_type AS symbol, value AS price, {_QTY} AS qty,
         ROUND(value * {_QTY}, 8) AS quote_qty,
         date_trunc('millisecond', ts) AS trade_time,
         date_trunc('millisecond', ts) + INTERVAL 1 MILLISECOND AS event_time,
         user_id % 2 = 0 AS is_buyer_maker,
         CAST(event_id % 3 AS INTEGER) AS kafka_partition,
         event_id // 3 AS kafka_offset,
         date_trunc('millisecond', ts) + INTERVAL 250 MILLISECOND AS kafka_timestamp
  FROM events)"""

BRONZE = f"""{TRADES},
bronze AS (
  SELECT * FROM trades
  UNION ALL
  SELECT * REPLACE (1000000000 + trade_id AS kafka_offset,
                    kafka_timestamp + INTERVAL 1 SECOND AS kafka_timestamp)
  FROM trades WHERE trade_id % 10 = 0)"""

SILVER = f"""{BRONZE},
silver AS (
  SELECT trade_id, symbol, price, qty, quote_qty, trade_time, event_time, is_buyer_maker,
         kafka_timestamp
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, trade_id
          ORDER BY kafka_timestamp DESC, kafka_offset DESC, kafka_partition DESC) AS rn
        FROM bronze)
  WHERE rn = 1)"""

LINE_TRADES = """
line_all AS (
  SELECT l_orderkey * 10 + l_linenumber AS trade_id, l_returnflag AS symbol,
         l_extendedprice AS price, l_quantity AS qty,
         ROUND(l_extendedprice * l_quantity, 8) AS quote_qty,
         l_shipdate AS trade_time, l_shipdate AS kafka_timestamp,
         l_partkey AS kafka_offset, l_suppkey AS kafka_partition
  FROM lineitem),
line_trades AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol, trade_id
          ORDER BY kafka_timestamp DESC, kafka_offset DESC, kafka_partition DESC,
                   qty DESC, price DESC) AS rn
        FROM line_all)
  WHERE rn = 1)"""


def _total(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(28,8))) AS DOUBLE)"


def _bars(source: str, unit: str, bucket: str) -> str:
    return f"""
SELECT symbol, date_trunc('{unit}', trade_time) AS {bucket},
       arg_min(price, (trade_time, trade_id)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (trade_time, trade_id)) AS close,
       {_total('qty')} AS volume, {_total('quote_qty')} AS quote_volume, count(*) AS trade_count
FROM {source} GROUP BY 1, 2"""


_MINUTES = f"minutes AS ({_bars('trades', 'minute', 'bucket_ts')})"
_AS_OF = "(SELECT MAX(trade_time) FROM trades)"

_LATEST = """
SELECT symbol, price, trade_time AS updated
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY symbol
        ORDER BY trade_time DESC, trade_id DESC) AS rn FROM trades)
WHERE rn = 1"""

_PROFILE = """
SELECT symbol, COUNT(*) AS trades, ROUND(MIN(price), 4) AS lo_price,
       ROUND(MAX(price), 4) AS hi_price, MIN(kafka_timestamp) AS first_seen,
       MAX(kafka_timestamp) AS last_seen
FROM bronze GROUP BY symbol"""

_WIRE = """
SELECT trade_id, symbol, price, qty, quote_qty, epoch_ms(trade_time) AS trade_time_ms,
       epoch_ms(event_time) AS event_time_ms, is_buyer_maker,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS ingested_at,
       kafka_partition, kafka_offset, kafka_timestamp
FROM bronze"""


def _recent(select: str, minutes: int) -> str:
    return f"WITH {TRADES}, {_MINUTES} {select.format(bound=f'{_AS_OF} - INTERVAL {minutes} MINUTE')}"


_RECENT_BARS = """SELECT bucket_ts, symbol, open, high, low, close, volume
FROM minutes WHERE bucket_ts > {bound}"""
_RECENT_CLOSE = 'SELECT bucket_ts AS "time", symbol, close FROM minutes WHERE bucket_ts > {bound}'
_RECENT_VOLUME = 'SELECT bucket_ts AS "time", symbol, volume FROM minutes WHERE bucket_ts > {bound}'


def _recent_count(minutes: int) -> str:
    return f"""WITH {SILVER}
SELECT symbol, COUNT(*) AS trades FROM silver
WHERE trade_time > {_AS_OF} - INTERVAL {minutes} MINUTE GROUP BY symbol"""


def _edge(way: str) -> str:
    return f"""WITH {TRADES}
SELECT symbol, bucket, trade_id, trade_time, price
FROM (SELECT *, date_trunc('hour', trade_time) AS bucket,
             ROW_NUMBER() OVER (PARTITION BY symbol, date_trunc('hour', trade_time)
                                ORDER BY trade_time {way}, trade_id {way}) AS rn
      FROM trades) WHERE rn = 1"""


def _throttle(interval: str, source: str = "trades", before: str = "") -> str:
    return f"""WITH RECURSIVE {TRADES}, {before}
kept(symbol, trade_time) AS (
  SELECT symbol, MIN(trade_time) FROM {source} GROUP BY symbol
  UNION ALL
  SELECT k.symbol, (SELECT MIN(t.trade_time) FROM {source} t
                    WHERE t.symbol = k.symbol AND t.trade_time >= k.trade_time + {interval})
  FROM kept k WHERE k.trade_time IS NOT NULL)
SELECT symbol, trade_id, trade_time, price
FROM (SELECT t.*, ROW_NUMBER() OVER (PARTITION BY symbol, trade_time ORDER BY trade_id) AS rn
      FROM {source} t SEMI JOIN kept k USING (symbol, trade_time)) WHERE rn = 1"""


_SPREAD = """
spread AS (SELECT * REPLACE (date_trunc('hour', trade_time) + to_microseconds(trade_id * 7919 % 250) AS trade_time) FROM trades),"""

_BROKEN = """
broken AS (
  SELECT unnest(['not json', '[]', '', '{"e":"trade"}',
    '{"e":"trade","E":1,"s":"' || event_type || '","t":"x","p":"1","q":"1","T":1,"m":true}',
    '{"e":"trade","E":1,"s":"' || event_type || '","t":1,"p":NaN,"q":"1","T":1,"m":true}',
    '{"e":"trade","E":1,"s":"' || event_type || '","t":1,"p":"1","q":"1","T":1,"m":"false"}',
    '{"data":null}']) AS preview,
    unnest(['not an object', 'not an object', 'not an object',
    'trade_id,symbol,price,qty,trade_time_ms,event_time_ms,is_buyer_maker',
    'trade_id', 'price', 'is_buyer_maker', 'not an object']) AS bad_fields
  FROM events WHERE event_id % 40 = 0)"""

_KLINES = f"""WITH {TRADES},
hours AS ({_bars('trades', 'hour', 'opened')}),
taken AS (
  SELECT symbol, date_trunc('hour', trade_time) AS opened,
         {_total("CASE WHEN is_buyer_maker THEN 0 ELSE qty END")} AS taker_buy_base,
         {_total("CASE WHEN is_buyer_maker THEN 0 ELSE quote_qty END")} AS taker_buy_quote
  FROM trades GROUP BY ALL)
SELECT epoch_ms(opened) AS open_time_ms, open, high, low, close, volume,
       epoch_ms(opened) + 3599999 AS close_time_ms, quote_volume, trade_count AS trades,
       taker_buy_base, taker_buy_quote, UPPER(symbol) AS symbol,
       CAST(CAST(opened AS DATE) + 1 AS DATE) AS dt, FALSE AS page_full
FROM hours JOIN taken USING (symbol, opened)"""

_PUBLISHED = f"""WITH {BRONZE}
SELECT symbol || ':' || trade_id AS key, * EXCLUDE (kafka_partition, kafka_offset, kafka_timestamp)
FROM ({_WIRE})"""

_ALL_FIELDS = "trade_id,symbol,price,qty,quote_qty,trade_time_ms,event_time_ms,is_buyer_maker,ingested_at"

ORACLE: dict[str, str] = {
    "bronze_count": f"WITH {BRONZE} SELECT COUNT(*) AS n FROM bronze",
    "bronze_profile": f"WITH {BRONZE} {_PROFILE}",
    "bronze_symbol_counts": f"WITH {BRONZE} SELECT symbol, COUNT(*) AS trades FROM bronze GROUP BY symbol",
    "layer_reconcile": f"""WITH {BRONZE}
SELECT symbol, COUNT(*) AS bronze_rows, COUNT(DISTINCT trade_id) AS silver_rows,
       COUNT(*) - COUNT(DISTINCT trade_id) AS removed FROM bronze GROUP BY symbol""",
    "offset_coverage": f"""WITH {BRONZE}
SELECT kafka_partition, MIN(kafka_offset) AS first_offset, MAX(kafka_offset) AS last_offset,
       COUNT(*) AS records, MAX(kafka_offset) + 1 AS next_offset,
       MAX(kafka_offset) - MIN(kafka_offset) + 1 - COUNT(DISTINCT kafka_offset) AS missing
FROM bronze GROUP BY kafka_partition""",
    "offset_gaps": f"""WITH {BRONZE}
SELECT kafka_partition, kafka_offset + 1 AS gap_start
FROM (SELECT kafka_partition, kafka_offset,
             LEAD(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS following
      FROM (SELECT DISTINCT kafka_partition, kafka_offset FROM bronze))
WHERE following > kafka_offset + 1""",
    "offset_intervals": f"""WITH {BRONZE}
SELECT kafka_partition, kafka_offset + 1 AS gap_start, following - 1 AS gap_end
FROM (SELECT kafka_partition, kafka_offset,
             LEAD(kafka_offset) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset) AS following
      FROM (SELECT DISTINCT kafka_partition, kafka_offset FROM bronze))
WHERE following > kafka_offset + 1""",
    "layer_diff": f"""WITH {SILVER}, picked AS (SELECT *, CAST(trade_time AS DATE) AS dt FROM silver)
SELECT symbol, dt, trade_id, 'price' AS "column", CAST(price AS VARCHAR) AS left_value,
       CAST(price + 1 AS VARCHAR) AS right_value FROM picked WHERE trade_id = 123
UNION ALL SELECT symbol, dt, trade_id, 'row', 'present', NULL FROM picked WHERE trade_id = 456
UNION ALL SELECT symbol, dt, -789, 'row', NULL, 'present' FROM picked WHERE trade_id = 789""",
    "table_health": """
SELECT 'events' AS table_name, COUNT(*) AS row_count, CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'warn' END AS status FROM events
UNION ALL SELECT 'lineitem', COUNT(*), CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'warn' END FROM lineitem
UNION ALL SELECT 'part', COUNT(*), CASE WHEN COUNT(*) > 0 THEN 'pass' ELSE 'warn' END FROM part
UNION ALL SELECT 'no_such_table', CAST(0 AS BIGINT), 'fail'""",
    "silver_trades": f"WITH {SILVER} SELECT * FROM silver",
    "stg_trades": f"""WITH {SILVER}
SELECT trade_id, symbol, price, qty AS quantity, quote_qty AS quote_quantity, trade_time,
       event_time, CAST(is_buyer_maker AS BOOLEAN) AS is_buyer_maker FROM silver""",
    "fact_trades_1h": f"WITH {SILVER} {_bars('silver', 'hour', 'bucket_hour')}",
    "first_trade_per_hour": _edge("ASC"),
    "last_trade_per_hour": _edge("DESC"),
    "silver_ties": f"WITH {LINE_TRADES} SELECT * FROM line_trades",
    "ohlcv_1d_ties": f"WITH {LINE_TRADES} {_bars('line_trades', 'day', 'bucket_day')}",
    "ohlcv_1m": f"WITH {TRADES} {_bars('trades', 'minute', 'bucket_ts')}",
    "ohlcv_1h_from_states": f"WITH {TRADES} {_bars('trades', 'hour', 'bucket_ts')}",
    "compacted_states": f"""WITH {TRADES}
SELECT symbol, date_trunc('minute', trade_time) AS bucket_ts,
       arg_min(price, (trade_time, trade_id)) AS open_price,
       MIN((trade_time, trade_id))[1] AS open_time, MIN((trade_time, trade_id))[2] AS open_id,
       arg_max(price, (trade_time, trade_id)) AS close_price,
       MAX((trade_time, trade_id))[1] AS close_time, MAX((trade_time, trade_id))[2] AS close_id,
       MAX(price) AS high, MIN(price) AS low, {_total('qty')} AS volume,
       {_total('quote_qty')} AS quote_volume, COUNT(*) AS trade_count
FROM trades GROUP BY ALL""",
    "merged_prices": f"""WITH {TRADES}
SELECT symbol, arg_max(price, (trade_time, trade_id)) AS price, MAX((trade_time, trade_id))[1] AS at,
       MAX((trade_time, trade_id))[2] AS trade_id, MAX(trade_time) AS updated
FROM trades GROUP BY symbol""",
    "latest_price": f"WITH {TRADES} {_LATEST}",
    "panel_latest_price": f"WITH {TRADES} SELECT symbol, price FROM ({_LATEST})",
    "last_not_null_price": f"WITH {TRADES} SELECT symbol, arg_max(price, trade_id) AS price FROM trades GROUP BY symbol",
    "ohlcv_1m_last30": _recent(_RECENT_BARS, 30),
    "ohlcv_1m_last24h": _recent(_RECENT_BARS, 1440),
    "panel_close_1m": _recent(_RECENT_CLOSE, 30),
    "panel_close_1m_24h": _recent(_RECENT_CLOSE, 1440),
    "panel_volume_1m": _recent(_RECENT_VOLUME, 30),
    "panel_volume_1m_24h": _recent(_RECENT_VOLUME, 1440),
    "panel_trade_count_15m": _recent_count(15),
    "panel_trade_count_24h": _recent_count(1440),
    "hot_retention_7d": f"""WITH {TRADES}
SELECT symbol, trade_id, trade_time FROM trades
WHERE date_trunc('second', trade_time) + INTERVAL 7 DAY > {_AS_OF}""",
    "throttle_5s": _throttle("INTERVAL 5 SECOND"),
    "throttle_5m": _throttle("INTERVAL 5 MINUTE"),
    "throttle_us": _throttle("INTERVAL 17 MICROSECOND", "spread", _SPREAD),
    "throttle_1d": _throttle("INTERVAL 1 DAY"),
    "trades_of_symbols": f"""WITH {TRADES}
SELECT UPPER(symbol) AS symbol, trade_id, price FROM trades WHERE symbol IN ('click', 'purchase')""",
    "decoded_log": f"WITH {BRONZE} {_WIRE}",
    "hot_rows": f"""WITH {BRONZE}
SELECT trade_id, symbol, price, qty, quote_qty, trade_time, event_time, is_buyer_maker,
       event_time AS ingested_at, kafka_partition, kafka_offset, kafka_timestamp FROM bronze""",
    "feed_trades": f"""WITH {TRADES}
SELECT trade_id, symbol, price, qty, quote_qty, epoch_ms(trade_time) AS trade_time_ms,
       epoch_ms(event_time) AS event_time_ms, is_buyer_maker, TRUE AS stamped FROM trades""",
    "feed_quarantine": f"""WITH {_BROKEN}
SELECT bad_fields, preview, preview AS raw, COUNT(*) AS n FROM broken GROUP BY ALL""",
    "feed_counters": """
SELECT COUNT(*) + 9 * COUNT(*) FILTER (event_id % 40 = 0) AS received, COUNT(*) AS sent,
       8 * COUNT(*) FILTER (event_id % 40 = 0) AS errors FROM events""",
    "published_messages": _PUBLISHED,
    "klines_1h": _KLINES,
    "klines_written": _KLINES,
    "klines_quarantine": f"""WITH {TRADES},
hours AS (SELECT DISTINCT UPPER(symbol) AS symbol, date_trunc('hour', trade_time) AS opened FROM trades)
SELECT symbol, 'usable' AS verdict, NULL AS raw,
       COUNT(*) + COUNT(*) FILTER (opened = date_trunc('day', opened)) AS n FROM hours GROUP BY symbol
UNION ALL
SELECT symbol, verdict, raw, CAST(1 AS BIGINT) AS n FROM (SELECT DISTINCT symbol FROM hours), (VALUES
  ('not an array of candles', '{{"code":-1121}}'), ('not an array of candles', '[[1,"2"'),
  ('open_time_ms', '[null,"1","2","0.5","1.5","10","1","15","3","4","6","0"]'),
  ('out of range', '["1","1","2","0.5","1.5","10","1","15","3","4","6","0"]')) AS bad(verdict, raw)""",
    "market_quarantine": """
SELECT TIMESTAMP '2024-01-01 05:00:00' AS snapshot_ts, 'usable' AS verdict, NULL AS raw, COUNT(*) AS n FROM part
UNION ALL
SELECT TIMESTAMP '2024-01-01 05:00:00', verdict, raw, COUNT(*) FROM part, (VALUES
  ('id', '{"symbol":"X"}'), ('current_price', '{"id":"y","current_price":"dear","market_cap":5.0}'),
  ('not an object', 'gone')) AS bad(verdict, raw)
WHERE p_partkey % 100 = 0 GROUP BY verdict, raw""",
    "market_written": """
SELECT snapshot_ts, id, market_cap, 5 AS hour, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_ts ORDER BY market_cap DESC, id) AS rank
      FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, TIMESTAMP '2024-01-01 05:00:00' AS snapshot_ts,
                   p_retailprice * p_size AS market_cap FROM part
            UNION ALL
            SELECT CAST(p_partkey AS VARCHAR), TIMESTAMP '2024-01-01 05:15:00', -(p_retailprice * p_size)
            FROM part))
WHERE rank <= 3""",
    "market_topk": """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS symbol, p_name AS name,
       p_retailprice AS current_price, p_retailprice * p_size AS market_cap,
       CAST(p_size AS DOUBLE) AS total_volume, TIMESTAMP '2024-01-01 05:00:00' AS snapshot_ts,
       '{"category":"' || p_type || '"}' AS _rescued, DATE '2024-01-01' AS dt, '05' AS hour,
       CAST(ROW_NUMBER() OVER (ORDER BY p_retailprice * p_size DESC, CAST(p_partkey AS VARCHAR))
            AS INTEGER) AS rank
FROM part ORDER BY rank LIMIT 250""",
    "ensured_bronze": f"WITH {BRONZE} {_PROFILE}",
    "listed_schemas": f"""WITH {TRADES}, gold AS (SELECT DISTINCT symbol, date_trunc('hour', trade_time) FROM trades)
SELECT unnest(['bronze', 'silver', 'gold']) AS schema, COUNT(*) AS gold_rows FROM gold""",
    "refreshed_gold": f"WITH {SILVER} {_bars('silver', 'hour', 'bucket_hour')}",
    "published_stream": _PUBLISHED,
    "silver_incremental": f"WITH {SILVER} SELECT * FROM silver",
    "silver_incremental_ties": f"""WITH {TRADES}
SELECT trade_id, symbol, CASE WHEN trade_id % 10 = 0 THEN price + 1 ELSE price END AS price, qty, quote_qty,
       trade_time, event_time, is_buyer_maker, kafka_timestamp FROM trades""",
    "stream_bronze": f"WITH {BRONZE} {_WIRE}",
    "compacted_bronze": f"WITH {BRONZE} {_WIRE}",
    "log_after_retention": f"""WITH {TRADES},
parts AS (SELECT kafka_partition, kafka_offset,
                 kafka_offset // (SELECT MAX(kafka_offset) // 3 + 1 FROM trades) AS part FROM trades)
SELECT kafka_partition, COUNT(*) FILTER (part <> 1) AS landed, 'gone' AS kind,
       MAX(kafka_offset) FILTER (part = 0) + 1 AS first_lost,
       MIN(kafka_offset) FILTER (part = 2) - 1 AS last_lost,
       (SELECT COUNT(*) FROM parts WHERE part = 0) AS landed_at_stop
FROM parts GROUP BY kafka_partition""",
    "evolved_bronze": f"""WITH {TRADES}, bronze AS (SELECT * FROM trades)
SELECT *, CASE WHEN trade_id % 3 > 0 THEN 'v' || trade_id % 5 END AS venue,
       CASE WHEN trade_id % 3 > 0 AND trade_id % 50 > 0 THEN trade_id + 0.5::DOUBLE END AS fee,
       CASE WHEN trade_id % 3 > 0 THEN CASE WHEN trade_id % 50 = 0 THEN 'fee=none,' ELSE '' END
            || 'note={{"seen":[' || trade_id % 4 || ']}}' END AS rescued
FROM ({_WIRE})""",
    "log_quarantine": f"""
SELECT '{_ALL_FIELDS}' AS bad_fields, raw, COUNT(*) AS n
FROM events, (VALUES ('not json'), ('[]'), ('{{}}'), ('{{"trade_id":"x"}}')) AS bad(raw)
WHERE event_id % 40 = 0 GROUP BY raw""",
    "commit_history": f"""WITH {BRONZE}
SELECT CASE WHEN kafka_offset >= 1000000000 THEN trade_id // 10 % 3 WHEN trade_id % 7 = 0 THEN 2
            ELSE trade_id % 2 END AS snapshot_id, 'append' AS operation, CAST(COUNT(*) AS VARCHAR) AS added
FROM bronze GROUP BY 1""",
    "committed_rows": f"WITH {BRONZE} SELECT COUNT(*) AS added FROM bronze",
    "bronze_partitions": f"""WITH {BRONZE}
SELECT symbol, CAST(kafka_timestamp AS DATE) AS dt, CAST(1 AS BIGINT) AS files, COUNT(*) AS rows
FROM bronze GROUP BY 1, 2""",
    "two_consumers": f"""WITH {BRONZE}
SELECT symbol, COUNT(*) AS bronze_rows, COUNT(DISTINCT trade_id) AS silver_rows,
       COUNT(DISTINCT trade_id) AS hot_rows FROM bronze GROUP BY symbol""",
    "stream_hot_rows": f"""WITH {TRADES}
SELECT trade_id, symbol, price, qty, quote_qty, trade_time, event_time, is_buyer_maker FROM trades""",
    "expired_hot": f"""WITH {TRADES}
SELECT CAST(trade_time AS DATE) AS dt, COUNT(*) AS trades FROM trades
WHERE CAST(trade_time AS DATE) >= CAST({_AS_OF} - INTERVAL 7 DAY AS DATE) GROUP BY 1""",
    "stream_old_copies": f"""WITH {TRADES}
SELECT symbol, trade_id, price, qty, trade_time FROM trades
UNION ALL
SELECT symbol, -1 - trade_id, price, qty, trade_time - INTERVAL 730 DAY FROM trades WHERE trade_id % 20 = 0""",
    "compacted_hot": f"""WITH {TRADES}
SELECT * RENAME (open AS open_price, close AS close_price) FROM ({_bars('trades', 'minute', 'bucket_ts')})""",
    "tiered_bronze": f"WITH {BRONZE} {_WIRE}",
    "wide_amounts": f"""WITH {BRONZE}, wide AS (
  SELECT symbol, qty * 5e18 AS wide, concat_ws(',', CASE WHEN qty * 5e18 >= 1e20 THEN 'qty' END,
         CASE WHEN qty * 3e18 >= 1e20 THEN 'quote_qty' END) AS bad FROM bronze),
-- The shortest decimal text of a double is what it stands for.
counted AS (SELECT *, CAST(CAST(wide AS VARCHAR) AS DECIMAL(38,8)) AS amount FROM wide)
SELECT symbol, CASE WHEN bad = '' THEN 'usable' ELSE bad END AS verdict, COUNT(*) AS n,
       CAST(SUM(CASE WHEN bad = '' THEN amount END) AS VARCHAR) AS volume, CAST(SUM(amount) AS VARCHAR) AS "all"
FROM counted GROUP BY 1, 2""",
    "bucketed_silver": f"WITH {SILVER} SELECT * FROM silver",
    "expired_rows": f"""WITH {TRADES}, left_minutes AS (
  SELECT MIN(date_trunc('minute', trade_time)) AS first_minute, COUNT(*) AS in_minutes FROM trades
  WHERE date_trunc('minute', trade_time) + INTERVAL 7 DAY > {_AS_OF})
SELECT symbol, trade_id, trade_time, first_minute, CAST(in_minutes AS BIGINT) AS in_minutes
FROM trades, left_minutes WHERE date_trunc('second', trade_time) + INTERVAL 7 DAY > {_AS_OF}""",
    "stream_ohlcv_1m": f"WITH {TRADES} {_bars('trades', 'minute', 'bucket_ts')}",
    "stream_latest_price": f"WITH {TRADES} {_LATEST}",
    "stream_price_updates": f"WITH {TRADES} {_LATEST}",
    "stream_windowed_bars": f"WITH {TRADES} {_bars('trades', 'minute', 'bucket_ts')}",
    "throttle_counters": f"""
SELECT symbol, received, sent, received - sent AS throttled
FROM (SELECT event_type AS symbol, COUNT(*) AS received FROM events GROUP BY 1)
JOIN (SELECT symbol, COUNT(*) AS sent FROM ({_throttle('INTERVAL 5 MINUTE')}) GROUP BY 1) USING (symbol)""",
    "stream_throttle_5m": _throttle("INTERVAL 5 MINUTE"),
    "stream_dedup": f"""WITH {TRADES}, bronze AS (SELECT * FROM trades)
SELECT * EXCLUDE (kafka_offset, kafka_timestamp) FROM ({_WIRE})""",
    "unique_bronze": f"""WITH {BRONZE}
SELECT symbol, trade_id, COUNT(*) AS n FROM bronze GROUP BY ALL HAVING COUNT(*) > 1""",
    "unique_gold": f"""WITH {SILVER}
SELECT symbol, bucket_hour, COUNT(*) AS n FROM ({_bars('silver', 'hour', 'bucket_hour')})
GROUP BY ALL HAVING COUNT(*) > 1""",
    "not_null_gold": f"""WITH {SILVER}, gold AS ({_bars('silver', 'hour', 'bucket_hour')})
SELECT column_name, n FROM (
  SELECT 'symbol' AS column_name, COUNT(*) FILTER (symbol IS NULL) AS n FROM gold
  UNION ALL SELECT 'bucket_hour', COUNT(*) FILTER (bucket_hour IS NULL) FROM gold) WHERE n > 0""",
    "relationship_orders": """
SELECT l_orderkey AS "value", COUNT(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
    "relationship_lines": """
SELECT o_orderkey AS "value", COUNT(*) AS n FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""",
}
