"""The same results as the catalog's queries, in SQL for DuckDB."""

from __future__ import annotations

_TRADES = """t AS (
  SELECT event_id, event_type AS symbol, ts, value AS price,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity
  FROM events)"""

_EPOCH = "TIMESTAMP '1970-01-01'"


def _start(seconds: int, column: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{seconds} seconds', {column}, {_EPOCH})"


def _cents(trades: str, price: str) -> str:
    return trades.replace(f"{price} AS price", f"round({price} * 100) AS price")


def _vwap(
    length: int,
    slide: int,
    trades: str = _TRADES,
    where: str = "TRUE",
    having: str = "TRUE",
    number: str = "DECIMAL(18,4)",
) -> str:
    """A chain of CTEs ending in m(window_end, symbol, vwap, total_volume)."""
    steps = -(-length // slide)
    return f"""{trades},
x AS (
  SELECT symbol, ts, CAST(price AS {number}) AS p, CAST(quantity AS {number}) AS q,
         {_start(slide)} - i.k * INTERVAL '{slide} seconds' AS ws
  FROM t, (SELECT unnest(range({steps})) AS k) i
  WHERE {where}),
m AS (
  SELECT ws + INTERVAL '{length} seconds' AS window_end, symbol,
         CAST(sum(p * q) AS DOUBLE) / nullif(CAST(sum(q) AS DOUBLE), 0) AS vwap,
         CAST(sum(q) AS DOUBLE) AS total_volume
  FROM x WHERE ts < ws + INTERVAL '{length} seconds'
  GROUP BY ws, symbol
  HAVING {having})"""


def _prices(length: int, order: str = "(ts, event_id)", trades: str = _TRADES) -> str:
    """A chain of CTEs ending in f(window_start, window_end, symbol, first, last)."""
    return f"""{trades},
f AS (
  SELECT {_start(length)} AS window_start,
         {_start(length)} + INTERVAL '{length} seconds' AS window_end, symbol,
         arg_min(price, {order}) AS first_price, arg_max(price, {order}) AS last_price
  FROM t GROUP BY ALL)"""


def _alerts(
    length: int, threshold: float, order: str = "(ts, event_id)", trades: str = _TRADES
) -> str:
    """A chain of CTEs ending in a(window_start, window_end, symbol, ..., percent_change)."""
    return f"""{_prices(length, order, trades)},
c AS (
  SELECT *, CASE WHEN first_price = 0 THEN 0.0
                 ELSE (last_price - first_price) / first_price * 100.0 END AS percent_change
  FROM f),
a AS (SELECT * FROM c WHERE abs(percent_change) > {threshold})"""


_METRIC = "window_end, symbol, vwap, total_volume"
_PASSED = "ws + INTERVAL '{0} seconds' <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'"
_HOUR, _HALF, _TEN = 3600, 1800, 600


def _wide(value: str) -> str:
    kinds = ("click", "error", "purchase", "signup", "view")
    return ", ".join(f"max({value}) FILTER (WHERE symbol = '{k}') AS {k}" for k in kinds)


_LINEITEM = """t AS (
  SELECT l_returnflag || l_linestatus AS symbol, l_shipdate AS ts,
         l_extendedprice AS price, l_quantity AS quantity
  FROM lineitem)"""
_ORDERS = """t AS (
  SELECT o_orderkey AS event_id, o_orderpriority AS symbol, o_orderdate AS ts,
         o_totalprice AS price
  FROM orders)"""

_TICKS = f"""{_TRADES},
k AS (
  SELECT {_start(_HOUR)} + INTERVAL '1 hour' AS window_end, symbol, price AS vwap,
         quantity AS total_volume, event_id AS arrival
  FROM t)"""
_DELIVERED = f"""{_alerts(_HOUR, 1.0)},
d AS (
  SELECT *, CAST(window_end AS DATE) AS refresh FROM a
  UNION ALL
  SELECT *, CAST(window_end AS DATE) + 1 AS refresh FROM a),
s AS (
  SELECT window_start, window_end, symbol, first_price, last_price, percent_change,
         min(refresh) AS refresh
  FROM d GROUP BY ALL)"""
_KEEP_LAST_TICK = f"""WITH {_TICKS}
SELECT window_end, symbol, arg_max(vwap, arrival) AS vwap,
       arg_max(total_volume, arrival) AS total_volume{{extra}}
FROM k GROUP BY window_end, symbol"""

_MONTH, _THIRD = 30 * 86400, 10 * 86400
_CENTS = _vwap(30, 10, _cents(_TRADES, "value"), number="DOUBLE")
_LINEITEM_CENTS = _vwap(_MONTH, _THIRD, _cents(_LINEITEM, "l_extendedprice"), number="DOUBLE")
# Error events carry no symbol in the feed, so the watermark does not see them either.
_NAMED_PASSED = _vwap(
    _HALF,
    _TEN,
    where="symbol <> 'error'",
    having=_PASSED.format(_HALF).replace("events", "events WHERE event_type <> 'error'"),
)

# Of every nine trades, six have something wrong with them.
_BAD = """t AS (
  SELECT event_id, event_type AS symbol, ts,
         CASE WHEN event_id % 9 IN (3, 4) THEN NULL ELSE value END AS price,
         CASE WHEN event_id % 9 IN (5, 6) THEN NULL
              ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS quantity
  FROM events WHERE event_id % 9 NOT IN (1, 2))"""
# A first or last price may be a missing one, which arg_min over the price alone would skip.
_MOMENT = "(date_trunc('milliseconds', ts), event_id)"
_BAD_CHANGES = f"""{_BAD},
f AS (
  SELECT {_start(_HOUR)} AS window_start, {_start(_HOUR)} + INTERVAL '1 hour' AS window_end,
         symbol, arg_min({{'p': price}}, {_MOMENT}).p AS first_price,
         arg_max({{'p': price}}, {_MOMENT}).p AS last_price
  FROM t GROUP BY ALL),
c AS (
  SELECT *, CASE WHEN first_price = 0 THEN 0.0
                 ELSE (last_price - first_price) / first_price * 100.0 END AS percent_change
  FROM f)"""
_MANY = _TRADES.replace("event_type AS symbol", "event_type || '_' || (event_id % 12) AS symbol")
_MANY_COLUMNS = ", ".join(
    f"max(total_volume) FILTER (WHERE symbol = '{kind}_{n}') AS {kind}_{n}"
    for kind in ("click", "error", "purchase", "signup", "view")
    for n in range(11)
)
# Events other than errors come first and move the watermark; errors come for what is left.
_FIRST_WATERMARK = """(SELECT max(date_trunc('milliseconds', ts)) FROM events
  WHERE event_type <> 'error') - INTERVAL '1 minute'"""
_WINDOW_END = f"{_start(_TEN)} - i.k * INTERVAL '{_TEN} seconds' + INTERVAL '{_HALF} seconds'"
_LATE = _vwap(
    _HALF,
    _TEN,
    where=f"(symbol <> 'error' OR {_WINDOW_END} > {_FIRST_WATERMARK})",
    having=_PASSED.format(_HALF).replace("max(ts)", "max(date_trunc('milliseconds', ts))"),
)

_SQL: dict[str, str] = {
    "wide_many_symbols": f"""WITH {_vwap(_HOUR, _HOUR, _MANY)}
SELECT window_end, {_MANY_COLUMNS}, CAST(NULL AS DOUBLE) AS absent
FROM m WHERE NOT ends_with(symbol, '_11') GROUP BY window_end""",
    "alerts_with_bad_trades": f"""WITH {_BAD_CHANGES}
SELECT * FROM c WHERE abs(percent_change) > 1.0""",
    "vwap_with_bad_trades": f"WITH {_vwap(_HOUR, _HOUR, _BAD)} SELECT {_METRIC} FROM m",
    "quarantine_bad_trades": """SELECT event_id AS "offset", CASE
  WHEN event_id % 9 IN (1, 2) THEN 'no event time'
  WHEN event_id % 9 IN (3, 4) THEN 'price is no number'
  ELSE 'quantity is no number' END AS reason
FROM events WHERE event_id % 9 BETWEEN 1 AND 6""",
    "decode_tails": """SELECT doc_id AS "offset", md5(text) AS symbol_md5
FROM documents WHERE doc_id % 8 IN (0, 1)""",
    "stream_late_trades": f"WITH {_LATE} SELECT {_METRIC} FROM m",
    "stream_new_alert_counts": f"""WITH {_alerts(_HOUR, 1.0)},
d AS (SELECT day(window_end) AS d FROM a)
SELECT 0::BIGINT AS batch_id, count(*) FILTER (WHERE d > 20) AS records,
       count(*) FILTER (WHERE d > 20) AS new_alerts FROM d
UNION ALL SELECT 1, count(*), count(*) FILTER (WHERE d <= 20) FROM d
UNION ALL SELECT 2, count(*) FILTER (WHERE d > 10 AND d <= 20), 0 FROM d""",

    "vwap_sliding_default": f"WITH {_vwap(30, 10)} SELECT {_METRIC} FROM m",
    "vwap_sliding_30m": f"WITH {_vwap(_HALF, _TEN)} SELECT {_METRIC} FROM m",
    "vwap_uneven_windows": f"WITH {_vwap(1500, _TEN)} SELECT {_METRIC} FROM m",
    "vwap_valid_trades": f"WITH {_vwap(_HOUR, _HOUR, where='price <> 0')} SELECT {_METRIC} FROM m",
    "vwap_from_json": f"WITH {_vwap(30, 10)} SELECT {_METRIC} FROM m",
    "vwap_lineitem": f"WITH {_vwap(_MONTH, _THIRD, _LINEITEM)} SELECT {_METRIC} FROM m",
    "vwap_cents": f"WITH {_CENTS} SELECT {_METRIC} FROM m",
    "vwap_lineitem_cents": f"WITH {_LINEITEM_CENTS} SELECT {_METRIC} FROM m",
    "symbol_subset_vwap": f"""WITH {_vwap(_HALF, _TEN, where="symbol IN ('click', 'purchase')")}
SELECT {_METRIC} FROM m""",
    "volume_tumbling": f"WITH {_vwap(10, 10)} SELECT window_end, symbol, total_volume FROM m",
    "first_last_price": f"WITH {_prices(_TEN)} SELECT * FROM f",
    "first_last_arrival": f"WITH {_prices(_HOUR, 'event_id')} SELECT * FROM f",
    "volatility_alerts_default": f"WITH {_alerts(10, 1.0)} SELECT * FROM a",
    "volatility_alerts_1h": f"WITH {_alerts(_HOUR, 1.0)} SELECT * FROM a",
    "volatility_alerts_arrival": f"WITH {_alerts(_HALF, 5.0, 'event_id')} SELECT * FROM a",
    "order_alerts": f"WITH {_alerts(86400, 10.0, trades=_ORDERS)} SELECT * FROM a",
    "panes_to_vwap": f"WITH {_vwap(_HALF, _TEN)} SELECT {_METRIC} FROM m",
    "panes_to_alerts": f"WITH {_alerts(_HOUR, 1.0, 'event_id')} SELECT * FROM a",
    "parse_trades_json": f"""WITH {_TRADES}
SELECT symbol, date_trunc('milliseconds', ts) AS event_time, price, quantity,
       price * quantity AS volume_price, event_id AS "offset"
FROM t""",
    "unwrap_envelope": f"""WITH {_TRADES}
SELECT symbol || '@trade' AS stream, epoch_ms(date_trunc('milliseconds', ts)) AS event_ms,
       CASE WHEN symbol <> 'error' THEN symbol END AS symbol,
       CAST(event_id AS VARCHAR) AS trade_id, CAST(price AS VARCHAR) AS price,
       CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity
FROM t""",
    "validate_trades": """SELECT event_id AS "offset", event_type AS s
FROM events WHERE event_type <> 'error'""",
    "rejected_trades": """SELECT event_id AS "offset", event_type || '@trade' AS stream
FROM events WHERE event_type = 'error'""",
    "default_fill": f"""WITH {_TRADES}
SELECT CAST(event_id AS VARCHAR) AS trade_id,
       CASE WHEN symbol <> 'error' THEN symbol ELSE 'N/A' END AS symbol,
       CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity
FROM t""",
    "default_fill_each": f"""WITH {_TRADES}
SELECT CASE WHEN event_id % 6 IN (0, 4) THEN 'N/A' ELSE CAST(event_id AS VARCHAR) END AS trade_id,
       CASE WHEN symbol = 'error' OR event_id % 6 IN (1, 4) THEN 'N/A' ELSE symbol END AS symbol,
       CASE WHEN event_id % 6 IN (2, 4) THEN '-1' ELSE CAST(price AS VARCHAR) END AS price,
       CASE WHEN event_id % 6 IN (3, 4) THEN '-1'
            ELSE CAST(CAST(quantity AS BIGINT) AS VARCHAR) END AS quantity
FROM t""",
    "quarantine_messages": """SELECT 'envelopes' AS topic, event_id AS "offset",
       'no symbol' AS reason FROM events
UNION ALL
SELECT 'documents', doc_id, CASE WHEN json_valid(text) THEN 'no symbol' ELSE 'malformed' END
FROM documents""",
    "metric_messages": f"WITH {_vwap(_HALF, _TEN)} SELECT symbol AS key, {_METRIC} FROM m",
    "alert_messages": f"WITH {_alerts(_HOUR, 1.0)} SELECT symbol AS key, * FROM a",
    "raw_trade_messages": f"""WITH {_TRADES}
SELECT symbol AS key, epoch_ms(date_trunc('milliseconds', ts)) AS event_ms, event_id AS trade_id, symbol,
       CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity
FROM t WHERE symbol <> 'error'""",
    "decode_payload": f"WITH {_vwap(_HOUR, _HOUR)} SELECT {_METRIC}, symbol AS key FROM m",
    "coerce_types": f"""WITH {_TRADES}
SELECT event_id, ts AS window_end, CASE WHEN symbol <> 'click' THEN price END AS vwap,
       CASE WHEN symbol <> 'error' THEN quantity END AS total_volume
FROM t WHERE symbol <> 'view'""",
    "append_batches": f"""SELECT * FROM (WITH {_vwap(_HOUR, _HOUR)} SELECT {_METRIC} FROM m)
UNION ALL BY NAME
SELECT * FROM (WITH {_vwap(_HALF, _HALF)} SELECT window_end, symbol, total_volume FROM m)""",
    "dedupe_keep_last": _KEEP_LAST_TICK.format(extra=", max(arrival) AS arrival"),
    "upsert_metrics": _KEEP_LAST_TICK.format(extra=', max(arrival) AS "offset"'),
    "latest_per_symbol": f"""WITH {_vwap(_HALF, _TEN)}
SELECT symbol, vwap, total_volume, window_end FROM m
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1""",
    "latest_nonnull_per_symbol": f"""WITH {_vwap(30, 10)}
SELECT symbol, arg_max(vwap, window_end) FILTER (WHERE vwap IS NOT NULL) AS vwap,
       arg_max(total_volume, window_end) FILTER (WHERE total_volume IS NOT NULL)
         AS total_volume,
       max(window_end) AS window_end
FROM m GROUP BY symbol""",
    "record_counts": f"WITH {_vwap(30, 10)} SELECT count(*) AS records FROM m",
    "vwap_pivot": f"""WITH {_vwap(_HALF, _TEN)}
SELECT window_end, {_wide('vwap')} FROM m GROUP BY window_end""",
    "volume_pivot": f"""WITH {_vwap(_HALF, _TEN)}
SELECT window_end, {_wide('total_volume')} FROM m GROUP BY window_end""",
    "metric_series": f"""WITH {_vwap(_HOUR, _HOUR)}
SELECT {_METRIC} FROM m ORDER BY window_end, symbol""",
    "metric_listing": f"""WITH {_vwap(_HOUR, _TEN)}
SELECT {_METRIC} FROM m ORDER BY window_end DESC, symbol""",
    "recent_alerts": f"""WITH {_alerts(_HOUR, 1.0)}
SELECT window_end, symbol, percent_change, first_price, last_price FROM a
ORDER BY window_end DESC, symbol""",
    "alert_listing": f"""WITH {_alerts(_HALF, 1.0)}
SELECT symbol, percent_change, first_price, last_price, window_end FROM a
ORDER BY window_end DESC, symbol""",
    "alert_keys": f"""WITH {_alerts(_HOUR, 1.0)}
SELECT symbol || '_' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS alert_key
FROM a""",
    "alert_lines": f"""WITH {_alerts(_HOUR, 1.0)}
SELECT window_end, symbol,
       symbol || ': ' || printf('%.2f', percent_change) || '% change ('
         || CAST(first_price AS VARCHAR) || ' -> ' || CAST(last_price AS VARCHAR)
         || ') at ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '+00:00' AS line
FROM a""",
    "new_alerts": f"""WITH {_alerts(_HOUR, 1.0)}
SELECT * FROM a
WHERE NOT EXISTS (
  SELECT 1 FROM c
  WHERE c.symbol = a.symbol AND c.window_end = a.window_end AND abs(c.percent_change) > 20.0)""",
    "first_shown_alerts": f"WITH {_DELIVERED} SELECT * FROM s",
    "new_alert_count": f"""WITH {_DELIVERED}
SELECT r.refresh, count(s.refresh) AS new_alerts
FROM (SELECT DISTINCT refresh FROM d) r LEFT JOIN s ON s.refresh = r.refresh
GROUP BY r.refresh""",
    "stream_vwap_append": f"""WITH {_vwap(30, 10, having=_PASSED.format(30))}
SELECT {_METRIC} FROM m""",
    "stream_vwap_chained": f"""WITH {_vwap(30, 10, having=_PASSED.format(30))}
SELECT {_METRIC} FROM m""",
    "stream_open_windows": f"""WITH {_vwap(_HALF, _TEN, having="NOT " + _PASSED.format(_HALF).replace(
        "max(ts)", "max(date_trunc('milliseconds', ts))"))}
SELECT {_METRIC} FROM m""",
    "stream_bounded_refreshes": f"""WITH {_TRADES}
SELECT symbol, count(*) AS trades, count(*) AS distinct_trades FROM t GROUP BY symbol""",
    "stream_vwap_update": f"WITH {_vwap(_HALF, _TEN)} SELECT {_METRIC} FROM m",
    "stream_vwap_complete": f"WITH {_vwap(_HOUR, _HOUR)} SELECT {_METRIC} FROM m",
    "stream_pivot_complete": f"""WITH {_vwap(_HOUR, _HOUR)}
SELECT window_end, {_wide('total_volume')} FROM m GROUP BY window_end""",
    "stream_pivot_append": f"""WITH {_vwap(_HOUR, _HOUR)}
SELECT window_end, {_wide('total_volume')} FROM m
WHERE window_end <= (SELECT max(window_end) FROM m) - INTERVAL '1 hour' GROUP BY window_end""",
    "stream_alerts_append": f"""WITH {_alerts(_HOUR, 1.0, 'event_id')}
SELECT * FROM a WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'""",
    "stream_raw_trades": f"""WITH {_TRADES}
SELECT symbol AS key, date_trunc('milliseconds', ts) AS event_time, price, quantity
FROM t WHERE symbol <> 'error'""",
    "stream_new_alerts": f"WITH {_alerts(_HOUR, 1.0)} SELECT * FROM a",
    "stream_to_latest": f"""WITH {_NAMED_PASSED}
SELECT symbol, vwap, total_volume, window_end FROM m
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC) = 1""",
    "stream_results_log": f"WITH {_vwap(_HOUR, _HOUR)} SELECT {_METRIC} FROM m",
    "stream_fan_out": f"""WITH {_vwap(_HALF, _TEN, having=_PASSED.format(_HALF))}
SELECT {_METRIC} FROM m""",
}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
