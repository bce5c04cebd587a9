"""The same results in plain SQL (DuckDB dialect), written from the rules rather than the plans."""

from __future__ import annotations

DAY_US, HOUR_US, WEEK_US = 86_400_000_000, 3_600_000_000, 604_800_000_000

EVENT_TICKS = """
ticks AS (
  SELECT upper(event_type) AS symbol, value AS price, json_extract_string(props, '$.k')::DOUBLE AS quantity,
         ts AS trade_time, CASE WHEN event_id % 2 = 1 THEN 'sell' ELSE 'buy' END AS side, 'binance' AS source,
         event_id AS seq, epoch_us(ts) AS at_us
  FROM events
  WHERE value > 0 AND json_extract_string(props, '$.k')::DOUBLE > 0
)"""

ORDER_TICKS = """
ticks AS (
  SELECT upper(o_orderpriority) AS symbol, o_totalprice AS price, 1.0::DOUBLE AS quantity,
         o_orderdate AS trade_time, o_orderkey AS seq, epoch_us(o_orderdate) AS at_us
  FROM orders
)"""

# Arrival order differs from time order; the newest time seen so far is the clock.
SHUFFLED_TICKS = EVENT_TICKS.replace("ticks AS", "in_order AS") + """,
arrived AS (
  SELECT * REPLACE ((seq // 16) * 16 + ((seq % 16) * 5 + 3) % 16 AS seq) FROM in_order
),
ticks AS (
  SELECT * REPLACE (max(at_us) OVER (PARTITION BY symbol ORDER BY seq) AS at_us), at_us AS own_time FROM arrived
)"""


SMALL_TICKS = EVENT_TICKS.replace("ticks AS", "usual AS") + """,
ticks AS (SELECT * REPLACE (price * 1e-10::DOUBLE AS price, quantity * 1e-9::DOUBLE AS quantity) FROM usual)"""


def deviation(n="n", s1="s1", s2="s2") -> str:
    """Population deviation in units: squares about the whole-number mean, less the rest of that mean squared."""
    return f"""sqrt(greatest(0.0::DOUBLE, ({s2} - ({s1}::HUGEINT // {n}) * ({s1} + {s1}::HUGEINT % {n}))::DOUBLE / {n}::DOUBLE
            - ({s1}::HUGEINT % {n})::DOUBLE / {n}::DOUBLE * (({s1}::HUGEINT % {n})::DOUBLE / {n}::DOUBLE)))"""


def stats(n="n", s1="s1", s2="s2", pv="pv", qv="qv", seconds=86400.0) -> str:
    """Statistics columns from sums of cents and whole quantities."""
    return f"""
       CASE WHEN {qv} > 0 THEN {pv}::DOUBLE / {qv}::DOUBLE / 100.0::DOUBLE ELSE {s1}::DOUBLE / {n}::DOUBLE / 100.0::DOUBLE END AS vwap,
       {s1}::DOUBLE / {n}::DOUBLE / 100.0::DOUBLE AS mean_price,
       {deviation(n, s1, s2)} / 100.0::DOUBLE AS stdev_price,
       {n}::BIGINT AS sample_count, {float(seconds)}::DOUBLE AS window_seconds"""


def windowed(ticks: str, window_us: int) -> str:
    """``w``: every tick with its statistics. Equal times are told apart by their arrival rank."""
    return f"""{ticks},
ranked AS (
  SELECT *, round(price * 100)::HUGEINT AS pc, round(quantity)::HUGEINT AS qc,
         at_us::HUGEINT * 65536 + row_number() OVER (PARTITION BY symbol ORDER BY at_us, seq)
           - rank() OVER (PARTITION BY symbol ORDER BY at_us) AS place
  FROM ticks
),
sums AS (
  SELECT *, count(*) OVER win AS n, sum(pc) OVER win AS s1, sum(pc * pc) OVER win AS s2,
         sum(pc * qc) OVER win AS pv, sum(qc) OVER win AS qv
  FROM ranked
  WINDOW win AS (PARTITION BY symbol ORDER BY place
                 RANGE BETWEEN {window_us}::HUGEINT * 65536 + 32768 PRECEDING AND CURRENT ROW)
),
w AS (SELECT *, {stats(seconds=window_us / 1e6)} FROM sums)"""


def own_scale(ticks: str, window_us: int) -> str:
    """``w`` where each symbol counts in units of its own: 15 digits of its largest price and quantity."""
    power = "('1e' || (14 - floor(log10(max({}) OVER (PARTITION BY symbol)))::INTEGER))::DOUBLE"
    seconds = window_us / 1e6
    return f"""{ticks},
scaled AS (SELECT *, {power.format("price")} AS pu, {power.format("quantity")} AS qu FROM ticks),
ranked AS (
  SELECT *, round_even(price * pu, 0)::HUGEINT AS pc, round_even(quantity * qu, 0)::HUGEINT AS qc,
         at_us::HUGEINT * 65536 + row_number() OVER (PARTITION BY symbol ORDER BY at_us, seq)
           - rank() OVER (PARTITION BY symbol ORDER BY at_us) AS place
  FROM scaled
),
sums AS (
  SELECT *, count(*) OVER win AS n, sum(pc) OVER win AS s1, sum(pc * pc) OVER win AS s2,
         sum(pc * qc) OVER win AS pv, sum(qc) OVER win AS qv
  FROM ranked
  WINDOW win AS (PARTITION BY symbol ORDER BY place
                 RANGE BETWEEN {window_us}::HUGEINT * 65536 + 32768 PRECEDING AND CURRENT ROW)
),
w AS (
  SELECT *, pv::DOUBLE / qv::DOUBLE / pu AS vwap, s1::DOUBLE / n::DOUBLE / pu AS mean_price, {deviation()} / pu AS stdev_price,
         n::BIGINT AS sample_count, {seconds}::DOUBLE AS window_seconds
  FROM sums
)"""


STAT_COLUMNS = "vwap, mean_price, stdev_price, sample_count, window_seconds"

def scored(ticks: str) -> str:
    """``p``: every tick with statistics of a day, z-score, flag and day."""
    return windowed(ticks, DAY_US) + """,
z AS (
  SELECT *, CASE WHEN sample_count < 5 OR stdev_price <= 0 THEN 0.0::DOUBLE ELSE (price - mean_price) / stdev_price END AS zscore
  FROM w
),
p AS (
  SELECT *, abs(zscore) > 3.0 AS is_anomaly, CASE WHEN abs(zscore) > 3.0 THEN zscore END AS anomaly_zscore,
         strftime(trade_time, '%Y-%m-%d') AS partition_key
  FROM z
)"""


SCORED = scored(EVENT_TICKS)

PROCESSED = f"""WITH {SCORED}
SELECT symbol, price, quantity, trade_time, side, {STAT_COLUMNS}, is_anomaly, anomaly_zscore, seq FROM p"""

STORED_COLUMNS = """symbol, price, quantity, side, vwap, mean_price, stdev_price, sample_count,
       is_anomaly::INTEGER AS is_anomaly, anomaly_zscore, partition_key"""

ISO = """strftime(trade_time, '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN epoch_us(trade_time) % 1000000 = 0 THEN '' ELSE '.' || lpad((epoch_us(trade_time) % 1000000)::VARCHAR, 6, '0') END"""

MESSAGE_FIELDS = """
e AS (
  SELECT event_id AS seq, event_type, value AS price, json_extract_string(props, '$.k')::INTEGER AS k, ts,
         event_id % 2 = 1 AS sell, event_type = 'error' AS bad
  FROM events
)"""

EXCHANGE_REASON = """
r AS (
  SELECT *, CASE
    WHEN bad AND k < 10 THEN 'bad_json'
    WHEN bad AND k < 20 THEN 'null_value'
    WHEN bad AND k < 30 THEN 'bad_json'
    WHEN bad AND k < 40 THEN 'symbol_invalid'
    WHEN bad AND k BETWEEN 80 AND 89 THEN 'not_object'
    WHEN bad AND k BETWEEN 50 AND 59 THEN 'price_invalid'
    WHEN price <= 0 THEN 'price_nonpositive'
    WHEN bad AND k BETWEEN 60 AND 69 THEN 'quantity_invalid'
    WHEN k <= 0 THEN 'quantity_nonpositive'
    WHEN bad AND k BETWEEN 70 AND 79 THEN 'time_invalid'
  END AS reject_reason FROM e
)"""

CANONICAL_REASON = """
r AS (
  SELECT *, CASE
    WHEN bad AND k BETWEEN 60 AND 79 THEN 'bad_utf8'
    WHEN price <= 0 OR (bad AND k BETWEEN 40 AND 59) THEN 'price_nonpositive'
    WHEN k <= 0 THEN 'quantity_nonpositive'
    WHEN bad AND k BETWEEN 20 AND 39 THEN 'time_invalid'
    WHEN bad AND k < 20 THEN 'side_invalid'
  END AS reject_reason FROM e
)"""

REJECT_COUNT = "SELECT reject_reason, count(*) AS messages, '{form}' AS form FROM ({body}) WHERE reject_reason IS NOT NULL GROUP BY reject_reason"


def _percentile(q: float) -> str:
    return f"min(late_us) FILTER (place = floor(n * {q}::DOUBLE))"


def _snapshot(rows: str) -> str:
    return f"""last_window AS ({rows}),
got AS (
  SELECT symbol, count(*) AS n, sum(round(price * 100)::HUGEINT) AS s1,
         sum(round(price * 100)::HUGEINT * round(price * 100)::HUGEINT) AS s2,
         sum(round(price * 100)::HUGEINT * round(quantity)::HUGEINT) AS pv, sum(round(quantity)::HUGEINT) AS qv
  FROM last_window GROUP BY symbol
)"""


ORACLE: dict[str, str] = {
    "parse_exchange": f"""WITH {MESSAGE_FIELDS}, {EXCHANGE_REASON}
SELECT CASE WHEN bad AND k BETWEEN 40 AND 49 THEN '' ELSE upper(event_type) END AS symbol, price, k::DOUBLE AS quantity,
       date_trunc('milliseconds', ts) AS trade_time, CASE WHEN (bad AND k >= 90) OR sell THEN 'sell' ELSE 'buy' END AS side, 'binance' AS source, seq
FROM r WHERE reject_reason IS NULL""",
    "landed_messages": f"""WITH {MESSAGE_FIELDS}, {EXCHANGE_REASON}
SELECT CASE WHEN bad AND k BETWEEN 40 AND 49 THEN '' ELSE upper(event_type) END AS symbol, price, k::DOUBLE AS quantity,
       date_trunc('milliseconds', ts) AS trade_time, CASE WHEN (bad AND k >= 90) OR sell THEN 'sell' ELSE 'buy' END AS side, 'binance' AS source,
       row_number() OVER (PARTITION BY CASE WHEN bad AND k BETWEEN 40 AND 49 THEN '' ELSE upper(event_type) END ORDER BY seq) AS arrival
FROM r WHERE reject_reason IS NULL""",
    "quarantine": f"""WITH {MESSAGE_FIELDS}, {EXCHANGE_REASON},
f AS (
  SELECT *, CASE WHEN bad AND k BETWEEN 30 AND 39 THEN '5' WHEN bad AND k BETWEEN 40 AND 49 THEN '"  "' ELSE '"' || event_type || '"' END AS s,
         CASE WHEN bad AND k BETWEEN 50 AND 59 THEN 'abc' ELSE price::VARCHAR END AS p,
         CASE WHEN bad AND k BETWEEN 60 AND 69 THEN 'null' ELSE k::VARCHAR END AS q,
         CASE WHEN bad AND k BETWEEN 70 AND 79 THEN '"' || (epoch_us(ts) // 1000) || '"' ELSE (epoch_us(ts) // 1000)::VARCHAR END AS t,
         CASE WHEN bad AND k >= 90 THEN '"false"' WHEN sell THEN 'true' ELSE 'false' END AS m
  FROM r
),
g AS (SELECT *, '{{"s":' || s || ',"p":"' || p || '","q":' || q || ',"T":' || t || ',"m":' || m || '}}' AS message FROM f)
SELECT seq, reject_reason,
       CASE WHEN bad AND k < 10 THEN 'not json' WHEN bad AND k < 20 THEN NULL WHEN bad AND k < 30 THEN message || ' x'
            WHEN bad AND k BETWEEN 80 AND 89 THEN '[' || message || ']' ELSE message END AS value
FROM g WHERE reject_reason IS NOT NULL""",
    "parse_canonical": f"""WITH {MESSAGE_FIELDS}, {CANONICAL_REASON}
SELECT upper(event_type) AS symbol, price, k::DOUBLE AS quantity,
       CASE WHEN event_type = 'signup' THEN date_trunc('milliseconds', ts) ELSE ts END AS trade_time,
       CASE WHEN sell THEN 'sell' ELSE 'buy' END AS side, CASE WHEN bad THEN 'binance' ELSE 'feed' END AS source, seq
FROM r WHERE reject_reason IS NULL""",
    "reject_counts": REJECT_COUNT.format(form="exchange", body=f"WITH {MESSAGE_FIELDS}, {EXCHANGE_REASON} SELECT * FROM r")
    + "\nUNION ALL\n"
    + REJECT_COUNT.format(form="canonical", body=f"WITH {MESSAGE_FIELDS}, {CANONICAL_REASON} SELECT * FROM r"),
    "topic_records": f"""WITH {EVENT_TICKS}
SELECT symbol AS key, symbol, price, quantity, {ISO} || 'Z' AS trade_time, side, source, 'market-data-raw' AS topic, seq AS "offset",
       trade_time AS "timestamp", true AS one_partition, true AS known_partition
FROM ticks""",
    "topic_roundtrip": f"WITH {EVENT_TICKS} SELECT symbol, price, quantity, trade_time, side, source, seq FROM ticks",
    "symbol_filter": f"""WITH {EVENT_TICKS}
SELECT symbol, price, quantity, trade_time, side, source, seq FROM ticks WHERE symbol IN ('PURCHASE', 'VIEW', 'CLICK')""",
    "symbol_lists": "SELECT o_orderkey, upper(o_orderpriority) || '|' || upper(o_orderstatus) AS symbols FROM orders",
    "rolling_stats_events": f"WITH {windowed(EVENT_TICKS, DAY_US)} SELECT symbol, seq, {STAT_COLUMNS} FROM w",
    "rolling_stats_short": f"WITH {windowed(EVENT_TICKS, HOUR_US)} SELECT symbol, seq, {STAT_COLUMNS} FROM w",
    "rolling_stats_orders": f"WITH {windowed(ORDER_TICKS, WEEK_US)} SELECT symbol, seq, {STAT_COLUMNS} FROM w",
    "rolling_stats_large": f"""WITH {own_scale(ORDER_TICKS.replace("o_totalprice AS price", "o_totalprice * 1e6::DOUBLE AS price"), WEEK_US)}
SELECT symbol, seq, {STAT_COLUMNS} FROM w""",
    "rolling_stats_small": f"""WITH {own_scale(SMALL_TICKS, DAY_US)} SELECT symbol, seq, {STAT_COLUMNS} FROM w""",
    "arrival_stats": f"WITH {windowed(SHUFFLED_TICKS, DAY_US)} SELECT symbol, seq, {STAT_COLUMNS} FROM w",
    "zscore": f"WITH {SCORED} SELECT symbol, seq, zscore, is_anomaly FROM p",
    "processed_ticks": PROCESSED,
    "anomaly_events": f"""WITH {SCORED}
SELECT symbol, trade_time AS "timestamp", price AS triggering_price, mean_price AS rolling_mean, stdev_price AS rolling_stdev,
       anomaly_zscore AS deviation_zscore, 3.0::DOUBLE AS threshold, seq FROM p WHERE is_anomaly""",
    "anomaly_log": f"""WITH {SCORED}
SELECT symbol, trade_time AS "timestamp", price AS triggering_price, round_even(mean_price, 4) AS rolling_mean,
       round_even(stdev_price, 4) AS rolling_stdev, round_even(anomaly_zscore, 3) AS deviation_zscore,
       3.0::DOUBLE AS threshold, seq FROM p WHERE is_anomaly""",
    "stored_rows": f"WITH {SCORED} SELECT {STORED_COLUMNS}, {ISO} || '+00:00' AS trade_time, seq FROM p",
    "stored_table": f"WITH {SCORED} SELECT {STORED_COLUMNS}, trade_time, seq FROM p",
    "range_scan": f"""WITH {SCORED} SELECT {STORED_COLUMNS}, trade_time, seq FROM p
WHERE symbol = 'PURCHASE' AND trade_time BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'""",
    "anomaly_scan": f"WITH {SCORED} SELECT {STORED_COLUMNS}, trade_time, seq FROM p WHERE is_anomaly",
    "market_ticks": f"""WITH {SCORED}
SELECT trade_time AS "timestamp", symbol, price, quantity, vwap AS rolling_vwap, mean_price AS rolling_mean,
       stdev_price AS rolling_std, is_anomaly, anomaly_zscore AS z_score, seq FROM p""",
    "snapshot": f"""WITH {EVENT_TICKS},
{_snapshot(f'''SELECT t.* FROM ticks t JOIN (SELECT symbol, max(at_us) AS newest FROM ticks GROUP BY symbol) USING (symbol)
  WHERE at_us >= newest - {DAY_US}''')},
wanted(symbol) AS (VALUES ('PURCHASE'), ('VIEW'), ('CLICK'), ('ETHUSDT'))
SELECT symbol, coalesce(vwap, 0.0::DOUBLE) AS vwap, coalesce(mean_price, 0.0::DOUBLE) AS mean_price,
       coalesce(stdev_price, 0.0::DOUBLE) AS stdev_price, coalesce(sample_count, 0) AS sample_count,
       86400.0::DOUBLE AS window_seconds
FROM wanted LEFT JOIN (SELECT symbol, {stats()} FROM got) USING (symbol)""",
    "snapshot_arrival": f"""WITH {windowed(SHUFFLED_TICKS, DAY_US)}
SELECT symbol, {STAT_COLUMNS} FROM w QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) = 1""",
    "latency_percentiles": f"""WITH {SHUFFLED_TICKS},
late AS (
  SELECT symbol, at_us - own_time AS late_us, count(*) OVER (PARTITION BY symbol) AS n,
         row_number() OVER (PARTITION BY symbol ORDER BY at_us - own_time) - 1 AS place
  FROM ticks
)
SELECT symbol, n, {_percentile(0.5)} AS p50, {_percentile(0.95)} AS p95, {_percentile(0.99)} AS p99
FROM late GROUP BY symbol, n""",
    "stream_processed": f"WITH {SCORED} SELECT {STORED_COLUMNS}, trade_time FROM p",
}
CANONICAL_TICKS = f"""{MESSAGE_FIELDS}, {CANONICAL_REASON},
stamped AS (SELECT *, CASE WHEN event_type = 'signup' THEN date_trunc('milliseconds', ts) ELSE ts END AS trade_time FROM r),
ticks AS (
  SELECT upper(event_type) AS symbol, price, k::DOUBLE AS quantity, trade_time, seq, epoch_us(trade_time) AS at_us,
         CASE WHEN sell THEN 'sell' ELSE 'buy' END AS side
  FROM stamped WHERE reject_reason IS NULL
)"""

LATE_TICKS = SHUFFLED_TICKS.replace("(seq // 16) * 16 + ((seq % 16) * 5 + 3) % 16 AS seq", "(seq % 3) * 1000000000 + seq AS seq")

ORACLE |= {
    "stream_event_time": ORACLE["stream_processed"],
    "stream_retry": ORACLE["stream_processed"],
    "stream_late": f"WITH {scored(LATE_TICKS)} SELECT {STORED_COLUMNS}, trade_time FROM p",
    "batch_outputs": f"""WITH {scored(CANONICAL_TICKS)}
SELECT 'tick' AS kind, symbol AS name, trade_time AS "at", price, anomaly_zscore AS z FROM p
UNION ALL SELECT 'event', symbol, trade_time, price, anomaly_zscore FROM p WHERE is_anomaly
UNION ALL SELECT 'reject', reject_reason, NULL, count(*)::DOUBLE, NULL FROM r WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
}

# How rows are cut into slices changes no result.
ORACLE |= {
    "rolling_stats_sliced": ORACLE["rolling_stats_events"],
    "arrival_stats_sliced": ORACLE["arrival_stats"],
    "percentiles_sliced": ORACLE["latency_percentiles"],
}

ORACLE |= {
    "archived_days": ORACLE["stored_table"],
    "rolling_stats_by_symbol": ORACLE["rolling_stats_events"],
    "rolling_sums_exact": f"""WITH {windowed(EVENT_TICKS.replace("value AS price", "round(value * 100) * CASE WHEN event_id % 2 = 1 THEN 1073741824.0::DOUBLE ELSE 1.0::DOUBLE END AS price"), DAY_US).replace("round(price * 100)", "price")}
SELECT symbol, seq, n, s1::VARCHAR AS s1, s2::VARCHAR AS s2, pv::VARCHAR AS pv, qv::VARCHAR AS qv FROM w""",
    "latency_sketch": f"""WITH {SHUFFLED_TICKS}
SELECT symbol, count(*) AS n, quantile, true AS within_bound FROM ticks CROSS JOIN (VALUES ('p50'), ('p95'), ('p99')) q(quantile) GROUP BY symbol, quantile""",
    "stream_stateful": ORACLE["stream_processed"],
    "stream_stateful_late": ORACLE["stream_late"],
    "snapshot_state": ORACLE["snapshot_arrival"],
    "stream_idle": ORACLE["stream_event_time"],
    # A watermark has whole milliseconds; ticks it has not reached are held.
    "stream_watermark": f"""WITH {SCORED} SELECT {STORED_COLUMNS}, trade_time FROM p
QUALIFY epoch_us(trade_time) <= (max(epoch_us(trade_time)) OVER () // 1000) * 1000 - {WEEK_US}""",
    "stream_counts": f"""WITH {MESSAGE_FIELDS}, {CANONICAL_REASON}
SELECT coalesce(reject_reason, 'emit') AS outcome, count(*) AS messages FROM r GROUP BY 1""",
    "stream_around": f"""WITH {SCORED}
SELECT e.trade_time AS "timestamp", e.price AS triggering_price, e.seq AS event_seq, t.symbol, t.price, t.quantity, t.trade_time, t.seq
FROM p e JOIN p t ON e.symbol = t.symbol AND e.is_anomaly
  AND t.trade_time BETWEEN e.trade_time - INTERVAL 1 HOUR AND e.trade_time + INTERVAL 30 MINUTE""",
}
