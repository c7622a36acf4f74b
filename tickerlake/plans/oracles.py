"""Independent SQL oracles (DuckDB dialect) for the registered queries.

DuckDB's decimal division and ``avg`` return DOUBLE, so the oracles round in
integers instead: a price in cents ``c``, and ``round_half_up(a / b)`` as
``sign(a) * sign(b) * ((2*|a| + |b|) // (2*|b|))``. Results leave as DOUBLE
(``cents / 100``) or BIGINT, the same boundary types as the Spark queries.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# The raw_bars input over lineitem (same text as documented in FIXTURES.md).
RAW_BARS = """raw_bars AS (
SELECT symbol, date,
  CAST(base * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS open,
  CAST((base + up) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS high,
  CAST((base - dn) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS low,
  CASE WHEN l_linenumber = 7 THEN NULL
       ELSE CAST((base + up - dn + CASE WHEN l_linenumber = 6 THEN dn * 2 ELSE 0 END)
                 * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END AS close,
  volume,
  ts AS ingestion_timestamp, 'lineitem' AS source_system,
  concat('run_', CAST(l_orderkey % 5 AS VARCHAR(20))) AS pipeline_run_id,
  l_linenumber AS tie1, l_partkey AS tie2
FROM (SELECT concat('S', CAST(l_suppkey AS VARCHAR(20))) AS symbol,
        CAST(l_shipdate AS DATE) AS date,
        CAST(100000 + CAST(round(l_extendedprice * 100) AS BIGINT) % 10000 AS DECIMAL(12,0)) AS base,
        CAST(CAST(round(l_tax * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS DECIMAL(12,0)) AS up,
        CAST(CAST(round(l_discount * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS DECIMAL(12,0)) AS dn,
        (CAST(l_quantity AS BIGINT) - 1) * 1000 AS volume,
        TIMESTAMP '2024-01-01 00:00:00' + l_orderkey * INTERVAL '1' SECOND AS ts,
        l_orderkey, l_linenumber, l_partkey
      FROM lineitem) q
)"""


def half_up_div(a: str, b: str) -> str:
    """round_half_up(a / b) for integers, NULL when b = 0."""
    return (f"(CASE WHEN ({b}) = 0 THEN NULL ELSE "
            f"sign({a}) * sign({b}) * ((2 * abs({a}) + abs({b})) // (2 * abs({b}))) END)")


def pct_bp(num: str, den: str) -> str:
    """Hundredths of a percent: round_half_up(num * 10000 / den)."""
    return half_up_div(f"CAST({num} AS HUGEINT) * 10000", den)


def dbl(cents: str, places: int = 2) -> str:
    return f"CAST({cents} AS DOUBLE) / {10 ** places}"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


CAST_BARS = """cast_bars AS (
SELECT symbol, date,
  CAST(open AS DECIMAL(18,2)) AS open_price, CAST(high AS DECIMAL(18,2)) AS high_price,
  CAST(low AS DECIMAL(18,2)) AS low_price, CAST(close AS DECIMAL(18,2)) AS close_price,
  CAST(volume AS BIGINT) AS volume, ingestion_timestamp, source_system, pipeline_run_id,
  tie1, tie2
FROM raw_bars)"""

NOT_NULL = ("open_price IS NOT NULL AND high_price IS NOT NULL AND low_price IS NOT NULL "
            "AND close_price IS NOT NULL AND volume IS NOT NULL")
VALID_OHLC = ("low_price <= high_price AND open_price BETWEEN low_price AND high_price "
              "AND close_price BETWEEN low_price AND high_price")
POSITIVE = "close_price > 0 AND volume > 0"

DAILY_CHANGE_BP = pct_bp(f"{cents('close_price')} - {cents('open_price')}", cents("open_price"))

STAGED = f"""clean AS (
SELECT *, high_price - low_price AS daily_range, {DAILY_CHANGE_BP} AS daily_change_bp
FROM cast_bars WHERE {NOT_NULL} AND {VALID_OHLC} AND {POSITIVE}),
staged AS (
SELECT symbol, date, open_price, high_price, low_price, close_price, volume, daily_range,
       daily_change_bp, ingestion_timestamp, source_system, pipeline_run_id
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date
                ORDER BY ingestion_timestamp DESC NULLS LAST, tie1 DESC, tie2 DESC) AS rn
      FROM clean) d
WHERE rn = 1)"""

# Per-symbol series quantities, all in integers.
SERIES = f"""s1 AS (
SELECT *, {cents('close_price')} AS close_c,
  lag({cents('close_price')}) OVER w AS prev_c,
  sum({cents('close_price')}) OVER w7 AS s7, count(*) OVER w7 AS n7,
  sum({cents('close_price')}) OVER w30 AS s30, count(*) OVER w30 AS n30,
  sum(volume) OVER w7 AS v7
FROM staged
WINDOW w AS (PARTITION BY symbol ORDER BY date),
       w7 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
s2 AS (
SELECT *, {pct_bp('close_c - prev_c', 'prev_c')} AS ret_bp,
  {half_up_div('s7', 'n7')} AS ma7_c, {half_up_div('s30', 'n30')} AS ma30_c,
  {half_up_div('v7', 'n7')} AS avgvol,
  {half_up_div('CAST(volume AS HUGEINT) * n7 * 100', 'v7')} AS volpct
FROM s1),
series AS (
SELECT *, lag(ma7_c) OVER w AS prev_ma7_c, lag(ma30_c) OVER w AS prev_ma30_c,
  {pct_bp('close_c - ma7_c', 'ma7_c')} AS dist7_bp,
  {pct_bp('close_c - ma30_c', 'ma30_c')} AS dist30_bp,
  CASE WHEN ret_bp > 300 THEN 'Large Gain' WHEN ret_bp > 100 THEN 'Moderate Gain'
       WHEN ret_bp >= -100 THEN 'Flat' WHEN ret_bp >= -300 THEN 'Moderate Loss'
       ELSE 'Large Loss' END AS return_category,
  CASE WHEN volpct > 200 THEN 'Very High Volume' WHEN volpct > 150 THEN 'High Volume'
       WHEN volpct > 80 THEN 'Normal' WHEN volpct > 50 THEN 'Low Volume'
       ELSE 'Very Low Volume' END AS volume_category,
  CASE WHEN ret_bp > 200 AND volpct > 150 THEN 'Strong Uptrend'
       WHEN ret_bp < -200 AND volpct > 150 THEN 'Strong Downtrend'
       WHEN ret_bp > 200 AND volpct < 80 THEN 'Weak Uptrend'
       WHEN ret_bp < -200 AND volpct < 80 THEN 'Weak Downtrend'
       ELSE 'Neutral' END AS trend_strength
FROM s2
WINDOW w AS (PARTITION BY symbol ORDER BY date)),
signals AS (
SELECT *, CASE WHEN ma7_c > ma30_c AND prev_ma7_c <= prev_ma30_c THEN 'Golden Cross'
               WHEN ma7_c < ma30_c AND prev_ma7_c >= prev_ma30_c THEN 'Death Cross'
          END AS crossover_signal
FROM series)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(RAW_BARS, CAST_BARS)
STAGED_BASE = with_ctes(RAW_BARS, CAST_BARS, STAGED)
SERIES_BASE = with_ctes(RAW_BARS, CAST_BARS, STAGED, SERIES)

CAST_COLS = (f"symbol, date, {dbl(cents('open_price'))} AS open_price, "
             f"{dbl(cents('high_price'))} AS high_price, {dbl(cents('low_price'))} AS low_price, "
             f"{dbl(cents('close_price'))} AS close_price, volume, ingestion_timestamp, "
             "source_system, pipeline_run_id, tie1, tie2")

# --- staging ---------------------------------------------------------------

ORACLES["stg_cast"] = BASE + f"SELECT {CAST_COLS} FROM cast_bars"
ORACLES["stg_not_null"] = BASE + f"SELECT {CAST_COLS} FROM cast_bars WHERE {NOT_NULL}"
ORACLES["stg_valid_ohlc"] = BASE + f"SELECT {CAST_COLS} FROM cast_bars WHERE {VALID_OHLC}"
ORACLES["stg_positive"] = BASE + f"SELECT {CAST_COLS} FROM cast_bars WHERE {POSITIVE}"
ORACLES["stg_daily_range"] = BASE + (
    f"SELECT symbol, date, tie1, tie2, {dbl(cents('high_price - low_price'))} AS daily_range "
    "FROM cast_bars")
ORACLES["stg_daily_change"] = BASE + (
    f"SELECT symbol, date, tie1, tie2, {dbl(DAILY_CHANGE_BP)} AS daily_change_pct FROM cast_bars")
ORACLES["stg_dedup_latest"] = BASE + f"""SELECT {CAST_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date
            ORDER BY ingestion_timestamp DESC NULLS LAST, tie1 DESC, tie2 DESC) AS rn
  FROM cast_bars) d WHERE rn = 1"""

STAGED_COLS = (f"symbol, date, {dbl(cents('open_price'))} AS open_price, "
               f"{dbl(cents('high_price'))} AS high_price, {dbl(cents('low_price'))} AS low_price, "
               f"{dbl(cents('close_price'))} AS close_price, volume, "
               f"{dbl(cents('daily_range'))} AS daily_range, {dbl('daily_change_bp')} AS daily_change_pct, "
               "ingestion_timestamp, source_system, pipeline_run_id")
ORACLES["stg_stock_prices"] = STAGED_BASE + f"SELECT {STAGED_COLS} FROM staged"

REASONS = ", ".join([
    "CASE WHEN symbol IS NULL THEN 'null_symbol' END",
    "CASE WHEN date IS NULL THEN 'null_date' END",
    "CASE WHEN open_price IS NULL THEN 'null_open_price' END",
    "CASE WHEN high_price IS NULL THEN 'null_high_price' END",
    "CASE WHEN low_price IS NULL THEN 'null_low_price' END",
    "CASE WHEN close_price IS NULL THEN 'null_close_price' END",
    "CASE WHEN volume IS NULL THEN 'null_volume' END",
    "CASE WHEN low_price > high_price THEN 'low_above_high' END",
    "CASE WHEN NOT (open_price BETWEEN low_price AND high_price) THEN 'open_outside_range' END",
    "CASE WHEN NOT (close_price BETWEEN low_price AND high_price) THEN 'close_outside_range' END",
    "CASE WHEN close_price <= 0 THEN 'close_not_positive' END",
    "CASE WHEN volume <= 0 THEN 'volume_not_positive' END",
])
ORACLES["stg_rejects"] = BASE + f"""SELECT symbol, date, tie1, tie2, reasons FROM (
  SELECT *, concat_ws(',', {REASONS}) AS reasons FROM cast_bars) r WHERE reasons <> ''"""

# --- marts -----------------------------------------------------------------

PREV = "prev_c"
ORACLES["ret_prev_close"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('close_c')} AS close_price, {dbl(PREV)} AS prev_close_price FROM s1")
ORACLES["ret_change"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('close_c - prev_c')} AS daily_change_inr FROM s1")
ORACLES["ret_pct"] = SERIES_BASE + f"SELECT symbol, date, {dbl('ret_bp')} AS daily_return_pct FROM s2"
ORACLES["ret_category"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('ret_bp')} AS daily_return_pct, return_category FROM series")
ORACLES["daily_returns"] = SERIES_BASE + f"""SELECT symbol, date, {dbl('close_c')} AS close_price,
  {dbl('prev_c')} AS prev_close_price, {dbl('close_c - prev_c')} AS daily_change_inr,
  {dbl('ret_bp')} AS daily_return_pct, volume, return_category, ingestion_timestamp
FROM series WHERE prev_c IS NOT NULL"""

ORACLES["ma_7"] = SERIES_BASE + f"SELECT symbol, date, {dbl('ma7_c')} AS ma_7_day FROM s2"
ORACLES["ma_30"] = SERIES_BASE + f"SELECT symbol, date, {dbl('ma30_c')} AS ma_30_day FROM s2"
ORACLES["ma_volume_7"] = SERIES_BASE + (
    "SELECT symbol, date, CAST(avgvol AS BIGINT) AS avg_volume_7_day FROM s2")
ORACLES["ma_prev"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('prev_ma7_c')} AS prev_ma_7_day, "
    f"{dbl('prev_ma30_c')} AS prev_ma_30_day FROM series")
ORACLES["ma_crossover"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('ma7_c')} AS ma_7_day, {dbl('ma30_c')} AS ma_30_day, "
    "crossover_signal FROM signals")
ORACLES["ma_distance"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('dist7_bp')} AS distance_from_ma7_pct, "
    f"{dbl('dist30_bp')} AS distance_from_ma30_pct FROM series")
ORACLES["moving_averages"] = SERIES_BASE + f"""SELECT symbol, date, {dbl('close_c')} AS close_price,
  {dbl('ma7_c')} AS ma_7_day, {dbl('ma30_c')} AS ma_30_day,
  CAST(avgvol AS BIGINT) AS avg_volume_7_day, volume,
  {dbl('dist7_bp')} AS distance_from_ma7_pct, {dbl('dist30_bp')} AS distance_from_ma30_pct,
  crossover_signal, ingestion_timestamp
FROM signals"""

ORACLES["vol_vs_avg"] = SERIES_BASE + (
    "SELECT symbol, date, volume, CAST(avgvol AS BIGINT) AS avg_volume_7d, "
    "CAST(volpct AS BIGINT) AS volume_vs_avg_pct FROM s2")
ORACLES["vol_price_change"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('ret_bp')} AS price_change_pct FROM s2")
ORACLES["vol_category"] = SERIES_BASE + (
    "SELECT symbol, date, CAST(volpct AS BIGINT) AS volume_vs_avg_pct, volume_category FROM series")
ORACLES["vol_trend"] = SERIES_BASE + (
    f"SELECT symbol, date, {dbl('ret_bp')} AS price_change_pct, "
    "CAST(volpct AS BIGINT) AS volume_vs_avg_pct, trend_strength FROM series")
ORACLES["volume_analysis"] = SERIES_BASE + f"""SELECT symbol, date, {dbl('close_c')} AS close_price,
  volume, CAST(avgvol AS BIGINT) AS avg_volume_7d, CAST(volpct AS BIGINT) AS volume_vs_avg_pct,
  {dbl('ret_bp')} AS price_change_pct, volume_category, trend_strength, ingestion_timestamp
FROM series WHERE avgvol IS NOT NULL"""

# --- data quality ----------------------------------------------------------


def report_sql(table: str, checks: list[tuple[str, str, str]], prefix: str = "") -> str:
    """One row per (test, column, failing condition)."""
    parts = []
    for test, column, cond in checks:
        n = f"CAST(count_if(coalesce({cond}, false)) AS BIGINT)"
        parts.append(f"SELECT {prefix}'{test}' AS test, '{column}' AS column_name, {n} AS failing_rows, "
                     f"{n} = 0 AS passed FROM {table}")
    return "\nUNION ALL\n".join(parts)


REQUIRED = ("symbol", "date", "open", "high", "low", "close", "volume")
ORACLES["dq_required_columns"] = BASE + "SELECT c.column_name, true AS present, " \
    "(SELECT count(*) FROM raw_bars) AS rows_checked FROM (VALUES " + \
    ", ".join(f"('{c}')" for c in REQUIRED) + ") c(column_name)"
ORACLES["dq_null_counts"] = BASE + report_sql(
    "raw_bars", [("null_count", c, f"{c} IS NULL") for c in ("symbol", "date", "close")])
ORACLES["dq_ohlc"] = BASE + report_sql("raw_bars", [("low_above_high", "low,high", "low > high")])
ORACLES["dq_batch_gate"] = BASE + """SELECT check_name, CAST(observed AS BIGINT) AS observed, passed FROM (
  SELECT 1 AS k, 'has_data' AS check_name, count(*) AS observed, count(*) > 0 AS passed FROM raw_bars
  UNION ALL SELECT 2, 'has_symbols', count(symbol), count(symbol) > 0 FROM raw_bars
  UNION ALL SELECT 3, 'no_null_close', count_if(close IS NULL), count_if(close IS NULL) = 0 FROM raw_bars
  UNION ALL SELECT 4, 'valid_ohlc', count_if(NOT coalesce(low <= high, false)),
                   count_if(NOT coalesce(low <= high, false)) = 0 FROM raw_bars) g"""
ORACLES["dq_not_null"] = BASE + report_sql(
    "raw_bars", [("not_null", c, f"{c} IS NULL") for c in ("symbol", "date", "close")])
NSE = ", ".join(f"'{s}'" for s in (
    "RELIANCE.NS", "TCS.NS", "HDFCBANK.NS", "INFY.NS", "ICICIBANK.NS",
    "HINDUNILVR.NS", "ITC.NS", "SBIN.NS", "BHARTIARTL.NS", "KOTAKBANK.NS"))
ORACLES["dq_accepted_values"] = STAGED_BASE + (
    "SELECT symbol AS value, count(*) AS failing_rows FROM staged "
    f"WHERE symbol IS NOT NULL AND symbol NOT IN ({NSE}) GROUP BY symbol")
ORACLES["dq_expression"] = BASE + report_sql("cast_bars", [
    ("expression_is_true", "close_price > 0", "close_price <= 0"),
    ("expression_is_true", "volume > 0", "volume <= 0")])

MART_CTES = """daily_returns AS (SELECT * FROM series WHERE prev_c IS NOT NULL),
moving_averages AS (SELECT * FROM signals),
volume_analysis AS (SELECT * FROM series WHERE avgvol IS NOT NULL)"""
MARTS_BASE = with_ctes(RAW_BARS, CAST_BARS, STAGED, SERIES, MART_CTES)


def nn(cols):
    return [("not_null", c, f"{c} IS NULL") for c in cols]


ORACLES["dq_suite"] = MARTS_BASE + "\nUNION ALL\n".join([
    report_sql("raw_bars", nn(["symbol", "date", "close"]), "'stock_prices_raw' AS table_name, "),
    report_sql("staged", nn(["symbol"]) + [
        ("accepted_values", "symbol", f"symbol IS NOT NULL AND symbol NOT IN ({NSE})")]
        + nn(["date", "close_price"]) + [("expression_is_true", "close_price > 0", "close_price <= 0")]
        + nn(["volume"]) + [("expression_is_true", "volume > 0", "volume <= 0")],
        "'stg_stock_prices' AS table_name, "),
    report_sql("daily_returns", nn(["symbol", "date"]), "'daily_returns' AS table_name, "),
    report_sql("moving_averages", nn(["symbol"]), "'moving_averages' AS table_name, "),
    report_sql("volume_analysis", nn(["symbol", "volume"]), "'volume_analysis' AS table_name, "),
])
ORACLES["reconcile_runs"] = STAGED_BASE + """SELECT coalesce(e.pipeline_run_id, l.pipeline_run_id) AS pipeline_run_id,
  coalesce(e.n, 0) AS extracted_rows, coalesce(l.n, 0) AS loaded_rows,
  CASE WHEN coalesce(l.n, 0) = coalesce(e.n, 0) THEN 'match'
       WHEN coalesce(l.n, 0) > 0 THEN 'partial' ELSE 'failed' END AS status
FROM (SELECT pipeline_run_id, count(*) AS n FROM raw_bars GROUP BY 1) e
FULL OUTER JOIN (SELECT pipeline_run_id, count(*) AS n FROM staged GROUP BY 1) l
  ON e.pipeline_run_id IS NOT DISTINCT FROM l.pipeline_run_id"""

# --- ingestion -------------------------------------------------------------

EVENT_BARS = """event_bars AS (
SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date,
  CAST(arg_min(value, (ts, event_id)) AS DECIMAL(18,2)) AS open,
  CAST(max(value) AS DECIMAL(18,2)) AS high, CAST(min(value) AS DECIMAL(18,2)) AS low,
  CAST(arg_max(value, (ts, event_id)) AS DECIMAL(18,2)) AS close,
  count(*) AS volume, max(ts) AS ingestion_timestamp, 'events' AS source_system,
  strftime(max(ts), '%Y%m%d') AS pipeline_run_id
FROM events GROUP BY 1, 2)"""

FLAG_BARS = """flag_bars AS (
SELECT l_returnflag || l_linestatus AS symbol, CAST(l_shipdate AS DATE) AS date,
  CAST(arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS DECIMAL(18,2)) AS open,
  CAST(max(l_extendedprice) AS DECIMAL(18,2)) AS high, CAST(min(l_extendedprice) AS DECIMAL(18,2)) AS low,
  CAST(arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS DECIMAL(18,2)) AS close,
  CAST(sum(l_quantity) AS BIGINT) AS volume
FROM lineitem GROUP BY 1, 2)"""


def d2(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


RAW_COLS = (f"symbol, date, {d2('open')} AS open, {d2('high')} AS high, {d2('low')} AS low, "
            f"{d2('close')} AS close, volume, ingestion_timestamp, source_system, pipeline_run_id")

ORACLES["clean_columns"] = BASE + (
    f"SELECT symbol, date, {d2('open')} AS open, {d2('high')} AS high, {d2('low')} AS low, "
    f"{d2('close')} AS adj_close, volume, pipeline_run_id AS pipeline_runid FROM raw_bars")
ORACLES["add_metadata"] = with_ctes(EVENT_BARS) + (
    f"SELECT symbol, date, {d2('open')} AS open, {d2('high')} AS high, {d2('low')} AS low, "
    f"{d2('close')} AS close, volume, TIMESTAMP '2026-03-22 11:01:33' AS ingestion_timestamp, "
    "'yfinance' AS source_system, '20260322_110133' AS pipeline_run_id FROM event_bars")
ORACLES["flatten_panel"] = with_ctes(FLAG_BARS) + (
    f"SELECT s.symbol, d.date, {d2('b.open')} AS open, {d2('b.high')} AS high, {d2('b.low')} AS low, "
    f"{d2('b.close')} AS close, b.volume "
    "FROM (SELECT DISTINCT symbol FROM flag_bars) s CROSS JOIN (SELECT DISTINCT date FROM flag_bars) d "
    "LEFT JOIN flag_bars b ON b.symbol = s.symbol AND b.date = d.date")
ORACLES["conform_columns"] = BASE + f"SELECT {RAW_COLS} FROM raw_bars"
ORACLES["filter_symbols"] = BASE + f"""SELECT {RAW_COLS}, tie1, tie2 FROM raw_bars
WHERE symbol IN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier
                 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
                 WHERE r_name = 'ASIA')"""
ORACLES["date_range"] = BASE + (
    f"SELECT {RAW_COLS}, tie1, tie2 FROM raw_bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
ORACLES["historical_days"] = STAGED_BASE + (
    f"SELECT {STAGED_COLS} FROM staged WHERE date BETWEEN DATE '2000-06-30' - 30 AND DATE '2000-06-30'")
ORACLES["latest_bar"] = STAGED_BASE + f"""SELECT {STAGED_COLS} FROM staged
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"""
ORACLES["business_days"] = BASE + """SELECT CAST(d AS DATE) AS date FROM (
  SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM raw_bars) g
WHERE dayofweek(d) NOT IN (0, 6)"""


def grid(lo: str, hi: str, extra: str = "") -> str:
    """Every symbol x every business day from lo to hi."""
    return f"""days AS (
SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series({lo}, {hi}, INTERVAL 1 DAY)) AS d{extra}) g
WHERE dayofweek(d) NOT IN (0, 6)),
grid AS (SELECT symbol, date FROM (SELECT DISTINCT symbol FROM staged) s CROSS JOIN days)"""


OWN_GRID = """grid AS (
SELECT symbol, CAST(d AS DATE) AS date FROM (
  SELECT symbol, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d
  FROM staged GROUP BY symbol) g
WHERE dayofweek(d) NOT IN (0, 6))"""
for _name, _grid in (("", grid("min(date)", "max(date)", " FROM staged")),
                     ("_bounds", grid("DATE '1993-05-01'", "DATE '1999-02-28'")), ("_per_symbol", OWN_GRID)):
    _ctes = with_ctes(RAW_BARS, CAST_BARS, STAGED, _grid)
    ORACLES["expected_grid" + _name] = _ctes + "SELECT symbol, date FROM grid"
    ORACLES["missing_bars" + _name] = _ctes + (
        "SELECT g.symbol, g.date FROM grid g ANTI JOIN staged s ON g.symbol = s.symbol AND g.date = s.date")

# --- reports ---------------------------------------------------------------

ORACLES["summary_by_symbol"] = STAGED_BASE + f"""SELECT symbol,
  {dbl(cents('min(close_price)'))} AS min_close, {dbl(cents('max(close_price)'))} AS max_close,
  {dbl(half_up_div('sum(' + cents('close_price') + ')', 'count(*)'))} AS mean_close,
  CAST(sum(volume) AS BIGINT) AS total_volume
FROM staged GROUP BY symbol"""
ORACLES["top_gainers"] = SERIES_BASE + f"""SELECT symbol, date, {dbl('ret_bp')} AS daily_return_pct
FROM series WHERE prev_c IS NOT NULL AND date BETWEEN DATE '2001-11-04' - 7 AND DATE '2001-11-04'
ORDER BY ret_bp DESC NULLS LAST, symbol, date LIMIT 10"""
ORACLES["recent_signals"] = SERIES_BASE + f"""SELECT symbol, date, {dbl('close_c')} AS close_price,
  crossover_signal FROM signals
WHERE crossover_signal = 'Golden Cross' AND date BETWEEN DATE '2001-11-04' - 30 AND DATE '2001-11-04'"""
ORACLES["layer_summary"] = MARTS_BASE + """SELECT 'RAW' AS layer, 'stock_prices_raw' AS table_name, count(*) AS row_count FROM raw_bars
UNION ALL SELECT 'STAGING', 'stg_stock_prices', count(*) FROM staged
UNION ALL SELECT 'MARTS', 'daily_returns', count(*) FROM daily_returns
UNION ALL SELECT 'MARTS', 'moving_averages', count(*) FROM moving_averages
UNION ALL SELECT 'MARTS', 'volume_analysis', count(*) FROM volume_analysis"""

# --- sources and sinks -----------------------------------------------------

ORACLES["read_csv_roundtrip"] = BASE + f"SELECT {RAW_COLS} FROM raw_bars"
ORACLES["read_csv_multiline"] = BASE + f"""SELECT * REPLACE (CASE WHEN volume % 3000 = 0
  THEN source_system || ',' || chr(10) || '"' || pipeline_run_id || '"' ELSE source_system END AS source_system)
FROM (SELECT {RAW_COLS} FROM raw_bars)"""
# Lines as they landed: torn ones, and those whose volume is no number and whose source is empty.
DAMAGED = """SELECT symbol || ',' || strftime(date, '%Y-%m-%d') AS raw_line, 'malformed' AS reasons
FROM raw_bars WHERE close IS NULL
UNION ALL
SELECT concat_ws(',', symbol, strftime(date, '%Y-%m-%d'), CAST(open AS VARCHAR), CAST(high AS VARCHAR), CAST(low AS VARCHAR),
  CAST(close AS VARCHAR), 'none', strftime(ingestion_timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '', pipeline_run_id), 'unparseable:volume'
FROM raw_bars WHERE close IS NOT NULL AND volume = 0"""
UNDAMAGED = f"SELECT {RAW_COLS} FROM raw_bars WHERE close IS NOT NULL AND volume <> 0"
ORACLES["quarantine_malformed"] = BASE + DAMAGED
ORACLES["quarantine_good"] = BASE + UNDAMAGED
ORACLES["csv_export_roundtrip"] = ORACLES["stg_stock_prices"]
EVENT_COLS = (f"symbol, date, {d2('open')} AS open, {d2('high')} AS high, {d2('low')} AS low, "
              f"{d2('close')} AS close, volume, ingestion_timestamp, source_system, pipeline_run_id")
ORACLES["bronze_append"] = with_ctes(EVENT_BARS) + (
    f"SELECT {EVENT_COLS} FROM event_bars UNION ALL SELECT {EVENT_COLS} FROM event_bars")
ORACLES["bronze_replace"] = with_ctes(EVENT_BARS) + f"SELECT {EVENT_COLS} FROM event_bars"
ORACLES["publish_mart"] = ORACLES["daily_returns"]
ORACLES["table_profile"] = STAGED_BASE + (
    "SELECT 'stored' AS name, true AS table_exists, count(*) AS row_count, count(DISTINCT symbol) AS symbols, "
    "min(date) AS first_date, max(date) AS last_date FROM staged "
    "UNION ALL SELECT 'missing', false, 0, 0, NULL, NULL")
ORACLES["staging_view"] = ORACLES["stg_stock_prices"]
ORACLES["sample_rows"] = STAGED_BASE + f"SELECT {STAGED_COLS} FROM staged ORDER BY symbol, date LIMIT 5"

# --- redaction, retention, refresh -----------------------------------------


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The redaction rules as the original states them, for RE2: its \s is ASCII,
# so the white space of Unicode is spelled out. Written apart from the code.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
RULES = [
    (r"""(?i)password=['"]([^'"]+)['"]""", "password='***REDACTED***'"),
    (r"(?i)&password=[^&]+&", "&password=***REDACTED***&"),
    (rf"(?i)[?&]password=[^&{WS}]+", "?password=***REDACTED***"),
    (rf"(https?://[^{WS}?]+)\?[^{WS}]+", r"\1?***REDACTED***"),
    (rf"""(?i)token=['"]?[^'"&{WS}]+['"]?""", "token='***REDACTED***'"),
]
LOG_FORMS = [
    (rf"'password':[{WS}]*'[^']*'", "'password': '***REDACTED***'"),
    (rf'"password":[{WS}]*"[^"]*"', '"password": "***REDACTED***"'),
    (r"""password=['"][^'"]*['"]""", "password='***REDACTED***'"),
]
LOOSE = [(rf"""(?i)(token[{WS}]*=[{WS}]*)["']?[^"'&{WS}]+["']?""", r"\1'***REDACTED***'")]


def redact_sql(col: str, rules) -> str:
    expr = col
    for pattern, repl in rules:
        expr = f"regexp_replace({expr}, {sql_str(pattern)}, {sql_str(repl)}, 'g')"
    return expr


def joined(*parts: str) -> str:
    """Text pieces with the document's id between them."""
    return "concat(" + ", doc_id, ".join(sql_str(p) for p in parts) + ", coalesce(text, ''))"


SECRETS = joined("PASSWORD='a", "' x&password=b", "&y ?Password=c", "　https://h/", "?q=", " next Token=d",
                 "　words token = \"e",
                 "\" {'password': 'f'} {\"password\": \"g\"} password=\"\" paſſword='h' toKen=i\u0085")
ORACLES["redact_documents"] = f"SELECT doc_id, {redact_sql('text', RULES + LOOSE)} AS text FROM documents"
ORACLES["redact_urls"] = f"SELECT page_id, {redact_sql('url', RULES)} AS url FROM pages"
ORACLES["redact_rules"] = f"SELECT doc_id, {redact_sql(SECRETS, RULES + LOG_FORMS + LOOSE)} AS text FROM documents"
ORACLES["redact_map"] = "SELECT event_id, props FROM events"
ORACLES["redact_nested"] = """SELECT c_custkey, CASE
  WHEN c_acctbal < 0 THEN '{"password": "' || c_name
  WHEN c_acctbal < 1000 THEN '["password", ' || c_custkey || ']'
  ELSE '{"id": ' || c_custkey || ', "Password": "***REDACTED***", "n": 1.50, "flag": true, "conn": {"user": "' || c_name
    || '", "TOKEN": "***REDACTED***", "deep": {"auth": "***REDACTED***", "deeper": {"api_key": "***REDACTED***", "x": [{"secret": 1}]}}}, "last": "\\"password\\": 1"}'
  END AS text FROM customer"""
ORACLES["redact_typed"] = """SELECT c_custkey, c_custkey AS id, '***REDACTED***' AS password, '***REDACTED***' AS token,
  c_acctbal AS kept, '***REDACTED***' AS secret, c_name AS open FROM customer"""
ORACLES["retention_split"] = """SELECT event_id, ts,
  coalesce(ts < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY, false) AS archived FROM events"""
ORACLES["stream_ingest"] = BASE + UNDAMAGED
ORACLES["stream_quarantine"] = BASE + DAMAGED
ORACLES["bronze_mixed"] = with_ctes(RAW_BARS, EVENT_BARS) + UNDAMAGED + f" UNION ALL SELECT {EVENT_COLS} FROM event_bars"
ORACLES["upsert_latest"] = ORACLES["stg_stock_prices"]
ORACLES["daily_refresh_layers"] = "WITH " + EVENT_BARS + """, st AS (
  SELECT * FROM event_bars
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND volume IS NOT NULL AND low <= high AND open BETWEEN low AND high
    AND close BETWEEN low AND high AND close > 0 AND volume > 0)
SELECT 'RAW' AS layer, 'stock_prices_raw' AS table_name, count(*) AS row_count FROM event_bars
UNION ALL SELECT 'STAGING', 'stg_stock_prices', count(*) FROM st
UNION ALL SELECT 'MARTS', 'daily_returns', count(*) - count(DISTINCT symbol) FROM st
UNION ALL SELECT 'MARTS', 'moving_averages', count(*) FROM st
UNION ALL SELECT 'MARTS', 'volume_analysis', count(*) FROM st"""
ORACLES["refresh_marts"] = ORACLES["moving_averages"]
ORACLES["refresh_marts_returns"] = ORACLES["daily_returns"]
ORACLES["refresh_marts_volume"] = ORACLES["volume_analysis"]

# The whole chain over event_bars, and over event_bars with every bar of ten
# days sent again, later, with its close at its open.
EVENTS_RAW = "raw_bars AS (SELECT *, 0 AS tie1, 0 AS tie2 FROM event_bars)"
EVENTS_TWICE = """raw_bars AS (SELECT *, 0 AS tie1, 0 AS tie2 FROM event_bars UNION ALL
SELECT symbol, date, open, high, low, open, volume, TIMESTAMP '2030-01-01 00:00:00', source_system, 'fix', 0, 0
FROM event_bars WHERE date <= DATE '2024-01-15' AND date > DATE '2024-01-15' - 10)"""
MART_VALUES = f"""SELECT symbol, date, {dbl('close_c')} AS close_price, {dbl('ma7_c')} AS ma_7_day, {dbl('ma30_c')} AS ma_30_day,
  CAST(avgvol AS BIGINT) AS avg_volume_7_day, crossover_signal,
  {dbl('dist7_bp')} AS distance_from_ma7_pct, {dbl('dist30_bp')} AS distance_from_ma30_pct,
  {dbl('prev_c')} AS prev_close_price, {dbl('close_c - prev_c')} AS daily_change_inr, {dbl('ret_bp')} AS daily_return_pct,
  CASE WHEN prev_c IS NOT NULL THEN return_category END AS return_category,
  volume, CAST(avgvol AS BIGINT) AS avg_volume_7d, CAST(volpct AS BIGINT) AS volume_vs_avg_pct,
  {dbl('ret_bp')} AS price_change_pct, volume_category, trend_strength
FROM signals"""
ORACLES["daily_refresh"] = with_ctes(EVENT_BARS, EVENTS_RAW, CAST_BARS, STAGED, SERIES) + MART_VALUES
ORACLES["daily_refresh_incremental"] = with_ctes(EVENT_BARS, EVENTS_TWICE, CAST_BARS, STAGED, SERIES) + MART_VALUES
ORACLES["daily_refresh_staging"] = with_ctes(EVENT_BARS, EVENTS_TWICE, CAST_BARS, STAGED) + f"SELECT {STAGED_COLS} FROM staged"
ORACLES["layer_tables"] = (with_ctes(EVENT_BARS, EVENTS_RAW, CAST_BARS, STAGED, SERIES)
                           + ORACLES["daily_returns"].removeprefix(SERIES_BASE))

ORACLES["daily_refresh_recovered"] = ORACLES["daily_refresh_incremental"]
# event_bars with the bars of one day sent again, later, with their close at their open.
EVENTS_LATE = """raw_bars AS (SELECT *, 0 AS tie1, 0 AS tie2 FROM event_bars UNION ALL
SELECT symbol, date, open, high, low, open, volume, TIMESTAMP '2030-01-01 00:00:00', source_system, 'fix', 0, 0
FROM event_bars WHERE date = DATE '2024-01-05')"""
ORACLES["refresh_late_bar"] = with_ctes(EVENT_BARS, EVENTS_LATE, CAST_BARS, STAGED, SERIES) + MART_VALUES
ORACLES["dq_suite_incremental"] = (with_ctes(EVENT_BARS, EVENTS_TWICE, CAST_BARS, STAGED, SERIES, MART_CTES)
                                   + ORACLES["dq_suite"].removeprefix(MARTS_BASE))
ORACLES["layer_summary_incremental"] = (with_ctes(EVENT_BARS, EVENTS_LATE, CAST_BARS, STAGED, SERIES, MART_CTES)
                                        + ORACLES["layer_summary"].removeprefix(MARTS_BASE))
DAMAGED_LOAD = """SELECT symbol, date, CASE WHEN d = 4 THEN high ELSE open END AS open, CASE WHEN d = 4 THEN open ELSE high END AS high, low,
  CASE WHEN d = 3 THEN close + 1 ELSE close END AS close, volume, ingestion_timestamp, source_system, pipeline_run_id, tie1, tie2
FROM (SELECT *, dayofyear(date) % 40 AS d FROM raw_bars) WHERE d <> 1"""
COMPARED = "symbol, date, open, high, low, close, volume, ingestion_timestamp, source_system, pipeline_run_id, tie1, tie2"
ORACLES["reconcile_content"] = BASE.rstrip() + f""", extracted AS (SELECT {COMPARED} FROM raw_bars),
loaded AS ({DAMAGED_LOAD} UNION ALL SELECT {COMPARED} FROM raw_bars WHERE dayofyear(date) % 40 = 2),
missing AS (SELECT pipeline_run_id, date, count(*) AS n FROM (SELECT * FROM extracted EXCEPT ALL SELECT {COMPARED} FROM loaded) GROUP BY 1, 2),
extra AS (SELECT pipeline_run_id, date, count(*) AS n FROM (SELECT {COMPARED} FROM loaded EXCEPT ALL SELECT * FROM extracted) GROUP BY 1, 2),
sides AS (SELECT pipeline_run_id, date, sum(e) AS e, sum(l) AS l FROM (SELECT pipeline_run_id, date, 1 AS e, 0 AS l FROM extracted
  UNION ALL SELECT pipeline_run_id, date, 0, 1 FROM loaded) GROUP BY 1, 2)
SELECT s.pipeline_run_id, s.date, CAST(e AS BIGINT) AS extracted_rows, CAST(l AS BIGINT) AS loaded_rows,
  coalesce(m.n, 0) AS missing_rows, coalesce(x.n, 0) AS extra_rows,
  CASE WHEN coalesce(m.n, 0) = 0 AND coalesce(x.n, 0) = 0 THEN 'match' WHEN l = 0 THEN 'failed' WHEN l = e THEN 'altered'
    WHEN coalesce(x.n, 0) = 0 THEN 'partial' WHEN coalesce(m.n, 0) = 0 THEN 'surplus' ELSE 'differs' END AS status
FROM sides s LEFT JOIN missing m ON s.pipeline_run_id IS NOT DISTINCT FROM m.pipeline_run_id AND s.date IS NOT DISTINCT FROM m.date
LEFT JOIN extra x ON s.pipeline_run_id IS NOT DISTINCT FROM x.pipeline_run_id AND s.date IS NOT DISTINCT FROM x.date"""

ORACLES["profile_sketched"] = STAGED_BASE + """SELECT count(*) AS row_count, min(date) AS first_date, max(date) AS last_date,
  true AS symbols_within, true AS quantile_25_within, true AS quantile_50_within, true AS quantile_75_within FROM staged"""
ORACLES["retention_stored"] = """SELECT event_id, ts,
  coalesce(ts < TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 7 DAY, false) AS archived FROM events"""
