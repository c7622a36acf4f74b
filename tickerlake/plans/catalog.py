"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through ``raw_bars`` / ``event_bars``
or directly) over their whole extent, so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as dt
import uuid

from tickerlake import schema as S
from tickerlake.functions.timeutil import ntz
from tickerlake.operators import ingest, marts, privacy, quality, reports, sketches, staging
from tickerlake.plans.boundary import to_plain_types
from tickerlake.plans.daily_run import run_daily
from tickerlake.session import ensure_checkpoint_dir, scratch_path, tuned
from tickerlake.sources import csv, retention, tables
from tickerlake.streaming import refresh
from tickerlake.sources.testbeds import event_bars, flag_bars, raw_bars, raw_bars_order, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ("symbol", "date", "tie1", "tie2")


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_plain_types(fn(tuned(spark), sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


def staged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(raw_bars(spark, sf_dir), raw_bars_order())


def cast_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.cast_prices(raw_bars(spark, sf_dir))


# --- staging (T1-T9) -------------------------------------------------------

@query("stg_cast")
def q_stg_cast(spark, sf_dir):
    return cast_raw(spark, sf_dir)


@query("stg_not_null")
def q_stg_not_null(spark, sf_dir):
    return staging.drop_null_bars(cast_raw(spark, sf_dir))


@query("stg_valid_ohlc")
def q_stg_valid_ohlc(spark, sf_dir):
    return staging.valid_ohlc(cast_raw(spark, sf_dir))


@query("stg_positive")
def q_stg_positive(spark, sf_dir):
    return staging.positive_bars(cast_raw(spark, sf_dir))


@query("stg_daily_range")
def q_stg_daily_range(spark, sf_dir):
    return staging.with_daily_range(cast_raw(spark, sf_dir)).select(*KEYS, "daily_range")


@query("stg_daily_change")
def q_stg_daily_change(spark, sf_dir):
    return staging.with_daily_change_pct(cast_raw(spark, sf_dir)).select(*KEYS, "daily_change_pct")


@query("stg_dedup_latest")
def q_stg_dedup_latest(spark, sf_dir):
    return staging.latest_per_key(cast_raw(spark, sf_dir), ("symbol", "date"), raw_bars_order())


@query("stg_stock_prices")
def q_stg_stock_prices(spark, sf_dir):
    return staged_bars(spark, sf_dir)


@query("stg_rejects")
def q_stg_rejects(spark, sf_dir):
    return staging.rejects(raw_bars(spark, sf_dir)).select(*KEYS, "reasons")


# --- daily returns (R1-R5) -------------------------------------------------

@query("ret_prev_close")
def q_ret_prev_close(spark, sf_dir):
    df = marts.with_prev_close(staged_bars(spark, sf_dir))
    return df.select("symbol", "date", "close_price", "prev_close_price")


@query("ret_change")
def q_ret_change(spark, sf_dir):
    df = marts.with_daily_change(marts.with_prev_close(staged_bars(spark, sf_dir)))
    return df.select("symbol", "date", "daily_change_inr")


@query("ret_pct")
def q_ret_pct(spark, sf_dir):
    df = marts.with_daily_return_pct(marts.with_prev_close(staged_bars(spark, sf_dir)))
    return df.select("symbol", "date", "daily_return_pct")


@query("ret_category")
def q_ret_category(spark, sf_dir):
    df = marts.with_return_category(
        marts.with_daily_return_pct(marts.with_prev_close(staged_bars(spark, sf_dir))))
    return df.select("symbol", "date", "daily_return_pct", "return_category")


@query("daily_returns")
def q_daily_returns(spark, sf_dir):
    return marts.daily_returns(staged_bars(spark, sf_dir))


# --- moving averages (M1-M5) -----------------------------------------------

@query("ma_7")
def q_ma_7(spark, sf_dir):
    return marts.with_moving_averages(staged_bars(spark, sf_dir)).select("symbol", "date", "ma_7_day")


@query("ma_30")
def q_ma_30(spark, sf_dir):
    return marts.with_moving_averages(staged_bars(spark, sf_dir)).select("symbol", "date", "ma_30_day")


@query("ma_volume_7")
def q_ma_volume_7(spark, sf_dir):
    return marts.with_moving_averages(staged_bars(spark, sf_dir)).select(
        "symbol", "date", "avg_volume_7_day")


@query("ma_prev")
def q_ma_prev(spark, sf_dir):
    df = marts.with_prev_averages(marts.with_moving_averages(staged_bars(spark, sf_dir)))
    return df.select("symbol", "date", "prev_ma_7_day", "prev_ma_30_day")


@query("ma_crossover")
def q_ma_crossover(spark, sf_dir):
    df = marts.with_crossover(marts.with_prev_averages(marts.with_moving_averages(
        staged_bars(spark, sf_dir))))
    return df.select("symbol", "date", "ma_7_day", "ma_30_day", "crossover_signal")


@query("ma_distance")
def q_ma_distance(spark, sf_dir):
    df = marts.with_moving_averages(staged_bars(spark, sf_dir))
    return df.select("symbol", "date",
                     marts.distance_pct("close_price", "ma_7_day").alias("distance_from_ma7_pct"),
                     marts.distance_pct("close_price", "ma_30_day").alias("distance_from_ma30_pct"))


@query("moving_averages")
def q_moving_averages(spark, sf_dir):
    return marts.moving_averages(staged_bars(spark, sf_dir))


# --- volume analysis (V1-V5) -----------------------------------------------

@query("vol_vs_avg")
def q_vol_vs_avg(spark, sf_dir):
    df = marts.with_volume_vs_avg(staged_bars(spark, sf_dir))
    return df.select("symbol", "date", "volume", "avg_volume_7d", "volume_vs_avg_pct")


@query("vol_price_change")
def q_vol_price_change(spark, sf_dir):
    df = marts.with_price_change_pct(staged_bars(spark, sf_dir))
    return df.select("symbol", "date", "price_change_pct")


@query("vol_category")
def q_vol_category(spark, sf_dir):
    df = marts.with_volume_labels(marts.with_price_change_pct(
        marts.with_volume_vs_avg(staged_bars(spark, sf_dir))))
    return df.select("symbol", "date", "volume_vs_avg_pct", "volume_category")


@query("vol_trend")
def q_vol_trend(spark, sf_dir):
    df = marts.with_volume_labels(marts.with_price_change_pct(
        marts.with_volume_vs_avg(staged_bars(spark, sf_dir))))
    return df.select("symbol", "date", "price_change_pct", "volume_vs_avg_pct", "trend_strength")


@query("volume_analysis")
def q_volume_analysis(spark, sf_dir):
    return marts.volume_analysis(staged_bars(spark, sf_dir))


# --- data quality (Q1-Q9) --------------------------------------------------

@query("dq_required_columns")
def q_dq_required_columns(spark, sf_dir):
    return quality.require_columns(raw_bars(spark, sf_dir))


@query("dq_null_counts")
def q_dq_null_counts(spark, sf_dir):
    return quality.null_counts(raw_bars(spark, sf_dir))


@query("dq_ohlc")
def q_dq_ohlc(spark, sf_dir):
    return quality.ohlc_violations(raw_bars(spark, sf_dir))


@query("dq_batch_gate")
def q_dq_batch_gate(spark, sf_dir):
    return quality.batch_gate(raw_bars(spark, sf_dir))


@query("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return quality.not_null(raw_bars(spark, sf_dir), ["symbol", "date", "close"])


@query("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(staged_bars(spark, sf_dir), "symbol", S.DEFAULT_SYMBOLS)


@query("dq_expression")
def q_dq_expression(spark, sf_dir):
    return quality.expression_is_true(cast_raw(spark, sf_dir),
                                      {"close_price > 0": "close_price > 0", "volume > 0": "volume > 0"})


def layer_views(spark, sf_dir):
    """Raw bars, and staging + the three marts as row filters of one
    ``series_features`` DataFrame: checks and counts over all of them run in
    two aggregations, computing staging and the window pass once."""
    raw = raw_bars(spark, sf_dir)
    features = marts.series_features(staging.stage(raw, raw_bars_order()))
    views = {"stg_stock_prices": None, **marts.mart_filters()}
    return raw, features, views


@query("dq_suite")
def q_dq_suite(spark, sf_dir):
    raw, features, views = layer_views(spark, sf_dir)
    suite = quality.default_suite()
    return (quality.run_suite({"stock_prices_raw": raw}, suite)
            .unionByName(quality.run_suite_on(features, views, suite)))


@query("reconcile_runs")
def q_reconcile_runs(spark, sf_dir):
    raw = raw_bars(spark, sf_dir)
    return quality.reconcile(raw, staging.stage(raw, raw_bars_order()))


# --- ingestion (I1-I11) ----------------------------------------------------

@query("clean_columns")
def q_clean_columns(spark, sf_dir):
    vendor = raw_bars(spark, sf_dir).select(
        F.col("symbol").alias("Symbol"), F.col("date").alias("Date"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("close").alias("Adj Close"), F.col("volume").alias("Volume%"),
        F.col("pipeline_run_id").alias("Pipeline Run-ID"))
    return ingest.clean_columns(vendor)


RUN_TS = dt.datetime(2026, 3, 22, 11, 1, 33)


@query("add_metadata")
def q_add_metadata(spark, sf_dir):
    bars = event_bars(spark, sf_dir).drop(*S.METADATA)
    return ingest.add_metadata(bars, RUN_TS)


@query("flatten_panel")
def q_flatten_panel(spark, sf_dir):
    panel = ingest.to_panel(flag_bars(spark, sf_dir))
    symbols = [c for c in panel.columns if c != "date"]
    return ingest.clean_columns(ingest.flatten_panel(panel, symbols))


@query("conform_columns")
def q_conform_columns(spark, sf_dir):
    return ingest.conform(raw_bars(spark, sf_dir))


@query("filter_symbols")
def q_filter_symbols(spark, sf_dir):
    universe = (table(spark, sf_dir, "supplier")
                .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .filter(F.col("r_name") == "ASIA")
                .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol")))
    return ingest.filter_symbols(raw_bars(spark, sf_dir), universe)


@query("date_range")
def q_date_range(spark, sf_dir):
    return ingest.date_range(raw_bars(spark, sf_dir), "1996-01-01", "1996-12-31")


@query("historical_days")
def q_historical_days(spark, sf_dir):
    return ingest.historical(staged_bars(spark, sf_dir), 30, "2000-06-30")


@query("latest_bar")
def q_latest_bar(spark, sf_dir):
    return ingest.latest(staged_bars(spark, sf_dir))


@query("business_days")
def q_business_days(spark, sf_dir):
    return ingest.calendar_of(raw_bars(spark, sf_dir))


@query("expected_grid")
def q_expected_grid(spark, sf_dir):
    return ingest.expected_grid(staged_bars(spark, sf_dir))


GRID_FROM, GRID_TO = dt.date(1993, 5, 1), dt.date(1999, 2, 28)


@query("expected_grid_bounds")
def q_expected_grid_bounds(spark, sf_dir):
    return ingest.expected_grid(staged_bars(spark, sf_dir), GRID_FROM, GRID_TO)


@query("expected_grid_per_symbol")
def q_expected_grid_per_symbol(spark, sf_dir):
    return ingest.expected_grid(staged_bars(spark, sf_dir), per_symbol=True)


@query("missing_bars")
def q_missing_bars(spark, sf_dir):
    return ingest.missing_bars(staged_bars(spark, sf_dir))


@query("missing_bars_bounds")
def q_missing_bars_bounds(spark, sf_dir):
    return ingest.missing_bars(staged_bars(spark, sf_dir), start=GRID_FROM, end=GRID_TO)


@query("missing_bars_per_symbol")
def q_missing_bars_per_symbol(spark, sf_dir):
    return ingest.missing_bars(staged_bars(spark, sf_dir), per_symbol=True)


# --- reports (P1-P4) -------------------------------------------------------

AS_OF = dt.date(2001, 11, 4)


@query("summary_by_symbol")
def q_summary_by_symbol(spark, sf_dir):
    return reports.summary_by_symbol(staged_bars(spark, sf_dir))


@query("top_gainers")
def q_top_gainers(spark, sf_dir):
    return reports.top_gainers(marts.daily_returns(staged_bars(spark, sf_dir)), AS_OF, days=7, n=10)


@query("recent_signals")
def q_recent_signals(spark, sf_dir):
    return reports.recent_signals(marts.moving_averages(staged_bars(spark, sf_dir)), AS_OF,
                                  S.GOLDEN_CROSS, days=30)


@query("layer_summary")
def q_layer_summary(spark, sf_dir):
    raw, features, views = layer_views(spark, sf_dir)
    layer = {"stg_stock_prices": S.SILVER_LAYER}
    return (reports.layer_summary({(S.BRONZE_LAYER, "stock_prices_raw"): raw})
            .unionByName(reports.layer_counts_on(
                features, {(layer.get(k, S.GOLD_LAYER), k): v for k, v in views.items()})))


# --- sources and sinks (S1-S10) --------------------------------------------
# Queries that exercise a sink write into a fresh folder under the shared
# ``spark.checkpoint.dir`` and return what they read back.


def scratch(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return scratch_path(spark, name)


def damaged_landing(spark: SparkSession, sf_dir: str) -> str:
    """Raw bars landed as CSV, some lines damaged: bars without a close are
    torn after two fields, those of zero volume have a volume that is no
    number and no source system. Both keep the raw line as it landed."""
    path = scratch(spark, "landing")
    raw = ingest.conform(raw_bars(spark, sf_dir))
    torn, odd = F.col("close").isNull(), F.coalesce(F.col("volume") == 0, F.lit(False))
    raw.filter(~torn & ~odd).write.options(**csv.WRITE_OPTIONS).csv(path)
    raw.filter(torn).select("symbol", "date").write.mode("append").options(**csv.WRITE_OPTIONS).csv(path)
    (raw.filter(~torn & odd).withColumn("volume", F.lit("none")).withColumn("source_system", F.lit(None).cast("string"))
        .write.mode("append").options(**csv.WRITE_OPTIONS).csv(path))
    return path


@query("read_csv_roundtrip")
def q_read_csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "csv-read")
    ingest.conform(raw_bars(spark, sf_dir)).write.options(**csv.WRITE_OPTIONS).csv(path)
    return csv.read_bars_csv(spark, path)


@query("read_csv_multiline")
def q_read_csv_multiline(spark, sf_dir):
    """S1 over records with a line break, a comma and quotes in a field."""
    path = scratch(spark, "csv-breaks")
    broken = F.concat("source_system", F.lit(',\n"'), "pipeline_run_id", F.lit('"'))
    raw = ingest.conform(raw_bars(spark, sf_dir)).withColumn("source_system", F.when(F.col("volume") % 3000 == 0, broken).otherwise(F.col("source_system")))
    raw.write.options(**csv.WRITE_OPTIONS).csv(path)
    return csv.read_bars_csv(spark, path)


@query("quarantine_malformed")
def q_quarantine_malformed(spark, sf_dir):
    return csv.quarantine_malformed(spark, damaged_landing(spark, sf_dir))[1]


@query("quarantine_good")
def q_quarantine_good(spark, sf_dir):
    return csv.quarantine_malformed(spark, damaged_landing(spark, sf_dir))[0]


@query("csv_export_roundtrip")
def q_csv_export_roundtrip(spark, sf_dir):
    path = scratch(spark, "csv-export")
    staged = staged_bars(spark, sf_dir)
    csv.write_bars_csv(staged, path)
    return csv.read_bars_csv(spark, path, staged.schema)


@query("bronze_append")
def q_bronze_append(spark, sf_dir):
    target = scratch(spark, "bronze-append")
    bars = event_bars(spark, sf_dir)
    tables.append_bronze(bars, target)
    tables.append_bronze(bars, target)
    return tables.read_table(spark, target)


@query("bronze_replace")
def q_bronze_replace(spark, sf_dir):
    target = scratch(spark, "bronze-replace")
    tables.append_bronze(ingest.conform(raw_bars(spark, sf_dir)), target, validate=False)
    tables.replace_bronze(event_bars(spark, sf_dir), target)
    return tables.read_table(spark, target)


@query("publish_mart")
def q_publish_mart(spark, sf_dir):
    target = scratch(spark, "mart")
    tables.publish_table(marts.daily_returns(staged_bars(spark, sf_dir)), target)
    return tables.read_table(spark, target)


def layers(spark: SparkSession) -> None:
    tables.ensure_layers(spark, root=scratch(spark, "layers"))


@query("layer_tables")
def q_layer_tables(spark, sf_dir):
    """A catalog table per layer, written and read by its qualified name."""
    layers(spark)
    bars, own = event_bars(spark, sf_dir), uuid.uuid4().hex[:8]
    raw, gold = (tables.layer_table(layer, f"bars_{own}") for layer in (S.BRONZE_LAYER, S.GOLD_LAYER))
    tables.append_bronze(bars, raw)
    tables.append_bronze(bars, raw)
    tables.publish_table(marts.daily_returns(staging.stage(tables.read_table(spark, raw))), gold)
    return tables.read_table(spark, gold)


@query("staging_view")
def q_staging_view(spark, sf_dir):
    """The staging layer queried by the name of its view."""
    tables.publish_view(staged_bars(spark, sf_dir), "stg_stock_prices")
    return spark.sql("SELECT * FROM stg_stock_prices")


@query("table_profile")
def q_table_profile(spark, sf_dir):
    """S9 of stored tables, one of which does not exist."""
    layers(spark)
    name = tables.layer_table(S.SILVER_LAYER, f"staged_{uuid.uuid4().hex[:8]}")
    tables.publish_table(staged_bars(spark, sf_dir), name)
    return (tables.table_profile(spark, name).withColumn("name", F.lit("stored"))
            .unionByName(tables.table_profile(spark, name + "_missing").withColumn("name", F.lit("missing"))))


@query("sample_rows")
def q_sample_rows(spark, sf_dir):
    return tables.sample_rows(staged_bars(spark, sf_dir), 5, ("symbol", "date"))


# --- redaction, retention, refresh (X1-X6) ---------------------------------

@query("redact_documents")
def q_redact_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return privacy.redact_secrets(docs, "text", loose_token=True)


@query("redact_urls")
def q_redact_urls(spark, sf_dir):
    return privacy.redact_secrets(table(spark, sf_dir, "pages").select("page_id", "url"), "url")


@query("redact_map")
def q_redact_map(spark, sf_dir):
    return privacy.redact_map(table(spark, sf_dir, "events").select("event_id", "props"), "props")


@query("redact_nested")
def q_redact_nested(spark, sf_dir):
    """X2 on JSON text with sensitive keys at several depths, values of all
    types, lists, and text that is no object."""
    cust = table(spark, sf_dir, "customer")
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    nested = F.concat(F.lit('{"id": '), key, F.lit(', "Password": "p'), key, F.lit('", "n": 1.50, "flag": true, "conn": {"user": "'), name,
                      F.lit('", "TOKEN": {"a": [1, "}"]}, "deep": {"auth": '), key, F.lit(', "deeper": {"api_key": null, "x": [{"secret": 1}]}}}, "last": "\\"password\\": 1"}'))
    other = F.concat(F.lit('["password", '), key, F.lit("]"))
    torn = F.concat(F.lit('{"password": "'), name)
    text = F.when(F.col("c_acctbal") < 0, torn).when(F.col("c_acctbal") < 1000, other).otherwise(nested)
    return privacy.redact_map(cust.select("c_custkey", text.alias("text")), "text")


@query("redact_typed")
def q_redact_typed(spark, sf_dir):
    """X2 on a struct column: sensitive fields of any depth, types kept."""
    cust = table(spark, sf_dir, "customer")
    value = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("Password"),
                     F.struct(F.col("c_acctbal").alias("token"), F.col("c_acctbal").alias("kept"),
                              F.create_map(F.lit("secret"), F.col("c_name"), F.lit("open"), F.col("c_name")).alias("m")).alias("conn"))
    out = privacy.redact_map(cust.select("c_custkey", value.alias("v")), "v")
    return out.select("c_custkey", F.col("v.id").alias("id"), F.col("v.Password").alias("password"), F.col("v.conn.token").alias("token"),
                      F.col("v.conn.kept").alias("kept"), F.col("v.conn.m")["secret"].alias("secret"), F.col("v.conn.m")["open"].alias("open"))


@query("redact_rules")
def q_redact_rules(spark, sf_dir):
    """X1 with every rule and log form firing, and non-ASCII spaces and
    letters, around the whole text of each document."""
    docs = table(spark, sf_dir, "documents")
    key, wide = F.col("doc_id").cast("string"), F.lit("\u3000")
    text = F.concat(
        F.lit("PASSWORD='a"), key, F.lit("' x&password=b"), key, F.lit("&y ?Password=c"), key, wide, F.lit("https://h/"), key, F.lit("?q="), key,
        F.lit("\u00a0next Token=d"), key, wide, F.lit("words token = \"e"), key, F.lit("\" {'password': 'f'} {\"password\":\u2003\"g\"} password=\"\" "),
        F.lit("pa\u017f\u017fword='h' to\u212aen=i\u0085"), F.coalesce("text", F.lit("")))
    return privacy.redact_secrets(docs.select("doc_id", text.alias("text")), "text", loose_token=True, log_forms=True)


RETENTION_AS_OF = dt.datetime(2024, 1, 31)


@query("retention_split")
def q_retention_split(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return privacy.with_archived_flag(ev, "ts", RETENTION_AS_OF, S.RETENTION_DAYS)


def streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw bars with damaged lines, landed and streamed in: (bronze, quarantine)."""
    bronze, bad = scratch(spark, "stream-bronze"), scratch(spark, "stream-bad")
    refresh.ingest_new_files(spark, damaged_landing(spark, sf_dir), bronze, scratch(spark, "stream-ckpt"), quarantine=bad)
    return bronze, bad


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    return tables.read_table(spark, streamed(spark, sf_dir)[0]).drop(tables.LOAD)


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    return tables.read_table(spark, streamed(spark, sf_dir)[1]).drop(tables.LOAD)


@query("bronze_mixed")
def q_bronze_mixed(spark, sf_dir):
    """Stream and batch loads into one table."""
    bronze, _ = streamed(spark, sf_dir)
    tables.append_bronze(event_bars(spark, sf_dir), bronze)
    return tables.read_table(spark, bronze).drop(tables.LOAD)


UPSERT_CUTOFF = dt.datetime(2024, 1, 1, 8, 0, 0)


@query("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    raw = raw_bars(spark, sf_dir)
    early = F.coalesce(F.col("ingestion_timestamp") < ntz(UPSERT_CUTOFF), F.lit(False))
    keep = ("tie1", "tie2")
    current = staging.stage(raw.filter(early), raw_bars_order(), keep)
    merged = refresh.upsert_latest(current, raw.filter(~early), raw_bars_order(), keep)
    return merged.select(*S.STAGED_COLUMNS)


def refreshed(spark, sf_dir, name: str) -> DataFrame:
    raw = raw_bars(spark, sf_dir)
    early = F.coalesce(F.col("ingestion_timestamp") < ntz(UPSERT_CUTOFF), F.lit(False))
    keep = ("tie1", "tie2")
    current = staging.stage(raw.filter(early), raw_bars_order(), keep)
    current_marts = {"daily_returns": marts.daily_returns(current),
                     "moving_averages": marts.moving_averages(current),
                     "volume_analysis": marts.volume_analysis(current)}
    late = raw.filter(~early)
    staged = refresh.upsert_latest(current, late, raw_bars_order(), keep)
    return refresh.refresh_marts(staged, current_marts, refresh.affected_symbols(late))[name]


@query("refresh_marts")
def q_refresh_marts(spark, sf_dir):
    return refreshed(spark, sf_dir, "moving_averages")


@query("refresh_marts_returns")
def q_refresh_marts_returns(spark, sf_dir):
    return refreshed(spark, sf_dir, "daily_returns")


@query("refresh_marts_volume")
def q_refresh_marts_volume(spark, sf_dir):
    return refreshed(spark, sf_dir, "volume_analysis")


def mart_values(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All columns of the three stored marts, side by side."""
    read = lambda name: tables.read_table(spark, paths[name])
    averages = read("moving_averages").select("symbol", "date", "close_price", "ma_7_day", "ma_30_day", "avg_volume_7_day", "crossover_signal",
                                              "distance_from_ma7_pct", "distance_from_ma30_pct")
    returns = read("daily_returns").select("symbol", "date", "prev_close_price", "daily_change_inr", "daily_return_pct", "return_category")
    volume = read("volume_analysis").select("symbol", "date", "volume", "avg_volume_7d", "volume_vs_avg_pct", "price_change_pct",
                                            "volume_category", "trend_strength")
    return averages.join(returns, ["symbol", "date"], "full_outer").join(volume, ["symbol", "date"], "full_outer")


@query("daily_refresh")
def q_daily_refresh(spark, sf_dir):
    """The values of the marts that a full run stores."""
    return mart_values(spark, run_daily(spark, event_bars(spark, sf_dir), scratch(spark, "daily")).tables)


@query("daily_refresh_layers")
def q_daily_refresh_layers(spark, sf_dir):
    return run_daily(spark, event_bars(spark, sf_dir), scratch(spark, "daily")).summary


def event_batches(spark, sf_dir) -> list[DataFrame]:
    """``event_bars`` in three loads: up to a day, up to a later one, and the
    rest with a correction of every bar of the ten days before the first cut."""
    bars = event_bars(spark, sf_dir)
    first, second = F.lit(FIRST_CUT), F.lit(SECOND_CUT)
    fixed = (bars.filter((F.col("date") <= first) & (F.col("date") > F.date_sub(first, 10)))
             .withColumns({"close": F.col("open"), "ingestion_timestamp": F.lit(CORRECTED).cast("timestamp_ntz"), "pipeline_run_id": F.lit("fix")}))
    return [bars.filter(F.col("date") <= first), bars.filter((F.col("date") > first) & (F.col("date") <= second)),
            bars.filter(F.col("date") > second).unionByName(fixed)]


FIRST_CUT, SECOND_CUT, CORRECTED = dt.date(2024, 1, 15), dt.date(2024, 1, 20), "2030-01-01 00:00:00"


@query("daily_refresh_incremental")
def q_daily_refresh_incremental(spark, sf_dir):
    """A full run, then two incremental ones, the last with corrections."""
    target = scratch(spark, "daily")
    for i, batch in enumerate(event_batches(spark, sf_dir)):
        out = run_daily(spark, batch, target, incremental=i > 0)
    return mart_values(spark, out.tables)


@query("daily_refresh_staging")
def q_daily_refresh_staging(spark, sf_dir):
    """The staging table after those three runs."""
    target = scratch(spark, "daily")
    for i, batch in enumerate(event_batches(spark, sf_dir)):
        out = run_daily(spark, batch, target, incremental=i > 0)
    return tables.read_table(spark, out.tables["stg_stock_prices"]).select(*S.STAGED_COLUMNS)


class Lost(Exception):
    """A run that stopped half-way, for the queries that recover one."""


def lost_after(step: str):
    def stop(done: str) -> None:
        if done == step:
            raise Lost(step)
    return stop


@query("daily_refresh_recovered")
def q_daily_refresh_recovered(spark, sf_dir):
    """A full run, an incremental one lost after it has staged its batch,
    and the next one, which repairs what that left."""
    target = scratch(spark, "daily")
    first, second, third = event_batches(spark, sf_dir)
    run_daily(spark, first, target)
    try:
        run_daily(spark, second, target, incremental=True, on_step=lost_after("staged"))
    except Lost:
        pass
    return mart_values(spark, run_daily(spark, third, target, incremental=True).tables)


def corrected(bars: DataFrame, day: dt.date) -> DataFrame:
    """The bars of one day sent again, later, with the close at the open."""
    return bars.filter(F.col("date") == F.lit(day)).withColumns(
        {"close": F.col("open"), "ingestion_timestamp": F.lit(CORRECTED).cast("timestamp_ntz"), "pipeline_run_id": F.lit("fix")})


LATE_DAY = dt.date(2024, 1, 5)


@query("refresh_late_bar")
def q_refresh_late_bar(spark, sf_dir):
    """A full run, then the bars of one past day corrected."""
    target, bars = scratch(spark, "daily"), event_bars(spark, sf_dir)
    run_daily(spark, bars, target)
    return mart_values(spark, run_daily(spark, corrected(bars, LATE_DAY), target, incremental=True).tables)


@query("dq_suite_incremental")
def q_dq_suite_incremental(spark, sf_dir):
    """Q8 from stored counters, after a full run and two incremental ones."""
    target = scratch(spark, "daily")
    for i, batch in enumerate(event_batches(spark, sf_dir)):
        out = run_daily(spark, batch, target, incremental=i > 0)
    return out.suite


@query("layer_summary_incremental")
def q_layer_summary_incremental(spark, sf_dir):
    """P4 from stored counters, after a full run and one of corrections."""
    target, bars = scratch(spark, "daily"), event_bars(spark, sf_dir)
    run_daily(spark, bars, target)
    return run_daily(spark, corrected(bars, LATE_DAY), target, incremental=True).summary


@query("reconcile_content")
def q_reconcile_content(spark, sf_dir):
    """Q9 by content: bars loaded with a tenth of their days damaged: a day
    lost, doubled, with altered closes, or with two columns swapped."""
    bars = raw_bars(spark, sf_dir).select(*S.RAW_COLUMNS, "tie1", "tie2")
    day = F.dayofyear("date") % 40
    kept = bars.filter(F.coalesce(day != 1, F.lit(True)))
    copies = F.when(day == 2, 2).otherwise(1)
    loaded = (kept.withColumns({"close": F.when(day == 3, F.col("close") + 1).otherwise(F.col("close")),
                                "open": F.when(day == 4, F.col("high")).otherwise(F.col("open")),
                                "high": F.when(day == 4, F.col("open")).otherwise(F.col("high"))})
              .withColumn("_n", F.explode(F.array_repeat(F.lit(0), copies))).drop("_n"))
    return quality.reconcile_content(bars, loaded, bars.columns)


@query("profile_sketched")
def q_profile_sketched(spark, sf_dir):
    """S9 from sketches of each date, and whether they keep their stated bounds
    against the exact figures."""
    staged = staged_bars(spark, sf_dir)
    got = sketches.profile_of_sketches(sketches.partition_sketches(staged))
    est = got.first()
    price = F.col("close_price").cast("double")
    near = lambda q: F.abs(F.avg((price <= F.lit(est[f"quantile_{q}"])).cast("double")) - F.lit(q / 100))
    # A rank by "not above" also counts the rows that share the estimate's value.
    same = lambda q: F.avg((price == F.lit(est[f"quantile_{q}"])).cast("double"))
    return staged.agg(F.lit(est["row_count"]).alias("row_count"), F.lit(est["first_date"]).alias("first_date"), F.lit(est["last_date"]).alias("last_date"),
                      (F.abs(F.lit(est["distinct_estimate"]) - F.count_distinct("symbol")) <= sketches.DISTINCT_ERROR * F.count_distinct("symbol"))
                      .alias("symbols_within"),
                      *[(near(q) <= sketches.RANK_ERROR + same(q)).alias(f"quantile_{q}_within") for q in (25, 50, 75)])


@query("retention_stored")
def q_retention_stored(spark, sf_dir):
    """X3 on a stored table: events by date, archived twice at a cutoff at noon."""
    target, archive = scratch(spark, "events"), scratch(spark, "archive")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", F.col("ts").cast("date").alias("date"))
    tables.publish_table(ev, target, sort=("date", "event_id"), partition_by="date")
    for _ in range(2):
        retention.archive_dates(spark, target, archive, RETENTION_AS_OF + dt.timedelta(hours=12), S.RETENTION_DAYS, "ts")
    read = lambda path, old: tables.read_table(spark, path).select("event_id", "ts", F.lit(old).alias("archived"))
    return read(target, False).unionByName(read(archive, True))
