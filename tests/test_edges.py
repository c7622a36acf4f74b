"""Hand-made edge rows: label boundaries, first bars, crossovers, staging rules."""

import datetime as dt
from decimal import Decimal

from tickerlake import schema as S
from tickerlake.functions import labels
from tickerlake.operators import marts, quality, staging

D0 = dt.date(2026, 2, 2)


def day(i):
    return D0 + dt.timedelta(days=i)


def staged_df(spark, rows):
    """rows: (symbol, day index, close, volume) -> staged bars."""
    data = [(s, day(i), Decimal(str(c)), Decimal(str(c)), Decimal(str(c)), Decimal(str(c)), v,
             Decimal("0.00"), Decimal("0.00"), dt.datetime(2026, 3, 1), "t", "r")
            for s, i, c, v in rows]
    schema = ("symbol string, date date, open_price decimal(18,2), high_price decimal(18,2), "
              "low_price decimal(18,2), close_price decimal(18,2), volume bigint, "
              "daily_range decimal(19,2), daily_change_pct decimal(28,2), "
              "ingestion_timestamp timestamp_ntz, source_system string, pipeline_run_id string")
    return spark.createDataFrame(data, schema)


def label_of(spark, fn, values):
    df = spark.createDataFrame([(Decimal(str(v)),) for v in values], "v decimal(10,2)")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_return_category_boundaries(spark):
    got = label_of(spark, labels.return_category, [3, 1, -1, -3, 3.01, 1.01, -1.01, -3.01])
    assert got == [S.RETURN_MODERATE_GAIN, S.RETURN_FLAT, S.RETURN_FLAT, S.RETURN_MODERATE_LOSS,
                   S.RETURN_LARGE_GAIN, S.RETURN_MODERATE_GAIN, S.RETURN_MODERATE_LOSS,
                   S.RETURN_LARGE_LOSS]


def test_volume_category_boundaries(spark):
    got = label_of(spark, labels.volume_category, [200, 150, 80, 50, 201, 151, 81, 51])
    assert got == [S.VOLUME_HIGH, S.VOLUME_NORMAL, S.VOLUME_LOW, S.VOLUME_VERY_LOW,
                   S.VOLUME_VERY_HIGH, S.VOLUME_HIGH, S.VOLUME_NORMAL, S.VOLUME_LOW]


def test_trend_boundaries(spark):
    df = spark.createDataFrame(
        [(2.0, 151), (-2.0, 151), (2.01, 80), (2.01, 150), (2.01, 151), (-2.01, 79), (None, 300)],
        "p double, v int")
    got = [r[0] for r in df.select(labels.trend_strength("p", "v")).collect()]
    assert got == [S.TREND_NEUTRAL, S.TREND_NEUTRAL, S.TREND_NEUTRAL, S.TREND_NEUTRAL,
                   S.TREND_STRONG_UP, S.TREND_WEAK_DOWN, S.TREND_NEUTRAL]


def test_return_rounding_is_exact_half_up(spark):
    # 2.995 % rounds to 3.00 (not above 3), 3.005 % to 3.01; -2.995 % to -3.00.
    rows = [("A", 0, "200.00", 1), ("A", 1, "205.99", 1),
            ("B", 0, "200.00", 1), ("B", 1, "206.01", 1),
            ("C", 0, "200.00", 1), ("C", 1, "194.01", 1)]
    out = {r.symbol: r for r in marts.daily_returns(staged_df(spark, rows)).collect()}
    assert out["A"].daily_return_pct == Decimal("3.00")
    assert out["A"].return_category == S.RETURN_MODERATE_GAIN
    assert out["B"].daily_return_pct == Decimal("3.01")
    assert out["B"].return_category == S.RETURN_LARGE_GAIN
    assert out["C"].daily_return_pct == Decimal("-3.00")
    assert out["C"].return_category == S.RETURN_MODERATE_LOSS


def test_volume_pct_exact_boundaries(spark):
    # 400 over a frame summing 600 with 3 bars: 400*3*100/600 = 200 -> High.
    # 100 after 300: 100*2*100/400 = 50 -> Very Low.
    rows = [("H", 0, 10, 100), ("H", 1, 10, 100), ("H", 2, 10, 400),
            ("L", 0, 10, 300), ("L", 1, 10, 100)]
    out = marts.volume_analysis(staged_df(spark, rows)).collect()
    last = {r.symbol: r for r in out if r.date == (day(2) if r.symbol == "H" else day(1))}
    assert last["H"].volume_vs_avg_pct == 200
    assert last["H"].volume_category == S.VOLUME_HIGH
    assert last["L"].volume_vs_avg_pct == 50
    assert last["L"].volume_category == S.VOLUME_VERY_LOW


def test_first_bar(spark):
    rows = [("A", 0, 100, 10), ("A", 1, 110, 10)]
    st = staged_df(spark, rows)
    assert [r.date for r in marts.daily_returns(st).collect()] == [day(1)]
    first = [r for r in marts.moving_averages(st).collect() if r.date == day(0)][0]
    assert first.crossover_signal is None
    assert first.ma_7_day == first.ma_30_day == Decimal("100.00")
    va = [r for r in marts.volume_analysis(st).collect() if r.date == day(0)][0]
    assert va.price_change_pct is None and va.trend_strength == S.TREND_NEUTRAL


def test_golden_and_death_cross_at_bar_8(spark):
    up = [("U", i, 100, 1) for i in range(7)] + [("U", 7, 200, 1)]
    down = [("D", i, 100, 1) for i in range(7)] + [("D", 7, 50, 1)]
    out = marts.moving_averages(staged_df(spark, up + down)).collect()
    sig = {(r.symbol, r.date): r.crossover_signal for r in out}
    assert all(sig[("U", day(i))] is None for i in range(7))
    assert sig[("U", day(7))] == S.GOLDEN_CROSS
    assert sig[("D", day(7))] == S.DEATH_CROSS


RAW_SCHEMA = ("symbol string, date date, open double, high double, low double, close double, "
              "volume bigint, ingestion_timestamp timestamp_ntz, source_system string, "
              "pipeline_run_id string")


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_newer_invalid_row_never_hides_older_valid_row(spark):
    old, new = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 2)
    rows = [("A", D0, 10.0, 12.0, 9.0, 11.0, 5, old, "s", "r1"),
            ("A", D0, 10.0, 12.0, 9.0, 13.0, 5, new, "s", "r2")]   # close above high
    out = staging.stage(raw_df(spark, rows)).collect()
    assert len(out) == 1 and out[0].pipeline_run_id == "r1"


def test_newest_valid_row_wins(spark):
    rows = [("A", D0, 10.0, 12.0, 9.0, 11.0, 5, dt.datetime(2026, 3, 1), "s", "r1"),
            ("A", D0, 10.0, 12.0, 9.0, 10.5, 5, dt.datetime(2026, 3, 2), "s", "r2")]
    out = staging.stage(raw_df(spark, rows)).collect()
    assert [r.pipeline_run_id for r in out] == ["r2"]


def test_staging_boundaries(spark):
    ts = dt.datetime(2026, 3, 1)
    rows = [
        ("EQ", D0, 9.0, 12.0, 9.0, 12.0, 5, ts, "s", "r"),        # open = low, close = high: kept
        ("TINY", D0, 0.004, 0.01, 0.0, 0.004, 5, ts, "s", "r"),   # close casts to 0.00: rejected
        ("ZERO", D0, 0.0, 2.0, -1.0, 1.0, 5, ts, "s", "r"),       # open 0: kept, change pct NULL
        ("NOVOL", D0, 1.0, 2.0, 1.0, 1.0, 0, ts, "s", "r"),       # volume 0: rejected
    ]
    out = {r.symbol: r for r in staging.stage(raw_df(spark, rows)).collect()}
    assert set(out) == {"EQ", "ZERO"}
    assert out["ZERO"].daily_change_pct is None
    assert out["EQ"].daily_change_pct == Decimal("33.33")
    rej = {r.symbol: r.reasons for r in staging.rejects(raw_df(spark, rows)).collect()}
    assert rej == {"TINY": ["close_not_positive"], "NOVOL": ["volume_not_positive"]}


def test_reconcile_statuses(spark):
    ext = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("c",)] * 2 + [(None,)] * 2, "pipeline_run_id string")
    loaded = spark.createDataFrame([("a",)] * 3 + [("b",)] * 1 + [(None,)] * 2, "pipeline_run_id string")
    got = [(r.pipeline_run_id, r.extracted_rows, r.loaded_rows, r.status) for r in quality.reconcile(ext, loaded).collect()]
    assert sorted(got, key=str) == sorted([("a", 3, 3, "match"), ("b", 3, 1, "partial"), ("c", 2, 0, "failed"), (None, 2, 2, "match")], key=str)


def test_batch_gate_reports_all_failures(spark):
    rows = [("A", D0, 1.0, 1.0, 2.0, None, 5, dt.datetime(2026, 3, 1), "s", "r")]
    gate = {r.check_name: r.passed for r in quality.batch_gate(raw_df(spark, rows)).collect()}
    assert gate == {"has_data": True, "has_symbols": True, "no_null_close": False, "valid_ohlc": False}
    try:
        quality.enforce(quality.batch_gate(raw_df(spark, rows)))
    except ValueError as e:
        assert "no_null_close" in str(e) and "valid_ohlc" in str(e)
    else:
        raise AssertionError("enforce did not raise")


def test_batch_gate_null_low_fails_valid_ohlc_but_not_q3(spark):
    rows = [("A", D0, 1.0, 1.0, None, 1.0, 5, dt.datetime(2026, 3, 1), "s", "r")]
    df = raw_df(spark, rows)
    gate = {r.check_name: r.passed for r in quality.batch_gate(df).collect()}
    assert gate["valid_ohlc"] is False
    assert quality.ohlc_violations(df).collect()[0].passed is True


def test_loader_smoke_rows_fail_accepted_values(spark):
    rows = [("TEST.NS", dt.date(2026, 2, 1 + i), 100.0 + i, 105.0 + i, 99.0 + i, 103.0 + i,
             1000000 + 100000 * i, dt.datetime(2026, 3, 1), "test", "test_run_001") for i in range(3)]
    df = raw_df(spark, rows)
    assert all(r.passed for r in quality.load_checks(df).collect())
    staged = staging.stage(df)
    bad = {r.value: r.failing_rows for r in quality.accepted_values(staged, "symbol").collect()}
    assert bad == {"TEST.NS": 3}


def test_expression_is_true_leaves_nulls_to_not_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "volume int")
    rep = quality.expression_is_true(df, {"volume > 0": "volume > 0"}).collect()[0]
    assert rep.failing_rows == 1
    assert quality.not_null(df, "volume").collect()[0].failing_rows == 1


def test_suite_declares_fifteen_tests():
    suite = quality.default_suite()
    assert sum(len(v) for v in suite.values()) == 15
    kinds = [c.test for v in suite.values() for c in v]
    assert kinds.count("not_null") == 12 and kinds.count("accepted_values") == 1
    assert kinds.count("expression_is_true") == 2


def test_layer_names_verbatim():
    from tickerlake.sources.tables import layer_table
    assert layer_table("MARTS", "daily_returns") == "MARTS.daily_returns"


def test_clean_columns_rules(spark):
    from tickerlake.operators.ingest import clean_columns
    df = spark.createDataFrame([(1, 2, 3)], "`Adj Close` int, `Open%` int, `Volume` int")
    assert clean_columns(df).columns == ["adj_close", "open", "volume"]
    dup = spark.createDataFrame([(1, 2)], "`Open` int, `open%` int")
    try:
        clean_columns(dup)
    except ValueError:
        pass
    else:
        raise AssertionError("collision not detected")


def test_business_days_guard(spark):
    from tickerlake.operators.ingest import business_days
    days = [r.date for r in business_days(spark, "2026-02-20", "2026-03-20").collect()]
    assert len(days) == 21 and all(d.weekday() < 5 for d in days)
    assert business_days(spark, "2016-01-01", "2025-12-31").count() == 2609       # ten years, no guard by default
    try:
        business_days(spark, "2020-01-01", "2026-01-01", S.MAX_CALENDAR_DAYS).collect()
    except Exception as e:  # noqa: BLE001
        assert "allowed are 1000" in str(e)
    else:
        raise AssertionError("guard did not fire")


def test_percentages_of_operands_with_more_places(spark):
    from tickerlake.functions.exact import pct_half_up
    df = spark.sql("SELECT CAST(0.0049 AS DECIMAL(18,4)) AS a, CAST(0.0151 AS DECIMAL(18,4)) AS b, "
                   "CAST(49000000000000.0049 AS DECIMAL(18,4)) AS c, CAST(151000000000000 AS DECIMAL(18,0)) AS d")
    r = df.select(pct_half_up("a", "b").alias("x"), pct_half_up("c", "d").alias("y")).collect()[0]
    assert str(r.x) == "32.45" and str(r.y) == "32.45"


def test_grid_and_missing(spark):
    from tickerlake.operators.ingest import expected_grid, missing_bars
    # Fri 2026-02-06, then Tue 2026-02-10: Mon 2026-02-09 is missing.
    rows = [("A", 4, 1, 1), ("A", 8, 1, 1)]
    st = staged_df(spark, rows)
    assert expected_grid(st).count() == 3
    assert [r.date for r in missing_bars(st).collect()] == [dt.date(2026, 2, 9)]
    # A has Monday to Friday, B only Monday, C only a bar after the span asked for.
    week = spark.createDataFrame([("A", dt.date(2026, 2, 2 + i)) for i in range(5)] + [("B", dt.date(2026, 2, 2)), ("B", dt.date(2026, 2, 2))], "symbol string, date date")
    gaps = lambda **kw: sorted((r.symbol, r.date.day) for r in missing_bars(week, **kw).collect())
    assert gaps() == [("B", d) for d in (3, 4, 5, 6)] and gaps(per_symbol=True) == []
    assert expected_grid(week).count() == 10 and expected_grid(week, per_symbol=True).count() == 6
    more = week.unionByName(spark.createDataFrame([("C", dt.date(2026, 2, 20))], "symbol string, date date"))
    for kw in ({}, {"start": "2026-01-29", "end": "2026-02-04"}, {"start": "2026-02-03", "end": "2026-02-25"}, {"start": "2026-03-02", "end": "2026-03-03"},
               {"end": "2026-02-04"}, {"start": "2026-02-08", "end": "2026-02-04"}):
        for own in (False, True):
            want = expected_grid(more, per_symbol=own, **kw)
            held = missing_bars(more, want)
            got = missing_bars(more, per_symbol=own, **kw)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, held.collect())), (kw, own)
    assert missing_bars(week.limit(0)).collect() == [] and expected_grid(week.limit(0)).collect() == []


def test_latest_bar(spark):
    from tickerlake.operators.ingest import latest
    st = staged_df(spark, [("A", 0, 1, 1), ("A", 3, 2, 1), ("B", 1, 5, 1)])
    got = {r.symbol: r.date for r in latest(st).collect()}
    assert got == {"A": day(3), "B": day(1)}
    assert latest(st).columns == st.columns


def test_summary_and_top_gainers(spark):
    from tickerlake.operators.reports import summary_by_symbol, top_gainers
    st = staged_df(spark, [("A", 0, 100, 5), ("A", 1, 110, 6), ("B", 0, 100, 1), ("B", 1, 90, 1)])
    s = {r.symbol: r for r in summary_by_symbol(st).collect()}
    assert s["A"].mean_close == Decimal("105.00") and s["A"].total_volume == 11
    top = top_gainers(marts.daily_returns(st), day(1), days=7, n=1).collect()
    assert [(r.symbol, r.daily_return_pct) for r in top] == [("A", Decimal("10.00"))]


def test_flatten_panel_skips_absent_symbols(spark):
    from tickerlake.operators.ingest import flatten_panel, to_panel
    bars = spark.createDataFrame([("X", D0, 1.0, 2.0, 0.5, 1.5, 10)],
                                 "symbol string, date date, open double, high double, low double, "
                                 "close double, volume bigint")
    panel = to_panel(bars, ["X"])
    out = flatten_panel(panel, ["X", "MISSING"]).collect()
    assert [(r.symbol, r.Close) for r in out] == [("X", 1.5)]


def test_gate_report_one_pass(spark):
    rows = [("A", D0, 1.0, 1.0, 2.0, None, 5, dt.datetime(2026, 3, 1), "s", "r"),
            (None, D0, 1.0, 3.0, 2.0, 2.5, 5, dt.datetime(2026, 3, 1), "s", "r")]
    got = {r.check_name: (r.observed, r.passed) for r in quality.gate_report(raw_df(spark, rows)).collect()}
    assert got["has_data"] == (2, True) and got["has_symbols"] == (1, True)
    assert got["no_null_close"] == (1, False) and got["valid_ohlc"] == (1, False)
    assert got["null_symbol"] == (1, False) and got["null_date"] == (0, True)
    assert got["low_above_high"] == (1, False)
    assert [quality.load_status(*c) for c in ((3, 3), (3, 1), (3, 0))] == ["match", "partial", "failed"]


def test_min_rows_suppresses_early_signals(spark):
    up = [("U", i, 100, 1) for i in range(7)] + [("U", 7, 200, 1)]
    out = marts.moving_averages(staged_df(spark, up), min_rows=S.SLOW_MA_ROWS).collect()
    assert all(r.crossover_signal is None for r in out)


def test_dedup_ties_under_default_order(spark):
    ts = dt.datetime(2026, 3, 1)
    rows = [("A", D0, 10.0, 12.0, 9.0, 11.0, 5, ts, "s", "20260301_1"),
            ("A", D0, 10.0, 12.0, 9.0, 10.0, 5, ts, "s", "20260301_2"),    # same time, later run: wins
            ("B", D0, 10.0, 12.0, 9.0, 10.0, 5, ts, "s", "r"),
            ("B", D0, 10.0, 12.0, 9.0, 11.5, 5, ts, "s", "r")]             # full tie: higher close wins
    out = {r.symbol: r for r in staging.stage(raw_df(spark, rows)).collect()}
    assert out["A"].pipeline_run_id == "20260301_2"
    assert out["B"].close_price == Decimal("11.50")


def test_accepted_values_with_universe_table(spark):
    st = staged_df(spark, [("A", 0, 1, 1), ("B", 0, 1, 1), ("B", 1, 1, 1), ("C", 0, 1, 1)])
    universe = spark.createDataFrame([("A",), ("C",)], "sym string")
    got = {r.value: r.failing_rows for r in quality.accepted_values(st, "symbol", universe).collect()}
    assert got == {"B": 2}
