"""Invariants of staging and marts over the driver's tables."""

from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.operators import marts, staging
from tickerlake.sources.testbeds import raw_bars, raw_bars_order
from tickerlake.streaming.refresh import upsert_latest

from conftest import SF_SMALL


def _staged(spark):
    return staging.stage(raw_bars(spark, SF_SMALL), raw_bars_order(), keep=("tie1", "tie2"))


def test_one_row_per_key(spark):
    st = _staged(spark)
    assert st.count() == st.select("symbol", "date").distinct().count()


def test_staged_plus_rejected_plus_duplicates_is_raw(spark):
    raw = raw_bars(spark, SF_SMALL)
    staged, rejected = _staged(spark).count(), staging.rejects(raw).count()
    valid = staging.valid(raw).count()
    assert staged + rejected + (valid - staged) == raw.count()


def test_stage_is_idempotent(spark):
    st = _staged(spark)
    again = staging.stage(
        st.select("symbol", "date", F.col("open_price").alias("open"), F.col("high_price").alias("high"),
                  F.col("low_price").alias("low"), F.col("close_price").alias("close"), "volume",
                  "ingestion_timestamp", "source_system", "pipeline_run_id", "tie1", "tie2"),
        raw_bars_order(), keep=("tie1", "tie2"))
    assert st.exceptAll(again).count() == 0 and again.exceptAll(st).count() == 0


def test_returns_rows_are_staged_minus_symbols(spark):
    st = _staged(spark)
    n_sym = st.select("symbol").distinct().count()
    assert marts.daily_returns(st).count() == st.count() - n_sym
    assert marts.moving_averages(st).count() == st.count()
    assert marts.volume_analysis(st).count() == st.count()


def test_upsert_over_any_split_equals_full_rebuild(spark):
    raw = raw_bars(spark, SF_SMALL)
    full = _staged(spark).select(*S.STAGED_COLUMNS)
    keep = ("tie1", "tie2")
    for cut in ("run_1", "run_3"):
        early = raw.filter(F.col("pipeline_run_id") < cut)
        late = raw.filter(~(F.col("pipeline_run_id") < cut))
        cur = staging.stage(early, raw_bars_order(), keep)
        merged = upsert_latest(cur, late, raw_bars_order(), keep).select(*S.STAGED_COLUMNS)
        assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0


def test_independent_of_partitioning_and_order(spark):
    raw = raw_bars(spark, SF_SMALL)
    a = marts.moving_averages(staging.stage(raw, raw_bars_order()))
    shuffled = raw.repartition(13).orderBy(F.rand(7))
    b = marts.moving_averages(staging.stage(shuffled, raw_bars_order()))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_series_features_equal_individual_marts(spark):
    st = _staged(spark).select(*S.STAGED_COLUMNS)
    feats = marts.marts_from_features(marts.series_features(st))
    for name, fn in (("daily_returns", marts.daily_returns), ("moving_averages", marts.moving_averages),
                     ("volume_analysis", marts.volume_analysis)):
        a, b = feats[name], fn(st)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_crossovers_alternate(spark):
    from pyspark.sql import Window
    ma = marts.moving_averages(_staged(spark).select(*S.STAGED_COLUMNS))
    sig = ma.filter(F.col("crossover_signal").isNotNull())
    w = Window.partitionBy("symbol").orderBy("date")
    repeats = sig.withColumn("prev", F.lag("crossover_signal").over(w)) \
                 .filter(F.col("prev") == F.col("crossover_signal"))
    # Two equal signals in a row need the averages to touch in between.
    for r in repeats.select("symbol", "date").collect():
        between = ma.filter((F.col("symbol") == r.symbol) & (F.col("date") < r.date)) \
                    .orderBy(F.col("date").desc()).limit(40).collect()
        assert any(b.ma_7_day == b.ma_30_day for b in between)


def test_hot_copy_group_holding_a_third_of_rows(spark):
    """One (symbol, date) with half as many copies as all other rows together."""
    raw = raw_bars(spark, SF_SMALL)
    n = raw.count()
    hot = (raw.filter(F.col("close").isNotNull()).limit(1)
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n // 2))))
              .withColumn("tie2", F.col("tie2") + F.col("copy")).drop("copy"))
    skewed = raw.unionByName(hot)
    st = staging.stage(skewed, raw_bars_order(), keep=("tie1", "tie2"))
    base = _staged(spark)
    assert st.count() == base.count()
    h = hot.select("symbol", "date").first()
    key = (F.col("symbol") == h.symbol) & (F.col("date") == h.date)
    want = (staging.valid(skewed).filter(key)
            .orderBy(F.col("ingestion_timestamp").desc(), F.col("tie1").desc(), F.col("tie2").desc())
            .first())
    won = st.filter(key).collect()
    assert len(won) == 1
    assert (won[0].ingestion_timestamp, won[0].tie1, won[0].tie2) == \
        (want.ingestion_timestamp, want.tie1, want.tie2)


def test_daily_run_marts_need_no_shuffle_after_checkpoint(spark):
    from tickerlake.session import cut_lineage
    st = _staged(spark).select(*S.STAGED_COLUMNS)
    feats = cut_lineage(marts.series_features(st))
    for df in marts.marts_from_features(feats).values():
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_refresh_marts_touching_few_symbols_equals_rebuild(spark):
    from tickerlake.streaming.refresh import affected_symbols, refresh_marts
    raw = raw_bars(spark, SF_SMALL)
    keep = ("tie1", "tie2")
    touched = F.col("symbol").isin("S1", "S2") & (F.col("tie1") <= 2)
    current = staging.stage(raw.filter(~touched), raw_bars_order(), keep)
    cur_marts = marts.marts_from_features(marts.series_features(current.select(*S.STAGED_COLUMNS)))
    batch = raw.filter(touched)
    staged = upsert_latest(current, batch, raw_bars_order(), keep)
    assert sorted(r.symbol for r in affected_symbols(batch).collect()) == ["S1", "S2"]
    got = refresh_marts(staged, cur_marts, affected_symbols(batch))
    full = staging.stage(raw, raw_bars_order())
    for name, fn in (("daily_returns", marts.daily_returns), ("moving_averages", marts.moving_averages),
                     ("volume_analysis", marts.volume_analysis)):
        want = fn(full)
        assert got[name].exceptAll(want).count() == 0 and want.exceptAll(got[name]).count() == 0, name


def test_suite_on_shared_features_equals_suite_per_table(spark):
    from tickerlake.operators import quality, reports
    st = _staged(spark).select(*S.STAGED_COLUMNS)
    features = marts.series_features(st)
    views = {"stg_stock_prices": None, **marts.mart_filters()}
    tables = {"stg_stock_prices": st, **marts.marts_from_features(features)}
    suite = quality.default_suite()
    one = quality.run_suite_on(features, views, suite)
    sep = quality.run_suite(tables, suite)
    assert one.exceptAll(sep).count() == 0 and sep.exceptAll(one).count() == 0
    counts = reports.layer_counts_on(features, {("L", k): v for k, v in views.items()})
    per = reports.layer_summary({("L", k): v for k, v in tables.items()})
    assert counts.exceptAll(per).count() == 0 and per.exceptAll(counts).count() == 0
    summary = quality.suite_summary(sep).first()
    assert summary.tests_passed + summary.tests_failed == 12
