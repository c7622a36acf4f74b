"""Golden label counts for raw_bars at sf0.01 (FIXTURES.md section 4)."""


from tickerlake.operators import marts, staging
from tickerlake.sources.testbeds import raw_bars, raw_bars_order

from conftest import SF_MID


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_sf001_goldens(spark):
    raw = raw_bars(spark, SF_MID)
    assert raw.count() == 60000
    assert staging.valid(raw).count() == 42314
    st = staging.stage(raw, raw_bars_order())
    assert st.count() == 38892
    assert st.select("symbol").distinct().count() == 100
    assert counts(marts.daily_returns(st), "return_category") == {
        "Large Gain": 9266, "Moderate Gain": 6334, "Flat": 7718, "Moderate Loss": 6517,
        "Large Loss": 8957}
    ma = marts.moving_averages(st)
    assert counts(ma.fillna({"crossover_signal": "NULL"}), "crossover_signal") == {
        "Golden Cross": 3544, "Death Cross": 3543, "NULL": 31805}
    va = marts.volume_analysis(st)
    assert counts(va, "volume_category") == {
        "Very High Volume": 1477, "High Volume": 6126, "Normal": 16190, "Low Volume": 6146,
        "Very Low Volume": 8953}
    assert counts(va, "trend_strength") == {
        "Strong Uptrend": 2310, "Strong Downtrend": 2405, "Weak Uptrend": 4708,
        "Weak Downtrend": 4593, "Neutral": 24876}
