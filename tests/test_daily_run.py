"""Lost runs, what a late bar rewrites, counters by partition, contents."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickerlake import schema as S
from tickerlake.operators import marts, quality, staging
from tickerlake.plans.daily_run import MART_NAMES, run_daily, table_paths
from tickerlake.plans.ledger import Ledger
from tickerlake.sources import tables
from tickerlake.sources.testbeds import raw_bars, raw_bars_order
from tickerlake.streaming import refresh

KEEP = ("tie1", "tie2")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def bars_of(spark, last=dt.date(1996, 2, 10)):
    return raw_bars(spark, SF_SMALL).filter(F.col("close").isNotNull() & F.col("date").between(dt.date(1996, 1, 1), last))


def check_tables(spark, work, seen):
    paths = table_paths(work)
    st = staging.stage(seen, raw_bars_order())
    assert same(st, tables.read_table(spark, paths["stg_stock_prices"]))
    for name, want in marts.marts_from_features(marts.series_features(st)).items():
        assert same(want, tables.read_table(spark, paths[name])), name


def check_reports(spark, out):
    stored = {n: tables.read_table(spark, p) for n, p in out.tables.items()}
    assert same(quality.run_suite(stored, quality.default_suite()), out.suite)
    assert {r.table_name: r.row_count for r in out.summary.collect()} == {n: df.count() for n, df in stored.items()}


class Lost(Exception):
    pass


def stop_after(step):
    def stop(done):
        if done == step:
            raise Lost
    return stop


def daily(spark, batch, work, **kw):
    return run_daily(spark, batch, work, raw_bars_order(), KEEP, **kw)


@pytest.mark.parametrize("step,again", [("opened", False), ("loaded", True), ("staged", False), ("marts", True), ("tested", False)])
def test_lost_run_is_repaired_by_the_next_or_the_same(spark, tmp_dir, step, again):
    bars = bars_of(spark).cache()
    runs = [bars.filter(F.col("pipeline_run_id").isin(*r)) for r in (("run_0", "run_1"), ("run_2",), ("run_3", "run_4"))]
    daily(spark, runs[0], tmp_dir)
    with pytest.raises(Lost):
        daily(spark, runs[1], tmp_dir, incremental=True, on_step=stop_after(step))
    assert len(Ledger(spark, tmp_dir).open_runs()) == 1
    if step == "staged":                            # a commit that was lost between taking away and putting in place
        for name in ("stg_stock_prices", "daily_returns"):
            path = table_paths(tmp_dir)[name]
            touched = runs[1].agg(F.max("date")).first()[0]
            os.rename(f"{path}/date={touched}", f"{tmp_dir}/gone-{name}")
    out = daily(spark, runs[1] if again else runs[2], tmp_dir, incremental=True)
    loaded = step != "opened" or again
    seen = runs[0].unionByName(runs[1]) if again else runs[0].unionByName(runs[2])
    if loaded and not again:
        seen = seen.unionByName(runs[1])
    check_tables(spark, tmp_dir, seen)
    check_reports(spark, out)
    assert not Ledger(spark, tmp_dir).open_runs()
    bronze = tables.read_table(spark, out.tables["stock_prices_raw"])
    assert same(seen.select(*S.RAW_COLUMNS, *KEEP), bronze.drop(tables.LOAD))
    assert out.load_status == "match" and len(out.recovered) == 1
    bars.unpersist()


def test_lost_full_run_is_followed_by_a_full_one(spark, tmp_dir):
    bars = bars_of(spark, dt.date(1996, 1, 10))
    one, two = bars.filter("pipeline_run_id < 'run_2'"), bars.filter("pipeline_run_id >= 'run_2'")
    with pytest.raises(Lost):
        daily(spark, one, tmp_dir, on_step=stop_after("loaded"))
    out = daily(spark, two, tmp_dir, incremental=True)
    check_tables(spark, tmp_dir, bars)
    again = daily(spark, two, tmp_dir, incremental=True)             # the same batch is one load
    assert again.run_id == out.run_id
    assert same(bars.select(*S.RAW_COLUMNS, *KEEP), tables.read_table(spark, out.tables["stock_prices_raw"]).drop(tables.LOAD))
    check_reports(spark, again)
    states = [r.state for r in Ledger(spark, tmp_dir).history().collect()]
    assert sorted(states) == ["ended", "ended", "opened", "opened", "opened", "recovered"]
    with pytest.raises(ValueError, match="other rows"):
        daily(spark, one, tmp_dir, run_id=out.run_id)
    assert len(Ledger(spark, tmp_dir).open_runs()) == 1


def modified(path):
    return {d: max(os.path.getmtime(os.path.join(path, d, f)) for f in os.listdir(os.path.join(path, d))) for d in os.listdir(path) if "=" in d}


def test_one_late_bar_rewrites_its_next_thirty_bars(spark, tmp_dir):
    """Two symbols over 90 dates, one of them on every third date only."""
    start, ts = dt.date(2024, 1, 1), dt.datetime(2024, 6, 1)
    schema = spark.createDataFrame([], S.RAW_BAR_SCHEMA).schema
    from decimal import Decimal

    def bar(s, k, close, at=ts, run="r1"):
        return (s, start + dt.timedelta(days=k), Decimal(10), Decimal(40), Decimal(1), Decimal(close), 100 + k, at, "s", run)

    rows = [bar("A", k, 10 + k % 7) for k in range(90)] + [bar("B", k, 20 + k % 5) for k in range(0, 90, 3)]
    first = spark.createDataFrame(rows, schema)
    out = run_daily(spark, first, tmp_dir)
    before = {n: modified(out.tables[n]) for n in ("stg_stock_prices", *MART_NAMES)}
    late = spark.createDataFrame([bar("A", 5, 33, dt.datetime(2024, 7, 1), "r2")], schema)
    out = run_daily(spark, late, tmp_dir, incremental=True)
    changed = {n: sorted(d for d, t in modified(out.tables[n]).items() if t != before[n].get(d)) for n in before}
    assert changed["stg_stock_prices"] == ["date=2024-01-06"]
    for name in MART_NAMES:
        assert len(changed[name]) <= 31 and changed[name][0] == "date=2024-01-06"
    st = staging.stage(first.unionByName(late))
    for name, want in marts.marts_from_features(marts.series_features(st)).items():
        assert same(want, tables.read_table(spark, out.tables[name]))
    check_reports(spark, out)
    # A symbol with few bars around the change is read whole: B's next thirty bars are ninety dates.
    late = spark.createDataFrame([bar("B", 3, 33, dt.datetime(2024, 8, 1), "r3"), bar("C", 40, 5, run="r3")], schema)
    out = run_daily(spark, late, tmp_dir, incremental=True)
    st = tables.read_table(spark, out.tables["stg_stock_prices"])
    for name, want in marts.marts_from_features(marts.series_features(st)).items():
        assert same(want, tables.read_table(spark, out.tables[name]))


def test_spans_are_merged_and_bounded():
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(1000)]
    assert refresh._spans([days[500]], days, 60) == [(440, 560)]
    assert refresh._spans([days[3], days[100], days[300]], days, 60) == [(0, 160), (240, 360)]
    assert refresh._spans(days[::150], days, 10, most=2) == [(0, 760), (890, 910)]


def test_reach_reads_few_partitions(spark, tmp_dir):
    target = os.path.join(tmp_dir, "staged")
    st = staging.stage(bars_of(spark, dt.date(1996, 12, 31)), raw_bars_order(), KEEP)
    tables.publish_table(st, target, partition_by="date")
    stored = tables.stored_dates(spark, target)
    assert len(stored) > 300
    day = stored[len(stored) // 2]
    cells = tables.on_dates(st, [day]).select("symbol", "date").withColumn("reach", F.lit(30)).limit(3).cache()
    read = tables.read_table(spark, target)
    with refresh.reached_features(read, cells, stored, around=20) as got:
        want = marts.series_features(st.select(*S.STAGED_COLUMNS))
        got = got.cache()
        hit = got.select("symbol", "date")
        assert same(want.join(hit, ["symbol", "date"], "left_semi").select(*S.DAILY_RETURNS_COLUMNS), got.select(*S.DAILY_RETURNS_COLUMNS))
        assert got.count() == sum(min(31, st.filter((F.col("symbol") == r.symbol) & (F.col("date") >= day)).count()) for r in cells.collect())
    plan = tables.on_dates(read, stored[:3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in plan
    cells.unpersist()


def test_content_digest_and_reconcile(spark):
    rows = [("r1", i, i * 2, None if i % 5 else "x") for i in range(50)] + [("r2", 1, 1, "a"), ("r2", 1, 1, "a"), (None, 2, 2, "b")]
    df = spark.createDataFrame(rows, "run string, a int, b int, c string")
    cols = ["run", "a", "b", "c"]
    digest = lambda d: tuple(quality.content_digest(d, cols).first())
    assert digest(df) == digest(df.repartition(7).orderBy(F.desc("a")))
    assert digest(df) != digest(df.union(df.limit(1)))
    swapped = df.select("run", F.col("b").alias("a"), F.col("a").alias("b"), "c")
    assert digest(df) != digest(swapped)

    def compared(loaded):
        return {r["run"]: tuple(r)[1:] for r in quality.reconcile_content(df, loaded, cols, ("run",)).collect()}

    assert compared(df) == {"r1": (50, 50, 0, 0, "match"), "r2": (2, 2, 0, 0, "match"), None: (1, 1, 0, 0, "match")}
    assert compared(df.distinct())["r2"] == (2, 1, 1, 0, "partial")
    assert compared(df.union(df.filter("run = 'r1' and a = 3")))["r1"] == (50, 51, 0, 1, "surplus")
    assert compared(swapped)["r1"] == (50, 50, 49, 49, "altered")
    assert compared(df.filter("run is not null"))[None] == (1, 0, 1, 0, "failed")
    assert compared(df.filter("a <> 4").union(df.filter("a = 3")).union(df.filter("a = 5")))["r1"] == (50, 51, 1, 2, "differs")
    assert quality.reconcile_content(df.limit(0), df.limit(0), cols, ("run",)).count() == 0


def test_loads_replace_themselves(spark, tmp_dir):
    target = os.path.join(tmp_dir, "bronze")
    df = spark.createDataFrame([("A", 1)], "symbol string, n int")
    assert tables.load_into(df, target, "run-1") == 1 and tables.load_into(df.union(df), target, "run-2") == 2
    assert tables.load_into(df, target, "run-2") == 1 and tables.append_bronze(df, target, validate=False) == 1
    assert tables.read_table(spark, target).count() == 3 and tables.has_load(spark, target, "run-1") and not tables.has_load(spark, target, "run-9")
    for bad in ("1", "a/b", "", "a b"):
        with pytest.raises(ValueError, match="load id"):
            tables.load_into(df, target, bad)
    plain = os.path.join(tmp_dir, "plain")
    tables.append_bronze(df, plain, validate=False)
    with pytest.raises(ValueError, match="not kept by load"):
        tables.load_into(df, plain, "run-1")
