"""CSV landing, quarantine, export, bronze tables, streaming refresh."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.operators import staging
from tickerlake.sources import csv, tables
from tickerlake.sources.testbeds import raw_bars, raw_bars_order
from tickerlake.streaming import refresh

from conftest import SF_SMALL

HEADER = ",".join(S.RAW_COLUMNS)


def write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_null_spellings(spark, tmp_dir):
    write(tmp_dir, "a.csv", [HEADER,
                             "A,2026-02-02,1.00,2.00,0.50,NULL,10,2026-03-22 11:01:33,y,r",
                             "A,2026-02-03,1.00,2.00,0.50,null,10,2026-03-22 11:01:33,y,r",
                             "A,2026-02-04,1.00,2.00,0.50,,10,2026-03-22 11:01:33,y,r",
                             'A,2026-02-05,"1.00",2.00,0.50,1.50,10,2026-03-22 11:01:33.207953,y,r'])
    rows = csv.read_bars_csv(spark, tmp_dir).orderBy("date").collect()
    assert [r.close for r in rows][:3] == [None, None, None]
    assert rows[3].open is not None and rows[3].ingestion_timestamp.microsecond == 207953


def test_torn_line_and_unparseable_value(spark, tmp_dir):
    write(tmp_dir, "b.csv", [HEADER,
                             "A,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r",
                             "A,2026-02-03,1.00,2.00,0.50,abc,10,2026-03-22 11:01:33,y,r",
                             "ance,20260322_110133"])
    good, bad = csv.quarantine_malformed(spark, tmp_dir)
    assert good.count() == 1
    got = {r.raw_line: r.reasons for r in bad.collect()}
    assert got["ance,20260322_110133"] == ["malformed"]
    assert [v for k, v in got.items() if "abc" in k] == [["unparseable:close"]]
    with pytest.raises(Exception):
        csv.quarantine_malformed(spark, tmp_dir, mode="FAILFAST")[0].count()


def test_export_roundtrip_counts(spark, tmp_dir):
    df = staging.stage(raw_bars(spark, SF_SMALL), raw_bars_order())
    n = csv.write_bars_csv(df, os.path.join(tmp_dir, "out"))
    assert n == df.count()
    assert os.path.exists(os.path.join(tmp_dir, "out", "_SUCCESS"))


def test_bronze_append_replace_and_profile(spark, tmp_dir):
    target = os.path.join(tmp_dir, "bronze")
    bars = tables.read_table(spark, f"{SF_SMALL}/lineitem.parquet").limit(0)
    assert tables.table_profile(spark, target).collect()[0].table_exists is False
    raw = raw_bars(spark, SF_SMALL).select(*S.RAW_COLUMNS)
    assert tables.append_bronze(raw.filter(F.lit(False)), target, validate=False) == 0
    n = tables.append_bronze(raw, target, validate=False)
    assert tables.append_bronze(raw, target, validate=False) == n
    assert tables.read_table(spark, target).count() == 2 * n
    assert tables.replace_bronze(raw, target, validate=False) == n
    prof = tables.table_profile(spark, target).collect()[0]
    assert prof.table_exists and prof.row_count == n
    with pytest.raises(ValueError):
        tables.append_bronze(raw, target)            # NULL closes fail the loader gate
    assert bars.count() == 0


def test_stream_ingest_loads_each_file_once(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "ckpt"))
    write(landing, "f1.csv", [HEADER, "A,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"])
    assert refresh.ingest_new_files(spark, landing, bronze, ckpt) == 1
    assert refresh.ingest_new_files(spark, landing, bronze, ckpt) == 0
    write(landing, "f2.csv", [HEADER, "A,2026-02-03,1.00,2.00,0.50,1.50,10,2026-03-23 11:01:33,y,r2",
                              "B,2026-02-03,1.00,2.00,0.50,1.50,10,2026-03-23 11:01:33,y,r2"])
    assert refresh.ingest_new_files(spark, landing, bronze, ckpt) == 2
    assert tables.read_table(spark, bronze).count() == 3


def test_stored_upsert_equals_rebuild(spark, tmp_dir):
    raw = raw_bars(spark, SF_SMALL).filter(F.col("date").between(dt.date(1996, 1, 1), dt.date(1996, 6, 30)))
    target = os.path.join(tmp_dir, "staged")
    keep = ("tie1", "tie2")
    for run in ("run_0", "run_1", "run_2", "run_3", "run_4"):
        refresh.upsert_into(spark, target, raw.filter(F.col("pipeline_run_id") == run),
                            raw_bars_order(), keep)
    stored = tables.read_table(spark, target).select(*S.STAGED_COLUMNS)
    full = staging.stage(raw, raw_bars_order()).select(*S.STAGED_COLUMNS)
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_retention_split(spark):
    from tickerlake.operators.privacy import split_by_age
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 23, 23, 59)), (2, dt.datetime(2024, 1, 24)), (3, None)],
        "id int, ts timestamp_ntz")
    recent, old = split_by_age(df, "ts", dt.datetime(2024, 1, 31), 7)
    assert sorted(r.id for r in recent.collect()) == [2, 3]
    assert [r.id for r in old.collect()] == [1]


def test_stream_upsert_equals_rebuild(spark, tmp_dir):
    raw = raw_bars(spark, SF_SMALL).filter(F.col("date").between(dt.date(1996, 1, 1), dt.date(1996, 6, 30))).select(*S.RAW_COLUMNS)
    landing, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "staged")
    ckpt = os.path.join(tmp_dir, "ckpt")
    raw.filter(F.col("pipeline_run_id") < "run_2").write.options(**csv.WRITE_OPTIONS).csv(
        os.path.join(landing, "a"))
    refresh.stream_upsert(spark, os.path.join(landing, "*"), target, ckpt)
    raw.filter(F.col("pipeline_run_id") >= "run_2").write.options(**csv.WRITE_OPTIONS).csv(
        os.path.join(landing, "b"))
    refresh.stream_upsert(spark, os.path.join(landing, "*"), target, ckpt)
    stored = tables.read_table(spark, target).select(*S.STAGED_COLUMNS)
    full = staging.stage(raw).select(*S.STAGED_COLUMNS)
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_stream_upsert_keeps_bad_lines(spark, tmp_dir):
    landing, target = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "staged")
    good = "A,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"
    bad = "B,2026-02-02,1.00,2.00,0.50,1.50,10,no time,y,r1"
    write(landing, "f1.csv", [HEADER, good, bad])
    refresh.stream_upsert(spark, landing, target, os.path.join(tmp_dir, "ck"))
    assert [r.symbol for r in tables.read_table(spark, target).collect()] == ["A"]
    kept = spark.read.parquet(target + "_quarantine").collect()
    assert [r.raw_line for r in kept] == [bad] and kept[0].reasons
    with pytest.raises(Exception, match="landed lines refused"):
        refresh.stream_upsert(spark, landing, target, os.path.join(tmp_dir, "ck2"), on_bad="fail")


def test_ingest_archives_processed_files(spark, tmp_dir):
    landing, bronze, archive = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "archive"))
    write(landing, "f1.csv", [HEADER, "A,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"])
    assert refresh.ingest_new_files(spark, landing, bronze, os.path.join(tmp_dir, "ck"),
                                    archive=archive) == 1
    write(landing, "f2.csv", [HEADER, "B,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"])
    assert refresh.ingest_new_files(spark, landing, bronze, os.path.join(tmp_dir, "ck"),
                                    archive=archive) == 1
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "f1.csv" in archived


def test_required_columns_reports_missing(spark):
    from tickerlake.operators.quality import load_checks, require_columns
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    rows = {r.column_name: r.present for r in require_columns(li).collect()}
    assert set(rows) == set(S.REQUIRED_COLUMNS) and not any(rows.values())
    with pytest.raises(ValueError):
        load_checks(li)


def test_incremental_daily_run_equals_full_run(spark, tmp_dir):
    from tickerlake.operators import marts
    from tickerlake.plans.daily_run import run_daily
    raw = raw_bars(spark, SF_SMALL).filter(F.col("close").isNotNull() & F.col("date").between(dt.date(1996, 1, 1), dt.date(1996, 3, 31)))
    keep = ("tie1", "tie2")
    inc, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    first = run_daily(spark, raw.filter(F.col("pipeline_run_id") < "run_3"), inc, raw_bars_order(), keep,
                      incremental=True)
    assert first.load_status == "match"
    run_daily(spark, raw.filter(F.col("pipeline_run_id") >= "run_3"), inc, raw_bars_order(), keep,
              incremental=True)
    ref = run_daily(spark, raw, full, raw_bars_order(), keep)
    st = staging.stage(raw, raw_bars_order())
    want = {"daily_returns": marts.daily_returns(st), "moving_averages": marts.moving_averages(st),
            "volume_analysis": marts.volume_analysis(st)}
    for name, w in want.items():
        got = tables.read_table(spark, os.path.join(inc, "MARTS", name)).select(*w.columns)
        assert got.exceptAll(w).count() == 0 and w.exceptAll(got).count() == 0, name
    counts = {r.table_name: r.row_count for r in ref.summary.collect()}
    assert counts["stg_stock_prices"] == st.count()


def files_of(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def check_marts(spark, work, st):
    from tickerlake.operators import marts
    want = {"daily_returns": marts.daily_returns(st), "moving_averages": marts.moving_averages(st),
            "volume_analysis": marts.volume_analysis(st)}
    for name, w in want.items():
        got = tables.read_table(spark, os.path.join(work, "MARTS", name)).select(*w.columns)
        assert same(w, got), name


@pytest.mark.parametrize("modes", [(False, True, True), (True, True, False), (False, False, True)])
def test_full_and_incremental_runs_in_any_order(spark, tmp_dir, modes):
    """No run loses what earlier ones stored."""
    from tickerlake.plans.daily_run import run_daily
    # Some months: staging and marts hold a folder per date.
    raw = raw_bars(spark, SF_SMALL).filter(F.col("close").isNotNull() & F.col("date").between(dt.date(1996, 1, 1), dt.date(1996, 3, 31)))
    keep = ("tie1", "tie2")
    parts = [raw.filter(F.col("pipeline_run_id").isin(*r)) for r in (("run_0", "run_1"), ("run_2",), ("run_3", "run_4"))]
    seen = None
    for part, incremental in zip(parts, modes):
        run_daily(spark, part, tmp_dir, raw_bars_order(), keep, incremental=incremental)
        seen = part if seen is None else seen.unionByName(part)
        st = staging.stage(seen, raw_bars_order())
        assert same(st, tables.read_table(spark, os.path.join(tmp_dir, "STAGING", "stg_stock_prices")))
        check_marts(spark, tmp_dir, st)
    stored = os.path.join(tmp_dir, "STAGING", "stg_stock_prices")
    dates = tables.read_table(spark, stored).select("date").distinct().count()
    assert len(files_of(stored)) <= dates + 3 * 8          # a file per date, and one more per task and write


def test_short_lookback_reads_older_bars(spark, tmp_dir):
    """Symbols with too few bars in the days looked back on are read whole."""
    raw = raw_bars(spark, SF_SMALL)
    st = staging.stage(raw, raw_bars_order()).cache()
    late = raw.filter(F.col("date") > dt.date(1998, 1, 1))
    changes = refresh.first_changes(late)
    from tickerlake.operators import marts
    want = marts.series_features(st).join(changes, "symbol").filter(F.col("date") >= F.col("since")).drop("since")
    for days in (0, 20, 5000):
        assert same(want, refresh.changed_features(st, changes, lookback_days=days))
    assert refresh.changed_features(st, changes.limit(0)) is None
    st.unpersist()


def test_wrong_layout_is_refused(spark, tmp_dir):
    raw = raw_bars(spark, SF_SMALL).filter(F.col("date") < dt.date(1992, 6, 1))
    target = os.path.join(tmp_dir, "staged")
    staging.stage(raw, raw_bars_order()).write.parquet(target)
    with pytest.raises(ValueError, match="not partitioned by date"):
        refresh.upsert_into(spark, target, raw, raw_bars_order())


def test_null_keys_never_reach_staging(spark, tmp_dir):
    ts = dt.datetime(2026, 3, 1)
    d1 = dt.date(2026, 2, 2)
    schema = spark.createDataFrame([], S.RAW_BAR_SCHEMA).schema
    rows = [("A", None), ("C", d1), (None, d1), ("B", None)]
    raw = [spark.createDataFrame([(s, d, *(__import__("decimal").Decimal(x) for x in ("1", "3", "1", "2")), 5, ts, "s", "r")], schema) for s, d in rows]
    target = os.path.join(tmp_dir, "staged")
    for r in raw:
        refresh.upsert_into(spark, target, r)
    every = raw[0].union(raw[1]).union(raw[2]).union(raw[3])
    assert same(staging.stage(every), tables.read_table(spark, target).select(*S.STAGED_COLUMNS))
    assert tables.read_table(spark, target).count() == 1
    assert sorted(r.reasons for r in staging.rejects(every).collect()) == [["null_date"], ["null_date"], ["null_symbol"]]


def test_stream_keeps_bad_lines_out_and_replays_add_nothing(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "ckpt"))
    good = "A,2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"
    bad = ["ance,20260322_110133", "A,2026-02-03,1.00,2.00,,1.50,abc,2026-03-22 11:01:33,,r1", ",2026-02-02,1,2,1,1.5,10,2026-03-22 11:01:33,y,r1",
           "A,2026-02-02,1.00,0.50,2.00,1.50,10,2026-03-22 11:01:33,y,r1"]
    write(landing, "f1.csv", [HEADER, good, *bad, ""])
    assert refresh.ingest_new_files(spark, landing, bronze, ckpt) == 1
    got = {r.raw_line: r.reasons for r in tables.read_table(spark, bronze + "_quarantine").collect()}
    assert got == dict(zip(bad, (["malformed"], ["unparseable:volume"], ["null_symbol"], ["low_above_high"])))
    # A batch load into the same table, and the same micro-batch once more.
    tables.append_bronze(tables.read_table(spark, bronze), bronze)
    assert tables.read_table(spark, bronze).count() == 2
    commits = os.path.join(ckpt, "commits")
    for f in os.listdir(commits):
        if not f.startswith(".") or f.endswith(".crc"):
            os.remove(os.path.join(commits, f))
    assert refresh.ingest_new_files(spark, landing, bronze, ckpt) == 1
    assert tables.read_table(spark, bronze).count() == 2
    write(landing, "f2.csv", [HEADER, "torn,line"])
    with pytest.raises(Exception, match="refused"):
        refresh.ingest_new_files(spark, landing, bronze, ckpt, on_bad="fail")


def test_stream_in_many_batches_counts_all(spark, tmp_dir):
    landing, bronze = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    for i in range(6):
        write(landing, f"f{i}.csv", [HEADER, f"A{i},2026-02-02,1.00,2.00,0.50,1.50,10,2026-03-22 11:01:33,y,r1"])
    assert refresh.ingest_new_files(spark, landing, bronze, os.path.join(tmp_dir, "ck"), files_per_batch=2) == 6
    assert tables.read_table(spark, bronze).count() == 6 and len(files_of(bronze)) >= 3


def test_csv_content_round_trip(spark, tmp_dir, monkeypatch):
    df = spark.createDataFrame([('q"u,o\\te', "a,b"), ("back\\slash", '"'), (None, "\\"), ("NULL", "x")], "symbol string, name string")
    path = os.path.join(tmp_dir, "out")
    assert csv.write_bars_csv(df, path) == 4
    back = csv.read_bars_csv(spark, path, df.schema).collect()
    assert sorted((r.symbol or "", r.name) for r in back) == sorted([('q"u,o\\te', "a,b"), ("back\\slash", '"'), ("", "\\"), ("", "x")])
    breaks = spark.createDataFrame([("line\nbreak",)], "symbol string")       # a record of two lines
    assert csv.write_bars_csv(breaks, os.path.join(tmp_dir, "broken")) == 1
    read = csv.read_bars_csv
    monkeypatch.setattr(csv, "read_bars_csv", lambda *a: read(*a).filter("symbol IS NULL"))
    with pytest.raises(ValueError, match="differs"):
        csv.write_bars_csv(breaks, os.path.join(tmp_dir, "lost"))


def test_quarantine_keeps_the_line_as_it_landed(spark, tmp_dir):
    line = 'A,2026-02-03,1.00,2.00,,1.50,abc,2026-03-22 11:01:33,"y, z",r'
    write(tmp_dir, "b.csv", [HEADER, line])
    _, bad = csv.quarantine_malformed(spark, tmp_dir)
    assert [(r.raw_line, r.reasons) for r in bad.collect()] == [(line, ["unparseable:volume"])]


def test_published_files_have_narrow_symbol_ranges(spark, tmp_dir):
    import pyarrow.parquet as pq
    st = staging.stage(raw_bars(spark, SF_SMALL), raw_bars_order())
    target = os.path.join(tmp_dir, "t")
    tables.publish_table(st, target, partitions=4)
    spans = sorted((pq.read_table(f, columns=["symbol"]).column("symbol").to_pylist() for f in files_of(target)), key=min)
    assert len(spans) > 1 and all(s == sorted(s) for s in spans)
    assert all(max(a) <= min(b) for a, b in zip(spans, spans[1:]))


def test_catalog_layers_and_missing_profile(spark, tmp_dir):
    tables.ensure_layers(spark, ["L1"], root=tmp_dir)
    name = tables.layer_table("L1", "bars")
    bars = spark.createDataFrame([("A", dt.date(2026, 2, 2))], "symbol string, date date")
    assert tables.table_profile(spark, name).collect()[0].table_exists is False
    tables.publish_table(bars, name, partitions=1)
    assert tables.table_profile(spark, name).collect()[0].row_count == 1
    spark.sql("DROP DATABASE L1 CASCADE")


def test_scratch_is_removed(spark, tmp_dir):
    from tickerlake.plans.daily_run import run_daily
    from tickerlake.session import checkpoint_root
    root = os.path.join(checkpoint_root(spark).removeprefix("file://").removeprefix("file:"), "tickerlake")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    raw = raw_bars(spark, SF_SMALL).filter(F.col("close").isNotNull() & F.col("date").between(dt.date(1996, 1, 1), dt.date(1996, 2, 29)))
    for incremental in (False, True):
        run_daily(spark, raw, tmp_dir, raw_bars_order(), ("tie1", "tie2"), incremental=incremental)
    assert set(os.listdir(root)) == before
