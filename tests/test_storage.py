"""S9 by sketches and X3 on stored tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tickerlake.operators import sketches
from tickerlake.plans.catalog import staged_bars
from tickerlake.sources import retention, tables


def test_sketches_unite_to_the_sketch_of_all_rows(spark):
    st = staged_bars(spark, SF_SMALL).cache()
    by_date = sketches.partition_sketches(st)
    plan = by_date._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") <= 3
    got = sketches.profile_of_sketches(by_date).first()
    exact = st.agg(F.count(F.lit(1)), F.count_distinct("symbol"), F.min("date"), F.max("date")).first()
    assert (got["row_count"], got["first_date"], got["last_date"]) == (exact[0], exact[2], exact[3])
    assert abs(got["distinct_estimate"] - exact[1]) <= sketches.DISTINCT_ERROR * exact[1]
    for q in (25, 50, 75):
        below = st.filter(F.col("close_price").cast("double") <= got[f"quantile_{q}"]).count() / exact[0]
        assert abs(below - q / 100) <= sketches.RANK_ERROR + 0.005
    # Halves counted apart give the same profile.
    half = st.filter(F.dayofmonth("date") < 16)
    parts = sketches.partition_sketches(half).unionByName(sketches.partition_sketches(st.filter(F.dayofmonth("date") >= 16)))
    again = sketches.profile_of_sketches(parts).first()
    assert again["row_count"] == exact[0] and abs(again["distinct_estimate"] - exact[1]) <= sketches.DISTINCT_ERROR * exact[1]
    none = sketches.profile_of_sketches(sketches.partition_sketches(st.limit(0))).first()
    assert none["row_count"] == 0 and none["quantile_50"] is None
    st.unpersist()


def files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_retention_moves_folders_and_rewrites_one_date(spark, tmp_dir):
    target, archive = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "a")
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=6 * i)) for i in range(40)] + [(99, None), (7, start + dt.timedelta(hours=42))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz").withColumn("date", F.col("ts").cast("date"))
    tables.publish_table(df, target, sort=("date", "id"), partition_by="date")
    before = {os.path.relpath(f, target): os.path.getmtime(f) for f in files(target)}

    def ids(path):
        return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "ts").collect() if r["id"] != 99)

    as_of = dt.datetime(2024, 1, 12, 13)                 # the cutoff is noon and an hour of the 5th
    moved, split = retention.archive_dates(spark, target, archive, as_of, 7, "ts")
    assert moved == [dt.date(2024, 1, k) for k in range(1, 5)] and split == dt.date(2024, 1, 5)
    old = sorted(r for r in rows if r[1] is not None and r[1] < dt.datetime(2024, 1, 5, 13))
    stay = sorted(r for r in rows if r[1] is not None and r[1] >= dt.datetime(2024, 1, 5, 13))
    assert ids(archive) == old and ids(target) == stay
    assert spark.read.parquet(target).filter("id = 99").count() == 1
    # Whole dates moved as they were; dates after the cutoff were not touched.
    same = [f for f in before if f.split("/")[0] in {f"date=2024-01-0{k}" for k in range(1, 5)}]
    assert all(os.path.getmtime(os.path.join(archive, f)) == before[f] for f in same)
    later = [f for f in before if f.split("/")[0] > "date=2024-01-05"]
    assert later and all(os.path.getmtime(os.path.join(target, f)) == before[f] for f in later)
    seen = files(tmp_dir)
    assert retention.archive_dates(spark, target, archive, as_of, 7, "ts") == ([], None)
    assert files(tmp_dir) == seen
    # Late rows of an archived date join it; a later cutoff on the split date adds to it.
    tables.replace_partitions(df.filter("id = 3").withColumn("id", F.lit(300)), target, "date", ())
    moved, split = retention.archive_dates(spark, target, archive, as_of + dt.timedelta(hours=6), 7, "ts")
    assert moved == [dt.date(2024, 1, 1)] and split == dt.date(2024, 1, 5)
    assert [r[0] for r in ids(archive)] == sorted([r[0] for r in rows if r[1] is not None and r[1] < dt.datetime(2024, 1, 5, 19)] + [300])
    assert retention.archive_dates(spark, target, archive, dt.datetime(2024, 1, 14), 7) == ([dt.date(2024, 1, 6)], None)
