"""X3 on stored tables: old dates move to an archive by folder.

A partition that is older than the cutoff as a whole is renamed into the
archive; no row of it is read or written. Only the date that the cutoff falls
into is rewritten, once on either side. Repeated, nothing happens; stopped
half-way, the next run goes on: a row is in the archive before it leaves the table, and
one that is in both is not archived twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.functions.timeutil import ntz
from tickerlake.session import Cut, exists, remove
from tickerlake.sources.tables import replace_partitions, stored_dates


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; into one that is there, its files one by one (their
    names are unique to the write that made them)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(target)):
        fs.mkdirs(path(target).getParent())
        moved = fs.rename(path(source), path(target))
        if not moved:
            raise OSError(f"could not move {source} to {target}")
        return
    for f in fs.listStatus(path(source)):
        name = f.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(f.getPath(), path(f"{target}/{name}")):
            raise OSError(f"could not move {source}/{name} to {target}")
    remove(spark, source)


def archive_dates(spark: SparkSession, target: str, archive: str, as_of: dt.datetime, days: int = S.RETENTION_DAYS,
                  ts: str | None = None) -> tuple[list[dt.date], dt.date | None]:
    """Move what is older than ``as_of - days`` (strictly) from ``target`` to
    ``archive``, both partitioned by ``date``.

    ``ts``: a timestamp within the partition's date, by which the date of the
    cutoff is split; without it a row is as old as its date's midnight. Rows
    without a date or a timestamp stay. Returns the dates moved as folders and
    the date rewritten, if any.
    """
    cutoff = as_of - dt.timedelta(days=days)
    whole, split = [], None
    for d in stored_dates(spark, target):
        start = dt.datetime.combine(d, dt.time())
        if start + dt.timedelta(days=1) <= cutoff or (ts is None and start < cutoff):
            whole.append(d)
        elif ts is not None and start < cutoff:
            split = d
    if split is not None:
        there = spark.read.parquet(target).filter(F.col("date") == F.lit(split))
        old = F.coalesce(F.col(ts) < ntz(cutoff), F.lit(False))
        going = there.filter(old)
        if exists(spark, f"{archive}/date={split}"):
            kept = spark.read.parquet(archive).select(*there.columns).filter(F.col("date") == F.lit(split))
            going = kept.unionByName(going.exceptAll(kept))
        with Cut(there.filter(~old), "staying") as staying, Cut(going, "going") as new:
            if there.filter(old).isEmpty():
                split = None
            else:
                replace_partitions(new, archive, "date", ())
                if staying.isEmpty():
                    remove(spark, f"{target.rstrip('/')}/date={split}")
                else:
                    replace_partitions(staying, target, "date", ())
    for d in whole:
        _move(spark, f"{target.rstrip('/')}/date={d}", f"{archive.rstrip('/')}/date={d}")
    return whole, split
