"""Bronze / silver / gold tables.

A target is either a path (anything with a ``/``), written as Parquet, or a
catalog name ``LAYER.TABLE``. Layer names are used verbatim, without prefix.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.session import exists

LOAD = "load_id"            # partition column of a table kept by load
_BY_LOAD = "_by_load"       # its marker, a file that readers skip


def is_path(target: str) -> bool:
    return "/" in target


def ensure_layers(spark: SparkSession, layers: Sequence[str] = (S.BRONZE_LAYER, S.SILVER_LAYER,
                                                                  S.GOLD_LAYER),
                  root: str | None = None) -> list[str]:
    """Create the layer namespaces if missing, under ``root`` if given
    (else in the warehouse folder)."""
    for layer in layers:
        place = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{place}")
    return list(layers)


def layer_table(layer: str, name: str) -> str:
    """Qualified name; the layer is used as given (no prefix)."""
    return f"{layer.strip()}.{name}"


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if is_path(target) else spark.table(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    return exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)


def _write(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = ()) -> int:
    obs = Observation(f"write_{mode}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(target):
        w.parquet(target)
    else:
        w.format("parquet").saveAsTable(target)
    return obs.get["rows"]


def append_bronze(df: DataFrame, target: str, validate: bool = True) -> int:
    """Append a batch; returns rows loaded (0 for an empty batch).

    With ``validate`` the loader's gate (required columns, NULL keys and
    close, low <= high) runs first and raises on failure. Rows are counted
    by an Observation during the write, not by a second pass. In a table kept
    by load the batch is a load of its own.
    """
    if validate:
        from tickerlake.operators.quality import enforce, load_checks
        enforce(load_checks(df))
    if is_path(target) and is_by_load(df.sparkSession, target):
        return load_into(df, target, f"append-{uuid.uuid4().hex[:16]}")
    return _write(df, target, "append")


def _load_folder(target: str, load_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"a load id starts with a letter and holds letters, digits, '.', '_' and '-' only: {load_id!r}")
    return f"{target.rstrip('/')}/{LOAD}={load_id}"


def is_by_load(spark: SparkSession, target: str) -> bool:
    return exists(spark, f"{target.rstrip('/')}/{_BY_LOAD}")


def has_load(spark: SparkSession, target: str, load_id: str) -> bool:
    """Whether the load was written to its end (the job's commit marks it)."""
    return exists(spark, _load_folder(target, load_id) + "/_SUCCESS")


def load_into(df: DataFrame, target: str, load_id: str) -> int:
    """S4 for a table kept by load: the folder ``load_id=<id>`` of ``target``
    takes ``df``. Written once more, a load replaces itself and nothing else,
    and no other load is listed or read, so the cost does not grow with the
    table. Returns the rows written. A table of plain files is refused."""
    spark, folder = df.sparkSession, _load_folder(target, load_id)
    if not is_by_load(spark, target):
        if exists(spark, target):
            raise ValueError(f"{target} is not kept by load; move its files into a folder {LOAD}=<id>, and add an empty file {_BY_LOAD}")
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{_BY_LOAD}")
        marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(marker, True).close()
    return _write(df.drop(LOAD), folder, "overwrite")


def read_load(spark: SparkSession, target: str, load_id: str) -> DataFrame:
    return spark.read.parquet(_load_folder(target, load_id))


def replace_bronze(df: DataFrame, target: str, validate: bool = True) -> int:
    """Replace the contents (overwrite); returns rows loaded."""
    if validate:
        from tickerlake.operators.quality import enforce, load_checks
        enforce(load_checks(df))
    return _write(df, target, "overwrite")


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """The staging layer as a non-materialised view."""
    df.createOrReplaceTempView(name)
    return df


def storage_order(df: DataFrame, sort: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of ``sort``, sorted within each."""
    ranged = (df.repartitionByRange(partitions, *sort) if partitions
              else df.repartitionByRange(*sort))
    return ranged.sortWithinPartitions(*sort)


def publish_table(df: DataFrame, target: str, sort: Sequence[str] = ("symbol", "date"),
                  partitions: int | None = None, partition_by: str | None = None) -> int:
    """Full refresh, stored in (symbol, date) order.

    Range partitioning on the sort keys plus a local sort gives files whose
    Parquet min/max statistics are narrow in ``symbol``, so later reads that
    filter by symbol skip most row groups. With ``partition_by`` the table has
    a folder per value and the order within; a range covers neighbouring
    values, so there are at most values + tasks files, and a large value is
    split over tasks.
    """
    keys = ([partition_by] if partition_by else []) + [c for c in sort if c != partition_by]
    return _write(storage_order(df, keys, partitions), target, "overwrite", [partition_by] if partition_by else ())


def check_layout(spark: SparkSession, target: str, column: str) -> None:
    """Raise unless the files of ``target`` lie in folders of ``column``: a
    table that is refreshed by partition must hold nothing outside them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    odd = [n for n in names if not n.startswith((f"{column}=", "_", "."))]
    if odd:
        raise ValueError(f"{target} is not partitioned by {column}: it holds {odd[:3]}")


def stored_dates(spark: SparkSession, target: str) -> list[dt.date]:
    """The dates that a table partitioned by ``date`` holds, by its folders'
    names: one per trading day, whatever the rows."""
    check_layout(spark, target, "date")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(dt.date.fromisoformat(n.removeprefix("date=")) for n in names
                  if n.startswith("date=") and n != "date=__HIVE_DEFAULT_PARTITION__")


def on_dates(df: DataFrame, dates: Sequence[dt.date], column: str = "date") -> DataFrame:
    """Rows of ``df`` on ``dates``: a filter by values, which prunes partitions
    while the files are planned."""
    return df.filter(F.col(column).isin([F.lit(d) for d in dates]) if dates else F.lit(False))


def replace_partitions(df: DataFrame, target: str, column: str, sort: Sequence[str]) -> None:
    """Replace the partitions of ``target`` that ``df`` has rows of."""
    (storage_order(df, [column, *[c for c in sort if c != column]])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(target))


def profile(df: DataFrame) -> DataFrame:
    """Row count, distinct symbols, first and last date, in one aggregation."""
    return df.agg(
        F.lit(True).alias("table_exists"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("symbol").alias("symbols"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def table_profile(spark: SparkSession, target: str) -> DataFrame:
    """S9 for a stored table; a missing table gives one row with ``table_exists`` false."""
    if table_exists(spark, target):
        return profile(read_table(spark, target))
    return spark.createDataFrame(
        [(False, 0, 0, None, None)],
        "table_exists boolean, row_count bigint, symbols bigint, first_date date, last_date date")


def sample_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """The first ``n`` rows under a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
