"""Bar-shaped inputs derived from the driver's TPC-H-like tables.

``raw_bars`` turns every ``lineitem`` row into one raw price bar (symbol =
supplier, date = ship date), with deliberate defects: NULL close (line 7),
close above high (line 6), zero volume (quantity 1) and repeated
(symbol, date) keys across orders. ``event_bars`` aggregates the ``events``
stream into daily bars per user. Both scale linearly with their tables and
are pure projections / one aggregation, so Catalyst prunes columns and pushes
filters into the Parquet scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.schema import PRICE

CENT = Decimal("0.01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str) -> F.Column:
    """A 2-decimal DOUBLE in cents. The tables' amounts have at most two
    decimals, so ``x * 100`` lies within float error of an integer and ``rint``
    equals ``round`` here, without round's per-value BigDecimal conversion."""
    return F.rint(F.col(c) * 100).cast("bigint")


def _price(units: F.Column) -> F.Column:
    """Integer cents -> DECIMAL(18,2), exactly (one decimal multiply)."""
    return (units.cast(T.DecimalType(18, 0)) * F.lit(CENT)).cast(PRICE)


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars with tie-break columns ``tie1`` (line number), ``tie2`` (part key).

    Prices are built in integer cents and converted to DECIMAL once: the
    staging filters are pushed below this projection and inline it, so its
    arithmetic must stay cheap.
    """
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("bigint")
    base = F.lit(100000) + _cents("l_extendedprice") % 10000
    up = _cents("l_tax") * qty
    dn = _cents("l_discount") * qty
    line = F.col("l_linenumber")
    close_units = base + up - dn + F.when(line == 6, dn * 2).otherwise(F.lit(0))
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("date"),
        _price(base).alias("open"),
        _price(base + up).alias("high"),
        _price(base - dn).alias("low"),
        F.when(line == 7, F.lit(None).cast(PRICE)).otherwise(_price(close_units)).alias("close"),
        ((qty - 1) * 1000).alias("volume"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("l_orderkey"))).alias("ingestion_timestamp"),
        F.lit("lineitem").alias("source_system"),
        F.concat(F.lit("run_"), (F.col("l_orderkey") % 5).cast("string")).alias("pipeline_run_id"),
        line.alias("tie1"),
        F.col("l_partkey").alias("tie2"),
    )


def raw_bars_order() -> list[F.Column]:
    """Dedup order for raw_bars: newest load first, then the tie columns."""
    return [F.col("ingestion_timestamp").desc_nulls_last(), F.col("tie1").desc(), F.col("tie2").desc()]


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars per user from ``events``: symbol ``U<user_id>``.

    open/close are the first/last value by (ts, event_id); high/low the
    extremes; volume the event count. One aggregation with a map-side partial
    step, so a hot user collapses before the shuffle; ordered by a struct, it is
    sort-based, and each task sorts its rows.
    """
    ev = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    return (ev.groupBy(
                F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                F.col("ts").cast("date").alias("date"))
            .agg(F.min_by("value", order).cast(PRICE).alias("open"),
                 F.max("value").cast(PRICE).alias("high"),
                 F.min("value").cast(PRICE).alias("low"),
                 F.max_by("value", order).cast(PRICE).alias("close"),
                 F.count(F.lit(1)).alias("volume"),
                 F.max("ts").alias("ingestion_timestamp"))
            .withColumn("source_system", F.lit("events"))
            .withColumn("pipeline_run_id", F.date_format("ingestion_timestamp", "yyyyMMdd")))


def flag_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per ``lineitem`` flag pair (return flag + line status).

    A short, data-derived symbol list (a handful of pairs) whose series grow
    with ``lineitem``: the shape of a vendor's multi-ticker panel.
    """
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    # (order, line) repeats in this table; the price itself ends the tie-break.
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return (li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("symbol"),
                       F.col("l_shipdate").cast("date").alias("date"))
              .agg(F.min_by(price, seq).cast(PRICE).alias("open"),
                   F.max(price).cast(PRICE).alias("high"),
                   F.min(price).cast(PRICE).alias("low"),
                   F.max_by(price, seq).cast(PRICE).alias("close"),
                   F.sum("l_quantity").cast("bigint").alias("volume")))
