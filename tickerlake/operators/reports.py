"""Reports over staged bars and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.operators.ingest import _date


def summary_by_symbol(df: DataFrame, price: str = "close_price") -> DataFrame:
    """Min, max, mean close (2 dp) and total volume per symbol.

    A hash aggregate: partial aggregation per task, then one row per symbol.
    The mean stays a DECIMAL so its rounding is exact.
    """
    p = F.col(price)
    return df.groupBy("symbol").agg(
        F.min(p).alias("min_close"),
        F.max(p).alias("max_close"),
        F.round(F.avg(p), 2).alias("mean_close"),
        F.sum("volume").alias("total_volume"),
    )


def top_gainers(returns: DataFrame, as_of, days: int = 7, n: int = 10) -> DataFrame:
    """The ``n`` highest returns in the ``days`` before ``as_of``.

    Ties break by symbol, then date, so the result repeats. ``orderBy`` +
    ``limit`` plans as TakeOrderedAndProject: each task keeps its own top n
    and only those are merged.
    """
    end = _date(as_of)
    recent = returns.filter(F.col("date").between(F.date_sub(end, days), end))
    return (recent.orderBy(F.col("daily_return_pct").desc_nulls_last(), "symbol", "date")
                  .limit(n)
                  .select("symbol", "date", "daily_return_pct"))


def recent_signals(averages: DataFrame, as_of, kind: str = S.GOLDEN_CROSS, days: int = 30
                   ) -> DataFrame:
    """Crossovers of one kind in the ``days`` before ``as_of``."""
    end = _date(as_of)
    return (averages.filter((F.col("crossover_signal") == kind)
                            & F.col("date").between(F.date_sub(end, days), end))
                    .select("symbol", "date", "close_price", "crossover_signal"))


def layer_summary(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row counts per (layer, table), one global count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for (layer, name), df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layer_counts_on(base: DataFrame, views: Mapping[tuple[str, str], object]) -> DataFrame:
    """P4 for tables that are row filters of one DataFrame, in one aggregation.

    ``views`` maps (layer, table) to a row filter Column, or None for all rows.
    """
    items = list(views.items())
    agg = base.agg(*[F.count_if(F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True))
                     .alias(f"_n{i}") for i, (_, cond) in enumerate(items)])
    rows = F.array(*[F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                              F.col(f"_n{i}").alias("row_count"))
                     for i, ((layer, name), _) in enumerate(items)])
    return agg.select(F.inline(rows))
