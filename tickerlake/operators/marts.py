"""Gold layer: daily returns, moving averages with crossovers, volume analysis.

All series windows share one spec, ``PARTITION BY symbol ORDER BY date``, so
Catalyst evaluates every LAG / rolling average of a mart in one Exchange +
Sort and a chain of Window nodes, and prunes the window columns a query
does not select. A symbol's partition holds at most one row per calendar day
after staging (one bar per symbol and date), so no window group can grow
with the volume of raw loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.functions import labels
from tickerlake.functions.exact import as_decimal, pct_half_up, ratio_half_up


def series() -> Window:
    """PARTITION BY symbol ORDER BY date."""
    return Window.partitionBy("symbol").orderBy("date")


def frame(rows: int) -> Window:
    """ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW."""
    return series().rowsBetween(-(rows - 1), Window.currentRow)


# --- daily returns (R1-R5) -------------------------------------------------

def with_prev_close(df: DataFrame) -> DataFrame:
    """Previous available bar's close (not the previous calendar day)."""
    return df.withColumn("prev_close_price", F.lag("close_price").over(series()))


def with_daily_change(df: DataFrame) -> DataFrame:
    """R2: close - previous close."""
    return df.withColumn("daily_change_inr", F.col("close_price") - F.col("prev_close_price"))


def daily_return_pct(close="close_price", prev="prev_close_price") -> Column:
    """round((close - prev) / prev * 100, 2), exact."""
    c, p = F.col(close), F.col(prev)
    return pct_half_up(c - p, p, operand_scale=2)


def with_daily_return_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("daily_return_pct", daily_return_pct())


def with_return_category(df: DataFrame) -> DataFrame:
    """Label of the rounded return."""
    return df.withColumn("return_category", labels.return_category("daily_return_pct"))


def daily_returns(staged: DataFrame) -> DataFrame:
    """The daily_returns mart; each symbol's first bar is dropped."""
    df = with_return_category(with_daily_return_pct(with_daily_change(with_prev_close(staged))))
    return df.filter(F.col("prev_close_price").isNotNull()).select(*S.DAILY_RETURNS_COLUMNS)


# --- moving averages (M1-M5) -----------------------------------------------

def moving_avg(col, rows: int, scale: int) -> Column:
    """M1: round(avg(col), scale) over the last ``rows`` bars (short at the start).

    Integral columns are averaged as DECIMAL(20,0) so the mean stays exact
    (a BIGINT average would be a DOUBLE).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c).over(frame(rows)), scale)


def with_moving_averages(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ma_7_day": moving_avg("close_price", S.FAST_MA_ROWS, 2),
        "ma_30_day": moving_avg("close_price", S.SLOW_MA_ROWS, 2),
        "avg_volume_7_day": moving_avg(as_decimal("volume"), S.VOLUME_MA_ROWS, 0),
    })


def with_prev_averages(df: DataFrame) -> DataFrame:
    """M2: previous bar's rounded averages."""
    return df.withColumns({
        "prev_ma_7_day": F.lag("ma_7_day").over(series()),
        "prev_ma_30_day": F.lag("ma_30_day").over(series()),
    })


def with_crossover(df: DataFrame, fast: str = "ma_7_day", slow: str = "ma_30_day",
                   min_rows: int = 0) -> DataFrame:
    """M3: Golden / Death Cross against the previous bar.

    By default a symbol's 8th bar can already signal: its first 7 bars have
    equal averages and the comparison with the previous bar includes
    equality. ``min_rows`` suppresses signals on a symbol's first
    ``min_rows`` bars.
    """
    signal = labels.crossover_signal(fast, slow, f"prev_{fast}", f"prev_{slow}")
    if min_rows:
        signal = F.when(F.row_number().over(series()) > min_rows, signal)
    return df.withColumn("crossover_signal", signal)


def distance_pct(price, avg) -> Column:
    """M4: round((price - avg) / avg * 100, 2), exact."""
    p = F.col(price) if isinstance(price, str) else price
    a = F.col(avg) if isinstance(avg, str) else avg
    return pct_half_up(p - a, a, operand_scale=2)


def moving_averages(staged: DataFrame, min_rows: int = 0) -> DataFrame:
    """M5: the moving_averages mart (previous averages are not exported)."""
    df = with_crossover(with_prev_averages(with_moving_averages(staged)), min_rows=min_rows)
    return (df.withColumns({
                "distance_from_ma7_pct": distance_pct("close_price", "ma_7_day"),
                "distance_from_ma30_pct": distance_pct("close_price", "ma_30_day"),
            })
            .select(*S.MOVING_AVERAGES_COLUMNS))


# --- volume analysis (V1-V5) -----------------------------------------------

def with_volume_vs_avg(df: DataFrame, rows: int = S.VOLUME_MA_ROWS) -> DataFrame:
    """V1: 7-bar average volume (0 dp) and volume / unrounded average x 100 (0 dp).

    One frame sum and count feed both: the average is round_half_up(sum / n)
    (the value ``round(avg(volume), 0)`` gives), and volume / (sum / n) * 100
    is the single exact division volume * n * 100 / sum. The current bar is
    inside its own frame.
    """
    vol = as_decimal("volume")
    w = frame(rows)
    df = df.withColumns({"_vsum": F.sum(vol).over(w), "_vn": F.count(vol).over(w)})
    n = F.col("_vn")
    return df.withColumns({
        "avg_volume_7d": ratio_half_up(F.col("_vsum"), n, 0, operand_scale=0),
        "volume_vs_avg_pct": ratio_half_up(vol * n.cast("int"), F.col("_vsum"), 0, factor=100,
                                           operand_scale=0),
    }).drop("_vsum", "_vn")


def with_price_change_pct(df: DataFrame) -> DataFrame:
    """V2: same formula as R3."""
    prev = F.lag("close_price").over(series())
    return df.withColumn("price_change_pct", pct_half_up(F.col("close_price") - prev, prev, operand_scale=2))


def with_volume_labels(df: DataFrame) -> DataFrame:
    """V3 + V4: volume category and trend strength."""
    return df.withColumns({
        "volume_category": labels.volume_category("volume_vs_avg_pct"),
        "trend_strength": labels.trend_strength("price_change_pct", "volume_vs_avg_pct"),
    })


def volume_analysis(staged: DataFrame) -> DataFrame:
    """V5: the volume_analysis mart (first bars kept)."""
    df = with_volume_labels(with_price_change_pct(with_volume_vs_avg(staged)))
    return df.filter(F.col("avg_volume_7d").isNotNull()).select(*S.VOLUME_ANALYSIS_COLUMNS)


# --- all marts from one window pass ----------------------------------------

def series_features(staged: DataFrame) -> DataFrame:
    """Every series column of the three marts, from one Exchange + Sort.

    The moving-average columns, LAGs, distances and volume ratios all share
    ``PARTITION BY symbol ORDER BY date``; computing them together lets a
    caller checkpoint one table and project the marts from it without
    another shuffle.
    """
    df = with_volume_vs_avg(with_moving_averages(with_prev_close(staged)))
    df = with_crossover(with_prev_averages(df))
    df = df.withColumns({
        "daily_change_inr": F.col("close_price") - F.col("prev_close_price"),
        "daily_return_pct": daily_return_pct(),
        "price_change_pct": daily_return_pct(),
        "distance_from_ma7_pct": distance_pct("close_price", "ma_7_day"),
        "distance_from_ma30_pct": distance_pct("close_price", "ma_30_day"),
    })
    return with_volume_labels(with_return_category(df))


MART_COLUMNS = {
    "daily_returns": S.DAILY_RETURNS_COLUMNS,
    "moving_averages": S.MOVING_AVERAGES_COLUMNS,
    "volume_analysis": S.VOLUME_ANALYSIS_COLUMNS,
}


def mart_filters() -> dict[str, Column | None]:
    """Each mart's rows as a filter of ``series_features`` (None: every row)."""
    return {
        "daily_returns": F.col("prev_close_price").isNotNull(),
        "moving_averages": None,
        "volume_analysis": F.col("avg_volume_7d").isNotNull(),
    }


def marts_from_features(features: DataFrame) -> dict[str, DataFrame]:
    """The three marts as projections of ``series_features``."""
    out = {}
    for name, cond in mart_filters().items():
        rows = features if cond is None else features.filter(cond)
        out[name] = rows.select(*MART_COLUMNS[name])
    return out
