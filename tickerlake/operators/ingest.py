"""Ingestion transforms (I1-I11): shaping vendor batches into raw bars.

Column renames and projections are metadata-only; filters are written as
plain predicates so Catalyst pushes them into the Parquet scan; calendar
generation is a per-row ``sequence`` + ``explode`` (no cross join).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.functions.timeutil import date_lit, ntz

# --- I1 / I2 / I4: names, batch metadata, canonical columns -----------------


def clean_name(name: str) -> str:
    """Lower-case, spaces to ``_``, then drop anything outside [a-z0-9_]."""
    return re.sub(r"[^a-z0-9_]", "", name.lower().replace(" ", "_"))


def clean_columns(df: DataFrame) -> DataFrame:
    """Standardise column names; raise if two names collide."""
    names = [clean_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"Column names collide after cleaning: {dupes}")
    return df.toDF(*names)


def add_metadata(df: DataFrame, run_ts: dt.datetime,
                 source: str = S.DEFAULT_SOURCE_SYSTEM) -> DataFrame:
    """The three batch constants; ``run_ts`` is passed in so reruns repeat."""
    ts = ntz(run_ts)
    return df.withColumns({
        "ingestion_timestamp": ts,
        "source_system": F.lit(source),
        "pipeline_run_id": F.date_format(ts, S.RUN_ID_FORMAT),
    })


def conform(df: DataFrame, cols: Sequence[str] = S.RAW_COLUMNS) -> DataFrame:
    """I4: keep the canonical columns that exist, in canonical order."""
    present = set(df.columns)
    return df.select(*[c for c in cols if c in present])


# --- I3: wide panel -> long bars -------------------------------------------

PANEL_FIELDS = ("Open", "High", "Low", "Close", "Volume")


def to_panel(bars: DataFrame, symbols: Sequence[str] | None = None,
             fields: Sequence[str] = ("open", "high", "low", "close", "volume"),
             index: str = "date") -> DataFrame:
    """Long bars -> a vendor-style panel: one row per date, one struct per symbol.

    The panel's width is the symbol list, so this is for the handful of
    tickers a vendor file carries; pass ``symbols`` to skip the distinct scan.
    """
    cell = F.struct(*[F.col(f).alias(f.capitalize()) for f in fields])
    grouped = bars.groupBy(index)
    pivoted = grouped.pivot("symbol", list(symbols)) if symbols else grouped.pivot("symbol")
    return pivoted.agg(F.first(cell))


def flatten_panel(panel: DataFrame, symbols: Sequence[str], fields: Sequence[str] = PANEL_FIELDS,
                  index: str = "date") -> DataFrame:
    """Wide (ticker, field) panel -> long bars, in one pass.

    One ``explode`` over an array of per-symbol structs replaces a union per
    symbol. Symbols absent from the panel are skipped; all-NULL cells are
    kept (staging drops them).
    """
    present = [s for s in symbols if s in panel.columns]
    if not present:
        return panel.sparkSession.createDataFrame([], f"symbol string, {index} date")
    cells = F.array(*[
        F.struct(F.lit(s).alias("symbol"),
                 *[F.col(f"`{s}`").getField(f).alias(f) for f in fields])
        for s in present
    ])
    return (panel.select(F.col(index), F.explode(cells).alias("_cell"))
                 .select("_cell.symbol", index, *[f"_cell.{f}" for f in fields]))


# --- I5-I8: universe and time restrictions ---------------------------------

def filter_symbols(df: DataFrame, symbols: Sequence[str] | DataFrame = S.DEFAULT_SYMBOLS) -> DataFrame:
    """Restrict to a symbol universe.

    A short list becomes an ``IN`` predicate (pushed to the scan). A universe
    given as a DataFrame (column ``symbol``) is a left-semi join; no broadcast
    hint is forced, AQE turns it into a broadcast join only after measuring
    the universe at runtime.
    """
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(list(symbols)))


_date = date_lit


def date_range(df: DataFrame, start, end, col: str = "date") -> DataFrame:
    """Bars with ``start <= date <= end``. Both bounds are required."""
    if start is None or end is None:
        raise ValueError("date_range needs both start and end")
    return df.filter(F.col(col).between(_date(start), _date(end)))


def historical(df: DataFrame, days: int, as_of, col: str = "date") -> DataFrame:
    """The last ``days`` days up to ``as_of`` (both ends inclusive)."""
    end = _date(as_of)
    return df.filter(F.col(col).between(F.date_sub(end, days), end))


def latest(df: DataFrame, key: str = "symbol", order: Sequence[str] = ("date",)) -> DataFrame:
    """I8: the most recent row per symbol.

    ``max_by`` over a struct of every column, ordered by ``order`` (add tie
    columns for a total order). Struct buffers plan as a sort-based aggregate
    with a partial (map-side) step, so a symbol with many rows costs one row
    per task to shuffle.
    """
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


# --- I9-I11: calendar, expected grid, missing bars -------------------------

def _business_days(start: Column, end: Column) -> Column:
    return F.filter(F.sequence(start, end), lambda d: F.weekday(d) < 5)


def business_days(spark: SparkSession, start, end, max_days: int | None = None) -> DataFrame:
    """Monday-Friday dates from ``start`` to ``end`` inclusive, no holidays.

    With ``max_days`` (for example ``schema.MAX_CALENDAR_DAYS``) a calendar of
    more business days is an error.
    """
    one = spark.range(1).select(_business_days(_date(start), _date(end)).alias("d"))
    return _explode_calendar(one, max_days)


def calendar_of(bars: DataFrame, max_days: int | None = None) -> DataFrame:
    """I9 over data: the business days spanning the bars' first to last date."""
    span = bars.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return _explode_calendar(span.select(_business_days(F.col("lo"), F.col("hi")).alias("d")), max_days)


def _explode_calendar(df: DataFrame, max_days: int | None) -> DataFrame:
    d = F.col("d")
    if max_days is not None:
        d = F.when(F.size(d) > max_days,
                   F.raise_error(F.concat(F.lit("calendar has "), F.size(d).cast("string"),
                                          F.lit(f" business days, allowed are {max_days}")))).otherwise(d)
    return df.select(F.explode(d).alias("date"))


def _span(bars: DataFrame, start, end) -> tuple[Column, Column]:
    """The bounds given, or else the first and last date of all bars: one row,
    read from the data only where a bound is missing."""
    if start is None or end is None:
        seen = bars.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        start, end = start or seen["lo"], end or seen["hi"]
    if start is None or end is None:                       # no bars, no bounds: an empty span
        return date_lit("1970-01-02"), date_lit("1970-01-01")
    return _date(start), _date(end)


def _days_between(lo: Column, hi: Column) -> Column:
    """Business days from ``lo`` to ``hi``; none when ``hi`` comes first."""
    return F.when(lo <= hi, _business_days(lo, hi)).otherwise(F.array().cast("array<date>"))


def expected_grid(bars: DataFrame, start=None, end=None, per_symbol: bool = False) -> DataFrame:
    """Every (symbol, business day) that should hold a bar.

    The calendar runs from ``start`` to ``end``, by default over the span of
    all bars, and is the same for each symbol: a symbol that sent nothing on
    the last day has that cell. With ``per_symbol`` it runs from the symbol's
    own first to its last bar, within ``start`` and ``end`` if given. Each
    symbol's days are generated from its own row; no cross join is planned.
    """
    if per_symbol:
        span = bars.groupBy("symbol").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        lo = F.col("lo") if start is None else F.greatest("lo", _date(start))
        hi = F.col("hi") if end is None else F.least("hi", _date(end))
        return span.select("symbol", F.explode(_days_between(lo, hi)).alias("date"))
    lo, hi = _span(bars, start, end)
    return bars.select("symbol").distinct().select("symbol", F.explode(_days_between(lo, hi)).alias("date"))


def missing_bars(bars: DataFrame, grid: DataFrame | None = None, start=None, end=None,
                 per_symbol: bool = False) -> DataFrame:
    """Expected cells without a bar.

    Without ``grid`` the cells are those of ``expected_grid`` with the same
    arguments: a symbol's missing days lie before its first bar, between a bar
    and the next, and after its last one. So one window per symbol and an
    ``explode`` of each gap find them: one shuffle, no join, and the bars are
    read once (twice, where the span of all bars has to be found first).
    An explicit ``grid`` is matched with a left-anti join on (symbol, date).
    """
    if grid is not None:
        return grid.join(bars.select("symbol", "date"), ["symbol", "date"], "left_anti")
    w = Window.partitionBy("symbol").orderBy("date")
    near = bars.select("symbol", "date").withColumns({
        "_next": F.lead("date").over(w), "_prev": F.lag("date").over(w)})
    after, before = F.date_add("date", 1), F.date_sub("date", 1)
    # A repeated date gives an empty gap, so duplicates need no distinct.
    if per_symbol:
        lo = after if start is None else F.greatest(after, _date(start))
        until = F.date_sub("_next", 1)
        hi = until if end is None else F.least(until, _date(end))
        gaps = F.when(F.col("_next").isNotNull(), _days_between(lo, hi)).otherwise(F.array().cast("array<date>"))
    else:
        first, last = _span(bars, start, end)
        gaps = F.concat(
            F.when(F.col("_prev").isNull(), _days_between(first, F.least(before, last))).otherwise(F.array().cast("array<date>")),
            _days_between(F.greatest(after, first), F.least(F.coalesce(F.date_sub("_next", 1), last), last)))
    return near.select("symbol", F.explode(gaps).alias("date"))
