"""Silver layer: cast, validate, derive and deduplicate raw bars.

Every operator is ``DataFrame -> DataFrame``. Validity is checked *before*
deduplication, so a newer invalid row never hides an older valid one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.functions.exact import pct_half_up
from tickerlake.schema import PRICE, STAGED_COLUMNS

PRICE_COLUMNS = ("open", "high", "low", "close")
STAGED_MEASURES = ("open_price", "high_price", "low_price", "close_price", "volume")


def cast_prices(df: DataFrame) -> DataFrame:
    """Prices to DECIMAL(18,2) as ``*_price``, volume to BIGINT.

    Other columns (metadata, tie-break columns) pass through unchanged.
    """
    casts = {f"{c}_price": F.col(c).cast(PRICE) for c in PRICE_COLUMNS}
    casts["volume"] = F.col("volume").cast(T.LongType())
    rest = [c for c in df.columns if c not in PRICE_COLUMNS and c not in ("symbol", "date", "volume")]
    return df.select(
        "symbol", "date",
        *[v.alias(k) for k, v in casts.items()],
        *rest,
    )


def not_null_condition() -> Column:
    cond = F.lit(True)
    for c in STAGED_MEASURES:
        cond = cond & F.col(c).isNotNull()
    return cond


def ohlc_condition() -> Column:
    lo, hi = F.col("low_price"), F.col("high_price")
    return (lo <= hi) & F.col("open_price").between(lo, hi) & F.col("close_price").between(lo, hi)


def positive_condition() -> Column:
    return (F.col("close_price") > 0) & (F.col("volume") > 0)


def drop_null_bars(df: DataFrame) -> DataFrame:
    """All five measures present."""
    return df.filter(not_null_condition())


def valid_ohlc(df: DataFrame) -> DataFrame:
    """Low <= high, open and close within [low, high] (inclusive)."""
    return df.filter(ohlc_condition())


def positive_bars(df: DataFrame) -> DataFrame:
    """T4: close > 0 and volume > 0."""
    return df.filter(positive_condition())


def with_daily_range(df: DataFrame) -> DataFrame:
    """T5: high - low."""
    return df.withColumn("daily_range", F.col("high_price") - F.col("low_price"))


def with_daily_change_pct(df: DataFrame) -> DataFrame:
    """round((close - open) / open * 100, 2); NULL when open is 0."""
    return df.withColumn(
        "daily_change_pct",
        pct_half_up(F.col("close_price") - F.col("open_price"), F.col("open_price"), operand_scale=2),
    )


def default_order() -> list[Column]:
    """Total latest-wins order: newest load, then run id, then the measures."""
    return [
        F.col("ingestion_timestamp").desc_nulls_last(),
        F.col("pipeline_run_id").desc_nulls_last(),
        *[F.col(c).desc_nulls_last() for c in STAGED_MEASURES],
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("symbol", "date"),
                   order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per key under ``order`` (ROW_NUMBER = 1).

    Catalyst plans this as a partial WindowGroupLimit before the shuffle and a
    final one after it, so every map task forwards at most one row per key:
    a key with a huge number of copies collapses before it is shuffled.
    """
    w = Window.partitionBy(*keys).orderBy(*(order or default_order()))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def keyed_bars(df: DataFrame) -> DataFrame:
    """Bars with a symbol and a date. The load gate stops the others; a row
    that comes another way is left out here and reported by T9, on the full
    and the incremental path alike."""
    return df.filter(F.col("symbol").isNotNull() & F.col("date").isNotNull())


def valid(raw: DataFrame) -> DataFrame:
    """Cast and validate, before deduplication."""
    return positive_bars(valid_ohlc(drop_null_bars(keyed_bars(cast_prices(raw)))))


def derive(df: DataFrame) -> DataFrame:
    """The derived columns."""
    return with_daily_change_pct(with_daily_range(df))


def clean(raw: DataFrame) -> DataFrame:
    """T1-T6 on every valid row."""
    return derive(valid(raw))


def stage(raw: DataFrame, order: Sequence[Column] | None = None,
          keep: Sequence[str] = ()) -> DataFrame:
    """The staging view: T1-T7 composed, 12 published columns (+ ``keep``).

    Validity is checked before deduplication; the derived columns are pure
    functions of the surviving row, so they are computed after it and the
    duplicates never pay for them.
    """
    deduped = latest_per_key(valid(raw), ("symbol", "date"), order)
    return derive(deduped).select(*STAGED_COLUMNS, *keep)


def reject_reasons() -> Column:
    """Array of the staging rules a (cast) row breaks; empty when it passes."""
    rules = [
        ("null_" + c, F.col(c).isNull()) for c in ("symbol", "date", *STAGED_MEASURES)
    ] + [
        ("low_above_high", F.col("low_price") > F.col("high_price")),
        ("open_outside_range", ~F.col("open_price").between(F.col("low_price"), F.col("high_price"))),
        ("close_outside_range", ~F.col("close_price").between(F.col("low_price"), F.col("high_price"))),
        ("close_not_positive", F.col("close_price") <= 0),
        ("volume_not_positive", F.col("volume") <= 0),
    ]
    # A comparison with a NULL operand is NULL: the row already carries a
    # null_* reason, so coalesce the rule to false.
    return F.filter(
        F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules]),
        lambda x: x.isNotNull(),
    )


def rejects(raw: DataFrame) -> DataFrame:
    """Every row staging drops for validity, with the list of reasons."""
    return (cast_prices(raw)
            .withColumn("reasons", reject_reasons())
            .filter(F.size("reasons") > 0))
