"""Data-quality checks (Q1-Q9) as report DataFrames.

All checks over one table are evaluated in **one** aggregation (partial
aggregates per task, one tiny final merge) and unpivoted into a report
``(test, column_name, failing_rows, passed)``. Nothing is collected except by
``enforce``, whose input is bounded by the number of declared checks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake import schema as S


@dataclass(frozen=True)
class Check:
    """One declared test: a name, a column and the predicate of a failing row
    (a NULL predicate does not count as a failure)."""
    test: str
    column: str
    failing: Column


def count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def report(df: DataFrame, checks: Sequence[Check], tables: Sequence[str] | None = None,
           where: Sequence[Column | None] | None = None) -> DataFrame:
    """Evaluate ``checks`` in one aggregation; one report row per check.

    ``where`` restricts a check to the rows of a view (a row filter of
    ``df``); ``tables`` names the table of each check in the report.
    """
    conds = [c.failing if not where or where[i] is None else (where[i] & c.failing)
             for i, c in enumerate(checks)]
    agg = df.agg(*[count_if(cond).cast("bigint").alias(f"_c{i}") for i, cond in enumerate(conds)])
    rows = F.array(*[
        F.struct(*([F.lit(tables[i]).alias("table_name")] if tables else []),
                 F.lit(c.test).alias("test"), F.lit(c.column).alias("column_name"),
                 F.col(f"_c{i}").alias("failing_rows"))
        for i, c in enumerate(checks)
    ])
    return (agg.select(F.inline(rows))
               .withColumn("passed", F.col("failing_rows") == 0))


# --- Q1-Q3: the loader's gate ---------------------------------------------

def require_columns(df: DataFrame, cols: Sequence[str] = S.REQUIRED_COLUMNS) -> DataFrame:
    """Q1: one row per required column: present or not, with the rows checked."""
    present = set(df.columns)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"))
        for c in cols
    ])
    return (df.agg(F.count(F.lit(1)).alias("rows_checked"))
              .select(F.inline(rows), "rows_checked"))


def null_counts(df: DataFrame, cols: Sequence[str] = S.NOT_NULL_AT_LOAD) -> DataFrame:
    """Q2: NULLs per column."""
    return report(df, [Check("null_count", c, F.col(c).isNull()) for c in cols])


def ohlc_violations(df: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """Q3: rows with low > high (a NULL side does not count)."""
    return report(df, [Check("low_above_high", f"{low},{high}", F.col(low) > F.col(high))])


def load_checks(df: DataFrame) -> DataFrame:
    """Q1-Q3 together, as run before a load."""
    missing = [c for c in S.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"batch lacks columns {missing}")
    checks = [Check("null_count", c, F.col(c).isNull()) for c in S.NOT_NULL_AT_LOAD]
    checks.append(Check("low_above_high", "low,high", F.col("low") > F.col("high")))
    return report(df, checks)


# --- Q4: the batch gate ----------------------------------------------------

def batch_gate(df: DataFrame) -> DataFrame:
    """Q4: has_data, has_symbols, no_null_close, valid_ohlc, all reported together.

    ``observed`` is the row count, the non-NULL symbol count (a distinct count
    is positive exactly when it is), the NULL closes, and the rows where
    ``low <= high`` is not true (a NULL side fails here, unlike Q3).
    """
    agg = df.agg(
        F.count(F.lit(1)).alias("has_data"),
        F.count("symbol").alias("has_symbols"),
        count_if(F.col("close").isNull()).alias("no_null_close"),
        count_if(~F.coalesce(F.col("low") <= F.col("high"), F.lit(False))).alias("valid_ohlc"),
    )
    def row(name: str, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), F.col(name).alias("observed"),
                        passed.alias("passed"))

    rows = F.array(
        row("has_data", F.col("has_data") > 0),
        row("has_symbols", F.col("has_symbols") > 0),
        row("no_null_close", F.col("no_null_close") == 0),
        row("valid_ohlc", F.col("valid_ohlc") == 0),
    )
    return agg.select(F.inline(rows))


def gate_report(df: DataFrame) -> DataFrame:
    """Q4 and the loader's Q1-Q3 in one aggregation (one pass over a batch).

    ``(check_name, observed, passed)``; the row count is the ``has_data`` row.
    Q1 is a schema check and raises before any data is read.
    """
    missing = [c for c in S.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"batch lacks columns {missing}")
    checks = {
        "has_data": (F.count(F.lit(1)), lambda c: c > 0),
        "has_symbols": (F.count("symbol"), lambda c: c > 0),
        "no_null_close": (count_if(F.col("close").isNull()), lambda c: c == 0),
        "valid_ohlc": (count_if(~F.coalesce(F.col("low") <= F.col("high"), F.lit(False))),
                       lambda c: c == 0),
        **{f"null_{c}": (count_if(F.col(c).isNull()), lambda c: c == 0)
           for c in S.NOT_NULL_AT_LOAD if c != "close"},
        "low_above_high": (count_if(F.col("low") > F.col("high")), lambda c: c == 0),
    }
    agg = df.agg(*[e.alias(n) for n, (e, _) in checks.items()])
    rows = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(n).alias("observed"),
                 ok(F.col(n)).alias("passed"))
        for n, (_, ok) in checks.items()
    ])
    return agg.select(F.inline(rows))


# --- Q5-Q7: declared table tests ------------------------------------------

def not_null(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Q5: ``not_null`` on one or more columns."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return report(df, not_null_checks(cols))


def not_null_checks(cols: Iterable[str]) -> list[Check]:
    return [Check("not_null", c, F.col(c).isNull()) for c in cols]


def accepted_values(df: DataFrame, col: str,
                    values: Sequence[str] | DataFrame = S.DEFAULT_SYMBOLS) -> DataFrame:
    """Q6: values of ``col`` outside the accepted set, with their counts.

    NULL is left to ``not_null``. A short list is an ``IN`` predicate; a large
    universe given as a one-column DataFrame is a left-anti join (AQE picks
    broadcast or shuffle after measuring it). The grouped count has map-side
    partial aggregation: a hot bad value costs one row per task to shuffle.
    """
    c = F.col(col)
    present = df.filter(c.isNotNull())
    if isinstance(values, DataFrame):
        universe = values.select(F.col(values.columns[0]).alias(col)).distinct()
        bad = present.join(universe, col, "left_anti")
    else:
        bad = present.filter(~c.isin(list(values)))
    return bad.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("failing_rows"))


def accepted_values_check(col: str, values: Sequence[str]) -> Check:
    c = F.col(col)
    return Check("accepted_values", col, c.isNotNull() & ~c.isin(list(values)))


def expression_is_true(df: DataFrame, exprs: Mapping[str, str | Column]) -> DataFrame:
    """Q7: rows where an expression is false (NULL is left to ``not_null``)."""
    return report(df, expression_checks(exprs))


def expression_checks(exprs: Mapping[str, str | Column]) -> list[Check]:
    out = []
    for name, e in exprs.items():
        cond = F.expr(e) if isinstance(e, str) else e
        out.append(Check("expression_is_true", name, cond == F.lit(False)))
    return out


# --- Q8: the declared suite ------------------------------------------------

def default_suite(symbols: Sequence[str] = S.DEFAULT_SYMBOLS) -> dict[str, list[Check]]:
    """The 15 declared tests: 12 not_null, 1 accepted_values, 2 expression_is_true."""
    return {
        "stock_prices_raw": not_null_checks(["symbol", "date", "close"]),
        "stg_stock_prices": [
            *not_null_checks(["symbol"]),
            accepted_values_check("symbol", symbols),
            *not_null_checks(["date", "close_price"]),
            *expression_checks({"close_price > 0": "close_price > 0"}),
            *not_null_checks(["volume"]),
            *expression_checks({"volume > 0": "volume > 0"}),
        ],
        "daily_returns": not_null_checks(["symbol", "date"]),
        "moving_averages": not_null_checks(["symbol"]),
        "volume_analysis": not_null_checks(["symbol", "volume"]),
    }


def run_suite(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]] | None = None
              ) -> DataFrame:
    """Q8: every declared test, one aggregation per table, one report."""
    suite = suite or default_suite()
    parts = [report(tables[name], checks, [name] * len(checks))
             for name, checks in suite.items() if name in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suite_on(base: DataFrame, views: Mapping[str, Column | None],
                 suite: Mapping[str, Sequence[Check]] | None = None) -> DataFrame:
    """Q8 for tables that are row filters of one DataFrame, in ONE aggregation.

    Staging and the three marts are all row filters of ``series_features``
    (``marts.mart_filters``): evaluating their checks together computes
    staging and the window pass once, instead of once per table.
    """
    suite = suite or default_suite()
    checks, tables, where = [], [], []
    for name, cond in views.items():
        for c in suite[name]:
            checks.append(c)
            tables.append(name)
            where.append(cond)
    return report(base, checks, tables, where)


def suite_summary(results: DataFrame) -> DataFrame:
    """Counts of passed and failed tests."""
    return results.agg(F.count_if("passed").alias("tests_passed"),
                       F.count_if(~F.col("passed")).alias("tests_failed"))


def enforce(results: DataFrame, passed_col: str = "passed") -> None:
    """Raise with every failed check; the report is bounded by the checks declared."""
    name_cols = [c for c in ("table_name", "test", "check_name", "column_name") if c in results.columns]
    failed = results.filter(~F.col(passed_col)).select(*name_cols).collect()
    if failed:
        names = [":".join(str(v) for v in r) for r in failed]
        raise ValueError(f"checks not passed: {names}")


# --- Q9: load reconciliation -----------------------------------------------

def load_status(extracted_rows: int, loaded_rows: int) -> str:
    """Q9 on totals: ``match``, ``partial`` (some rows, not the same count) or ``failed``."""
    if loaded_rows == extracted_rows:
        return "match"
    return "partial" if loaded_rows > 0 else "failed"


def reconcile(extracted: DataFrame, loaded: DataFrame, key: str = "pipeline_run_id") -> DataFrame:
    """Q9: per run, rows extracted vs rows loaded.

    ``match`` when equal, ``partial`` when some but not the same number were
    loaded (the original pipeline lets this pass with a message), ``failed``
    when none were. Both sides are counted in one grouping, so a NULL run is a
    run like any other.
    """
    sides = (extracted.select(key, F.lit(1).alias("e"), F.lit(0).alias("l"))
             .union(loaded.select(key, F.lit(0).alias("e"), F.lit(1).alias("l"))))
    j = sides.groupBy(key).agg(F.sum("e").alias("extracted_rows"), F.sum("l").alias("loaded_rows"))
    status = (F.when(F.col("loaded_rows") == F.col("extracted_rows"), "match")
               .when(F.col("loaded_rows") > 0, "partial")
               .otherwise("failed"))
    return j.withColumn("status", status)


# --- Q9: reconciliation of contents --------------------------------------------

def row_digests(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row over ``cols``; each value is hashed
    with its place, so a NULL or a moved value counts."""
    told = [F.concat(F.lit(f"{i}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N"))) for i, c in enumerate(cols)]
    return [F.xxhash64(*told, F.lit(seed)).cast("decimal(20,0)") for seed in ("a", "b")]


def content_digest(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows``, ``digest_a`` and ``digest_b`` per group: sums over the rows, so
    they depend on no order, add up over partitions, and count copies."""
    a, b = row_digests(df, cols)
    told = [F.count(F.lit(1)).alias("rows"), F.sum(a).alias("digest_a"), F.sum(b).alias("digest_b")]
    return df.groupBy(*by).agg(*told) if by else df.agg(*told)


def reconcile_content(extracted: DataFrame, loaded: DataFrame, cols: Sequence[str], by: Sequence[str] = ("pipeline_run_id", "date")
                      ) -> DataFrame:
    """Q9 by content: per group (run and date), the rows extracted that are
    missing in ``loaded`` and the loaded rows that are extra, copies counted.

    First the digests of all groups are compared, a grouped sum with a
    map-side partial step. Only the groups that differ are then compared row by
    row: their rows are counted per row value on both sides. ``match``: the same
    rows; ``failed``: none loaded; ``altered``: as many rows, not the same;
    ``partial``: rows missing and none extra; ``surplus``: extra rows and none missing; else ``differs``.
    """
    by = list(by)
    both = (extracted.select(*by, *[c for c in cols if c not in by]).withColumn("_side", F.lit(1))
            .unionByName(loaded.select(*by, *[c for c in cols if c not in by]).withColumn("_side", F.lit(-1))))
    a, b = row_digests(both, cols)
    side = F.col("_side")
    groups = both.groupBy(*by).agg(F.count_if(side == 1).alias("extracted_rows"), F.count_if(side == -1).alias("loaded_rows"),
                                   F.sum(a * side).alias("_a"), F.sum(b * side).alias("_b"))
    same = (F.col("extracted_rows") == F.col("loaded_rows")) & (F.col("_a") == 0) & (F.col("_b") == 0)
    odd = groups.filter(~same).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)])
    on = None
    for i, c in enumerate(by):
        k = F.col(c).eqNullSafe(F.col(f"_k{i}"))
        on = k if on is None else on & k
    values = [c for c in cols if c not in by]
    rows = (both.join(odd, on, "left_semi").groupBy(*by, *values).agg(F.sum("_side").alias("_more"))
            .groupBy(*by).agg(F.sum(F.greatest("_more", F.lit(0))).alias("missing_rows"),
                              F.sum(F.greatest(-F.col("_more"), F.lit(0))).alias("extra_rows")))
    rows = rows.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(by)})
    out = groups.join(rows, on, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("missing_rows", "extra_rows")})
    missing, extra = F.col("missing_rows") > 0, F.col("extra_rows") > 0
    status = (F.when(~missing & ~extra, "match").when(F.col("loaded_rows") == 0, "failed")
              .when(F.col("loaded_rows") == F.col("extracted_rows"), "altered").when(~extra, "partial").when(~missing, "surplus").otherwise("differs"))
    return out.select(*by, "extracted_rows", "loaded_rows", "missing_rows", "extra_rows", status.alias("status"))
