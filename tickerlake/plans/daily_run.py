"""The daily run (X6): gate -> ledger -> load -> reconcile -> stage -> marts -> tests.

One driver program replaces the original's chain of scheduled tasks; each
stage stays a separate function so it can be rerun alone. Staging and all
series columns are computed once and written into the shared folder
(``spark.checkpoint.dir``) and deleted at the end; the staging table and the
three marts are projections of that written table: one shuffle for dedup, one
for the series windows, and one per stored table to lay it out by date.

A run can be lost at any step. The bars it may have changed are in the ledger
before it changes a table; the next run, of the same batch or another, rebuilds
the staging dates of lost runs from bronze and every mart row that they reach, so stored
tables equal a full rebuild of bronze again. Bronze is kept by load, one per
run id, so a batch that is run again is there once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tickerlake import schema as S
from tickerlake.operators import marts, quality, staging
from tickerlake.operators.partition_metrics import MetricsTable, counters
from tickerlake.plans.ledger import Ledger
from tickerlake.session import Cut, together, tuned
from tickerlake.sources import tables
from tickerlake.streaming import refresh


@dataclass
class DailyRun:
    loaded_rows: int
    load_status: str
    gate: list
    suite: DataFrame
    summary: DataFrame
    tables: dict[str, str] = field(default_factory=dict)
    run_id: str = ""
    recovered: list[str] = field(default_factory=list)


def table_paths(workdir: str) -> dict[str, str]:
    root = workdir.rstrip("/")
    return {
        "stock_prices_raw": f"{root}/{S.BRONZE_LAYER}/{S.BRONZE_TABLE}",
        "stg_stock_prices": f"{root}/{S.SILVER_LAYER}/stg_stock_prices",
        "daily_returns": f"{root}/{S.GOLD_LAYER}/daily_returns",
        "moving_averages": f"{root}/{S.GOLD_LAYER}/moving_averages",
        "volume_analysis": f"{root}/{S.GOLD_LAYER}/volume_analysis",
    }


LAYER_OF = {"stock_prices_raw": S.BRONZE_LAYER, "stg_stock_prices": S.SILVER_LAYER}


MART_NAMES = ("daily_returns", "moving_averages", "volume_analysis")
PART_OF = {"stock_prices_raw": tables.LOAD, "stg_stock_prices": "date", **{n: "date" for n in MART_NAMES}}


def full_features(bronze: DataFrame, order, keep: Sequence[str]) -> DataFrame:
    """Staging and all series columns of all bronze history: one dedup shuffle,
    one window pass."""
    return marts.series_features(staging.stage(bronze, order, keep))


def _full_build(spark: SparkSession, paths: dict[str, str], order, keep: Sequence[str]) -> None:
    """Stage all bronze history once, then every mart from one window pass."""
    bronze = tables.read_table(spark, paths["stock_prices_raw"]).drop(tables.LOAD)
    with Cut(full_features(bronze, order, keep), "features") as features:
        stored = {"stg_stock_prices": features.select(*S.STAGED_COLUMNS, *keep), **marts.marts_from_features(features)}     # T8, R5, M5, V5
        together(*[partial(tables.publish_table, df, paths[name], partition_by="date") for name, df in stored.items()])   # S8


def _rebuild_dates(spark: SparkSession, paths: dict[str, str], cells: DataFrame, order, keep: Sequence[str]) -> list[dt.date]:
    """Rebuild from bronze the staging dates of ``cells``, bars that lost runs
    may have changed: a lost write may have removed a partition and not put the new one in
    its place. Returns those dates."""
    dates = sorted(r["date"] for r in cells.select("date").distinct().collect())        # trading days
    bronze = tables.on_dates(tables.read_table(spark, paths["stock_prices_raw"]), dates)
    with Cut(staging.stage(bronze, order, keep), "recovered") as rebuilt:
        if not rebuilt.isEmpty():
            tables.replace_partitions(rebuilt, paths["stg_stock_prices"], "date", ("symbol",))
    return dates


def _whole_dates(spark: SparkSession, paths: dict[str, str], lost: DataFrame) -> DataFrame:
    """The cells that repair the marts after lost runs: what their bars reach,
    and every bar of each date on which that is."""
    reach = lost.select("symbol", "date", F.lit(refresh.LOOKBACK_ROWS).alias("reach"))
    reached = refresh.reached_dates(spark, paths["stg_stock_prices"], reach)
    whole = tables.on_dates(tables.read_table(spark, paths["stg_stock_prices"]), reached)
    return reach.unionByName(whole.select("symbol", "date", F.lit(0).alias("reach")))


def _fold_batch(spark: SparkSession, batch: DataFrame, paths: dict[str, str], order, keep: Sequence[str], lost: DataFrame | None,
                on_step: Callable[[str], None]) -> tuple[list[dt.date], list[dt.date]]:
    """Upsert the batch into staging, refresh the mart dates it reaches,
    and repair what lost runs left. Returns the dates rewritten in staging and in the marts."""
    again = [] if lost is None else _rebuild_dates(spark, paths, lost, order, keep)
    refresh.upsert_into(spark, paths["stg_stock_prices"], batch, order, keep)
    on_step("staged")
    cells = refresh.changed_cells(batch)
    if lost is not None:
        cells = cells.unionByName(_whole_dates(spark, paths, lost))
    with Cut(cells, "cells") as changed:
        staged = sorted({*again, *(r["date"] for r in refresh.changed_cells(batch).select("date").distinct().collect())})
        marts_on = refresh.refresh_mart_tables(spark, paths["stg_stock_prices"], {n: paths[n] for n in MART_NAMES}, changed)
    return staged, marts_on


def _load(spark: SparkSession, landed: DataFrame, target: str, load_id: str, cols: Sequence[str], extracted: int, here: Row) -> tuple[int, str]:
    """The batch, whose digest is ``here``, as the load ``load_id`` of bronze, and its status.
    A load that is there to its end is kept; it must hold this batch. The rows
    read back must be those of the batch, by content."""
    kept = tables.has_load(spark, target, load_id)
    loaded = None if kept else tables.load_into(landed, target, load_id)
    stored = tables.read_load(spark, target, load_id)
    there = quality.content_digest(stored, cols).first()
    loaded = there["rows"] if loaded is None else loaded
    status = quality.load_status(extracted, loaded)
    if here != there and (kept or status == "match"):
        odd = quality.reconcile_content(landed, stored, cols).filter("status <> 'match'").limit(5).collect()
        why = "its load is there with other rows" if kept else "the rows read back are not the batch's"
        raise ValueError(f"run {load_id}: {why}: {[r.asDict() for r in odd]}")
    return loaded, status


def run_daily(spark: SparkSession, batch: DataFrame, workdir: str,
              order: Sequence[Column] | None = None, keep: Sequence[str] = (),
              symbols: Sequence[str] = S.DEFAULT_SYMBOLS, enforce_suite: bool = False,
              incremental: bool = False, run_id: str | None = None,
              on_step: Callable[[str], None] = lambda step: None) -> DailyRun:
    """Run every stage over ``batch``; stops at the first failed gate.

    Gates: Q4 and the loader's Q1-Q3, evaluated together in one pass over the
    batch; then Q9: no rows loaded fails, a partial load passes and is
    reported, and the load read back must hold the batch's rows (order-free
    digests; bronze history is not read). The declared test suite (Q8) is
    returned, and raised on only with ``enforce_suite``.

    ``run_id`` names the batch's load in bronze; by default it is a digest of the batch's
    content, so the same batch run again is one load. ``on_step`` is called
    after each step (opened, loaded, staged, marts, tested, ended).

    ``incremental``: after the first run, the batch is folded into the stored
    staging table (only touched dates read and rewritten) instead of
    re-deduplicating all bronze history; in the marts only the bars that the
    batch reaches are made anew, and only their dates rewritten; the suite and
    the layer summary add up stored counters, counted anew for the rewritten
    partitions only. Both modes store staging and marts by date, so
    runs of either kind may follow each other; results equal a full run.
    After a full run was lost the next one is a full one.

    The batch is read once: every step reads the copy the run starts with.
    """
    spark = tuned(spark)
    paths, cols = table_paths(workdir), [*S.RAW_COLUMNS, *keep]
    bronze, book = paths["stock_prices_raw"], Ledger(spark, workdir)
    with Cut(batch.select(*cols), "batch") as landed:
        gate, content = together(quality.gate_report(landed).collect,            # Q1-Q4, one pass
                                 quality.content_digest(landed, cols).first)     # for the run id and Q9
        failed = [r.check_name for r in gate if not r.passed]
        if failed:
            raise ValueError(f"the gate refused the batch: {failed}")
        extracted = next(r.observed for r in gate if r.check_name == "has_data")
        if run_id is None:
            run_id = "run-" + "-".join(f"{abs(int(v)):x}{'n' if v < 0 else ''}" for v in content)
        lost = book.open_runs()
        stored = all(tables.table_exists(spark, paths[n]) for n in ("stg_stock_prices", *MART_NAMES))
        mode = "incremental" if incremental and stored and all(m == "incremental" for _, m in lost) else "full"
        missed = None
        for name, how in lost:
            cells = book.cells(name, how)
            missed = cells if missed is None else missed.unionByName(cells)
        with Cut(missed.distinct(), "lost") if lost else nullcontext() as before:
            book.open(run_id, mode, refresh.changed_cells(landed), extracted)
            on_step("opened")
            loaded, status = _load(spark, landed, bronze, run_id, cols, extracted, content)       # S4, Q9
            if status == "failed":
                raise ValueError(f"nothing was loaded of {extracted} rows")
            on_step("loaded")
            suite = quality.default_suite(symbols)
            metrics = MetricsTable(spark, workdir.rstrip("/") + "/METRICS/partition_counters", suite)
            if mode == "incremental":
                staged_on, marts_on = _fold_batch(spark, landed, paths, order, keep, before, on_step)
            else:
                _full_build(spark, paths, order, keep)
            on_step("marts")
    every = {name: tables.read_table(spark, p) for name, p in paths.items()}
    if mode == "incremental" and metrics.usable():
        loads = [run_id, *[r for r, _ in lost if tables.has_load(spark, bronze, r)]]
        touched = {"stock_prices_raw": every["stock_prices_raw"].filter(F.col(tables.LOAD).isin(loads)),
                   "stg_stock_prices": tables.on_dates(every["stg_stock_prices"], staged_on),
                   **{n: tables.on_dates(every[n], marts_on) for n in MART_NAMES}}
        metrics.add([counters(df, PART_OF[n], n, suite[n]) for n, df in touched.items()])
    else:
        metrics.replace([counters(df, PART_OF[n], n, suite[n]) for n, df in every.items()])
    tables.publish_view(every["stg_stock_prices"].select(*S.STAGED_COLUMNS), "stg_stock_prices")     # S7
    report = metrics.suite_report()                                              # Q8
    if enforce_suite:
        quality.enforce(report)
    on_step("tested")
    for name, how in lost:
        if (name, how) != (run_id, mode):
            book.end(name, how, "recovered")
    book.end(run_id, mode, rows=loaded)
    on_step("ended")
    summary = metrics.layer_counts({n: LAYER_OF.get(n, S.GOLD_LAYER) for n in paths})     # P4
    return DailyRun(loaded, status, [r.asDict() for r in gate], report, summary, paths, run_id, [r for r, _ in lost])


def main(argv: Sequence[str] | None = None) -> int:
    """``spark-submit --py-files tickerlake.zip tickerlake/plans/daily_run.py --landing <csv dir>
    --workdir <dir>`` (locally: ``python -m tickerlake.plans.daily_run ...``).

    Reads the landed CSV batch (S1, S2), runs ``run_daily`` and prints the layer
    summary and the declared tests. Exit status 1 if a declared test fails
    with ``--enforce-suite``.
    """
    import argparse

    from tickerlake.session import get_session
    from tickerlake.sources.csv import quarantine_malformed

    ap = argparse.ArgumentParser(prog="tickerlake.plans.daily_run")
    ap.add_argument("--landing", required=True, help="folder of landed header CSV files")
    ap.add_argument("--workdir", required=True, help="root of the RAW / STAGING / MARTS tables")
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--enforce-suite", action="store_true")
    ap.add_argument("--symbols", default=",".join(S.DEFAULT_SYMBOLS),
                    help="comma-separated accepted symbols")
    args = ap.parse_args(argv)
    spark = get_session(app="tickerlake-daily")
    # A line that is torn or holds a value that does not parse stops the run.
    batch, bad = quarantine_malformed(spark, args.landing)
    refused = bad.limit(20).collect()
    if refused:
        for r in refused:
            print(f"refused {r.reasons}: {r.raw_line}")
        return 1
    try:
        out = run_daily(spark, batch, args.workdir, symbols=args.symbols.split(","),
                        enforce_suite=args.enforce_suite, incremental=args.incremental)
    except ValueError as e:
        print(f"stopped: {e}")
        return 1
    print(f"loaded {out.loaded_rows} rows ({out.load_status})")
    out.summary.show(truncate=False)
    out.suite.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
