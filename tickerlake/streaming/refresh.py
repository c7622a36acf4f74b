"""Incremental refresh: land files once (X4) and fold batches into staging and marts.

``ingest_new_files`` is a Structured Streaming query over the landing folder
with ``trigger(availableNow=True)``: the checkpoint records which files were
read, so each file is loaded exactly once across runs, and a lost executor
replays from the checkpoint. Each micro-batch is split into good and bad
lines; what it adds to bronze is a load of its number (a folder of the table), so a
replayed batch replaces its own load, and no micro-batch lists or reads another.

``upsert_latest`` keeps the staging rule (latest valid row wins per symbol and
date); because that rule picks a maximum under a total order, folding batches
one at a time equals a full rebuild. Staging and marts are stored by date in
full and incremental runs alike, and only the dates a batch changes are
rewritten.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from bisect import bisect_left
from collections.abc import Sequence
from contextlib import contextmanager
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake import schema as S
from tickerlake.operators import marts, staging
from tickerlake.session import Cut, checkpoint_root, together
from tickerlake.sources.csv import tag_lines
from tickerlake.sources.records import read_lines, records
from tickerlake.sources.tables import check_layout, load_into, on_dates, read_table, replace_partitions, stored_dates, table_exists

FILES_PER_BATCH = 1000    # landed files in a micro-batch; the rest wait for the next one
LOOKBACK_ROWS = S.SLOW_MA_ROWS   # earlier bars a mart row needs: 29 of the frame, and one for its LAG
SPANS = 64                # ranges of dates that a refresh reads, at most
LOOKBACK_DAYS = 120       # read at first; symbols with too few bars in them are read whole


def stream_checkpoint(spark: SparkSession, target: str, kind: str) -> str:
    """A stable checkpoint folder for ``target`` under ``spark.checkpoint.dir``."""
    key = hashlib.sha1(target.encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/tickerlake/streams/{kind}-{key}"


def landing_stream(spark: SparkSession, landing: str, archive: str | None = None,
                   files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Lines of landed files with their places; a file is whole in a micro-batch."""
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    return read_lines(spark, landing, streaming=True, maxFilesPerTrigger=files_per_batch, **options)


def gate_reasons() -> Column:
    """The load gate (NULL keys or close, low above high) row by row."""
    rules = [(f"null_{c}", F.col(c).isNull()) for c in S.NOT_NULL_AT_LOAD] + [("low_above_high", F.col("low") > F.col("high"))]
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())


def ingest_new_files(spark: SparkSession, landing: str, bronze: str, checkpoint: str | None = None,
                     archive: str | None = None, schema: T.StructType = S.RAW_BAR_SCHEMA,
                     quarantine: str | None = None, gate: bool = True, on_bad: str = "quarantine",
                     files_per_batch: int = FILES_PER_BATCH) -> int:
    """Append every not-yet-seen landed file to the bronze Parquet table,
    which is kept by load (``tables.load_into``), a load per micro-batch.

    A line with the wrong number of fields, a value that does not parse, or
    (with ``gate``) a row that the load gate refuses does not enter bronze: it
    goes to ``quarantine`` (by default ``<bronze>_quarantine``) as
    (raw_line, reasons), or stops the run with ``on_bad="fail"``.
    Returns the rows added by this run (0 when nothing new has landed).
    ``archive`` moves processed files aside (``cleanSource=archive``).
    """
    checkpoint = checkpoint or stream_checkpoint(spark, bronze, "ingest")
    quarantine = quarantine or bronze.rstrip("/") + "_quarantine"
    run = "stream-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:10]
    added: dict[int, int] = {}

    def load(lines: DataFrame, epoch: int) -> None:
        reasons = F.concat("reasons", F.when(F.size("reasons") == 0, gate_reasons()).otherwise(F.array().cast("array<string>"))) if gate else F.col("reasons")
        with Cut(tag_lines(records(lines), schema).withColumn("reasons", reasons), "landed") as tagged:
            bad = tagged.filter(F.size("reasons") > 0).select("raw_line", "reasons")
            if on_bad == "fail" and not bad.isEmpty():
                raise ValueError(f"landed lines refused, the first: {bad.first().asDict()}")
            good = tagged.filter(F.size("reasons") == 0).drop("raw_line", "reasons")
            added[epoch] = load_into(good, bronze, f"{run}-{epoch}")
            load_into(bad, quarantine, f"{run}-{epoch}")

    q = (landing_stream(spark, landing, archive, files_per_batch)
         .writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(added.values())


def upsert_latest(current: DataFrame, batch: DataFrame, order: Sequence[Column] | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Fold a raw batch into staged rows; equals ``stage(all raw rows)``.

    ``current`` must carry the columns ``order`` reads (``keep``). New rows are
    validated first (a newer invalid row never hides an older valid one).
    """
    fresh = staging.clean(batch).select(*S.STAGED_COLUMNS, *keep)
    merged = current.select(*S.STAGED_COLUMNS, *keep).unionByName(fresh)
    return staging.latest_per_key(merged, ("symbol", "date"), order)


def merged_dates(spark: SparkSession, target: str, batch: DataFrame, order: Sequence[Column] | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """The new content of the date partitions that ``batch`` touches. Only
    those are read: left-semi on the partition column prunes the scan. Valid
    rows have a symbol and a date, so no key here is NULL."""
    if not table_exists(spark, target):
        return staging.latest_per_key(staging.clean(batch).select(*S.STAGED_COLUMNS, *keep), ("symbol", "date"), order)
    check_layout(spark, target, "date")
    dates = staging.valid(batch).select("date").distinct()
    return upsert_latest(read_table(spark, target).join(dates, "date", "left_semi"), batch, order, keep)


def upsert_into(spark: SparkSession, target: str, batch: DataFrame,
                order: Sequence[Column] | None = None, keep: Sequence[str] = ()) -> int:
    """X5 on a stored staging table partitioned by ``date``.

    Only the date partitions the batch touches are read and rewritten
    (dynamic partition overwrite). The merged rows are written to the shared
    folder first, so the table is never read and overwritten by the same
    lineage; that copy is deleted afterwards. A target that is not partitioned
    by date is refused. Returns the rows written.
    """
    with Cut(merged_dates(spark, target, batch, order, keep), "merged") as merged:
        n = merged.count()
        if n:                                    # no valid row: nothing to store, no empty table
            replace_partitions(merged, target, "date", ("symbol",))
    return n


def stream_upsert(spark: SparkSession, landing: str, target: str, checkpoint: str | None = None,
                  order_fn=None, keep: Sequence[str] = (),
                  schema: T.StructType = S.RAW_BAR_SCHEMA, files_per_batch: int = FILES_PER_BATCH,
                  quarantine: str | None = None, on_bad: str = "quarantine") -> None:
    """X5 as a stream: each micro-batch of landed rows is folded into ``target``.

    ``foreachBatch`` + dynamic partition overwrite is idempotent: replaying a
    batch after a failure rewrites the same partitions with the same rows.
    A malformed line goes to ``quarantine`` (by default ``<target>_quarantine``)
    as (raw_line, reasons), or stops the run with ``on_bad="fail"``.
    ``order_fn`` builds the dedup order (Columns need an active session).
    """
    checkpoint = checkpoint or stream_checkpoint(spark, target, "upsert")
    quarantine = quarantine or target.rstrip("/") + "_quarantine"
    run = "stream-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:10]
    stream = landing_stream(spark, landing, files_per_batch=files_per_batch)

    def fold(lines: DataFrame, epoch: int) -> None:
        own = lines.sparkSession
        with Cut(tag_lines(records(lines), schema), "landed") as tagged:
            bad = tagged.filter(F.size("reasons") > 0).select("raw_line", "reasons")
            if on_bad == "fail" and not bad.isEmpty():
                raise ValueError(f"landed lines refused, the first: {bad.first().asDict()}")
            good = tagged.filter(F.size("reasons") == 0).drop("raw_line", "reasons")
            upsert_into(own, target, good, order_fn() if order_fn else None, keep)
            load_into(bad, quarantine, f"{run}-{epoch}")

    q = (stream.writeStream.foreachBatch(fold)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def affected_symbols(batch: DataFrame) -> DataFrame:
    """Symbols with at least one valid row in ``batch`` (the only ones whose
    staged rows, and so whose mart rows, can change)."""
    return staging.valid(batch).select("symbol").distinct()


def first_changes(batch: DataFrame) -> DataFrame:
    """(symbol, since): the first date on which a symbol's staged rows, and so
    its mart rows from there on, can change."""
    return staging.valid(batch).groupBy("symbol").agg(F.min("date").alias("since"))


def refresh_marts(staged: DataFrame, current: dict[str, DataFrame], symbols: DataFrame
                  ) -> dict[str, DataFrame]:
    """X5 for the marts as DataFrames: rebuild the affected symbols, keep every
    other row.

    A corrected bar changes its symbol's next LAG and up to 29 later averages,
    so affected symbols are recomputed whole (a symbol's series is bounded by
    the calendar). Unaffected rows pass through a left-anti join; the affected
    set is a distinct list that AQE broadcasts once it has measured it.
    Equals a full rebuild of the marts from ``staged``.
    """
    part = staged.select(*S.STAGED_COLUMNS).join(symbols, "symbol", "left_semi")
    fresh = marts.marts_from_features(marts.series_features(part))
    return {name: current[name].join(symbols, "symbol", "left_anti").unionByName(fresh[name])
            for name in fresh}


def changed_features(staged: DataFrame, changes: DataFrame, lookback_days: int = LOOKBACK_DAYS,
                     lookback_rows: int = LOOKBACK_ROWS) -> DataFrame | None:
    """``series_features`` of the changed symbols from their first change on.

    Each symbol brings the ``lookback_rows`` bars before it, which its first
    rows look back on. They are looked for in the last ``lookback_days`` before
    the earliest change, so the scan reads few date partitions; only symbols
    that have fewer bars there are read further back. None if nothing changed.
    """
    earliest = changes.agg(F.min("since")).first()[0]
    if earliest is None:
        return None
    rows = staged.select(*S.STAGED_COLUMNS)
    cut = F.lit(earliest - dt.timedelta(days=lookback_days))
    near = rows.filter(F.col("date") >= cut).join(changes, "symbol")
    seen = near.filter(F.col("date") < F.col("since")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    short = changes.join(seen, "symbol", "left").filter(F.coalesce("n", F.lit(0)) < lookback_rows).drop("n")
    older = rows.filter(F.col("date") < cut).join(short, "symbol")
    before = near.filter(F.col("date") < F.col("since")).unionByName(older)
    w = Window.partitionBy("symbol").orderBy(F.desc("date"))
    before = before.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= lookback_rows).drop("_n")
    part = near.filter(F.col("date") >= F.col("since")).unionByName(before)
    features = marts.series_features(part.select(*S.STAGED_COLUMNS))
    return features.join(changes, "symbol").filter(F.col("date") >= F.col("since")).drop("since")


# --- what a change reaches ----------------------------------------------------

def changed_cells(batch: DataFrame, reach: int = LOOKBACK_ROWS) -> DataFrame:
    """(symbol, date, reach): the bars that ``batch`` can change. A bar changes
    itself and the marts of its symbol's next ``reach`` bars: it lies in the frames
    of 29 of them, and the 30th looks back on the average before."""
    return staging.valid(batch).select("symbol", "date").distinct().withColumn("reach", F.lit(reach))


def _spans(changed: Sequence[dt.date], stored: Sequence[dt.date], around: int, most: int = SPANS) -> list[tuple[int, int]]:
    """Ranges (first, last place in ``stored``) of ``around`` dates before and
    after each changed one; ranges that meet are one, and the nearest ones are
    joined until there are ``most``."""
    spans: list[list[int]] = []
    for d in changed:
        at = bisect_left(stored, d)
        low, high = max(0, at - around), min(len(stored) - 1, at + around)
        if spans and low <= spans[-1][1] + 1:
            spans[-1][1] = max(high, spans[-1][1])
        else:
            spans.append([low, high])
    while len(spans) > most:
        k = min(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1])
        spans[k - 1][1] = spans.pop(k)[1]
    return [(a, b) for a, b in spans]


def _span_features(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``series_features`` of the reached bars among ``rows`` (staged columns,
    span, opens, ends: whether the span begins or ends with the table), with
    ``whole``: the span held all bars that its reached ones look back on, and
    all that its changes reach. Each span of a symbol is a series of its own."""
    marked = rows.join(cells.groupBy("symbol", "date").agg(F.max("reach").alias("_reach")), ["symbol", "date"], "left")
    keyed = marked.withColumns({"_symbol": F.col("symbol"), "symbol": F.concat(F.col("span").cast("string"), F.lit("\u0000"), F.col("symbol"))})
    series, every = Window.partitionBy("symbol").orderBy("date"), Window.partitionBy("symbol")
    ranked = keyed.withColumn("_at", F.row_number().over(series))
    until = F.max(F.col("_at") + F.col("_reach")).over(series.rowsBetween(Window.unboundedPreceding, 0))
    reached = marts.series_features(ranked.withColumn("_until", until)).withColumn("_hit", F.coalesce(F.col("_at") <= F.col("_until"), F.lit(False)))
    first, last = F.min(F.when(F.col("_hit"), F.col("_at"))).over(every), F.max("_until").over(every)
    whole = (F.col("opens") | (first > LOOKBACK_ROWS)) & (F.col("ends") | (last <= F.count(F.lit(1)).over(every)))
    return (reached.withColumn("whole", whole).filter("_hit").withColumn("symbol", F.col("_symbol"))
            .drop("_symbol", "_at", "_until", "_reach", "_hit", "span", "opens", "ends"))


@contextmanager
def reached_features(staged: DataFrame, cells: DataFrame, stored: Sequence[dt.date], around: int = 2 * LOOKBACK_ROWS):
    """``series_features`` of exactly the bars that ``cells`` (symbol, date,
    reach) reach, as a table for the block; None if nothing changed.

    Read are the partitions up to ``around`` stored dates before and after the
    changed dates; a symbol that has too few bars there is read whole, in a
    second pass over such symbols alone. The changed dates come to the driver:
    at most one per trading day.
    """
    changed = sorted(r["date"] for r in cells.select("date").distinct().collect() if stored and stored[0] <= r["date"] <= stored[-1])
    if not changed:
        yield None
        return
    rows = staged.select(*S.STAGED_COLUMNS)
    spans = _spans(changed, stored, around)
    span = F.lit(None).cast("int")
    for k, (low, _) in enumerate(spans):
        span = F.when(F.col("date") >= F.lit(stored[low]), k) if not k else F.when(F.col("date") >= F.lit(stored[low]), k).otherwise(span)
    inside = F.lit(False)
    for low, high in spans:
        inside = inside | F.col("date").between(F.lit(stored[low]), F.lit(stored[high]))
    near = rows.filter(inside)
    edge = lambda names: F.col("span").isin(names) if names else F.lit(False)
    near = (near.withColumn("span", span)
            .withColumns({"opens": edge([k for k, s in enumerate(spans) if s[0] == 0]), "ends": edge([k for k, s in enumerate(spans) if s[1] == len(stored) - 1])})
            .join(cells.select("symbol").distinct(), "symbol", "left_semi"))
    with Cut(_span_features(near, cells), "features") as first:
        short = first.filter(~F.col("whole")).select("symbol").distinct()
        if short.isEmpty():
            yield first.drop("whole")
            return
        all_dates = rows.join(short, "symbol", "left_semi").withColumns({"span": F.lit(0), "opens": F.lit(True), "ends": F.lit(True)})
        with Cut(_span_features(all_dates, cells), "features") as second:
            yield first.join(short, "symbol", "left_anti").unionByName(second).drop("whole")


def refresh_mart_tables(spark: SparkSession, staging_table: str, mart_tables: dict[str, str], cells: DataFrame) -> list[dt.date]:
    """X5 for stored marts partitioned by ``date``: recompute the bars that
    ``cells`` reach, and rewrite only their dates, once. Returns those dates."""
    stored = stored_dates(spark, staging_table)
    with reached_features(read_table(spark, staging_table), cells, stored) as rows:
        if rows is None:
            return []
        dates = sorted(r["date"] for r in rows.select("date").distinct().collect())     # a trading day each
        again = rows.select("symbol", "date")

        def rewrite(name: str, fresh: DataFrame) -> None:
            target = mart_tables[name]
            check_layout(spark, target, "date")
            kept = (on_dates(read_table(spark, target), dates).select(*fresh.columns)
                    .join(again, ["symbol", "date"], "left_anti").select(*fresh.columns))
            with Cut(kept.unionByName(fresh), name) as new:
                replace_partitions(new, target, "date", ("symbol",))

        together(*[partial(rewrite, name, fresh) for name, fresh in marts.marts_from_features(rows).items()])
        return dates


def reached_dates(spark: SparkSession, staging_table: str, cells: DataFrame) -> list[dt.date]:
    """The dates of the bars that ``cells`` reach."""
    with reached_features(read_table(spark, staging_table), cells, stored_dates(spark, staging_table)) as rows:
        return [] if rows is None else sorted(r["date"] for r in rows.select("date").distinct().collect())
