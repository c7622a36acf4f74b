"""Records of CSV files whose quoted fields may hold line breaks.

Files are read as lines, split over tasks as any text is. Each line maps the
state it is entered in (inside a quoted field or not) to the state it is left
in; such maps compose, so a running composition inside a split, and one over the
few splits of a file, give every line's state without reading a file in one
task. Lines between the opening and the closing of a field are one record,
joined by the line breaks that they were read with.

Only files with a line that leaves a field open go through that. A first pass
sums each split up in a row; with the state a split is entered in, the task that
reads it joins its records in Arrow batches. Shuffled are these rows and the lines
of records that go on in the next split, no others.

Defined cases: a quote opens a field only at the field's start; a doubled quote
inside a quoted field is a quote; the carriage return before a record's last
line feed belongs to the break. A field that is never closed in its file, or a
record of more than ``MAX_LINES`` lines (a torn line's quote met by a far one),
leaves its lines as records of their own, so a torn line does not swallow others.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

MAX_LINES = 10_000
PLACE = ("file", "block")


def read_lines(spark: SparkSession, path, streaming: bool = False, **options) -> DataFrame:
    """(value, file, block): lines with their file and where its split begins."""
    reader = (spark.readStream if streaming else spark.read).options(lineSep="\n", **options)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _left_open(text: Column) -> Column:
    """Whether ``text`` (without doubled quotes), entered outside of quotes,
    ends inside a quoted field: complete quoted fields are taken out first."""
    return F.regexp_replace(text, '(^|,)"[^"]*+"[^,]*+', "$1").rlike('(^|,)"')


def leaves_open(line: Column, entered_open: bool) -> Column:
    """Whether ``line`` ends inside a quoted field, by the state it is entered in."""
    quoted = line.contains('"')
    single = F.replace(line, F.lit('""'), F.lit(""))
    if not entered_open:
        return F.when(quoted, _left_open(single)).otherwise(False)
    closes = single.contains('"')
    return F.when(quoted & closes, _left_open(F.regexp_replace(single, '^[^"]*+"[^,]*+', ""))).otherwise(True)


def files_with_breaks(lines: DataFrame) -> DataFrame:
    return lines.filter(leaves_open(F.col("value"), False)).select("file").distinct()


def _composed(df: DataFrame, order: Window, low: str, high: str) -> DataFrame:
    """``low`` and ``high`` (0 or 1: the state left, when entered outside or
    inside of quotes) of each row become those of all rows up to it: what the
    last row that forgets its entry leaves, turned by the swaps since."""
    df = df.withColumn("_swaps", F.sum(((F.col(low) == 1) & (F.col(high) == 0)).cast("int")).over(order))
    forgets = F.when(F.col(low) == F.col(high), F.struct(F.col(low).alias("state"), F.col("_swaps").alias("swaps")))
    df = df.withColumn("_last", F.last(forgets, ignorenulls=True).over(order))
    turned = lambda entry: F.pmod(F.coalesce(F.col("_last.state") + F.col("_swaps") - F.col("_last.swaps"), F.lit(entry) + F.col("_swaps")), F.lit(2)).cast("int")
    return df.withColumns({low: turned(0), high: turned(1)}).drop("_swaps", "_last")


def _blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\r$", "")) == ""


SUMMARY = ("file string, block long, first long, lines long, low int, high int, first_low long, first_high long, "
           "last_low long, last_high long, text long")
WHOLE = "value string, head boolean"


def _states(low: np.ndarray, high: np.ndarray, entry: int) -> np.ndarray:
    """The state after each line of a run that is entered in ``entry``."""
    swaps = np.cumsum((low == 1) & (high == 0))
    told = np.maximum.accumulate(np.where(low == high, np.arange(len(low)), -1))
    return (np.where(told >= 0, low[told] - swaps[told], entry) + swaps) & 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """The ranges of rows of a batch that are of one split."""
    n, files, blocks = batch.num_rows, batch.column("file"), batch.column("block").to_numpy()
    new = pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False) | (blocks[1:] != blocks[:-1])
    return pairwise([0, *(np.flatnonzero(new) + 1).tolist(), n])


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split: its number of lines, the states it is left in, the first
    and the last line that starts a record (for both entries), its first text."""
    schema = pa.schema([(n, pa.string() if n == "file" else pa.int32() if n in ("low", "high") else pa.int64())
                        for n in (f.split()[0] for f in SUMMARY.split(", "))])
    split: dict | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        done = []
        low, high, text, ids = (_ints(batch, n) for n in ("low", "high", "text", "line"))
        for a, z in _runs(batch):
            place = {"file": batch.column("file")[a].as_py(), "block": batch.column("block")[a].as_py()}
            if split is None or (split["file"], split["block"]) != (place["file"], place["block"]):
                done += [split] if split else []
                split = {**place, "first": int(ids[a]), "lines": 0, "low": 0, "high": 1, "text": None,
                         "first_low": None, "first_high": None, "last_low": None, "last_high": None}
            for name in ("low", "high"):
                after = _states(low[a:z], high[a:z], split[name])
                starts = np.flatnonzero(np.concatenate(([split[name]], after[:-1])) == 0)
                if len(starts):
                    split[f"last_{name}"] = split["lines"] + int(starts[-1])
                    if split[f"first_{name}"] is None:
                        split[f"first_{name}"] = split["lines"] + int(starts[0])
                split[name] = int(after[-1])
            if split["text"] is None and text[a:z].any():
                split["text"] = split["lines"] + int(text[a:z].argmax())
            split["lines"] += z - a
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if split:
        yield pa.RecordBatch.from_pylist([split], schema=schema)


def _whole_records(max_lines: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The records that lie in one split, and the lines of those that are left as
    their lines. A split is a run of rows; at most a record's lines are held."""
    def joined(lines: pa.Array, begin: np.ndarray, at: int, head: int) -> pa.RecordBatch:
        places = np.flatnonzero(begin)
        offsets = pa.array(np.append(places, len(lines)), pa.int32())
        heads = np.zeros(len(places), bool)
        if at <= head < at + len(lines):
            heads[np.searchsorted(places, head - at, "right") - 1] = True
        return pa.RecordBatch.from_arrays([pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n"), pa.array(heads)], names=["value", "head"])

    def last_of(split: dict) -> Iterator[pa.RecordBatch]:
        held = split["held"]
        if len(held) and not (split["tail_kept"] and split["crosses"]):
            begin = np.full(len(held), not split["tail_kept"])
            begin[0] = True
            yield joined(held, begin, split["at"] - len(held), split["head"])

    def of_run(split: dict, lines: pa.Array, low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
        after = _states(low, high, split["state"])
        begin = np.concatenate(([split["state"]], after[:-1])) == 0
        at, held = split["at"], split["held"]
        split["state"], split["at"] = int(after[-1]), at + len(lines)
        if len(held):
            begin = np.concatenate((np.zeros(len(held), bool), begin))
            begin[0] = True
            lines, at = pa.concat_arrays([held, lines]), at - len(held)
        starts = np.flatnonzero(begin)
        first = int(starts[0]) if len(starts) else len(lines)
        if first:                                   # of a record that started before
            if split["leads"] and split["lead_kept"]:
                lines, begin, at, starts = lines.slice(first), begin[first:], at + first, starts - first
            else:
                begin[:first] = True
        if len(starts):
            split["leads"] = False
        sizes = np.diff(np.append(starts, len(lines)))
        for k in np.flatnonzero(sizes > max_lines):
            begin[starts[k]:starts[k] + sizes[k]] = True
        until = int(starts[-1]) if len(starts) and sizes[-1] <= max_lines else len(lines)
        split["held"] = lines.slice(until)
        if until:
            yield joined(lines.slice(0, until), begin[:until], at, split["head"])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            low, high = _ints(batch, "low"), _ints(batch, "high")
            for a, z in _runs(batch):
                place = (batch.column("file")[a].as_py(), batch.column("block")[a].as_py())
                if split is None or split["place"] != place:
                    if split:
                        yield from last_of(split)
                    told = {n: batch.column(n)[a].as_py() for n in ("entry", "lead_kept", "tail_kept", "crosses", "head")}
                    if told["entry"] is None:
                        raise ValueError(f"the splits of {place[0]} changed while it was read")
                    split = {**told, "place": place, "state": told["entry"], "at": 0, "leads": True, "held": pa.array([], pa.string()),
                             "head": -1 if told["head"] is None else told["head"]}
                yield from of_run(split, batch.column("value").slice(a, z - a), low[a:z], high[a:z])
        if split:
            yield from last_of(split)

    return over


def _splits(lines: DataFrame, max_lines: int) -> DataFrame:
    """A row per split of ``lines`` (file, block, first: its first line):
    the state it is entered in; ``lead``, its lines of a record that started
    before, and ``start``, where its last record starts, with these records' numbers in
    the file; whether these records are kept, and whether the last one ``crosses``
    into a later split; ``head``: the file's first line that is not blank, if it is here."""
    over_blocks, every = Window.partitionBy("file").orderBy("block"), Window.partitionBy("file")
    ends = lines.withColumn("text", ~_blank(F.col("value"))).select(*PLACE, "line", "low", "high", "text").mapInArrow(_summaries, SUMMARY)
    ends = _composed(ends, over_blocks, "low", "high").withColumn("entry", F.lag("low", 1, 0).over(over_blocks))
    by_entry = lambda n: F.when(F.col("entry") == 0, F.col(f"{n}_low")).otherwise(F.col(f"{n}_high"))
    ends = ends.select(*PLACE, "first", "entry", F.coalesce(by_entry("first"), "lines").alias("lead"), by_entry("last").alias("start"), "lines", "text",
                       F.max_by("low", "block").over(every).alias("left"),
                       F.min(F.when(F.col("text").isNotNull(), F.col("block"))).over(every).alias("_text"))
    starts = F.col("start").isNotNull()
    ends = ends.withColumn("tail_record", F.sum(starts.cast("int")).over(over_blocks))
    ends = ends.withColumns({"lead_record": F.col("tail_record") - starts.cast("int"), "_last": F.max("tail_record").over(every)})
    # A record of several splits: the tail of the one it starts in and the leads of those up to the next start.
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_led", F.sum("lead").over(Window.partitionBy("file", "lead_record")))
    ends = ends.withColumns({"_tail": F.last(F.when(starts, F.col("lines") - F.col("start")), ignorenulls=True).over(earlier),
                             "_goes_on": F.lead("_led", 1, 0).over(over_blocks)})
    kept = lambda size, record: (size <= max_lines) & ((F.col(record) < F.col("_last")) | (F.col("left") == 0))
    return ends.select(*PLACE, "first", "entry", "lead", "start", "lead_record", "tail_record",
                       kept(F.coalesce("_tail", F.lit(0)) + F.col("_led"), "lead_record").alias("lead_kept"),
                       kept(F.col("lines") - F.col("start") + F.col("_goes_on"), "tail_record").alias("tail_kept"),
                       (starts & (F.col("_goes_on") > 0)).alias("crosses"),
                       F.when(F.col("block") == F.col("_text"), F.col("text")).alias("head"))


def broken_records(lines: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """(value, head) of the records of ``lines`` (with ``line``); ``head``: the
    record is its file's first that is not blank. Only the lines of records
    that cross a split's end are shuffled."""
    told = lines.withColumns({n: leaves_open(F.col("value"), n == "high").cast("int") for n in ("low", "high")})
    splits = F.broadcast(_splits(told, max_lines))     # a row per split; both joins use all of it, so it is made once
    own = told.join(splits, list(PLACE), "left")
    whole = own.drop("line").mapInArrow(_whole_records(max_lines), WHOLE)
    lead, tail = (F.col("lead") > 0) & F.col("lead_kept"), F.col("crosses") & F.col("tail_kept")
    at = F.col("line") - F.col("first")
    record = F.when(lead & (at < F.col("lead")), F.col("lead_record")).when(tail & (at >= F.col("start")), F.col("tail_record"))
    crossing = (lines.join(splits, list(PLACE)).withColumn("record", record).filter(F.col("record").isNotNull())
                .groupBy("file", "record")
                .agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("all"), F.max(F.coalesce(at == F.col("head"), F.lit(False))).alias("head"))
                .select(F.array_join(F.col("all.value"), "\n").alias("value"), "head"))
    return whole.unionByName(crossing).select(F.regexp_replace("value", "\r$", "").alias("value"), "head")


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with ``line``, which rises inside a split."""
    return lines.withColumn("line", F.monotonically_increasing_id())


def records(lines: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """(value): the records of ``lines`` as ``read_lines`` gives them."""
    breaks = F.broadcast(files_with_breaks(lines))
    plain = lines.join(breaks, "file", "left_anti").select(F.regexp_replace("value", "\r$", "").alias("value"))
    return plain.unionByName(broken_records(numbered(lines).join(breaks, "file", "left_semi"), max_lines).select("value"))
