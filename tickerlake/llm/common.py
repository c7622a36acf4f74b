"""Helpers shared by the operators: written tables, whole-text Arrow kernels,
distributed prefix sums and connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tickerlake.session import ensure_checkpoint_dir, remove, scratch_path

SLICE_BYTES = 4 << 20  # text handled at once inside a task


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where the
    setting is absent and the master is a single local process."""
    fallback = None
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        fallback = tempfile.gettempdir() + "/tickerlake-checkpoints"
    root = ensure_checkpoint_dir(spark, fallback)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    shared_folder(spark)
    return scratch_path(spark, name)


_passing: list[list[str]] = []       # paths written inside each open ``passing`` block


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage is
    cut, and everything after it sees the same rows, whatever is lost. Inside
    ``passing`` it goes at the end of the block, unless it is to ``keep``."""
    path = scratch(df.sparkSession, name)
    if _passing and not keep:
        _passing[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession):
    """What is ``written`` inside the block serves only the block: its files are
    deleted at the end. A result is written with ``keep``."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            remove(spark, path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Arrow batches of about ``size`` for what runs inside the block: tasks
    that make much of each text need little of them at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hand memory that this worker process no longer uses back to the system:
    workers live on from stage to stage, and allocators keep what was freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # not this C library
        pass


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process."""
    holder = sys.modules.setdefault("_tickerlake_process", types.ModuleType("_tickerlake_process"))
    return holder.__dict__.setdefault(name, {})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def extended(schema: T.StructType, **kinds: str) -> T.StructType:
    """``schema`` with more fields; the given one is left alone."""
    more = T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in kinds.items()))
    return T.StructType([*schema.fields, *more.fields])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the like, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# --- whole texts in Arrow batches ------------------------------------------

def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut ``batch`` between rows so that each piece holds about ``max_bytes``
    of text; one longer text is a piece of its own. No text is cut."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and row of every word ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def cut_words(column: pa.Array, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Of each text the words first <= i < last, with what stands between."""
    data, offsets = utf8(column)
    starts, ends, rows = word_spans(data, offsets)
    edges = np.searchsorted(rows, np.arange(len(column)))
    raw = data.tobytes()
    return pa.array([raw[starts[e + a]:ends[e + b - 1]].decode() if b > a else "" for e, a, b in
                     zip(edges.tolist(), first.tolist(), last.tolist())], pa.string())


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; every other byte kept."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- prefix sums -------------------------------------------------------------

def ordered_prefix_sums(df: DataFrame, group: list[str], order: list[str], size: str,
                        name: str = "prefix", spread_by: list[str] | None = None) -> DataFrame:
    """Adds ``start``: the sum of ``size`` over the rows before this one in its
    group, in the given order; and ``rid``, a row number unique over the table.

    Rows are range-partitioned by (group, order), so a hot group spreads over
    many tasks. Each task sums its own rows in one pass; the bases of the
    partitions are prefix sums over one row per (partition, group); only the
    groups that a partition goes on with have a base, so at most one row a
    partition is broadcast. ``order`` must be total but for
    rows that are equal throughout. Sizes are non-null. ``spread_by``: the first
    columns of ``order``, where the range need not be cut by all of them.
    """
    spark = df.sparkSession
    cols = [F.col(c).asc_nulls_last() for c in group + order]
    schema = extended(df.schema, rid="long", part="int", local="long")
    names = list(df.columns)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, total, row = None, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sizes = batch.column(names.index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
            change = np.zeros(n, bool)
            keys = [batch.column(names.index(c)).to_pylist() for c in group]
            rows = list(zip(*keys)) if group else [()] * n
            for i, key in enumerate(rows):
                if last is None or key != last:
                    change[i], last = True, key
            before = np.cumsum(sizes) - sizes + total
            base = np.where(change, before, -1)
            if not change[0]:
                base[0] = 0
            base = np.maximum.accumulate(base)
            local = before - base
            total = int(local[-1] + sizes[-1])
            rid = (np.int64(part) << np.int64(40)) + np.arange(row, row + n)
            row += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rid), pa.array(np.full(n, part, np.int32)), pa.array(local)],
                names=[*names, "rid", "part", "local"])

    ranges = cols if spread_by is None else cols[:len(group) + len(spread_by)]
    spread = df.repartitionByRange(max(partitions(spark), 1), *ranges).sortWithinPartitions(*cols)
    rows = written(spread.mapInArrow(run, schema), name)
    # One row per (partition, group): a group that fills several partitions is
    # alone in all but its first and last.
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    totals = rows.groupBy(F.col("part").alias("_part"), *keys).agg(F.sum(size).alias("_sum"))
    w = W.partitionBy(*[f"_g{i}" for i in range(len(group))] or [F.lit(0)])
    bases = totals.withColumn("_base", F.coalesce(F.sum("_sum").over(
        w.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_sum").where("_base <> 0")
    on = F.col("part") == F.col("_part")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(F.broadcast(bases), on, "left").select(
        *names, "rid", (F.col("local") + F.coalesce("_base", F.lit(0))).alias("start"))


# --- connected components ------------------------------------------------------

def connected_components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest node that
    it can reach. Alternating large-star and small-star steps; each is a
    grouped minimum with map-side combining, the edge table never grows
    beyond its first size by more than the nodes, and it ends after O(log n)
    steps. Nothing but a changed flag comes to the driver."""
    spark = edges.sparkSession
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = written(e, f"{name}-edges")
    while True:
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e2 = large.where("u > v").distinct()
        low = e2.groupBy("u").agg(F.min("v").alias("m"))
        small = (e2.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        nxt = written(small.where("u > v").distinct(), f"{name}-step")
        same = (nxt.count() == e.count()
                and nxt.join(e, ["u", "v"], "left_anti").limit(1).count() == 0)
        e = nxt
        if same:
            break
    roots = e.groupBy("u").agg(F.min("v").alias("component"))
    return roots.select(F.col("u").alias("node"), "component").union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
