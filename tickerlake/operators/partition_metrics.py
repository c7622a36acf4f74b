"""Q5-Q8 and P4 by partition: counters that add up.

The rows and failing rows of each declared check are counted per partition of
a table (a date, or a load of bronze) and stored. A run counts only the
partitions it has rewritten and appends the counters with a version; the
latest version of a partition holds. The suite and the layer summary are sums
over these counters, so neither rescans history. Counters of another suite
(other checks or accepted values) do not count, and make the next run count
every partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators.quality import Check, count_if
from tickerlake.session import Cut, exists

ROWS = "row_count"
METRICS = "table_name string, part string, test string, column_name string, counted long, version long, suite string"
VERSIONS = 64             # appended files of counters, then one table again


def signature(suite: Mapping[str, Sequence[Check]]) -> str:
    told = [(name, c.test, c.column, str(c.failing)) for name, checks in suite.items() for c in checks]
    return hashlib.sha1(repr(told).encode()).hexdigest()[:16]


def counters(df: DataFrame, part: str, table: str, checks: Sequence[Check]) -> DataFrame:
    """(table_name, part, test, column_name, counted): a grouped count with a
    map-side partial step; a row per partition and check."""
    aggs = [F.count(F.lit(1)).alias("_n"), *[count_if(c.failing).alias(f"_c{i}") for i, c in enumerate(checks)]]
    grouped = df.groupBy(F.col(part).cast("string").alias("part")).agg(*aggs)
    items = [(ROWS, "", "_n"), *[(c.test, c.column, f"_c{i}") for i, c in enumerate(checks)]]
    rows = F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(n).alias("counted")) for t, c, n in items])
    return grouped.select(F.lit(table).alias("table_name"), "part", F.inline(rows))


class MetricsTable:
    def __init__(self, spark: SparkSession, path: str, suite: Mapping[str, Sequence[Check]]):
        self.spark, self.path, self.suite, self.sign = spark, path, suite, signature(suite)

    def usable(self) -> bool:
        """Whether counters of this suite are stored."""
        return exists(self.spark, self.path + "/_SUCCESS") and not self._own().isEmpty()

    def _own(self) -> DataFrame:
        return self.spark.read.schema(METRICS).parquet(self.path).filter(F.col("suite") == self.sign)

    def current(self) -> DataFrame:
        """The counters that hold."""
        return (self._own().groupBy("table_name", "part", "test", "column_name")
                .agg(F.max_by("counted", "version").alias("counted"), F.max("version").alias("version")))

    def _rows(self, parts: Sequence[DataFrame], version: int) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumns({"version": F.lit(version).cast("long"), "suite": F.lit(self.sign)})

    def replace(self, parts: Sequence[DataFrame]) -> None:
        """Counters of every partition of all tables."""
        self._rows(parts, 0).repartition(1).write.mode("overwrite").parquet(self.path)

    def add(self, parts: Sequence[DataFrame]) -> None:
        """Counters of the partitions that a run has rewritten."""
        seen = self._own().agg(F.max("version").alias("last"), F.count_distinct("version").alias("n")).first()
        self._rows(parts, seen["last"] + 1).repartition(1).write.mode("append").parquet(self.path)
        if seen["n"] >= VERSIONS:
            with Cut(self.current().withColumn("suite", F.lit(self.sign)), "metrics") as now:
                now.repartition(1).write.mode("overwrite").parquet(self.path)

    def suite_report(self) -> DataFrame:
        """Q8: a row per declared test, as ``quality.run_suite`` gives it."""
        told = [(i, name, c.test, c.column) for i, (name, c) in enumerate((n, c) for n, checks in self.suite.items() for c in checks)]
        declared = self.spark.createDataFrame(told, "_i int, table_name string, test string, column_name string")
        sums = self.current().groupBy("table_name", "test", "column_name").agg(F.sum("counted").alias("_sum"))
        out = declared.join(F.broadcast(sums), ["table_name", "test", "column_name"], "left").orderBy("_i")     # a row per declared test
        out = out.select("table_name", "test", "column_name", F.coalesce("_sum", F.lit(0)).alias("failing_rows"))
        return out.withColumn("passed", F.col("failing_rows") == 0)

    def layer_counts(self, layers: Mapping[str, str]) -> DataFrame:
        """Rows per (layer, table)."""
        declared = self.spark.createDataFrame([(layer, name) for name, layer in layers.items()], "layer string, table_name string")
        sums = self.current().filter(F.col("test") == ROWS).groupBy("table_name").agg(F.sum("counted").alias("_sum"))
        return (declared.join(F.broadcast(sums), "table_name", "left")                                          # a row per table
                .select("layer", "table_name", F.coalesce("_sum", F.lit(0)).alias("row_count")))
