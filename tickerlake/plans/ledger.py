"""The ledger of daily runs: what a run that was lost half-way may have changed.

Before a run changes a table it stores the bars it can change (symbol, date)
in a folder of its own under ``RUNS/open``; the folder goes when the run has
ended. A run that finds folders of others takes their bars as changed, too, and so
repairs whatever they left. ``RUNS/ledger`` is appended to: a row when a run
opens and one when it ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.session import exists, remove

LEDGER = "run_id string, state string, mode string, rows long, at timestamp_ntz"


class Ledger:
    def __init__(self, spark: SparkSession, workdir: str):
        self.spark = spark
        self.root = workdir.rstrip("/") + "/RUNS"
        self.runs = self.root + "/ledger"

    def _open_folder(self, run_id: str, mode: str) -> str:
        return f"{self.root}/open/{mode}={run_id}"

    def open_runs(self) -> list[tuple[str, str]]:
        """(run id, mode) of the runs that were opened and have not ended; a
        run whose folder is not complete had changed nothing yet."""
        if not exists(self.spark, self.root + "/open"):
            return []
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root + "/open")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(f.getPath().getName() for f in fs.listStatus(path) if "=" in f.getPath().getName())
        runs = [(n.split("=", 1)[1], n.split("=", 1)[0]) for n in names]
        return [(r, m) for r, m in runs if exists(self.spark, self._open_folder(r, m) + "/_SUCCESS")]

    def _note(self, run_id: str, state: str, mode: str, rows: int | None) -> None:
        row = (run_id, state, mode, rows, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(self.runs)

    def open(self, run_id: str, mode: str, cells: DataFrame, rows: int) -> None:
        cells.select("symbol", "date").distinct().write.mode("overwrite").parquet(self._open_folder(run_id, mode))
        self._note(run_id, "opened", mode, rows)

    def cells(self, run_id: str, mode: str) -> DataFrame:
        """The bars that an open run can have changed."""
        return self.spark.read.schema("symbol string, date date").parquet(self._open_folder(run_id, mode))

    def end(self, run_id: str, mode: str, state: str = "ended", rows: int | None = None) -> None:
        """Close a run; ``state`` is ``ended``, or ``recovered`` by a later one."""
        self._note(run_id, state, mode, rows)
        remove(self.spark, self._open_folder(run_id, mode))

    def history(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.runs).orderBy(F.col("at"))
