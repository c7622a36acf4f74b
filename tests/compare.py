"""Compare a Spark result with a DuckDB oracle result (tests and local checks).

Row count, column names and an order-insensitive comparison of values; floats
are compared after rounding to 9 significant places.
"""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].astype(object).itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           if not isinstance(x, (list, dict)) else (False, "z", str(x))
                                           for x in r))


@dataclass
class Result:
    name: str
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.rows_spark == self.rows_oracle and self.columns_match and self.values_match


def compare(name: str, spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> Result:
    cols_ok = sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    if not cols_ok:
        return Result(name, len(spark_pdf), len(oracle_pdf), False, False,
                      f"spark={sorted(spark_pdf.columns)} oracle={sorted(oracle_pdf.columns)}")
    a, b = _rows(spark_pdf), _rows(oracle_pdf)
    same = a == b
    detail = ""
    if not same:
        sa, sb = set(a), set(b)
        only_a, only_b = list(sa - sb)[:3], list(sb - sa)[:3]
        detail = f"spark-only={only_a} oracle-only={only_b}"
    return Result(name, len(a), len(b), True, same, detail)
