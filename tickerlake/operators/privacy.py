"""Redaction (X1, X2) and retention (X3) over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake import schema as S
from tickerlake.functions.timeutil import ntz
from tickerlake.functions.redact import json_redactor, redact_text, redact_value, rules


def redact_secrets(df: DataFrame, col: str, loose_token: bool = False, log_forms: bool = False,
                   rule_list: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Redact passwords, URL query strings and tokens in a text column.

    The whole text of every row is processed; rules run in their fixed order.
    """
    chosen = rule_list if rule_list is not None else rules(loose_token, log_forms)
    return df.withColumn(col, redact_text(col, chosen))


def redact_map(df: DataFrame, col: str, keys: Sequence[str] = S.SENSITIVE_KEYS) -> DataFrame:
    """Redact sensitive keys, to any depth, of a struct or map column or of
    JSON objects in a text column; other values keep their type and spelling,
    and text that is not a JSON object is kept."""
    kind = df.schema[col].dataType
    c = F.col(f"`{col}`")
    return df.withColumn(col, json_redactor(keys)(c) if isinstance(kind, T.StringType) else redact_value(c, kind, keys))


def _ts(v) -> Column:
    return ntz(v)


def with_archived_flag(df: DataFrame, ts: str, as_of, days: int = S.RETENTION_DAYS) -> DataFrame:
    """Flag rows older than ``as_of - days`` (strictly before the cutoff)."""
    return df.withColumn("archived", _is_old(ts, as_of, days))


def _is_old(ts: str, as_of, days: int) -> Column:
    cutoff = _ts(as_of) - F.make_dt_interval(days=F.lit(days))
    return F.coalesce(F.col(ts) < cutoff, F.lit(False))


def split_by_age(df: DataFrame, ts: str, as_of, days: int = S.RETENTION_DAYS
                 ) -> tuple[DataFrame, DataFrame]:
    """``(recent, archive)``. Two complementary filters: on a table
    partitioned by date each side reads only its own partitions. A row
    without a timestamp is never archived, so every row lands on one side."""
    old = _is_old(ts, as_of, days)
    return df.filter(~old), df.filter(old)
