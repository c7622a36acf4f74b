"""Zone-independent literals for naive (TIMESTAMP_NTZ) timestamps and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(v) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime or ISO string.

    Built from its text, so neither the Python process zone nor the session
    zone can shift it (``F.lit(datetime)`` would be a zoned timestamp).
    """
    if isinstance(v, Column):
        return v
    text = v.isoformat(sep=" ") if isinstance(v, dt.datetime) else str(v)
    return F.lit(text).cast("timestamp_ntz")


def date_lit(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)))
