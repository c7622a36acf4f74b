"""Vectors that take part in searches and comparisons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_ID = -(1 << 63)


def usable(vector) -> "F.Column":
    """Not null, not zero, and all components finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def kind_of(df: DataFrame, column: str) -> str:
    """numpy's name of the components' type: they are kept as they are given."""
    return "<f4" if isinstance(df.schema[column].dataType.elementType, T.FloatType) else "<f8"


def packed(column: pa.Array, kind: str) -> pa.Array:
    """The bytes of each vector of a list column, of any lengths."""
    flat = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), kind)
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype("<i8") * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def unpacked(values: list[bytes], kind: str, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), length)


def by_length(values: list[bytes], kind: str):
    """(length, rows, matrix) for each length of packed vectors."""
    sizes = np.array([len(v) for v in values], np.int64) // np.dtype(kind).itemsize
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, unpacked([values[i] for i in rows], kind, int(d))
