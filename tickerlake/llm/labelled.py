"""Labelled training rows for the two classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLDS = 5                 # fold 0 is held out, never learned from
SAMPLE_ROWS = 20_000      # labelled rows a classifier is fitted on, about, at most
_HASHES = 1 << 20


def fold_of(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def held_out(doc_id):
    """Whether a row is held out; a null id is not."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def _thin(rows: DataFrame, doc_id: str, at_most: int) -> DataFrame:
    """Rows by a hash of their id, about ``at_most``: the same ones each time."""
    total = rows.count()
    if total <= at_most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(_HASHES)) < _HASHES * at_most // total)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, y, text): labelled rows outside the held-out fold. A doc_id
    with several labels has their smallest; with several texts, the smallest."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold_of(F.col("doc_id")) != 0))
           .groupBy("doc_id").agg(F.min(label).alias("y")))
    ids = _thin(ids, "doc_id", at_most)      # bounded by at_most, so it may be broadcast
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
