"""A corpus pipeline over ``documents``: toxic and poor documents go, one of each
group of near-duplicates stays, sources are mixed to target weights, and the
mix is packed into bins.

No oracle: SQL can't express the trained stages; they are tested on labels
held out, on planted copies and on the bins' invariants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerlake.llm import stages
from tickerlake.llm.common import written

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("quality", stages.keep_quality),
    ("near_duplicates", stages.one_of_each),
    ("mixing", stages.mix_sources),
    ("packing", stages.pack_bins),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
