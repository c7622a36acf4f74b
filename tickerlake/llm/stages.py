"""The operators as stages of a corpus pipeline: documents in, documents out.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``
(doc_id, text, lang, source, n_chars and any others, which the filtering stages
carry along). Null texts are empty; no rows give no rows. Stages that cut texts write
their rows themselves: the size of the Arrow batches that carry texts to and
from the workers is settled where a plan is run.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerlake.llm import jaccard_join, mixing, packing, quality, toxicity
from tickerlake.llm.common import cut_words, fresh, give_back, passing, slices, small_batches, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_FROM = 0.5
GOOD_FROM = 0.3
CUT_BYTES = 1 << 20        # text cut at once inside a task: its words' places take many times as much


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a unique number per row: its doc_id where all differ, else
    a row number, fixed by writing the rows."""
    n = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if n["rows"] == n["ids"]:
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    return written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under ``TOXIC_FROM``."""
    model = toxicity.fit(docs.select("doc_id", "text"), _labels(spark, sf_dir))
    name = fresh(docs, "_score")
    return toxicity.score(docs, model, name).where(F.col(name) < TOXIC_FROM).drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is ``GOOD_FROM`` or more."""
    model = quality.fit(docs.select("doc_id", "text"), _labels(spark, sf_dir))
    name = fresh(docs, "_score")
    return quality.score(docs, model, name).where(F.col(name) >= GOOD_FROM).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word n-grams, a Jaccard
    similarity of 0.8 or more) the document with the smallest number."""
    key = fresh(docs, "_key")
    rows = keyed(docs, key)
    with passing(spark):
        groups = jaccard_join.similar_documents(rows, key, "text", words=5, percent=80)
        gone = written(groups.where(F.col(key) != F.col("component_id")).select(key), "copies", keep=True)
    few = gone.count() <= jaccard_join.BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti").drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: for each pass over its source, the runs of words
    of a document that the mix takes. A whole document is one run."""
    with passing(spark), small_batches(spark, "2m"):
        return written(_mixed(docs), "mixed", keep=True)


def _mixed(docs: DataFrame) -> DataFrame:
    rows = keyed(docs.select(*COLUMNS), "_key")
    sizes, spans = mixing.mix(rows.select("_key", "source", "text"), "_key")
    spans = spans.join(sizes.select("rid", "_key"), "rid")
    w = W.partitionBy("_key", "turn").orderBy("first")
    starts = (F.col("first") != F.coalesce(F.lag("last").over(w), F.lit(-1))).cast("int")
    runs = (spans.withColumn("new", starts).withColumn("run", F.sum("new").over(w))
            .groupBy("_key", "turn", "run").agg(F.min("first").alias("_first"), F.max("last").alias("_last"))
            .drop("turn", "run"))
    schema = rows.select(*COLUMNS).schema

    def cut(batches):
        for batch in batches:
            for piece in slices(batch, "text", CUT_BYTES):
                first, last = (piece.column(c).to_numpy() for c in ("_first", "_last"))
                text = cut_words(piece.column("text"), first, last)
                chars = pa.compute.utf8_length(text).cast(pa.int64())
                new = {"text": text, "n_chars": chars}
                yield pa.RecordBatch.from_arrays([new[c] if c in new else piece.column(c) for c in COLUMNS], names=COLUMNS)
        give_back()

    return rows.join(runs, "_key").select(*COLUMNS, "_first", "_last").mapInArrow(cut, schema)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece: its bin (group_no, bin_no), document, words
    and text. Copies of a document never share a bin."""
    with passing(spark), small_batches(spark, "2m"):
        return written(_packed(docs), "packed", keep=True)


def _packed(docs: DataFrame) -> DataFrame:
    rows = keyed(docs.select(*COLUMNS), "rid")
    pieces = packing.pack_documents(rows, cluster=F.col("doc_id"))
    placed = pieces.select("rid", "first", "words", "group_no", "bin_no")
    both = placed.join(rows.select("rid", "doc_id", "source", "text"), "rid")
    names = ["group_no", "bin_no", "doc_id", "source", "first", "words", "text"]

    def cut(batches):
        for batch in batches:
            for piece in slices(batch, "text", CUT_BYTES):
                first, words = (piece.column(c).to_numpy() for c in ("first", "words"))
                text = cut_words(piece.column("text"), first, first + words)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names[:-1]), text], names=names)
        give_back()

    both = both.select(*names)
    return both.mapInArrow(cut, both.schema)
