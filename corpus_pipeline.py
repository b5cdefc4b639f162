"""A corpus run over ``documents``: judge quality, drop near copies, cut repeated passages, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of ``documents``, extra ones
included, whatever their names.

Defined cases: a null or empty text is scored as the classifier scores it (kept if the score reaches the
threshold), is a near copy of nothing, loses nothing, has size 0 and so adds no words to the mixture (it is
taken as often as its place says), and has no ids. A null id is never held out, labelled, linked or cut.
Repeated rows (same id and text) stand or fall together until mixing, which shares their copies evenly.
An empty table gives an empty result. Spent stage folders are deleted, the last stage's input is not.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, mixing, near_dedup, quality, substring_dedup
from corpusloom.llm.common import ensure_checkpoint_dir, lean, remove
from corpusloom.shipping import ship


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labelled ones that are not held out."""
    ship(spark)
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    ship(spark)
    return near_dedup.keep_one(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds are cut; n_chars follows the text."""
    ship(spark)
    cleaned = substring_dedup.remove_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 5, 2, 1 in turn; a document is there as often as it is taken."""
    ship(spark)
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding them gave the text back."""
    ship(spark)
    path = bpe.default_path()

    def run(batches):
        c = bpe.codec(path)
        for batch in batches:
            ids = [c.encode(t.as_py() or "") for t in batch.column(1)]
            intact = [c.decode(i) == (t.as_py() or "") for i, t in zip(ids, batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(intact, pa.bool_())], ["doc_id", "n_tokens", "ids", "intact"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, n_tokens long, ids array<int>, intact boolean")


STAGES = [("quality classifier", good), ("MinHash near-dedup", distinct), ("substring dedup", unrepeated), ("mixing sources", mixed), ("BPE encoding", encoded)]

#: A fitted model, MinHash candidates and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:  # what this stage has read is spent; the last one's input stays, as its result is not computed yet
            remove(spark, f"{folder}/{k - 1}")
