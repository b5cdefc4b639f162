"""Append-only logs as streams: latest entry per id, first entry per key, resume without repeats.

Each runner takes what is there (``availableNow``) from a folder of files and returns the table so
built; with the same state folder a later run goes on where the last one ended.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.manifest import latest_by
from corpusloom.sources.jsonl import exists


def _events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    folder = path if not path.endswith(".parquet") or _is_folder(spark, path) else f"{os.path.dirname(path)}/*{os.path.basename(path)}"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return raw.select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("decision"), F.col("event_id").alias("seq"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def _drain(stream: DataFrame, handle, state: str, mode: str) -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def _last(spark: SparkSession, folder: str, below: int | None = None) -> str | None:
    """The newest version of a table whose batches are folders 0, 1, ...; of those below a number, if one is given."""
    if not exists(spark, folder):
        return None
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    numbers = [int(f.getPath().getName()) for f in found if f.getPath().getName().isdigit()]
    numbers = [n for n in numbers if below is None or n < below]
    return f"{folder}/{max(numbers)}" if numbers else None


def run_latest(spark: SparkSession, path: str, state: str) -> DataFrame:
    """id, decision, seq: last write wins, by stateful aggregation. Batch n merges its updates with version n - 1 of the table into version n, so a batch that is run again changes nothing."""
    at = f"{state}/table"
    stream = _events(spark, path).groupBy("id").agg(F.max_by(F.struct("decision", "seq"), "seq").alias("last"))

    def handle(batch: DataFrame, n: int) -> None:
        new, before = batch.select("id", "last.decision", "last.seq"), _last(spark, at, n)
        both = new.unionByName(spark.read.parquet(before)) if before else new
        latest_by(both).drop("first_seq").write.mode("overwrite").parquet(f"{at}/{n}")

    _drain(stream, handle, state, "update")
    last = _last(spark, at)
    return spark.read.parquet(last) if last else spark.createDataFrame([], "id string, decision string, seq long")


def run_dedup(spark: SparkSession, path: str, state: str) -> DataFrame:
    """id, decision: each pair once, by stateful dropDuplicates."""
    stream = _events(spark, path).select("id", "decision").dropDuplicates(["id", "decision"])
    at = f"{state}/table"

    def handle(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/batch={n}")

    _drain(stream, handle, state, "append")
    return spark.read.parquet(at).select("id", "decision") if exists(spark, at) else spark.createDataFrame([], "id string, decision string")


def run_resume(spark: SparkSession, path: str, state: str) -> DataFrame:
    """id, seq of the first entry of each id: a batch appends only ids that the log does not hold, so nothing is done twice.

    Files come in order of their modification times, not of seq. So a batch also appends an id that the
    log holds with a later entry, and the first of the id's entries counts.
    """
    at = f"{state}/table"
    firsts = lambda rows, name="seq": rows.groupBy("id").agg(F.min("seq").alias(name))

    def handle(batch: DataFrame, n: int) -> None:
        first = firsts(batch)
        if exists(spark, at):
            held = firsts(spark.read.parquet(at).where(F.col("batch") != n), "held")
            first = first.join(held, "id", "left").where("held IS NULL OR seq < held").select("id", "seq")
        first.write.mode("overwrite").parquet(f"{at}/batch={n}")

    _drain(_events(spark, path), handle, state, "append")
    return firsts(spark.read.parquet(at)) if exists(spark, at) else spark.createDataFrame([], "id string, seq long")
