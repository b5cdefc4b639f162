"""Voices for prompts, in turn by position in the log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.display import composite_id, slug
from corpusloom.operators.manifest import positions


def round_robin(prompts: DataFrame, voices: DataFrame, seq: str = "seq") -> DataFrame:
    """Prompts with the voice at (position mod number of voices), its slug and the sample id. The voice table is a configuration of a few rows."""
    listed = voices.select("*", F.monotonically_increasing_id().alias("__m")).coalesce(1)
    listed = listed.select(*voices.columns, (F.row_number().over(W.orderBy("__m")) - 1).alias("__voice"))
    n = voices.count()
    placed = positions(prompts, seq).withColumn("__voice", (F.col("position") % n).cast("int"))
    out = placed.join(F.broadcast(listed), "__voice").drop("__voice")
    return out.withColumn("voice_slug", slug(F.col("provider"), F.col("voice_id"))).withColumn("sample_id", composite_id(F.col("id").cast("string"), F.col("voice_slug")))


def audio_records(assigned: DataFrame, sample_rate: int = 16000) -> DataFrame:
    """Records before synthesis: failed until a provider says otherwise."""
    none = lambda t: F.lit(None).cast(t)
    return assigned.select(
        F.col("sample_id").alias("id"), F.col("id").alias("prompt_id"), "text", "category", F.col("provider").alias("voice_provider"), "voice_id",
        F.col("gender").alias("voice_gender"), F.col("dialect").alias("voice_dialect"), none("string").alias("audio_path"), none("double").alias("duration_sec"),
        F.lit(sample_rate).alias("sample_rate"), F.lit("failed").alias("status"), none("string").alias("error"), "seq",
    )
