"""The export join: audio with its latest review and quality, through the acceptance gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Export
from corpusloom.functions.display import dataset_relative
from corpusloom.operators.manifest import latest_by
from corpusloom.schemas import DATASET, METADATA


def skip_reason(rules: Export) -> Column:
    """Why a joined row stays out, null if it does not: unreviewed, then rejected, then flagged and merely accepted."""
    reason = F.when(F.col("decision").isNull(), "unreviewed")
    if not rules.include_rejected:
        reason = reason.when(F.col("decision") == "reject", "rejected")
    if not rules.include_flagged:
        reason = reason.when(F.col("auto_status").eqNullSafe("flagged") & (F.col("decision") == "accept"), "flagged_accept_only")
    return reason


def joined(audio: DataFrame, quality: DataFrame, reviews: DataFrame, rules: Export | None = None) -> DataFrame:
    """All ok audio, latest per id, with review, quality and ``skip_reason``. Status is filtered before the latest is taken, so a later failure hides nothing."""
    a = latest_by(audio.where("status = 'ok'"), columns=[c for c in audio.columns if c not in ("error", "prompt_id")])
    r = latest_by(reviews, columns=["decision", "final_text", "note"]).drop("first_seq")
    q = latest_by(quality, columns=["transcript", "cer", "wer", "flags", "auto_status"]).drop("first_seq").withColumn("has_quality", F.lit(True))
    rows = a.join(r, "id", "left").join(q, "id", "left")
    return rows.withColumn("skip_reason", skip_reason(rules or Export()))


def export_rows(rows: DataFrame, rules: Export | None = None) -> DataFrame:
    """The metadata columns of the rows that passed, with ``first_seq``, their order. Without a quality row flags are empty; an edited text counts unless it is empty."""
    rules = rules or Export()
    names = [f.name for f in METADATA.fields]
    own = {
        "audio_relpath": F.col("audio_path"),
        "text": F.coalesce(F.nullif(F.col("final_text"), F.lit("")), F.col("text")),
        "original_prompt": F.col("text"),
        "asr_transcript": F.col("transcript"),
        "asr_cer": F.col("cer"),
        "asr_wer": F.col("wer"),
        "auto_flags": F.when(F.col("has_quality").isNull(), F.array().cast("array<string>")).otherwise(F.col("flags")),
        "review_decision": F.col("decision"),
        "review_note": F.col("note"),
        "is_synthetic": F.lit(True),
        "language": F.lit(rules.language),
    }
    return rows.where("skip_reason IS NULL").select(*[own.get(n, F.col(n)).alias(n) for n in names], "first_seq")


def skip_counts(rows: DataFrame) -> DataFrame:
    return rows.where("skip_reason IS NOT NULL").groupBy("skip_reason").agg(F.count("*").alias("n"))


def typed(metadata: DataFrame) -> DataFrame:
    """The dataset columns: path relative to the dataset, reals narrowed."""
    withpath = metadata.withColumn("audio", dataset_relative(F.col("audio_relpath")))
    return withpath.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DATASET.fields])
