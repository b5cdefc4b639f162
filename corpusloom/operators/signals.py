"""Quality signals of a clip from its text, transcript and duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Quality
from corpusloom.functions import rates
from corpusloom.functions.text import normalize_for_comparison


def flags(q: Quality, *, duration: Column, cps: Column, cer: Column, hypothesis: Column, asr_error: Column, missing: Column, unreadable: Column) -> Column:
    """Flags in the order of the rules. A missing or unreadable file ends the list there. Limits are strict."""
    rules = [
        (duration < q.min_duration_sec, "too_short"),
        (duration > q.max_duration_sec, "too_long"),
        (cps < q.min_chars_per_second, "too_slow"),
        (cps > q.max_chars_per_second, "too_fast"),
        (~asr_error & (cer > q.max_cer), "high_cer"),
        (~asr_error & (hypothesis == ""), "empty_transcript"),
        (asr_error, "asr_error"),
    ]
    listed = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for rule, name in rules]))
    return F.when(missing, F.array(F.lit("missing_audio"))).when(unreadable, F.array(F.lit("duration_read_error"))).otherwise(listed)


def status(flag_list: Column, failed: Column) -> Column:
    return F.when(failed, "error").when(F.size(flag_list) > 0, "flagged").otherwise("ok")


def signals(audio: DataFrame, q: Quality, *, assume_nfc: bool = False) -> DataFrame:
    """Quality records.

    ``audio``: id, prompt_id, audio_path, text, duration_sec (read from the file; null if it can't
    be), exists, transcript, asr_error (message or null), seq. The error rate is compared as it is
    stored, rounded to three places; rate and duration as measured.
    """
    rows = audio.withColumn("__ref", normalize_for_comparison(F.col("text"), assume_nfc)).withColumn("__hyp", normalize_for_comparison(F.coalesce("transcript", F.lit("")), assume_nfc))
    missing = ~F.coalesce(F.col("exists"), F.lit(False))
    unreadable = ~missing & F.col("duration_sec").isNull()
    failed, error = missing | unreadable, F.col("asr_error").isNotNull()
    rows = rows.withColumn("__cps", F.when(~failed, rates.chars_per_second(F.col("text"), F.col("duration_sec"))))
    heard = ~failed & ~error
    rows = rows.withColumn("cer", F.when(heard, F.bround(rates.cer(F.col("__ref"), F.col("__hyp")), 3))).withColumn("wer", F.when(heard, F.bround(rates.wer(F.col("__ref"), F.col("__hyp")), 3)))
    listed = flags(q, duration=F.col("duration_sec"), cps=F.col("__cps"), cer=F.col("cer"), hypothesis=F.col("__hyp"), asr_error=error, missing=missing, unreadable=unreadable)
    message = F.when(missing, F.concat(F.lit("audio file not found: "), F.coalesce("audio_path", F.lit("")))).when(unreadable, F.lit("duration: not readable")).when(error, F.concat(F.lit("asr: "), F.col("asr_error")))
    return rows.select(
        "id", "prompt_id", "audio_path", F.bround("duration_sec", 3).alias("duration_sec"), F.when(heard, F.col("transcript")).alias("transcript"), "cer", "wer",
        F.bround("__cps", 2).alias("chars_per_sec"), listed.alias("flags"), status(listed, failed).alias("auto_status"), message.alias("error"), "seq",
    )


def outcomes(quality: DataFrame) -> DataFrame:
    """n_ok, n_flagged, n_error."""
    return quality.agg(*[F.count_if(F.col("auto_status") == s).alias(f"n_{s}") for s in ("ok", "flagged", "error")])
