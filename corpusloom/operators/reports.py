"""Reports: rates by voice and category, flag reasons, distributions, figures of the dataset card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.quantiles import order_statistics
from corpusloom.operators.manifest import latest_by


def report_rows(audio: DataFrame, quality: DataFrame, reviews: DataFrame, columns: Sequence[str] = ("category", "voice_id")) -> DataFrame:
    """Quality entries with ``columns`` of their audio and the latest decision; quality's id, prompt, path, duration and error win."""
    a = latest_by(audio.where("status = 'ok'"), columns=columns).select("id", *columns)
    return quality.join(a, "id").join(latest_by(reviews, columns=["decision"]).select("id", "decision"), "id", "left")


def _shares(*names: str):
    out = []
    for column, value in (("auto_status", "flagged"), ("decision", "reject")):
        n = F.count_if(F.col(column) == value)
        name = "rejected" if value == "reject" else value
        out += [n.alias(f"n_{name}"), (F.lit(100.0) * n / F.count("*")).alias(f"pct_{name}")]
    return out


def summary(quality: DataFrame) -> DataFrame:
    """One row: n, mean, upper median, p90, greatest rate, flagged."""
    stats = order_statistics(quality.withColumn("__all", F.lit(1)), ["__all"], "cer")
    head = quality.agg(F.count("*").alias("n"), F.avg("cer").alias("mean_cer"), F.max("cer").alias("max_cer"), F.count_if(F.col("auto_status") == "flagged").alias("n_flagged"), F.try_divide(F.lit(100.0) * F.count_if(F.col("auto_status") == "flagged"), F.count("*")).alias("pct_flagged"))
    return head.select("n", "mean_cer", stats.select("upper_median").scalar().alias("median_cer"), stats.select("p90").scalar().alias("p90_cer"), "max_cer", "n_flagged", "pct_flagged")


def by_voice(rows: DataFrame) -> DataFrame:
    stats = order_statistics(rows, ["voice_id"], "cer").select("voice_id", F.col("median").alias("median_cer"), F.col("p90").alias("p90_cer"))
    return rows.groupBy("voice_id").agg(F.count("*").alias("n"), F.avg("cer").alias("mean_cer"), *_shares()).join(stats, "voice_id", "left")


def by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.avg("cer").alias("mean_cer"), *_shares())


def ranked(report: DataFrame, key: str, mean: str = "mean_cer", size: str = "n") -> DataFrame:
    """A report with a row for each key, and the row's place by key, by size and by mean (largest first, nulls last, ties by key). The windows hold the report's rows."""
    place = lambda *order: F.row_number().over(W.orderBy(*order))
    return report.withColumns({"by_key": place(key), "by_size": place(F.col(size).desc(), key), "by_mean": place(F.col(mean).desc_nulls_last(), key)})


def versus(rows: DataFrame, category: str) -> DataFrame:
    """One pass: counts and means within the category and outside it, and their ratio."""
    own = F.col("category").eqNullSafe(category)
    inside, outside = F.avg(F.when(own, F.col("cer"))), F.avg(F.when(~own, F.col("cer")))
    return rows.agg(F.count_if(own).alias("n_in"), inside.alias("mean_in"), F.count_if(~own).alias("n_out"), outside.alias("mean_out"), F.try_divide(inside, outside).alias("ratio"))


def decisions_by_voice(rows: DataFrame) -> DataFrame:
    seen = rows.where("decision IS NOT NULL")
    counts = [F.count_if(F.col("decision") == d) for d in ("reject", "accept", "edit")]
    return seen.groupBy("voice_id").agg(F.count("*").alias("n"), counts[0].alias("n_reject"), counts[1].alias("n_accept"), counts[2].alias("n_edit"), (F.lit(100.0) * counts[0] / F.greatest(F.count("*"), F.lit(1))).alias("pct_reject"))


def flag_reasons(quality: DataFrame) -> DataFrame:
    return quality.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def card_figures(metadata: DataFrame) -> DataFrame:
    """One row: samples, seconds, minutes, mean rate (0 where there is none)."""
    seconds = F.coalesce(F.sum(F.coalesce("duration_sec", F.lit(0.0))), F.lit(0.0))
    return metadata.agg(F.count("*").alias("n_samples"), seconds.alias("total_sec"), (seconds / 60).alias("total_min"), F.coalesce(F.avg("asr_cer"), F.lit(0.0)).alias("mean_cer"))


def cube_counts(rows: DataFrame) -> DataFrame:
    """Voices by categories with subtotals (an addition)."""
    return rows.cube("voice_id", "category").agg(F.count("*").alias("n"), F.avg("cer").alias("mean_cer"))


def duration_figures(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("duration_sec").alias("total_sec"), F.avg("duration_sec").alias("mean_sec"), F.avg("asr_cer").alias("mean_cer"), F.max("asr_cer").alias("max_cer"))
