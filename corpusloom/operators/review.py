"""Review: the queue, its display, decisions, navigation, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import display as D
from corpusloom.operators.manifest import latest_by, positions

# What a reviewer sees first.
PRIORITY = {"flagged": 0, "error": 1, "ok": 2, "unknown": 3}
LAST = 4


def queue(audio: DataFrame, quality: DataFrame) -> DataFrame:
    """Ok audio (repeated ids stay) with quality and ``position``: by priority, then log order. Without a quality row the status is unknown and flags are empty."""
    q = latest_by(quality, columns=["flags", "auto_status", "cer", "wer", "transcript", "chars_per_sec"]).drop("first_seq").withColumn("__has", F.lit(True))
    rows = audio.where("status = 'ok'").join(q, "id", "left")
    none = F.col("__has").isNull()
    rows = rows.withColumn("flags", F.when(none, F.array().cast("array<string>")).otherwise(F.col("flags"))).withColumn("auto_status", F.when(none, F.lit("unknown")).otherwise(F.col("auto_status")))
    place = F.lit(LAST)
    for name, p in PRIORITY.items():
        place = F.when(F.col("auto_status") == name, F.lit(p)).otherwise(place)
    rows = rows.withColumn("priority", place.cast("int")).drop("__has")
    # one number orders both: priorities are few, log positions stay below 2^56
    return positions(rows.withColumn("__order", F.shiftleft(F.col("priority").cast("long"), 56) + F.col("seq")), "__order").drop("__order")


def with_decisions(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    last = latest_by(decisions, columns=["decision", "final_text", "note"]).select("id", "decision", F.col("final_text").alias("decided_text"), "note")
    return rows.join(last, "id", "left")


def next_unreviewed(rows: DataFrame, decisions: DataFrame, at: int) -> DataFrame:
    """One row, ``next_position``: the first unreviewed place behind ``at``, else the first before it, else ``at``."""
    open_ = rows.join(decisions.select("id"), "id", "left_anti").where(F.col("position") != at)
    ahead, behind = F.min(F.when(F.col("position") > at, F.col("position"))), F.min(F.when(F.col("position") < at, F.col("position")))
    return open_.agg(F.coalesce(ahead, behind, F.lit(at)).cast("long").alias("next_position"))


def stepped(rows: DataFrame, delta: int) -> DataFrame:
    """position, to: the place ``delta`` further, kept within the queue."""
    n = rows.agg(F.count("*").alias("n")).scalar()
    return rows.select("position", F.greatest(F.lit(0), F.least(F.col("position") + delta, n - 1)).cast("long").alias("to"))


def decided(rows: DataFrame, decision: str, edited: str | None = None, note: str | None = None) -> DataFrame:
    """Decision records: edits carry the stripped edit, accepts the text, rejects nothing; a blank note is none."""
    text = {"edit": F.trim(F.lit(edited)), "accept": F.col("text")}.get(decision, F.lit(None).cast("string"))
    return rows.select("id", F.lit(decision).alias("decision"), text.cast("string").alias("final_text"), F.nullif(F.trim(F.lit(note).cast("string")), F.lit("")).alias("note"))


def display(rows: DataFrame) -> DataFrame:
    """id, position and the strings that a reviewer reads."""
    return rows.select(
        "id", "position", D.flag_list(F.col("flags")).alias("flags_text"), D.number(F.col("cer"), 2).alias("cer_text"), D.number(F.col("wer"), 2).alias("wer_text"),
        D.number(F.col("chars_per_sec"), 1).alias("cps_text"), D.number(F.col("duration_sec"), 2, "s").alias("duration_text"), D.shortened(F.col("text")).alias("text_short"),
    )


def progress(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """reviewed, total and the counts of each decision, latest entries only."""
    last = latest_by(decisions, columns=["decision"])
    tally = last.agg(F.count("*").alias("reviewed"), *[F.count_if(F.col("decision") == d).alias(f"n_{d}") for d in ("accept", "edit", "reject")])
    return tally.withColumn("total", rows.agg(F.count("*").alias("total")).scalar())


def cleared_notes(decisions: DataFrame) -> DataFrame:
    """n_entries, n_ids, n_notes: what a compaction reads, keeps and clears."""
    kept = latest_by(decisions, columns=["note"]).agg(F.count("*").alias("n_ids"), F.count_if(F.coalesce("note", F.lit("")) != "").alias("n_notes"))
    return kept.withColumn("n_entries", decisions.agg(F.count("*").alias("n")).scalar())
