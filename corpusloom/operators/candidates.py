"""Candidates for prompts: validation, planning, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.shared import kept


def prepared(candidates: DataFrame, assume_nfc: bool = False) -> DataFrame:
    """cleaned, word_count and hash, each computed once."""
    out = candidates.withColumn("cleaned", T.clean(F.col("text")))
    return out.withColumn("word_count", T.word_count(F.col("cleaned"))).withColumn("hash", T.text_hash(F.col("cleaned"), assume_nfc))


def first_reason(low: int, high: int, script: str = T.SCRIPT, least: float = 0.3) -> Column:
    """The first rule that a prepared candidate breaks, empty if none: emptiness, length, script."""
    n = F.col("word_count")
    return (
        F.when(F.col("cleaned") == "", "empty_after_cleaning")
        .when(n < low, F.concat(F.lit("too_short_"), n.cast("string"), F.lit("w")))
        .when(n > high, F.concat(F.lit("too_long_"), n.cast("string"), F.lit("w")))
        .when(~T.looks_like_script(F.col("cleaned"), least, script), "not_arabic_enough")
        .otherwise("")
    )


def judged(candidates: DataFrame, existing: DataFrame | None = None, *, low: int = 3, high: int = 25, script: str = T.SCRIPT, least: float = 0.3, seq: str = "seq", assume_nfc: bool = False) -> DataFrame:
    """seq, word_count, hash, reason. Duplicates come last: of what passes the other rules, all but the first of a hash, or any whose hash exists.

    Texts are read and normalised once; what goes on is a few values a candidate. The first of a hash that
    several have is found by an aggregate with partial sums; no text is dealt by its hash.
    """
    rows = prepared(candidates, assume_nfc).withColumn("reason", first_reason(low, high, script, least))
    rows = kept(rows.select(F.col(seq).alias("seq"), "word_count", "hash", "reason"))
    first = rows.where("reason = ''").groupBy("hash").agg(F.min("seq").alias("first"), F.count("*").alias("n")).where("n > 1").select("hash", "first")
    rows = rows.join(first, "hash", "left")
    late = F.col("seq") > F.coalesce("first", "seq")
    if existing is not None:
        rows = rows.join(existing.select("hash", F.lit(True).alias("known")).distinct(), "hash", "left")
        late = late | F.col("known").isNotNull()
    return rows.select(F.col("seq").alias(seq), "word_count", "hash", F.when((F.col("reason") == "") & late, "duplicate").otherwise(F.col("reason")).alias("reason"))


def validated(candidates: DataFrame, existing: DataFrame | None = None, **rules) -> DataFrame:
    """The candidates with cleaned, word_count, hash and reason; rules as in ``judged``."""
    seq = rules.get("seq", "seq")
    return candidates.withColumn("cleaned", T.clean(F.col("text"))).join(judged(candidates, existing, **rules), seq)


def reason_counts(rows: DataFrame) -> DataFrame:
    return rows.where("reason != ''").groupBy("reason").agg(F.count("*").alias("n"))


def targets(categories: DataFrame, total: int) -> DataFrame:
    """category, target: shares of the total, halves to even, not balanced to sum up."""
    return categories.select("category", F.bround(F.col("proportion") * F.lit(float(total))).cast("int").alias("target"))


def deficits(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """category, deficit: what is still missing, satisfied categories dropped."""
    have = existing.groupBy("category").agg(F.count("*").alias("have"))
    missing = plan.join(have, "category", "left").select("category", (F.col("target") - F.coalesce("have", F.lit(0))).cast("int").alias("deficit"))
    return missing.where("deficit > 0")


def total_deficit(missing: DataFrame) -> DataFrame:
    """total: prompts still missing over all categories, 0 if none."""
    return missing.agg(F.coalesce(F.sum("deficit"), F.lit(0)).cast("long").alias("total"))


def next_category(missing: DataFrame, per_request: int = 15) -> DataFrame:
    """category, deficit, batch_n of the largest deficit; ties by a fixed hash."""
    batch = F.least(F.lit(per_request), F.col("deficit") + 5).alias("batch_n")
    return missing.orderBy(F.col("deficit").desc(), F.sha1("category")).limit(1).select("category", "deficit", batch)


def within_quota(valid: DataFrame, missing: DataFrame, seq: str = "seq") -> DataFrame:
    """The first ``deficit`` valid rows of each category.

    Rows are numbered in their category with a cap at the largest deficit, so that the window keeps
    only that many rows of a category in each task before the shuffle.
    """
    most = missing.agg(F.max("deficit").alias("m")).first()["m"] or 0
    rank = F.row_number().over(W.partitionBy("category").orderBy(seq))
    numbered = valid.withColumn("__rank", rank).where(F.col("__rank") <= int(most))
    return numbered.join(F.broadcast(missing), "category").where("__rank <= deficit").drop("__rank", "deficit")


def prompt_records(accepted: DataFrame, model: str) -> DataFrame:
    return accepted.select(F.col("hash").alias("id"), "hash", F.col("cleaned").alias("text"), "category", "word_count", F.lit(f"llm:{model}").alias("source"), "seq")
