"""The test tables in the roles of manifests.

documents are clips (category = language, 0.4 s a word, the share of other characters than A-Z as
the error rate, in thousandths rounded down); those not in Spanish have a quality entry. labels are
reviews (toxic: reject, quality: accept, else edit). events are a decision log by user.
conversations are pairs of a turn and the next turn's reply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.config import VOICES, Quality
from corpusloom.functions import text as T
from corpusloom.functions.rates import chars_per_second
from corpusloom.operators import signals

LIMITS = Quality(max_cer=0.25, min_duration_sec=0.5, max_duration_sec=1000.0, min_chars_per_second=12.0, max_chars_per_second=15.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "text", F.col("lang").alias("category"), "source")


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    voice = F.element_at(F.array(*[F.struct(F.lit(v.provider).alias("p"), F.lit(v.voice_id).alias("v"), F.lit(v.gender).alias("g"), F.lit(v.dialect).alias("d")) for v in VOICES]), (F.col("doc_id") % 3 + 1).cast("int"))
    key = F.col("doc_id").cast("string")
    return d.withColumn("voice", voice).select(
        key.alias("id"), key.alias("prompt_id"), "text", F.col("lang").alias("category"), F.col("voice.p").alias("voice_provider"), F.col("voice.v").alias("voice_id"),
        F.col("voice.g").alias("voice_gender"), F.col("voice.d").alias("voice_dialect"), F.concat("source", F.lit("/"), key, F.lit(".wav")).alias("audio_path"),
        (T.word_count(F.col("text")) * 4 / F.lit(10.0)).alias("duration_sec"), F.lit(16000).alias("sample_rate"), F.when(F.col("n_chars") < 40, "failed").otherwise("ok").alias("status"),
        F.lit(None).cast("string").alias("error"), F.col("doc_id").alias("seq"),
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = audio(spark, sf_dir).where("category != 'es'")
    n = F.length("text")
    other = n - F.length(F.regexp_replace("text", "[^A-Za-z]", ""))
    cer = F.when(n >= 200, F.floor(other * 1000 / n) / F.lit(1000.0))
    cps = chars_per_second(F.col("text"), F.col("duration_sec"))
    no = F.lit(False)
    a = a.withColumn("cer", cer).withColumn("flags", signals.flags(LIMITS, duration=F.col("duration_sec"), cps=cps, cer=F.col("cer"), hypothesis=F.col("text"), asr_error=no, missing=no, unreadable=no))
    return a.select("id", "prompt_id", "audio_path", "duration_sec", F.col("category").alias("transcript"), "cer", (F.col("cer") * 2).alias("wer"), F.floor(cps).cast("double").alias("chars_per_sec"), "flags", signals.status(F.col("flags"), no).alias("auto_status"), F.lit(None).cast("string").alias("error"), "seq")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "accept").otherwise("edit")
    edited = F.when(decision == "edit", F.concat(F.lit("edited "), F.col("doc_id").cast("string"))).when(decision == "accept", F.lit(""))
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), decision.alias("decision"), edited.alias("final_text"), F.when(F.col("quality") == 0, F.lit("low")).alias("note"), F.col("doc_id").alias("seq"))


def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("decision"), F.col("props").alias("final_text"), F.when(F.col("value") < 10, F.col("event_type")).alias("note"), F.col("event_id").alias("seq"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, ref, hyp: a user's turn and the assistant's next."""
    c = table(spark, sf_dir, "conversations")
    after = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    both = c.select("conv_id", "turn", "role", F.col("text").alias("ref"), F.lead("text").over(after).alias("hyp"), F.lead("role").over(after).alias("next_role"))
    return both.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", "ref", "hyp")


_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def words_sql(column: str) -> str:
    return f"len(list_filter(string_split_regex({column}, '{_WS}+'), lambda x: x <> ''))"



#: The same roles as common table expressions.
SQL = rf"""
audio AS (
  SELECT doc_id::VARCHAR AS id, doc_id::VARCHAR AS prompt_id, text, lang AS category,
    ['edge', 'edge', 'gtts'][(doc_id % 3 + 1)::INT] AS voice_provider,
    ['ar-EG-SalmaNeural', 'ar-EG-ShakirNeural', 'ar'][(doc_id % 3 + 1)::INT] AS voice_id,
    ['female', 'male', 'unknown'][(doc_id % 3 + 1)::INT] AS voice_gender,
    ['egyptian', 'egyptian', 'msa_leaning'][(doc_id % 3 + 1)::INT] AS voice_dialect,
    source || '/' || doc_id || '.wav' AS audio_path,
    {words_sql("text")} * 4 / 10.0::DOUBLE AS duration_sec, 16000 AS sample_rate,
    CASE WHEN n_chars < 40 THEN 'failed' ELSE 'ok' END AS status, NULL::VARCHAR AS error, doc_id AS seq
  FROM documents
),
measured AS (
  SELECT *, CASE WHEN length(text) >= 200 THEN floor((length(text) - length(regexp_replace(text, '[^A-Za-z]', '', 'g'))) * 1000 / length(text)) / 1000.0::DOUBLE END AS cer,
    length(replace(text, ' ', '')) / greatest(duration_sec, 1e-6::DOUBLE) AS cps
  FROM audio WHERE category <> 'es'
),
flagged AS (
  SELECT *, list_filter([
    CASE WHEN duration_sec < 0.5::DOUBLE THEN 'too_short' END, CASE WHEN duration_sec > 1000.0::DOUBLE THEN 'too_long' END,
    CASE WHEN cps < 12.0::DOUBLE THEN 'too_slow' END, CASE WHEN cps > 15.0::DOUBLE THEN 'too_fast' END,
    CASE WHEN cer > 0.25::DOUBLE THEN 'high_cer' END, CASE WHEN text = '' THEN 'empty_transcript' END], lambda x: x IS NOT NULL) AS flags
  FROM measured
),
quality AS (
  SELECT id, prompt_id, audio_path, duration_sec, category AS transcript, cer, cer * 2 AS wer, floor(cps)::DOUBLE AS chars_per_sec, flags,
    CASE WHEN len(flags) > 0 THEN 'flagged' ELSE 'ok' END AS auto_status, seq
  FROM flagged
),
reviews AS (
  SELECT doc_id::VARCHAR AS id, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'accept' ELSE 'edit' END AS decision,
    CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN '' ELSE 'edited ' || doc_id END AS final_text,
    CASE WHEN quality = 0 THEN 'low' END AS note, doc_id AS seq
  FROM labels
),
log AS (
  SELECT user_id::VARCHAR AS id, event_type AS decision, props AS final_text, CASE WHEN value < 10 THEN event_type END AS note, event_id AS seq FROM events
),
pairs AS (
  SELECT conv_id, turn, ref, hyp FROM (
    SELECT conv_id, turn, role, text AS ref, lead(text) OVER o AS hyp, lead(role) OVER o AS next_role
    FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
  WHERE role = 'user' AND next_role = 'assistant'
),
joined AS (
  SELECT a.*, r.decision, r.final_text, r.note, q.id IS NOT NULL AS has_quality, q.transcript, q.cer, q.wer, q.flags, q.auto_status
  FROM audio a LEFT JOIN reviews r USING (id) LEFT JOIN quality q USING (id) WHERE a.status = 'ok'
),
report AS (
  SELECT q.*, a.category, a.voice_id, r.decision FROM quality q JOIN audio a USING (id) LEFT JOIN reviews r USING (id) WHERE a.status = 'ok'
)
"""
