"""One query for each operator of the engine, over the whole test tables in the roles of roles.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.config import Export
from corpusloom.functions import display as D
from corpusloom.functions import quantiles, rates
from corpusloom.functions import text as T
from corpusloom.operators import assign, candidates, checks, curate, manifest, reports, review, sample, signals
from corpusloom.plans import roles
from corpusloom.shared import scratch
from corpusloom.sources import jsonl, wav
from corpusloom.streaming import incremental

LATIN = "A-Za-z"


def _joined(spark, d, rules: Export | None = None):
    return curate.joined(roles.audio(spark, d), roles.quality(spark, d), roles.reviews(spark, d), rules)


def _metadata(spark, d, rules: Export | None = None):
    return curate.export_rows(_joined(spark, d, rules), rules)


def _flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("auto_flags", F.array_join("auto_flags", ",")).drop("first_seq")


def export_join(spark, d):
    return _flat(_metadata(spark, d))


def export_include_rejected(spark, d):
    return _flat(_metadata(spark, d, Export(include_rejected=True)))


def export_include_flagged(spark, d):
    return _flat(_metadata(spark, d, Export(include_flagged=True)))


def export_skip_reasons(spark, d):
    return curate.skip_counts(_joined(spark, d))


def latest_decision(spark, d):
    return manifest.latest_by(roles.decision_log(spark, d)).select("id", "decision", "final_text", "note", "seq", "first_seq")


def decision_compaction(spark, d):
    return manifest.compacted(roles.decision_log(spark, d)).select("id", "decision", "final_text", "note", "first_seq")


def decision_tally(spark, d):
    return manifest.latest_by(roles.decision_log(spark, d)).groupBy("decision").agg(F.count("*").alias("n"))


def decision_audit_count(spark, d):
    return review.cleared_notes(roles.decision_log(spark, d))


def review_progress(spark, d):
    return review.progress(review.queue(roles.audio(spark, d), roles.quality(spark, d)), roles.reviews(spark, d))


def resume_pending_ok_only(spark, d):
    a = roles.audio(spark, d)
    return manifest.synthesis_pending(a, a).select("id", "seq")


def resume_pending_any(spark, d):
    return manifest.quality_pending(roles.audio(spark, d), roles.quality(spark, d)).select("id", "seq")


def dedup_against_existing(spark, d):
    known = roles.table(spark, d, "benchmark").select(F.explode(F.split("text", "\n")).alias("line")).select(T.text_hash(F.col("line")).alias("hash"))
    lines = roles.candidates(spark, d).select("seq", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return manifest.pending(lines.select("seq", "line", T.text_hash(F.col("text")).alias("hash")), known, "hash")


def clean_text(spark, d):
    return roles.candidates(spark, d).select("seq", T.clean(F.col("text")).alias("cleaned"))


def word_count(spark, d):
    return roles.candidates(spark, d).select("seq", T.word_count(F.col("text")).alias("word_count"))


def script_ratio(spark, d):
    return roles.candidates(spark, d).select("seq", T.script_ratio(F.col("text"), LATIN).alias("ratio"), T.looks_like_script(F.col("text"), 0.8, LATIN).alias("passes"))


def text_hash(spark, d):
    return roles.candidates(spark, d).select("seq", T.text_hash(F.col("text")).alias("hash"))


RULES = {"low": 20, "high": 600, "script": LATIN, "least": 0.8}


def validate_reasons(spark, d):
    return candidates.judged(roles.candidates(spark, d), **RULES)


def validate_reason_counts(spark, d):
    return candidates.reason_counts(validate_reasons(spark, d))


def _plan(spark):
    shares = spark.createDataFrame([("en", 0.55), ("de", 0.15), ("fr", 0.175), ("es", 0.125)], "category string, proportion double")
    return candidates.targets(shares, 300)


def _deficits(spark, d):
    return candidates.deficits(_plan(spark), roles.reviews(spark, d).where("decision = 'edit'").join(roles.audio(spark, d).select("id", "category"), "id"))


def accept_candidates(spark, d):
    # the quota is cut on narrow rows; texts come for what is accepted
    rows = roles.candidates(spark, d)
    valid = validate_reasons(spark, d).where("reason = ''").join(rows.select("seq", "category"), "seq")
    taken = candidates.within_quota(valid, _deficits(spark, d))
    return candidates.prompt_records(taken.join(rows.select("seq", T.clean(F.col("text")).alias("cleaned")), "seq"), "stub")


def plan_targets(spark, d):
    return candidates.targets(config.category_table(spark), 75)


def plan_deficit(spark, d):
    return _deficits(spark, d)


def plan_total_deficit(spark, d):
    return candidates.total_deficit(_deficits(spark, d))


def category_share_total(spark, d):
    return config.category_table(spark).agg(F.round(F.sum("proportion"), 9).alias("total"), F.count("*").alias("n"))


def plan_next_category(spark, d):
    return candidates.next_category(_deficits(spark, d))


def append_union(spark, d):
    both = manifest.appended(roles.reviews(spark, d), roles.decision_log(spark, d).drop("note"))
    return both.groupBy("decision").agg(F.count("*").alias("n"), F.count("note").alias("n_notes"))


def distinct_hashes(spark, d):
    return roles.candidates(spark, d).select(T.text_hash(F.col("text")).alias("hash")).distinct().agg(F.count("*").alias("n"))


def round_robin_voice(spark, d):
    prompts = roles.candidates(spark, d).withColumn("id", F.col("seq").cast("string"))
    return assign.round_robin(prompts, config.voice_table(spark)).select("seq", "position", "voice_id", "voice_slug", "sample_id")


def audio_record_defaults(spark, d):
    prompts = roles.candidates(spark, d).withColumn("id", F.col("seq").cast("string"))
    return assign.audio_records(assign.round_robin(prompts, config.voice_table(spark))).drop("text")


def voice_slug_id(spark, d):
    a = roles.audio(spark, d)
    s = D.slug(F.concat("voice_provider", F.lit(":x")), F.concat("audio_path", F.lit("/"), "voice_id"))
    return a.select("seq", s.alias("slug"), D.composite_id(F.col("prompt_id"), s).alias("composite"))


def qa_normalize(spark, d):
    return roles.candidates(spark, d).select("seq", T.normalize_for_comparison(F.col("text")).alias("normalized"))


def _ascii(c):
    return F.regexp_replace(c, r"[^\x00-\x7f]", "?")


def cer_pairs(spark, d):
    p = roles.pairs(spark, d).withColumn("ref", _ascii(T.normalize_for_comparison(F.col("ref")))).withColumn("hyp", _ascii(T.normalize_for_comparison(F.col("hyp"))))
    return p.select("conv_id", "turn", F.length("ref").alias("n"), rates.cer(F.col("ref"), F.col("hyp")).alias("cer"))


def cer_pairs_whole(spark, d):
    """As cer_pairs, over the texts as they are."""
    p = roles.pairs(spark, d).withColumn("ref", T.normalize_for_comparison(F.col("ref"))).withColumn("hyp", T.normalize_for_comparison(F.col("hyp")))
    return p.select("conv_id", "turn", F.length("ref").alias("n"), rates.cer(F.col("ref"), F.col("hyp")).alias("cer"))


def wer_pairs(spark, d):
    p = roles.pairs(spark, d).withColumn("ref", T.normalize_for_comparison(F.col("ref"))).withColumn("hyp", T.normalize_for_comparison(F.col("hyp")))
    return p.select("conv_id", "turn", F.size(F.split("ref", " ")).alias("n"), rates.wer(F.col("ref"), F.col("hyp")).alias("wer"))


def speaking_rate(spark, d):
    a = roles.audio(spark, d)
    return a.select("seq", rates.chars_per_second(F.col("text"), F.col("duration_sec")).alias("cps"))


def quality_flags(spark, d):
    return roles.quality(spark, d).select("id", "duration_sec", "cer", "wer", "chars_per_sec", D.flag_list(F.col("flags")).alias("flags"), "auto_status")


def signals_records(spark, d):
    """Quality records of clips: turns as texts, the replies as transcripts; some files are missing or unreadable, some transcriptions failed."""
    k = F.col("conv_id") * 31 + F.col("turn")
    clips = roles.pairs(spark, d).select(
        F.concat_ws("_", "conv_id", "turn").alias("id"), F.col("conv_id").cast("string").alias("prompt_id"), F.concat_ws("/", "conv_id", "turn").alias("audio_path"), F.col("ref").alias("text"),
        F.when(k % 13 != 0, T.word_count(F.col("ref")) * 4 / F.lit(10.0)).alias("duration_sec"), (k % 11 != 0).alias("exists"), F.col("hyp").alias("transcript"),
        F.when(k % 7 == 0, F.lit("no answer")).alias("asr_error"), k.alias("seq"),
    )
    return signals.signals(clips, roles.LIMITS).withColumn("flags", D.flag_list(F.col("flags")))


def batch_outcomes(spark, d):
    return signals.outcomes(roles.quality(spark, d))


def auto_status_counts(spark, d):
    return roles.quality(spark, d).groupBy("auto_status").agg(F.count("*").alias("n"))


def flag_reason_counts(spark, d):
    return reports.flag_reasons(roles.quality(spark, d))


def _queue(spark, d):
    return review.queue(roles.audio(spark, d), roles.quality(spark, d))


def review_queue(spark, d):
    return _queue(spark, d).select("id", "auto_status", "priority", "position", F.array_join("flags", ",").alias("flags"))


def review_decisions(spark, d):
    return review.with_decisions(_queue(spark, d), roles.reviews(spark, d)).select("id", "position", "decision", "decided_text", "note")


def next_unreviewed(spark, d):
    q = _queue(spark, d)
    return review.next_unreviewed(q, roles.reviews(spark, d), 40)


def navigation(spark, d):
    q = _queue(spark, d)
    return review.stepped(q, 1).withColumnRenamed("to", "following").join(review.stepped(q, -1).withColumnRenamed("to", "previous"), "position")


def review_display(spark, d):
    return review.display(_queue(spark, d))


def review_record(spark, d):
    return review.decided(_queue(spark, d), "edit", "  an edit ", "  ")


def _report(spark, d):
    return reports.report_rows(roles.audio(spark, d), roles.quality(spark, d), roles.reviews(spark, d))


def _rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order; reports are compared to nine places."""
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def cer_summary(spark, d):
    return _rounded(reports.summary(roles.quality(spark, d)))


def cer_by_voice(spark, d):
    return _rounded(reports.by_voice(_report(spark, d)))


def cer_by_category(spark, d):
    return _rounded(reports.by_category(_report(spark, d)))


def cer_by_category_ranked(spark, d):
    return reports.ranked(cer_by_category(spark, d), "category").select("category", "n", "mean_cer", "by_key", "by_size", "by_mean")


def category_ratio(spark, d):
    return _rounded(reports.versus(_report(spark, d), "fr"))


def reject_rate_by_voice(spark, d):
    return _rounded(reports.decisions_by_voice(_report(spark, d)))


def histogram_18(spark, d):
    return quantiles.histogram(roles.quality(spark, d), "cer", 18)


def order_statistics_by_category(spark, d):
    return quantiles.order_statistics(_report(spark, d), ["category"], "cer")


def cube_voice_category(spark, d):
    return _rounded(reports.cube_counts(_report(spark, d)))


def stratified_sample_24(spark, d):
    rows = _metadata(spark, d, Export(include_flagged=True))
    return sample.round_robin_sample(rows, ["voice_id", "category"], 24, "first_seq").select("place", "id", "voice_id", "category", D.dataset_relative(F.col("audio_relpath")).alias("audio_relpath"))


def dataset_card_stats(spark, d):
    return _rounded(reports.card_figures(_metadata(spark, d)))


def verify_distribution(spark, d):
    rows = _metadata(spark, d)
    parts = [manifest.counted(rows, c, "first_seq").select(F.lit(c).alias("column"), F.col(c).alias("value"), "n", "place") for c in ("voice_id", "category", "review_decision")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def verify_durations(spark, d):
    return _rounded(reports.duration_figures(_metadata(spark, d)))


def verify_paths(spark, d):
    return checks.path_report(roles.table(spark, d, "pages").select(F.regexp_extract("url", "^https?://[^/]*(/.*)?$", 1).alias("path")), "path", "/en/")


def leaked_paths(spark, d):
    p = roles.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("id"), "url", F.substring_index("url", "://", -1).alias("rest"))
    return checks.leaked_paths(p, prefixes=("http:", "m.", "blog."))


def first_leaks(spark, d):
    p = roles.table(spark, d, "pages").select(F.lpad(F.col("page_id").cast("string"), 12, "0").alias("id"), "url")
    return checks.first_leaks(p, 3, prefixes=("http:",))


def relative_paths(spark, d):
    u = F.col("url")
    return roles.table(spark, d, "pages").select("page_id", D.dataset_relative(u).alias("relative"), D.posix(F.translate(u, "/", "\\")).alias("posix"), D.absolute("/base", D.basename(u)).alias("absolute"), D.is_absolute(u).alias("is_absolute"))


def missing_audio_files(spark, d):
    files = roles.table(spark, d, "labels").join(roles.table(spark, d, "documents"), "doc_id").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"))
    return checks.missing_files(roles.audio(spark, d), files).select("id", "audio_path")


def final_schema_cast(spark, d):
    t = curate.typed(_metadata(spark, d))
    return t.select("id", "audio", "text", "duration_sec", "sample_rate", "asr_cer", "asr_wer", "is_synthetic", F.array_join("auto_flags", ",").alias("auto_flags"))


def display_labels(spark, d):
    names = {"ar-EG-SalmaNeural": "Salma", "ar-EG-ShakirNeural": "Shakir"}
    return roles.audio(spark, d).groupBy(D.label(F.col("voice_id"), names).alias("label")).agg(F.count("*").alias("n"), F.round(F.sum("duration_sec"), 6).alias("total_sec"))


def error_texts(spark, d):
    log = roles.decision_log(spark, d)
    return log.select("seq", D.error_text(F.col("decision"), F.col("final_text")).alias("error"))


def json_props(spark, d):
    log = roles.decision_log(spark, d)
    return log.select("seq", F.get_json_object("final_text", "$.k").cast("int").alias("k"), F.size(D.prompts_from_json(F.concat(F.lit('{"prompts": ["'), "decision", F.lit('", 7]}')))).alias("n"))


def segments_joined(spark, d):
    return roles.candidates(spark, d).select("seq", D.joined_segments(F.split("text", "\n")).alias("joined"))


def jsonl_roundtrip(spark, d):
    path = scratch(spark, "log")
    jsonl.append(roles.decision_log(spark, d).repartition(4, "seq"), path)
    back = jsonl.read(spark, path, "id STRING, decision STRING, final_text STRING, note STRING, seq LONG")
    return back.select("id", "decision", "final_text", "note", "seq")


def _log_files(spark, d, path: str, columns: list[str]) -> None:
    """The decision log as JSON lines in several files, in order of their names."""
    roles.decision_log(spark, d).repartitionByRange(5, "seq").sortWithinPartitions("seq").select(*columns).write.option("ignoreNullFields", "false").json(path)


def log_in_order(spark, d):
    path = scratch(spark, "log")
    _log_files(spark, d, path, ["id", "decision", "final_text", "note"])
    return jsonl.read_in_order(spark, path, "id STRING, decision STRING, final_text STRING, note STRING")


def log_overwrite(spark, d):
    """A log that is rewritten from itself: its latest entries in place of all."""
    path, schema = scratch(spark, "log"), "id STRING, decision STRING, final_text STRING, note STRING, seq LONG"
    _log_files(spark, d, path, ["id", "decision", "final_text", "note", "seq"])
    kept = manifest.compacted(jsonl.read(spark, path, schema))
    jsonl.overwrite(kept.select("id", "decision", "final_text", "note", F.col("first_seq").alias("seq")), path)
    return jsonl.read(spark, path, schema).select("id", "decision", "final_text", "note", F.col("seq").alias("first_seq"))


def _clip(key: Column) -> Column:
    """A clip of key % 5000 + 1 frames; every seventh is no WAV, every fifth has a longer header than usual."""
    n_bytes = F.pmod(key, F.lit(5000)) * 2 + 2
    longer = F.pmod(key, F.lit(5)) == 0
    zeros = lambda n: F.repeat(F.lit("\0"), n.cast("int")).cast("binary")
    ascii_hex = lambda x: F.lit(x.encode("ascii").hex())

    def little_endian(x: Column) -> Column:
        h = F.lpad(F.hex(x.cast("long")), 8, "0")
        return F.concat(*[F.substring(h, at, 2) for at in (7, 5, 3, 1)])

    fmt = F.concat(*map(little_endian, (F.lit(16), F.lit(1 + (1 << 16)), F.lit(16000), F.lit(32000), F.lit(2 + (16 << 16)))))  # PCM, one channel, 16 bits
    extra = F.when(longer, F.concat(ascii_hex("LIST"), little_endian(F.lit(4)), ascii_hex("INFO"))).otherwise("")
    whole = F.when(longer, n_bytes + 48).otherwise(n_bytes + 36)
    head = F.concat(ascii_hex("RIFF"), little_endian(whole), ascii_hex("WAVEfmt "), fmt, extra, ascii_hex("data"), little_endian(n_bytes))
    return F.when(F.pmod(key, F.lit(7)) == 0, F.concat(F.lit(b"RIFF"), zeros(F.pmod(key, F.lit(400))))).otherwise(F.concat(F.unhex(head), zeros(n_bytes)))


def _clips(spark, d):
    return roles.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), _clip(F.col("doc_id")).alias("content"))


def wav_durations(spark, d):
    return wav.durations(_clips(spark, d))


def wav_clips(spark, d):
    return _clips(spark, d).where(wav.is_clip(F.col("content"))).select("path", F.octet_length("content").cast("long").alias("n_bytes"))


def dataset_schema(spark, d):
    path = scratch(spark, "dataset")
    curate.typed(_metadata(spark, d)).write.parquet(path)
    return checks.schema_rows(spark.read.parquet(path))


def _event_files(spark, d) -> str:
    path = scratch(spark, "events")
    roles.table(spark, d, "events").repartitionByRange(6, "event_id").write.parquet(path)
    return path


def stream_latest_files(spark, d):
    """As stream_latest over six files, one a micro-batch: each merges with the state of those before."""
    return incremental.run_latest(spark, _event_files(spark, d), scratch(spark, "stream"))


def stream_dedup_files(spark, d):
    return incremental.run_dedup(spark, _event_files(spark, d), scratch(spark, "stream"))


def stream_resume_files(spark, d):
    return incremental.run_resume(spark, _event_files(spark, d), scratch(spark, "stream"))


def export_parquet_roundtrip(spark, d):
    path = scratch(spark, "dataset")
    curate.typed(_metadata(spark, d)).write.parquet(path)
    return spark.read.parquet(path).groupBy("category").agg(F.count("*").alias("n"), F.count_if(F.col("asr_cer").isNull()).alias("n_null"), F.max("duration_sec").cast("double").alias("longest"))


def stream_latest(spark, d):
    return incremental.run_latest(spark, f"{d}/events.parquet", scratch(spark, "stream"))


def stream_dedup(spark, d):
    return incremental.run_dedup(spark, f"{d}/events.parquet", scratch(spark, "stream"))


def stream_resume(spark, d):
    return incremental.run_resume(spark, f"{d}/events.parquet", scratch(spark, "stream"))


QUERIES = {
    f.__name__: f
    for f in (
        export_join, export_include_rejected, export_include_flagged, export_skip_reasons, latest_decision, decision_compaction, decision_tally,
        decision_audit_count, review_progress, resume_pending_ok_only, resume_pending_any, dedup_against_existing, clean_text, word_count,
        script_ratio, text_hash, validate_reasons, validate_reason_counts, accept_candidates, plan_targets, plan_deficit, plan_next_category,
        append_union, distinct_hashes, round_robin_voice, audio_record_defaults, voice_slug_id, qa_normalize, cer_pairs, cer_pairs_whole, wer_pairs, speaking_rate,
        quality_flags, auto_status_counts, flag_reason_counts, review_queue, review_decisions, next_unreviewed, navigation, review_display,
        review_record, cer_summary, cer_by_voice, cer_by_category, category_ratio, reject_rate_by_voice, histogram_18,
        order_statistics_by_category, cube_voice_category, stratified_sample_24, dataset_card_stats, verify_distribution, verify_durations,
        verify_paths, leaked_paths, relative_paths, missing_audio_files, final_schema_cast, display_labels, error_texts, json_props,
        segments_joined, jsonl_roundtrip, export_parquet_roundtrip, stream_latest, stream_dedup, stream_resume,
        plan_total_deficit, category_share_total, signals_records, batch_outcomes, cer_by_category_ranked, first_leaks, log_in_order, log_overwrite,
        wav_durations, wav_clips, dataset_schema, stream_latest_files, stream_dedup_files, stream_resume_files,
    )
}
