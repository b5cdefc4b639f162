"""Stages from the command line: prompts, tts, quality, review, export, all (the first three);
besides compact (the review log), sample, report and verify (the export).

Every stage resumes: what its manifest already holds is left out, so a second run adds nothing.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom import config, providers
from corpusloom.config import Config
from corpusloom.operators import assign, candidates, curate, manifest, reports, review, sample, signals
from corpusloom.schemas import AUDIO, PROMPTS, QUALITY, REVIEWED, with_seq
from corpusloom.sources import dataset, jsonl, wav

log = logging.getLogger("corpusloom")


def read(spark: SparkSession, cfg: Config, name: str):
    schema = {"prompts_manifest": PROMPTS, "audio_manifest": AUDIO, "quality_manifest": QUALITY, "reviewed_manifest": REVIEWED}[name]
    return jsonl.read(spark, cfg.path(name), with_seq(schema))


def generate_prompts(spark: SparkSession, cfg: Config, reply=providers.stub_reply) -> int:
    """Requests by the largest deficit until the plan is met or several requests in a row give nothing; returns the prompts added."""
    p, path, added, empty, batch = cfg.prompts, cfg.path("prompts_manifest"), 0, 0, 0
    plan = candidates.targets(config.category_table(spark, p.categories), p.total_target)
    while empty < p.max_empty_batches:
        existing = read(spark, cfg, "prompts_manifest")
        missing = candidates.deficits(plan, existing)
        one = candidates.next_category(missing, p.prompts_per_request).first()
        if one is None:
            break
        batch += 1
        try:
            found = providers.generate(spark, one["category"], one["batch_n"], batch, reply)
        except Exception as e:
            log.error("request for %s failed: %s", one["category"], e)
            empty += 1
            continue
        valid = candidates.validated(found, existing, low=p.min_words, high=p.max_words, least=p.min_script_ratio).where("reason = ''")
        new = candidates.prompt_records(candidates.within_quota(valid, missing), p.model).cache()
        n = new.count()
        if n:
            jsonl.append_numbered(new, path, PROMPTS, "seq")
        new.unpersist()
        added, empty = added + n, 0 if n else empty + 1
    return added


def synthesize(spark: SparkSession, cfg: Config, speech=None) -> int:
    prompts = read(spark, cfg, "prompts_manifest")
    if prompts.isEmpty():
        raise RuntimeError("no prompts; run that stage first")
    todo = assign.audio_records(assign.round_robin(prompts, config.voice_table(spark, cfg.speech.voices)), cfg.speech.output_sample_rate)
    todo = manifest.synthesis_pending(todo, read(spark, cfg, "audio_manifest")).repartition(cfg.speech.concurrency)
    made = providers.synthesize(todo, cfg.root, cfg.paths.get("audio_dir", config.DEFAULT_PATHS["audio_dir"]), speech, cfg.speech.timeout, cfg.speech.first_wait).cache()
    n = made.count()
    if n:
        jsonl.append_numbered(made, cfg.path("audio_manifest"), AUDIO, "seq")
    made.unpersist()
    return n


def compute_quality(spark: SparkSession, cfg: Config, hear=providers.stub_transcript) -> int:
    todo = manifest.quality_pending(read(spark, cfg, "audio_manifest"), read(spark, cfg, "quality_manifest"))
    if todo.isEmpty():
        return 0
    folder = cfg.path("audio_dir")
    found = wav.durations(wav.files(spark, folder, content=True)) if jsonl.exists(spark, folder) else spark.createDataFrame([], "path string, duration_sec double, sample_rate int")
    found = found.select(F.substring_index("path", "/", -1).alias("file"), F.col("duration_sec").alias("measured"), F.lit(True).alias("exists"))
    clips = todo.withColumn("file", F.substring_index("audio_path", "/", -1)).join(found, "file", "left").drop("file", "duration_sec").withColumnRenamed("measured", "duration_sec")
    done = signals.signals(providers.transcribe(clips, hear), cfg.quality).cache()
    n = done.count()
    jsonl.append_numbered(done, cfg.path("quality_manifest"), QUALITY, "seq")
    done.unpersist()
    return n


def decide(spark: SparkSession, cfg: Config, ids: list[str], decision: str, edited: str | None = None, note: str | None = None) -> None:
    """Append decisions on a few samples; the latest entry of an id counts."""
    rows = read(spark, cfg, "audio_manifest").where(F.col("id").isin(ids))
    jsonl.append_numbered(review.decided(rows, decision, edited, note), cfg.path("reviewed_manifest"), REVIEWED)


def show_review(spark: SparkSession, cfg: Config) -> None:
    queue = review.queue(read(spark, cfg, "audio_manifest"), read(spark, cfg, "quality_manifest"))
    review.display(queue).orderBy("position").show(20, truncate=60)
    review.progress(queue, read(spark, cfg, "reviewed_manifest")).show()


def export(spark: SparkSession, cfg: Config) -> str:
    return dataset.export(spark, cfg, read(spark, cfg, "audio_manifest"), read(spark, cfg, "quality_manifest"), read(spark, cfg, "reviewed_manifest"))


def compact_reviews(spark: SparkSession, cfg: Config) -> dict:
    """Rewrite the review log as its latest entries, notes cleared; returns what was read, kept and cleared."""
    log_ = read(spark, cfg, "reviewed_manifest")
    counts = review.cleared_notes(log_).first().asDict()
    # entries keep the place of their first appearance
    kept = manifest.compacted(log_).withColumn("seq", F.col("first_seq")).select(*[f.name for f in with_seq(REVIEWED).fields])
    jsonl.overwrite(kept, cfg.path("reviewed_manifest"))
    return counts


def draw_sample(spark: SparkSession, cfg: Config, size: int = 24) -> str:
    """A small stratified sample of what would be exported, with its files, below the final folder."""
    rows = curate.export_rows(curate.joined(read(spark, cfg, "audio_manifest"), read(spark, cfg, "quality_manifest"), read(spark, cfg, "reviewed_manifest"), cfg.export), cfg.export)
    target = f"{cfg.path('final_dir')}/samples"
    dataset.write_sample(spark, sample.round_robin_sample(rows, ["voice_id", "category"], size, "first_seq").drop("first_seq"), cfg.root, target)
    return target


def show_reports(spark: SparkSession, cfg: Config) -> None:
    audio, quality, reviews = (read(spark, cfg, n) for n in ("audio_manifest", "quality_manifest", "reviewed_manifest"))
    rows = reports.report_rows(audio, quality, reviews)
    tables = {"summary": reports.summary(quality), "flags": reports.flag_reasons(quality), "by voice": reports.by_voice(rows), "by category": reports.by_category(rows), "code switching": reports.versus(rows, "code_switching"), "decisions": reports.decisions_by_voice(rows)}
    for name, table in tables.items():
        print(name)
        table.show(truncate=False)


def verify(spark: SparkSession, cfg: Config) -> list[str]:
    return dataset.verify(spark, f"{cfg.path('final_dir')}/{cfg.export.dataset_name}")


STAGES = {
    "prompts": generate_prompts, "tts": synthesize, "quality": compute_quality, "review": show_review, "export": export,
    "compact": compact_reviews, "sample": draw_sample, "report": show_reports, "verify": verify,
}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom")
    parser.add_argument("--stage", choices=[*STAGES, "all"], default="all")
    parser.add_argument("--config")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    cfg = config.load(given.config)  # a bad configuration fails before anything starts
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    try:
        for name in ("prompts", "tts", "quality") if given.stage == "all" else (given.stage,):
            found = STAGES[name](spark, cfg)
            log.info("%s: %s", name, found)
            if name == "verify" and found:
                return 1
    except KeyboardInterrupt:
        return 130
    return 0


if __name__ == "__main__":
    sys.exit(main())
