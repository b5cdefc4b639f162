"""The exported dataset: metadata lines, typed Parquet (and Arrow on request), payload copies, card."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.functions.display import basename
from corpusloom.operators import checks, curate, manifest, reports
from corpusloom.schemas import DATASET
from corpusloom.sources import jsonl


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small driver-made file, through Spark's file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def copy_payloads(rows: DataFrame, path_col: str, root: str, target: str) -> None:
    """Each file once into ``target``, from the executors; files that are there stay. ``root`` and ``target`` must be folders that all executors share."""

    def copy(part):
        for r in part:
            source, to = os.path.join(root, r["path"]), os.path.join(target, os.path.basename(r["path"]))
            if not os.path.exists(to):
                os.makedirs(target, exist_ok=True)
                half = f"{to}.{os.getpid()}.part"
                shutil.copyfile(source, half)
                os.replace(half, to)

    rows.select(F.col(path_col).alias("path")).where("path IS NOT NULL").distinct().foreachPartition(copy)


def card(metadata: DataFrame, cfg: Config) -> str:
    """Markdown with the dataset's figures; only aggregates are collected."""
    x = reports.card_figures(metadata).first()
    lines = [f"# {cfg.export.dataset_name}", "", "Synthetic speech with reviewed transcripts.", f"Language: {cfg.export.language}.", ""]
    lines += ["| Figure | Value |", "|-|-|", f"| Rate and format | {cfg.speech.output_sample_rate} Hz, 16 bit, one channel |", f"| Samples | {x['n_samples']} |", f"| Seconds of speech | {x['total_sec']:.3f} |", f"| Character error rate, mean | {x['mean_cer']:.4f} |", ""]
    for title, column in (("Voices", "voice_id"), ("Categories", "category")):
        counts = manifest.counted(metadata, column, "first_seq").orderBy("place").toLocalIterator()
        lines += [f"## {title}", "", *[f"- `{r[column]}`: {r['n']}" for r in counts], ""]
    lines += ["## Columns", "", *[f"- `{f.name}`: {f.dataType.simpleString()}" for f in DATASET.fields], "", "Paths in `audio` are relative to this folder.", ""]
    return "\n".join(lines)


def export(spark: SparkSession, cfg: Config, audio: DataFrame, quality: DataFrame, reviews: DataFrame, *, copy: bool = True, arrow: bool = False) -> str:
    """Write the dataset; returns its folder. Nothing to export is an error."""
    rows = curate.export_rows(curate.joined(audio, quality, reviews, cfg.export), cfg.export).cache()
    try:
        if rows.isEmpty():
            raise RuntimeError("no rows to export; were any samples reviewed?")
        final = cfg.path("final_dir")
        jsonl.overwrite(rows.orderBy("first_seq").drop("first_seq"), f"{final}/metadata")
        if cfg.export.format == "jsonl_only":
            write_text(spark, f"{final}/README.md", card(rows, cfg))
            return final
        folder = f"{final}/{cfg.export.dataset_name}"
        if copy:
            copy_payloads(rows, "audio_relpath", cfg.root, f"{folder}/audio")
        typed = curate.typed(rows)
        typed.write.mode("overwrite").parquet(f"{folder}/data")
        if arrow:
            write_arrow(typed, f"{folder}/data.arrow")
        write_text(spark, f"{final}/README.md", card(rows, cfg))
        return folder
    finally:
        rows.unpersist()


def write_arrow(df: DataFrame, path: str) -> None:
    """One Arrow file; partitions pass through the driver one at a time, as record batches, so it holds a partition at most."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, names = to_arrow_schema(df.schema), df.columns

    def rows():
        held = []
        for r in df.toLocalIterator():
            held.append(r)
            if len(held) == 10_000:
                yield held
                held = []
        yield held

    with pa.OSFile(path, "wb") as sink, pa.ipc.new_file(sink, schema) as writer:
        for part in rows():
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], schema.field(n).type) for i, n in enumerate(names)], schema=schema))


def load(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/data")


def verify(spark: SparkSession, folder: str) -> list[str]:
    """What is wrong with an export; empty if nothing is. All rows are checked."""
    df = load(spark, folder)
    bad = checks.schema_differences(df, DATASET)
    x = checks.path_report(df, "audio").first()
    bad += [f"{x[k]} of {x['n']} audio paths: {k[2:]}" for k in ("n_absolute", "n_outside", "n_null") if x[k]]
    bad += [f"row {r['id']}: {r['field']} holds a local path" for r in checks.first_leaks(df).collect()]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/audio").select(basename(F.col("path")).alias("path")) if jsonl.exists(spark, f"{folder}/audio") else spark.createDataFrame([], "path string")
    missing = checks.missing_files(df.withColumn("file", basename(F.col("audio"))), files, "file").count()
    return bad + ([f"{missing} audio files are missing"] if missing else [])


def write_sample(spark: SparkSession, sample: DataFrame, root: str, target: str) -> None:
    """A sample's metadata with dataset-relative paths, and its files."""
    copy_payloads(sample, "audio_relpath", root, f"{target}/audio")
    moved = sample.withColumn("audio_relpath", F.concat(F.lit("audio/"), basename(F.col("audio_relpath"))))
    jsonl.overwrite(moved, f"{target}/metadata")
