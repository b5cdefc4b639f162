"""Checks of an exported dataset: paths, schema, files. All rows are checked, in aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.display import is_absolute

# Prefixes that give a local absolute path away.
LEAKS = ("C:", "c:", "/Users/")


def leaked_paths(df: DataFrame, id_col: str = "id", prefixes: tuple[str, ...] = LEAKS) -> DataFrame:
    """id, field, value of every string that starts like a local path."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in names])
    bad = F.lit(False)
    for p in prefixes:
        bad = bad | F.startswith(F.col("p.value"), F.lit(p))
    return df.select(F.col(id_col).alias("id"), F.explode(pairs).alias("p")).where(bad).select("id", "p.field", "p.value")


def first_leaks(df: DataFrame, n: int = 3, id_col: str = "id", prefixes: tuple[str, ...] = LEAKS) -> DataFrame:
    """The first ``n`` of them, by id and field, for a message."""
    return leaked_paths(df, id_col, prefixes).orderBy("id", "field").limit(n)


def path_report(df: DataFrame, path_col: str, prefix: str = "audio/") -> DataFrame:
    """n, n_absolute, n_outside, n_null of a path column."""
    p = F.col(path_col)
    return df.agg(F.count("*").alias("n"), F.count_if(is_absolute(p)).alias("n_absolute"), F.count_if(~is_absolute(p) & ~F.startswith(p, F.lit(prefix))).alias("n_outside"), F.count_if(p.isNull()).alias("n_null"))


def missing_files(df: DataFrame, files: DataFrame, path_col: str = "audio_path") -> DataFrame:
    """Rows whose file is not among ``files`` (column path)."""
    return df.join(files.select(F.col("path").alias(path_col)), path_col, "left_anti")


def schema_rows(df: DataFrame) -> DataFrame:
    """name, type of every column."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "name string, type string")


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    have, want = {f.name: f.dataType.simpleString() for f in df.schema.fields}, {f.name: f.dataType.simpleString() for f in expected.fields}
    return [f"{n}: {have.get(n, 'missing')} for {want.get(n, 'nothing')}" for n in sorted({*have, *want}) if have.get(n) != want.get(n)]
