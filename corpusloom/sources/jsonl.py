"""JSON Lines manifests: a folder (or file) of lines, append-only.

Blank lines are skipped, a malformed line is an error, a missing path is an empty table. Nulls are
written, text stays unescaped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.manifest import positions
from corpusloom.schemas import parse


def exists(spark: SparkSession, path: str) -> bool:
    """Through Spark's own file systems, so that any store it reads will do."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else parse(schema)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    schema = _schema(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def iterate(spark: SparkSession, path: str, schema):
    """Rows one at a time, a partition of them on the driver at most; here a missing path is an error."""
    return spark.read.schema(_schema(schema)).option("mode", "FAILFAST").json(path).toLocalIterator()


def read_in_order(spark: SparkSession, path: str, schema) -> DataFrame:
    """With ``seq`` from file, block and line, for logs that were not written with one. The place within a block is the reading task's running number."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*_schema(schema).fields, T.StructField("seq", T.LongType())]))
    rows = read(spark, path, schema).select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    blocks = rows.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__id").alias("__least"))
    # one row a block
    starts = blocks.select("__file", "__block", "__least", (F.sum("__n").over(W.orderBy("__file", "__block")) - F.col("__n")).alias("__start"))
    return rows.join(starts, ["__file", "__block"]).withColumn("seq", F.col("__start") + F.col("__id") - F.col("__least")).drop("__file", "__block", "__id", "__least", "__start")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def append_numbered(rows: DataFrame, path: str, schema, order: str | None = None) -> int:
    """Append with ``seq`` going on from the log's greatest; returns the first number given. ``order``: a numeric, unique column."""
    spark = rows.sparkSession
    top = read(spark, path, T.StructType([*_schema(schema).fields, T.StructField("seq", T.LongType())])).agg(F.max("seq").alias("m")).first()["m"]
    first = 0 if top is None else top + 1
    key = order or "__n"
    rows = rows if order else rows.withColumn("__n", F.monotonically_increasing_id())
    numbered = positions(rows, key, "seq").withColumn("seq", F.col("seq") + first)
    append(numbered.select(*[f.name for f in _schema(schema).fields], "seq"), path)
    return first


def overwrite(rows: DataFrame, path: str) -> None:
    """Written beside the old folder, then swapped, so a manifest can be rewritten from itself."""
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, old, at = (jvm.org.apache.hadoop.fs.Path(p) for p in (path + ".new", path + ".old", path))
    fs = at.getFileSystem(conf)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path + ".new")
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)
