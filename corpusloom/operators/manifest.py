"""Manifests as tables: latest entry per key, resume, append order.

``seq`` is the position in the log and unique; every manifest carries it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by(log: DataFrame, key: str = "id", seq: str = "seq", columns: Sequence[str] | None = None) -> DataFrame:
    """The last entry of each key, with ``first_seq``, the place of its first.

    An aggregate with partial sums, so a key with many entries is no hot spot. An entry travels as
    one value, which hides its columns from pruning: name those that are needed.
    """
    rest = [c for c in (log.columns if columns is None else columns) if c != key]
    kept = log.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("last"), F.min(seq).alias("first_seq"))
    return kept.select(key, *[F.col("last")[c].alias(c) for c in rest], "first_seq")


def pending(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``todo`` whose key is not among ``done``; ids need no distinct for an anti-join."""
    return todo.join(done.select(key), key, "left_anti")


def synthesis_pending(todo: DataFrame, audio: DataFrame) -> DataFrame:
    """Failed entries are tried again: only ok ones are done."""
    return pending(todo, audio.where("status = 'ok'"))


def quality_pending(audio: DataFrame, quality: DataFrame) -> DataFrame:
    """Any recorded entry is done, an error too."""
    return pending(audio.where("status = 'ok'"), quality)


def appended(log: DataFrame, new: DataFrame) -> DataFrame:
    return log.unionByName(new, allowMissingColumns=True)


def compacted(log: DataFrame) -> DataFrame:
    """Latest entry per id in first-seen order, notes cleared."""
    return latest_by(log).withColumn("note", F.lit(None).cast("string"))


def counted(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """key, n, place: most common first, ties by first appearance. The window holds one row a key."""
    n = df.groupBy(key).agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"))
    return n.select(key, "n", F.row_number().over(W.orderBy(F.col("n").desc(), "first_seq")).alias("place"))


def positions(df: DataFrame, key: str, name: str = "position") -> DataFrame:
    """``name``: the row's place (from 0) in the order of a numeric, unique key.

    Places are counted in ranges of the key, whose borders come from an approximate quantile, and
    the ranges' starts are running sums over one row a range: no task sorts the whole table.
    """
    spark = df.sparkSession
    n = min(4096, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"] or []
    borders = sorted({int(b) for b in borders})
    bucket = _bucket(F.col(key), borders)
    rows = df.withColumn("__bucket", bucket)
    starts = rows.groupBy("__bucket").agg(F.count("*").alias("__n"))
    starts = starts.select("__bucket", (F.sum("__n").over(W.orderBy("__bucket")) - F.col("__n")).alias("__start"))
    inside = F.row_number().over(W.partitionBy("__bucket").orderBy(key))
    return rows.withColumn("__r", inside).join(starts, "__bucket").withColumn(name, F.col("__start") + F.col("__r") - 1).drop("__bucket", "__r", "__start")


def _bucket(key: Column, borders: list[int]) -> Column:
    """How many borders lie below the key, found in two steps of about the root of their number."""
    if not borders:
        return F.lit(0)
    step = max(1, int(len(borders) ** 0.5))
    groups = [borders[i : i + step] for i in range(0, len(borders), step)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b < key))
    coarse = below(F.array(*[F.lit(g[-1]) for g in groups]))
    fine = below(F.coalesce(F.try_element_at(F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups]), coarse + 1), F.array().cast("array<bigint>")))
    return coarse * step + fine
