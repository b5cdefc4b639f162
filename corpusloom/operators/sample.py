"""Stratified sample: one row of each bucket in turn, buckets in order of first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def round_robin_sample(rows: DataFrame, by: list[str], size: int = 24, seq: str = "seq") -> DataFrame:
    """``size`` rows with ``place``. A row's rank in its bucket is at most ``size``, so the window drops all others before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(seq))
    ranked = rows.withColumn("__rank", rank).where(F.col("__rank") <= size)
    ranked = ranked.withColumn("__bucket", F.min(seq).over(W.partitionBy(*by)))
    # the top rows alone reach the window that numbers them
    top = ranked.orderBy("__rank", "__bucket").limit(size)
    return top.withColumn("place", F.row_number().over(W.orderBy("__rank", "__bucket"))).drop("__rank", "__bucket")
