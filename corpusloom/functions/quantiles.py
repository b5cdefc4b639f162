"""Order statistics as the reports define them, exact and without collecting a group's values.

Values are first counted by (group, value); a running sum of the counts finds the value at an
index. A group of a billion rows is a list of its distinct values (error rates are rounded to
three places), pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upper_median_index(n: Column) -> Column:
    return F.floor(n / 2)


def p90_index(n: Column) -> Column:
    return F.floor(n * F.lit(0.9)).cast("long")


def order_statistics(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group: n (not null), upper_median, median (interpolated), p90 (the value at index int(n * 0.9))."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    w = W.partitionBy(*keys)
    placed = counts.withColumn("upto", F.sum("c").over(w.orderBy("v"))).withColumn("n", F.sum("c").over(w))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("v")))
    lower = at(F.floor((F.col("n") - 1) / 2))
    return placed.groupBy(*keys).agg(
        F.first("n").alias("n"),
        at(upper_median_index(F.col("n"))).alias("upper_median"),
        ((lower + at(upper_median_index(F.col("n")))) / 2).alias("median"),
        at(p90_index(F.col("n"))).alias("p90"),
    )


def histogram(df: DataFrame, value: str, bins: int = 18) -> DataFrame:
    """bin (1 to bins), n, low, high: equal widths from the least to the greatest value, the last bin closed. The ends are scalar subqueries."""
    v = F.col(value)
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    rows = df.where(v.isNotNull()).select(v.alias("v"), low.alias("low"), high.alias("high"))
    one = F.least(F.floor((F.col("v") - F.col("low")) / ((F.col("high") - F.col("low")) / bins)) + 1, F.lit(bins))
    spread = F.when(F.col("high") > F.col("low"), one).otherwise(F.lit(1)).cast("int")
    return rows.groupBy(spread.alias("bin"), "low", "high").agg(F.count("*").alias("n")).select("bin", "n", "low", "high")
