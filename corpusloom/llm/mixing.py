"""Mixing sources to target weights by systematic sampling.

Targets: sources share ``share`` times all sizes by weight, no source above ``most`` times its own
size, the excess reshared by weight until none is above. That is the level L with
sum(min(most * size, L * weight)) = share * total, found in closed form from running sums over one
row per source.

Sampling: a document of a source expects e = target / source size copies. Documents stand in a
fixed order; with P(i) = i * e + u, u one random offset of the source, document i is emitted
floor(P(i)) - floor(P(i - 1)) times, once per integer boundary crossed. The order runs from
large documents to small and back (every other document on the way down, the rest on the way
up), so the picks' errors on both slopes cancel and the words taken come near the target. Of
OFFSETS evenly spaced shifts of the random offset the one that comes nearest is taken; the sums
that tell are one row a source.

Positions are numbered in levels: counts by (source, size), their running sums, counts by salt
inside, and a row number inside (source, size, salt). A source with a third of all rows, or a
document with a million copies, is spread over SALTS groups.

Defined cases: a null text has size 0 and takes 0 words; a null source is a source of its own and
stands last; equal rows keep places of their own; an empty table gives an empty result; a source
of size 0 has target 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, row_key, unclashed, unit_interval, word_count

#: Hex digits of the id's hash that split equal sizes of one source: 16^2 salts.
SALT_DIGITS = 2
#: Shifts of a source's random offset that are compared.
OFFSETS = 16
WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows. The windows hold one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", "n_rows", weight.alias("weight"))
    by_ratio = W.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(W.unboundedPreceding, W.currentRow)
    everyone = W.partitionBy()
    level = (share * F.sum("source_size").over(everyone) - most * (F.sum("source_size").over(upto) - F.col("source_size"))) / (F.sum("weight").over(everyone) - F.sum("weight").over(upto) + F.col("weight"))
    per = per.withColumn("level", level)
    # the first source in order of ratio that stays below its cap fixes the level
    fits = F.col("level") * F.col("weight") <= most * F.col("source_size")
    per = per.withColumn("fixed", F.min(F.when(fits, F.struct((F.col("source_size") / F.col("weight")).alias("r"), F.col("source").isNull().alias("z"), F.col("source").alias("s"), F.col("level").alias("v")))).over(everyone)["v"])
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("fixed"), F.lit(float("inf"))) * F.col("weight"))
    return per.select("source", "source_size", "n_rows", target.cast("double").alias("target"))


def _crossed(pos: Column, e: Column, u: Column, most: float) -> Column:
    """Integer boundaries between the prefix sums before and behind a place."""
    return F.least(F.floor(pos * e + u) - F.floor((pos - 1) * e + u), F.lit(math.ceil(most))).cast("long")


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, n_copies, and the (narrow) columns named in ``keep``, which also order rows of one id."""
    key = ["src", "nosrc"]

    def sized(*more: str) -> DataFrame:
        salt = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, SALT_DIGITS)
        # nulls join under a flag and an empty name
        return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), salt.alias("salt"), F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("nosrc"), *more)

    small = cut(sized(*keep))  # a few numbers a document, so that texts are counted once and stay where they are
    cells = small.groupBy(*key, "size", "salt").agg(F.count("*").alias("n"))
    by_size = cells.groupBy(*key, "size").agg(F.sum("n").alias("n"))
    by_size = by_size.select(*key, "size", (F.sum("n").over(W.partitionBy(*key).orderBy(F.col("size").desc())) - F.col("n")).alias("larger"))
    inside = cells.withColumn("before", F.sum("n").over(W.partitionBy(*key, "size").orderBy("salt")) - F.col("n"))
    plan = targets(small.select("source", "size"), weights, share, most).select(
        F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("nosrc"), "source_size", "n_rows", "target",
        unit_interval(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("\0")))).alias("u"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("e"),
    )

    def placed(rows: DataFrame, facts: DataFrame) -> DataFrame:
        r = F.row_number().over(W.partitionBy(*key, "size", "salt").orderBy("doc_id", *keep))
        # facts of a source meet its distinct sizes first, so that no join deals many rows by source alone
        starts = inside.join(by_size.join(facts, key), [*key, "size"]).withColumn("start", F.col("larger") + F.col("before")).drop("n", "before", "larger")
        out = rows.withColumn("r", r).join(starts, [*key, "size", "salt"])
        i = F.col("start") + F.col("r")
        return out.withColumn("pos", F.floor(F.when(i % 2 == 1, (i + 1) / 2).otherwise(F.col("n_rows") - i / 2 + 1)).cast("double"))

    shifted = lambda k: F.col("u") + k / OFFSETS - F.when(F.col("u") + k / OFFSETS >= 1, 1.0).otherwise(0.0)
    sums = placed(small, plan).groupBy(*key).agg(*[F.sum(_crossed(F.col("pos"), F.col("e"), shifted(k), most) * F.col("size")).alias(f"t{k}") for k in range(OFFSETS)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("k")) for k in range(OFFSETS)]))["k"]
    fixed = plan.join(sums, key).withColumn("u", F.element_at(F.array(*[shifted(k) for k in range(OFFSETS)]), best + 1)).drop(*[f"t{k}" for k in range(OFFSETS)])
    out = placed(small, fixed)
    return out.select("doc_id", "source", "size", "source_size", "target", _crossed(F.col("pos"), F.col("e"), F.col("u"), most).alias("n_copies"), *keep)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken; all columns, whatever their names.

    Copies are numbered on narrow rows; whole rows meet their number once, by id, source and text. Rows that agree in
    all three share their copies evenly.
    """
    rows, restored = unclashed(docs, ("doc_id", "text", "source"))
    rows = rows.withColumn("tkey", row_key(F.col("text")))
    taken = copies(rows.select("doc_id", "source", "text", "tkey"), weights, share, most, seed, keep=["tkey"])
    taken = cut(taken.groupBy(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("tkey").alias("t_key")).agg(F.sum("n_copies").alias("n_copies"), F.count("*").alias("alike")).where("n_copies > 0"))
    on = F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("tkey") == F.col("t_key"))
    out = rows.join(taken.where("alike = 1"), on).withColumn("times", F.col("n_copies"))
    repeated = taken.where("alike > 1")
    if not repeated.isEmpty():
        place = F.row_number().over(W.partitionBy("t_id", "t_source", "t_key").orderBy("t_id"))
        out = out.union(rows.join(repeated, on).withColumn("times", F.floor(F.col("n_copies") / F.col("alike")) + (place <= F.col("n_copies") % F.col("alike")).cast("long")))
    return restored(out.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS salt
  FROM documents
),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM base GROUP BY source
),
lev AS (
  SELECT *, source_size / weight AS r,
    (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - 2.0::DOUBLE * (sum(source_size) OVER o - source_size)::DOUBLE)
      / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
  FROM per
  WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
fixed AS (
  SELECT arg_min(level, (r, source IS NULL, coalesce(source, ''))) AS v FROM lev WHERE level * weight <= 2.0::DOUBLE * source_size
),
plan AS (
  SELECT source, source_size, n_rows, least(2.0::DOUBLE * source_size, coalesce(v, 'inf'::DOUBLE) * weight) AS target,
         ('0x' || substr(md5('mix:' || coalesce(source, chr(0))), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM lev, fixed
),
placed AS (
  SELECT b.*, source_size, n_rows, target, u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e,
         row_number() OVER (PARTITION BY b.source ORDER BY size DESC, salt, doc_id NULLS FIRST) AS i
  FROM base b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source
),
pos AS (
  SELECT *, (CASE WHEN i % 2 = 1 THEN (i + 1) // 2 ELSE n_rows - i // 2 + 1 END)::DOUBLE AS p FROM placed
),
shifts AS (SELECT k, k / 16.0::DOUBLE AS s FROM (SELECT unnest(range(16)) AS k)),
sums AS (
  SELECT source, k, any_value(target) AS target,
    CASE WHEN any_value(u) + any_value(s) >= 1 THEN any_value(u) + any_value(s) - 1 ELSE any_value(u) + any_value(s) END AS v,
    sum(least(floor(p * e + CASE WHEN u + s >= 1 THEN u + s - 1 ELSE u + s END)::BIGINT - floor((p - 1) * e + CASE WHEN u + s >= 1 THEN u + s - 1 ELSE u + s END)::BIGINT, 2) * size)::BIGINT AS t
  FROM pos, shifts GROUP BY source, k
),
fixed_u AS (SELECT source, arg_min(v, (abs(t - target), k)) AS v FROM sums GROUP BY source)
SELECT doc_id, size, source_size, target,
       (least(floor(p * e + v)::BIGINT - floor((p - 1) * e + v)::BIGINT, 2) * size)::BIGINT AS taken
FROM pos JOIN fixed_u f ON pos.source IS NOT DISTINCT FROM f.source
"""
