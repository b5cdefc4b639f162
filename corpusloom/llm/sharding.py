"""Sharding by rendezvous hashing.

Every (record key, shard) pair gets a hash; a record goes to the shard whose hash, adjusted by
the shard's weight, wins. A shard that is added can only win records for itself, so growing from
n to n + 1 shards moves about 1 / (n + 1) of the records and none between old shards. The choice
is a projection (no shuffle). Slots are numbered in two levels: counts by (shard, bucket), their
running sums (at most BUCKETS rows a shard), and a row number inside each (shard, bucket); so no
task holds a whole shard.

Defined cases: a null key counts as the empty string; equal keys share a shard; a null text has
size ``overhead`` and the CRC of no bytes; repeated rows get slots of their own; an empty table
gives an empty result; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, text_crc32

#: Hex digits of the key's hash that make a bucket for numbering slots: 16^3 buckets.
BUCKET_DIGITS = 3


def _ranked(key: Column, s: int) -> Column:
    """A shard's hash for a key, its number behind it."""
    return F.concat(F.substring(F.md5(F.concat(F.coalesce(key, F.lit("")), F.lit(f":{s}"))), 1, 13), F.lit(f"{s:06d}"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard. Equal weights compare raw hashes; others compare -ln(u) / w."""
    key = F.coalesce(key, F.lit(""))
    if len(weights) == 1:
        return F.lit(0)
    if len(set(weights)) == 1:
        return F.substring(F.greatest(*[_ranked(key, s) for s in range(len(weights))]), 14, 6).cast("int")
    unit = [(F.conv(F.substring(_ranked(key, s), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13) for s in range(len(weights))]
    return F.array_min(F.array(*[F.struct((-F.log(u) / float(w)).alias("score"), F.lit(s).alias("shard")) for s, (u, w) in enumerate(zip(unit, weights, strict=True))]))["shard"]


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * 24, *, grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """id, size, text_crc32, shard, slot, grown_shard (with one more shard: ``grown``, else the last weight repeated)."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    grown = list(grown or [*weights, weights[-1]])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + overhead).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
        F.substring(F.md5(key), 1, BUCKET_DIGITS).alias("bucket"),
    )
    if len(weights) > 1 and len({*weights, *grown}) == 1 and len(grown) == len(weights) + 1:
        # one hash a shard: the winner of all but the new one, then the winner against the new one
        rows = rows.withColumn("top", F.greatest(*[_ranked(key, s) for s in range(len(weights))]))
        rows = rows.withColumn("shard", F.substring("top", 14, 6).cast("int")).withColumn("grown_shard", F.when(_ranked(key, len(weights)) > F.col("top"), F.lit(len(weights))).otherwise(F.col("shard"))).drop("top")
    else:
        rows = rows.withColumn("shard", rendezvous(key, weights)).withColumn("grown_shard", rendezvous(key, grown))
    rows = cut(rows)  # a few numbers a row, so that texts are read and keys are hashed once
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("r", F.row_number().over(inside))
        .join(before, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("r") - 1).cast("long").alias("slot"), "grown_shard")
    )


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _winner(n: int) -> str:
    return "substr(greatest(" + ", ".join(f"substr(md5(k || ':{s}'), 1, 13) || '{s:06d}'" for s in range(n)) + "), 14, 6)::INT"


#: The CRC is folded over the bytes with a table that is made from the polynomial.
OP10_SQL = f"""
WITH RECURSIVE bits(b, c, i) AS (
  SELECT b, b, 0 FROM (SELECT unnest(range(256))::BIGINT AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8
),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
texts AS (
  SELECT DISTINCT coalesce(text, '') AS text FROM documents
),
hexes AS (SELECT text, hex(encode(text)) AS h FROM texts),
crcs AS (
  SELECT text, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295::BIGINT) AS crc
  FROM hexes, tab
),
base AS (
  SELECT doc_id, strlen(coalesce(d.text, ''))::BIGINT + 8 AS size, crc AS text_crc32, coalesce(doc_id::VARCHAR, '') AS k
  FROM documents d JOIN crcs c ON c.text = coalesce(d.text, '')
),
placed AS (SELECT *, {_winner(24)} AS shard, {_winner(25)} AS grown_shard, substr(md5(k), 1, {BUCKET_DIGITS}) AS bucket FROM base)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
       grown_shard
FROM placed
"""
