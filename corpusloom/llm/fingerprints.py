"""Document fingerprints: a homomorphic multiset hash.

A text is a multiset of paragraphs (lines, cut further behind sentence ends). Each paragraph is
hashed to a wide vector: a one for the count, WIDE dense lanes modulo 2^32, and for each of LEVELS
levels one of LANES lanes modulo 2^8, where level l takes a paragraph with chance 4^-l. The
fingerprint is the sum of the vectors, each lane modulo its power of two. So it does not depend on
the order, equal multisets have equal sums, and paragraphs are inserted or deleted by adding or
subtracting their vectors (``combine``).

Likeness of two fingerprints: the share of equal lanes of a level tells how many paragraphs differ
(each leaves all but one lane of its level as it is); the number is the most likely one over all
levels, at least the difference of the counts. The last level is not saturated before 2^32
paragraphs, which is where the count ends. 1 - difference / (sum of both counts), within 0 and 1;
equal fingerprints have 1. It is an estimate: its error was measured, see the README.

The neighbour in descending id order: ranges of ids (borders from an approximate quantile of the
id column alone) are buckets; the first document of each bucket is also sent to the bucket before
it as a look-ahead. One shuffle of the texts; each task streams its sorted buckets and holds two
texts.

Defined cases: a null text counts as empty; a paragraph of white space alone is none; null ids
stand last; rows of one id are ordered by their text's hash; a single document is its own
neighbour; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import row_key, shuffle_partitions

WIDE, LEVELS, LANES = 8, 14, 64
SIZE = 4 + 4 * WIDE + LEVELS * LANES
_CUT = re.compile(r"\n|(?<=[.!?])[ \t]")
_DIGEST = 4 * WIDE + 4 + 2 * LEVELS


def paragraphs(text: str) -> list[bytes]:
    return [p.encode() for p in (x.strip() for x in _CUT.split(text)) if p]


def digests(text: str, known: dict[bytes, bytes] | None = None) -> bytes:
    """The paragraphs' hashes, one behind the other."""
    known = {} if known is None else known
    out = []
    for p in paragraphs(text):
        d = known.get(p)
        if d is None:
            d = known[p] = hashlib.blake2b(p, digest_size=_DIGEST).digest()
        out.append(d)
    return b"".join(out)


def total(hashes: bytes) -> bytes:
    """The sum of the vectors that the hashes stand for."""
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, _DIGEST)
    dense = np.ascontiguousarray(rows[:, : 4 * WIDE]).view("<u4").sum(axis=0, dtype=np.uint32)
    chance = np.ascontiguousarray(rows[:, 4 * WIDE : 4 * WIDE + 4]).view("<u4")[:, 0]
    tail = rows[:, 4 * WIDE + 4 :]
    lanes = np.zeros((LEVELS, LANES), np.int64)
    for level in range(LEVELS):
        if level:
            taken = chance < (2**32 >> (2 * level))
            chance, tail = chance[taken], tail[taken]
        if not len(tail):
            break
        lanes[level] = np.bincount(tail[:, 2 * level] % LANES, weights=tail[:, 2 * level + 1] | 1, minlength=LANES).astype(np.int64)
    return np.uint32(len(rows)).tobytes() + dense.tobytes() + (lanes % 256).astype(np.uint8).tobytes()


def fingerprint(text: str) -> bytes:
    return total(digests(text))


def combine(a: bytes, b: bytes, sign: int = 1) -> bytes:
    """The fingerprint of both multisets together (sign 1), or of a without b (sign -1)."""
    head = 4 + 4 * WIDE
    x, y = np.frombuffer(a[:head], "<u4").astype(np.int64), np.frombuffer(b[:head], "<u4").astype(np.int64)
    u, v = np.frombuffer(a[head:], np.uint8).astype(np.int64), np.frombuffer(b[head:], np.uint8).astype(np.int64)
    return ((x + sign * y) % 2**32).astype("<u4").tobytes() + ((u + sign * v) % 256).astype(np.uint8).tobytes()


#: Numbers of differing paragraphs, and the logarithms of a lane's chances at each level to be equal (untouched, or
#: touched with sums that agree by chance: parities often do, the rest once in 128) or not.
_DIFFER = np.unique(np.concatenate([np.arange(1, 65), np.round(64 * 1.015 ** np.arange(1, 1260))]))
_TOUCHED = -np.expm1(_DIFFER[:, None] * np.log1p(-(4.0 ** -np.arange(LEVELS)) / LANES))
_EQUAL, _OTHER = np.log(1 - _TOUCHED * 127 / 128), np.log(_TOUCHED * 127 / 128)


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    n1, n2 = int(np.frombuffer(a[:4], "<u4")[0]), int(np.frombuffer(b[:4], "<u4")[0])
    head = 4 + 4 * WIDE
    same = (np.frombuffer(a[head:], np.uint8) == np.frombuffer(b[head:], np.uint8)).reshape(LEVELS, LANES).sum(axis=1)
    differ = max(float(_DIFFER[(_EQUAL @ same + _OTHER @ (LANES - same)).argmax()]), abs(n1 - n2))
    return min(1.0, max(0.0, 1.0 - differ / max(n1 + n2, 1)))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k] if k else text


def _row(text: str, prints: bytes, hashes: dict, following: str, next_prints: bytes) -> tuple:
    other = edited(text, following)
    changed = total(digests(other, hashes)) if other != text else prints
    return len(text), hashlib.sha256(other.encode()).hexdigest(), prints.hex(), changed.hex(), likeness(prints, changed), likeness(prints, next_prints)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, in order inside it, a look-ahead row at the bucket's end."""
    held = None  # bucket, id, text, fingerprint, hashes, is_ahead
    for batch in batches:
        out = []
        for bucket, ahead, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            text, hashes = text.as_py() or "", {}
            prints = total(digests(text, hashes))
            if held and held[0] == bucket and not held[5]:
                out.append((held[1], *_row(held[2], held[3], held[4], text, prints)))
            held = (bucket, doc_id, text, prints, hashes, ahead)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every document with its edited text and its neighbour in descending id order."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("tkey"), F.col("text").alias("text"))
    # a border and a first document for each partition reach the driver
    borders = np.unique(np.array(rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first()["q"] or [], np.int64)) if n > 1 else np.zeros(0, np.int64)

    @F.pandas_udf("int")
    def bucket_of(doc_id: pd.Series) -> pd.Series:
        """0 holds the largest ids; nulls have a bucket of their own at the end."""
        none = doc_id.isna().to_numpy()
        at = np.searchsorted(borders, doc_id.fillna(0).astype("int64").to_numpy())
        return pd.Series(np.where(none, len(borders) + 1, len(borders) - at), dtype="int32")

    keyed = rows.withColumn("bucket", bucket_of("doc_id"))
    heads = keyed.groupBy("bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("i"), "tkey")).alias("h")).select("bucket", (-F.col("h.i")).alias("i"), "h.tkey").collect()
    used = sorted(r["bucket"] for r in heads)
    before = {b: used[k - 1] for k, b in enumerate(used)}  # of the first bucket: the last
    marks = docs.sparkSession.createDataFrame([(r["i"], r["tkey"], before[r["bucket"]]) for r in heads], "m_id long, m_tkey long, bucket int")
    ahead = rows.join(F.broadcast(marks), (F.col("tkey") == F.col("m_tkey")) & F.col("doc_id").eqNullSafe(F.col("m_id"))).select("bucket", F.lit(True).alias("ahead"), "doc_id", "tkey", "text")
    every = keyed.select("bucket", F.lit(False).alias("ahead"), "doc_id", "tkey", "text").unionByName(ahead)
    order = ["bucket", "ahead", F.col("doc_id").desc_nulls_last(), "tkey"]
    return every.repartitionById(n, F.least("bucket", F.lit(n - 1))).sortWithinPartitions(*order).select("bucket", "ahead", "doc_id", "text").mapInArrow(_stream, SCHEMA)


def op7(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
