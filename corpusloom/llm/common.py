"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of code points other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def unit_interval(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of a string, in steps of 2^-20."""
    return F.conv(F.substring(F.md5(key), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)


def row_key(text: Column) -> Column:
    """Tells rows with the same id but other texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The shared folder that the session names; one of our own only where it names none and all runs on this machine, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: lineage ends here and lost executors cost nothing before it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unclashed(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The rows with every column but those in ``keep`` renamed, so that none meets a name of ours; and the way back, with ``text`` replaced if given."""
    own = [c if c in keep else f"c{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*own), lambda df, text=None: df.select(*[(text if c == "text" and text is not None else F.col(c)).alias(name) for c, name in zip(own, docs.columns, strict=True)])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Word hashes that a worker process keeps while a task runs.
WORD_CACHE = 50_000
_word: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    if len(_word) > WORD_CACHE:
        _word.clear()
    return np.fromiter((_word.get(w) or _word.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))


def other_word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words by a function of another family, so that what agrees in both agrees by chance in 2^-128."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def release() -> None:
    """Give back what a worker process holds beyond its task: word hashes, Arrow's pool, free heap pages."""
    _word.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library has no such call
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which the worker process, which lives on, is as small as it can be."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
