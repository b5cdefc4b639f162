"""Token counts without token ids.

1. Documents are cut into pre-tokens, block by block (at most BLOCK_DOCS documents or BLOCK_CHARS
   code points, or one longer document). A block becomes one row a bucket of pre-tokens: the
   block's distinct pre-tokens of that bucket and, for each, the documents and frequencies.
2. Shuffled by bucket, each distinct pre-token meets its piece count, which the tokenizer library
   gives once; count times frequency, summed by document, leaves as one short row.
3. Shuffled by block, the buckets' sums add up to each document's tokens.

A pre-token that every document holds is one entry a block, never a row a document, so no key is
hot. Memory is bounded by one block and by CACHE piece counts; nothing reaches the driver.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); an added special token's string in
a text is one token, as the library has it by default; null ids and repeated rows stay as they
are; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import shuffle_partitions
from corpusloom.llm.pretokens import Splitter

BLOCK_DOCS, BLOCK_CHARS = 2048, 5_000_000
#: Piece counts that a task keeps; fewer than a bucket's pre-tokens only cost recounting.
CACHE = 300_000

_splitters: dict[str, Splitter] = {}
_libraries: dict[str, object] = {}


def _pack(x) -> bytes:
    return zlib.compress(pickle.dumps(x, protocol=5), 1)


def _unpack(x: bytes):
    return pickle.loads(zlib.decompress(x))


def _narrow(a: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


class _Block:
    def __init__(self):
        self.ids, self.bytes, self.special, self.chars = [], [], [], 0
        self.index: dict[str, int] = {}
        self.token, self.doc, self.freq = [], [], []

    def add(self, doc_id, text: str, splitter: Splitter) -> None:
        special, freq = 0, Counter()
        for segment, is_special in splitter.segments(text):
            if is_special:
                special += 1
            else:
                freq.update(splitter.pieces(segment))
        index = self.index
        self.token.append(np.fromiter((index.setdefault(p, len(index)) for p in freq), np.uint32, len(freq)))
        self.freq.append(np.fromiter(freq.values(), np.uint32, len(freq)))
        self.doc.append(np.full(len(freq), len(self.ids), np.uint32))
        self.ids.append(doc_id)
        self.bytes.append(len(text.encode()))
        self.special.append(special)
        self.chars += len(text)

    def rows(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """(bucket, body): a row of documents first, then a row for each bucket that has pre-tokens."""
        yield zlib.crc32(str(self.ids[0]).encode()) % buckets, _pack(("docs", self.ids, np.array(self.bytes, np.int64), np.array(self.special, np.int64)))
        names = [p.encode() for p in self.index]
        if not names:
            return
        home = np.fromiter((zlib.crc32(n) % buckets for n in names), np.uint32, len(names))
        token = np.concatenate(self.token)
        order = np.lexsort((token, home[token]))
        token, doc, freq = token[order], np.concatenate(self.doc)[order], np.concatenate(self.freq)[order]
        cuts = np.flatnonzero(np.diff(home[token], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine, times = np.unique(token[a:b], return_counts=True)
            words = [names[k] for k in mine]
            yield int(home[token[a]]), _pack(("pairs", _narrow(np.array([len(w) for w in words])), b"".join(words), _narrow(times), _narrow(doc[a:b]), _narrow(freq[a:b])))


def _cut(path: str, buckets: int):
    def run(batches):
        from pyspark import TaskContext

        if path not in _splitters:
            _splitters[path] = Splitter(path)
        splitter, block, number = _splitters[path], _Block(), TaskContext.get().partitionId() << 32

        def flush():
            nonlocal block, number
            rows = list(block.rows(buckets))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "block", "body"])
            block, number = _Block(), number + 1

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, text.as_py() or "", splitter)
                if len(block.ids) >= BLOCK_DOCS or block.chars >= BLOCK_CHARS:
                    yield from flush()
        if block.ids:
            yield from flush()

    return run


def _count(path: str):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would each keep memory
        from tokenizers import Tokenizer

        if path not in _libraries:
            _libraries[path] = Tokenizer.from_file(path)
        library, known = _libraries[path], {}
        for batch in batches:
            for block, body in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                kind, *parts = _unpack(body.as_py())
                if kind == "pairs":
                    sizes, words, times, doc, freq = parts
                    ends = np.cumsum(sizes, dtype=np.int64).tolist()
                    names = [words[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                    if len(known) > CACHE:
                        known.clear()
                    new = [n for n in names if n not in known]
                    known.update(zip(new, (len(e.ids) for e in library.encode_batch([n.decode() for n in new], add_special_tokens=False)), strict=True))
                    pieces = np.repeat(np.fromiter((known[n] for n in names), np.int64, len(names)), times)
                    total = np.bincount(doc, weights=pieces * freq.astype(np.int64)).astype(np.int64)
                    at = np.flatnonzero(total)
                    parts = [_narrow(at), _narrow(total[at])]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([_pack((kind, *parts))], pa.binary())], ["block", "body"])

    return run


def _add_up(batches):
    """Rows come sorted by block."""
    at, docs, sums = None, None, []

    def done():
        ids, sizes, total = docs
        for where, n in sums:
            total[where] += n.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for block, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if block != at:
                if at is not None:
                    yield from done()
                at, docs, sums = block, None, []
            kind, *parts = _unpack(body.as_py())
            if kind == "docs":
                docs = parts
            else:
                sums.append(parts)
    if at is not None:
        yield from done()


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens for each row of doc_id, text."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(_cut(path, n), "bucket int, block long, body binary")
    sums = rows.repartitionById(n, "bucket").mapInArrow(_count(path), "block long, body binary")
    return sums.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")


def op1(spark, sf_dir: str) -> DataFrame:
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
