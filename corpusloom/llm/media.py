"""Media columns: payloads in content-defined chunks.

Store: a text's UTF-8 bytes, padded with spaces, are the 8-bit samples of its payload. A rolling
gear hash (window of 32 bytes) cuts the payload; a chunk's name is its SHA-256. Chunks are stored
once each, as zstd frames, deduplicated inside a task and then by name. A payload is kept as an
ordered list of chunk names.

Read back: the lists meet the store in a join on the chunk name; every frame is decompressed and
held against its name, every payload against its own digest, and a mismatch or a missing chunk is
an error. Features are computed from the bytes that were read back.

Documents are taken in blocks (at most BLOCK_DOCS or BLOCK_BYTES, or one longer document), and
equal payloads of a block share one list, so a text with many copies is one row a block in the
join, not a row a document. Payloads of one chunk are finished at the join; only chunks of longer
ones are shuffled again, sorted by payload and place, and assembled one payload at a time.

Stored form: magic, sample count, chunk count, (name, length) of each chunk, then the frames.

Defined cases: a null text counts as empty, and an empty one is padded to one unit; null ids and
repeated rows stay as they are; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import shuffle_partitions

UNIT = 192
WINDOW, MASK_BITS, SHORTEST, LONGEST = 32, 13, 2048, 65536
BLOCK_DOCS, BLOCK_BYTES = 2048, 8_000_000
LEVEL = 6
#: Chunk names a task remembers having stored.
SEEN = 500_000
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def payload_of(text: str) -> tuple[int, bytes]:
    """The text's bytes before padding, and the padded payload."""
    raw = text.encode()
    return len(raw), raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" ")


def cuts(payload: bytes) -> list[int]:
    """Ends of the chunks. The hash of the last 32 bytes is built by doubling the window."""
    n = len(payload)
    if n <= SHORTEST:
        return [n]
    h = GEAR[np.frombuffer(payload, np.uint8)]
    width = 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint32(width)
        h, width = longer, 2 * width
    marks = np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1
    ends, start = [], 0
    while start < n:
        if n - start <= SHORTEST:
            end = n
        else:
            k = np.searchsorted(marks, start + SHORTEST)
            end = min(n, start + LONGEST, int(marks[k]) if k < len(marks) else n)
        ends.append(end)
        start = end
    return ends


def features(payload: bytes) -> str:
    """Sums over the samples around the middle of their range."""
    s = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"sum={int(s.sum())};energy={int((s * s).sum())};crossings={int(np.count_nonzero((s[1:] < -28) != (s[:-1] < -28)))};peak={int(np.abs(s).max())}"


def _blocks(batches) -> Iterator[tuple[int, dict[bytes, list]]]:
    """Block number and its distinct payloads with (doc_id, n_bytes) of each."""
    from pyspark import TaskContext

    number, held, docs, size = TaskContext.get().partitionId() << 32, {}, 0, 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            n, payload = payload_of(text.as_py() or "")
            held.setdefault(payload, []).append((doc_id, n))
            docs, size = docs + 1, size + len(payload)
            if docs >= BLOCK_DOCS or size >= BLOCK_BYTES:
                yield number, held
                number, held, docs, size = number + 1, {}, 0, 0
    if held:
        yield number, held


def _store(batches):
    pack, seen = zstandard.ZstdCompressor(level=LEVEL), set()
    for _, held in _blocks(batches):
        names, frames = [], []
        for payload in held:
            start = 0
            for end in cuts(payload):
                chunk, start = payload[start:end], end
                name = hashlib.sha256(chunk).digest()
                if name not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    names.append(name)
                    frames.append(pack.compress(chunk))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(frames, pa.binary())], ["name", "frame"])


def _lists(batches):
    for number, held in _blocks(batches):
        rows = []
        for k, (payload, docs) in enumerate(held.items()):
            ends, start = cuts(payload), 0
            for place, end in enumerate(ends):
                head = pickle.dumps((hashlib.sha256(payload).digest(), docs)) if place == 0 else None
                rows.append((hashlib.sha256(payload[start:end]).digest(), number, k, place, len(ends), head))
                start = end
        types = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["name", "block", "k", "place", "n_chunks", "head"])


RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_NAMES = [c.split(" ")[0] for c in RESULT.split(", ")]


def open_frame(name: bytes, frame: bytes | None) -> bytes:
    if frame is None:
        raise ValueError(f"chunk {name.hex()} is missing")
    chunk = zstandard.ZstdDecompressor().decompress(frame, max_output_size=LONGEST)
    if hashlib.sha256(chunk).digest() != name:
        raise ValueError(f"chunk {name.hex()} is damaged")
    return chunk


def _finish(head: bytes, parts: list[tuple[bytes, bytes, bytes]]) -> list[tuple]:
    """Result rows of one payload; parts: (name, frame, chunk) in order."""
    expected, docs = pickle.loads(head)
    payload = b"".join(c for _, _, c in parts)
    digest = hashlib.sha256(payload).digest()
    if digest != expected:
        raise ValueError(f"payload {expected.hex()} was not read back")
    stored = b"CDC1" + struct.pack("<QI", len(payload), len(parts)) + b"".join(n + struct.pack("<I", len(c)) for n, _, c in parts) + b"".join(f for _, f, _ in parts)
    own = (len(payload), digest.hex(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), features(payload))
    return [(doc_id, n, *own) for doc_id, n in docs]


def _at_join(batches):
    """Payloads of one chunk are done; chunks of others go on with their frames. ``body``: pickled result rows or the frame."""
    for batch in batches:
        name, block, k, place, n_chunks, head, frame = (batch.column(i) for i in range(7))
        out = []
        for i, n in enumerate(n_chunks.to_pylist()):
            x, f, h = name[i].as_py(), frame[i].as_py(), head[i].as_py()
            chunk = open_frame(x, f)
            out.append((pickle.dumps(_finish(h, [(x, f, chunk)])), None, None) if n == 1 else (f, x, h))
        columns = [block, k, place, n_chunks, *(pa.array(c, pa.binary()) for c in zip(*out, strict=True))] if out else None
        if columns:
            yield pa.RecordBatch.from_arrays(columns, ["block", "k", "place", "n_chunks", "body", "name", "head"])


def _assemble(batches):
    """Rows come sorted by payload and place."""
    parts, head = [], None
    for batch in batches:
        rows = []
        for i, (place, n) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            body = batch.column(4)[i].as_py()
            if n == 1:
                rows += pickle.loads(body)
                continue
            name = batch.column(5)[i].as_py()
            if place != len(parts):
                raise ValueError("a chunk is missing or out of order")
            head = batch.column(6)[i].as_py() if place == 0 else head
            parts.append((name, body, open_frame(name, body)))
            if len(parts) == n:
                rows += _finish(head, parts)
                parts, head = [], None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)
    if parts:
        raise ValueError("the last payload is incomplete")


def chunk_store(docs: DataFrame) -> DataFrame:
    """name, frame: every distinct chunk once."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(_store, "name binary, frame binary").groupBy("name").agg(F.first("frame").alias("frame"))


def chunk_lists(docs: DataFrame) -> DataFrame:
    """name, block, k, place, n_chunks, head: the ordered chunk lists; head holds the payload's digest and documents."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(_lists, "name binary, block long, k int, place int, n_chunks int, head binary")


def read_back(lists: DataFrame, store: DataFrame) -> DataFrame:
    """Payloads rebuilt from the store and verified, with their features, a row a document."""
    n = shuffle_partitions(lists.sparkSession)
    met = lists.join(store, "name", "left").select("name", "block", "k", "place", "n_chunks", "head", "frame")
    parts = met.mapInArrow(_at_join, "block long, k int, place int, n_chunks int, body binary, name binary, head binary")
    return parts.repartition(n, "block", "k").sortWithinPartitions("block", "k", "place").mapInArrow(_assemble, RESULT)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_back(chunk_lists(docs), chunk_store(docs))
