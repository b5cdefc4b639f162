"""Byte-level BPE encoding by backtracking, and decoding through an offset table.

Encoding a pre-token: an Aho-Corasick automaton over all tokens gives the longest token at every
position in one pass. From the left, the longest token is tried; it stands if the position behind
it is not known to be a dead end and if it is compatible with the token before it: no merge of
lower rank would have joined across their border. Else the next shorter prefix token is tried,
and where none is left the last token is taken back and its end marked dead. Each position is
marked once, so the work is linear; the result is exactly what applying the merges by rank gives.

Decoding: all tokens' bytes lie in one buffer; ids select ranges of it through an offset table.

Whole texts are encoded in ``mapInArrow``; a bounded cache holds recent pre-tokens.

Defined cases: a null text is encoded as the empty text (no ids); an added special token's string
inside a text becomes its id, as the library does by default; other columns are not read; equal
rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean
from corpusloom.llm.pretokens import Splitter

#: Pre-tokens in each of a worker's two cache generations, the longest that is kept, and pairs in the compatibility table.
CACHE, CACHE_CHARS, PAIRS = 100_000, 64, 150_000


def byte_chars() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes: printable Latin-1 ones stand for themselves, the others follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    """Tokens are numbered by rank: the 256 bytes, then the merges in order. ``ids`` maps ranks to vocabulary ids."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("not a plain byte-level BPE file")
        to_byte, vocab = byte_chars(), model["vocab"]
        names = sorted(to_byte, key=to_byte.get)
        rank = {c: k for k, c in enumerate(names)}
        self.halves: list[tuple[int, int]] = [(k, k) for k in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            names.append(a + b)
            if rank.setdefault(a + b, len(names) - 1) != len(names) - 1:
                raise ValueError("two merges make one token")
            self.halves.append((rank[a], rank[b]))
            self.pairs[rank[a], rank[b]] = len(names) - 1
        self.texts = ["".join(chr(to_byte[c]) for c in n) for n in names]
        self.lengths = [len(t) for t in self.texts]
        self.ids = [vocab[n] for n in names]
        known = {t: k for k, t in enumerate(self.texts)}
        self.shorter = [next((known[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1) for t in self.texts]
        self.automaton = ahocorasick.Automaton()
        for k, t in enumerate(self.texts):
            self.automaton.add_word(t, k)
        self.automaton.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side: a table filled on demand."""
        found = self._compatible.get((left, right))
        if found is None:
            if len(self._compatible) >= PAIRS:
                self._compatible.clear()
            found = self._compatible[left, right] = self._border_holds(left, right)
        return found

    def _border_holds(self, left: int, right: int) -> bool:
        """Undo the later of the two tokens' merges step by step; the border breaks if the parts that face each other merge before the merge that is undone next."""
        bound = len(self.halves)
        while True:
            joined = self.pairs.get((left, right))
            if joined is not None and joined < bound:
                return False
            undo_left = left > right
            if undo_left and left < 256 or not undo_left and right < 256:
                undo_left = not undo_left
                if (left if undo_left else right) < 256:
                    return True
            if undo_left:
                # a merge inside the left part comes before one across the border at the same rank
                bound, left = left, self.halves[left][1]
            else:
                bound, right = right + 1, self.halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Vocabulary ids of one pre-token."""
        text = piece.decode("latin-1")
        n, lengths, shorter, compatible = len(text), self.lengths, self.shorter, self.compatible
        longest = [-1] * (n + 1)
        for end, k in self.automaton.iter(text):
            longest[end - lengths[k] + 1] = k
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        pos, k = 0, longest[0]
        while k >= 0:
            end = pos + lengths[k]
            if alive[end] and (not out or compatible(out[-1], k)):
                out.append(k)
                pos, k = end, longest[end]
            elif shorter[k] >= 0:
                k = shorter[k]
            else:
                alive[pos] = 0
                k = out.pop()
                pos -= lengths[k]
        return [self.ids[k] for k in out]


class Codec:
    """Texts to ids and back."""

    def __init__(self, path: str):
        self.splitter, self.bpe = Splitter(path), Bpe(path)
        table = dict(zip(self.bpe.ids, (t.encode("latin-1") for t in self.bpe.texts), strict=True)) | {i: s.encode() for s, i in self.splitter.special_ids.items()}
        parts = [table.get(i, b"") for i in range(max(table) + 1)]
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        cache = self._cache
        for segment, special in self.splitter.segments(text):
            if special:
                ids.append(self.splitter.special_ids[segment])
                continue
            for piece in self.splitter.pieces(segment):
                found = cache.get(piece)
                if found is None:
                    found = self._older.get(piece) or tuple(self.bpe.encode_piece(piece.encode()))
                    if len(piece) <= CACHE_CHARS:
                        if len(cache) >= CACHE:
                            self._older, self._cache = cache, {}
                            cache = self._cache
                        cache[piece] = found
                ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        at = np.asarray(ids, np.int64)
        if not len(at):
            return ""
        starts, sizes = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.buffer[index].tobytes().decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a worker process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoded(path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        names = [str(i) for i in range(len(c.offsets))]
        for batch in batches:
            ids_out, n_out, a_out, b_out = [], [], [], []
            for text in batch.column(1):
                ids = c.encode(text.as_py() or "")
                n_out.append(len(ids))
                if digest:
                    a_out.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                    b_out.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
                else:
                    ids_out.append(np.asarray(ids, np.int32))
            if digest:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_out, pa.int64()), pa.array(a_out, pa.string()), pa.array(b_out, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_out, pa.int64()), pa.array(ids_out, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])

    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(lean(_encoded(path or default_path(), False)), "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids; a null list decodes to the empty text."""
    path = path or default_path()

    def run(batches):
        c = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(x.as_py() or []) for x in batch.column(1)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text; each text is encoded, decoded and dropped, so no id list leaves the worker."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(lean(_encoded(path or default_path(), True)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
