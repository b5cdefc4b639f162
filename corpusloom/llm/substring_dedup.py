"""Removal of passages that an earlier document holds, by suffix automata of reference shards.

A passage is any run of at least ``length`` words. A word goes if a window of ``length`` words that
covers it also starts in a document with a smaller id; windows are judged on the input.

1. Every window has an anchor: the least hash of its GRAM-word grams. Equal windows have equal
   anchors. An anchor's owner is the smallest document that has it; anchors of one document alone
   are done with. What is shuffled is a few hashes a document, pre-aggregated.
2. A reference shard is an owner's text around the anchors it owns. It is sent to the task that gets
   the other documents' stretches with these anchors, SALTS times over where an anchor has many
   documents, so no shard is larger than one document and no task gets all of a common passage.
   (A broadcast of all shards to all tasks would grow with the corpus, and so would the work of
   streaming every document past every shard; hence each shard goes only where its anchors occur.)
3. There the shard's suffix automaton is built, the stretches are streamed past it, and where the
   matching statistic reaches ``length`` the window is a repeat.
4. A window that its owner lacks (the anchor alone is common) may still repeat between others.
   Exactly these windows are compared by 128-bit hashes (polynomials over two word hashes of
   different families); the smallest document of a hash, found by an aggregate, stays.
5. Spans are gathered by document and cut from the whole text.

Defined cases: a null or short text loses nothing; a null id loses nothing and is no reference;
rows that share an id never remove each other; equal texts: the smallest id keeps its words; other
columns are carried by ``remove_repeats`` and not read by ``op5``; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, lean, other_word_hashes, row_key, shuffle_partitions, unclashed, word_hashes

LENGTH, GRAM = 50, 16
#: Documents with an anchor for each copy of its shard; beyond SALTS copies both grow with the root of the documents. Copies are powers of two.
SALT_DOCS, SALTS = 32, 256
#: Characters of stretches that a task holds before it passes them on.
FLUSH = 4_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words: differences of prefix sums of a polynomial modulo 2^64."""
    n = len(h) - size + 1
    up = np.multiply.accumulate(np.full(len(h), _BASE, np.uint64))
    down = np.multiply.accumulate(np.full(n, _INVERSE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    return _mix((sums[size:] - sums[:n]) * down)


def window_anchors(h: np.ndarray, length: int) -> np.ndarray:
    """Least gram hash of every window, by doubling; as signed integers."""
    if len(h) < length:
        return np.zeros(0, np.int64)
    g = gram_hashes(h, min(GRAM, length))
    wide, span = length - min(GRAM, length) + 1, 1
    while span * 2 <= wide:
        g, span = np.minimum(g[:-span], g[span:]), span * 2
    if span < wide:
        g = np.minimum(g[: len(g) - (wide - span)], g[wide - span :])
    return g.view(np.int64)


def shard_copies(docs: np.ndarray) -> np.ndarray:
    """Copies of a shard whose anchor ``docs`` documents have."""
    wanted = docs / SALT_DOCS
    return 1 << np.ceil(np.log2(np.maximum(np.where(wanted > SALTS, np.sqrt(wanted * SALTS), wanted), 1))).astype(np.int64)


class SuffixAutomaton:
    """Of several word lists; no match runs from one into the next."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            known = nxt[last].get(w)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            if known is None:
                cur = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
                last = cur
            else:
                last = self._split(last, w, known)

    def _split(self, p: int, w, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        link[q] = clone
        return clone

    def matched(self, words: list, least: int) -> list[int]:
        """Starts of the windows of ``least`` words that the automaton's texts hold."""
        nxt, link, length, v, n, out = self.next, self.link, self.length, 0, 0, []
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                n += 1
                if n >= least:
                    out.append(i - least + 1)
            else:
                n = 0
        return out


def _anchors(length: int):
    def run(batches):
        for batch in batches:
            found = [np.unique(window_anchors(word_hashes((t.as_py() or "").encode().split()), length)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "anchors"])

    return run


_STRETCH = [("owner", pa.int64()), ("level", pa.int32()), ("salt", pa.int32()), ("query", pa.int32()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int32()), ("words", pa.string())]


def _stretches(length: int, flush: int = FLUSH):
    """Runs of windows that have one owner and level, as stretches of text for their shard."""

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _STRETCH, strict=True)], [n for n, _ in _STRETCH])

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for doc_id, tkey, text, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                listed = listed.values
                words = (text.as_py() or "").encode().split()
                at = window_anchors(word_hashes(words), length)
                if not len(at) or not len(listed):
                    continue
                known, owner, docs = (listed.field(i).to_numpy() for i in range(3))
                order = np.argsort(known)
                known, owner, docs = known[order], owner[order], docs[order]
                k = np.minimum(np.searchsorted(known, at), len(known) - 1)
                has = known[k] == at
                # level 0: two documents only, the owner and one other
                level = np.where(docs[k] <= 2, 0, shard_copies(docs[k]))
                own = owner[k]
                edge = np.ones(len(at), bool)
                edge[1:] = (has[1:] != has[:-1]) | (own[1:] != own[:-1]) | (level[1:] != level[:-1])
                starts = np.flatnonzero(edge)
                ends = np.append(starts[1:], len(at))
                for a, b in zip(starts, ends, strict=True):
                    if has[a]:
                        copies = max(1, int(level[a]))
                        part = b" ".join(words[a : b + length - 1]).decode()
                        mine = own[a] == doc_id
                        for salt in range(copies) if mine else (xxhash.xxh32_intdigest(str(doc_id)) % copies,):
                            rows.append((int(own[a]), int(level[a]), salt, int(not mine), doc_id, tkey, int(a), part))
                            size += len(part)
                            if size > flush:  # copies of a long shard leave in portions
                                yield packed(rows)
                                rows, size = [], 0
            if rows:
                yield packed(rows)

    return run


def _runs(starts: list[int], length: int) -> list[tuple[int, int]]:
    """(first word, number of words) of the union of windows."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = s + length
        else:
            out.append([s, s + length])
    return [(a, b - a) for a, b in out]


_FOUND = [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("start", pa.int32()), ("size", pa.int32())]


def _match(length: int):
    """Rows come sorted by shard, its reference stretches first. size 0: a window still to be compared by its hash."""

    def run(batches: Iterator[pa.RecordBatch]):
        shard, automaton, known = None, None, {}
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for i, (owner, level, salt, query, doc_id, tkey, start) in enumerate(zip(*columns, strict=True)):
                if (owner, level, salt) != shard:
                    shard, automaton, known = (owner, level, salt), SuffixAutomaton(), {}
                text = batch.column(7)[i].as_py()
                words = text.encode().split()
                if not query:
                    automaton.add(words)
                    continue
                found = known.get(text)
                if found is None:
                    hits = automaton.matched(words, length)
                    rest = []
                    if level:
                        left = np.setdiff1d(np.arange(len(words) - length + 1), hits)
                        if len(left):
                            h = word_hashes(words)
                            one, two = gram_hashes(h, length).view(np.int64), gram_hashes(other_word_hashes(words), length).view(np.int64)
                            rest = [(int(one[w]), int(two[w]), int(w)) for w in left]
                    found = _runs(hits, length), rest
                    if len(known) < 256:
                        known[text] = found
                for a, n in found[0]:
                    rows.append((doc_id, tkey, doc_id, tkey, start + a, n))
                for h1, h2, w in found[1]:
                    rows.append((h1, h2, doc_id, tkey, start + w, 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FOUND, strict=True)], [n for n, _ in _FOUND])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("tkey"), F.col("text").alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, tkey, start, size: runs of words to remove; they may overlap."""
    n = shuffle_partitions(docs.sparkSession)
    rows = _keyed(docs).where(F.col("doc_id").isNotNull())
    anchors = cut(rows.select("doc_id", "text").mapInArrow(lean(_anchors(length)), "doc_id long, anchors array<long>"))
    each = anchors.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = cut(each.groupBy("anchor").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("docs")).where("owner < last").drop("last"))
    listed = each.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "owner", "docs")).alias("listed"))
    stretches = rows.join(listed, "doc_id").select("doc_id", "tkey", "text", "listed").mapInArrow(lean(_stretches(length)), "owner long, level int, salt int, query int, doc_id long, tkey long, start int, words string")
    shard = ["owner", "level", "salt"]
    found = cut(stretches.repartition(n, *shard).sortWithinPartitions(*shard, "query", "doc_id", "start").mapInArrow(lean(_match(length)), "h1 long, h2 long, doc_id long, tkey long, start int, size int"))
    spans = ["doc_id", "tkey", "start", "size"]
    # windows still to be compared: minima are summed before they are shuffled, and what meets them is a plain join
    rest = found.where("size = 0")
    first = cut(rest.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("h1", "h2", "first"))
    repeated = rest.join(first, ["h1", "h2"]).where("doc_id > first").withColumn("size", F.lit(length))
    return found.where("size > 0").select(*spans).union(repeated.select(*spans))


def with_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, tkey, text, spans: every row with an id; spans is null where nothing repeats."""
    spans = repeated_spans(docs, length).groupBy("doc_id").agg(F.collect_list(F.struct("tkey", "start", "size")).alias("spans"))
    return _keyed(docs).where(F.col("doc_id").isNotNull()).join(spans, "doc_id", "left").select("doc_id", "tkey", "text", "spans")


def kept_words(text: str, tkey: int, spans: pa.ListScalar | None) -> tuple[int, list[bytes] | None]:
    """Number of words, and the words that stay (None: all)."""
    words = text.encode().split()
    if spans is None or spans.values is None:
        return len(words), None
    keep = np.ones(len(words), bool)
    tkeys, starts, sizes = (spans.values.field(i).to_numpy() for i in range(3))
    for k in np.flatnonzero(tkeys == tkey):
        keep[starts[k] : starts[k] + sizes[k]] = False
    return len(words), None if keep.all() else [words[k] for k in np.flatnonzero(keep)]


def _digests(batches):
    for batch in batches:
        n, gone, digest = [], [], []
        for tkey, text, spans in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            text = text.as_py() or ""
            count, kept = kept_words(text, tkey, spans)
            kept = text.encode().split() if kept is None else kept
            n.append(count)
            gone.append(count - len(kept))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def digest_kept(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    nameless = _keyed(docs).where(F.col("doc_id").isNull()).withColumn("spans", F.lit(None).cast("array<struct<tkey:bigint,start:int,size:int>>"))
    return with_spans(docs, length).mapInArrow(lean(_digests), schema).unionByName(nameless.mapInArrow(lean(_digests), schema))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (its other words joined by one space; texts that lose nothing stay as they are); all columns, whatever their names."""
    rows, restored = unclashed(docs)
    spans = repeated_spans(docs, length).groupBy(F.col("doc_id").alias("span_id"), F.col("tkey").alias("span_key")).agg(F.collect_list(F.struct("start", "size")).alias("spans"))

    @F.pandas_udf("string")
    def cut_out(text, spans):
        import pandas as pd

        out = []
        for t, s in zip(text, spans, strict=True):
            words = (t or "").encode().split()
            keep = np.ones(len(words), bool)
            for x in s if s is not None else ():
                keep[x["start"] : x["start"] + x["size"]] = False
            out.append(t if keep.all() else b" ".join(words[k] for k in np.flatnonzero(keep)).decode())
        return pd.Series(out, dtype=object)

    met = rows.join(spans, (rows["doc_id"].cast("long") == F.col("span_id")) & (row_key(rows["text"]) == F.col("span_key")), "left")
    return restored(met, text=F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut_out("text", "spans")))


def op5(spark, sf_dir: str) -> DataFrame:
    return digest_kept(spark.read.parquet(f"{sf_dir}/documents.parquet"))
