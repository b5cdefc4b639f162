"""Near-duplicate documents by MinHash and an LSH forest.

1. Every document becomes the set of its distinct word shingles (64-bit hashes) and a signature of
   TREES x DEPTH minima. Documents with equal sets are one class, named by its smallest document;
   only classes go on.
2. A tree orders all classes by its DEPTH minima, then by four bits of every minimum, rotated by
   the tree's number. Sorted by range over many tasks, classes that share a long prefix stand side by side.
   Candidates of a class are its neighbours by longest common prefix: all of its region, where the
   depth that makes a region is adapted (the smallest prefix length, sketch bytes included, that
   leaves at most REGION classes), and where DEPTH minima leave more, the next NEAREST classes.
   What a row meets depends on the CONTEXT rows around it alone; rows beside a task's border meet
   again in a second, small pass. So candidates are the same for any number of tasks or batch size.
3. Regions of more than REGION classes (at the depths in CROWDED) are summed to their majority
   signature; the class nearest to it, the hub, is a candidate of all others, so that a group of
   many copies finds its common original. Regions meet their rows in joins, never on the driver.
4. A candidate must agree in enough minima for the similarity asked for; it is confirmed on full
   shingle sets made from whole texts. First each class's most similar partner; then, between
   components that are still apart, all others.
5. What the sorted orders leave out is found exactly: all classes meet in a prefix join on full sets. Of n shingles
   ordered from rare to common, two sets that are similar share one of their first n - ceil(n * percent / 100) + 1.
   For a pair, whose least overlap o follows from both sizes, the shared one is among the first n - o + 1 of each.
   Only classes of different components meet, so a group that hangs together costs its size. Any order gives the same
   links; shingles are ordered by COMMON rough counters, so that those which many documents share stand last and stay out
   of the join. Texts stay where they are: a class goes to the join as packed hashes of its prefix, and only the pairs met
   there that agree in some minima (``surely_matches``) ask for texts.
6. Components: nodes take a neighbour as label and edges are renamed, until few enough for one task.

Defined cases: a null or blank text has an empty set and is linked with nothing; a text of fewer
words than a shingle is one shingle; a null id is linked with nothing, has no component and is
kept; rows with one id and different texts are judged each by its own set; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, lean, row_key, shuffle_partitions, unclashed, word_hashes

TREES, DEPTH = 16, 4
N_HASH = TREES * DEPTH
LEVELS = DEPTH + N_HASH // 2
REGION, NEAREST = 8, 3
#: Rows on each side that decide what a row meets; rows of a border that a second pass needs; minima that make a region with a hub.
CONTEXT, HALO, CROWDED = 8, 24, (2, 3, 4)
#: Rows of small tables (regions, hubs, labels) up to which they are broadcast; edges up to which one task unites them; pairs of one class for each copy of its text.
FEW, FEW_EDGES, COPY_PAIRS = 50_000, 100_000, 64

#: Shingles counted at a time; counters that order shingles, and how many of them are in a row; postings of a bucket; pairs compared at a time.
COUNTED, COMMON, SLICE, BUCKET, AT_ONCE = 500_000, 2**22, 2**16, 2**20, 2**22

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 2**63, N_HASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, N_HASH, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``size`` words, A-Z lower-cased."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = max(1, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        out = _mix(out * _STEP + h[k : k + n] + np.uint64(k + 1))
    return np.unique(out + np.uint64(min(size, len(h))))


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of N_HASH multiply-shift functions, 32 bits each."""
    best = np.full(N_HASH, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 1024):
        best = np.minimum(best, (s[None, a : a + 1024] * _MUL[:, None] + _ADD[:, None]).min(axis=1))
    return (best >> np.uint64(32)).astype(">u4")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def _signed(size: int, common: int):
    """A row for each row; then, as rows of n_shingles -1 with the slice's number as d1, how often each of ``common`` counters was met."""

    def run(batches):
        counts, sets, held = np.zeros(common, np.uint32), [], 0

        def count():
            np.add(counts, np.bincount((np.concatenate(sets) % np.uint64(common)).astype(np.int64), minlength=common), out=counts, casting="unsafe")
            sets.clear()

        for batch in batches:
            n, d1, d2, sig = [], [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py() or "", size)
                n.append(len(s))
                digest = xxhash.xxh3_128_digest(s.tobytes())
                d1.append(int.from_bytes(digest[:8], "little", signed=True))
                d2.append(int.from_bytes(digest[8:], "little", signed=True))
                sig.append(signature(s).tobytes() if len(s) else None)
                if common:
                    sets.append(s)
                    held += len(s)
                    if held >= COUNTED:
                        count()
                        held = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())], names)
        if sets:
            count()
        at = [k for k in range(-(-common // SLICE)) if counts[k * SLICE : (k + 1) * SLICE].any()]
        if at:
            none = pa.nulls(len(at), pa.int64())
            parts = [zlib.compress(counts[k * SLICE : (k + 1) * SLICE].astype("<u4").tobytes(), 1) for k in at]
            yield pa.RecordBatch.from_arrays([none, none, pa.array(np.full(len(at), -1)), pa.array(at, pa.int64()), none, pa.array(parts, pa.binary())], names)

    names = ["doc_id", "tkey", "n_shingles", "d1", "d2", "sig"]
    return run


def _planted(batches):
    """One row a class and tree; the key is the tree's minima and the rotated four-bit sketch."""
    for batch in batches:
        sig = np.frombuffer(b"".join(x.as_py() for x in batch.column(2)), ">u4").reshape(-1, TREES, DEPTH)
        nibbles = (sig.reshape(-1, N_HASH) & 15).astype(np.uint8)
        sketch = (nibbles[:, 0::2] << 4) | nibbles[:, 1::2]
        for tree in range(TREES):
            keys = np.concatenate([np.ascontiguousarray(sig[:, tree]).view(np.uint8).reshape(len(sig), -1), np.roll(sketch, -2 * tree, axis=1)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), tree, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0), batch.column(1)], ["tree", "key", "doc_id", "tkey"])


_EQUAL = np.array([(b >> 4 == 0) + (b & 15 == 0) for b in range(256)], np.uint8)


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _EQUAL[a ^ b].sum(axis=1, dtype=np.int64)


def _alike(tree: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """n x LEVELS: row i shares d + 1 columns (minima, then sketch bytes) with row i - 1."""
    alike = np.zeros((len(tree), LEVELS), bool)
    minima = np.ascontiguousarray(keys[:, : 4 * DEPTH]).view(">u4")
    alike[1:, :DEPTH] = minima[1:] == minima[:-1]
    alike[1:, DEPTH:] = keys[1:, 4 * DEPTH :] == keys[:-1, 4 * DEPTH :]
    alike[1:] &= (tree[1:] == tree[:-1])[:, None]
    return np.logical_and.accumulate(alike, axis=1)


def _votes(sketch: np.ndarray) -> np.ndarray:
    """16 x N_HASH: how often each minimum of the sketches has each value."""
    nibbles = np.concatenate([sketch >> 4, sketch & 15], axis=1)
    return np.stack([(nibbles == v).sum(axis=0) for v in range(16)])


def _middle(votes: np.ndarray) -> np.ndarray:
    most = votes.argmax(axis=0)
    return ((most[: N_HASH // 2] << 4) | most[N_HASH // 2 :]).astype(np.uint8)


_PAIRS = "a_id long, a_key long, b_id long, b_key long, score long"
_FOUND = f"{_PAIRS}, tree int, prefix binary, n long, part binary"
_SCHEMA = pa.schema([*((c, pa.int64()) for c in ("a_id", "a_key", "b_id", "b_key", "score")), ("tree", pa.int32()), ("prefix", pa.binary()), ("n", pa.int64()), ("part", pa.binary())])


def _pair_batch(ids, tkeys, a, b, score) -> pa.RecordBatch:
    swap = (ids[a] > ids[b]) | (ids[a] == ids[b]) & (tkeys[a] > tkeys[b])
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    return _found(a_id=ids[a], a_key=tkeys[a], b_id=ids[b], b_key=tkeys[b], score=score)


def _found(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _near_pairs(shared: np.ndarray, sketch: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted rows that are candidates, and the minima that agree; shared: columns that each row has in common with the one before."""
    n = len(shared)
    depth = np.zeros((CONTEXT, n), np.int64)  # common depth of rows i and i + s + 1
    reach = np.full(n, LEVELS)
    for s in range(min(CONTEXT, n - 1)):
        reach = np.minimum(reach[: n - s - 1], shared[s + 1 :])
        depth[s, : n - s - 1] = reach
    both = np.zeros((2 * CONTEXT, n), np.int64)
    both[:CONTEXT] = depth
    for s in range(min(CONTEXT, n - 1)):
        both[CONTEXT + s, s + 1 :] = depth[s, : n - s - 1]
    # the least depth that leaves at most REGION rows; LEVELS + 1: none does
    need = 1 + np.sort(both, axis=0)[2 * CONTEXT - REGION]
    found = []
    for s in range(1, min(REGION, n)):
        i = np.arange(n - s)
        common = depth[s - 1, : n - s]
        ok = (common >= np.minimum(need[i], need[i + s])) | ((s <= NEAREST) & (common >= DEPTH)) | ((s == 1) & (common >= 1))
        found.append(np.stack([i[ok], i[ok] + s], axis=1))
    at = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    score = _matches(sketch[at[:, 0]], sketch[at[:, 1]])
    return at[score >= least], score[score >= least]


class _Crowds:
    """Runs of rows with one prefix, depth by depth; one that goes on in the next batch is held as a sum of votes."""

    def __init__(self):
        self.held: dict[int, list] = {}  # depth: tree, prefix, rows, votes, whether it began with the task

    def add(self, tree, keys, shared, first: bool) -> list[tuple]:
        """Closed runs that are crowded, or that may go on in the task before; shared[0] is with the row before the batch."""
        out = []
        for depth in CROWDED:
            starts = np.flatnonzero(shared < depth)
            goes_on = not (len(starts) and starts[0] == 0)
            starts = np.concatenate([[0], starts]) if goes_on else starts
            ends = np.append(starts[1:], len(shared))
            if not goes_on and depth in self.held:
                out += self._closed(self.held.pop(depth))
            for k in np.flatnonzero((ends - starts > REGION) | (np.arange(len(starts)) == 0) | (ends == len(shared))):
                a, b = int(starts[k]), int(ends[k])
                votes = _votes(keys[a:b, 4 * DEPTH :])
                if k == 0 and goes_on and depth in self.held:
                    run = self.held.pop(depth)
                    run[2] += b - a
                    run[3] = run[3] + votes
                else:
                    run = [int(tree[a]), keys[a, : 4 * depth].tobytes(), b - a, votes, first and k == 0]
                if b == len(shared):
                    self.held[depth] = run
                else:
                    out += self._closed(run)
        return out

    @staticmethod
    def _closed(run: list, last: bool = False) -> list[tuple]:
        return [tuple(run[:4])] if last or run[4] or run[2] > REGION else []

    def end(self) -> list[tuple]:
        return [x for run in self.held.values() for x in self._closed(run, True)]


def _neighbours(least: int):
    """Sorted rows of one task. Pairs whose context lies inside the task; the task's border rows and their number (tree -1); crowded runs."""

    def crowds(rows: list[tuple]):
        if rows:
            tree, prefix, n, votes = zip(*rows, strict=True)
            yield _found(tree=tree, prefix=prefix, n=n, part=[v.astype("<u4").tobytes() for v in votes])

    def border(task, rows, begin, at):
        """Rows that may be met from other tasks: b_id says which task, n the place in it; ``rows`` begin at a place."""
        if len(at):
            some = rows.take(pa.array(at - begin))
            yield _found(a_id=some.column(2), a_key=some.column(3), b_id=np.full(len(at), task), tree=some.column(0), prefix=some.column(1), n=at)

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        task, rest, begin, total, open_runs = TaskContext.get().partitionId(), None, 0, 0, _Crowds()
        for batch in batches:
            if not batch.num_rows:
                continue
            old = rest.num_rows if rest else 0
            rows = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks().to_batches()[0]
            tree = rows.column(0).to_numpy()
            keys = np.frombuffer(b"".join(x.as_py() for x in rows.column(1)), np.uint8).reshape(len(tree), -1)
            ids, tkeys = rows.column(2).to_numpy(), rows.column(3).to_numpy()
            shared = _alike(tree, keys).sum(axis=1)
            yield from crowds(open_runs.add(tree[old:], keys[old:], shared[old:], total == 0))
            at, score = _near_pairs(shared, keys[:, 4 * DEPTH :], least)
            # the context of a pair is CONTEXT rows before it and behind it; what has too few before it was met in the last batch
            ok = (at[:, 0] >= CONTEXT) & (at[:, 1] + CONTEXT < len(tree)) & (at[:, 1] + CONTEXT >= old)
            if ok.any():
                yield _pair_batch(ids, tkeys, at[ok, 0], at[ok, 1], score[ok])
            if total < HALO:
                yield from border(task, rows, begin, np.arange(total, min(HALO, total + batch.num_rows)))
            total += batch.num_rows
            keep = min(len(tree), 2 * HALO)
            rest, begin = rows.slice(len(tree) - keep, keep), total - keep
        if total:
            yield from crowds(open_runs.end())
            yield from border(task, rest, begin, np.arange(max(HALO, total - HALO), total))
            yield _found(tree=[-1], b_id=[task], n=[total])

    return run


def _at_borders(least: int):
    """Rows come sorted by border and place. Pairs whose context holds the border."""

    def met(border, rows):
        place, tree, keys, ids, tkeys = zip(*rows, strict=True)
        place, tree, ids, tkeys = (np.array(c, np.int64) for c in (place, tree, ids, tkeys))
        keys = np.frombuffer(b"".join(keys), np.uint8).reshape(len(tree), -1)
        at, score = _near_pairs(_alike(tree, keys).sum(axis=1), keys[:, 4 * DEPTH :], least)
        ok = (place[at[:, 0]] - CONTEXT < border) & (place[at[:, 1]] + CONTEXT >= border)
        return _pair_batch(ids, tkeys, at[ok, 0], at[ok, 1], score[ok]).select([0, 1, 2, 3, 4])

    def run(batches):
        held = None
        for batch in batches:
            for border, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held[0] != border:
                    if held:
                        yield met(*held)
                    held = (border, [])
                held[1].append(tuple(row))
        if held:
            yield met(*held)

    return run


def _regions(batches):
    """Sums of votes come sorted by region. The majority signature of each crowded one."""
    held = None

    def closed(tree, prefix, n, votes):
        if n > REGION:
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([prefix]), pa.array([n], pa.int64()), pa.array([np.roll(_middle(votes), 2 * tree).tobytes()])], ["tree", "prefix", "n", "middle"])

    for batch in batches:
        for tree, prefix, n, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is None or held[:2] != [tree, prefix]:
                if held:
                    yield from closed(*held)
                held = [tree, prefix, 0, np.zeros((16, N_HASH), np.int64)]
            held[2] += n
            held[3] += np.frombuffer(part, "<u4").reshape(16, N_HASH)
    if held:
        yield from closed(*held)


def _sketches(column: pa.Array) -> np.ndarray:
    """One row of four-bit minima, two to a byte, for each signature."""
    nibbles = (np.frombuffer(b"".join(x.as_py() for x in column), ">u4").reshape(-1, N_HASH) & 15).astype(np.uint8)
    return (nibbles[:, 0::2] << 4) | nibbles[:, 1::2]


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.uint8).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _towards(batches):
    """region, id, key, sig, middle: how near each row is to its region's majority, and its sketch."""
    for batch in batches:
        if batch.num_rows:
            sketch = _sketches(batch.column(3))
            score = _matches(sketch, _bytes(batch.column(4)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), _binary(sketch), pa.array(score)], ["region", "id", "key", "sketch", "score"])


def _to_hubs(least: int):
    """id, key, sketch and the hub's: pairs that agree in enough minima."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, tkeys, h_ids, h_keys = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            score = _matches(_bytes(batch.column(2)), _bytes(batch.column(5)))
            ok = np.flatnonzero((score >= least) & ((ids != h_ids) | (tkeys != h_keys)))
            if len(ok):
                n = len(ok)
                yield _pair_batch(np.append(ids[ok], h_ids[ok]), np.append(tkeys[ok], h_keys[ok]), np.arange(n), np.arange(n, 2 * n), score[ok]).select([0, 1, 2, 3, 4])

    return run


def least_matches(percent: int) -> int:
    """Minima (of N_HASH, four bits each) that a pair at the limit exceeds but for chance below 1e-5."""
    p = percent / 100 + (1 - percent / 100) / 16
    return int(N_HASH * p - 4.3 * (N_HASH * p * (1 - p)) ** 0.5)


def surely_matches(percent: int) -> int:
    """Minima that a pair at the limit exceeds but for a chance of about 1e-14, less than that of two sets with one digest in a large corpus."""
    p = percent / 100 + (1 - percent / 100) / 16
    return max(0, int(N_HASH * p - 9 * (N_HASH * p * (1 - p)) ** 0.5))


def _node(prefix: str):
    return F.struct(F.col(f"{prefix}_id").alias("id"), F.col(f"{prefix}_key").alias("key"))


def _small(df: DataFrame) -> DataFrame:
    """A materialised table, broadcast if a count says that it is small."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def _sorted_pairs(classes: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Candidates among neighbours in the sorted orders, and the crowded regions: region, middle."""
    spark, n = classes.sparkSession, shuffle_partitions(classes.sparkSession)
    order = ["tree", "key", "doc_id", "tkey"]
    planted = classes.select("doc_id", "tkey", "sig").mapInArrow(_planted, "tree int, key binary, doc_id long, tkey long")
    found = cut(planted.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(lean(_neighbours(least)), _FOUND))
    pairs = found.where("tree IS NULL").select(*[c.split(" ")[0] for c in _PAIRS.split(", ")])
    # one number a task reaches the driver; a border and the rows around it go to the tasks as a table of its own
    sizes = sorted(tuple(r) for r in found.where("tree = -1").select("b_id", "n").collect())
    begins = np.concatenate([[0], np.cumsum([k for _, k in sizes])]).astype(np.int64)
    near = []
    for k, (task, size) in enumerate(sizes):
        lo, hi = np.searchsorted(begins, begins[k] - HALO, "right"), np.searchsorted(begins, begins[k] + size + HALO)
        near += [(task, int(begins[k]), int(b)) for b in begins[lo:hi]]
    marks = spark.createDataFrame(near, "b_id long, begin long, border long")
    rows = found.where("tree >= 0 AND b_id IS NOT NULL").select("b_id", "n", "tree", F.col("prefix").alias("row_key"), F.col("a_id").alias("id"), F.col("a_key").alias("tkey"))
    rows = rows.join(F.broadcast(marks), "b_id").withColumn("place", F.col("begin") + F.col("n")).where(f"place >= border - {HALO} AND place < border + {HALO}")
    beside = rows.select("border", "place", "tree", "row_key", "id", "tkey").repartition(n, "border").sortWithinPartitions("border", "place").mapInArrow(_at_borders(least), _PAIRS)
    parts = found.where("tree >= 0 AND part IS NOT NULL").select("tree", "prefix", "n", "part").repartition(n, "tree", "prefix").sortWithinPartitions("tree", "prefix")
    regions = parts.mapInArrow(_regions, "tree int, prefix binary, n long, middle binary")
    return pairs.union(beside), cut(regions.select(F.xxhash64("tree", "prefix").alias("region"), "middle"))


def _crowd(classes: DataFrame, regions: DataFrame) -> DataFrame:
    """region, id, key, sketch, score: the rows of crowded regions, and how near they are to the majority."""
    places = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", 4 * DEPTH * t + 1, 4 * d)) for t in range(TREES) for d in CROWDED])
    rows = classes.select("doc_id", "tkey", "sig", F.explode(places).alias("region"))
    return cut(rows.join(_small(regions), "region").select("region", "doc_id", "tkey", "sig", "middle").mapInArrow(lean(_towards), "region long, id long, key long, sketch binary, score long"))


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """a, b, score: pairs of classes (doc_id, tkey, sig), each once."""
    return pairs_and_crowd(classes, percent)[0]


def pairs_and_crowd(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """a, b, score: pairs of classes (doc_id, tkey, sig), each once; and node, sketch: the classes of crowded regions."""
    least = least_matches(percent)
    found, regions = _sorted_pairs(classes, least)
    crowd = _crowd(classes, regions)
    hubs = cut(crowd.groupBy("region").agg(F.max(F.struct("score", "id", "key", "sketch")).alias("m")).select("region", "m.id", "m.key", "m.sketch"))
    hubs = hubs.select("region", F.col("id").alias("h_id"), F.col("key").alias("h_key"), F.col("sketch").alias("h_sketch"))
    met = crowd.join(_small(hubs), "region").select("id", "key", "sketch", "h_id", "h_key", "h_sketch").mapInArrow(lean(_to_hubs(least)), _PAIRS)
    pairs = found.union(met).groupBy(_node("a").alias("a"), _node("b").alias("b")).agg(F.max("score").alias("score"))
    return pairs, crowd.groupBy(F.struct("id", "key").alias("node")).agg(F.first("sketch").alias("sketch"))


def _summed(batches):
    """Slices of counters from all tasks. The ranks of their sums, eight to each doubling, as bytes."""
    sums = {}
    for batch in batches:
        for at, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = np.frombuffer(zlib.decompress(part.as_py()), "<u4").astype(np.int64)
            sums[at] = sums[at] + counts if at in sums else counts
    for at, counts in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8).tobytes()])], ["at", "rank"])


def _ranks(parts: DataFrame, common: int) -> np.ndarray:
    """The rank of each counter; parts: at, part. One byte a counter reaches the driver."""
    ranks = np.zeros(common, np.uint8)
    for r in parts.repartition(shuffle_partitions(parts.sparkSession), "at").mapInArrow(lean(_summed), "at long, rank binary").collect():
        ranks[r["at"] * SLICE : (r["at"] + 1) * SLICE] = np.frombuffer(r["rank"], np.uint8)
    return ranks


def _prefixes(size: int, percent: int, ranks: np.ndarray):
    """id, key, n, prefix: six bytes of each shingle of a set's prefix, from the lowest rank to the highest."""

    def run(batches):
        for batch in batches:
            n, prefix = [], []
            for text in batch.column(2):
                s = shingles(text.as_py() or "", size)
                order = np.argsort(ranks[(s % np.uint64(len(ranks))).astype(np.int64)], kind="stable") if len(ranks) else np.arange(len(s))
                first = s[order[: len(s) - (len(s) * percent + 99) // 100 + 1]].astype("<u8")
                n.append(len(s))
                prefix.append(first.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prefix, pa.binary())], ["id", "key", "n", "prefix"])

    return run


_POSTING = (("h", 6), ("num", 8), ("label", 8), ("n", 4), ("place", 4))


def _pack(postings: dict[str, np.ndarray]) -> bytes:
    """Numbers as steps, labels as what differs from the number (mostly nothing); bytes of one weight side by side."""
    num = postings["num"]
    rows = postings | {"num": np.diff(num, prepend=0), "label": postings["label"] ^ num}
    planes = [rows[c].astype("<i8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes() for c, k in _POSTING]
    return zlib.compress(b"".join(planes), 1)


def _unpack(parts: list[bytes]) -> dict[str, np.ndarray]:
    found = {c: [] for c, _ in _POSTING}
    for part in parts:
        planes = np.frombuffer(zlib.decompress(part), np.uint8).reshape(sum(k for _, k in _POSTING), -1)
        at, rows = 0, {}
        for c, k in _POSTING:
            whole = np.zeros((planes.shape[1], 8), np.uint8)
            whole[:, :k] = planes[at : at + k].T
            at, rows[c] = at + k, whole.view("<i8")[:, 0]
        num = np.cumsum(rows["num"])
        for c, x in (rows | {"num": num, "label": rows["label"] ^ num}).items():
            found[c].append(x)
    return {c: np.concatenate(x) for c, x in found.items()}


def _dealt(buckets: int):
    """num, label, n, prefix of classes. Their postings, packed by bucket."""

    def run(batches):
        for batch in batches:
            prefixes = [x.as_py() for x in batch.column(3)]
            times = np.array([len(x) // 6 for x in prefixes], np.int64)
            if not times.sum():
                continue
            whole = np.zeros((int(times.sum()), 8), np.uint8)
            whole[:, :6] = np.frombuffer(b"".join(prefixes), np.uint8).reshape(-1, 6)
            num, label, n = (np.repeat(batch.column(i).to_numpy(), times) for i in range(3))
            rows = {"h": whole.view("<i8")[:, 0], "num": num, "label": label, "n": n, "place": np.arange(len(n)) - np.repeat(np.cumsum(times) - times, times)}
            bucket = (rows["h"] >> 24) % buckets
            order = np.argsort(bucket, kind="stable")
            rows, bucket = {c: x[order] for c, x in rows.items()}, bucket[order]
            begins = np.flatnonzero(np.diff(bucket, prepend=-1))
            parts = [_pack({c: x[a:b] for c, x in rows.items()}) for a, b in zip(begins, np.append(begins[1:], len(bucket)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[begins]), pa.array(parts, pa.binary())], ["bucket", "part"])

    return run


def _cross(p: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers a < b of classes with different labels that share a shingle where similar sets of their sizes may have it first."""
    order = np.lexsort((p["label"], p["h"]))
    p = {c: x[order] for c, x in p.items()}
    begins = np.flatnonzero(np.append(True, p["h"][1:] != p["h"][:-1]))
    ends = np.append(begins[1:], len(order))
    mixed = p["label"][begins] != p["label"][ends - 1]
    if not mixed.any():
        return
    keep = np.repeat(mixed, ends - begins)
    lengths = (ends - begins)[mixed]
    p = {c: x[keep] for c, x in p.items()}
    end = np.repeat(np.cumsum(lengths), lengths)
    runs = np.flatnonzero(np.append(True, (p["label"][1:] != p["label"][:-1]) | (p["h"][1:] != p["h"][:-1])))
    run_ends = np.append(runs[1:], len(end))
    behind = np.repeat(run_ends, run_ends - runs)
    others = end - behind  # rows of the same shingle behind the row's own label
    total = np.cumsum(others)
    at = 0
    while at < len(end):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, "right")))
        times = others[at:to]
        i = np.repeat(np.arange(at, to), times)
        j = np.repeat(behind[at:to], times) + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        n, m = p["n"][i], p["n"][j]
        overlap = -(-(n + m) * percent // (100 + percent))
        ok = (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (p["place"][i] <= n - overlap) & (p["place"][j] <= m - overlap)
        a, b = p["num"][i[ok]], p["num"][j[ok]]
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
        yield a[new], b[new]
        at = to


def _meeting(percent: int):
    """Packed postings come sorted by bucket. Pairs that may be similar."""

    def met(parts):
        for a, b in _cross(_unpack(parts), percent):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        at, parts = None, []
        for batch in batches:
            for bucket, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != at and parts:
                    yield from met(parts)
                    parts = []
                at = bucket
                parts.append(part.as_py())
        if parts:
            yield from met(parts)

    return run


def _agreeing(least: int):
    """Pairs of nodes whose signatures agree in enough minima."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.select([0, 1, 2, 3]).filter(pa.array(_matches(_bytes(batch.column(4)), _bytes(batch.column(5))) >= least))

    return run


def _sketched(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), _binary(_sketches(batch.column(3)))], ["num", "id", "key", "sketch"])


def left_apart(members: DataFrame, rows: DataFrame, ranks: np.ndarray, postings: int, size: int, percent: int) -> DataFrame:
    """a, b: all pairs of members (num, node, label, sig) of different labels that may be similar; rows: doc_id, tkey, text; postings: about how many."""
    n = shuffle_partitions(members.sparkSession)
    own = members.select(F.col("node.id").alias("id"), F.col("node.key").alias("key"), "num", F.col("label").alias("node"))
    own = own.join(members.select("node", F.col("num").alias("l_num")), "node").select("id", "key", "num", "l_num")
    prefixes = rows.select("doc_id", "tkey", "text").mapInArrow(lean(_prefixes(size, percent, ranks)), "id long, key long, n long, prefix binary")
    dealt = prefixes.join(own, ["id", "key"]).select("num", "l_num", "n", "prefix").mapInArrow(lean(_dealt(max(2 * n, -(-postings // BUCKET)))), "bucket long, part binary")
    met = cut(dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(_meeting(percent)), "a long, b long").distinct())
    sketches = cut(members.select("num", "node.id", "node.key", "sig").mapInArrow(lean(_sketched), "num long, id long, key long, sketch binary"))
    of = lambda c: sketches.select(F.col("num").alias(c), F.col("id").alias(f"{c}_id"), F.col("key").alias(f"{c}_key"), F.col("sketch").alias(f"{c}_sketch"))
    both = met.join(of("a"), "a").join(of("b"), "b").select("a_id", "a_key", "b_id", "b_key", "a_sketch", "b_sketch")
    near = both.mapInArrow(lean(_agreeing(surely_matches(percent))), "a_id long, a_key long, b_id long, b_key long")
    return near.select(F.least(_node("a"), _node("b")).alias("a"), F.greatest(_node("a"), _node("b")).alias("b"))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are similar; texts: node, text. The text of a class with many pairs goes to as many tasks as its pairs need."""

    def run(batches):
        seen, own = None, None
        for batch in batches:
            ok = []
            for i in range(batch.num_rows):
                at = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if at != seen:
                    seen, own = at, shingles(batch.column(5)[i].as_py() or "", size)
                ok.append(similar(shingles(batch.column(4)[i].as_py() or "", size), own, percent))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(ok, pa.bool_())], ["a_id", "a_key", "b_id", "b_key", "ok"])

    often = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count().where(F.col("count") > COPY_PAIRS))
    often = _small(often.select("node", F.ceil(F.col("count") / COPY_PAIRS).cast("long").alias("copies")))
    of = lambda c: often.select(F.col("node").alias(c), F.col("copies").alias(f"{c}_copies"))
    known = pairs.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").withColumn("swap", F.coalesce("a_copies", F.lit(1)) > F.coalesce("b_copies", F.lit(1)))
    x, y = F.when(F.col("swap"), F.col("b")).otherwise(F.col("a")), F.when(F.col("swap"), F.col("a")).otherwise(F.col("b"))
    turned = known.select(x.alias("x"), y.alias("y"), F.pmod(F.xxhash64(x), F.greatest(F.coalesce("a_copies", F.lit(1)), F.coalesce("b_copies", F.lit(1)))).alias("copy"))
    left = texts.select(F.col("node").alias("x"), F.col("text").alias("x_text"))
    right = texts.join(often, "node", "left").select(F.col("node").alias("y"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"), F.col("text").alias("y_text"))
    both = turned.join(left, "x").join(right, ["y", "copy"]).select("x.id", "x.key", F.col("y.id").alias("b_id"), F.col("y.key").alias("b_key"), "x_text", "y_text")
    met = both.mapInArrow(lean(run), "a_id long, a_key long, b_id long, b_key long, ok boolean").where("ok")
    return met.select(F.least(_node("a"), _node("b")).alias("a"), F.greatest(_node("a"), _node("b")).alias("b"))


def _united(batches):
    """All edges a, b: every node with the first node of its component."""
    above: dict[tuple, tuple] = {}

    def top(x):
        while (y := above.setdefault(x, x)) != x:
            above[x] = above[y]
            x = above[x]
        return x

    for batch in batches:
        nodes = [batch.column(i).to_numpy().tolist() for i in range(6)]
        for a, b in zip(zip(*nodes[:3], strict=True), zip(*nodes[3:], strict=True), strict=True):
            a, b = top(a), top(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    if above:
        rows = [(*x, *top(x)) for x in list(above)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["h", "id", "key", "l_h", "l_id", "l_key"])


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each linked node reaches; smallest ones are left out.

    While there are many edges, every node takes as label the first of its neighbours and itself by a hash (so that no
    order of ids makes long chains), edges are renamed, and those inside a label go. Minima are summed up before they
    are shuffled, and the joins are plain ones, whose large keys Spark splits; no node's edges have to be in one task.
    At most FEW_EDGES edges, a bounded table, are left to a union-find in one task.
    """
    by_hash = lambda c: F.struct(F.xxhash64(f"{c}.id", f"{c}.key").alias("h"), F.col(f"{c}.id").alias("id"), F.col(f"{c}.key").alias("key")).alias(c)
    edges = cut(links.where("a != b").select(by_hash("a"), by_hash("b")))
    found = None
    while edges.limit(FEW_EDGES + 1).count() > FEW_EDGES:
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
        least = cut(ends.groupBy(F.col("e.node").alias("node")).agg(F.min("e.other").alias("m")).select("node", F.least("node", "m").alias("label")))
        found = least if found is None else _renamed(found, least)
        of = lambda c: least.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))  # noqa: B023, E731
        between = edges.join(of("a"), "a").join(of("b"), "b").where("a_label != b_label")
        edges = cut(between.select(F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b")).distinct())
    rest = edges.select("a.h", "a.id", "a.key", F.col("b.h").alias("b_h"), F.col("b.id").alias("b_id"), F.col("b.key").alias("b_key")).repartition(1).mapInArrow(_united, "h long, id long, key long, l_h long, l_id long, l_key long")
    rest = rest.select(F.struct("h", "id", "key").alias("node"), F.struct(F.col("l_h").alias("h"), F.col("l_id").alias("id"), F.col("l_key").alias("key")).alias("label"))
    found = cut(rest if found is None else _renamed(found, _small(cut(rest))))
    found = found.select(F.struct("node.id", "node.key").alias("node"), F.col("label").alias("root"))
    return found.join(_small(cut(found.groupBy("root").agg(F.min("node").alias("label")))), "root").select("node", "label").where("node != label")


def _renamed(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``found`` with each label replaced by the one that ``labels`` gives it, if any."""
    others = [c for c in found.columns if c != "label"]
    return found.join(labels.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left").select(*others, F.coalesce("root", "label").alias("label"))


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs a, b with a_label, b_label; a node without a label is its own."""
    for c in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")), c, "left").withColumn(f"{c}_label", F.coalesce(f"{c}_label", c))
    return pairs


def classify(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, tkey, n_shingles, component_id, kept: a row for each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("text")).alias("tkey"), F.col("text").alias("text"))
    common = COMMON
    told = cut(rows.mapInArrow(lean(_signed(size, common)), "doc_id long, tkey long, n_shingles long, d1 long, d2 long, sig binary"))
    signed, node = told.where("n_shingles >= 0"), F.struct(F.col("doc_id").alias("id"), F.col("tkey").alias("key"))
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = cut(signed.where(linkable).groupBy("d1", "d2").agg(F.min(node).alias("node"), F.first("sig").alias("sig")))
    pairs = cut(pairs_and_crowd(classes.select(F.col("node.id").alias("doc_id"), F.col("node.key").alias("tkey"), "sig"), percent)[0])
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"), "score")
    partners = cut(ends.groupBy("p.x").agg(F.max(F.struct("score", F.col("p.y"))).alias("m")).select("x", "m.y"))
    of = lambda wanted: cut(rows.where(F.col("doc_id").isNotNull()).select(node.alias("node"), "text").join(wanted, "node", "left_semi").dropDuplicates(["node"]))
    texts = of(partners.select(F.col("x").alias("node")))
    best = cut(partners.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    first = _small(cut(components(confirm(best, texts, size, percent))))
    apart = _labelled(pairs.join(best, ["a", "b"], "left_anti"), first).where("a_label != b_label")
    more = confirm(cut(apart.select("a", "b")), texts, size, percent)
    between = _labelled(more, first).select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct()
    second = _small(cut(components(between)))
    members = cut(_renamed(_renamed(classes.select("d1", "d2", "sig", "node", F.col("node").alias("label")), first), second).withColumn("num", F.monotonically_increasing_id()))
    prefixes = signed.where(linkable).agg(F.sum(F.floor(F.col("n_shingles") * (100 - percent) / 100) + 1)).first()[0] or 0
    ranks = _ranks(told.where("n_shingles < 0").select(F.col("d1").alias("at"), F.col("sig").alias("part")), common)
    left = cut(left_apart(members, rows.where(F.col("doc_id").isNotNull()), ranks, int(prefixes), size, percent))
    ends = cut(left.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    rest = confirm(left, of(_small(ends)), size, percent)
    labels = members.select("node", "label").join(_small(ends), "node", "left_semi")
    between = _labelled(rest, labels).select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct()
    named = _renamed(members.select("d1", "d2", "node", "label"), _small(cut(components(between))))
    named = named.select("d1", "d2", F.col("label.id").alias("component_id"))
    # rows that link with nothing need no join, so they do not meet in one task
    columns = ["doc_id", "tkey", "n_shingles", "component_id"]
    result = signed.where(linkable).join(cut(named), ["d1", "d2"]).select(*columns).union(signed.where(~linkable).select("doc_id", "tkey", "n_shingles", F.col("doc_id").alias("component_id")))
    return result.select(*columns, (F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))).alias("kept"))


def keep_one(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without those of which a component holds a smaller document; all columns, whatever their names."""
    rows, restored = unclashed(docs)
    gone = classify(docs, size=size, percent=percent).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("tkey").alias("gone_key")).distinct()
    text, doc_id = rows["text"], rows["doc_id"]
    return restored(rows.join(gone, (doc_id.cast("long") == F.col("gone_id")) & (row_key(text) == F.col("gone_key")), "left_anti"))


def op6(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2, percent=80).drop("tkey")
