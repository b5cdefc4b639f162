"""Quality classifier: a factorisation machine.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over hashed words, statistics of
the text's structure, and its metadata (sizes; never language, source or ids). The pairwise sum is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so scoring is linear in the features.

Fitting: at most ``max_rows`` labelled rows, those whose id's MD5 is lowest, are turned to feature
vectors on the executors; only those vectors (max_rows x N_FEATURES floats) reach the driver, where
the machine is fitted by gradient steps with fixed seed. Rows whose crc32(id as text) mod 4 is 2 are
held out: their labels are never read for fitting. Scoring reads every whole text once, without a
shuffle.

Defined cases: a null text counts as empty and is scored as such; without labels of both kinds all
scores are the share of label 1 (0.5 without labels); several labels of one id count as rows of
their own; null ids are not held out (crc32 of the empty string) and have no label; equal texts
have equal scores; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean, release

WORDS, N_STATS = 256, 24
N_FEATURES = WORDS + N_STATS
RANK = 8
THRESHOLD = 0.7
#: Standardised features count within these bounds, in fitting as in scoring.
BOUND = 5.0
#: Labelled rows that are fitted on at most.
MAX_ROWS = 6000

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), [32], [10], [9, 11, 12, 13], map(ord, ".,;:?'\"()-"), map(ord, "!#$%&*+/<=>@[\\]^_`{|}~"), range(128, 256)), 1):
    _CLASS[list(_chars)] = _k


def features(text: str) -> np.ndarray:
    """Hashed words (term shares, length 1) and statistics within about -1 and 1."""
    raw = text.encode()
    x = np.zeros(N_FEATURES, np.float32)
    words = raw.split()
    n, size = len(words), max(len(raw), 1)
    share = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10) / size
    stats = [*share]  # 10
    if n:
        counts = np.bincount(np.fromiter(map(zlib.crc32, words), np.uint32, n) % WORDS, minlength=WORDS).astype(np.float32)
        x[:WORDS] = counts / np.sqrt((counts**2).sum())
        distinct = len(set(words))
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        pairs = len(set(zip(words, words[1:], strict=False)))
        lines = [v for v in raw.split(b"\n") if v.strip()]
        upper = sum(w.isupper() for w in words)
        mixed = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
        lens = np.fromiter(map(len, words), np.int64, n)
        stats += [distinct / n, same / n, pairs / n, upper / n, mixed / n, len(set(lines)) / len(lines), min(1, lens.mean() / 12), min(1, lens.std() / 10), min(1, np.log1p(n) / 10), min(1, n / len(lines) / 200), min(1, float(lens.max()) / 60), min(1, raw.count(b"!!") / n), min(1, raw.count(b" | ") / n)]
    stats += [0.0] * (N_STATS - 1 - len(stats)) + [1.0 if n else 0.0]
    x[WORDS:] = stats
    return x


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def standard(self, x: np.ndarray) -> np.ndarray:
        """What the machine is fitted on and scores: standardised features within the bound."""
        return np.clip((x - self.mean) * self.scale, -BOUND, BOUND)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.standard(x)
        pairs = 0.5 * ((z @ self.factors) ** 2 - (z**2) @ (self.factors**2)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(self.bias + z @ self.linear + pairs, -30, 30)))


def fit_machine(x: np.ndarray, y: np.ndarray, *, rank: int = RANK, steps: int = 600, batch: int = 512, rate: float = 0.02, decay: float = 2e-3, seed: int = 7) -> Machine:
    """Adam on the log loss, both labels weighed alike."""
    d = x.shape[1]
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        odds = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
        return Machine(float(odds), np.zeros(d), np.zeros((d, rank)), np.zeros(d), np.ones(d))
    rng = np.random.default_rng(seed)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-2), 0.0)
    scale[:WORDS] *= 0.2
    p = {"b": np.zeros(1), "w": np.zeros(d), "v": rng.normal(0, 0.02, (d, rank))}
    m = {k: np.zeros_like(a) for k, a in p.items()}
    s = {k: np.zeros_like(a) for k, a in p.items()}
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    z_all = Machine(0.0, p["w"], p["v"], mean, scale).standard(x)
    for t in range(1, steps + 1):
        at = rng.integers(0, len(y), batch)
        z, t_y = z_all[at], y[at]
        sums = z @ p["v"]
        logit = p["b"][0] + z @ p["w"] + 0.5 * (sums**2 - (z**2) @ (p["v"] ** 2)).sum(axis=1)
        g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - t_y) * weight[at] / batch
        grads = {"b": np.array([g.sum()]), "w": z.T @ g + decay * p["w"], "v": z.T @ (g[:, None] * sums) - ((z**2).T @ g)[:, None] * p["v"] + decay * p["v"]}
        for k, grad in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * grad
            s[k] = 0.999 * s[k] + 0.001 * grad**2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Machine(float(p["b"][0]), p["w"], p["v"], mean, scale)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = MAX_ROWS) -> Machine:
    """The machine fitted on the first ``max_rows`` rows by MD5 of the id that are labelled and not held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "y").limit(max_rows)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).join(F.broadcast(own), "doc_id")  # max_rows rows at most

    def run(batches):
        for batch in batches:
            xs = [features(t.as_py() or "").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(xs, pa.binary())], ["doc_id", "y", "x"])

    # rows that share an id could exceed the bound, so it holds again here, in an order that reruns repeat
    got = chosen.select("doc_id", "y", "text").mapInArrow(lean(run), "doc_id long, y int, x binary").orderBy("doc_id", "y", "x").limit(max_rows).collect()
    got.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
    return fit_machine(x, np.array([float(r["y"] > 0) for r in got]))


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for a in range(0, batch.num_rows, 1024):
                part = batch.column(2).slice(a, 1024)
                out.append(machine.score(np.stack([features(t.as_py() or "") for t in part]).astype(np.float64)))
            s = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").alias("text")).mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            parts = [machine.score(np.stack([features(t or "") for t in text[a : a + 1024]]).astype(np.float64)) for a in range(0, len(text), 1024)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        release()

    return docs.where(scored("text") >= threshold)


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
