"""The pipeline against its stages done by hand in plain Python (the classifier's scores are the operator's own)."""

import hashlib
import math
import random
from collections import Counter

import pytest

import corpus_pipeline
from corpusloom.llm import bpe, quality
from tests.llm.test_llm import WORD, vocabulary


def sets_of(text, size=5):
    w = [x.encode().lower() for x in WORD.findall(text or "")]
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def distinct(rows):
    root = {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: sets_of(t) for i, t, *_ in rows}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return [r for r in rows if find(r[0]) == r[0]]


def unrepeated(rows, length=50):
    first = {}
    for i, t, *_ in sorted(rows):
        w = WORD.findall(t)
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = []
    for i, t, source in rows:
        w = WORD.findall(t)
        keep = [True] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                keep[k : k + length] = [False] * length
        out.append((i, t if all(keep) else " ".join(x for x, y in zip(w, keep, strict=True) if y), source))
    return out


def mixed(rows):
    size = {i: len(WORD.findall(t)) for i, t, _ in rows}
    per = Counter()
    for i, _, s in rows:
        per[s] += size[i]
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(sorted(per))}
    left, open_, target = 1.5 * sum(per.values()), set(per), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * per[s]}
        for s in full or open_:
            target[s] = 2.0 * per[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    out = []
    for s in per:
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (-size[r[0]], hashlib.md5(str(r[0]).encode()).hexdigest()[:2], r[0]))
        u = int(hashlib.md5(f"mix:{s}".encode()).hexdigest()[:5], 16) / 2**20
        e = target[s] / per[s] if per[s] else 0.0
        places = [(k + 1) // 2 if k % 2 else len(own) - k // 2 + 1 for k in range(1, len(own) + 1)]
        shifts = [u + k / 16 - (u + k / 16 >= 1) for k in range(16)]
        taken = lambda v: [math.floor(p * e + v) - math.floor((p - 1) * e + v) for p in places]
        miss = [abs(sum(n * size[r[0]] for n, r in zip(taken(v), own, strict=True)) - target[s]) for v in shifts]
        for n, r in zip(taken(shifts[miss.index(min(miss))]), own, strict=True):
            out += [r] * n
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    words = vocabulary(rng, 500)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    junk = lambda: " ".join(f"{w.upper()}!!" for w in rng.choices(words, k=60))
    passage, rows, labels = prose(80), [], []
    for i in range(260):
        bad = rng.random() < 0.25
        text = junk() if bad else prose(rng.randint(15, 160))
        if not bad and i % 7 == 0:
            text = f"{text} {passage} {prose(20)}"
        if not bad and i % 11 == 0 and rows:
            w = rows[-1][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            text, bad = " ".join(w), labels[-1][1] == 0
        rows.append((i, text, "en", f"s{i % 5 if i % 3 else 0}", len(text)))
        labels.append((i, int(not bad), 0))
    base = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def test_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    machine = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score(docs, machine).collect() if r["predicted"]}
    rows = sorted((r["doc_id"], r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in good)
    assert 100 < len(rows) < 260
    expected = mixed(unrepeated(distinct(rows)))
    codec = bpe.codec(bpe.default_path())
    got = corpus_pipeline.run(spark, folder).collect()
    assert all(r["intact"] for r in got)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, tuple(codec.encode(t))) for i, t, _ in expected)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
