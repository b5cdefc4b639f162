"""The opN queries over files, against plain Python that shares nothing with the operators."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

import corpus_pipeline
from corpusloom.llm import fingerprints, media, mixing, near_dedup, quality, sharding, substring_dedup, token_counts
from tests.llm.test_llm import PATH, labelled, sample_texts, vocabulary


@pytest.fixture(scope="module")
def texts():
    return [(i * 2 + 1, t) for i, t in enumerate(sample_texts(3))]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    base = tmp_path_factory.mktemp("queries")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{base}/documents.parquet")
    return str(base)


def test_op1(spark, folder, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    n = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.op1(spark, folder).collect()}
    assert got == {i: (len((t or "").encode()), n[i], n[i] > 1024) for i, t in texts}
    assert {x[2] for x in got.values()} == {True, False}


def chunks_of(payload):
    """The rolling hash a byte at a time."""
    gear = [int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)]
    out, start = [], 0
    while start < len(payload):
        end = min(len(payload), start + 65536)
        if len(payload) - start > 2048:
            h, found = 0, None
            for k in range(max(0, start + 2048 - 32), end):
                h = (h * 2 + gear[payload[k]]) % 2**32
                if k + 1 >= start + 2048 and h >> 19 == 0:
                    found = k + 1
                    break
            end = found or end
        else:
            end = len(payload)
        out.append(payload[start:end])
        start = end
    return out


def test_op3(spark, folder, texts):
    got = {r["doc_id"]: r for r in media.op3(spark, folder).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        raw = (t or "").encode()
        payload = raw + b" " * ((-len(raw)) % 192 if raw else 192)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        chunks = chunks_of(payload)
        frames = [zstandard.ZstdCompressor(level=6).compress(c) for c in chunks]
        form = b"CDC1" + struct.pack("<QI", len(payload), len(chunks)) + b"".join(hashlib.sha256(c).digest() + struct.pack("<I", len(c)) for c in chunks) + b"".join(frames)
        assert (r["media_bytes"], r["media_sha256"]) == (len(form), hashlib.sha256(form).hexdigest())
        x = [b - 128 for b in payload]
        crossings = sum((a < -28) != (b < -28) for a, b in zip(x, x[1:], strict=False))
        assert r["feature"] == f"sum={sum(x)};energy={sum(v * v for v in x)};crossings={crossings};peak={max(map(abs, x))}"


def multiset_hash(text):
    """Sums lane by lane, with plain integers."""
    cut, parts = "", []
    for k, c in enumerate(text):
        if c == "\n" or c in " \t" and k and text[k - 1] in ".!?":
            parts.append(cut)
            cut = ""
        else:
            cut += c
    parts = [p.strip() for p in [*parts, cut] if p.strip()]
    wide, levels, lanes = fingerprints.WIDE, fingerprints.LEVELS, fingerprints.LANES
    dense, small = [0] * wide, [[0] * lanes for _ in range(levels)]
    for p in parts:
        d = hashlib.blake2b(p.encode(), digest_size=4 * wide + 4 + 2 * levels).digest()
        for k in range(wide):
            dense[k] = (dense[k] + int.from_bytes(d[4 * k : 4 * k + 4], "little")) % 2**32
        chance = int.from_bytes(d[4 * wide : 4 * wide + 4], "little")
        for level in range(levels):
            if level == 0 or chance < 2**32 // 4**level:
                at, by = d[4 * wide + 4 + 2 * level], d[4 * wide + 5 + 2 * level]
                small[level][at % lanes] = (small[level][at % lanes] + (by | 1)) % 256
    return len(parts), (struct.pack("<I", len(parts)) + struct.pack(f"<{wide}I", *dense) + bytes(v for row in small for v in row)).hex()


def most_likely(a, b, n1, n2):
    """The difference that makes the lanes' equality most likely, number by number."""
    if a == b:
        return 1.0
    x, y = (bytes.fromhex(v)[4 + 4 * fingerprints.WIDE :] for v in (a, b))
    lanes, best = fingerprints.LANES, None
    same = [sum(x[k] == y[k] for k in range(lanes * level, lanes * (level + 1))) for level in range(fingerprints.LEVELS)]
    for d in sorted({*range(1, 65), *(round(64 * 1.015**k) for k in range(1260))}):
        chance = 0.0
        for level, s in enumerate(same):
            touched = -math.expm1(d * math.log1p(-(4.0**-level) / lanes))
            chance += s * math.log(1 - touched * 127 / 128) + (lanes - s) * math.log(touched * 127 / 128)
        if best is None or chance > best[0]:
            best = chance, d
    return min(1.0, max(0.0, 1.0 - max(best[1], abs(n1 - n2)) / max(n1 + n2, 1)))


def test_op7(spark, folder, texts):
    got = {r["doc_id"]: r for r in fingerprints.op7(spark, folder).collect()}
    order = sorted(texts, reverse=True)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        other = t[: len(t) - n] + following[:n]
        (n1, own), (n2, changed), (n3, beside) = multiset_hash(t), multiset_hash(other), multiset_hash(following)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(other.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, changed)
        assert r["near_edited"] == pytest.approx(most_likely(own, changed, n1, n2)) and r["near_next"] == pytest.approx(most_likely(own, beside, n1, n3))


def test_op8_scores_what_it_was_fitted_on(spark):
    """From the features to the logit by a double loop, bounds included, also for features far beyond them."""
    docs, labels, _ = labelled(spark, 300)
    m = quality.fit(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(25).collect()] + [(1000, "|" * 5000), (1001, " | " * 900), (1002, "Q" * 3000 + "!! !!"), (1003, None)]
    got = {r["doc_id"]: r["score"] for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string"), m).collect()}
    beyond = 0
    for i, t in rows:
        x = quality.features(t or "").astype(float)
        raw = [(float(x[k]) - float(m.mean[k])) * float(m.scale[k]) for k in range(len(x))]
        z = [min(5.0, max(-5.0, v)) for v in raw]
        beyond += z != raw
        logit = m.bias + sum(m.linear[k] * z[k] for k in range(len(z)))
        for a in range(len(z)):
            if z[a]:
                logit += sum(float(np.dot(m.factors[a], m.factors[b])) * z[a] * z[b] for b in range(a) if z[b])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-min(30, max(-30, logit)))), abs=1e-9)
    assert beyond >= 2


def test_one_word_hash_that_collides_removes_nothing(spark, monkeypatch):
    """Words that one hash function confuses are told apart by the other."""
    h = np.arange(60, dtype=np.uint64)
    words = [b"w%d" % k for k in range(60)]
    monkeypatch.setattr(substring_dedup, "word_hashes", lambda ws: h[: len(ws)].copy())
    one = substring_dedup.gram_hashes(substring_dedup.word_hashes(words), 50)
    two = substring_dedup.gram_hashes(substring_dedup.word_hashes([b"x" + v for v in words]), 50)
    assert (one == two).all()
    a, b = (substring_dedup.gram_hashes(substring_dedup.other_word_hashes(ws), 50) for ws in (words, [b"x" + v for v in words]))
    assert (a != b).all()


def odd(spark):
    rng = random.Random(6)
    words = vocabulary(rng, 300)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = prose(120)
    rows = [(1, None), (2, ""), (3, " \n "), (4, prose(30000)), (5, base), (5, base), (6, base), (None, base), (None, None), (7, base + " end"), (8, prose(60)), (8, prose(61))]
    rows += [(20 + k, prose(40) + " " + base[:500]) for k in range(12)]
    extra = (9, "x", 1.5, 3, 4, "c", 5, True)
    return spark.createDataFrame([(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), *extra) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, tkey long, gone_id string, times double, n_copies int, t_id int, spans string, copy int, swap boolean")


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_of_odd_rows(spark, tmp_path, stage):
    docs = odd(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.STAGES[stage][1](spark, docs, str(tmp_path))
    assert out.dtypes == docs.dtypes
    before, after = (Counter((r["doc_id"], r["source"], r["text"], r["gone_id"], r["t_id"]) for r in d.collect()) for d in (docs, out))
    if stage == 0:
        assert not after  # without labels every score is 0.5
    elif stage == 1:
        kept = Counter(r["doc_id"] for r in near_dedup.classify(docs).where("kept").collect())
        assert Counter(k[0] for k in after.elements()) == kept and not after - before
    elif stage == 2:
        assert Counter(k[0] for k in after.elements()) == Counter(k[0] for k in before.elements())
        assert {k[2] for k in after if k[0] == 1} == {None} and {k[2] for k in after if k[0] == 3} == {" \n "}
    else:
        taken = Counter()
        for r in mixing.copies(docs).collect():
            taken[r["doc_id"]] += r["n_copies"]
        assert Counter(k[0] for k in after.elements()) == +taken and set(after) <= set(before)


def test_grown_shards_are_those_of_one_more_weight(spark):
    ids = spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")
    both = sharding.shard(ids, (1.0,) * 7).select("doc_id", "grown_shard").join(sharding.shard(ids, (1.0,) * 8).select("doc_id", "shard"), "doc_id")
    assert both.where("grown_shard != shard").count() == 0 and both.count() == 3000
