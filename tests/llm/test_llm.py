"""Every operator against brute force on small tables with nulls, empty, long and repeated texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from corpusloom.llm import bpe, fingerprints, media, mixing, near_dedup, quality, sharding, substring_dedup, token_counts, url_filter
from corpusloom.llm.pretokens import Splitter

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, bucket string, n int, u double, anchor string, h1 long, tkey long, block int, shard int"
EXTRA = (7, "b", 8, 0.5, "a", 1, 2, 3, 4)


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdeésñ") for _ in range(rng.randint(1, 9))) for _ in range(n)]


def sample_texts(seed=1):
    rng = random.Random(seed)
    words = vocabulary(rng)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = prose(70), prose(200)
    texts = [None, "", " \t\n", "one", "<|endoftext|>", "a<|endoftext|> b", "漢字 text 🙂\u00a0 x\u0085y\x1c z", "x" * 30000, "é" * 5000, " ".join(["be"] * 300)]
    texts += [base, base, base]
    for k in range(8):
        w = base.split(" ")
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [prose(40) + " " + passage + "\n" + prose(30) for _ in range(4)]
    texts += [prose(rng.randint(5, 150)) + ".\n" + prose(20) for _ in range(25)]
    texts.append(prose(20000))
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = sample_texts()
    out = [(i * 3 - 6, t, "en", None if i % 9 == 0 else f"s{i % 4}", len(t or ""), *EXTRA) for i, t in enumerate(texts)]
    return [*out, out[12], (None, "no id here", None, "s1", 10, *EXTRA), (None, None, None, None, None, *EXTRA)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def multiset(values):
    return Counter(values)


# 1 and 9: tokens


def test_token_counts(docs, rows, library):
    got = multiset((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs).collect())
    assert got == multiset((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)


def test_token_counts_over_many_blocks(docs, rows, library, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_DOCS", 3)
    monkeypatch.setattr(token_counts, "CACHE", 5)
    splitter, library_counts = Splitter(PATH), []
    block = token_counts._Block()
    for r in rows[:9]:
        block.add(r[0], r[1] or "", splitter)
        library_counts.append(len(library.encode(r[1] or "", add_special_tokens=False).ids))
    parts = [token_counts._unpack(body) for _, body in block.rows(5)]
    special = parts[0][3]
    total = special.copy()
    for _, sizes, words, times, doc, freq in parts[1:]:
        ends = np.cumsum(sizes, dtype=np.int64)
        names = [words[b - s : b].decode() for b, s in zip(ends, sizes, strict=True)]
        pieces = np.repeat([len(library.encode(n, add_special_tokens=False).ids) for n in names], times)
        np.add.at(total, doc, pieces * freq.astype(np.int64))
    assert total.tolist() == library_counts


def test_codec(docs, rows, library):
    got = multiset(tuple(r) for r in bpe.round_trip(docs).collect())
    expected = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == multiset(expected)


def test_decode_gives_texts_back(docs, rows):
    got = multiset(tuple(r) for r in bpe.decode(bpe.encode(docs)).collect())
    assert got == multiset((r[0], r[1] or "") for r in rows)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(alphabet="ab 'stdré\n\t漢🙂<|endoftext|>0१", max_size=60))
def test_codec_equals_the_library(library, text):
    codec = bpe.codec(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids and codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pieces_join_to_the_text():
    s = Splitter(PATH)
    for t in ["a  b\n\n c's 12", "x\u0301 y", " "]:
        assert "".join(s.pieces(t)) == t


# 2: URLs

URLS = [None, "", "nothing", "http://net/", "http://a.net", "HTTP://WWW.Example.NET/en/x?y#z", "https://example.net/fr/", "https://example.net/en", "x://m.example.com/de/1", "https://example.com/d", "https://o.org/fr/q", "https://notnet/", "http://org/fr/", "http://a.b.c.example.net/en/", "a://b://c/d", "https://x.net:80/", "https://x.net?/y", "https://net./", "https://.net/", "http://a.net\n/x", "http://u/" + "a/" * 3000]


def judged(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


@pytest.mark.parametrize("limit", [100_000, 0])
def test_url_filter(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    rules = [*url_filter.RULES, ("example.com", "/d", "allow"), ("net", "", "allow"), ("com", "/de/1", "block"), ("a.b.c.example.net", "/en/", "block")]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(3, URLS[3], "y"), (None, URLS[3], "z")], "page_id long, url string, host string")
    for given_rules in (url_filter.RULES, rules):
        got = multiset(tuple(r) for r in url_filter.judge(pages, url_filter.rule_table(spark, given_rules)).collect())
        assert got == multiset((i, *judged(u, given_rules)) for i, u in [*enumerate(URLS), (3, URLS[3]), (None, URLS[3])])
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, url_filter.rule_table(spark).limit(0), default="block").collect()} == {"block"}


# 3: media


def test_media(docs, rows):
    got = {}
    out = media.read_back(media.chunk_lists(docs), media.chunk_store(docs)).collect()
    assert len(out) == len(rows)
    expected = []
    for r in rows:
        n, payload = media.payload_of(r[1] or "")
        assert len(payload) % 192 == 0 and payload and payload.rstrip(b" ") == (r[1] or "").encode().rstrip(b" ")
        expected.append((r[0], n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), media.features(payload)))
    assert multiset((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["feature"]) for r in out) == multiset(expected)
    for r in out:
        assert got.setdefault(r["payload_sha256"], (r["media_bytes"], r["media_sha256"], r["feature"])) == (r["media_bytes"], r["media_sha256"], r["feature"])


def test_cuts_follow_the_content():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 300_000, np.uint8).tobytes()
    ends = media.cuts(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes[:-1].min() >= media.SHORTEST and sizes.max() <= media.LONGEST and len(ends) > 15
    moved = media.cuts(b"inserted" + data)
    assert len({len(data) - e for e in ends} & {len(data) + 8 - e for e in moved}) >= len(ends) - 3
    h, expected = 0, []
    for i, b in enumerate(data[:5000]):
        h = ((h << 1) + int(media.GEAR[b])) % 2**32
        if h >> (32 - media.MASK_BITS) == 0:
            expected.append(i + 1)
    assert media.cuts(data[:5000])[0] == next((e for e in expected if e >= media.SHORTEST), 5000)


def test_damage_is_seen(docs):
    with pytest.raises(ValueError):
        media.open_frame(b"x", None)
    with pytest.raises(Exception, match="is missing"):
        media.read_back(media.chunk_lists(docs), media.chunk_store(docs).limit(1)).collect()


# 4: mixing


def test_targets(spark):
    sizes = [("a", 100), ("a", 50), ("b", 40), ("c", 1000), ("d", 10), (None, 5)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    per = {"a": 150, "b": 40, "c": 1000, "d": 10, None: 5}
    weight = {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0, None: 2.0}
    left, open_, expected = 1.5 * sum(per.values()), set(per), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * per[s]}
        if not full:
            expected |= {s: level * weight[s] for s in open_}
            break
        expected |= {s: 2.0 * per[s] for s in full}
        left -= sum(expected[s] for s in full)
        open_ -= full
    assert got == pytest.approx(expected)


def test_mixture(docs, rows):
    out = mixing.copies(docs).collect()
    assert multiset((r["doc_id"], r["size"]) for r in out) == multiset((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    assert all(0 <= r["n_copies"] <= 2 for r in out)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.copies(docs.repartition(5)).collect()), key=str)
    for s in {r["source"] for r in out}:
        own = [r for r in out if r["source"] == s]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["n_copies"] * r["size"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)


def test_mixture_is_near_its_targets_at_size(spark):
    rng = random.Random(2)
    many = spark.createDataFrame([(i, "w " * rng.randint(1, 300), f"s{i % 3 if i % 2 else 0}") for i in range(3000)], "doc_id long, text string, source string")
    out = mixing.copies(many).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("n_copies") * F.col("size")).alias("k")).collect()
    assert all(abs(r["k"] - r["t"]) < 0.01 * r["t"] for r in out)


def test_mix_keeps_columns(docs):
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == mixing.copies(docs).agg(F.sum("n_copies")).first()[0]


# 5: substring dedup


def cut_by_brute_force(rows, length):
    first = {}
    for i, t in sorted((r[0], r[1]) for r in rows if r[0] is not None and r[1]):
        w = WORD.findall(t)
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = []
    for i, t in ((r[0], r[1]) for r in rows):
        w = WORD.findall(t or "")
        keep = [True] * len(w)
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                keep[k : k + length] = [False] * length
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return multiset(out)


@pytest.mark.parametrize("length", [50, 20, 5])
def test_substring_dedup(docs, rows, length):
    assert multiset(tuple(r) for r in substring_dedup.digest_kept(docs, length).collect()) == cut_by_brute_force(rows, length)


def test_passages_without_an_owner(spark):
    """Windows whose anchor's owner has other words around it, and a hot passage in salted shards."""
    rng = random.Random(8)
    w = vocabulary(rng, 3000)
    prose = lambda n: " ".join(rng.choice(w) for _ in range(n))
    core, wider = prose(22), prose(70)
    texts = [prose(30) + " " + core + " " + prose(30) for _ in range(6)]
    shared = prose(15) + " " + core + " " + prose(25)
    texts += [prose(10) + " " + shared + " " + prose(9) for _ in range(5)] + [prose(5) + " " + wider + " " + prose(rng.randint(1, 9)) for _ in range(600)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    got = substring_dedup.digest_kept(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert multiset(map(tuple, got)) == cut_by_brute_force(rows, 50)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), max_size=4), st.lists(st.sampled_from("abc"), max_size=30), st.integers(1, 6))
def test_automaton(references, query, least):
    a = substring_dedup.SuffixAutomaton()
    for r in references:
        a.add(r)
    have = {tuple(r[k : k + least]) for r in references for k in range(len(r) - least + 1)}
    assert a.matched(query, least) == [k for k in range(len(query) - least + 1) if tuple(query[k : k + least]) in have]


def test_stretches_leave_in_portions():
    words = [f"w{k % 90}" for k in range(300)]
    anchors = np.unique(substring_dedup.window_anchors(substring_dedup.word_hashes([w.encode() for w in words]), 50))
    listed = [{"anchor": int(a), "owner": 1 if k % 2 else 5, "docs": 40 * (k % 3) + 2} for k, a in enumerate(anchors)]
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("owner", pa.int64()), ("docs", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([9]), pa.array([" ".join(words)]), pa.array([listed], kind)], ["doc_id", "tkey", "text", "listed"])
    whole, portions = ([b.to_pylist() for b in substring_dedup._stretches(50, size)(iter([batch]))] for size in (10**9, 10))
    assert len(whole) == 1 and len(portions) > 3 and sum(portions, []) == whole[0]


def test_remove_repeats(docs, rows):
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    words = multiset((r[0], n, hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest()) for r, t, n in ((r, r["text"] or "", len(WORD.findall(r["text"] or ""))) for r in out.collect()))
    assert words == multiset((i, n - k, h) for (i, n, k, h), c in cut_by_brute_force(rows, 50).items() for _ in range(c))


# 6: near duplicates


def linked(rows, size, percent):
    sets = {}
    for k, (i, t) in enumerate((r[0], r[1]) for r in rows):
        w = [x.encode().lower() for x in WORD.findall(t or "")]
        sets[k] = (i, {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (i, s) in sets.items():
        for b, (j, t) in sets.items():
            if a < b and i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                root[find(a)] = find(b)
    out = []
    for k, (i, s) in sets.items():
        c = None if i is None else min(sets[m][0] for m in sets if find(m) == find(k)) if s else i
        out.append((i, len(s), c, c is None or c == i))
    return multiset(out)


@pytest.mark.parametrize("size,percent", [(2, 80), (5, 80), (1, 60)])
def test_near_dedup(docs, rows, size, percent):
    got = multiset((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.classify(docs, size=size, percent=percent).collect())
    assert got == linked(rows, size, percent)


def test_a_group_with_a_common_original(spark):
    rng = random.Random(4)
    w = vocabulary(rng, 900)
    base = [rng.choice(w) for _ in range(150)]
    rows = [(1, " ".join(base))]
    for i in range(2, 150):
        copy = list(base)
        for k in rng.sample(range(150), rng.randint(1, 7)):
            copy[k] = rng.choice(w)
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(rng.choice(w) for _ in range(150))) for i in range(60)]
    got = near_dedup.classify(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert multiset((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == linked(rows, 2, 80)


def test_a_group_over_many_batches_finds_its_original(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(5000, " ".join(base))]
    for i in range(1500):
        copy = list(base)
        for k in rng.sample(range(1, 119, 2), 6):
            copy[k] = f"x{i}_{k}"
        rows.append((i, " ".join(copy)))
    classes = spark.createDataFrame([(i, 0, near_dedup.signature(near_dedup.shingles(t, 2)).tobytes()) for i, t in rows], "doc_id long, tkey long, sig binary")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        met = near_dedup.candidates(classes, 80).where("a.id = 5000 OR b.id = 5000").count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert met == 1500


def crowded_classes(spark):
    """Distinct near copies around one original, pairs, and unrelated texts."""
    rng = random.Random(15)
    base = [f"w{k}" for k in range(120)]
    rows = [(5000, " ".join(base))]
    for i in range(400):
        copy = list(base)
        for k in rng.sample(range(1, 119, 2), rng.randint(1, 6)):
            copy[k] = f"x{i}_{k}"
        rows.append((i, " ".join(copy)))
    for i in range(600, 800, 2):
        words = [f"u{rng.randrange(3000)}" for _ in range(90)]
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:85], "other", "end"]))]
    return spark.createDataFrame([(i, 0, near_dedup.signature(near_dedup.shingles(t, 2)).tobytes()) for i, t in rows], "doc_id long, tkey long, sig binary")


def test_candidates_do_not_depend_on_the_layout(spark):
    classes, found = crowded_classes(spark), []
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, batch in ((1, 10_000), (8, 10_000), (8, 100), (64, 10_000), (211, 37)):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
            found.append({(r["a"]["id"], r["b"]["id"], r["score"]) for r in near_dedup.candidates(classes, 80).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found[0]) > 1000 and all(f == found[0] for f in found[1:])
    assert {(i, i + 1) for i in range(600, 800, 2)} <= {f[:2] for f in found[0]} and {i for i in range(400)} <= {a for a, b, _ in found[0] if b == 5000}


@pytest.mark.parametrize("common", [0, 50_000])
def test_crowds_need_no_candidates(spark, monkeypatch, common):
    """Texts around a shared passage, some with near copies: all links are found without a single pair from the sorted orders."""
    rng = random.Random(16)
    w = vocabulary(rng, 2000)
    passage, rows = [rng.choice(w) for _ in range(120)], []
    for i in range(90):
        own = passage + [rng.choice(w) for _ in range(rng.randint(10, 60))]
        rows.append((2 * i, " ".join(own)))
        if i % 3 == 0:
            own[rng.randrange(len(own))] = "other"
            rows.append((2 * i + 1, " ".join([*own, "end"])))
    whole = near_dedup.pairs_and_crowd
    monkeypatch.setattr(near_dedup, "pairs_and_crowd", lambda *a: (whole(*a)[0].where("false"), whole(*a)[1]))
    monkeypatch.setattr(near_dedup, "COMMON", common)
    got = near_dedup.classify(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert multiset((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == linked(rows, 2, 80)


def test_links_need_neither_candidates_nor_crowds(spark, monkeypatch):
    """Near copies outside any crowd are found without a single pair from the sorted orders."""
    rng = random.Random(21)
    w = vocabulary(rng, 3000)
    rows = []
    for i in range(60):
        own = [rng.choice(w) for _ in range(rng.randint(3, 90))]
        rows.append((3 * i, " ".join(own)))
        if i % 2 == 0:
            rows.append((3 * i + 1, " ".join([*own, "end"])))
            rows.append((3 * i + 2, " ".join([own[0], *own, "end", "of", "it"])))
    whole = near_dedup.pairs_and_crowd
    monkeypatch.setattr(near_dedup, "pairs_and_crowd", lambda *a: tuple(x.where("false") for x in whole(*a)))
    got = near_dedup.classify(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    want = linked(rows, 2, 80)
    assert multiset((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    assert sum(not r["kept"] for r in got) > 30


@pytest.mark.parametrize("at_once", [2**22, 3])
def test_packed_postings_and_pairs_of_a_shingle(monkeypatch, at_once):
    monkeypatch.setattr(near_dedup, "AT_ONCE", at_once)
    rng = np.random.default_rng(22)
    n = 400
    num = np.sort(rng.integers(0, 2**40, n))
    rows = {"h": rng.integers(0, 40, n), "num": num, "label": np.where(rng.random(n) < 0.5, num, num[0]), "n": rng.integers(8, 12, n), "place": rng.integers(0, 3, n)}
    back = near_dedup._unpack([near_dedup._pack({c: x[a:b] for c, x in rows.items()}) for a, b in ((0, 150), (150, n))])
    assert all((back[c] == x).all() for c, x in rows.items())
    place = {k: (rows["n"][k], rows["place"][k]) for k in range(n)}

    def early(i, j):
        (a, p), (b, q) = place[i], place[j]
        overlap = -(-(a + b) * 80 // 180)
        return 100 * min(a, b) >= 80 * max(a, b) and p <= a - overlap and q <= b - overlap

    want = {(int(num[i]), int(num[j])) for i in range(n) for j in range(i + 1, n) if rows["h"][i] == rows["h"][j] and rows["label"][i] != rows["label"][j] and early(i, j)}
    got = {(x, y) for a, b in near_dedup._cross(back, 80) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == want and want


@pytest.mark.parametrize("few", [100_000, 20, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(near_dedup, "FEW_EDGES", few)
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(400, 480)]
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame([((a, 0), (b, 0)) for a, b in edges], "a struct<id:long,key:long>, b struct<id:long,key:long>")
    assert {r["node"]["id"]: r["label"]["id"] for r in near_dedup.components(df).collect()} == {k: find(k) for k in root if find(k) != k}


def test_keep_one(docs):
    out = near_dedup.keep_one(docs, size=2)
    assert out.columns == docs.columns and out.count() == near_dedup.classify(docs, size=2).where("kept").count()


# 7: fingerprints


def test_fingerprints(docs, rows):
    got = fingerprints.compare_with_next(docs).collect()
    order = sorted((r[:2] for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    groups = {}
    for i, t in order:
        groups.setdefault(i, []).append(t or "")
    assert multiset((r["doc_id"], r["n_chars"]) for r in got) == multiset((i, len(t or "")) for i, t in order)
    single = [i for i, ts in groups.items() if i is not None and len(ts) == 1]
    ids = list(groups)
    by_id = {r["doc_id"]: r for r in got}
    for i in single:
        following = groups[ids[(ids.index(i) + 1) % len(ids)]]
        t, r = groups[i][0], by_id[i]
        options = {hashlib.sha256(fingerprints.edited(t, f).encode()).hexdigest(): f for f in following}
        assert r["edited_sha256"] in options and r["fingerprint"] == fingerprints.fingerprint(t).hex()
        assert r["near_next"] in {fingerprints.likeness(fingerprints.fingerprint(t), fingerprints.fingerprint(f)) for f in following}
    last = next(r for r in got if r["doc_id"] is None)
    assert last["n_chars"] in (0, 10)


def test_a_single_document(spark):
    r = fingerprints.compare_with_next(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and r["near_next"] == 1.0


def test_multiset_hash():
    rng = random.Random(9)
    lines = [" ".join(rng.choice(vocabulary(rng, 50)) for _ in range(6)) for _ in range(60)]
    whole = fingerprints.fingerprint("\n".join(lines))
    shuffled = lines[:]
    rng.shuffle(shuffled)
    assert fingerprints.fingerprint("\n".join(shuffled)) == whole
    part, rest = fingerprints.fingerprint("\n".join(lines[:45])), fingerprints.fingerprint("\n".join(lines[45:]))
    assert fingerprints.combine(part, rest) == whole and fingerprints.combine(whole, rest, -1) == part
    other = fingerprints.fingerprint("\n".join(f"other {k} line" for k in range(60)))
    assert fingerprints.likeness(whole, whole) == 1.0 and fingerprints.likeness(whole, part) > 0.6 > 0.3 > fingerprints.likeness(whole, other)


@pytest.mark.parametrize("n1,n2", [(500, 500), (10_000, 10_000), (20_000, 50), (50_000, 50_000)])
def test_likeness_of_unrelated_texts(n1, n2):
    a, b = (fingerprints.fingerprint("\n".join(f"{name} {k}" for k in range(n))) for name, n in (("one", n1), ("two", n2)))
    assert fingerprints.likeness(a, b) < 0.3


def test_likeness_of_long_texts():
    lines = [f"line {k}" for k in range(50_000)]
    a, b = fingerprints.fingerprint("\n".join(lines)), fingerprints.fingerprint("\n".join(lines[:40_000] + [f"new {k}" for k in range(10_000)]))
    assert abs(fingerprints.likeness(a, b) - 0.8) < 0.1


# 8: quality


def test_machine_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=12), rng.normal(size=(12, 4)), np.zeros(12), np.ones(12))
    x = rng.normal(size=(5, 12)) * 0.3
    slow = [0.3 + r @ m.linear + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(12) for j in range(i)) for r in x]
    assert m.score(x) == pytest.approx(1 / (1 + np.exp(-np.array(slow))))


def labelled(spark, n=400):
    rng = random.Random(12)
    words = vocabulary(rng, 300)
    good = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(20, 120))).capitalize() + "."
    bad = lambda: rng.choice([lambda: " ".join(f"{w.upper()}!!" for w in rng.choices(words, k=60)), lambda: " ".join([rng.choice(words)] * 80), lambda: " ".join(w + "###" for w in rng.choices(words, k=70))])()
    y = [int(rng.random() < 0.7) for _ in range(n)]
    docs = spark.createDataFrame([(i, good() if v else bad()) for i, v in enumerate(y)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, v, 0) for i, v in enumerate(y)], "doc_id long, quality int, toxic int"), y


def test_quality(spark):
    docs, labels, y = labelled(spark)
    out = {r["doc_id"]: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in out if out[i]["held_out"]} == set(held) and len(held) > 50
    assert sum(out[i]["predicted"] == y[i] for i in held) / len(held) > 0.97
    assert all(out[i]["predicted"] == int(out[i]["score"] >= 0.7) for i in out)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(docs, flipped)).collect()}
    assert again == {i: r["score"] for i, r in out.items()}
    assert quality.keep_good(docs, quality.fit(docs, labels)).count() == sum(r["predicted"] for r in out.values())


def test_quality_of_odd_rows(docs, rows, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, none)).collect()
    assert len(got) == len(rows) and {r["score"] for r in got} == {0.5}
    _, labels, _ = labelled(spark)
    m = quality.fit(docs, labels)
    scores = {}
    texts = {(r[0], r[1]) for r in rows}
    for r in quality.score(docs, m).collect():
        assert 0 <= r["score"] <= 1
        scores.setdefault(r["doc_id"], r["score"])
    same = [i for i, t in texts if t and t == rows[10][1]]
    assert len({scores[i] for i in same}) == 1


# 10: sharding


def test_sharding(docs, rows):
    got = sharding.shard(docs).collect()
    assert multiset((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == multiset((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)


def test_weighted_shards(spark):
    ids = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = {r["shard"]: r["count"] for r in sharding.shard(ids, (1.0, 2.0, 1.0)).groupBy("shard").count().collect()}
    assert got[1] == pytest.approx(10000, rel=0.05) and got[0] == pytest.approx(5000, rel=0.07)
    moved = sharding.shard(ids, (1.0,) * 9).where("grown_shard != shard")
    assert moved.where("grown_shard != 9").count() == 0 and moved.count() == pytest.approx(2000, rel=0.1)


# empty tables


@pytest.mark.parametrize("run", [
    lambda d: token_counts.count_tokens(d), lambda d: bpe.round_trip(d), lambda d: media.read_back(media.chunk_lists(d), media.chunk_store(d)), lambda d: mixing.copies(d), lambda d: mixing.mix(d),
    lambda d: substring_dedup.digest_kept(d), lambda d: near_dedup.classify(d), lambda d: fingerprints.compare_with_next(d), lambda d: sharding.shard(d),
    lambda d: quality.score(d, quality.fit(d, d.select("doc_id", F.lit(1).alias("quality")))),
])
def test_empty(empty, run):
    assert run(empty).count() == 0
