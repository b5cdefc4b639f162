import random

import pytest
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.config import Export, Quality, Voice
from corpusloom.functions import text as T
from corpusloom.operators import assign, candidates, checks, curate, manifest, reports, review, sample, signals
from corpusloom.schemas import AUDIO, DATASET, QUALITY, REVIEWED, with_seq


def clip(i, seq, *, text="some text", status="ok", voice="v", category="c"):
    return (i, i[:1], text, category, "edge", voice, "female", "d", f"data/audio/{i}.wav", 1.5, 16000, status, None, seq)


def audio(spark, *rows):
    return spark.createDataFrame(list(rows), with_seq(AUDIO))


def quality(spark, *rows):
    """(id, status, flags, cer) in log order."""
    return spark.createDataFrame([(i, i[:1], "p", 1.0, "heard", c, c, 9.0, f, s, None, n) for n, (i, s, f, c) in enumerate(rows)], with_seq(QUALITY))


def reviews(spark, *rows):
    return spark.createDataFrame([(i, d, t, None, n) for n, (i, d, t) in enumerate(rows)], with_seq(REVIEWED))


@pytest.fixture(scope="module")
def tiny(spark):
    return (
        audio(spark, clip("a", 0), clip("b", 1), clip("c", 2)),
        quality(spark, ("a", "ok", [], 0.1), ("b", "flagged", ["high_cer"], 0.6), ("c", "flagged", ["too_slow"], 0.2)),
        reviews(spark, ("a", "accept", "some text"), ("b", "reject", None), ("c", "edit", "better")),
    )


def exported(parts, **rules):
    e = Export(**rules)
    rows = curate.joined(*parts, e)
    return {r["id"]: r for r in curate.export_rows(rows, e).collect()}, {r["skip_reason"]: r["n"] for r in curate.skip_counts(rows).collect()}


def test_export_gates(tiny):
    rows, skipped = exported(tiny)
    assert set(rows) == {"a", "c"} and rows["c"]["text"] == "better" and rows["c"]["original_prompt"] == "some text" and skipped == {"rejected": 1}
    rows, skipped = exported(tiny, include_rejected=True)
    assert set(rows) == {"a", "b", "c"} and skipped == {}


def test_unreviewed_is_skipped(spark, tiny):
    a, q, r = tiny
    rows, skipped = exported((a.union(audio(spark, clip("d", 3))), q, r))
    assert "d" not in rows and skipped == {"rejected": 1, "unreviewed": 1}


def test_export_edges(spark):
    a = audio(spark, clip("a", 0), clip("b", 1), clip("c", 2), clip("d", 3), clip("e", 4), clip("d", 5, status="failed"))
    q = quality(spark, ("a", "flagged", ["x"], 0.1), ("b", "error", ["missing_audio"], None), ("e", None, None, None))
    r = reviews(spark, ("a", "accept", None), ("b", "accept", ""), ("c", "reject", None), ("c", "edit", "last"), ("d", "accept", None), ("e", "accept", None))
    rows, skipped = exported((a, q, r))
    assert skipped == {"flagged_accept_only": 1} and set(rows) == {"b", "c", "d", "e"}
    assert rows["b"]["text"] == "some text" and rows["c"]["text"] == "last"
    assert rows["c"]["auto_flags"] == [] and rows["e"]["auto_flags"] is None and rows["c"]["auto_status"] is None
    assert [r["id"] for r in sorted(rows.values(), key=lambda r: r["first_seq"])] == ["b", "c", "d", "e"]
    assert "a" in exported((a, q, r), include_flagged=True)[0]


def test_typed_export(tiny):
    e = Export()
    t = curate.typed(curate.export_rows(curate.joined(*tiny, e), e))
    assert checks.schema_differences(t, DATASET) == [] and t.where("id = 'a'").first()["audio"] == "audio/a.wav"
    assert checks.schema_differences(t.drop("audio"), DATASET) == ["audio: missing for string"]


def test_latest_and_resume(spark):
    log = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("a", None, 2)], "id string, v int, seq long")
    assert {r["id"]: (r["v"], r["seq"], r["first_seq"]) for r in manifest.latest_by(log).collect()} == {"a": (None, 2, 0), "b": (2, 1, 1)}
    a = audio(spark, clip("a", 0), clip("b", 1, status="failed"))
    assert [r["id"] for r in manifest.synthesis_pending(a, a).collect()] == ["b"]
    assert manifest.quality_pending(a, quality(spark, ("a", "error", [], None))).count() == 0
    assert manifest.latest_by(log.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 500])
def test_positions(spark, n):
    keys = random.Random(n).sample(range(-(10**12), 10**12), n)
    got = manifest.positions(spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()
    assert {r["k"]: r["position"] for r in got} == {k: i for i, k in enumerate(sorted(keys))}


def test_counted(spark):
    df = spark.createDataFrame([("x", 0), ("y", 1), ("y", 2), ("z", 3)], "k string, seq long")
    assert [r["k"] for r in manifest.counted(df, "k").orderBy("place").collect()] == ["y", "x", "z"]


def test_reasons(spark):
    good = "انا رايح البيت دلوقتي"
    given = [good, "كلمة واحدة", " ".join(["كلمة"] * 26), "this is only english text", " " + good + " ", "\U0001f600 \U0001f680", "ابعتلي الـ link على الواتساب"]
    rows = spark.createDataFrame([(i, t, "c") for i, t in enumerate(given)], "seq long, text string, category string")
    got = {r["seq"]: r["reason"] for r in candidates.validated(rows).collect()}
    assert got == {0: "", 1: "too_short_2w", 2: "too_long_26w", 3: "not_arabic_enough", 4: "duplicate", 5: "empty_after_cleaning", 6: ""}
    known = rows.limit(1).select(T.text_hash(T.clean(F.col("text"))).alias("hash"))
    assert candidates.validated(rows, known).where("seq = 0").first()["reason"] == "duplicate"
    assert {r["reason"] for r in candidates.reason_counts(candidates.validated(rows)).collect()} == {v for v in got.values() if v}


@pytest.mark.parametrize("have,expected", [({}, {"a": 50, "b": 50}), ({"a": 20}, {"a": 30, "b": 50}), ({"a": 50, "b": 49}, {"b": 1}), ({"a": 60, "b": 50}, {})])
def test_plan(spark, have, expected):
    plan = candidates.targets(spark.createDataFrame([("a", 0.5), ("b", 0.5)], "category string, proportion double"), 100)
    existing = spark.createDataFrame([(c,) for c, n in have.items() for _ in range(n)], "category string")
    missing = candidates.deficits(plan, existing)
    assert {r["category"]: r["deficit"] for r in missing.collect()} == expected
    one = candidates.next_category(missing).first()
    assert (one is None) == (not expected) and (one is None or one["batch_n"] == min(15, one["deficit"] + 5))


def test_targets_round_halves_to_even(spark):
    t = candidates.targets(spark.createDataFrame([("a", 0.125), ("b", 0.375)], "category string, proportion double"), 100)
    assert {r["category"]: r["target"] for r in t.collect()} == {"a": 12, "b": 38}


def test_quota(spark):
    valid = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 20 + i) for i in range(3)] + [("c", 40)], "category string, seq long")
    missing = spark.createDataFrame([("a", 2), ("b", 5)], "category string, deficit int")
    assert sorted(r["seq"] for r in candidates.within_quota(valid, missing).collect()) == [0, 1, 20, 21, 22]


def test_round_robin(spark):
    voices = (Voice("edge", "x/1", "f", "d"), Voice("edge", "x:2", "m", "d"), Voice("gtts", "ar", "u", "d"))
    assert voices[0].slug == "edge-x_1" and len({v.slug for v in voices}) == 3 and len({*voices}) == 3
    prompts = spark.createDataFrame([(f"p{i}", i * 7, "t", "c") for i in range(7)], "id string, seq long, text string, category string")
    got = assign.round_robin(prompts, config.voice_table(spark, voices)).orderBy("seq").collect()
    assert [r["voice_id"] for r in got] == [voices[i % 3].voice_id for i in range(7)] and got[1]["sample_id"] == "p1_edge-x_2"


def test_signals(spark):
    q = Quality()
    base = {"text": "abcd abcd abcd", "duration_sec": 1.0, "exists": True, "transcript": "abcd abcd abcd", "asr_error": None}
    cases = {
        "fine": ({}, [], "ok"),
        "short": ({"duration_sec": 0.49}, ["too_short"], "flagged"),
        "at_limit": ({"duration_sec": 0.5, "text": "abcd abcd", "transcript": "abcd abcd"}, [], "ok"),
        "long": ({"duration_sec": 20.5}, ["too_long", "too_slow"], "flagged"),
        "fast": ({"duration_sec": 0.1}, ["too_short", "too_fast"], "flagged"),
        "wrong": ({"transcript": "zzzz zzzz zzzz"}, ["high_cer"], "flagged"),
        "silent": ({"transcript": " ؟ "}, ["empty_transcript"], "flagged"),
        "no_text": ({"text": "؟؟؟؟", "transcript": "abc"}, [], "ok"),
        "deaf": ({"asr_error": "boom", "transcript": None}, ["asr_error"], "flagged"),
        "missing": ({"exists": False, "duration_sec": None}, ["missing_audio"], "error"),
        "broken": ({"duration_sec": None}, ["duration_read_error"], "error"),
    }
    rows = [(k, k, "p", *(v := base | c[0]).values(), i) for i, (k, c) in enumerate(cases.items())]
    df = spark.createDataFrame(rows, "id string, prompt_id string, audio_path string, text string, duration_sec double, exists boolean, transcript string, asr_error string, seq long")
    got = {r["id"]: r for r in signals.signals(df, q).collect()}
    for k, (_, flags, status) in cases.items():
        assert (got[k]["flags"], got[k]["auto_status"]) == (flags, status), k
    assert got["fine"]["cer"] == 0.0 and got["no_text"]["cer"] is None and got["deaf"]["transcript"] is None
    assert got["missing"]["error"].startswith("audio file not found") and got["fine"]["chars_per_sec"] == 12.0
    assert tuple(signals.outcomes(signals.signals(df, q)).first()) == (3, 6, 2)


def test_queue(spark):
    a = audio(spark, clip("a", 0), clip("b", 1), clip("c", 2), clip("d", 3), clip("a", 4), clip("x", 5, status="failed"))
    q = quality(spark, ("a", "ok", [], 0.1), ("b", "flagged", ["f"], 0.5), ("c", "error", ["m"], None))
    rows = review.queue(a, q)
    assert [r["id"] for r in rows.orderBy("position").collect()] == ["b", "c", "a", "a", "d"]
    done = reviews(spark, ("b", "accept", None), ("a", "accept", None))
    assert [review.next_unreviewed(rows, done, at).first()[0] for at in (0, 1, 4)] == [1, 4, 1]
    assert review.next_unreviewed(rows, reviews(spark, *[(i, "accept", None) for i in "abcd"]), 2).first()[0] == 2
    assert [r["to"] for r in review.stepped(rows, 1).orderBy("position").collect()] == [1, 2, 3, 4, 4]
    assert review.progress(rows, done).first().asDict() == {"reviewed": 2, "n_accept": 2, "n_edit": 0, "n_reject": 0, "total": 5}
    shown = {r["position"]: r for r in review.display(rows).collect()}
    assert shown[0]["cer_text"] == "0.50" and shown[1]["cer_text"] == "-" and shown[4]["flags_text"] == "none"


def test_decisions(spark):
    rows = spark.createDataFrame([("a", "text")], "id string, text string")
    made = [tuple(review.decided(rows, d, " e ", n).first()) for d, n in (("edit", " n "), ("accept", " "), ("reject", None))]
    assert made == [("a", "edit", "e", "n"), ("a", "accept", "text", None), ("a", "reject", None, None)]


def test_sample_matches_the_sequential_rule(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abc"), rng.choice("xyzw")) for i in range(60)]
    buckets: dict = {}
    for r in rows:
        buckets.setdefault(r[1:], []).append(r[0])
    picked = []
    while len(picked) < 24 and any(buckets.values()):
        picked += [b.pop(0) for b in buckets.values() if b]
    got = sample.round_robin_sample(spark.createDataFrame(rows, "seq long, v string, c string"), ["v", "c"]).orderBy("place").collect()
    assert [r["seq"] for r in got] == picked[:24]


def test_reports(spark):
    a = audio(spark, clip("a", 0, voice="v1", category="x"), clip("b", 1, voice="v1", category="y"), clip("c", 2, voice="v2", category="y"))
    q = quality(spark, ("a", "ok", [], 0.2), ("b", "flagged", ["f", "g"], 0.6), ("c", "ok", [], None))
    rows = reports.report_rows(a, q, reviews(spark, ("a", "accept", None), ("b", "reject", None)))
    v = {r["voice_id"]: r for r in reports.by_voice(rows).collect()}
    assert v["v1"]["n"] == 2 and v["v1"]["mean_cer"] == pytest.approx(0.4) and v["v1"]["pct_rejected"] == 50.0 and v["v2"]["median_cer"] is None
    x = reports.versus(rows, "x").first()
    assert (x["n_in"], x["n_out"]) == (1, 2) and x["ratio"] == pytest.approx(0.2 / 0.6)
    assert {r["flag"]: r["n"] for r in reports.flag_reasons(q).collect()} == {"f": 1, "g": 1}
    s = reports.summary(q).first()
    assert (s["n"], s["n_flagged"], s["median_cer"], s["p90_cer"]) == (3, 1, 0.6, 0.6)
    assert reports.summary(q.limit(0)).first()["mean_cer"] is None


def test_checks(spark):
    df = spark.createDataFrame([("a", "audio/x.wav", "fine"), ("b", "/Users/me/x.wav", "C:\\x"), ("c", "other/x.wav", None)], "id string, audio string, note string")
    assert checks.path_report(df, "audio").first().asDict() == {"n": 3, "n_absolute": 1, "n_outside": 1, "n_null": 0}
    assert sorted((r["id"], r["field"]) for r in checks.leaked_paths(df).collect()) == [("b", "audio"), ("b", "note")]


def test_config(tmp_path):
    with pytest.raises(ValueError):
        config.from_dict({"prompts": {"categories": {"a": 0.5}}}, ".")
    (tmp_path / "c.yaml").write_text("prompts: {total_target: 8}\nquality: {max_wer: 0.3}\nexport: {format: jsonl_only, unknown: 1}\n")
    cfg = config.load(str(tmp_path / "c.yaml"))
    assert cfg.prompts.total_target == 8 and cfg.quality.max_cer == 0.3 and cfg.root == str(tmp_path)


def test_secret(monkeypatch):
    monkeypatch.setenv("SOME_KEY", "your-key-here")
    with pytest.raises(RuntimeError):
        config.secret("SOME_KEY")
    monkeypatch.setenv("SOME_KEY", "abc")
    assert config.secret("SOME_KEY") == "abc"
