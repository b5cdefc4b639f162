import json
import time

import pytest
from pyspark.sql import functions as F

from corpusloom import cli, providers
from corpusloom.config import Config, Export, Prompts, Speech
from corpusloom.schemas import REVIEWED, with_seq
from corpusloom.sources import dataset, jsonl, wav
from corpusloom.streaming import incremental


def test_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", "accept", "نص", None, 0)], with_seq(REVIEWED))
    assert jsonl.read(spark, path, REVIEWED).count() == 0
    jsonl.append(rows, path)
    line = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "log").glob("part-*"))
    assert "نص" in line and json.loads(line)["note"] is None
    jsonl.append(rows, path)
    assert jsonl.read(spark, path, with_seq(REVIEWED)).count() == 2
    jsonl.overwrite(jsonl.read(spark, path, with_seq(REVIEWED)).limit(1), path)
    assert jsonl.read(spark, path, with_seq(REVIEWED)).collect() == rows.collect()


def test_foreign_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a"}\n\n   \n{"id": "b", "note": null}\n{"id": "c", "other": 1}\n', encoding="utf-8")
    got = jsonl.read_in_order(spark, str(tmp_path / "x.jsonl"), REVIEWED).orderBy("seq").collect()
    assert [r["id"] for r in got] == ["a", "b", "c"] and got[0]["decision"] is None
    (tmp_path / "y.jsonl").write_text('{"id": "a"}\n{broken\n', encoding="utf-8")
    with pytest.raises(Exception):
        jsonl.read(spark, str(tmp_path / "y.jsonl"), REVIEWED).collect()


def test_numbers_go_on(spark, tmp_path):
    rows = spark.createDataFrame([(f"i{k}", "accept", None, None) for k in range(5)], REVIEWED)
    assert [jsonl.append_numbered(rows, str(tmp_path / "n"), REVIEWED) for _ in range(3)] == [0, 5, 10]
    assert sorted(r["seq"] for r in jsonl.read(spark, str(tmp_path / "n"), with_seq(REVIEWED)).collect()) == list(range(15))


def test_wav(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav.encode(b"\1\0" * 24000, 16000))
    odd = wav.encode(b"\1\0" * 8000, 16000)
    (tmp_path / "b.wav").write_bytes(odd[:36] + b"LIST" + (4).to_bytes(4, "little") + b"abcd" + odd[36:])
    (tmp_path / "c.wav").write_bytes(b"not a clip")
    got = {r["path"][-5:]: r for r in wav.durations(wav.files(spark, str(tmp_path), content=True)).collect()}
    assert got["a.wav"]["duration_sec"] == 1.5 and got["a.wav"]["sample_rate"] == 16000 and got["b.wav"]["duration_sec"] == 0.5 and got["c.wav"]["duration_sec"] is None


def test_wav_headers_alone_go_to_python(spark):
    plain = wav.encode(b"\1\0" * 8000, 16000)
    chunk = lambda n, tag=b"LIST", size=None: tag + (n if size is None else size).to_bytes(4, "little") + b"x" * n + b"\0" * (n % 2)
    within = lambda *more: plain[:4] + (len(plain) - 8 + sum(map(len, more))).to_bytes(4, "little") + plain[8:36] + b"".join(more) + plain[36:]
    files = {
        "odd": within(chunk(5), chunk(4, b"data"[::-1])), "many": within(*[chunk(2)] * 40), "late": within(chunk(300)), "stereo": plain[:22] + b"\2" + plain[23:],
        "beyond": within(chunk(2, size=10**6)), "past its size": plain[:4] + (40).to_bytes(4, "little") + plain[8:36] + chunk(60) + plain[36:], "cut": plain[:30], "none": b"RIFF" + bytes(9000), "empty": b"",
    }
    clips = spark.createDataFrame([*((k, bytearray(v)) for k, v in files.items()), ("null", None)], "path string, content binary")
    got = {r["path"]: r["duration_sec"] for r in wav.durations(clips).collect()}
    assert got == dict.fromkeys([*files, "null"]) | {"odd": 0.5, "many": 0.5, "late": 0.5, "stereo": 0.25}
    sent = {r["path"]: r["n"] for r in clips.select("path", F.octet_length(wav.header(F.col("content"))).alias("n")).collect()}
    assert sent == {"odd": 70, "many": len(files["many"]), "late": 352, "stereo": 44, "beyond": 12, "past its size": 112, "cut": 12, "none": 12, "empty": 0, "null": None}


def test_clips_are_those_of_the_wave_module(spark):
    from corpusloom.plans import queries

    keys = [0, 1, 5, 7, 10, 399, 3999, 4999, 5000, 5001, 10**9 + 1, -3]
    for r in spark.createDataFrame([(k,) for k in keys], "k long").select("k", queries._clip(F.col("k")).alias("c")).collect():
        plain = wav.encode(b"\0\0" * (r["k"] % 5000 + 1), 16000)
        longer = plain[:4] + (len(plain) + 4).to_bytes(4, "little") + plain[8:36] + b"LIST\4\0\0\0INFO" + plain[36:]
        assert r["c"] == (b"RIFF" + bytes(r["k"] % 400) if r["k"] % 7 == 0 else plain if r["k"] % 5 else longer)


def test_retry():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    waits = []
    assert providers.retry(flaky, sleep=waits.append) == "ok" and waits == [2.0, 4.0]
    with pytest.raises(ZeroDivisionError):
        providers.retry(lambda: 1 / 0, sleep=waits.append)


def test_a_call_that_hangs_is_left():
    began = time.monotonic()
    with pytest.raises(TimeoutError):
        providers.within(0.1, lambda: time.sleep(2))
    assert time.monotonic() - began < 1.5 and providers.within(5, lambda: 7) == 7 and providers.within(None, lambda: 8) == 8


def test_slow_speech_becomes_failed_rows(spark, tmp_path):
    cfg = Config(str(tmp_path), prompts=Prompts(total_target=3, categories={"questions": 1.0}), speech=Speech(timeout=0.2, first_wait=0.01))
    cli.generate_prompts(spark, cfg)

    def slow(text, voice, rate):
        time.sleep(1)
        return providers.stub_speech(text, voice, rate)

    cli.synthesize(spark, cfg, {"edge": slow, "gtts": providers.stub_speech})
    got = {r["voice_provider"]: r for r in cli.read(spark, cfg, "audio_manifest").collect()}
    assert got["edge"]["status"] == "failed" and got["edge"]["error"].startswith("TimeoutError") and got["gtts"]["status"] == "ok"


def test_a_model_gets_the_request_and_the_temperature(spark):
    asked = []

    def ask(request, temperature):
        asked.append((request, temperature))
        return '{"prompts": ["one", "two"]}'

    got = providers.generate(spark, "formal_news", 5, reply=providers.asking(ask, 3, 25, 0.4)).collect()
    assert [r["text"] for r in got] == ["one", "two"] and asked[0][1] == 0.4
    assert all(x in asked[0][0] for x in ("formal news", "5 different", "3 to 25", "JSON"))


def test_rows_come_lazily(spark, tmp_path):
    rows = spark.createDataFrame([(f"i{k}", "accept", None, None) for k in range(5)], REVIEWED)
    jsonl.append(rows, str(tmp_path / "n"))
    assert sorted(r["id"] for r in jsonl.iterate(spark, str(tmp_path / "n"), REVIEWED)) == [f"i{k}" for k in range(5)]
    with pytest.raises(Exception):
        list(jsonl.iterate(spark, str(tmp_path / "nothing"), REVIEWED))


def test_arrow_file(spark, tmp_path):
    import pyarrow as pa

    rows = spark.createDataFrame([(1, "a", [1.5]), (2, None, None)], "id long, text string, x array<float>").repartition(2)
    dataset.write_arrow(rows, str(tmp_path / "x.arrow"))
    with pa.OSFile(str(tmp_path / "x.arrow")) as f:
        back = pa.ipc.open_file(f).read_all()
    assert sorted(back.to_pylist(), key=lambda r: r["id"]) == [{"id": 1, "text": "a", "x": [1.5]}, {"id": 2, "text": None, "x": None}]


def test_lines_only_export(spark, tmp_path):
    cfg = Config(str(tmp_path), prompts=Prompts(total_target=3, categories={"questions": 1.0}), export=Export(format="jsonl_only"))
    cli.generate_prompts(spark, cfg)
    cli.synthesize(spark, cfg)
    cli.compute_quality(spark, cfg)
    cli.decide(spark, cfg, [r["id"] for r in cli.read(spark, cfg, "audio_manifest").collect()], "edit", "another text")
    assert cli.export(spark, cfg) == cfg.path("final_dir")
    assert (tmp_path / "data/final/README.md").exists() and not (tmp_path / "data/final" / cfg.export.dataset_name).exists()
    assert spark.read.json(f"{cfg.path('final_dir')}/metadata").count() == 3


def test_stages_resume_and_export(spark, tmp_path):
    cfg = Config(str(tmp_path), prompts=Prompts(total_target=12, categories={"questions": 0.5, "emotional": 0.5}))
    assert cli.generate_prompts(spark, cfg) == 12 and cli.generate_prompts(spark, cfg) == 0
    assert cli.synthesize(spark, cfg) == 12 and cli.synthesize(spark, cfg) == 0
    assert cli.compute_quality(spark, cfg) == 12 and cli.compute_quality(spark, cfg) == 0
    audio = cli.read(spark, cfg, "audio_manifest")
    assert audio.where("status = 'ok'").count() == 12 and audio.select("voice_id").distinct().count() == 3
    with pytest.raises(RuntimeError):
        cli.export(spark, cfg)
    ids = [r["id"] for r in audio.orderBy("seq").collect()]
    cli.decide(spark, cfg, ids[:4], "accept")
    cli.decide(spark, cfg, ids[4:6], "edit", "edited text")
    cli.decide(spark, cfg, ids[:1], "reject")
    folder = cli.export(spark, cfg)
    out = dataset.load(spark, folder)
    kept = {r["id"]: r for r in out.collect()}
    assert ids[0] not in kept and kept[ids[4]]["text"] == "edited text" and dataset.verify(spark, folder) == []
    lines = spark.read.json(f"{cfg.path('final_dir')}/metadata")
    assert lines.count() == len(kept)
    assert "Samples" in (tmp_path / "data/final/README.md").read_text(encoding="utf-8")
    next((tmp_path / "data/final/speech_dataset_v1/audio").iterdir()).unlink()
    assert any("missing" in x for x in dataset.verify(spark, folder))
    cli.show_review(spark, cfg)
    cli.show_reports(spark, cfg)
    assert any("missing" in x for x in cli.verify(spark, cfg))
    target = cli.draw_sample(spark, cfg, 3)
    drawn = spark.read.json(f"{target}/metadata").collect()
    assert len(drawn) == 3 and all((tmp_path / "data/final/samples" / r["audio_relpath"]).exists() for r in drawn)
    assert cli.compact_reviews(spark, cfg) == {"n_entries": 7, "n_ids": 6, "n_notes": 0}
    assert cli.read(spark, cfg, "reviewed_manifest").count() == 6
    assert {r["id"] for r in dataset.load(spark, cli.export(spark, cfg)).collect()} == set(kept)


def test_failed_rows_stay_rows(spark, tmp_path):
    cfg = Config(str(tmp_path), prompts=Prompts(total_target=3, categories={"questions": 1.0}), speech=Speech(first_wait=0.01))
    cli.generate_prompts(spark, cfg)

    def broken(text, voice, rate):
        raise OSError("no line")

    assert cli.synthesize(spark, cfg, {"edge": broken, "gtts": providers.stub_speech}) == 3
    got = cli.read(spark, cfg, "audio_manifest").groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in got} == {"failed": 2, "ok": 1}
    assert cli.synthesize(spark, cfg) == 2


def test_useless_replies_stop_the_loop(spark, tmp_path):
    cfg = Config(str(tmp_path), prompts=Prompts(total_target=3, categories={"questions": 1.0}))
    calls = []
    assert cli.generate_prompts(spark, cfg, lambda c, n, b: calls.append(b) or "no json") == 0 and len(calls) == 3


def test_streams_equal_batches(spark, tmp_path):
    events = spark.range(300).select((F.col("id") * 7 % 20).alias("user_id"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("event_type"), F.col("id").alias("event_id"))
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    path = str(tmp_path / "events.parquet")
    batch = events.collect()
    last: dict = {}
    for r in batch:
        last[str(r["user_id"])] = max(last.get(str(r["user_id"]), (-1, "")), (r["event_id"], r["event_type"]))
    got = incremental.run_latest(spark, path, str(tmp_path / "s1")).collect()
    assert {r["id"]: (r["seq"], r["decision"]) for r in got} == last
    got = incremental.run_dedup(spark, path, str(tmp_path / "s2")).collect()
    assert len(got) == len({*got}) and {tuple(r) for r in got} == {(str(r["user_id"]), r["event_type"]) for r in batch}
    got = incremental.run_resume(spark, path, str(tmp_path / "s3")).collect()
    assert len(got) == 20 and len({r["id"] for r in got}) == 20


def test_streams_go_on(spark, tmp_path):
    path, state = str(tmp_path / "events.parquet"), [str(tmp_path / f"s{k}") for k in range(3)]
    runners = (incremental.run_latest, incremental.run_dedup, incremental.run_resume)
    make = lambda low, high: spark.range(low, high).select((F.col("id") % 10).alias("user_id"), F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("event_type"), F.col("id").alias("event_id"))
    make(0, 5).coalesce(1).write.parquet(path)
    assert [r(spark, path, s).count() for r, s in zip(runners, state, strict=True)] == [5, 5, 5]
    make(3, 40).coalesce(1).write.mode("append").parquet(path)
    latest, pairs, first = (r(spark, path, s).collect() for r, s in zip(runners, state, strict=True))
    assert {r["id"]: r["seq"] for r in latest} == {str(u): 30 + u for u in range(10)}
    assert len(pairs) == len({*pairs}) == len({(i % 10, i % 7) for i in range(40)})
    assert {r["id"]: r["seq"] for r in first} == {str(u): u for u in range(10)}


def test_resume_finds_first_entries_in_any_order_of_files(spark, tmp_path):
    path, state = str(tmp_path / "events.parquet"), str(tmp_path / "s")
    make = lambda low, high: spark.range(low, high).select((F.col("id") % 10).alias("user_id"), F.lit("t").alias("event_type"), F.col("id").alias("event_id"))
    for low, high in ((60, 90), (30, 67), (0, 5), (3, 40)):
        make(low, high).coalesce(1).write.mode("append").parquet(path)
        got = incremental.run_resume(spark, path, state).collect()
        assert len(got) == 10
    assert {r["id"]: r["seq"] for r in got} == {str(u): u for u in range(10)}
