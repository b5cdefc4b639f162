"""Providers: where texts, clips and transcripts come from.

The engine needs three functions, each DataFrame to DataFrame, so hosted or local models can be put
in their place. The ones here work offline and always give the same results. Rows fail one by
one: an error becomes a column, never a failed partition.
"""

from __future__ import annotations

import hashlib
import os
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from corpusloom.sources import wav



def instruction(category: str, n: int, low: int, high: int) -> str:
    """A request in words; the category's name says what is wanted."""
    return f"Write {n} different sentences of the kind \"{category.replace('_', ' ')}\", each of {low} to {high} words. Answer with a JSON object that has the list as prompts."


def asking(ask: Callable[[str, float], str], low: int, high: int, temperature: float) -> Callable[[str, int, int], str]:
    """A reply function for ``generate`` from a model that takes a request and a temperature."""
    return lambda category, n, batch: ask(instruction(category, n, low, high), temperature)


def retry(call: Callable, attempts: int = 3, first: float = 2.0, most: float = 10.0, sleep: Callable[[float], None] = time.sleep):
    """Call again after an error, waiting twice as long each time; the last error is raised."""
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k == attempts - 1:
                raise
            sleep(min(most, first * 2**k))


def within(seconds: float | None, call: Callable):
    """The call's result; TimeoutError if it takes longer. A call that hangs keeps its thread, not the caller."""
    if seconds is None:
        return call()
    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(call).result(timeout=seconds)
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


# Fixed values of the offline generator: words it draws from.
_WORDS = "انا عايز اروح البيت دلوقتي مع صاحبي علشان نتكلم عن الشغل بكره الصبح في الميدان كده يعني خالص طب فين الكتاب الجديد ممكن تساعدني شوية".split()


def stub_reply(category: str, n: int, batch: int = 0) -> str:
    """A JSON reply of a generator."""
    import json

    rng = random.Random(f"{category}:{batch}")
    return json.dumps({"prompts": [" ".join(rng.choice(_WORDS) for _ in range(rng.randint(3, 12))) for _ in range(n)]}, ensure_ascii=False)


def generate(spark: SparkSession, category: str, n: int, batch: int = 0, reply: Callable[[str, int, int], str] = stub_reply) -> DataFrame:
    """category, text, seq: the candidates of one request, parsed by Spark; a reply that is no JSON gives none."""
    from pyspark.sql import functions as F

    from corpusloom.functions.display import prompts_from_json

    one = spark.createDataFrame([(category, retry(lambda: reply(category, n, batch), first=2.0, most=20.0))], "category string, reply string")
    return one.select("category", F.posexplode(prompts_from_json(F.col("reply"))).alias("seq", "text")).select("category", "text", F.col("seq").cast("long").alias("seq"))


def stub_speech(text: str, voice_id: str, rate: int) -> bytes:
    """Silence of 0.35 s a word; fails for an empty text."""
    if not text.strip():
        raise ValueError("nothing to say")
    return wav.encode(b"\0\0" * int(rate * 0.35 * len(text.split())), rate)


SPEECH: dict[str, Callable[[str, str, int], bytes]] = {"edge": stub_speech, "gtts": stub_speech}


def synthesize(todo: DataFrame, root: str, folder: str, providers: dict[str, Callable[[str, str, int], bytes]] | None = None, timeout: float | None = None, first_wait: float = 2.0) -> DataFrame:
    """Each call gets ``timeout`` seconds and three tries, the waits between them doubling. Audio records of pending rows (audio_records of assign.py) with path, seconds, status and error. ``root`` must be shared by the executors."""
    providers = providers or SPEECH

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(os.path.join(root, folder), exist_ok=True)
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                path, at = f"{folder}/{r['id']}.wav", os.path.join(root, folder, f"{r['id']}.wav")
                try:
                    if r["voice_provider"] not in providers:
                        raise KeyError(f"unknown provider: {r['voice_provider']}")
                    clip = retry(lambda r=r: within(timeout, lambda: providers[r["voice_provider"]](r["text"], r["voice_id"], int(r["sample_rate"]))), first=first_wait)
                    if len(clip) < wav.LEAST_BYTES:
                        raise ValueError(f"only {len(clip)} bytes")
                    with open(f"{at}.part", "wb") as fh:
                        fh.write(clip)
                    os.replace(f"{at}.part", at)
                    r |= {"audio_path": path.replace("\\", "/"), "duration_sec": round((len(clip) - wav.HEADER) / (2 * r["sample_rate"]), 3), "status": "ok", "error": None}
                except Exception as e:
                    r |= {"audio_path": None, "duration_sec": None, "status": "failed", "error": f"{type(e).__name__}: {e}"}
                out.append(r)
            yield pd.DataFrame(out, columns=f.columns)

    return todo.mapInPandas(run, todo.schema)


def stub_transcript(text: str, key: str) -> str:
    """The text with every seventh word lost, as a hash of the key decides."""
    shift = int(hashlib.sha1(key.encode()).hexdigest(), 16) % 7
    return " ".join(w for k, w in enumerate(text.split()) if (k + shift) % 7)


def transcribe(clips: DataFrame, hear: Callable[[str, str], str] = stub_transcript) -> DataFrame:
    """Adds transcript and asr_error. A real recogniser loads its model once a worker process, in a module-level cache."""
    from pyspark.sql import types as T

    schema = T.StructType([*clips.schema.fields, T.StructField("transcript", T.StringType()), T.StructField("asr_error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            heard, errors = [], []
            for text, key in zip(f["text"], f["id"], strict=True):
                try:
                    heard.append(hear(text, key))
                    errors.append(None)
                except Exception as e:
                    heard.append(None)
                    errors.append(str(e))
            yield f.assign(transcript=pd.Series(heard, dtype=object, index=f.index), asr_error=pd.Series(errors, dtype=object, index=f.index))

    return clips.mapInPandas(run, schema)
