"""Explicit schemas of every manifest; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "BOOLEAN": T.BooleanType(),
    "LONG": T.LongType(), "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def parse(ddl: str) -> T.StructType:
    """Flat schemas only; unlike Spark's own parser it needs no session."""
    return T.StructType([T.StructField(*(lambda n, t: (n, _TYPES[t.upper()]))(*f.split())) for f in ddl.split(",")])


PROMPTS = parse("id STRING, hash STRING, text STRING, category STRING, word_count INT, source STRING")
AUDIO = parse(
    "id STRING, prompt_id STRING, text STRING, category STRING, voice_provider STRING, voice_id STRING, voice_gender STRING, "
    "voice_dialect STRING, audio_path STRING, duration_sec DOUBLE, sample_rate INT, status STRING, error STRING"
)
QUALITY = parse(
    "id STRING, prompt_id STRING, audio_path STRING, duration_sec DOUBLE, transcript STRING, cer DOUBLE, wer DOUBLE, "
    "chars_per_sec DOUBLE, flags ARRAY<STRING>, auto_status STRING, error STRING"
)
REVIEWED = parse("id STRING, decision STRING, final_text STRING, note STRING")
METADATA = parse(
    "id STRING, audio_relpath STRING, text STRING, original_prompt STRING, category STRING, voice_provider STRING, voice_id STRING, "
    "voice_gender STRING, voice_dialect STRING, duration_sec DOUBLE, sample_rate INT, asr_transcript STRING, asr_cer DOUBLE, "
    "asr_wer DOUBLE, auto_flags ARRAY<STRING>, auto_status STRING, review_decision STRING, review_note STRING, is_synthetic BOOLEAN, language STRING"
)
#: The typed export: metadata with the dataset-relative path, reals narrowed to float.
DATASET = parse(
    "id STRING, audio STRING, audio_relpath STRING, text STRING, original_prompt STRING, category STRING, voice_provider STRING, "
    "voice_id STRING, voice_gender STRING, voice_dialect STRING, duration_sec FLOAT, sample_rate INT, asr_transcript STRING, "
    "asr_cer FLOAT, asr_wer FLOAT, auto_flags ARRAY<STRING>, auto_status STRING, review_decision STRING, review_note STRING, "
    "is_synthetic BOOLEAN, language STRING"
)
VOICES = parse("provider STRING, voice_id STRING, gender STRING, dialect STRING")


def with_seq(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("seq", T.LongType())])
