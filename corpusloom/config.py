"""Configuration: a YAML file or keyword arguments become validated, frozen dataclasses."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from corpusloom.schemas import VOICES as VOICE_SCHEMA


@dataclass(frozen=True)
class Voice:
    provider: str
    voice_id: str
    gender: str
    dialect: str

    @property
    def slug(self) -> str:
        return f"{self.provider}-{self.voice_id}".replace("/", "_").replace(":", "_")


# The categories with their shares, and the three voices.
CATEGORIES = {
    "daily_conversation": 0.25,
    "customer_service": 0.15,
    "questions": 0.15,
    "code_switching": 0.15,
    "numbers_dates": 0.10,
    "commands_requests": 0.10,
    "emotional": 0.05,
    "formal_news": 0.05,
}
VOICES = (
    Voice("edge", "ar-EG-SalmaNeural", "female", "egyptian"),
    Voice("edge", "ar-EG-ShakirNeural", "male", "egyptian"),
    Voice("gtts", "ar", "unknown", "msa_leaning"),
)


@dataclass(frozen=True)
class Prompts:
    model: str = "stub"
    temperature: float = 0.9
    total_target: int = 80
    prompts_per_request: int = 15
    categories: dict[str, float] = field(default_factory=lambda: dict(CATEGORIES))
    min_words: int = 3
    max_words: int = 25
    min_script_ratio: float = 0.3
    max_empty_batches: int = 3


@dataclass(frozen=True)
class Speech:
    output_sample_rate: int = 16000
    concurrency: int = 8
    timeout: float = 30.0
    first_wait: float = 2.0
    voices: tuple[Voice, ...] = VOICES


@dataclass(frozen=True)
class Quality:
    max_cer: float = 0.40
    min_duration_sec: float = 0.5
    max_duration_sec: float = 20.0
    min_chars_per_second: float = 4.0
    max_chars_per_second: float = 25.0


@dataclass(frozen=True)
class Export:
    format: str = "columnar"
    include_rejected: bool = False
    include_flagged: bool = False
    dataset_name: str = "speech_dataset_v1"
    language: str = "ar-EG"


@dataclass(frozen=True)
class Config:
    root: str
    prompts: Prompts = field(default_factory=Prompts)
    speech: Speech = field(default_factory=Speech)
    quality: Quality = field(default_factory=Quality)
    export: Export = field(default_factory=Export)
    paths: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        total = sum(self.prompts.categories.values())
        if abs(total - 1.0) > 0.01:
            raise ValueError(f"category shares must sum to 1, not {total:.3f}")
        if self.export.format not in ("columnar", "huggingface", "jsonl_only"):
            raise ValueError(f"unknown export format {self.export.format!r}")

    def path(self, name: str) -> str:
        """A manifest's folder; relative ones are below the root."""
        return os.path.join(self.root, self.paths.get(name, DEFAULT_PATHS[name]))


DEFAULT_PATHS = {
    "prompts_manifest": "data/prompts",
    "audio_dir": "data/audio",
    "audio_manifest": "data/audio_manifest",
    "quality_manifest": "data/quality",
    "reviewed_manifest": "data/reviewed",
    "final_dir": "data/final",
}


def _pick(kind, values: dict | None):
    known = {f.name for f in fields(kind)}
    return kind(**{k: v for k, v in (values or {}).items() if k in known})


def from_dict(raw: dict, root: str) -> Config:
    speech = dict(raw.get("tts") or raw.get("speech") or {})
    if "voices" in speech:
        speech["voices"] = tuple(Voice(**v) for v in speech["voices"])
    quality = dict(raw.get("quality") or {})
    if "max_wer" in quality and "max_cer" not in quality:  # the older name of the same limit
        quality["max_cer"] = quality["max_wer"]
    return Config(root, _pick(Prompts, raw.get("prompts")), _pick(Speech, speech), _pick(Quality, quality), _pick(Export, raw.get("export")), dict(raw.get("paths") or {}))


def load(path: str | None = None, root: str | None = None) -> Config:
    if path is None:
        return Config(root or os.getcwd())
    import yaml

    file = Path(path)
    with file.open(encoding="utf-8") as f:
        return from_dict(yaml.safe_load(f) or {}, root or str(file.resolve().parent))


def secret(name: str) -> str:
    """A key from the environment, on the driver only; placeholders do not count."""
    value = os.environ.get(name, "").strip()
    if not value or value.lower().startswith(("your", "sk-your", "changeme", "<")):
        raise RuntimeError(f"{name} is not set")
    return value


def voice_table(spark: SparkSession, voices: tuple[Voice, ...] = VOICES) -> DataFrame:
    return spark.createDataFrame([(v.provider, v.voice_id, v.gender, v.dialect) for v in voices], VOICE_SCHEMA)


def category_table(spark: SparkSession, categories: dict[str, float] | None = None) -> DataFrame:
    return spark.createDataFrame(list((categories or CATEGORIES).items()), "category string, proportion double")
