"""Settings. They are passed to operators as values; nothing is kept in Spark's configuration."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass
from pathlib import Path

# ---- fixed values of the data format ----
SPEAKER_COUNT = 34
EXCLUDED = ("s21",)
SPLITS = ("train", "val", "test")
SCHEMA_VERSION = "1.0.0"
DATASET = "GRID"
STATUSES = ("PENDING", "DOWNLOADING", "EXTRACTING", "PREPROCESSING", "QC", "PACKAGING", "UPLOADING", "DONE", "FAILED")
TERMINAL = ("DONE",)
RETRYABLE = tuple(s for s in STATUSES if s not in TERMINAL)
PAIRING = ("PAIRED", "MISSING_AUDIO", "MISSING_VIDEO", "DUPLICATE_AUDIO", "DUPLICATE_VIDEO")
REASONS = (
    "MISSING_AUDIO",
    "MISSING_VIDEO",
    "DUPLICATE_AUDIO",
    "DUPLICATE_VIDEO",
    "VIDEO_DECODE_FAILED",
    "AUDIO_DECODE_FAILED",
    "INVALID_FPS",
    "NO_FRAMES",
    "FACE_NOT_DETECTED",
    "INSUFFICIENT_CONSECUTIVE_FACE_FRAMES",
    "AUDIO_CONVERSION_FAILED",
    "EMPTY_AUDIO",
    "INVALID_OUTPUT_AUDIO_RATE",
    "CORRUPT_OUTPUT",
    "UNKNOWN_ERROR",
)


@dataclass(frozen=True)
class CorpusConfig:
    """Of the corpus builder."""

    root: str = "."
    fps: float = 25.0
    fps_tolerance: float = 0.05
    audio_rate: int = 16_000
    audio_channels: int = 1
    min_face_ratio: float = 0.5
    min_consecutive: int = 5
    min_audio_sec: float = 0.1
    spot_checks: int = 3
    jpeg_quality: int = 95
    detector_batch: int = 16
    split_seed: int = 42
    train: int = 27
    val: int = 3
    test: int = 3
    excluded: tuple[str, ...] = EXCLUDED
    retries: int = 5
    retry_delay: float = 2.0
    retry_factor: float = 2.0
    retry_max_delay: float = 60.0
    connect_timeout: float = 30.0
    read_timeout: float = 60.0
    chunk: int = 1 << 20
    max_member_bytes: int = 16 << 20

    def usable(self) -> list[str]:
        """Speakers in numeric order, without the excluded ones."""
        return [s for s in (f"s{i}" for i in range(1, SPEAKER_COUNT + 1)) if s not in self.excluded]

    @property
    def shards(self) -> str:
        return f"{self.root}/silver/shards"

    @property
    def metadata(self) -> str:
        return f"{self.root}/silver/metadata"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def state(self) -> str:
        return f"{self.root}/state"


def check_speaker(speaker: str, config: CorpusConfig) -> str:
    if speaker in config.excluded:
        raise ValueError(f"speaker {speaker} is excluded")
    if speaker not in config.usable():
        raise ValueError(f"speaker {speaker} is unknown")
    return speaker


@dataclass(frozen=True)
class ReaderSettings:
    """Of the sample reader and the duration report."""

    data_root: str | None = None
    fps: float = 25.0
    frame_width: int = 96
    frame_height: int = 96
    gap_threshold_ms: float = 80.0
    min_frame_count: int | None = None

    def __post_init__(self) -> None:
        if not (isinstance(self.fps, (int, float)) and math.isfinite(self.fps) and self.fps > 0):
            raise ValueError("fps must be finite and positive")
        for side in (self.frame_width, self.frame_height):
            if type(side) is not int or side <= 0:
                raise ValueError("the frame's width and height must be positive integers")
        if not (math.isfinite(self.gap_threshold_ms) and self.gap_threshold_ms >= 0):
            raise ValueError("the gap threshold must be finite and not negative")
        if self.min_frame_count is not None and (type(self.min_frame_count) is not int or self.min_frame_count < 1):
            raise ValueError("min_frame_count must be a positive integer or None")

    @classmethod
    def from_env(cls, dotenv: str | None = ".env", environ: dict[str, str] | None = None, prefix: str = "CORVANE_") -> ReaderSettings:
        """The environment, else the file, else defaults; blank values count as absent, a bad number raises ValueError."""
        found: dict[str, str] = {}
        if dotenv and Path(dotenv).is_file():
            for line in Path(dotenv).read_text(encoding="utf-8").splitlines():
                key, sign, value = line.strip().removeprefix("export ").partition("=")
                if sign and not key.lstrip().startswith("#"):
                    found[key.strip()] = value.strip().strip("'\"")
        found |= {k: v for k, v in (os.environ if environ is None else environ).items() if v.strip()}
        out = {}
        for name, kind in (("data_root", str), ("fps", float), ("frame_width", int), ("frame_height", int), ("gap_threshold_ms", float), ("min_frame_count", int)):
            value = found.get(prefix + name.upper(), "").strip()
            if value:
                out[name] = kind(value)
        return cls(**out)
