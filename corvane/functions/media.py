"""Media payloads: WAV decoding, letterbox geometry, and interfaces for decoders that this package doesn't bring along."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.errors import DatasetReadError, DetectionSetupError


#: Fixed values of the format: the head of a RIFF file, of a chunk, and the number that stands for plain samples.
RIFF, CHUNK, PCM = struct.Struct("<4sI4s"), struct.Struct("<4sI"), 1


def pcm(content: bytes, rate: int) -> np.ndarray:
    """The 16-bit samples of an uncompressed mono WAV file at `rate`, as they are in its bytes."""
    if len(content) < RIFF.size or content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise DatasetReadError("audio can't be decoded: it is no WAV file")
    at, form = RIFF.size, None
    while at + CHUNK.size <= len(content):
        name, size = CHUNK.unpack_from(content, at)
        at += CHUNK.size
        if name == b"fmt ":
            if size < 16 or at + 16 > len(content):
                raise DatasetReadError("audio can't be decoded: its format is cut short")
            form = struct.unpack_from("<HHIIHH", content, at)
        elif name == b"data":
            if form is None:
                raise DatasetReadError("audio can't be decoded: data come before the format")
            tag, channels, got, _, _, bits = form
            if tag != PCM or channels != 1 or bits != 16:
                raise DatasetReadError("audio must be uncompressed mono 16-bit PCM")
            if got != rate:
                raise DatasetReadError(f"audio has rate {got}, not {rate}")
            size = min(size, len(content) - at)
            if not size or size % 2:
                raise DatasetReadError("audio is empty or cut short")
            return np.frombuffer(content, "<i2", size // 2, at)
        at += size + size % 2
    raise DatasetReadError("audio can't be decoded: it has no data")


@F.arrow_udf(T.StructType([T.StructField("samples", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())]))
def decode_wav(content: pa.Array, rate: pa.Array) -> pa.Array:
    """Samples from -1 to 1, or what is wrong. The samples of a batch are one array, divided by rows; no number becomes a Python object."""
    parts, ends, errors = [], [0], []
    for c, r in zip(content, rate):
        part, error = np.zeros(0, np.int16), None
        try:
            if c.is_valid:
                part = pcm(memoryview(c.as_buffer()), r.as_py())
            else:
                error = "audio is missing"
        except DatasetReadError as e:
            error = str(e)
        parts.append(part)
        ends.append(ends[-1] + len(part))
        errors.append(error)
    flat = np.concatenate([*parts, np.zeros(0, np.int16)]).astype(np.float32) / np.float32(32768)
    errors = pa.array(errors, pa.string())
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat), mask=errors.is_valid())
    return pa.StructArray.from_arrays([lists, errors], ["samples", "error"])


def letterbox(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """struct(width, height, left, top): where an image scaled to fit stands in a frame. Halves round to even; offsets round down."""
    scale = F.least(F.lit(float(to_width)) / width, F.lit(float(to_height)) / height)
    side = lambda x: F.greatest(F.lit(1), F.rint(x * scale).cast("int"))
    return F.struct(side(width).alias("width"), side(height).alias("height"), F.expr("1").alias("_")).withField("left", F.floor((F.lit(to_width) - side(width)) / 2).cast("int")).withField("top", F.floor((F.lit(to_height) - side(height)) / 2).cast("int")).dropFields("_")


def fit(image: np.ndarray, to_width: int, to_height: int) -> np.ndarray:
    """An image scaled into a black frame. Shrinking averages areas, enlarging interpolates linearly."""
    h, w = image.shape[:2]
    scale = min(to_width / w, to_height / h)
    nw, nh = max(1, round(w * scale)), max(1, round(h * scale))
    x = image.astype(np.float64)
    for axis, n in ((0, nh), (1, nw)):
        x = np.moveaxis(_areas(np.moveaxis(x, axis, 0), n) if scale < 1 else _linear(np.moveaxis(x, axis, 0), n), 0, axis)
    out = np.zeros((to_height, to_width, *image.shape[2:]), np.uint8)
    top, left = (to_height - nh) // 2, (to_width - nw) // 2
    out[top : top + nh, left : left + nw] = np.clip(np.rint(x), 0, 255)
    return out


def _areas(x: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate([np.zeros_like(x[:1]), np.cumsum(x, axis=0)])
    at = np.arange(n + 1) * (len(x) / n)
    low = np.minimum(at.astype(int), len(x) - 1)
    upto = total[low] + x[low] * (at - low).reshape(-1, *[1] * (x.ndim - 1))
    return np.diff(upto, axis=0) * (n / len(x))


def _linear(x: np.ndarray, n: int) -> np.ndarray:
    at = np.clip((np.arange(n) + 0.5) * (len(x) / n) - 0.5, 0, len(x) - 1)
    low = np.minimum(at.astype(int), max(0, len(x) - 2))
    part = (at - low).reshape(-1, *[1] * (x.ndim - 1))
    return x[low] * (1 - part) + x[np.minimum(low + 1, len(x) - 1)] * part


def decode_frames(df: DataFrame, decoder: Callable[[], Callable[[bytes], np.ndarray]], width: int, height: int) -> DataFrame:
    """prefix, frame_index, pixels (height x width x 3 RGB bytes), error for df(prefix, frame_index, content). decoder() is called once a
    task and gives a function from encoded bytes to an RGB array; this package has none for JPEG."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = decoder()
        for b in batches:
            pixels, errors = [], []
            for c in b["content"]:
                try:
                    pixels.append(fit(decode(bytes(c)), width, height).tobytes()), errors.append(None)
                except Exception as e:  # a decoder may raise anything; the row says so
                    pixels.append(None), errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"prefix": b["prefix"], "frame_index": b["frame_index"], "pixels": pixels, "error": errors})

    return df.select("prefix", "frame_index", "content").mapInPandas(run, "prefix string, frame_index int, pixels binary, error string")


def clamp_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """A detection as struct(left, top, right, bottom) of whole pixels inside its frame; null if nothing is left of it."""
    left, top = F.greatest(F.lit(0), x1.cast("int")), F.greatest(F.lit(0), y1.cast("int"))
    right, bottom = F.least(width.cast("int"), x2.cast("int")), F.least(height.cast("int"), y2.cast("int"))
    return F.when((right > left) & (bottom > top), F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")))


def fps_ok(fps: Column, expected: float, tolerance: float) -> Column:
    return fps.between(expected * (1 - tolerance), expected * (1 + tolerance))


CROPS = "array<struct<frame_index: int, content: binary>>"


def process_videos(df: DataFrame, reader: Callable, detector: Callable, batch: int = 16, expected: float = 25.0, tolerance: float = 0.05, encoder: Callable | None = None, video: str = "video_path") -> DataFrame:
    """For df(speaker_id, utterance_id, video_path): fps, total_frames, detected frame indices, invalid_reason. reader() gives a function from a
    path (or whatever the column `video` holds, such as a file's bytes) to (fps, frames or None); detector() one from a list of
    frames to a list of boxes or None. Both are made once a task. The frame rate is checked before any frame is read; a batch that
    fails counts as without detections, and the rest goes on. With encoder, which gives a function from a crop to the bytes of an image
    file, or None if it can't, each crop comes out in `crops` under its frame's index; a frame whose crop can't be encoded isn't detected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read, detect, encode = reader(), detector(), encoder() if encoder else lambda crop: b""
        if read is None or detect is None:
            raise DetectionSetupError("no video reader or face detector is available")
        for b in batches:
            rows = []
            for s, u, path in zip(b["speaker_id"], b["utterance_id"], b[video]):
                try:
                    fps, frames = read(path)
                except Exception:
                    rows.append((s, u, 0.0, 0, [], "VIDEO_DECODE_FAILED", []))
                    continue
                if not expected * (1 - tolerance) <= fps <= expected * (1 + tolerance):
                    rows.append((s, u, fps, 0, [], "INVALID_FPS", []))
                    continue
                frames, found = list(frames()), []
                for i in range(0, len(frames), batch):
                    try:
                        boxes = detect(frames[i : i + batch])
                    except Exception:
                        continue
                    cut = [(i + j, crop(f, box)) for j, (box, f) in enumerate(zip(boxes, frames[i : i + batch])) if box is not None]
                    found += [(k, data) for k, c in cut if c is not None and (data := encode(c)) is not None]
                rows.append((s, u, fps, len(frames), [k for k, _ in found], None if frames else "NO_FRAMES", [{"frame_index": k, "content": data} for k, data in found]))
            yield pd.DataFrame(rows, columns=["speaker_id", "utterance_id", "source_fps", "total_frames", "detected", "invalid_reason", "crops"])

    out = df.select("speaker_id", "utterance_id", video).mapInPandas(run, f"speaker_id string, utterance_id string, source_fps double, total_frames int, detected array<int>, invalid_reason string, crops {CROPS}")
    return out if encoder else out.drop("crops")


def crop(frame: np.ndarray, box) -> np.ndarray | None:
    left, top, right, bottom = max(0, int(box[0])), max(0, int(box[1])), min(frame.shape[1], int(box[2])), min(frame.shape[0], int(box[3]))
    return frame[top:bottom, left:right] if right > left and bottom > top else None


def first_faces(detections: list) -> list:
    """Of each frame's detections the first one's box, not below 0; None without any."""
    return [None if d is None or not len(d) else [max(0, v) for v in d[0][:4]] for d in detections]


def process_audio(df: DataFrame, convert: Callable, rate: int = 16_000, least: float = 0.1, audio: str = "audio_path") -> DataFrame:
    """For df(speaker_id, utterance_id, audio_path): success, invalid_reason, audio_duration_sec, audio_sample_rate, audio_channels, converted.
    convert() is made once a task and gives a function from a path (or whatever the column `audio` holds) to (converted, duration,
    rate, channels); converted is the bytes of the new file, or whether there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run_one = convert()
        for b in batches:
            rows = []
            for s, u, path in zip(b["speaker_id"], b["utterance_id"], b[audio]):
                try:
                    ok, duration, got, channels = run_one(path)
                except Exception:
                    rows.append((s, u, False, "AUDIO_CONVERSION_FAILED", None, None, None, None))
                    continue
                reason = "AUDIO_CONVERSION_FAILED" if not ok else "INVALID_OUTPUT_AUDIO_RATE" if got != rate else "EMPTY_AUDIO" if duration is not None and duration < least else None
                rows.append((s, u, reason is None, reason, duration, got, channels, ok if isinstance(ok, bytes) else None))
            yield pd.DataFrame(rows, columns=["speaker_id", "utterance_id", "success", "invalid_reason", "audio_duration_sec", "audio_sample_rate", "audio_channels", "converted"])

    return df.select("speaker_id", "utterance_id", audio).mapInPandas(run, "speaker_id string, utterance_id string, success boolean, invalid_reason string, audio_duration_sec double, audio_sample_rate int, audio_channels int, converted binary")
