"""Files that other tools read by name, written whole or not at all. Small ones come from the driver; a table's CSV is written by tasks, a part
for each partition, which one task then streams together. Folders are ones that the driver and all executors share."""

from __future__ import annotations

import csv
import io
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.config import SPLITS
from corvane.errors import PersistenceError
from corvane.operators.numbering import settled
from corvane.schemas import DURATION, MANIFEST_COLUMNS, SUMMARY_COLUMNS


#: What counts as the same type in a report.
KINDS = {T.StringType: "text", T.BooleanType: "truth", T.DoubleType: "number", T.FloatType: "number", T.IntegerType: "count", T.LongType: "count", T.ShortType: "count"}


def write_atomically(path: str, data: bytes) -> str:
    """Under another name first, flushed to disk, then renamed."""
    folder = os.path.dirname(path) or "."
    try:
        os.makedirs(folder, exist_ok=True)
        handle, part = tempfile.mkstemp(dir=folder, prefix=f".{os.path.basename(path)}.")
        try:
            with os.fdopen(handle, "wb") as f:
                f.write(data)
                f.flush()
                os.fsync(f.fileno())
            os.replace(part, path)
        except BaseException:
            os.unlink(part)
            raise
    except OSError as e:
        raise PersistenceError(f"{path} can't be written: {e}") from e
    return path


def write_json(path: str, value) -> str:
    return write_atomically(path, (json.dumps(value, indent=2, ensure_ascii=False) + "\n").encode())


def write_csv(path: str, columns, rows, bom: bool = False) -> str:
    """With a header, lines ended by CR LF, nulls empty, booleans as True and False."""
    out = io.StringIO(newline="")
    w = csv.writer(out)
    w.writerow(columns)
    w.writerows(["" if v is None else v for v in r] for r in rows)
    return write_atomically(path, out.getvalue().encode("utf-8-sig" if bom else "utf-8"))


def documents(df: DataFrame, folder: str) -> dict[str, str]:
    """A JSON file for each row of df(speaker_id, json), written whole or not at all by the task that has it; speakers and their paths, which is
    all that the driver gets. A task that is run again writes the same files."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            paths = [write_atomically(f"{folder}/{s}.json", (text + "\n").encode()) for s, text in zip(b["speaker_id"], b["json"])]
            yield pd.DataFrame({"speaker_id": b["speaker_id"], "path": paths})

    return {r["speaker_id"]: r["path"] for r in df.select("speaker_id", "json").mapInPandas(write, "speaker_id string, path string").collect()}


def long_documents(ends: DataFrame, items: DataFrame, folder: str) -> dict[str, str]:
    """documents() of any length: a file for each row of ends(speaker_id, head, tail), with the text of each of its items(speaker_id, place, text)
    between them, by place. Items are dealt by ranges, so a long document is written by many tasks, and streamed together by one; none holds more of it
    than an Arrow batch. Head, items and tail have a line each, all items but the first with a comma before; none has line feeds of its own."""
    spark, parts = ends.sparkSession, f"{folder}/.parts-{uuid.uuid4().hex}"
    make_folder(parts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tag, made, speaker, f = TaskContext.get().partitionId(), uuid.uuid4().hex, [], None, None
        try:
            for batch in batches:
                for s, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if f is None or s != speaker:
                        if f is not None:
                            f.close()
                        speaker, path = s, f"{parts}/{number}.{len(made)}.{tag}"
                        f = pafs.LocalFileSystem().open_output_stream(path, compression="zstd")
                        made.append((s, number, path))
                    f.write(f",{text}\n".encode())
        finally:
            if f is not None:
                f.close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), (pa.string(), pa.int32(), pa.string()))], names=["speaker_id", "number", "path"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                path, attempt = f"{folder}/{r['speaker_id']}.json", f"{parts}/{uuid.uuid4().hex}"
                with open(attempt, "wb") as out:
                    out.write(f"{r['head']}\n".encode())
                    for i, part in enumerate(r["parts"] or []):
                        with pafs.LocalFileSystem().open_input_stream(part["path"], compression="zstd") as f:
                            f.read(0 if i else 1)  # no comma before the first item
                            shutil.copyfileobj(f, out, 1 << 20)
                    out.write(f"{r['tail']}\n".encode())
                    out.flush()
                    os.fsync(out.fileno())
                os.replace(attempt, path)
                done.append(path)
            yield pa.RecordBatch.from_arrays([batch.column("speaker_id"), pa.array(done, pa.string())], names=["speaker_id", "path"])

    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = items.repartitionByRange(n, "speaker_id", "place").sortWithinPartitions("speaker_id", "place").select("speaker_id", "text")
        written = settled(dealt.mapInArrow(write, "speaker_id string, number int, path string"))  # a row for each speaker of a range
        by = written.groupBy("speaker_id").agg(F.sort_array(F.collect_list(F.struct("number", "path"))).alias("parts"))
        whole = ends.select("speaker_id", "head", "tail").join(by, "speaker_id", "left").repartition(n, "speaker_id")
        return {r["speaker_id"]: r["path"] for r in whole.mapInArrow(join, "speaker_id string, path string").collect()}
    finally:
        shutil.rmtree(parts, ignore_errors=True)


def table_csv(df: DataFrame, path: str, bom: bool = False) -> str:
    """df as write_csv has it, in the order of its partitions and of their rows, without passing through the driver."""
    columns, parts = df.columns, f"{path}.{uuid.uuid4().hex}"
    try:
        os.makedirs(parts)
    except OSError as e:
        raise PersistenceError(f"{path} can't be written: {e}") from e

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        attempt = f"{parts}/.{number}.{uuid.uuid4().hex}"
        with open(attempt, "w", encoding="utf-8", newline="") as f:
            w = csv.writer(f)
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    w.writerow(["" if v is None else v for v in row])
        os.replace(attempt, f"{parts}/{number:08d}")
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32())], names=["number"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sorted(n for batch in batches for n in batch.column(0).to_pylist())
        attempt = f"{parts}/.all"
        with open(attempt, "wb") as out:
            head = io.StringIO(newline="")
            csv.writer(head).writerow(columns)
            out.write(head.getvalue().encode("utf-8-sig" if bom else "utf-8"))
            for n in numbers:
                with open(f"{parts}/{n:08d}", "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
            out.flush()
            os.fsync(out.fileno())
        os.replace(attempt, path)
        yield pa.RecordBatch.from_arrays([pa.array([len(numbers)], pa.int32())], names=["number"])

    try:
        written = [r["number"] for r in df.mapInArrow(write, "number int").collect()]  # a number for each partition
        df.sparkSession.createDataFrame([(n,) for n in written], "number int").coalesce(1).mapInArrow(join, "number int").collect()
        if not written:
            write_csv(path, columns, [], bom)
    finally:
        shutil.rmtree(parts, ignore_errors=True)
    return path


def manifests(rows: DataFrame, folder: str, partial: str | None = None) -> dict[str, str]:
    """The compatible form of the manifest, a CSV a split, in the order of speakers and samples. parquet() has it by split."""
    out = {}
    for s in SPLITS:
        mine = rows.where(rows["split"] == s).orderBy("ordinal", "pos").select(*MANIFEST_COLUMNS)
        out[s] = table_csv(mine, f"{folder}/{s}_manifest{f'_{partial}' if partial else ''}.csv")
    return out


def parquet(rows: DataFrame, folder: str) -> None:
    rows.write.partitionBy("split").mode("overwrite").parquet(folder)


def report(gaps: DataFrame, summary: DataFrame, folder: str) -> dict[str, str]:
    """utterance_gaps, split_summary and speaker_summary as CSV with a byte order mark."""
    missing = set(DURATION.fieldNames()) - set(gaps.columns) | set(SUMMARY_COLUMNS) - set(summary.columns)
    if missing:
        raise TypeError(f"the report lacks columns: {sorted(missing)}")
    wrong = [f"{f.name} ({gaps.schema[f.name].dataType.simpleString()})" for f in DURATION.fields if KINDS[type(f.dataType)] != KINDS.get(type(gaps.schema[f.name].dataType))]
    if wrong:
        raise TypeError(f"the report has columns of another type: {wrong}")
    every = summary.collect()  # a row for each speaker, split and all
    pick = lambda levels: [tuple(r[c] for c in SUMMARY_COLUMNS) for r in every if r["level"] in levels]
    return {
        "utterance_gaps": table_csv(gaps.select(*DURATION.fieldNames()), f"{folder}/utterance_gaps.csv", bom=True),
        "split_summary": write_csv(f"{folder}/split_summary.csv", SUMMARY_COLUMNS, pick((0, 1)), bom=True),
        "speaker_summary": write_csv(f"{folder}/speaker_summary.csv", SUMMARY_COLUMNS, pick((2,)), bom=True),
    }


def make_folder(path: str) -> None:
    try:
        os.makedirs(path, exist_ok=True)
    except OSError as e:
        raise PersistenceError(f"{path} can't be made: {e}") from e


def remove(path: str) -> None:
    if os.path.exists(path):
        os.unlink(path)
