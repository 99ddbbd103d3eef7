"""State events as a stream: the commits of operators.state.Log, read as they come."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corvane import objects
from corvane.operators.state import FIELDS
from corvane.schemas import EVENT

#: A row of state, as operators.state.latest has it, and what it takes to go on from there.
ROW = T.StructType([T.StructField("speaker_id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("attempt_count", T.LongType()), T.StructField("started_at", T.StringType()), T.StructField("last_error", T.StringType()), *(EVENT[f] for f in FIELDS), T.StructField("seq", T.LongType()), T.StructField("completed_at", T.StringType())])
KEPT = T.StructType([*ROW.fields[1:-1], T.StructField("done_at", T.StringType()), T.StructField("first_done_at", T.StringType())])
WHOLE = [f.name for f in EVENT.fields if isinstance(f.dataType, T.LongType)]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def events(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """New events of the log in folder, each file once."""
    read = spark.readStream.schema(EVENT)
    read = read.option("maxFilesPerTrigger", files_at_once) if files_at_once else read
    return read.json(f"{folder.rstrip('/')}/commits")


def step(s: dict, e: dict) -> None:
    """What an event makes of a speaker's state. Numbers up to the state's are repeats."""
    if e["seq"] <= s["seq"]:
        return
    kind, status = e["kind"], e["status"]
    s["seq"] = e["seq"]
    s["status"] = status or s["status"]
    if kind == "start":
        s |= {"attempt_count": s["attempt_count"] + 1, "started_at": e["ts"], "done_at": None, "first_done_at": None}
    elif s["started_at"] is None and status not in (None, "PENDING", "DONE"):
        s["started_at"] = e["ts"]
    if kind in ("start", "done", "reconcile", "failure"):
        s["last_error"] = e["error"] if kind == "failure" else None
    if kind == "done":
        s["done_at"] = e["ts"]
    if kind in ("done", "reconcile") and s["first_done_at"] is None:
        s["first_done_at"] = e["ts"]
    s |= {f: e[f] for f in FIELDS if e[f] is not None}


class Latest(StatefulProcessor):
    """A speaker's row, kept from batch to batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = KEPT.fieldNames()
        before = self.kept.get()
        s = dict(zip(names, before)) if before is not None else dict.fromkeys(names) | {"status": "PENDING", "attempt_count": 0, "seq": 0}
        got = pd.concat(rows).sort_values("seq", kind="stable")
        for e in got.astype(object).where(got.notna(), None).to_dict("records"):
            step(s, e | {f: int(e[f]) for f in WHOLE if e[f] is not None})  # a column with nulls comes as doubles
        self.kept.update(tuple(s[n] for n in names))
        row = s | {"speaker_id": key[0], "completed_at": s["done_at"] or s["first_done_at"]}
        yield pd.DataFrame({f.name: pd.Series([row[f.name]], dtype="Int64" if isinstance(f.dataType, T.LongType) else object) for f in ROW.fields})

    def close(self) -> None:
        pass


def latest(stream: DataFrame) -> DataFrame:
    """The rows of state that a batch changes, as operators.state.latest has them after it (output mode update). Its state is kept in RocksDB, which
    this sets for the session."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return stream.groupBy("speaker_id").transformWithStateInPandas(Latest(), ROW, "Update", "None")


def failures_by_hour(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Failures an hour of event time; events later than `late` are dropped, and so is old state."""
    timed = stream.where("kind = 'failure'").withColumn("at", F.to_timestamp("ts")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour").alias("hour")).agg(F.count("*").alias("failures"))


def followed(out: DataFrame, folder: str, tasks: int | None = None) -> None:
    """Take all that is there now through a stream in output mode update, going on from where the run before ended. Each batch's rows are written to a
    folder of its number, so a batch that is done again after a failure replaces its own. The state is dealt to `tasks` tasks (the session's shuffle
    partitions, unless given) for as long as the checkpoint is used; each holds a database with some MB of files of its own, so few keys want few."""

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    run = out.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    conf, key = out.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(tasks or before))
    try:
        query = run.start()  # takes the settings as they are now
    finally:
        conf.set(key, before)
    query.awaitTermination()


def shown(out: DataFrame, folder: str, *keys: str) -> DataFrame:
    """What `followed` has written of the stream `out`: the last row of each key."""
    spark, schema = out.sparkSession, out.schema
    if not objects.names(f"{folder}/rows"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{folder}/rows")
    rest = [c for c in schema.fieldNames() if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last")).select(*keys, "_last.*").select(*schema.fieldNames())
