"""Processing state as an append-only log of events, one latest row a speaker.

An event has kind: start, transition, failure, done or reconcile. Numbers (seq) rise within a speaker. What a row of state
holds follows from the events since the last start, in one grouped aggregate without a sort.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane import objects
from corvane.config import RETRYABLE, STATUSES
from corvane.errors import PersistenceError
from corvane.schemas import EVENT

FIELDS = ("shard_path", "metadata_path", "shard_size_bytes", "shard_sha256", "video_source_used", "audio_source_used")


def event(speaker: str, seq: int, kind: str, ts: str, **more) -> dict:
    """A row of the log. kind failure and done imply their status."""
    given = more.pop("status", None)
    status = {"failure": "FAILED", "done": "DONE", "reconcile": "DONE"}.get(kind, given)
    if kind not in ("start", "transition", "failure", "done", "reconcile") or (status is not None and status not in STATUSES):
        raise PersistenceError(f"no such event: {kind} {status}")
    return dict.fromkeys(EVENT.fieldNames()) | {"speaker_id": speaker, "seq": seq, "kind": kind, "ts": ts, "status": status} | more


class Log:
    """The log in a folder, appended to by any number of drivers. A commit is a file of events in JSON lines, named by its number, and put there only
    if no other driver has taken that number; who comes second reads what is new, numbers the events anew and takes the next. Every `every`
    commits what is there so far is written once more as a snapshot in few files, so reading opens that and the commits since. Commits
    stay, for streams. Nothing but the numbers by speaker is held here."""

    def __init__(self, spark: SparkSession, folder: str, clock: Callable[[], str], every: int = 100):
        self.spark, self.folder, self.clock, self.every = spark, folder.rstrip("/"), clock, every
        self.last, self.seq = self._newest(), {}
        self.seq = {r["speaker_id"]: r["seq"] for r in self._upto(self.last).groupBy("speaker_id").agg(F.max("seq").alias("seq")).collect()}
        self._catch_up()

    def commits(self) -> str:
        """The folder of the commits' files, for streams."""
        return f"{self.folder}/commits"

    def _commit(self, n: int) -> str:
        return f"{self.commits()}/{n:012d}.json"

    def _newest(self) -> int:
        """The number of the newest snapshot that is whole; 0 without any."""
        return max((int(x.removesuffix(".done")) for x in objects.names(f"{self.folder}/snapshots") if x.endswith(".done")), default=0)

    def _numbers(self, after: int) -> list[int]:
        return sorted(n for x in objects.names(self.commits()) if x.endswith(".json") and x[:-5].isdigit() and (n := int(x[:-5])) > after)

    def _upto(self, snapshot: int) -> DataFrame:
        return self.spark.read.schema(EVENT).parquet(f"{self.folder}/snapshots/{snapshot:012d}") if snapshot else self.spark.createDataFrame([], EVENT)

    def events(self) -> DataFrame:
        """All events: the newest snapshot and the commits after it."""
        newest = self._newest()
        files = [self._commit(n) for n in self._numbers(newest)]
        old = self._upto(newest)
        return old.unionByName(self.spark.read.schema(EVENT).json(files)) if files else old

    def _catch_up(self) -> None:
        """Numbers of events that other drivers have committed."""
        for n in self._numbers(self.last):
            for line in objects.read(self._commit(n)).decode().splitlines():
                e = json.loads(line)
                self.seq[e["speaker_id"]] = max(e["seq"], self.seq.get(e["speaker_id"], 0))
            self.last = n

    def add(self, *events: tuple[str, str, dict]) -> None:
        """(speaker, kind, fields) each, in order; one commit. ts is the clock's unless it is given."""
        if not events:
            return
        now = [self.clock() if more.get("ts") is None else more["ts"] for _, _, more in events]
        for attempt in range(1000):
            seq, rows = dict(self.seq), []
            for (speaker, kind, more), ts in zip(events, now):
                seq[speaker] = seq.get(speaker, 0) + 1
                rows.append(event(speaker, seq[speaker], kind, ts, **{k: v for k, v in more.items() if k != "ts"}))
            if objects.put_if_absent(self.spark, self._commit(self.last + 1), "".join(json.dumps(r) + "\n" for r in rows).encode()):
                self.last, self.seq = self.last + 1, seq
                if self.last % self.every == 0:
                    self.snapshot()
                return
            if attempt:
                time.sleep(random.random() * min(1.0, 0.01 * 2**attempt))
            self._catch_up()
        raise PersistenceError(f"{self.folder}: 1000 attempts to commit came second")

    def extend(self, events: DataFrame) -> None:
        """Events made by an operator, a few a speaker; they get the log's next numbers."""
        names = [f for f in EVENT.fieldNames() if f not in ("speaker_id", "kind", "seq")]
        rows = events.select(*EVENT.fieldNames()).orderBy("seq").collect()
        self.add(*((r["speaker_id"], r["kind"], {f: r[f] for f in names if r[f] is not None}) for r in rows))

    def snapshot(self) -> None:
        """What is there up to this driver's last commit, compacted. Another driver may write the same one: the files are put in place under a name of
        this attempt, and the mark that names them only once."""
        if self._newest() >= self.last:
            return
        upto = self._upto(newest := self._newest())
        files = [self._commit(n) for n in self._numbers(newest) if n <= self.last]
        df = upto.unionByName(self.spark.read.schema(EVENT).json(files))
        path = f"{self.folder}/snapshots/{self.last:012d}"
        try:
            df.coalesce(max(1, len(files) // 10_000)).write.mode("errorifexists").parquet(path)
        except AnalysisException:
            return  # another driver is writing it
        objects.put_if_absent(self.spark, f"{path}.done", b"")


def latest(events: DataFrame) -> DataFrame:
    """A row for each speaker that has events."""
    start = F.max(F.when(F.col("kind") == "start", F.col("seq"))).over(Window.partitionBy("speaker_id"))
    e = events.withColumn("_start", F.coalesce(start, F.lit(-1)))
    now, seq = F.col("seq") >= F.col("_start"), F.col("seq")
    begun = (F.col("kind") == "start") | (F.col("status").isNotNull() & ~F.col("status").isin("PENDING", "DONE"))
    done = F.col("kind").isin("done", "reconcile")
    clears = F.col("kind").isin("start", "done", "reconcile")
    return e.groupBy("speaker_id").agg(
        F.coalesce(F.max_by("status", F.when(F.col("status").isNotNull(), seq)), F.lit("PENDING")).alias("status"),
        F.count_if(F.col("kind") == "start").alias("attempt_count"),
        F.min_by("ts", F.when(begun & now, seq)).alias("started_at"),
        F.max_by("ts", F.when(done & now & ((F.col("kind") == "done")), seq)).alias("_done"),
        F.min_by("ts", F.when(done & now, seq)).alias("_first_done"),
        F.max_by(F.when(F.col("kind") == "failure", F.col("error")), F.when(clears | (F.col("kind") == "failure"), seq)).alias("last_error"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c) for c in FIELDS],
        F.max("seq").alias("seq"),
    ).withColumn("completed_at", F.coalesce("_done", "_first_done")).drop("_done", "_first_done")


def state(catalogue: DataFrame, events: DataFrame) -> DataFrame:
    """latest() for all speakers of the catalogue; those without events are PENDING."""
    df = catalogue.select("speaker_id").join(latest(events), "speaker_id", "left")
    return df.withColumns({"status": F.coalesce("status", F.lit("PENDING")), "attempt_count": F.coalesce("attempt_count", F.lit(0))})


def with_retry(states: DataFrame) -> DataFrame:
    return states.withColumns({"is_done": F.col("status") == "DONE", "should_retry": F.col("status").isin(*RETRYABLE)})


def all_done(states: DataFrame) -> bool:
    return bool(states.agg(F.coalesce(F.bool_and(F.col("status") == "DONE"), F.lit(False))).first()[0])


def transitions(events: DataFrame) -> DataFrame:
    """Events with the status before."""
    order = Window.partitionBy("speaker_id").orderBy("seq")
    return events.where("status is not null").withColumn("previous_status", F.coalesce(F.lag("status").over(order), F.lit("PENDING")))


def verified(states: DataFrame, inventory: DataFrame) -> DataFrame:
    """Whether each speaker's artefacts are there: inventory(speaker_id, shard_size, shard_sha, has_metadata) comes from the configured root,
    not from paths in the state. A size or digest that wasn't recorded isn't compared."""
    df = states.join(inventory, "speaker_id", "left")
    same = lambda want, got: want.isNull() | (want == F.coalesce(got.cast("string"), F.lit("")))
    want_sha = F.nullif(F.col("shard_sha256"), F.lit(""))
    ok = F.col("shard_size").isNotNull() & F.coalesce("has_metadata", F.lit(False)) & same(F.col("shard_size_bytes").cast("string"), F.col("shard_size")) & same(want_sha, F.col("shard_sha"))
    return df.withColumn("verified", ok)


def to_process(checked: DataFrame, force: bool = False) -> DataFrame:
    """Speakers whose artefacts don't verify, whatever their status; all with force."""
    return checked if force else checked.where("not verified")


def reconciled(checked: DataFrame, shards: str, metadata: str, ts: str) -> DataFrame:
    """Events that bring the state of verified speakers up to date; none where it is so already."""
    shard, meta = F.concat(F.lit(f"{shards}/"), "speaker_id", F.lit(".tar")), F.concat(F.lit(f"{metadata}/"), "speaker_id", F.lit(".json"))
    same = (F.col("status") == "DONE") & F.equal_null("shard_path", shard) & F.equal_null("metadata_path", meta) & F.col("last_error").isNull() & F.col("completed_at").isNotNull()
    new = checked.where(F.col("verified") & ~same).select("speaker_id", (F.coalesce("seq", F.lit(0)) + 1).cast("bigint").alias("seq"), F.lit("reconcile").alias("kind"), F.lit("DONE").alias("status"), F.lit(ts).alias("ts"), shard.alias("shard_path"), meta.alias("metadata_path"))
    return new.select(*[F.col(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT.fields])
