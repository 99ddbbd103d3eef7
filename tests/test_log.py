"""The state log with several writers, its snapshots, and the same log as a stream."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from corvane import objects
from corvane.operators import state
from corvane.streaming import state as stream


def test_put_if_absent(spark, tmp_path):
    path = str(tmp_path / "a/b")
    assert objects.put_if_absent(spark, path, b"1") and not objects.put_if_absent(spark, f"file://{path}", b"2")
    assert objects.read(path) == b"1" and objects.names(str(tmp_path / "a")) == ["b"] and objects.names(str(tmp_path / "none")) == []
    # the form for other stores, here on the local one
    folder = (tmp_path / "c").as_uri()
    assert objects._renamed(spark, folder, "x", b"1") and not objects._renamed(spark, folder, "x", b"2")
    assert (tmp_path / "c/x").read_bytes() == b"1"


def test_two_drivers_interleave(spark, tmp_path):
    a, b = state.Log(spark, str(tmp_path), lambda: "a"), state.Log(spark, str(tmp_path), lambda: "b")
    a.add(("s1", "start", {}), ("s2", "start", {}))
    b.add(("s1", "transition", {"status": "QC"}))
    b.add(("s1", "failure", {"error": "e"}))
    a.add(("s1", "start", {}), ("s2", "transition", {"status": "QC"}))
    b.extend(spark.createDataFrame([("s2", 1, "reconcile", "DONE", "r")], "speaker_id string, seq long, kind string, status string, ts string").select(*[F.col(f.name) if f.name in ("speaker_id", "seq", "kind", "status", "ts") else F.lit(None).cast(f.dataType).alias(f.name) for f in state.EVENT.fields]))
    got = [tuple(r) for r in a.events().select("speaker_id", "seq", "kind", "ts").orderBy("speaker_id", "seq").collect()]
    assert got == [("s1", 1, "start", "a"), ("s1", 2, "transition", "b"), ("s1", 3, "failure", "b"), ("s1", 4, "start", "a"), ("s2", 1, "start", "a"), ("s2", 2, "transition", "a"), ("s2", 3, "reconcile", "r")]
    a.add()
    with pytest.raises(state.PersistenceError):
        a.add(("s1", "nonsense", {}))
    assert state.Log(spark, str(tmp_path), lambda: "c").seq == {"s1": 4, "s2": 3}


def test_many_drivers_at_once(spark, tmp_path):
    logs = [state.Log(spark, str(tmp_path), lambda: "t", every=20) for _ in range(4)]

    def work(log, k):
        for i in range(25):
            log.add((f"s{(i + k) % 3}", "start", {}), ("all", "transition", {"status": "QC", "error": f"{k}.{i}"}))

    threads = [threading.Thread(target=work, args=(x, k)) for k, x in enumerate(logs)]
    [t.start() for t in threads], [t.join() for t in threads]
    rows = logs[0].events().collect()
    seqs = lambda s: sorted(r.seq for r in rows if r.speaker_id == s)
    assert len(rows) == 200 and seqs("all") == list(range(1, 101)) and len({r.error for r in rows if r.speaker_id == "all"}) == 100
    assert all(seqs(f"s{i}") == list(range(1, len(seqs(f"s{i}")) + 1)) for i in range(3))


def test_reading_after_many_commits_opens_few_files(spark, tmp_path):
    log = state.Log(spark, str(tmp_path), lambda: "t")
    for i in range(1000):
        log.add((f"s{i % 5}", "start", {}))
    events = log.events()
    assert events.count() == 1000 and len(events.inputFiles()) <= 100
    assert len(objects.names(log.commits())) == 1000
    log.add(("s1", "start", {}))
    again = state.Log(spark, str(tmp_path), lambda: "t")
    assert again.seq == {"s0": 200, "s1": 201, "s2": 200, "s3": 200, "s4": 200} and again.last == 1001
    # a snapshot that was left without its mark isn't read
    (tmp_path / "snapshots/000000001001").mkdir()
    assert state.Log(spark, str(tmp_path), lambda: "t").seq == again.seq


def test_stream_equals_latest_after_each_batch(spark, tmp_path):
    r = random.Random(5)
    log = state.Log(spark, str(tmp_path / "log"), lambda: f"2024-01-01T{r.randint(0, 23):02d}:00:00", every=1000)
    kinds = ["start", "transition", "failure", "done", "reconcile"]

    def commit(n):
        for _ in range(n):
            log.add(*((f"s{r.randint(1, 4)}", k, ({"status": r.choice(["QC", "PENDING", "UPLOADING"])} if k == "transition" else {"error": r.choice(["x", None])} if k == "failure" else {}) | ({"shard_path": str(r.random())} if r.random() < 0.3 else {}) | ({"shard_size_bytes": r.randint(1, 9)} if r.random() < 0.3 else {})) for k in r.choices(kinds, k=r.randint(1, 4))))

    shown: dict = {}

    def take(df, _):
        shown.update({x.speaker_id: x.asDict() for x in df.collect()})

    def run():
        out = stream.latest(stream.events(spark, str(tmp_path / "log"), 3)).writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert out.awaitTermination(300)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for batch in range(3):  # each a restart from the checkpoint
            commit(6)
            if batch == 1:  # a repeat of a commit, as a second driver's copy of the file would be
                (tmp_path / "log/commits/repeat.json").write_bytes(objects.read(log._commit(2)))
            run()
            want = {x.speaker_id: x.asDict() for x in state.latest(log.events()).collect()}
            diff = {(s, k): (shown[s][k], v) for s, row in want.items() for k, v in row.items() if shown[s][k] != v}
            assert not diff and shown == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_failures_by_hour(spark, tmp_path):
    log = state.Log(spark, str(tmp_path / "log"), lambda: "2024-01-01T00:10:00")
    log.add(("s1", "start", {}), ("s1", "failure", {}), ("s2", "failure", {}))
    q = stream.failures_by_hour(stream.events(spark, str(tmp_path / "log"))).writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("hours").first().failures == 2
    assert json.loads(objects.read(log._commit(1)).splitlines()[0])["kind"] == "start"
