"""Streams that are followed in pieces, and the queries over them, on odd tables."""

from pyspark.sql import functions as F

from corvane.operators import state
from corvane.plans import stream_queries
from corvane.streaming import state as stream


def test_rows_are_kept_over_restarts_and_repeats(spark, tmp_path):
    log, folder = state.Log(spark, str(tmp_path / "log"), lambda: "2024-01-01T00:10:00Z"), str(tmp_path / "out")
    out = lambda: stream.failures_by_hour(stream.events(spark, log.folder))
    log.add(("s1", "start", {}))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream.followed(out(), folder, 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and len([x for x in (tmp_path / "out/checkpoint/state/0").iterdir() if x.name.isdigit()]) == 3
    assert stream.shown(out(), folder, "hour").count() == 0
    for n in (1, 2):  # the hour stays open from one run to the next
        log.add(("s1", "failure", {"error": "e"}))
        stream.followed(out(), folder)
        stream.followed(out(), folder)  # nothing new: nothing is counted twice
        assert [r.failures for r in stream.shown(out(), folder, "hour").collect()] == [n]
    # a batch that is written again replaces its own rows
    newest = max(int(x.name.split("=")[1]) for x in (tmp_path / "out/rows").iterdir())
    again = spark.read.parquet(f"{folder}/rows/batch={newest}").cache()
    again.count()
    again.write.mode("overwrite").parquet(f"{folder}/rows/batch={newest}")
    assert [r.failures for r in stream.shown(out(), folder, "hour").collect()] == [2]


def test_nothing_followed_yet(spark, tmp_path):
    out = spark.createDataFrame([], "k string, n long")
    assert stream.shown(out, str(tmp_path / "none"), "k").columns == ["k", "n"] and stream.shown(out, str(tmp_path / "none"), "k").count() == 0


def test_queries_on_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string"
    big = "é" * (stream_queries.LIMIT // 2 + 1)
    rows = [(0, ""), (1, None), (7, big), (7 + stream_queries.ARCHIVES, big[1:]), (None, "no id"), (stream_queries.BROKEN, "gone"), (9, "x")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "some/documents.parquet"))
    got = {r.name: (r.size, r.error) for r in stream_queries.archives_read(spark, str(tmp_path / "some")).collect()}
    long = "Oversized member s7/7/text.txt: 4098 bytes"
    assert got == {"s0/0/text.txt": (0, None), "s1/1/text.txt": (0, None), "s7/7/text.txt": (4098, long), "s7/71/text.txt": (4096, None), "s9/9/text.txt": (1, None), "s3.tar": (None, "unreadable")}
    spark.createDataFrame([], schema).coalesce(1).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert stream_queries.archives_read(spark, str(tmp_path / "none")).count() == 0
    empty = spark.createDataFrame([], schema)
    assert stream_queries.logged(empty).count() == 0
    assert stream_queries.logged(spark.createDataFrame([(0, ""), (1, "")], schema)).orderBy("seq").select("speaker_id", "kind", "ts", F.col("error")).collect()[1] == ("s1", "failure", "2024-01-01T00:01:00Z", "e1")
