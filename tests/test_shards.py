"""Shards written by several tasks, their commit and abort."""

import io
import os
import tarfile

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from corvane.sinks import shards

SCHEMA = "speaker_id string, utterance_id string, filename string, content binary"


def rows():
    out = [("s1", f"u{i % 37}", f"{i}.jpg", bytes([i % 256]) * (i * 7 % 3000)) for i in range(900)]
    out += [("s1", "long" * 40, "é" * 30 + ".jpg", b"x"), ("s2", "u", "audio.wav", b""), ("s10", "u", "0.jpg", b"y" * 512)]
    return out


def as_one(mine):
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w:") as t:
        for s, u, n, data in sorted(mine, key=lambda r: (r[1], r[2])):
            i = tarfile.TarInfo(f"{s}/{u}/{n}")
            i.size = len(data)
            t.addfile(i, io.BytesIO(data))
    return b.getvalue()


def test_many_tasks_write_what_one_writes(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    want = {s: as_one([r for r in rows() if r[0] == s]) for s in ("s1", "s2", "s10")}
    for tasks in (1, 3, 40):
        folder = tmp_path / str(tasks)
        got = {r.speaker_id: r for r in shards.package(df, str(folder), tasks).collect()}
        assert {x.name for x in folder.iterdir()} == {f"{s}.tar" for s in want}  # no parts, no attempts
        for s, data in want.items():
            assert (folder / f"{s}.tar").read_bytes() == data and got[s].size == len(data)
            assert got[s].members == sum(r[0] == s for r in rows())
        assert len({r.sha256 for r in got.values()}) == 3
    # again into the same place: replaced, others stay
    (tmp_path / "3/s9.tar").write_bytes(b"")
    shards.package(df.where("speaker_id = 's2'"), (tmp_path / "3").as_uri())
    assert (tmp_path / "3/s2.tar").read_bytes() == want["s2"] and (tmp_path / "3/s1.tar").read_bytes() == want["s1"] and (tmp_path / "3/s9.tar").exists()
    assert shards.package(df.limit(0), str(tmp_path / "none")).count() == 0


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    broken = df.withColumn("content", F.when(F.col("filename") == "600.jpg", F.expr("cast(raise_error('lost') as binary)")).otherwise(F.col("content")))
    shards.package(df.where("speaker_id = 's2'"), str(tmp_path))
    with pytest.raises(Exception, match="lost"):
        shards.package(broken, str(tmp_path), 8).collect()
    assert os.listdir(tmp_path) == ["s2.tar"]
    with pytest.raises(Exception, match="columns"):
        spark.dataSource.register(shards.ShardParts)
        df.drop("content").write.format("corvane_shard_parts").mode("append").save(str(tmp_path / "x"))


def test_commit_and_abort_of_the_writer(tmp_path):
    w = shards.PartWriter({"path": str(tmp_path / "p")})
    (tmp_path / "p").mkdir()
    (tmp_path / "p/left").write_bytes(b"of a task that was lost")
    w.commit([shards.Parts(1, [("s1", "x", 5, 1)]), None, shards.Parts(0, [])])
    assert (tmp_path / "p/parts.json").read_text() == '[{"speaker_id": "s1", "path": "x", "bytes": 5, "members": 1, "number": 1}]'
    w.abort([None])
    assert not (tmp_path / "p").exists()
    w.abort([])


def test_places_are_prefix_sums(spark):
    parts = spark.createDataFrame([("a", "p", 5, 1, 3), ("a", "q", 7, 1, 0), ("b", "r", 1, 1, 2), ("a", "s", 11, 1, 7)], "speaker_id string, path string, bytes long, members long, number int")
    assert {r.path: r.offset for r in shards.places(parts).collect()} == {"q": 0, "p": 7, "s": 12, "r": 0}


@pytest.mark.parametrize("uri", ["file:/tmp/x", "file:///tmp/x", "/tmp/x"])
def test_stores(uri):
    fs, path = shards.store(uri)
    assert path == "/tmp/x" and isinstance(fs, pafs.LocalFileSystem)


def test_shards_that_pass_are_there_a_wave_at_a_time(spark, tmp_path, monkeypatch):
    """Disk holds one wave's shards, and their parts compressed, not those of all speakers twice."""
    monkeypatch.setattr(shards, "shared_folder", lambda _: str(tmp_path))
    df = spark.createDataFrame([*rows(), ("s3", "u", "0.jpg", None)], SCHEMA)
    assert shards.waves(df, 1 << 30) == [["s1", "s10", "s2", "s3"]] and shards.waves(df, 1600) == [["s1"], ["s10", "s2"], ["s3"]] and shards.waves(df.limit(0), 1) == [[]]
    seen = []

    def use(info, folder):
        seen.append(sorted(x.name for x in tmp_path.rglob("*.tar")))
        return info.select("speaker_id", "size", "members")

    got = shards.passed(df, use, held=1600)
    assert seen == [["s1.tar"], ["s10.tar", "s2.tar"], ["s3.tar"]] and not list(tmp_path.rglob("*.tar"))
    want = shards.package(df, str(tmp_path / "all")).select("speaker_id", "size", "members")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ZeroDivisionError):
        shards.passed(df.where("speaker_id = 's2'"), lambda *_: 1 / 0)
    assert [x.name for x in tmp_path.rglob("*.tar") if x.parent.name == "shards"] == []


def test_parts_are_compressed(spark, tmp_path):
    spark.dataSource.register(shards.ShardParts)
    spark.createDataFrame([("s1", "u", f"{i}.jpg", b"x") for i in range(500)], SCHEMA).coalesce(1).write.format("corvane_shard_parts").mode("append").save(str(tmp_path))
    (part,) = tmp_path.glob("s1.*")
    assert part.stat().st_size * 10 < 500 * 1024


@pytest.mark.parametrize("name", ["shard_frame_read", "shards_packed", "shards_verified"])
def test_queries_over_shards_leave_none_and_equal_sql(spark, tmp_path, monkeypatch, name):
    import duckdb

    import __spark_entry__ as entry

    monkeypatch.setattr(shards, "shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(shards.passed, "__defaults__", (1 << 20,))
    sf = "/root/testdata/sf0.001"
    got = entry.queries()[name](spark, sf)
    assert len(list(tmp_path.glob("*-rows"))) > 1 and not list(tmp_path.rglob("*.tar"))
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{sf}/lineitem.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [x[0] for x in want.description]
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_records_made_together_are_those_made_alone():
    names = [f"s{i % 7}/{'u' * (i % 60)}/{i}.jpg" for i in range(2000)] + ["", "a" * 100, "a" * 101, "é/x/1"]
    contents = [bytes([i % 256]) * (0, 1, 511, 512, 513, 3000)[i % 6] for i in range(len(names))]
    contents[77] = b"x" * (shards.TOGETHER + 1)
    alone = [shards.head(n, len(c)) + c + bytes(-len(c) % 512) for n, c in zip(names, contents)]
    assert b"".join(shards.records(names, contents)) == b"".join(alone)
    plain = list(shards.records(names[:70], contents[:70]))
    assert plain == [b"".join(alone[:70])] and list(shards.records([], [])) == []


def test_shards_are_assembled_by_several_tasks(spark, tmp_path):
    """Their parts are few rows, which a session's defaults would put into one task."""
    df = spark.createDataFrame([(f"s{i % 9}", "u", f"{i}.jpg", b"x") for i in range(90)], SCHEMA)
    got = shards.package(df, str(tmp_path))
    assert got.rdd.glom().map(len).filter(bool).count() == 9 and got.count() == 9
