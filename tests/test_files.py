"""The format's files: written by tasks, read back as one plan."""

import os

import pytest

from corvane.errors import ManifestError
from corvane.plans import file_queries as Q
from corvane.plans.catalogue import ORACLE_SQL, QUERIES
from corvane.schemas import MANIFEST_COLUMNS
from corvane.sinks import files
from corvane.sources import manifest

SF = "/root/testdata/sf0.001"


def row(split, speaker, utterance, **more):
    v = {"split": split, "speaker_id": speaker, "utterance_id": utterance, "shard_path": f"/x/{speaker}.tar", "shard_member_prefix": f"{speaker}/{utterance}/", "frame_count": "2", "first_frame_index": "0", "last_frame_index": "1", "face_detection_ratio": "0.5", "audio_duration_sec": "0.1", "audio_sample_rate": "16000", "valid": "True"}
    return [(v | more)[c] for c in MANIFEST_COLUMNS]


def corpus(root, **rows):
    for split in ("train", "val", "test"):
        files.write_csv(f"{root}/gold/{split}_manifest.csv", MANIFEST_COLUMNS, rows.get(split, []))
    return str(root)


def test_documents_are_written_by_tasks(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i}", f'{{"x": "ä{i}"}}') for i in range(20)], "speaker_id string, json string").repartition(5)
    for _ in range(2):  # written anew, nothing else is left
        made = files.documents(df, str(tmp_path / "m"))
        assert made == {f"s{i}": f"{tmp_path}/m/s{i}.json" for i in range(20)}
        assert sorted(os.listdir(tmp_path / "m")) == sorted(f"s{i}.json" for i in range(20))
    assert (tmp_path / "m" / "s3.json").read_bytes() == '{"x": "ä3"}\n'.encode()
    assert files.documents(df.limit(0), str(tmp_path / "none")) == {}


def test_all_manifests_are_numbered_each_on_its_own(spark, tmp_path):
    root = corpus(tmp_path, train=[row("train", "s1", f"u{i}") for i in range(5)], test=[row("test", "s2", "a"), row("test", "s2", "b")])
    got = manifest.load_all(spark, root).orderBy("split", "manifest_index").select("split", "utterance_id", "manifest_index", "row_number").collect()
    assert [tuple(r) for r in got] == [("test", "a", 0, 2), ("test", "b", 1, 3), *[("train", f"u{i}", i, i + 2) for i in range(5)]]
    one = manifest.load(spark, root, "train").orderBy("manifest_index").select("utterance_id", "manifest_index").collect()
    assert [tuple(r) for r in one] == [(f"u{i}", i) for i in range(5)]


def test_the_first_bad_row_of_the_first_split_is_named(spark, tmp_path):
    root = corpus(tmp_path, train=[row("train", "s1", "a"), row("train", "s1", "b"), row("train", "s1", "c", valid="no")], test=[row("val", "s2", "a")])
    with pytest.raises(ManifestError, match="row 4: not marked valid"):
        manifest.load_all(spark, root)
    with pytest.raises(ManifestError, match="row 2: unexpected split"):
        manifest.load(spark, root, "test")
    rows = manifest.load_all(spark, root, strict=False)
    assert {(r.split, r.manifest_index, r.error) for r in rows.where("error is not null").collect()} == {("train", 2, "not marked valid"), ("val", 0, "unexpected split: val")}
    os.unlink(f"{root}/gold/val_manifest.csv")
    with pytest.raises(ManifestError, match="there is no manifest"):
        manifest.load_all(spark, root)
    with pytest.raises(ValueError, match="unknown split"):
        manifest.load_all(spark, root, ("dev",))


@pytest.mark.parametrize("name", ["gold_files", "partial_gold", "report_summaries"])
def test_files_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{SF}/lineitem.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [x[0] for x in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_an_empty_table_gives_empty_files(spark, tmp_path):
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(0).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert Q.gold_files(spark, str(tmp_path)).count() == 0
    assert [(r.split, r.described, r.utterances) for r in Q.partial_gold(spark, str(tmp_path)).orderBy("split").collect()] == [("test", 0, 0), ("train", 0, 0), ("val", 0, 0)]


def test_long_documents_are_written_by_many_tasks(spark, tmp_path):
    """No task gets a document whole: the tasks that write have ranges of its items."""
    import json

    from corvane.sources import metadata

    ends = spark.createDataFrame([(s, f'{{"id":"{s}","samples":[', '],"shard":{"path":"x"}}') for s in ("s1", "s2", "s3")], "speaker_id string, head string, tail string")
    ids = [f"ä{i:05d}" for i in range(5000)]
    items = spark.createDataFrame([("s1", i, f'{{"utterance_id":"{i}"}}') for i in reversed(ids)] + [("s2", "z", '{"utterance_id":"z"}')], "speaker_id string, place string, text string").repartition(5)
    folder = tmp_path / "m"
    for _ in range(2):
        assert files.long_documents(ends, items, str(folder)) == {s: f"{folder}/{s}.json" for s in ("s1", "s2", "s3")}
        assert sorted(x.name for x in folder.iterdir()) == ["s1.json", "s2.json", "s3.json"]
    for s, want in (("s1", ids), ("s2", ["z"]), ("s3", [])):
        doc = json.loads((folder / f"{s}.json").read_text())
        assert [x["utterance_id"] for x in doc["samples"]] == want and doc["id"] == s and doc["shard"] == {"path": "x"}
    got = metadata.lines(spark, str(folder)).where("kind = 'sample'").groupBy("speaker_id").count().collect()
    assert {r.speaker_id: r["count"] for r in got} == {"s1": 5000, "s2": 1}


def test_no_row_holds_a_speakers_document(spark, monkeypatch):
    import duckdb

    def refused(*_):
        raise AssertionError("a whole document in a row")

    monkeypatch.setattr(files, "documents", refused)
    from corvane.plans import corpus as plan

    monkeypatch.setattr(plan, "speaker_documents", refused)
    con = duckdb.connect()
    for t in ("lineitem", "events"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name in ("speaker_documents", "gold_files"):
        got = QUERIES[name](spark, SF)
        if name == "speaker_documents":
            con.execute("create macro round_even(x, n) as round(x, n)") if not con.execute("select count(*) from duckdb_functions() where function_name = 'round_even'").fetchone()[0] else None
        want = con.execute(ORACLE_SQL[name])
        columns = [x[0] for x in want.description]
        assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))
