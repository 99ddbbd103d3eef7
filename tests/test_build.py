"""Building a corpus from archives, with media that are stood in for."""

import io
import json
import logging
import tarfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane import cli, logs
from corvane.config import CorpusConfig
from corvane.errors import DownloadError
from corvane.operators import state
from corvane.plans import build
from corvane.schemas import EVENT


def reader():
    def read(data):
        words = dict(x.split("=") for x in bytes(data).decode().split(";"))  # raises for what is no video
        return float(words["fps"]), lambda: [np.full((20, 30, 3), i) for i in range(int(words["n"]))]

    return read


def detector():
    return lambda frames: [None if f[0, 0, 0] == 9 else [1, 2, 11, 12] for f in frames]


def encoder():
    return lambda crop: b"jpg %d %dx%d" % (crop[0, 0, 0], crop.shape[1], crop.shape[0]) if crop[0, 0, 0] != 8 else None


def converter():
    def convert(data):
        data = bytes(data)
        if data == b"bad":
            raise OSError
        return b"RIFF" + data, 0.01 if data == b"short" else 1.0, 8000 if data == b"slow" else 16000, 1

    return convert


def tar_of(path, items, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, mode) as t:
        for name, data in items:
            i = tarfile.TarInfo(name)
            i.size = len(data)
            t.addfile(i, io.BytesIO(data))


def zip_of(path, items):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, data in items:
            z.writestr(name, data)


@pytest.fixture
def raw(tmp_path):
    d = tmp_path / "raw"
    zip_of(d / "s1v.zip", [("x/s1/BBAF2N.mpg", b"fps=25;n=12"), ("x/s1/novoice.mpg", b"fps=25;n=12"), ("x/s1/slowv.mpg", b"fps=20;n=12"), ("x/s1/broken.mpg", b"?"), ("x/s1/few.mpg", b"fps=25;n=3"), ("x/s1/mute.mpg", b"fps=25;n=12"), ("x/readme.txt", b"")])
    tar_of(d / "s1a.tgz", [(f"s1/{u}.WAV", w) for u, w in [("bbaf2n", b"ok"), ("slowv", b"ok"), ("broken", b"ok"), ("few", b"ok"), ("mute", b"bad"), ("noface", b"ok")]], "w:gz")
    zip_of(d / "s2v.zip", [("v/u.mpg", b"fps=25;n=10")])
    tar_of(d / "both.tar", [("all/s2/u.wav", b"two"), ("all/s4/u.wav", b"four")])
    zip_of(d / "s4v.zip", [("v/u.mpg", b"fps=25;n=10")])
    zip_of(d / "s5v.zip", [("v/u.mpg", b"fps=25;n=10")])
    tar_of(d / "s5a.tar", [("a/u.txt", b"")])
    (d / "s6v.zip").write_bytes(b"PK\x03\x04 no archive")
    zip_of(d / "s7v.zip", [("v/u.mpg", b"fps=25;n=0")])
    tar_of(d / "s7a.tar", [("a/u.wav", b"ok")])
    return d


def media_of(raw):
    found = {"s1": ("s1v.zip", "s1a.tgz", "primary", "primary"), "s2": ("s2v.zip", "both.tar", "primary", "zenodo_fallback"), "s4": ("s4v.zip", "both.tar", "primary", "zenodo_fallback"), "s5": ("s5v.zip", "s5a.tar", "primary", "primary"), "s6": ("s6v.zip", "s5a.tar", "primary", "primary"), "s7": ("s7v.zip", "s7a.tar", "primary", "primary")}

    def acquire(speaker):
        if speaker not in found:
            raise DownloadError(f"no source for {speaker}")
        v, a, *names = found[speaker]
        return (f"{raw}/{v}", f"{raw}/{a}", *names)

    return build.Media(acquire, reader, detector, encoder, converter)


def test_speakers_become_shards_metadata_and_state(spark, tmp_path, raw, caplog):
    c = CorpusConfig(root=str(tmp_path / "d"))
    with caplog.at_level(logging.INFO, "corvane"):
        logging.getLogger("corvane").propagate = True
        states = {r.speaker_id: r for r in build.build(spark, c, ["s1", "s2", "s3", "s4", "s5", "s7"], media_of(raw), clock=lambda: "t").collect()}
    assert {s: states[s].status for s in ("s1", "s2", "s3", "s4", "s5", "s7", "s8")} == {"s1": "DONE", "s2": "DONE", "s3": "FAILED", "s4": "DONE", "s5": "FAILED", "s7": "FAILED", "s8": "PENDING"}
    assert states["s3"].last_error == "no source for s3" and states["s5"].last_error == "there are no audio files" and states["s7"].last_error == "no valid utterances after the checks"
    assert states["s1"].attempt_count == 1 and states["s1"].audio_source_used == "primary" and states["s2"].audio_source_used == "zenodo_fallback"
    doc = json.loads((tmp_path / "d/silver/metadata/s1.json").read_text())
    got = {x["utterance_id"]: x["invalid_reason"] for x in doc["samples"]}
    assert got == {"bbaf2n": None, "novoice": "MISSING_AUDIO", "noface": "MISSING_VIDEO", "slowv": "INVALID_FPS", "broken": "VIDEO_DECODE_FAILED", "few": "INSUFFICIENT_CONSECUTIVE_FACE_FRAMES", "mute": "AUDIO_CONVERSION_FAILED"}
    with tarfile.open(f"{c.shards}/s1.tar") as t:
        names = t.getnames()
        assert names == sorted(names) and set(names) == {"s1/bbaf2n/audio.wav", *(f"s1/bbaf2n/{i}.jpg" for i in (*range(8), 10, 11))}
        assert t.extractfile("s1/bbaf2n/3.jpg").read() == b"jpg 3 10x10" and t.extractfile("s1/bbaf2n/audio.wav").read() == b"RIFFok"
    first = next(x for x in doc["samples"] if x["valid"])
    assert first["detected_frame_indices"] == [*range(8), 10, 11] and first["face_detection_ratio"] == 0.8333 and doc["shard"]["sha256"] == states["s1"].shard_sha256
    for s, text in (("s2", b"RIFFtwo"), ("s4", b"RIFFfour")):  # of the archive for all speakers only what is theirs
        with tarfile.open(f"{c.shards}/{s}.tar") as t:
            assert t.extractfile(f"{s}/u/audio.wav").read() == text
    assert "[s1] INVALID_FPS: 1" in caplog.text and "[s5] there are no audio files" in caplog.text

    # again: what verifies is left alone, whatever its state; what doesn't is done anew
    log = state.Log(spark, f"{c.state}/log", lambda: "t2")
    n = log.events().count()
    log.add(("s4", "transition", {"status": "QC"}))
    (tmp_path / "d/silver/shards/s2.tar").write_bytes(b"damaged")
    states = {r.speaker_id: r for r in build.build(spark, c, ["s1", "s2", "s4"], media_of(raw), clock=lambda: "t3").collect()}
    assert [states[s].status for s in ("s1", "s2", "s4")] == ["DONE"] * 3 and [states[s].attempt_count for s in ("s1", "s2", "s4")] == [1, 2, 1]
    events = [(r.speaker_id, r.kind) for r in log.events().where("ts <> 't'").orderBy("speaker_id", "seq").collect()]
    assert [k for s, k in events if s == "s1"] == [] and [k for s, k in events if s == "s4"] == ["transition", "reconcile"] and log.events().count() > n
    states = {r.speaker_id: r for r in build.build(spark, c, ["s1"], media_of(raw), force=True, limit=1).collect()}
    assert states["s1"].attempt_count == 2 and json.loads((tmp_path / "d/silver/metadata/s1.json").read_text())["summary"]["total_candidates"] == 1


def test_one_broken_archive_fails_its_speaker_only(spark, tmp_path, raw):
    c = CorpusConfig(root=str(tmp_path / "d"))
    states = {r.speaker_id: r for r in build.build(spark, c, ["s2", "s6"], media_of(raw)).collect()}
    assert states["s2"].status == "DONE" and states["s6"].status == "FAILED" and "s6v.zip can't be read" in states["s6"].last_error


def test_dry_runs_open_nothing(spark, tmp_path):
    c = CorpusConfig(root=str(tmp_path / "d"))
    states = {r.speaker_id: r.status for r in build.build(spark, c, ["s1"], None, dry_run=True).collect()}
    assert states["s1"] == "EXTRACTING" and not (tmp_path / "d/gold").exists()


def test_gold_follows_when_all_are_done(spark, tmp_path, raw):
    c = CorpusConfig(root=str(tmp_path / "d"))
    m = media_of(raw)
    small = CorpusConfig(root=c.root, excluded=tuple(f"s{i}" for i in range(1, 35) if i not in (2, 4)), train=1, val=1, test=0)
    build.build(spark, small, ["s2"], m)
    assert not (tmp_path / "d/gold").exists()
    build.build(spark, small, ["s2", "s4"], m)
    assert json.loads((tmp_path / "d/gold/split_metadata.json").read_text())["utterance_counts"] == {"train": 1, "val": 1, "test": 0}


def test_log_numbers_go_on(spark, tmp_path):
    clock = iter(map(str, range(100)))
    log = state.Log(spark, str(tmp_path / "log"), lambda: next(clock))
    assert log.events().count() == 0
    log.add(("s1", "start", {}), ("s1", "transition", {"status": "QC"}), ("s2", "start", {}))
    log = state.Log(spark, str(tmp_path / "log"), lambda: next(clock))
    log.add(("s1", "failure", {"error": "x"}))
    log.extend(spark.createDataFrame([tuple(state.event("s2", 2, "done", "9").values())], EVENT))
    log.add(("s2", "start", {}))
    assert [(r.speaker_id, r.seq, r.kind) for r in log.events().orderBy("speaker_id", "seq").collect()] == [("s1", 1, "start"), ("s1", 2, "transition"), ("s1", 3, "failure"), ("s2", 1, "start"), ("s2", 2, "done"), ("s2", 3, "start")]
    assert {r.speaker_id: (r.status, r.last_error) for r in state.latest(log.events()).collect()}["s1"] == ("FAILED", "x")


def test_command_line(spark, tmp_path, raw, capsys, monkeypatch):
    root = str(tmp_path / "d")
    assert cli.main(["build", "--speaker", "s21", "--root", root, "--dry-run"]) == 1 and cli.main(["build", "--speaker", "x", "--root", root, "--dry-run"]) == 1
    assert cli.main(["build", "--speaker", "s2", "--root", root]) == 1
    assert cli.main(["build", "--speaker", "s2", "--root", root, "--dry-run"]) == 0
    monkeypatch.setattr("tests.test_build.MEDIA", media_of(raw), raising=False)
    assert cli.main(["build", "--speaker", "s2", "--root", root, "--media", "tests.test_build:MEDIA"]) == 0
    monkeypatch.setattr(build, "build", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    assert cli.main(["build", "--all", "--root", root, "--dry-run"]) == 130
    assert "DONE: 1" in (tmp_path / "d/logs/build.log").read_text()
    (tmp_path / "d/gold").mkdir()
    (tmp_path / "d/gold/train_manifest.csv").write_text("split,speaker_id,shard_path,valid\ntrain,s1,/secret/s1.tar,True\ntrain,s2,x,True\ntrain,s3,x,True\n")
    (tmp_path / "d/gold/split_metadata.json").write_text(json.dumps({"seed": 42, "train_speakers": ["s1", "s2"], "missing_speakers": ["/x"], "utterance_counts": {"train": 5, "note": "n"}}))
    (tmp_path / "d/state/processing_state.json").write_text(json.dumps({"speakers": {"s1": {"status": "DONE"}, "s2": {}}}))
    (tmp_path / "d/silver/metadata/a.json").write_text("{oops")
    text = cli.inspect(spark, root)
    for x in ("[shards by size] 1 archives", "  s2.tar (", "a.json: can't be read as JSON", "keys of the first: audio_channels", "{'split': 'train', 'speaker_id': 's1', 'valid': 'True'}", "train_speakers: 2 (s1, s2)", "missing_speakers: 1\n", "utterance_counts: note, train; {'train': '5'}", "speakers: 2; {", "[metadata documents] 2"):
        assert x in text, (x, text)
    assert "/secret" not in text and str(tmp_path) not in text and "'s3'" not in text


def test_one_sample_on_the_command_line(spark, tmp_path, raw, capsys):
    import wave

    c = CorpusConfig(root=str(tmp_path / "d"), excluded=tuple(f"s{i}" for i in range(1, 35) if i not in (2, 4)), train=1, val=1, test=0)
    sound = io.BytesIO()
    with wave.open(sound, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000), w.writeframes(bytes(3200))
    m = media_of(raw)
    m = build.Media(m.acquire, m.reader, m.detector, m.encoder, lambda: lambda data: (sound.getvalue(), 0.1, 16000, 1))
    build.build(spark, c, ["s2", "s4"], m)
    assert cli.main(["sample", "--root", c.root, "--index", "-1"]) == 0
    out = capsys.readouterr().out
    assert "frames: 8 (0, 1, 2, 3, 4, 5, 6, 7)" in out and "audio: 1600 samples" in out and "video_duration_sec: 0.320 s" in out and "over 80 ms" in out
    with pytest.raises(IndexError):
        cli.main(["sample", "--root", c.root, "--index", "5"])
    (tmp_path / "d/silver/metadata/s2.json").write_text("{oops")
    from corvane.sources import metadata

    assert metadata.unreadable(spark, c.metadata) == ["s2"] and metadata.speakers(spark, c.metadata).count() == 1
    with pytest.raises(DownloadError):
        metadata.urls(spark.createDataFrame([('{"files": []}',)], "json string"))


def test_logging_is_set_up_once(tmp_path, capsys):
    for _ in range(2):
        log = logs.configure("DEBUG", str(tmp_path / "l/x.log"))
    log.debug("once")
    assert (tmp_path / "l/x.log").read_text().count("once") == 1
    (tmp_path / "file").write_text("")
    assert len(logs.configure("INFO", str(tmp_path / "file/x.log")).handlers) == 1


def test_digests_are_read_in_chunks(spark, tmp_path):
    import hashlib

    from corvane.sources import archive, metadata

    data = bytes(range(256)) * 12_000
    for folder in ("shards", "metadata"):
        (tmp_path / folder).mkdir()
    (tmp_path / "shards/s1.tar").write_bytes(data)
    (tmp_path / "metadata/s1.json").write_text("{}")
    df = spark.createDataFrame([(str(tmp_path / "shards/s1.tar"),), (f"file://{tmp_path}/shards/s1.tar",), (str(tmp_path / "none"),)], "path string")
    want = (len(data), hashlib.sha256(data).hexdigest())
    assert sorted([(r.size, r.sha256) for r in archive.digests(df).collect()], key=str) == sorted([want, want, (None, None)], key=str)
    got = metadata.inventory(spark, str(tmp_path / "shards"), str(tmp_path / "metadata")).first()
    assert (got.shard_size, got.shard_sha, got.has_metadata) == (*want, True)
    assert metadata.inventory(spark, str(tmp_path / "shards"), str(tmp_path / "metadata"), digests=False).where(F.col("shard_sha").isNull()).count() == 1
