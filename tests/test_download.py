"""Downloads by ranges on executors, and a build from them."""

import io
import json
import os
import tarfile
import zipfile

import pytest

from corvane.config import CorpusConfig
from corvane.operators import state
from corvane.plans import build
from corvane.sources import download, members
from tests.test_build import converter, detector, encoder, reader

C = CorpusConfig(retries=2, retry_delay=0.0)


class Server:
    """Files in a folder, by name; every request is written down. A request listed in the file `fails` fails that many times."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, url, headers):
        name, asked = url.rsplit("/", 1)[-1], headers.get("Range", "")
        with open(f"{self.folder}/log", "a") as f:
            f.write(f"{name} {asked}\n")
        fails = json.load(open(f"{self.folder}/fails")) if os.path.exists(f"{self.folder}/fails") else {}
        if f"{name} {asked}" in fails:
            raise OSError("reset")
        if not os.path.exists(f"{self.folder}/{name}"):
            return 404, {}, []
        data = open(f"{self.folder}/{name}", "rb").read()
        if not asked or name.startswith("plain"):
            return 200, {"content-length": str(len(data))}, [data[:100], data[100:]]
        a, b = asked.removeprefix("bytes=").split("-")
        part = data[int(a) : int(b) + 1 if b else None]
        return 206, {"content-range": f"bytes {a}-{b}/{len(data)}", "content-length": str(len(part))}, [part]

    def requests(self):
        try:
            with open(f"{self.folder}/log") as f:
                return f.read().splitlines()
        finally:
            open(f"{self.folder}/log", "w").close()


def zipped(*items):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for n, d in items:
            z.writestr(n, d)
    return b.getvalue()


def tarred(*items):
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w") as t:
        for n, d in items:
            i = tarfile.TarInfo(n)
            i.size = len(d)
            t.addfile(i, io.BytesIO(d))
    return b.getvalue()


@pytest.fixture
def server(tmp_path):
    (tmp_path / "web").mkdir()
    return Server(tmp_path / "web")


def test_ranges_are_resumed_alone(spark, tmp_path, server):
    data = zipped(("a", os.urandom(5000)), ("b", b"2"))
    for name in ("x.zip", "plain.zip"):
        (tmp_path / f"web/{name}").write_bytes(data)
    (tmp_path / "web/bad.zip").write_bytes(b"no archive" * 300)
    (tmp_path / "web/empty.zip").write_bytes(b"")
    dest = lambda n: str(tmp_path / "got" / n)
    files = spark.createDataFrame([(f"http://h/{n}", dest(n), "zip") for n in ("x.zip", "plain.zip", "bad.zip", "empty.zip", "none.zip")], "url string, dest string, format string")
    (tmp_path / "web/fails").write_text(json.dumps({"x.zip bytes=2000-2999": 1}))
    got = {os.path.basename(r.dest): r.error for r in download.fetched(files, server, C, 1000, lambda s: None).collect()}
    assert got["plain.zip"] is None and "attempts failed" in got["x.zip"] and "not a zip" in got["bad.zip"] and "404" in got["none.zip"] and got["empty.zip"]
    assert (tmp_path / "got/plain.zip").read_bytes() == data and not (tmp_path / "got/x.zip").exists() and not (tmp_path / "got/bad.zip").exists()
    server.requests()
    (tmp_path / "web/fails").unlink()
    again = {os.path.basename(r.dest): r.error for r in download.fetched(files.where("url like '%x.zip' or url like '%plain.zip'"), server, C, 1000, lambda s: None).collect()}
    assert again == {"x.zip": None, "plain.zip": None} and (tmp_path / "got/x.zip").read_bytes() == data
    # of the parts only the one that failed, and nothing of what was there whole
    assert server.requests() == ["x.zip bytes=0-0", "x.zip bytes=2000-2999"]
    assert sorted(x.name for x in (tmp_path / "got").iterdir() if not x.name.endswith(".parts")) == ["plain.zip", "x.zip"]


def test_fallback_is_by_kind(spark, tmp_path, server):
    for n in ("v.zip", "v2.zip", "all.zip"):
        (tmp_path / f"web/{n}").write_bytes(zipped((n, b"x")))
    (tmp_path / "web/broken.zip").write_bytes(b"junk")
    rows = [("s1", "video", 0, "primary", "v.zip"), ("s1", "video", 1, "fallback", "v2.zip"), ("s1", "audio", 0, "primary", "broken.zip"), ("s1", "audio", 1, "fallback", "all.zip"), ("s2", "audio", 0, "primary", "gone.zip"), ("s2", "audio", 1, "fallback", "all.zip"), ("s3", "audio", 0, "primary", "gone.zip"), ("s3", "audio", 1, "fallback", "broken.zip")]
    wanted = spark.createDataFrame([(s, k, p, n, f"http://h/{u}", str(tmp_path / "got" / u), "zip") for s, k, p, n, u in rows], "speaker_id string, kind string, priority int, source string, url string, dest string, format string")
    got = {(r.speaker_id, r.kind): (r.source, r.error) for r in download.acquired(wanted, server, C, sleep=lambda s: None).collect()}
    assert got["s1", "video"] == ("primary", None) and got["s1", "audio"] == ("fallback", None) and got["s2", "audio"] == ("fallback", None)
    assert got["s3", "audio"][0] == "fallback" and "not a zip" in got["s3", "audio"][1]
    asked = [r.split()[0] for r in server.requests()]
    assert asked.count("all.zip") == 2 and "v2.zip" not in asked  # its length and its one range, for both speakers


def test_a_build_from_downloads(spark, tmp_path, server, monkeypatch):
    """33 speakers, three with a broken archive: the stages run once, over all, and a shared archive is opened for all at once."""
    c = CorpusConfig(root=str(tmp_path / "d"), retries=1)
    speakers = c.usable()
    for s in speakers:
        (tmp_path / f"web/{s}v.zip").write_bytes(b"PK\x03\x04 broken" if s in ("s3", "s7") else zipped(("v/u.mpg", b"fps=25;n=8")))
    (tmp_path / "web/audio.tar").write_bytes(tarred(*((f"all/{s}/u.wav", s.encode()) for s in speakers if s != "s9")))
    (tmp_path / "web/s9a.tar").write_bytes(b"junk" * 1000)

    def sources(s):
        return [("video", "primary", f"http://h/{s}v.zip", "zip"), ("audio", "primary", f"http://h/{s}a.tar", "tar")] + [("audio", "zenodo_fallback", "http://h/audio.tar", "tar")] * (s != "s9")

    opens = tmp_path / "opens"

    def opener(path):
        with open(opens, "a") as f:
            f.write(f"{os.path.basename(path)}\n")
        return members.opened(path)

    media = build.Media(None, reader, detector, encoder, converter, sources, server, opener)
    runs = []
    process = build.process
    monkeypatch.setattr(build, "process", lambda *a: (runs.append(a[2]), process(*a))[1])
    states = {r.speaker_id: r for r in build.build(spark, c, speakers, media, clock=lambda: "t").collect()}
    assert {s for s, r in states.items() if r.status == "FAILED"} == {"s3", "s7", "s9"} and sum(r.status == "DONE" for r in states.values()) == 30
    assert len(runs) == 1 and all(r.attempt_count == 1 for r in states.values())
    assert states["s1"].audio_source_used == "zenodo_fallback" and states["s1"].video_source_used == "primary" and "no" in states["s3"].last_error
    shared = [x for x in opens.read_text().split() if x.endswith("audio.tar")]
    # looked at, indexed, and read by tasks for their batches; not once a speaker for each of these
    assert 3 <= len(shared) <= 33
    with tarfile.open(f"{c.shards}/s2.tar") as t:
        assert t.extractfile("s2/u/audio.wav").read() == b"RIFFs2"


def test_an_old_state_document_is_adopted_once(spark, tmp_path):
    (tmp_path / "state").mkdir()
    doc = {"s1": {"status": "DONE", "attempt_count": 2, "started_at": "a", "completed_at": "b", "shard_size_bytes": 5}, "s2": {"status": "FAILED", "attempt_count": 1, "started_at": "a", "last_error": "e"}, "s3": {"status": "QC", "attempt_count": 1, "started_at": "c"}}
    (tmp_path / "state/processing_state.json").write_text(json.dumps({"speakers": doc}))
    c = CorpusConfig(root=str(tmp_path))
    for _ in range(2):
        build.build(spark, c, ["s4"], None, dry_run=True, clock=lambda: "now")
    got = {r.speaker_id: r for r in state.latest(state.Log(spark, f"{c.state}/log", lambda: "x").events()).collect()}
    assert (got["s1"].status, got["s1"].attempt_count, got["s1"].started_at, got["s1"].completed_at, got["s1"].shard_size_bytes) == ("DONE", 2, "a", "b", 5)
    assert (got["s2"].status, got["s2"].last_error) == ("FAILED", "e") and got["s3"].status == "QC" and got["s4"].attempt_count == 2
