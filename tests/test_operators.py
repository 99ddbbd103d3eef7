"""Rules of the operators, against plain Python where that is shorter."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.config import CorpusConfig, ReaderSettings, check_speaker
from corvane.errors import ManifestError, SourceLayoutError
from corvane.functions import media, text
from corvane.functions.runs import longest_run
from corvane.operators import duration, gold, integrity, manifest, pairing, profile, quality, state


def run_of(values):
    best = run = 0
    last = None
    for v in sorted(values):
        run = run + 1 if last is not None and v == last + 1 else 1
        best, last = max(best, run), v
    return best


def test_longest_run(spark):
    cases = [[], [5], [0, 1, 2, 3], [0, 1, 3, 4, 5, 6], [0, 2, 4, 6], [4, 1, 2, 3, 0], [1, 1, 2], None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, a array<int>").select("i", longest_run(F.col("a")).alias("n"))
    assert [r.n for r in df.orderBy("i").collect()] == [0, 1, 4, 4, 1, 5, 2, 0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 30), max_size=25), min_size=1, max_size=40))
def test_longest_run_equals_python(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "i int, a array<int>").select("i", longest_run(F.col("a")).alias("n"))
    assert [r.n for r in df.orderBy("i").collect()] == [run_of(x) for x in lists]


VALID = {"split": "train", "speaker_id": "s1", "utterance_id": "bbaf2n", "shard_path": "G:\\dataset\\silver\\shards\\s1.tar", "shard_member_prefix": "s1/bbaf2n/", "frame_count": "75", "first_frame_index": "0", "last_frame_index": "74", "face_detection_ratio": "1.0", "audio_duration_sec": "1.19", "audio_sample_rate": "16000", "valid": "True"}
BAD = [
    ("split", "test"), ("speaker_id", "invalid"), ("speaker_id", "s21"), ("speaker_id", "s01"), ("speaker_id", "s0"), ("utterance_id", "abc/123"), ("utterance_id", "a\nb"), ("shard_member_prefix", "s1/wrong/"), ("shard_member_prefix", "../escape/"), ("shard_path", "s2.tar"), ("valid", "False"), ("valid", "yes"),
    ("frame_count", "0"), ("frame_count", "abc"), ("frame_count", "76"), ("frame_count", "75.0"), ("frame_count", None), ("first_frame_index", "-1"), ("last_frame_index", "73"), ("last_frame_index", ""), ("face_detection_ratio", "1.5"), ("face_detection_ratio", "-0.5"), ("face_detection_ratio", "nan"),
    ("audio_duration_sec", "0"), ("audio_duration_sec", "1.0d"), ("audio_sample_rate", "0"), ("audio_sample_rate", "99999999999999"),
]
GOOD = [("speaker_id", " s1 "), ("speaker_id", "\ts1"), ("valid", "1"), ("valid", " TRUE "), ("frame_count", " +75 "), ("frame_count", "7_5"), ("audio_duration_sec", "nan"), ("audio_duration_sec", "inf"), ("audio_duration_sec", "1e0"), ("shard_path", "/content/drive/s1.tar"), ("shard_path", "s1.tar/")]


def rows_of(spark, changes):
    names = list(VALID)
    data = [tuple((VALID | c)[n] for n in names) + (i + 2, "train") for i, c in enumerate(changes)]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names) + ", row_number long, expected_split string")


def test_manifest_checks(spark):
    got = manifest.parsed(rows_of(spark, [{k: v} for k, v in BAD])).orderBy("row_number").collect()
    assert [b for b, r in zip(BAD, got) if r.error is None] == []
    got = manifest.parsed(rows_of(spark, [{k: v} for k, v in GOOD])).orderBy("row_number").collect()
    assert [(g, r.error) for g, r in zip(GOOD, got) if r.error] == []
    assert got[0].speaker_id == "s1" and got[5].frame_count == 75


def test_manifest_fails_on_the_first_bad_row_and_on_repeats(spark):
    with pytest.raises(ManifestError, match="row 3"):
        manifest.enforce(manifest.parsed(rows_of(spark, [{}, {"valid": "0"}, {"split": "x"}])))
    with pytest.raises(ManifestError, match="repeats"):
        manifest.enforce(manifest.parsed(rows_of(spark, [{}, {}])))
    with pytest.raises(ManifestError, match="split"):
        manifest.parsed(rows_of(spark, [{}]).drop("split"))
    good, bad = manifest.quarantine(manifest.parsed(rows_of(spark, [{}, {"valid": "0"}])))
    assert (good.count(), bad.count()) == (1, 1)


def test_eligibility_and_order(spark):
    rows = manifest.indexed(manifest.parsed(rows_of(spark, [{"frame_count": "5"}, {"utterance_id": "u", "shard_member_prefix": "s1/u/"}])))
    assert [manifest.eligible(rows, n).count() for n in (None, 6, 50)] == [2, 1, 1]
    assert manifest.eligible(rows, 6).first().manifest_index == 1
    assert manifest.at(rows, "train", -1).first().manifest_index == 1 and manifest.at(rows, "train", 2).count() == 0
    with pytest.raises(ValueError):
        manifest.at(rows, "dev", 0)


def test_settings():
    for bad in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            ReaderSettings(min_frame_count=bad)
    for kw in ({"fps": 0}, {"fps": math.nan}, {"frame_width": 0}, {"frame_height": 1.0}, {"gap_threshold_ms": -1}, {"gap_threshold_ms": math.inf}):
        with pytest.raises(ValueError):
            ReaderSettings(**kw)
    assert check_speaker("s1", CorpusConfig()) == "s1"
    for s in ("s21", "s35", "x"):
        with pytest.raises(ValueError):
            check_speaker(s, CorpusConfig())


def test_settings_from_environment(tmp_path):
    f = tmp_path / ".env"
    f.write_text("# c\nCORVANE_FPS=30\nexport CORVANE_FRAME_WIDTH='128'\nCORVANE_FRAME_HEIGHT=\n")
    s = ReaderSettings.from_env(str(f), {"CORVANE_FPS": "24.5", "CORVANE_FRAME_WIDTH": " "})
    assert (s.fps, s.frame_width, s.frame_height) == (24.5, 128, 96)
    with pytest.raises(ValueError):
        ReaderSettings.from_env(None, {"CORVANE_FPS": "fast"})


def test_split_is_the_published_one():
    c = CorpusConfig()
    s = gold.split_speakers(c.usable(), c.split_seed, c.train, c.val, c.test)
    assert [len(v) for v in s.values()] == [27, 3, 3] and sorted(sum(s.values(), []), key=lambda x: int(x[1:])) == c.usable()
    assert s == gold.split_speakers(c.usable(), 42, 27, 3, 3) != gold.split_speakers(c.usable(), 43, 27, 3, 3)


def test_pairing(spark):
    v = spark.createDataFrame([("s1", "/a/bbaf2n.mpg"), ("s1", "/a/BBWI2A.mpg"), ("s1", "/b/bbaf2n.mpg")], "speaker_id string, path string")
    a = spark.createDataFrame([("s1", "/a/bbaf2n.wav"), ("s1", "/a/lgwl7p.wav")], "speaker_id string, path string")
    got = {r.utterance_id: (r.pairing_status, r.video_path) for r in pairing.pair(v, a).collect()}
    assert got == {"bbaf2n": ("PAIRED", "/b/bbaf2n.mpg"), "bbwi2a": ("MISSING_AUDIO", "/a/BBWI2A.mpg"), "lgwl7p": ("MISSING_VIDEO", None)}
    assert {r.pairing_status for r in pairing.pair(v, a, strict=True).collect()} == {"DUPLICATE_VIDEO", "MISSING_AUDIO", "MISSING_VIDEO"}
    assert pairing.counts(pairing.pair(v, a)).first().paired == 1
    assert pairing.limited(pairing.pair(v, a), 1).count() == 1
    with pytest.raises(SourceLayoutError):
        pairing.pair(v, a.limit(0))


BASE = {"speaker_id": "s1", "utterance_id": "u", "pairing_status": "PAIRED", "video_failed": False, "video_reason": None, "source_fps": 25.0, "total_frames": 10, "detected": [1, 2, 3, 4, 5, 6], "audio_failed": False, "audio_success": True, "audio_reason": None, "audio_duration_sec": 1.0, "audio_sample_rate": 16000, "audio_channels": 2, "readable": True, "has_audio": True}
QC = [
    ({}, None, (25.0, 10, 6)), ({"pairing_status": "MISSING_VIDEO"}, "MISSING_VIDEO", (0.0, 0, 0)), ({"video_failed": True}, "VIDEO_DECODE_FAILED", (0.0, 0, 0)), ({"video_reason": "INVALID_FPS"}, "INVALID_FPS", (25.0, 10, 0)), ({"audio_failed": True}, "AUDIO_CONVERSION_FAILED", (25.0, 10, 0)),
    ({"audio_success": False, "audio_reason": "EMPTY_AUDIO"}, "EMPTY_AUDIO", (25.0, 10, 6)), ({"audio_success": False}, "AUDIO_CONVERSION_FAILED", (25.0, 10, 6)), ({"total_frames": 0}, "NO_FRAMES", (25.0, 0, 6)), ({"detected": []}, "FACE_NOT_DETECTED", (25.0, 10, 0)), ({"total_frames": 13}, "FACE_NOT_DETECTED", (25.0, 13, 6)),
    ({"detected": [1, 2, 4, 5, 6, 7]}, "INSUFFICIENT_CONSECUTIVE_FACE_FRAMES", (25.0, 10, 6)), ({"readable": False}, "CORRUPT_OUTPUT", (25.0, 10, 6)), ({"has_audio": False}, "AUDIO_DECODE_FAILED", (25.0, 10, 6)), ({"audio_sample_rate": 8000}, "INVALID_OUTPUT_AUDIO_RATE", (25.0, 10, 6)), ({"audio_duration_sec": 0.05}, "EMPTY_AUDIO", (25.0, 10, 6)), ({"audio_duration_sec": None}, "EMPTY_AUDIO", (25.0, 10, 6)),
    ({"total_frames": 12}, None, (25.0, 12, 6)),
]


def test_quality_records(spark):
    names = list(BASE)
    ddl = "speaker_id string, utterance_id string, pairing_status string, video_failed boolean, video_reason string, source_fps double, total_frames int, detected array<int>, audio_failed boolean, audio_success boolean, audio_reason string, audio_duration_sec double, audio_sample_rate int, audio_channels int, readable boolean, has_audio boolean"
    df = spark.createDataFrame([tuple((BASE | c | {"utterance_id": f"u{i:02}"})[n] for n in names) for i, (c, _, _) in enumerate(QC)], ddl)
    records = quality.classify(df)
    got = records.orderBy("utterance_id").collect()
    assert [r.invalid_reason for r in got] == [x[1] for x in QC]
    assert [(r.source_fps, r.source_frame_count, r.cropped_frame_count) for r in got] == [x[2] for x in QC]
    assert got[0].face_detection_ratio == 0.6 and got[0].shard_member_prefix == "s1/u00/" and got[5].shard_member_prefix == "" and got[7].face_detection_ratio == 0
    s = quality.summarise(records).first()
    assert (s.total_candidates, s.valid_samples, s.invalid_samples) == (17, 2, 15) and s.invalid_reason_counts["EMPTY_AUDIO"] == 3


def test_spot_checks(spark):
    frames = spark.createDataFrame([("s1", "a", 1, True), ("s1", "a", 2, True), ("s1", "b", 4, False)], "speaker_id string, utterance_id string, frame_index int, readable boolean")
    u = spark.createDataFrame([("s1", "a", [2, 1]), ("s1", "b", [4]), ("s1", "c", [9])], "speaker_id string, utterance_id string, detected array<int>")
    assert {r.utterance_id: r.readable for r in quality.spot_checked(frames, u).collect()} == {"a": True, "b": False, "c": False}


def nearest(values, q=0.95):
    return sorted(values)[math.ceil(q * len(values)) - 1]


def test_duration_report_equals_python(spark):
    r = random.Random(1)
    rows = [(["train", "val"][i % 2], f"s{i % 3}", f"u{i}", r.randint(1, 75), 0, 74, r.random() * 4 + 0.01) for i in range(41)] + [("test", "s9", "edge", 75, 0, 74, 2.92), ("test", "s9", "near", 75, 0, 74, 2.9199)]
    df = spark.createDataFrame(rows, "split string, speaker_id string, utterance_id string, frame_count int, first_frame_index int, last_frame_index int, audio_duration_sec double")
    g = duration.gaps(df)
    by = {x.utterance_id: x for x in g.collect()}
    assert by["edge"].exceeds_threshold is False and by["near"].exceeds_threshold is True
    gaps = {u: 3.0 - a for _, _, u, *_, a in rows}
    s = {x["group"]: x for x in duration.summarise(g).collect()}
    assert len(s) == 1 + 3 + 7
    for name, mine in (("ALL", rows), ("train", [x for x in rows if x[0] == "train"]), ("test/s9", rows[-2:])):
        v = [gaps[x[2]] for x in mine]
        assert s[name].utterances == len(v) and s[name].min_gap_sec == min(v) and s[name].max_gap_sec == max(v)
        assert math.isclose(s[name].mean_gap_sec, sum(v) / len(v), abs_tol=1e-8)
        assert s[name].p95_absolute_gap_sec == nearest([abs(x) for x in v])
        assert s[name].has_missing_frames_count == sum(x[3] < 75 for x in mine)
    assert duration.summarise(g.limit(0)).count() == 0
    with pytest.raises(ValueError):
        duration.gaps(df, fps=0)
    bad = df.limit(1).withColumn("audio_duration_sec", F.lit(float("nan")))
    with pytest.raises(Exception, match="finite"):
        duration.checked(bad)


def test_state_log(spark):
    e = state.event
    log = [e("s1", 1, "start", "t1"), e("s1", 2, "transition", "t2", status="QC"), e("s1", 3, "failure", "t3", error="boom"), e("s1", 4, "start", "t4"), e("s1", 5, "done", "t5", shard_size_bytes=9, shard_sha256="ab", shard_path="/p"), e("s2", 1, "transition", "t1", status="PACKAGING"), e("s3", 1, "start", "t1"), e("s3", 2, "failure", "t2", error="no")]
    df = spark.createDataFrame([tuple(x.values()) for x in log], state.EVENT)
    cat = spark.createDataFrame([(f"s{i}",) for i in range(1, 5)], "speaker_id string")
    s = {r.speaker_id: r for r in state.with_retry(state.state(cat, df)).collect()}
    assert [s[f"s{i}"].status for i in range(1, 5)] == ["DONE", "PACKAGING", "FAILED", "PENDING"]
    assert (s["s1"].attempt_count, s["s1"].started_at, s["s1"].completed_at, s["s1"].last_error, s["s1"].shard_size_bytes) == (2, "t4", "t5", None, 9)
    assert s["s2"].started_at == "t1" and s["s3"].last_error == "no" and s["s4"].attempt_count == 0
    assert [s[x].should_retry for x in ("s1", "s2", "s3", "s4")] == [False, True, True, True]
    inv = spark.createDataFrame([("s1", 9, "ab", True), ("s2", 5, "cd", True), ("s3", 5, "cd", False)], "speaker_id string, shard_size long, shard_sha string, has_metadata boolean")
    v = state.verified(state.state(cat, df), inv)
    assert {r.speaker_id: r.verified for r in v.collect()} == {"s1": True, "s2": True, "s3": False, "s4": False}
    assert {r.speaker_id for r in state.to_process(v).collect()} == {"s3", "s4"} and state.to_process(v, force=True).count() == 4
    new = state.reconciled(v, "/x", "/m", "t9")
    assert {r.speaker_id for r in new.collect()} == {"s1", "s2"}
    again = state.verified(state.state(cat, df.unionByName(new)), inv)
    assert state.reconciled(again, "/x", "/m", "t10").count() == 0 and not state.all_done(state.state(cat, df))
    assert [r.previous_status for r in state.transitions(df).where("speaker_id = 's1'").orderBy("seq").collect()] == ["PENDING", "QC", "FAILED"]
    with pytest.raises(Exception):
        state.event("s1", 1, "transition", "t", status="ODD")


def test_text_functions(spark):
    df = spark.createDataFrame([(0,), (1152,), (1023,), (1 << 20,), (3 << 50,), (None,)], "n long")
    assert [r[0] for r in df.select(text.human_bytes("n")).collect()] == ["0.00 B", "1.12 KiB", "1023.00 B", "1.00 MiB", "3.00 PiB", None]
    assert [r[0] for r in df.select(text.fmt_size(F.col("n"))).collect()] == ["0.0 B", "1.1 KiB", "1,023.0 B", "1.0 MiB", "3,072.0 TiB", None]
    r4 = spark.createDataFrame([(0.66665,), (0.00015,), (1 / 3,), (None,)], "x double").select(text.round4("x"))
    assert [r[0] for r in r4.collect()] == [0.6666, 0.0001, 0.3333, None]
    p = spark.createDataFrame([("/a/B.Tar.gz",), ("G:\\x\\s1.tar",), ("plain",), (".hid",)], "p string")
    assert [tuple(r) for r in p.select(text.stem(F.col("p")), text.basename(F.col("p")), text.folder(F.col("p")), text.filename(F.col("p"))).collect()] == [("b.tar", "B.Tar.gz", "/a", "B.Tar.gz"), ("g:\\x\\s1", "s1.tar", "", "G:\\x\\s1.tar"), ("plain", "plain", "", "plain"), (".hid", ".hid", "", ".hid")]


def test_media(spark):
    import io
    import wave

    def wav(n, rate=16000, channels=1, width=2):
        b = io.BytesIO()
        with wave.open(b, "wb") as w:
            w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
            w.writeframes(b"\x00\x40" * n)
        return b.getvalue()

    df = spark.createDataFrame([(wav(1600), 16000), (wav(10, 8000), 16000), (wav(10, channels=2), 16000), (wav(0), 16000), (b"junk", 16000), (None, 1)], "c binary, r int").select(media.decode_wav("c", "r").alias("d")).select("d.*").collect()
    assert len(df[0].samples) == 1600 and df[0].samples[0] == 0.5 and all(x.samples is None and x.error for x in df[1:])
    import numpy as np

    img = media.fit(np.full((24, 12, 3), 200, np.uint8), 20, 16)
    assert img.shape == (16, 20, 3) and (img[:, :6] == 0).all() and (img[:, 6:14] == 200).all() and (img[:, 14:] == 0).all()
    big = media.fit(np.full((4, 8, 3), 9, np.uint8), 20, 16)
    assert (big[3:13] == 9).all() and (big[:3] == 0).all()
    frames = spark.createDataFrame([("p", 0, b"x"), ("p", 1, b"bad")], "prefix string, frame_index int, content binary")

    def decoder():
        def one(b):
            if b == b"bad":
                raise ValueError("not an image")
            return np.zeros((4, 4, 3), np.uint8)

        return one

    got = media.decode_frames(frames, decoder, 6, 6).orderBy("frame_index").collect()
    assert len(got[0].pixels) == 108 and got[1].error == "ValueError: not an image"


def test_media_interfaces(spark):
    import numpy as np

    v = spark.createDataFrame([("s1", "a", "ok"), ("s1", "b", "slow"), ("s1", "c", "raise"), ("s1", "d", "empty")], "speaker_id string, utterance_id string, video_path string")

    def reader():
        def read(path):
            if path == "raise":
                raise OSError
            return (25.0 if path != "slow" else 20.0), lambda: [np.zeros((10, 10, 3))] * (0 if path == "empty" else 40)

        return read

    def detector():
        calls = []

        def detect(frames):
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError
            return media.first_faces([[(-3, 1, 5.9, 5)]] * (len(frames) - 1) + [None])

        return detect

    got = {r.utterance_id: r for r in media.process_videos(v.coalesce(1), reader, detector).collect()}
    assert got["a"].detected == [*range(15), *range(32, 39)] and [got[x].invalid_reason for x in "abcd"] == [None, "INVALID_FPS", "VIDEO_DECODE_FAILED", "NO_FRAMES"]
    a = v.withColumnRenamed("video_path", "audio_path")

    def convert():
        return lambda p: {"ok": (True, 1.0, 16000, 1), "slow": (True, 1.0, 8000, 1), "empty": (True, 0.01, 16000, 1)}[p]

    got = {r.utterance_id: r.invalid_reason for r in media.process_audio(a, convert).collect()}
    assert got == {"a": None, "b": "INVALID_OUTPUT_AUDIO_RATE", "c": "AUDIO_CONVERSION_FAILED", "d": "EMPTY_AUDIO"}


def test_profiles_and_integrity(spark):
    j = spark.createDataFrame([("a", '{"status": "DONE", "seed": 42, "samples": [{"b": 1, "a": 2}]}'), ("b", "{bad")], "path string, json string")
    got = {r.path: r for r in profile.json_profile(j).collect()}
    assert got["a"].root_keys == ["samples", "seed", "status"] and got["a"].sample_keys == ["a", "b"] and got["a"].samples == 1 and not got["b"].readable
    e = spark.createDataFrame([("b", True), ("A", True), ("a.txt", False)], "name string, is_dir boolean")
    assert [r.name for r in profile.preview(e, 2).collect()] == ["A", "b"]
    files = spark.createDataFrame([("x.tar", b"ab"), ("y.tar", b"")], "path string, content binary")
    d = integrity.with_digests(files)
    want = spark.createDataFrame([("x.tar", 2, "zz"), ("z.tar", 1, "a"), ("y.tar", 5, "a")], "path string, size long, sha256 string")
    assert {r.path: r.problem for r in integrity.shard_problems(want, d).collect()} == {"x.tar": "digest differs", "z.tar": "missing", "y.tar": "size differs"}
    assert profile.shard_totals(d).first().bytes == 2
