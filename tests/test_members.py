"""The index of archives' members, reading by byte ranges, and archives at fault."""

import io
import os
import random
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from corvane.errors import DatasetReadError
from corvane.operators import samples
from corvane.sources import members


def tar_bytes(items, format=tarfile.PAX_FORMAT):
    b = io.BytesIO()
    with tarfile.open(fileobj=b, mode="w:", format=format) as t:
        for name, data in items:
            i = tarfile.TarInfo(name)
            if data is None:
                i.type = tarfile.DIRTYPE
                t.addfile(i)
            else:
                i.size = len(data)
                t.addfile(i, io.BytesIO(data))
    return b.getvalue()


def one(spark, *paths):
    return spark.createDataFrame([(str(p),) for p in paths], "archive string")


def hard_items(seed):
    r = random.Random(seed)
    nested = tar_bytes([(f"n{i}/{'x' * r.randint(1, 90)}", r.randbytes(r.randint(0, 3000))) for i in range(40)])
    items = []
    for i in range(120):
        name = f"s1/u{i % 7}/{i}.jpg" if i % 5 else f"s1/{'long' * r.randint(20, 80)}/é{i}"
        data = r.choice([b"", r.randbytes(r.randint(1, 6000)), nested, nested[: r.randint(1, 20) * 512], bytes(2000)])
        items.append((name, data))
        if i % 11 == 0:
            items.append((f"s1/folder{i}", None))
    return items


@pytest.mark.parametrize("format,width", [(tarfile.PAX_FORMAT, 4096), (tarfile.GNU_FORMAT, 4096), (tarfile.PAX_FORMAT, 50_000)])
def test_ranges_give_what_one_task_gives(spark, tmp_path, width, format):
    """Ranges that begin within payloads, within payloads that look like headers, and between a long name and its header."""
    items = hard_items(width)
    (tmp_path / "s1.tar").write_bytes(tar_bytes(items, format))
    found = members.index(one(spark, tmp_path / "s1.tar"), range_bytes=width)
    got = {r.name: (r.size, r.content) for r in members.content(found).collect()}
    assert got == {n: (len(d), d) for n, d in items if d is not None} and found.where("error is not null").count() == 0
    whole = members.index(one(spark, tmp_path / "s1.tar"))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, found.collect()))
    frames = {r.filename: r.frame_index for r in found.collect()}
    assert frames["1.jpg"] == 1 and all(v is None for k, v in frames.items() if not k.endswith(".jpg"))


class Counting:
    """A file that writes down how many bytes are read of it."""

    def __init__(self, path, log):
        self.f, self.log = open(path.removeprefix("file:"), "rb"), log

    def read(self, n=-1):
        data = self.f.read(n)
        with open(self.log, "a") as out:
            out.write(f"{len(data)}\n")
        return data

    def seek(self, *a):
        return self.f.seek(*a)

    def tell(self):
        return self.f.tell()

    def close(self):
        self.f.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def test_one_frame_of_a_large_shard_reads_little(spark, tmp_path):
    """700 MB, nearly all of it holes in a sparse file."""
    path, log = tmp_path / "s1.tar", tmp_path / "log"
    with open(path, "wb") as f:
        for i in range(70):
            head = tarfile.TarInfo(f"s1/u/{i}.jpg")
            head.size = 10_000_000
            f.write(head.tobuf())
            f.write(b"%d" % i)
            f.seek(-(-(f.tell() - len(b"%d" % i) + head.size) // 512) * 512)
        f.write(bytes(1024))
    read = lambda: sum(map(int, log.read_text().split())) if log.exists() else 0
    opener = lambda p: Counting(p, str(log))
    table = members.index(one(spark, path), opener=opener)
    table.withColumn("speaker_id", F.lit("s1")).write.parquet(str(tmp_path / "index"))
    kept = spark.read.parquet(str(tmp_path / "index"))
    # ranges whose first block is a hole are looked through for a header
    assert kept.count() == 70
    log.unlink()
    small = kept.withColumn("size", F.lit(3000).cast("bigint")).withColumn("stored", F.lit(3000).cast("bigint"))
    got = members.content(small.where("frame_index = 33"), opener=opener).collect()
    assert got[0].content[:2] == b"33" and read() < 1_000_000
    (tmp_path / "s2.tar").write_bytes(tar_bytes([(f"s2/u/{i}.jpg", bytes([i]) * 5000) for i in range(200)]))
    log.unlink()
    table = members.index(one(spark, tmp_path / "s2.tar"), opener=opener)
    assert table.count() == 200 and read() < 2 * 200 * 600  # headers only
    table.write.parquet(str(tmp_path / "index2"))
    log.unlink()
    assert [r.content[:1] for r in members.content(spark.read.parquet(str(tmp_path / "index2")).where("frame_index = 7"), opener=opener).collect()] == [b"\x07"] and read() == 5000


def test_kinds_of_archives_and_faults(spark, tmp_path):
    items = [("a/s1/1.jpg", b"x" * 70_000), ("a/s1/audio.wav", b"w"), ("b/2.jpg", b""), ("root.txt", b"r")]
    (tmp_path / "t.tar").write_bytes(tar_bytes(items))
    for mode in ("gz", "bz2", "xz"):
        with tarfile.open(tmp_path / f"t.{mode}", f"w:{mode}") as t:
            for n, d in items:
                i = tarfile.TarInfo(n)
                i.size = len(d)
                t.addfile(i, io.BytesIO(d))
    for name, method in (("stored", zipfile.ZIP_STORED), ("deflated", zipfile.ZIP_DEFLATED), ("bzip", zipfile.ZIP_BZIP2)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", method) as z:
            for n, d in items:
                i = zipfile.ZipInfo(n)
                i.extra, i.compress_type = b"\xfe\xca" + (900).to_bytes(2, "little") + bytes(900), method
                z.writestr(i, d)
    (tmp_path / "empty.tar").write_bytes(tar_bytes([]))
    (tmp_path / "broken.zip").write_bytes(b"PK\x03\x04 no archive")
    (tmp_path / "broken.tar").write_bytes(b"no archive at all")
    (tmp_path / "cut.tar").write_bytes(tar_bytes(items)[:3000])
    (tmp_path / "twice.tar").write_bytes(tar_bytes([*items, items[0]]))
    good = ["t.tar", "t.gz", "t.bz2", "t.xz", "stored.zip", "deflated.zip", "bzip.zip", "twice.tar"]
    bad = ["broken.zip", "broken.tar", "cut.tar", "gone.tar"]
    found = members.index(one(spark, *(tmp_path / x for x in [*good, "empty.tar", *bad]))).cache()
    want = {n: d for n, d in items if "/" in n}
    rows = members.content(found.where("name is not null and archive not like '%cut.tar'")).collect()
    for x in good:
        assert {r.name: r.content for r in rows if r.archive.endswith(f"/{x}")} == want, x
    assert {os.path.basename(r.archive) for r in members.faults(found).collect()} == {*bad, "twice.tar"}
    with pytest.raises(DatasetReadError, match="can't be"):
        members.sound(found)
    assert members.sound(found.where("archive like '%/t.tar'")).count() == 3
    cut = members.content(found.where("archive like '%cut.tar' and name is not null"), strict=False).collect()
    assert all(r.content is None and "Truncated" in r.error for r in cut)
    with pytest.raises(Exception, match="Oversized"):
        members.content(found.where("archive like '%/t.tar'"), max_member_bytes=4).collect()
    part = members.content(found.where("archive like '%/t.tar'"), max_member_bytes=4, strict=False).collect()
    assert {r.name: r.error is None for r in part} == {"a/s1/1.jpg": False, "a/s1/audio.wav": True, "b/2.jpg": True}
    with pytest.raises(ValueError):
        members.content(found, max_member_bytes=0)
    found.unpersist()


def test_samples_read_what_they_need(spark, tmp_path):
    (tmp_path / "shards").mkdir()
    (tmp_path / "shards/s1.tar").write_bytes(tar_bytes([("s1/u/0.jpg", b"a"), ("s1/u/2.jpg", b"cc"), ("s1/u/audio.wav", b"w"), ("s1/two/1.jpg", b"x"), ("s1/two/01.jpg", b"y"), ("s1/huge/5.jpg", bytes(17 << 20)), ("s1/none/notes.txt", b"")]))
    index = members.of_folder(spark, str(tmp_path / "shards"))
    got = {r.prefix: (r.content, r.error) for r in samples.frame(index, 2).collect()}
    # one frame is over the limit and isn't asked for
    assert got == {"s1/u/": (b"cc", None), "s1/two/": (None, "there is no frame 2"), "s1/huge/": (None, "there is no frame 2"), "s1/none/": (None, "there is no frame 2")}
    assert {r.prefix: r.error for r in samples.frame(index, 1).collect()}["s1/two/"] == "frame 1 is there twice"
    m = spark.createDataFrame([("s1", f"s1/{u}/", n, 0, 2) for u, n in (("u", 2), ("two", 1), ("none", 1), ("gone", 1))], "speaker_id string, shard_member_prefix string, frame_count int, first_frame_index int, last_frame_index int")
    out = {r.shard_member_prefix: (r.frames, r.audio, r.error) for r in samples.utterances(m, index).collect()}
    assert out["s1/u/"] == ({0: b"a", 2: b"cc"}, b"w", None)
    assert {k: v[2] for k, v in out.items() if k != "s1/u/"} == {"s1/two/": "audio is missing", "s1/none/": "audio is missing", "s1/gone/": "utterance is missing from its shard"}
    assert members.of_folder(spark, str(tmp_path / "shards"), speakers=["s9"]).count() == 0


@pytest.mark.parametrize("range_bytes", [64 << 20, 100_000])
def test_short_members_are_read_together_and_once(spark, tmp_path, range_bytes):
    """Not header by header, and not once more to check where ranges begin."""
    path, log = tmp_path / "s1.tar", tmp_path / "log"
    items = [(f"s1/{i // 7}/{i % 7}.jpg", b"%d" % i) for i in range(3000)]
    path.write_bytes(tar_bytes(items))
    found = members.index(one(spark, path), range_bytes=range_bytes, opener=lambda p: Counting(p, str(log)))
    reads = list(map(int, log.read_text().split()))
    assert len(reads) < 1000 and sum(reads) < 3 * path.stat().st_size
    assert sorted(r.name for r in found.collect()) == sorted(n for n, _ in items) and found.where("frame_index = 2").count() == 429


def test_headers_are_walked_as_tarfile_does(tmp_path):
    """Long names, folders and old types among plain files, archives that end without blocks, within a payload or within a header."""
    for seed, format in enumerate((tarfile.PAX_FORMAT, tarfile.GNU_FORMAT, tarfile.USTAR_FORMAT)):
        items = [(n, d) for n, d in hard_items(seed) if format != tarfile.USTAR_FORMAT or len(n.encode()) < 100]
        data = tar_bytes([*items, *((f"s2/{i}.jpg", b"x" * (i % 3)) for i in range(2500)), ("s2/a/", None)], format)
        for cut in (len(data), len(data) - 10240, len(data) - 200_700, 700_100, 512, 100):
            (tmp_path / "x.tar").write_bytes(data[:cut])

            def of(step):
                out = []
                with open(tmp_path / "x.tar", "rb") as f:
                    try:
                        out += step(f)
                    except tarfile.TarError as e:
                        out.append(str(e))
                return out

            def slow(f):
                with tarfile.open(fileobj=f, mode="r:") as t:
                    while (m := t.next()) is not None:
                        got.append((m.offset, m.name, m.size, m.offset_data, m.isfile()))
                return []

            def fast(f):
                for m in members.walk(f, 0, 1 << 40):
                    got.append(m)
                return []

            got = []
            want, got = [of(slow), got], []
            assert [of(fast), got] == want, (format, cut)


def test_a_speaker_is_taken_from_the_path_without_a_pattern(spark, tmp_path):
    """A pattern that ends with the path is tried from every place of it, for every member: two thirds of the time of reading frames."""
    (tmp_path / "s x.tar").write_bytes(tar_bytes([("s1/u/0.jpg", b"a")]))
    found = members.of_folder(spark, str(tmp_path))
    assert [r.speaker_id for r in found.collect()] == ["s x"]
    assert "regexp_extract(archive" not in found._jdf.queryExecution().optimizedPlan().toString()
