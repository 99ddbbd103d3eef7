"""Operators that must hold at any size: row numbers, order statistics, manifests in blocks."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import duration, manifest
from corvane.operators.numbering import numbered
from corvane.operators.order_statistics import at_ranks, sortable, unsortable
from corvane.schemas import MANIFEST_COLUMNS
from corvane.sources import manifest as source


def test_numbers_by_group_and_over_all(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").alias("g"), F.hash("id").alias("_at"))
    got = numbered(df, [F.col("_at")], ["g"]).collect()
    for g in ("hot", "b", None):
        mine = sorted((r.row_no, r._at) for r in got if r.g == g)
        assert [n for n, _ in mine] == list(range(len(mine))) and [k for _, k in mine] == sorted(k for _, k in mine)
    over = sorted((r.row_no, r._at) for r in numbered(df, [F.desc("_at")], first=1).collect())
    assert [n for n, _ in over] == list(range(1, 1001)) and [-k for _, k in over] == sorted(-k for _, k in over)
    assert numbered(df.limit(0), [F.col("id")], ["g"]).count() == 0
    ties = numbered(df.withColumn("_at", F.lit(1)), [F.col("_at")])
    assert sorted(r.row_no for r in ties.collect()) == list(range(1000))


def test_no_task_has_a_whole_group(spark):
    rows = manifest.indexed(spark.range(4000).select(F.lit("train").alias("split"), F.col("id").alias("row_number")))
    assert rows.groupBy(F.spark_partition_id()).count().count() > 4
    assert {r.row_number: r.manifest_index for r in rows.collect()} == {i: i for i in range(4000)}
    assert manifest.at(rows, "train", -1).first().row_number == 3999 and manifest.at(rows, "train", 7).first().row_number == 7


ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 0.1 + 2**-56, float("nan")]


def test_bits_sort_as_doubles(spark):
    r = random.Random(1)
    v = ODD + [struct.unpack("<d", r.randbytes(8))[0] for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "x double").select("x", sortable(F.col("x")).alias("k"))
    got = [tuple(x) for x in df.collect() if x.x is not None]
    assert [k for _, k in sorted(got, key=lambda t: (math.isnan(t[0]), t[0] if not math.isnan(t[0]) else 0))] == sorted(k for _, k in got)
    back = df.where("x is not null and not isnan(x)").select("x", unsortable("k").alias("y")).collect()
    assert all(a.x == a.y for a in back)


def test_values_at_ranks_are_exact(spark):
    r = random.Random(2)
    data = {g: [r.choice([r.gauss(0, 1), r.choice(ODD[:-1]), 0.5]) for _ in range(n)] for g, n in (("a", 1), ("b", 2), (None, 333), ("c", 1000))}
    values = spark.createDataFrame([(g, x) for g, v in data.items() for x in v] + [("a", None)], "g string, value double").repartition(7)
    ranks = [(g, f"r{k}", k) for g, v in data.items() for k in {0, len(v) // 2, len(v) - 1, len(v)}]
    got = {(x.g, x.name): x.value for x in at_ranks(values, spark.createDataFrame(ranks, "g string, name string, rank long"), ["g"]).collect()}
    assert got == {(g, name): sorted(data[g])[k] for g, name, k in ranks if k < len(data[g])}


@pytest.mark.parametrize("n", [0, 1, 19, 20, 21, 400])
def test_both_forms_of_the_summary_agree(spark, n):
    r = random.Random(n)
    rows = [(r.choice(["train", "val"]), r.choice(["s1", "s2", None]), f"u{i}", 75, 0, 74 + r.randint(0, 2), r.choice([1.19, 3.0, r.uniform(0.2, 4), None])) for i in range(n)]
    df = spark.createDataFrame(rows, "split string, speaker_id string, utterance_id string, frame_count int, first_frame_index int, last_frame_index int, audio_duration_sec double")
    g = duration.gaps(df)
    plain, ranked = (sorted(map(tuple, duration.summarise(g, held).collect()), key=repr) for held in (10**6, 0))
    assert plain == ranked and (n == 0) == (plain == [])


def test_a_manifest_in_blocks_is_numbered_as_one(spark, tmp_path):
    line = lambda i, quote="": ["train", f"s{i % 9 + 1}", f"u{i}", f"{quote}s{i % 9 + 1}.tar{quote}", f"s{i % 9 + 1}/u{i}/", "75", "0", "74", "1.0", "1.19", "16000", "True"]
    head = ",".join(MANIFEST_COLUMNS)
    path = tmp_path / "m.csv"
    path.write_text("\n".join([head, *(",".join(line(i, '"' if i % 3 == 0 else "")) for i in range(3000))]) + "\n")
    whole = [(r.row_number, r.utterance_id, r.shard_path) for r in source.raw(spark, str(path), "train").orderBy("row_number").collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        blocks = source.raw(spark, str(path), "train")
        assert [(r.row_number, r.utterance_id, r.shard_path) for r in blocks.orderBy("row_number").collect()] == whole and whole[0][0] == 2 and whole[-1][0] == 3001
        assert source._divides(spark, str(path))
        path.write_text(path.read_text() + 'train,s1,"two\nlines",s1.tar\n')
        assert not source._divides(spark, str(path))
        assert source.raw(spark, str(path), "train").count() == 3001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert np.array_equal([n for n, _, _ in whole], np.arange(2, 3002))


def test_csv_is_written_by_tasks(spark, tmp_path):
    from corvane.errors import PersistenceError
    from corvane.sinks import files

    rows = [(i, f'a,"{i}"\n' if i % 3 else None, i % 2 == 0, i / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, t string, b boolean, x double").orderBy("i")
    one = files.write_csv(str(tmp_path / "one.csv"), df.columns, rows, bom=True)
    many = files.table_csv(df, str(tmp_path / "many.csv"), bom=True)
    assert open(many, "rb").read() == open(one, "rb").read() and {x.name for x in tmp_path.iterdir()} == {"one.csv", "many.csv"}
    none = files.table_csv(df.where("i < 0"), str(tmp_path / "none.csv"))
    assert open(none, "rb").read() == b"i,t,b,x\r\n"
    with pytest.raises(PersistenceError):
        files.table_csv(df, str(tmp_path / "one.csv/x/y.csv"))
    with pytest.raises(Exception):
        files.table_csv(df.withColumn("t", F.raise_error(F.lit("lost")).cast("string")), many)
    assert open(many, "rb").read() == open(one, "rb").read()


def test_a_summary_makes_its_rows_once_and_shuffles_few(spark):
    """The rows are evaluated once, however many passes the order statistics take, and passes shuffle counts only."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    u = spark.range(3000).selectExpr("array('train','val')[id % 2] as split", "concat('s', id % 3) as speaker_id", "cast(id as string) as utterance_id", "2 as frame_count", "0 as first_frame_index", "cast(id % 50 + 1 as int) as last_frame_index", "id % 41 / 10.0D + 0.01D as audio_duration_sec")
    rows = duration.gaps(u)
    rows = rows.mapInArrow(seen, rows.schema)
    plain = sorted(map(tuple, duration.summarise(duration.gaps(u)).collect()), key=repr)
    assert sorted(map(tuple, duration.summarise(rows, held=0).collect()), key=repr) == plain
    assert made.value == 3000
