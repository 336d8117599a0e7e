"""CSV read by many tasks against Spark's one-task reader."""

import random

import pytest

from recordlens.sources import csv_records

PIECES = ["a", "é", '""', "\n", "\r\n", ",", " ", '""x""', "\n\n", "NA", "long text " * 8]


def field(rng):
    if rng.random() < 0.5:
        return rng.choice(["", "NA", "plain", "12", "ü x", '""'])
    return '"' + "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 7))) + '"'


def content(rng, end, records, last_end=True):
    lines = ["id,one,two"] + [f"{i},{field(rng)},{field(rng)}" for i in range(records)]
    if records:
        lines.insert(rng.randrange(1, len(lines)), "")
    return end.join(lines) + (end if last_end else "")


def one_task(spark, path):
    return spark.read.options(header=True, **csv_records.OPTIONS).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["40b", "200b", "10m"])
def test_equals_the_one_task_reader(spark, tmp_path, end, size):
    rng = random.Random(f"{end}{size}")
    for i in range(2):
        (tmp_path / f"{i}.csv").write_bytes(content(rng, end, 60, last_end=bool(i)).encode())
    (tmp_path / "2.csv").write_bytes(content(rng, end, 0).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = rows(one_task(spark, str(tmp_path)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert rows(csv_records.read_csv(spark, str(tmp_path))) == want and len(want) == 120
        n_ranges = csv_records.ranges(spark, str(tmp_path)).count()
        assert n_ranges > 40 if size == "40b" else n_ranges > 12 if size == "200b" else n_ranges == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_record_over_many_ranges_and_one_big_file_in_many_tasks(spark, tmp_path):
    body = "x\n\"\"y\"\"\r\n" * 40
    text = "id,one\n" + f'1,"{body}"\n' + "".join(f'{i},"line {i}\nnext"\n' for i in range(2, 5000))
    (tmp_path / "big.csv").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
        assert csv_records.ranges(spark, str(tmp_path)).filter("open = 1 AND block < 300").count() >= 2
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        assert csv_records._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        got = rows(csv_records.read_csv(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 4999 and dict(got)["1"] == body.replace('""', '"') and dict(got)["77"] == "line 77\nnext"
