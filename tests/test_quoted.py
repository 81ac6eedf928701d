"""Quoted line breaks: files split into many tasks give what the one-task reader gives."""

import csv
import random

import pytest

from spendstar.schemas import RAW_COLUMNS
from spendstar.sources.quoted import read_records
from spendstar.sources.raw_csv import read_raw_csv

CELLS = ["", "a", "two\nlines", 'say "x"', "\n\n", "\r\nx", ",", 'q"\n"q', "é\n日本", " pad ", '""', "end\n"]


def write(path, rows, end="\n", header=RAW_COLUMNS):
    with open(path, "w", newline="") as fh:
        out = csv.writer(fh, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        out.writerow(header)
        out.writerows(rows)


def plain(spark, path):
    """The multi-line reader of Spark: one task a file."""
    options = {"header": True, "multiLine": True, "escape": '"', "mode": "FAILFAST"}
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.options(**options, **keep).csv(path).select(*RAW_COLUMNS)


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, str(v)) for k, v in zip(before, (size, 0), strict=True)]
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [64, 300, 5_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_cells_as_written(spark, scratch, small_splits, size, end):
    """Equal to the cells written and to the one-task reader.

    In files of CR LF lines that reader turns a quoted CR LF into LF; this one keeps it.
    """
    rng, written = random.Random(size), []
    for k in range(2):
        rows = [[rng.choice(CELLS) for _ in RAW_COLUMNS] for _ in range(60)]
        write(f"{scratch}/f{k}.csv", rows, end)
        written += [tuple(c or None for c in row) for row in rows]
    one_task = plain(spark, scratch).collect()
    small_splits(size)
    found = read_raw_csv(spark, scratch, multiline=True)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, written))
    if end == "\n":
        assert sorted(map(str, found.collect())) == sorted(map(str, one_task))
    assert found.count() == 120


def test_a_large_file_is_split(spark, scratch, small_splits):
    """One file of 25 MB in splits of 1 MB, a third of its cells with line breaks."""
    rng = random.Random(1)
    write(f"{scratch}/big.csv", ([rng.choice(CELLS) + "x" * rng.randrange(30) for _ in RAW_COLUMNS] for _ in range(130_000)))
    expected = plain(spark, f"{scratch}/big.csv")
    total = expected.count()
    small_splits(1 << 20)
    found = read_raw_csv(spark, f"{scratch}/big.csv", multiline=True)
    records = read_records(spark, [f"{scratch}/big.csv"])
    assert records.rdd.getNumPartitions() > 10
    assert found.count() == total == 130_000
    assert found.exceptAll(expected).count() == 0


def test_records_longer_than_splits(spark, scratch, small_splits):
    rows = [["x" + "\nline" * 100, "b", *["c"] * 7], ["d\ne"] * 9]
    write(f"{scratch}/long.csv", rows)
    small_splits(50)
    found = read_raw_csv(spark, f"{scratch}/long.csv", multiline=True, with_file_path=True)
    assert sorted(tuple(r)[:9] for r in found.collect()) == sorted(map(tuple, rows))
    assert {r._source_file.endswith("long.csv") for r in found.collect()} == {True}


@pytest.mark.parametrize("line", ["a,b", ",".join("abcdefghij"), '"open,b,c,d,e,f,g,h,i'])
def test_ragged_and_unclosed_records_fail(spark, scratch, line):
    write(f"{scratch}/bad.csv", [["a"] * 9])
    with open(f"{scratch}/bad.csv", "a") as fh:
        fh.write(line + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|Malformed"):
        read_raw_csv(spark, f"{scratch}/bad.csv", multiline=True).select("channel").collect()


def test_header_only_and_extra_columns(spark, scratch):
    write(f"{scratch}/h.csv", [])
    assert read_raw_csv(spark, f"{scratch}/h.csv", multiline=True).count() == 0
    write(f"{scratch}/e.csv", [["n\nm"] * 10], header=["region", *RAW_COLUMNS])
    kept = read_raw_csv(spark, f"{scratch}/e.csv", multiline=True, all_columns=True)
    assert kept.columns == ["region", *RAW_COLUMNS] and kept.first().region == "n\nm"
