"""Records of CSV files whose quoted cells hold line breaks, read in many tasks a file.

A line ends a record exactly if an even number of quotes stands before its end. So:

1. one pass counts the quotes of each split (a byte range of a file); the parities of a
   file's splits, added up in order, say whether a split begins inside quotes;
2. a second pass over the same splits joins each split's lines into records. A split gives
   out whole records, and what its neighbours must be joined to: the lines before its
   first record start and those of its last, unfinished record;
3. these fragments, at most two a split, are put together by file; nothing else is moved.

A record must fit in memory, a file need not.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'

_RECORDS = pa.schema(
    [
        ("file", pa.string()),
        ("start", pa.int64()),
        ("first", pa.bool_()),  # the file's first record
        ("opens", pa.bool_()),  # its record starts in this split
        ("closes", pa.bool_()),  # its record ends in this split
        ("record", pa.string()),
    ]
)
_RECORDS_SQL = "file string, start long, first boolean, opens boolean, closes boolean, record string"


def _split_lines(spark: SparkSession, uris: list[str]) -> DataFrame:
    """(file, start, line): every line of the files; a split's lines are in order."""
    # only LF ends a line, so that CR inside quotes stays
    return spark.read.option("lineSep", "\n").text(uris).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
    )


def _inside_at_start(lines: DataFrame) -> DataFrame:
    """(file, start) of the splits that begin inside quotes."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE)))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return splits.select("file", "start", inside.alias("inside")).where("inside")


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the splits whose lines come in, in order."""
    split, inside, opens, first = None, False, True, False
    held: list[str] = []
    out: list[tuple] = []
    for batch in batches:
        for file, start, starts_inside, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, start) != split:
                if held:
                    out.append((*split, first, opens, False, "\n".join(held)))
                split, held = (file, start), []
                inside, opens, first = starts_inside, not starts_inside, start == 0
            held.append(line)
            if line.count(QUOTE) % 2:
                inside = not inside
            if not inside:
                out.append((file, start, first, opens, True, "\n".join(held)))
                held, opens, first = [], True, False
        yield _batch(out)
        out = []
    if held:
        yield _batch([(*split, first, opens, False, "\n".join(held))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_RECORDS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)], schema=_RECORDS)


def read_records(spark: SparkSession, uris: list[str]) -> DataFrame:
    """(file, first, record): all records of the files, empty lines left out.

    ``first`` marks each file's first record. A file that ends inside quotes gives its
    rest as a record.
    """
    lines = _split_lines(spark, uris)
    # Both passes plan the same splits: same files, same settings. At most a row a split, fewer
    # than the tasks the driver lists for this scan; a broadcast join keeps the lines' order.
    starts = F.broadcast(_inside_at_start(lines))
    pieces = (
        lines.join(starts, ["file", "start"], "left")
        .select("file", "start", F.coalesce("inside", F.lit(False)).alias("inside"), "line")
        .mapInArrow(_join_lines, _RECORDS_SQL)
    )
    whole = F.col("opens") & F.col("closes")
    fragments = pieces.where(~whole)
    # a record's fragments: from one that opens it up to the next
    order = Window.partitionBy("file").orderBy("start", "opens")
    joined = (
        fragments.withColumn("number", F.sum(F.col("opens").cast("long")).over(order))
        .groupBy("file", "number")
        .agg(
            F.max("first").alias("first"),
            F.array_sort(F.collect_list(F.struct("start", "opens", "record"))).alias("parts"),
        )
        .select("file", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    )
    records = pieces.where(whole).select("file", "first", "record").unionByName(joined)
    # CR LF ends a record too
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.select("file", "first", record.alias("record")).where("record <> ''")
