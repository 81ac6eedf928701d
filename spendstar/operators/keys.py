"""Dense surrogate keys: 1..n in ascending natural-key order, NULL last.

The distinct rows are range-partitioned and sorted on the natural key, so no task
holds more than its range. Rows get their partition id and in-partition position;
the result is written to the shared folder and read back (range bounds are sampled,
so an unpinned recomputation could move rows between partitions). Per-partition
counts (one row per partition) give each partition its offset, and
key = offset + position. The number of partitions is the session's shuffle
partitioning, whatever the number of keys; adaptive execution may not merge them
below what the data need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.session import scratch_path


@dataclass(frozen=True)
class Keyed:
    """A keyed dimension and its exact row count."""

    df: DataFrame
    rows: int

    def for_join(self, *cols: str) -> DataFrame:
        """The dimension projected for a join; Spark chooses how from the written size."""
        return self.df.select(*cols) if cols else self.df


def assign_dense_keys(
    distinct_rows: DataFrame, order_col: str, key_col: str, pin_uri: str | None = None
) -> Keyed:
    """Add ``key_col`` (bigint) to rows that are unique on ``order_col``.

    ``pin_uri`` is where the pinned copy is written (default: a fresh folder under
    the shared work area).
    """
    order = F.col(order_col).asc_nulls_last()
    spark = distinct_rows.sparkSession
    ranged = (
        distinct_rows.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    uri = pin_uri or scratch_path(spark, "dense-keys")
    ranged.write.mode("overwrite").parquet(uri)
    pinned = spark.read.parquet(uri)
    # one row per non-empty partition: its first position and its row count
    counts = (
        pinned.groupBy("_pid")
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .collect()
    )
    shift, running = {}, 0
    for row in sorted(counts, key=lambda r: r["_pid"]):
        shift[row["_pid"]] = running - row["_first"] + 1
        running += row["_n"]
    # one number per partition, looked up by position: the offset of a row's partition
    offsets = [shift.get(k, 0) for k in range(max(shift, default=0) + 1)]
    key = F.element_at(F.lit(offsets), F.col("_pid") + 1) + F.col("_pos")
    return Keyed(pinned.select(key.cast("long").alias(key_col), *distinct_rows.columns), running)
