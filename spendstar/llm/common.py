"""Helpers shared by the operators of this subpackage.

Ranges of an id column are cut at approximate quantiles, so a global order (next
row, row number) needs only one shuffle by range and a driver-side list of one
number per range; no window ever spans the whole table.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.session import shared_root

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Rows and bytes per Arrow batch for functions over whole texts: a batch of long
# documents must fit in a Python worker.
TEXT_BATCH_ROWS = 2000
TEXT_BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings the Python stages rely on, and the package on the workers' path."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark) + "/checkpoints")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(df: DataFrame, col: str = "text") -> Column:
    return F.coalesce(df[col], F.lit(""))


def id_splits(df: DataFrame, col: str, parts: int) -> list[int]:
    """Ascending cut points that divide ``col`` into about ``parts`` equal ranges."""
    if parts < 2:
        return []
    marks = [i / parts for i in range(1, parts)]
    row = df.select(
        F.percentile_approx(F.col(col), marks, max(10_000, 20 * parts)).alias("marks")
    ).first()
    return sorted(set(row["marks"] or []))


def range_of(col: Column, splits: list[int]) -> Column:
    """Number of the range that holds ``col``: how many cut points are <= it (NULL: 0).

    Looked up in two levels, so a row compares with about twice the square root
    of the number of cut points.
    """
    if not splits:
        return F.lit(0)
    step = math.isqrt(len(splits) - 1) + 1
    groups = [splits[i : i + step] for i in range(0, len(splits), step)]
    outer = F.size(F.filter(F.lit([g[0] for g in groups]), lambda x: x <= col))
    inner = F.size(
        F.filter(
            F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(outer, F.lit(1))),
            lambda x: x <= col,
        )
    )
    return F.when(outer == 0, 0).otherwise((outer - 1) * step + inner).cast("int")


def add_fields(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """``schema`` with more fields given as (name, DDL type)."""
    more = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))
    return T.StructType([*schema.fields, *more.fields])
