"""Equality by digests: the same answer as a comparison row by row, without moving rows."""

import random

import pytest
from pyspark.sql import functions as F

from spendstar.operators import reconcile as R

SCHEMA = "a string, b long, c decimal(14,2), d date"


def rows_of(rng, n):
    return [
        (rng.choice(["x", "y", None, ""]), rng.choice([1, 2, None]), rng.choice([None, 1, 2]), None) for _ in range(n)
    ]


def summary(df):
    return tuple(df.first())


@pytest.mark.parametrize("seed", range(4))
def test_equals_except_all(spark, seed):
    from decimal import Decimal

    rng = random.Random(seed)
    rows = [(a, b, None if c is None else Decimal(c), d) for a, b, c, d in rows_of(rng, 60)]
    other = rows[:]
    if seed % 2:
        other = other[:-3] + [other[0]]
    rng.shuffle(other)
    left, right = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA).repartition(5)
    want = (len(rows), len(other), left.exceptAll(right).count(), right.exceptAll(left).count())
    assert summary(R.set_diff_summary(left, right, "l", "r")) == want
    assert summary(R._row_differences(left, right, "l", "r")) == want


def test_null_has_a_place(spark):
    left = spark.createDataFrame([("a", None)], "x string, y string")
    right = spark.createDataFrame([(None, "a")], "x string, y string")
    assert summary(R.set_diff_summary(left, right, "l", "r")) == (1, 1, 1, 1)


def test_counts_matter(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    right = spark.createDataFrame([(1,), (2,), (2,)], "x long")
    assert summary(R.set_diff_summary(left, right, "l", "r")) == (3, 3, 1, 1)
    empty = left.limit(0)
    assert summary(R.set_diff_summary(empty, empty, "l", "r")) == (0, 0, 0, 0)


def test_equal_sides_move_no_rows(spark):
    wide = spark.range(1_000).select("id", F.lit("x").alias("t"))
    plan = R.multiset_digest(wide)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("Exchange") == 1 and "SinglePartition" in plan
    same = R.set_diff_summary(wide, wide.repartition(3), "l", "r")
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
