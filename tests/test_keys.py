"""Keys are dense, in natural order, NULL last, whatever the partitioning."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendstar.operators.keys import assign_dense_keys


def test_range_keys_equal_a_global_row_number(spark):
    keys = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") == 777, F.lit(None)).otherwise(F.format_string("K%07d", F.col("id") * 7919 % 200_003)).alias("k")
    ).distinct()
    ranged = assign_dense_keys(keys, "k", "key")
    want = keys.select(F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last())).cast("long").alias("key"), "k")
    got = ranged.df.select("key", "k")
    assert ranged.rows == 200_000
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    top = ranged.df.orderBy(F.col("key").desc()).first()
    assert top.k is None and top.key == 200_000


def test_no_rows_no_keys(spark):
    none = assign_dense_keys(spark.createDataFrame([], "k string"), "k", "key")
    assert none.rows == 0 and none.df.count() == 0
