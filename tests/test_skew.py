"""Skewed input: a third of all rows identical, another third on one grain."""

from pyspark.sql import functions as F

from spendstar.operators.gold import build_gold
from spendstar.operators.silver import build_silver

N = 30_000


def skewed_raw(spark):
    i = F.col("id")
    third = F.lit(N // 3)
    hot_copy = i < third                     # one identical event, N/3 times
    hot_grain = (i >= third) & (i < 2 * third)  # one (date, channel, campaign), distinct events
    day = F.when(hot_copy | hot_grain, 0).otherwise(i % 90)
    return spark.range(0, N, 1, 8).select(
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), day.cast("int")), "yyyy-MM-dd").alias("event_date"),
        F.when(hot_copy | hot_grain, F.lit(" PAID SEARCH ")).otherwise(F.lit("Email")).alias("channel"),
        F.when(hot_copy | hot_grain, F.lit("CMP-1000")).otherwise(F.concat(F.lit("CMP-"), (1001 + i % 7).cast("string"))).alias("campaign_id"),
        F.lit("Name").alias("campaign_name"),
        F.when(hot_copy, F.lit("1000")).otherwise((i + 1000).cast("string")).alias("impressions"),
        F.lit("10").alias("clicks"),
        F.lit("2.50").alias("spend"),
        F.lit("1").alias("conversions"),
        F.when(i % 2 == 0, F.lit("DKK")).otherwise(F.lit(" dkk ")).alias("currency"),
    )


def test_hot_duplicates_and_hot_grain_are_exact(spark):
    silver = build_silver(skewed_raw(spark))
    third = N // 3
    # the identical third collapses to one row; the hot-grain third stays distinct
    assert silver.count() == 1 + third + third
    gold = build_gold(silver)
    hot = gold.fact.join(gold.dim_campaign.df.filter("campaign_id = 'CMP-1000'"), "campaign_key").filter(
        "date_key = 20260101"
    )
    row = hot.agg(F.sum("impressions").alias("i"), F.sum("spend_dkk").alias("s"), F.count(F.lit(1)).alias("n")).first()
    expected_impressions = 1000 + sum(k + 1000 for k in range(third, 2 * third))
    assert (row.n, row.i) == (1, expected_impressions)
    assert str(row.s) == f"{(1 + third) * 2.5:.2f}"
    plan = gold.fact._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # the hot grain is pre-aggregated on every mapper
