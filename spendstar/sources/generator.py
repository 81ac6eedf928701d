"""Synthetic campaign events as a distributed job.

Each row is a pure function of ``(seed, row id)``: uniform draws come from
``xxhash64`` of the seed, the id and a per-column salt, so the output does not
depend on partitioning (``rand(seed)`` does). The distributions follow the
source system's generator: a campaign uniform over the catalog, a day in 120
days from 2026-01-01, impressions 500-50,000, clicks 0.5-6 % of impressions,
conversions 1-12 % of clicks, spend 1.5-9.0 per click, currency DKK/DKK/DKK/EUR/SEK
and a channel written as is, padded with spaces or upper-cased. Then
``max(1, rows // 100)`` exact copies of earlier rows are appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.functions.exprs import r2
from spendstar.refdata import CAMPAIGNS
from spendstar.schemas import RAW_COLUMNS

# --- fixed values (generator parameters) -------------------------------------
START_DATE = "2026-01-01"
DAYS = 120
CURRENCY_CHOICES = ("DKK", "DKK", "DKK", "EUR", "SEK")
# -------------------------------------------------------------------------------

_TWO_53 = float(2**53)


def _uniform(seed: int, row_id: Column, salt: str) -> Column:
    """A uniform draw in [0, 1) from (seed, row id, salt)."""
    h = F.xxhash64(F.lit(seed).cast("long"), row_id, F.lit(salt))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(_TWO_53)


def _pick(seed: int, row_id: Column, salt: str, n: int) -> Column:
    return F.least(F.floor(_uniform(seed, row_id, salt) * n), F.lit(n - 1)).cast("int")


def _rows_for_ids(ids: DataFrame, seed: int) -> DataFrame:
    rid = F.col("id")
    names = F.array(*[F.lit(n) for _, n, _ in CAMPAIGNS])
    channels = F.array(*[F.lit(c) for _, _, c in CAMPAIGNS])
    currencies = F.array(*[F.lit(c) for c in CURRENCY_CHOICES])
    k = _pick(seed, rid, "campaign", len(CAMPAIGNS))
    impressions = (F.lit(500) + _pick(seed, rid, "impressions", 50_000 - 500 + 1)).cast("long")
    clicks = F.floor(impressions * (0.005 + _uniform(seed, rid, "ctr") * 0.055)).cast("long")
    conversions = F.floor(clicks * (0.01 + _uniform(seed, rid, "cvr") * 0.11)).cast("long")
    spend = r2(clicks * (1.5 + _uniform(seed, rid, "cpc") * 7.5))
    staged = ids.select(
        k.alias("_k"),
        _pick(seed, rid, "day", DAYS).alias("_day"),
        impressions.alias("_impr"),
        clicks.alias("_clk"),
        conversions.alias("_conv"),
        spend.alias("_spend"),
        _pick(seed, rid, "currency", len(CURRENCY_CHOICES)).alias("_cur"),
        _pick(seed, rid, "variant", 3).alias("_var"),
    )
    channel = F.element_at(channels, F.col("_k") + 1)
    return staged.select(
        F.date_format(F.date_add(F.lit(START_DATE).cast("date"), F.col("_day")), "yyyy-MM-dd").alias(
            "event_date"
        ),
        F.when(F.col("_var") == 0, channel)
        .when(F.col("_var") == 1, F.concat(F.lit(" "), channel, F.lit(" ")))
        .otherwise(F.upper(channel))
        .alias("channel"),
        F.concat(F.lit("CMP-"), (F.col("_k") + 1000).cast("string")).alias("campaign_id"),
        F.element_at(names, F.col("_k") + 1).alias("campaign_name"),
        F.col("_impr").cast("string").alias("impressions"),
        F.col("_clk").cast("string").alias("clicks"),
        F.col("_spend").cast("string").alias("spend"),
        F.col("_conv").cast("string").alias("conversions"),
        F.element_at(currencies, F.col("_cur") + 1).alias("currency"),
    ).select(*RAW_COLUMNS)


def generate_events(
    spark: SparkSession, rows: int, seed: int, num_partitions: int | None = None
) -> DataFrame:
    """``rows`` synthetic raw events plus ``max(1, rows // 100)`` exact duplicates."""
    if rows <= 0:
        raise ValueError("rows must be positive")
    parts = num_partitions or max(1, min(rows // 1_000_000 + 1, 100_000))
    base = spark.range(0, rows, 1, parts)
    n_dup = max(1, rows // 100)
    # a duplicate is the row of an earlier id, recomputed from that id (no join)
    dups = spark.range(0, n_dup, 1, max(1, parts // 100)).select(
        F.floor(_uniform(seed, F.col("id"), "duplicate") * rows).cast("long").alias("id")
    )
    return _rows_for_ids(base.unionByName(dups), seed)


def write_events(
    spark: SparkSession, rows: int, seed: int, uri: str, num_partitions: int | None = None
) -> str:
    """Generate events and write them as a raw CSV folder (header in every part)."""
    from spendstar.sources.landing import write_raw_csv

    return write_raw_csv(generate_events(spark, rows, seed, num_partitions), uri)
