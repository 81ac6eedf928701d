"""Driver tables -> raw campaign events.

The driver ships TPC-H-like tables, not campaign files. This projection maps each
``lineitem`` row to one raw event in the shape of the raw CSV (every column text),
including the dirt silver has to clean: padded and upper-cased channel names,
negative impressions, zero spend, a missing or untidy currency, and exact
duplicate rows. Every rule is a per-row expression, so the scan stays narrow and
splits like the parquet it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.refdata import CAMPAIGNS
from spendstar.schemas import RAW_COLUMNS

LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_CONF = "spendstar.scan.spread"


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan's rows round-robin into as many partitions as ``SPREAD_CONF`` says.

    Off unless set: a scan keeps its splits. Worth setting for a small file of one
    row group, which is one task otherwise.
    """
    wanted = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(wanted)) if wanted else df


def raw_events_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Project ``lineitem`` to raw campaign events (9 text columns)."""
    names = F.array(*[F.lit(name) for _, name, _ in CAMPAIGNS])
    channels = F.array(*[F.lit(channel) for _, _, channel in CAMPAIGNS])
    li = spread(lineitem.select(*LINEITEM_COLUMNS))
    k = (F.col("l_partkey") % 10).cast("int")
    ok = F.col("l_orderkey")
    q = F.col("l_quantity").cast("int")
    stage = li.select(
        "*",
        k.alias("_k"),
        q.alias("_q"),
        (q * (F.lit(5) + ok % 56)).alias("_clk"),
        # rows whose order key is a multiple of 100 arrive twice
        F.explode(F.sequence(F.lit(1), F.when(ok % 100 == 0, 2).otherwise(1))).alias("_copy"),
    )
    catalog_channel = F.element_at(channels, F.col("_k") + 1)
    channel = (
        F.when(F.col("l_linenumber") % 3 == 0, catalog_channel)
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit(" "), catalog_channel, F.lit(" ")))
        .otherwise(F.upper(catalog_channel))
    )
    spend = F.when(ok % 89 == 0, F.lit("0.00")).otherwise(
        F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    )
    currency = (
        F.when(ok % 83 == 0, F.lit(None).cast("string"))
        .when(ok % 5 <= 2, F.lit("DKK"))
        .when(ok % 5 == 3, F.lit(" eur "))
        .otherwise(F.lit("SEK"))
    )
    return stage.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_date"),
        channel.alias("channel"),
        F.concat(F.lit("CMP-"), (F.col("_k") + 1000).cast("string")).alias("campaign_id"),
        F.element_at(names, F.col("_k") + 1).alias("campaign_name"),
        F.when(ok % 97 == 0, F.lit("-1"))
        .otherwise((F.col("_q") * 1000).cast("string"))
        .alias("impressions"),
        F.col("_clk").cast("string").alias("clicks"),
        spend.alias("spend"),
        F.expr("(_clk * (1 + l_suppkey % 12)) div 100").cast("string").alias("conversions"),
        currency.alias("currency"),
    ).select(*RAW_COLUMNS)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw campaign events derived from ``<sf_dir>/lineitem.parquet``."""
    return raw_events_from_lineitem(read_table(spark, sf_dir, "lineitem"))
