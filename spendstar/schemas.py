"""Column orders and Spark types of every layer (the table contract)."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is exact decimal inside the warehouse.
MONEY = T.DecimalType(14, 2)
# Sums of money: a grain can hold more than a single event.
MONEY_SUM = T.DecimalType(38, 2)

# --- fixed values (names, order and types of every layer's columns: the table contract) ---
RAW_COLUMNS = (
    "event_date",
    "channel",
    "campaign_id",
    "campaign_name",
    "impressions",
    "clicks",
    "spend",
    "conversions",
    "currency",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = T.StructType(
    list(RAW_SCHEMA.fields)
    + [
        T.StructField("_ingested_at", T.TimestampType(), True),
        T.StructField("_source_file", T.StringType(), True),
    ]
)

SILVER_COLUMNS = (
    "event_date",
    "channel",
    "campaign_id",
    "campaign_name",
    "impressions",
    "clicks",
    "spend_dkk",
    "conversions",
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.DateType(), True),
        T.StructField("channel", T.StringType(), True),
        T.StructField("campaign_id", T.StringType(), True),
        T.StructField("campaign_name", T.StringType(), True),
        T.StructField("impressions", T.IntegerType(), True),
        T.StructField("clicks", T.IntegerType(), True),
        T.StructField("spend_dkk", MONEY, True),
        T.StructField("conversions", T.IntegerType(), True),
    ]
)

DIM_DATE_COLUMNS = (
    "date_key",
    "full_date",
    "year",
    "quarter",
    "month",
    "month_name",
    "day",
    "iso_week",
    "day_of_week",
    "is_weekend",
)

DIM_DATE_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.IntegerType(), True),
        T.StructField("full_date", T.DateType(), True),
        T.StructField("year", T.LongType(), True),
        T.StructField("quarter", T.LongType(), True),
        T.StructField("month", T.LongType(), True),
        T.StructField("month_name", T.StringType(), True),
        T.StructField("day", T.LongType(), True),
        T.StructField("iso_week", T.LongType(), True),
        T.StructField("day_of_week", T.LongType(), True),
        T.StructField("is_weekend", T.BooleanType(), True),
    ]
)

DIM_CHANNEL_COLUMNS = ("channel_key", "channel_name", "channel_group")
DIM_CHANNEL_SCHEMA = T.StructType(
    [
        T.StructField("channel_key", T.LongType(), True),
        T.StructField("channel_name", T.StringType(), True),
        T.StructField("channel_group", T.StringType(), True),
    ]
)

DIM_CAMPAIGN_COLUMNS = ("campaign_key", "campaign_id", "campaign_name")
DIM_CAMPAIGN_SCHEMA = T.StructType(
    [
        T.StructField("campaign_key", T.LongType(), True),
        T.StructField("campaign_id", T.StringType(), True),
        T.StructField("campaign_name", T.StringType(), True),
    ]
)

FACT_COLUMNS = (
    "date_key",
    "channel_key",
    "campaign_key",
    "impressions",
    "clicks",
    "spend_dkk",
    "conversions",
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.IntegerType(), True),
        T.StructField("channel_key", T.LongType(), True),
        T.StructField("campaign_key", T.LongType(), True),
        T.StructField("impressions", T.LongType(), True),
        T.StructField("clicks", T.LongType(), True),
        T.StructField("spend_dkk", MONEY_SUM, True),
        T.StructField("conversions", T.LongType(), True),
    ]
)

# The published extract (one JSON document).
TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("spend_dkk", T.DoubleType(), True),
        T.StructField("ctr_pct", T.DoubleType(), True),
        T.StructField("cost_per_conversion", T.DoubleType(), True),
        T.StructField("conversions", T.LongType(), True),
    ]
)
CHANNEL_ROW_SCHEMA = T.StructType(
    [
        T.StructField("channel_group", T.StringType(), True),
        T.StructField("channel_name", T.StringType(), True),
        T.StructField("spend_dkk", T.DoubleType(), True),
        T.StructField("clicks", T.LongType(), True),
        T.StructField("conversions", T.LongType(), True),
        T.StructField("ctr_pct", T.DoubleType(), True),
        T.StructField("cost_per_conversion", T.DoubleType(), True),
    ]
)
MONTHLY_ROW_SCHEMA = T.StructType(
    [
        T.StructField("year_month", T.StringType(), True),
        T.StructField("spend_dkk", T.DoubleType(), True),
        T.StructField("ctr_pct", T.DoubleType(), True),
        T.StructField("cost_per_conversion", T.DoubleType(), True),
    ]
)
MARTS_SCHEMA = T.StructType(
    [
        T.StructField("generated_at", T.StringType(), True),
        T.StructField("seed", T.LongType(), True),
        T.StructField("totals", TOTALS_SCHEMA, True),
        T.StructField("channels", T.ArrayType(CHANNEL_ROW_SCHEMA, True), True),
        T.StructField("monthly", T.ArrayType(MONTHLY_ROW_SCHEMA, True), True),
    ]
)
# ------------------------------------------------------------------------------------------
