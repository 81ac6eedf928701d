"""Marts over the gold star schema: report, totals, channels, monthly, series.

Ratios are always computed from summed numerators and denominators, never as an
average of ratios. All marts aggregate the fact, which is already one row per
(date, channel, campaign), after joining the (small) dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.functions.exprs import cost_per_conversion, ctr_pct, money_to_double

# --- fixed values (labels of the dashboard's KPI cards and metric choices) ---
KPI_LABELS = (
    ("spend_dkk", "Total spend"),
    ("ctr_pct", "Blended CTR"),
    ("cost_per_conversion", "Cost / conversion"),
    ("conversions", "Conversions"),
)
METRICS = (("spend_dkk", "Spend"), ("ctr_pct", "CTR"), ("cost_per_conversion", "CPA"))
# -------------------------------------------------------------------------------


MEASURES = ("spend_dkk", "clicks", "conversions", "impressions")


def _sums() -> list:
    return [F.sum(m).alias(m) for m in MEASURES]


def _ratios() -> list:
    return [
        ctr_pct(F.col("clicks"), F.col("impressions")).alias("ctr_pct"),
        cost_per_conversion(F.col("spend_dkk"), F.col("conversions")).alias("cost_per_conversion"),
    ]


def _spend_of(column: str = "spend_dkk"):
    return money_to_double(F.col(column)).alias("spend_dkk")


def rollup(fact: DataFrame, dim_channel: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sums by channel and month, from one scan of the fact: every mart adds up these few rows.

    Facts whose channel or date does not resolve keep rows of their own (``has_channel``,
    ``has_date``): the totals count them, the other marts do not.
    """
    ch = dim_channel.select("channel_key", "channel_group", "channel_name", F.lit(True).alias("has_channel"))
    dd = dim_date.select("date_key", "year", "month", F.lit(True).alias("has_date"))
    keys = ["has_channel", "channel_group", "channel_name", "has_date", "year", "month"]
    return fact.join(ch, "channel_key", "left").join(dd, "date_key", "left").groupBy(*keys).agg(*_sums())


def _nulls_last(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def report_of(sums: DataFrame) -> DataFrame:
    """The channel x month report from a roll-up."""
    keys = ["channel_group", "channel_name", "year", "month"]
    g = sums.where("has_channel and has_date").groupBy(*keys).agg(*_sums())
    return _nulls_last(g.select(*keys, "spend_dkk", "clicks", "conversions", *_ratios()), *keys)


def totals_of(sums: DataFrame) -> DataFrame:
    """The totals from a roll-up or a fact."""
    return sums.agg(*_sums()).select(_spend_of(), *_ratios(), F.col("conversions").cast("long").alias("conversions"))


def channels_of(sums: DataFrame) -> DataFrame:
    """The channel mart from a roll-up."""
    keys = ["channel_group", "channel_name"]
    g = sums.where("has_channel").groupBy(*keys).agg(*_sums())
    counts = [F.col(c).cast("long").alias(c) for c in ("clicks", "conversions")]
    return _nulls_last(g.select(*keys, _spend_of(), *counts, *_ratios()), *keys)


def monthly_of(sums: DataFrame) -> DataFrame:
    """The monthly mart from a roll-up."""
    month = F.format_string("%04d-%02d", F.col("year"), F.col("month")).alias("year_month")
    g = sums.where("has_date").groupBy(month).agg(*_sums())
    return _nulls_last(g.select("year_month", _spend_of(), *_ratios()), "year_month")


def _with_dimensions(fact: DataFrame, dim_channel: DataFrame | None, dim_date: DataFrame | None) -> DataFrame:
    """The fact's measures beside the columns that the ``*_of`` functions group by."""
    if dim_channel is not None:
        ch = dim_channel.select("channel_key", "channel_group", "channel_name", F.lit(True).alias("has_channel"))
        fact = fact.join(ch, "channel_key")
    if dim_date is not None:
        fact = fact.join(dim_date.select("date_key", "year", "month", F.lit(True).alias("has_date")), "date_key")
    return fact


def report_channel_month(fact: DataFrame, dim_channel: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend, clicks, conversions, CTR and cost per conversion by channel and month."""
    return report_of(_with_dimensions(fact, dim_channel, dim_date))


def mart_totals(fact: DataFrame) -> DataFrame:
    """One row: total spend, blended CTR, cost per conversion, conversions."""
    return totals_of(fact)


def mart_channels(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Per channel (and its group): spend, clicks, conversions, CTR, cost per conversion."""
    return channels_of(_with_dimensions(fact, dim_channel, None))


def mart_monthly(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per calendar month ``YYYY-MM``: spend, CTR, cost per conversion."""
    return monthly_of(_with_dimensions(fact, None, dim_date))


def _long(wide: DataFrame, keys: list[str], labelled) -> DataFrame:
    """One row per metric: literal names and labels beside the value, no join."""
    entries = [
        F.struct(F.lit(m).alias("metric"), F.lit(label).alias("label"), F.col(m).cast("double").alias("value"))
        for m, label in labelled
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def monthly_metric_series(monthly: DataFrame) -> DataFrame:
    """Long form of the monthly mart: (year_month, metric, label, value)."""
    return _long(monthly, ["year_month"], METRICS)


def channel_metric_series(channels: DataFrame) -> DataFrame:
    """Long form of the channel mart: (channel_group, channel_name, metric, label, value)."""
    return _long(channels, ["channel_group", "channel_name"], METRICS)


def kpi_long(totals: DataFrame) -> DataFrame:
    """The four KPI cards as (metric, label, value) rows; values as double."""
    return _long(totals, [], KPI_LABELS)
