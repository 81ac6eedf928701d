"""Conformed dimensions: dates, channels, campaigns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendstar.functions.exprs import date_key
from spendstar.operators.keys import Keyed, assign_dense_keys
from spendstar.refdata import CHANNEL_GROUPS, OTHER_GROUP, lookup
from spendstar.schemas import DIM_CAMPAIGN_COLUMNS, DIM_CHANNEL_COLUMNS, DIM_DATE_COLUMNS


def build_dim_date(silver: DataFrame) -> DataFrame:
    """One row per distinct event date (NULL included) with its calendar parts.

    ``silver`` may be silver itself or its grain aggregate (same dates).

    The distinct dates are found first, so the calendar expressions run once per
    day rather than once per event. Weekday 0 is Sunday, 6 Saturday.
    """
    d = F.col("full_date")
    dow = (F.dayofweek(d) - 1).cast("long")
    days = silver.select(F.col("event_date").alias("full_date")).distinct()
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("long").alias("day"),
        F.weekofyear(d).cast("long").alias("iso_week"),
        dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"),
    ).select(*DIM_DATE_COLUMNS)


def channel_group(name: Column, groups: Mapping[str, str] = CHANNEL_GROUPS) -> Column:
    """Catalog group of a channel name; names outside the catalog are ``Other``."""
    return lookup(groups, name, OTHER_GROUP)


def build_dim_channel(
    silver: DataFrame,
    groups: Mapping[str, str] = CHANNEL_GROUPS,
    pin_uri: str | None = None,
) -> Keyed:
    """Distinct channel names, keyed 1..n by name (NULL last), with their group."""
    names = silver.select(F.col("channel").alias("channel_name")).distinct()
    keyed = assign_dense_keys(names, "channel_name", "channel_key", pin_uri)
    df = keyed.df.withColumn("channel_group", channel_group(F.col("channel_name"), groups))
    return Keyed(df.select(*DIM_CHANNEL_COLUMNS), keyed.rows)


def build_dim_campaign(
    silver: DataFrame,
    pin_uri: str | None = None,
) -> Keyed:
    """One row per campaign id, keyed 1..n by id (NULL last).

    Should one id carry several names, the smallest non-NULL name is kept, so
    the result does not depend on row order. The group-by is a partial/final
    hash aggregate: a hot campaign is pre-reduced on every mapper.
    """
    ids = silver.groupBy("campaign_id").agg(F.min("campaign_name").alias("campaign_name"))
    keyed = assign_dense_keys(ids, "campaign_id", "campaign_key", pin_uri)
    return Keyed(keyed.df.select(*DIM_CAMPAIGN_COLUMNS), keyed.rows)
