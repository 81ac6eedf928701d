"""The gold star schema.

Every gold table is derived from the grain aggregate of silver (one row per
event_date, channel, campaign_id with summed measures and the smallest campaign
name): its dates, channels and campaign ids are exactly silver's, and the
smallest name per campaign is the smallest of the per-grain smallest names. The
grain is usually orders of magnitude smaller than silver, so materialising it
once and deriving the dimensions and the fact from it replaces three scans of
silver with one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from spendstar.operators.dimensions import build_dim_campaign, build_dim_channel, build_dim_date
from spendstar.operators.fact import aggregate_grain, build_fact
from spendstar.operators.keys import Keyed
from spendstar.refdata import CHANNEL_GROUPS

GOLD_TABLES = ("dim_date", "dim_channel", "dim_campaign", "fact_campaign_performance")


@dataclass(frozen=True)
class Gold:
    dim_date: DataFrame
    dim_channel: Keyed
    dim_campaign: Keyed
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.dim_date,
            "dim_channel": self.dim_channel.df,
            "dim_campaign": self.dim_campaign.df,
            "fact_campaign_performance": self.fact,
        }


def build_gold_from_grain(
    grain: DataFrame,
    groups: Mapping[str, str] = CHANNEL_GROUPS,
) -> Gold:
    """Dimensions first (their keys feed the fact), then the fact."""
    dim_channel = build_dim_channel(grain, groups)
    dim_campaign = build_dim_campaign(grain)
    return Gold(
        dim_date=build_dim_date(grain),
        dim_channel=dim_channel,
        dim_campaign=dim_campaign,
        fact=build_fact(grain, dim_channel, dim_campaign),
    )


def build_gold(
    silver: DataFrame,
    groups: Mapping[str, str] = CHANNEL_GROUPS,
) -> Gold:
    """The star schema straight from silver (grain not materialised)."""
    return build_gold_from_grain(aggregate_grain(silver), groups)
