"""Reference data: FX rates, the channel catalog and the campaign catalog.

The values below are fixed values that must equal the source system's for the
results to agree. They are kept as plain Python mappings so their size is known
before anything is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Rate that converts one unit of the currency into DKK.
FX_TO_DKK: dict[str, float] = {"DKK": 1.0, "EUR": 7.46, "SEK": 0.64}

# Channel name -> channel group (the catalog, in catalog order).
CHANNEL_GROUPS: dict[str, str] = {
    "Paid Search": "Paid",
    "Paid Social": "Paid",
    "Display": "Paid",
    "Email": "Owned",
    "Organic Social": "Earned",
    "Affiliate": "Paid",
}

# Group of any channel that is not in the catalog.
OTHER_GROUP = "Other"

# Campaign catalog in catalog order: (campaign_id, campaign_name, channel).
CAMPAIGNS: tuple[tuple[str, str, str], ...] = (
    ("CMP-1000", "Spring Skyr Launch", "Paid Search"),
    ("CMP-1001", "Protein Pudding Awareness", "Paid Social"),
    ("CMP-1002", "Organic Milk Always-On", "Paid Search"),
    ("CMP-1003", "Cheese Lovers Retargeting", "Display"),
    ("CMP-1004", "Barista Edition Teaser", "Paid Social"),
    ("CMP-1005", "Recipe Newsletter", "Email"),
    ("CMP-1006", "Summer Smoothie UGC", "Organic Social"),
    ("CMP-1007", "Lactose-Free Affiliate Push", "Affiliate"),
    ("CMP-1008", "Kids Yogurt Back-to-School", "Display"),
    ("CMP-1009", "Sustainability Story", "Organic Social"),
)
# --- end of fixed values ----------------------------------------------------


def lookup(values: Mapping[str, object], key: Column, default: object) -> Column:
    """The entry of a small mapping for ``key``, else ``default`` (NULL keys too).

    The mapping is a literal of the plan: these are catalogs of a few entries. A
    table of rates belongs in a joined DataFrame instead.
    """
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))

# Letters whose full case mapping is not one to one, or differs by place in the word.
TITLE_LETTERS = ("ß", "Σ", "ǆ", "ﬁ", "ŉ", "İ", "ა", "é", "Ǆ", "ΐ")
