"""Silver: type, trim, canonicalise, FX-normalise, validate and de-duplicate.

Plan shape: one narrow projection over bronze (all built-in expressions, inside
whole-stage codegen), the validity filter, then ``distinct`` over the eight typed
columns - a hash aggregate with a map-side partial step, so repeated rows are
collapsed before the single shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendstar.functions.exprs import (
    canonical_name,
    r2,
    to_date_strict,
    to_double_strict,
    to_int_strict,
    trim_zs,
)
from spendstar.refdata import FX_TO_DKK, lookup
from spendstar.schemas import MONEY, SILVER_COLUMNS


def fx_rate(currency: Column, rates: Mapping[str, float] = FX_TO_DKK) -> Column:
    """Rate to DKK of a raw currency cell; unknown or missing currency -> 1.0."""
    by_code = {str(code).upper(): float(rate) for code, rate in rates.items()}
    return lookup(by_code, F.upper(trim_zs(currency)), 1.0)


def typed_events(bronze: DataFrame, rates: Mapping[str, float] = FX_TO_DKK) -> DataFrame:
    """Every bronze row typed and normalised (before validation and de-duplication).

    ``spend_dkk`` is the double product rounded to cents; it becomes a decimal only
    after validation, as invalid rows must not abort the job.
    """
    return bronze.select(
        to_date_strict("event_date").alias("event_date"),
        canonical_name("channel").alias("channel"),
        trim_zs("campaign_id").alias("campaign_id"),
        trim_zs("campaign_name").alias("campaign_name"),
        to_int_strict("impressions").alias("impressions"),
        to_int_strict("clicks").alias("clicks"),
        r2(to_double_strict("spend") * fx_rate(F.col("currency"), rates)).alias("spend_dkk"),
        to_int_strict("conversions").alias("conversions"),
    )


def is_valid() -> Column:
    """Validity of a typed row; a NULL measure makes the row invalid."""
    return (
        (F.col("impressions") >= 0)
        & (F.col("clicks") >= 0)
        & (F.col("conversions") >= 0)
        & (F.col("spend_dkk") > 0)
    )


def _money(c: Column) -> Column:
    # NaN and infinity pass "> 0" but have no decimal value: abort, do not drop.
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.raise_error(F.concat(F.lit("spend is not a number: "), c.cast("string")))).otherwise(
        c
    ).cast(MONEY)


def _to_money(df: DataFrame) -> DataFrame:
    return df.select(
        *[_money(F.col(c)).alias(c) if c == "spend_dkk" else F.col(c) for c in SILVER_COLUMNS]
    )


def evaluate_once(df: DataFrame) -> DataFrame:
    """Pin each column's expression so it is evaluated once per row.

    Catalyst pushes a filter below a projection by substituting the projected
    expressions into it. For silver that would parse every measure twice (once in
    the pushed filter, once in the projection), and push the parsing into the scan
    stage. Columns produced by a generator cannot be substituted, so a filter on
    them stays above it and reads the values computed once.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def build_silver(bronze: DataFrame, rates: Mapping[str, float] = FX_TO_DKK) -> DataFrame:
    """The silver table: valid, typed, normalised rows without exact duplicates.

    Duplicates are judged on the eight normalised columns; currency is not one of
    them, so the same event sent in two currencies collapses to one row.

    The de-duplication groups on the cent-rounded double; the decimal cast runs
    after the shuffle on the surviving rows. That is exact: distinct cent values
    below 2**53 cents are distinct doubles and vice versa, and Spark normalises
    NaN and -0.0 in grouping keys. It keeps the map-side stage (scan, typing,
    filter, partial aggregate) small enough for the JIT and hashes a double
    instead of a decimal.
    """
    typed = evaluate_once(typed_events(bronze, rates))
    return _to_money(typed.filter(is_valid()).distinct())


def dedup_stats(bronze: DataFrame, rates: Mapping[str, float] = FX_TO_DKK) -> DataFrame:
    """One row: valid rows, silver rows and duplicates removed, in one pass.

    Valid rows are grouped on the silver columns once: the number of groups is
    the silver row count and the sum of group sizes the valid row count. The
    money guard runs on every group, so NaN or infinite spend fails as in silver.
    """
    typed = evaluate_once(typed_events(bronze, rates)).filter(is_valid())
    groups = typed.groupBy(*SILVER_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    checked = groups.select("_n", _money(F.col("spend_dkk")).alias("_spend"))
    stats = checked.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("valid_rows"),
        F.count(F.col("_spend")).alias("silver_rows"),
    )
    return stats.select(
        "valid_rows", "silver_rows", (F.col("valid_rows") - F.col("silver_rows")).alias("duplicates_removed")
    )
