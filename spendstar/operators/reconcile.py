"""Reconciliation operators: invariants a correct build satisfies.

Each returns a small DataFrame (one summary row, or the offending groups) and is
computed with aggregates and scalar subqueries - no cross joins, nothing
collected. A clean build shows zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.functions.exprs import round_half_away, trim_zs


def silver_canonical_violations(silver: DataFrame) -> DataFrame:
    """Rows with an untidy channel (padded or all upper case) or an invalid measure."""
    ch = F.col("channel")
    untidy = (ch != trim_zs(ch)) | (ch == F.upper(ch))
    invalid = (
        (F.col("impressions") < 0)
        | (F.col("clicks") < 0)
        | (F.col("conversions") < 0)
        | (F.col("spend_dkk") <= 0)
    )
    return silver.agg(
        F.count(F.when(untidy, 1)).alias("untidy_channel_rows"),
        F.count(F.when(invalid, 1)).alias("invalid_measure_rows"),
    )


DUPLICATE_KEY = (
    "event_date",
    "channel",
    "campaign_id",
    "impressions",
    "clicks",
    "spend_dkk",
    "conversions",
)


def silver_duplicate_groups(silver: DataFrame) -> DataFrame:
    """Groups of silver rows equal on the event columns (the name left out)."""
    groups = silver.groupBy(*DUPLICATE_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return groups.filter(F.col("rows") > 1)


def spend_reconciliation(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Total spend of silver against total spend of the fact, to the cent."""
    s = silver.agg(F.sum("spend_dkk")).scalar()
    f = fact.agg(F.sum("spend_dkk")).scalar()
    spark = silver.sparkSession
    out = spark.range(1).select(s.alias("silver_spend_dkk"), f.alias("fact_spend_dkk"))
    return out.select(
        "silver_spend_dkk",
        "fact_spend_dkk",
        (F.col("fact_spend_dkk") - F.col("silver_spend_dkk")).alias("difference"),
        F.coalesce(F.col("fact_spend_dkk") == F.col("silver_spend_dkk"), F.lit(False)).alias(
            "matches"
        ),
    )


def mart_reconciliation(totals: DataFrame, channels: DataFrame, monthly: DataFrame) -> DataFrame:
    """Channel spends and monthly spends must each add up to the total, to the cent."""
    def cents(c: str):
        return round_half_away(F.col(c) * F.lit(100.0)).cast("long")

    total = totals.agg(F.sum(cents("spend_dkk"))).scalar()
    by_channel = channels.agg(F.sum(cents("spend_dkk"))).scalar()
    by_month = monthly.agg(F.sum(cents("spend_dkk"))).scalar()
    spark = totals.sparkSession
    out = spark.range(1).select(
        total.alias("total_cents"), by_channel.alias("channel_cents"), by_month.alias("monthly_cents")
    )
    return out.select(
        "total_cents",
        "channel_cents",
        "monthly_cents",
        F.coalesce(
            (F.col("channel_cents") == F.col("total_cents"))
            & (F.col("monthly_cents") == F.col("total_cents")),
            F.lit(False),
        ).alias("matches"),
    )


def in_cents(fact: DataFrame) -> DataFrame:
    """A fact with spend as integer cents, for exact comparison."""
    return fact.select(
        *[
            (F.col(c) * 100).cast("long").alias(c) if c == "spend_dkk" else F.col(c)
            for c in fact.columns
        ]
    )


def multiset_digest(rows: DataFrame) -> DataFrame:
    """One row that tells two multisets of rows apart: their number and the sums of two row hashes.

    Sums do not depend on order, so a digest needs no shuffle of rows. Each column goes into the
    hash beside whether it is NULL, as a hash passes over NULLs.
    """
    cells = [x for c in rows.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    # a 64-bit hash in decimal(28,0) leaves room for 10^19 rows
    sums = [
        F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{k}")
        for k, seed in enumerate(("left", "right"))
    ]
    return rows.agg(F.count(F.lit(1)).alias("rows"), *sums)


def set_diff_summary(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Row counts of two builds and of the rows each has that the other lacks.

    Multiset semantics (as ``exceptAll``: a duplicated row counts); NULLs compare equal. Equal
    digests decide equality while each side is read once and nothing but two rows is moved;
    only if they differ are the sides compared row by row.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    right = right.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in left.columns])
    a, b = [tuple(r) for r in (multiset_digest(left).first(), multiset_digest(right).first())]
    if a != b:
        return _row_differences(left, right, left_name, right_name)
    names = [f"{left_name}_rows", f"{right_name}_rows", f"only_{left_name}", f"only_{right_name}"]
    return left.sparkSession.createDataFrame([(a[0], b[0], 0, 0)], ", ".join(f"`{n}` long" for n in names))


def _row_differences(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """The full comparison: a side-marked union grouped by the whole row, each input shuffled once."""
    marked = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = marked.groupBy(*left.columns).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    zero = F.lit(0).cast("long")
    return per_row.agg(
        F.coalesce(F.sum("_nl"), zero).cast("long").alias(f"{left_name}_rows"),
        F.coalesce(F.sum("_nr"), zero).cast("long").alias(f"{right_name}_rows"),
        F.coalesce(F.sum(F.greatest(F.col("_nl") - F.col("_nr"), F.lit(0))), zero).cast("long").alias(
            f"only_{left_name}"
        ),
        F.coalesce(F.sum(F.greatest(F.col("_nr") - F.col("_nl"), F.lit(0))), zero).cast("long").alias(
            f"only_{right_name}"
        ),
    )
