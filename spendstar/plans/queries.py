"""Registered queries over the driver's tables.

Each query takes ``(spark, sf_dir)``, derives raw campaign events from
``<sf_dir>/lineitem.parquet`` (see ``sources.testdata``) and runs one operator
of the warehouse over all of them. Money leaves a query as double (decimal sums
differ in precision between engines; the values do not).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.functions.exprs import canonical_name, r2, to_double_strict, trim_zs
from spendstar.operators import marts as M
from spendstar.operators import quality as Q
from spendstar.operators import reconcile as R
from spendstar.operators.fact import aggregate_grain, natural_fact, silver_sums
from spendstar.operators.gold import Gold, build_gold_from_grain
from spendstar.operators.silver import build_silver, dedup_stats, fx_rate, typed_events
from spendstar.plans.pipeline import write_layers
from spendstar.refdata import TITLE_LETTERS
from spendstar.schemas import FACT_SCHEMA, SILVER_SCHEMA
from spendstar.session import apply_runtime_conf, scratch_path
from spendstar.sources import extract as X
from spendstar.sources.landing import land, write_raw_csv
from spendstar.sources.raw_csv import read_raw_csv, to_bronze
from spendstar.sources.testdata import raw_events
from spendstar.sources.warehouse import Warehouse

# The hand-made orphan fact row used to prove the gate fails.
ORPHAN_FACT_ROW = (99999999, -1, -1, 0, 0, "0.00", 0)

GENERATED_AT = "2026-06-30T00:00:00Z"
SEED = 42


def boundary(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double at the query boundary."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Build:
    """Layers of one query over one scale-factor folder.

    ``silver`` is lazy. Anything that needs gold first writes the grain aggregate
    of silver once to the shared folder and reads it back: the dimensions and the
    fact derive from that small table instead of re-deriving silver. Checks that
    compare silver with gold use silver written the same way.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        apply_runtime_conf(spark)
        self.spark = spark
        self.raw = raw_events(spark, sf_dir)
        self.silver = build_silver(self.raw)
        self._silver_table: DataFrame | None = None
        self._grain_table: DataFrame | None = None
        self._gold: Gold | None = None

    @property
    def silver_table(self) -> DataFrame:
        if self._silver_table is None:
            uri = scratch_path(self.spark, "silver")
            self.silver.write.mode("overwrite").parquet(uri)
            self._silver_table = self.spark.read.schema(SILVER_SCHEMA).parquet(uri)
        return self._silver_table

    @property
    def grain_table(self) -> DataFrame:
        if self._grain_table is None:
            uri = scratch_path(self.spark, "grain")
            # from the written silver when a query already needed it: silver once
            source = self._silver_table if self._silver_table is not None else self.silver
            aggregate_grain(source).write.mode("overwrite").parquet(uri)
            self._grain_table = self.spark.read.parquet(uri)
        return self._grain_table

    @property
    def gold(self) -> Gold:
        if self._gold is None:
            self._gold = build_gold_from_grain(self.grain_table)
        return self._gold

    def marts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Totals, channels and months from one scan of the fact."""
        uri = scratch_path(self.spark, "rollup")
        g = self.gold
        M.rollup(g.fact, g.dim_channel.df, g.dim_date).write.parquet(uri)
        sums = self.spark.read.parquet(uri)
        return M.totals_of(sums), M.channels_of(sums), M.monthly_of(sums)

    def totals(self) -> DataFrame:
        return M.mart_totals(self.gold.fact)

    def channels(self) -> DataFrame:
        return M.mart_channels(self.gold.fact, self.gold.dim_channel.df)

    def monthly(self) -> DataFrame:
        return M.mart_monthly(self.gold.fact, self.gold.dim_date)


def _orphan_fact(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(
        [ORPHAN_FACT_ROW],
        "date_key int, channel_key long, campaign_key long, impressions long, clicks long, "
        "spend_dkk string, conversions long",
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMA.fields])


def _fact_with_orphan(b: Build) -> DataFrame:
    return b.gold.fact.unionByName(_orphan_fact(b.spark))


# -- sources ----------------------------------------------------------------------
def q_bronze_raw_load(spark, sf_dir):
    b = Build(spark, sf_dir)
    uri = write_raw_csv(b.raw, scratch_path(spark, "raw-csv"))
    return read_raw_csv(spark, uri)


def q_landing_roundtrip(spark, sf_dir):
    b = Build(spark, sf_dir)
    disk_uri = write_raw_csv(b.raw, scratch_path(spark, "raw-csv"))
    landed_uri = land(spark, disk_uri, scratch_path(spark, "landing"))
    disk, landed = read_raw_csv(spark, disk_uri), read_raw_csv(spark, landed_uri)
    return R.set_diff_summary(disk, landed, "disk", "landed")


# -- silver -----------------------------------------------------------------------
def q_silver_typed(spark, sf_dir):
    return typed_events(Build(spark, sf_dir).raw)


def q_channel_canonical(spark, sf_dir):
    raw = Build(spark, sf_dir).raw
    pairs = raw.select(F.col("channel").alias("raw_channel"), canonical_name("channel").alias("channel"))
    return pairs.groupBy("raw_channel", "channel").agg(F.count(F.lit(1)).alias("rows"))


def q_title_case_letters(spark, sf_dir):
    """Canonical names of channels between letters whose case mapping engines differ in."""
    raw = Build(spark, sf_dir).raw
    letter = F.element_at(F.lit(list(TITLE_LETTERS)), F.col("clicks").cast("int") % len(TITLE_LETTERS) + 1)
    names = raw.select(F.concat(letter, F.lit("a "), letter, F.col("channel"), F.lit(" o"), letter).alias("raw_name"))
    return names.groupBy("raw_name", canonical_name("raw_name").alias("name")).agg(F.count(F.lit(1)).alias("rows"))


def q_fx_normalise(spark, sf_dir):
    raw = Build(spark, sf_dir).raw
    rate = fx_rate(F.col("currency"))
    out = raw.select(
        F.upper(trim_zs("currency")).alias("currency_code"),
        rate.alias("rate_to_dkk"),
        r2(to_double_strict("spend") * rate).cast("decimal(18,2)").alias("spend_dkk"),
    )
    return boundary(
        out.groupBy("currency_code", "rate_to_dkk").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("spend_dkk").alias("spend_dkk")
        )
    )


def q_silver_clean(spark, sf_dir):
    return boundary(Build(spark, sf_dir).silver)


def q_duplicate_rows_removed(spark, sf_dir):
    return dedup_stats(Build(spark, sf_dir).raw)


# -- gold -------------------------------------------------------------------------
def q_dim_date(spark, sf_dir):
    return Build(spark, sf_dir).gold.dim_date


def q_dim_channel(spark, sf_dir):
    return Build(spark, sf_dir).gold.dim_channel.df


def q_dim_campaign(spark, sf_dir):
    return Build(spark, sf_dir).gold.dim_campaign.df


def q_fact_campaign_performance(spark, sf_dir):
    return boundary(Build(spark, sf_dir).gold.fact)


# -- marts ------------------------------------------------------------------------
def q_report_channel_month(spark, sf_dir):
    g = Build(spark, sf_dir).gold
    return boundary(M.report_channel_month(g.fact, g.dim_channel.df, g.dim_date))


def q_mart_totals(spark, sf_dir):
    return Build(spark, sf_dir).totals()


def q_mart_channels(spark, sf_dir):
    return Build(spark, sf_dir).channels()


def q_mart_monthly(spark, sf_dir):
    return Build(spark, sf_dir).monthly()


def q_monthly_metric_series(spark, sf_dir):
    return M.monthly_metric_series(Build(spark, sf_dir).monthly())


def q_channel_metric_series(spark, sf_dir):
    return M.channel_metric_series(Build(spark, sf_dir).channels())


def q_kpi_long(spark, sf_dir):
    return M.kpi_long(Build(spark, sf_dir).totals())


def _extract(spark, sf_dir) -> X.Extract:
    """The extract, written in parts and read back."""
    b = Build(spark, sf_dir)
    lines = X.document_lines(*b.marts(), GENERATED_AT, SEED)
    return X.read_extract(spark, X.write_extract(spark, lines, scratch_path(spark, "extract")))


def q_marts_document(spark, sf_dir):
    return _extract(spark, sf_dir).flattened()


def q_marts_extract_totals(spark, sf_dir):
    return _extract(spark, sf_dir).totals


def q_marts_extract_channels(spark, sf_dir):
    return _extract(spark, sf_dir).channels


def q_marts_extract_monthly(spark, sf_dir):
    return _extract(spark, sf_dir).monthly


# -- quality ----------------------------------------------------------------------
def q_quality_checks(spark, sf_dir):
    b = Build(spark, sf_dir)
    b.silver_table  # noqa: B018 - materialise silver first; gold then derives from it
    g = b.gold
    return Q.run_checks(
        b.silver_table, g.fact, g.dim_date, g.dim_channel.df, g.dim_campaign.df)


def q_quality_checks_violations(spark, sf_dir):
    b = Build(spark, sf_dir)
    b.silver_table  # noqa: B018
    g = b.gold
    return Q.run_checks(
        b.silver_table,
        _fact_with_orphan(b),
        g.dim_date,
        g.dim_channel.df,
        g.dim_campaign.df)


def q_quality_checks_repeats(spark, sf_dir):
    """The checks on a fact whose first campaign comes twice, once with negative counts."""
    b = Build(spark, sf_dir)
    b.silver_table  # noqa: B018
    g = b.gold
    again = g.fact.where("campaign_key = 1").withColumn("impressions", -F.col("impressions"))
    return Q.run_checks(
        b.silver_table, g.fact.unionByName(again), g.dim_date, g.dim_channel.df, g.dim_campaign.df)


def q_orphan_facts(spark, sf_dir):
    b = Build(spark, sf_dir)
    g = b.gold
    orphans = Q.fact_orphans(
        _fact_with_orphan(b), g.dim_date, g.dim_channel.df, g.dim_campaign.df)
    return boundary(orphans)


# -- reconciliation ---------------------------------------------------------------
def q_silver_canonical_violations(spark, sf_dir):
    return R.silver_canonical_violations(Build(spark, sf_dir).silver)


def q_silver_duplicate_groups(spark, sf_dir):
    return boundary(R.silver_duplicate_groups(Build(spark, sf_dir).silver))


def q_silver_duplicate_groups_violations(spark, sf_dir):
    """Duplicate groups of silver in which one campaign's rows come twice."""
    silver = Build(spark, sf_dir).silver
    again = silver.where("campaign_id = 'CMP-1003'")
    return boundary(R.silver_duplicate_groups(silver.unionByName(again)))


def q_spend_reconciliation(spark, sf_dir):
    b = Build(spark, sf_dir)
    b.silver_table  # noqa: B018
    return boundary(R.spend_reconciliation(b.silver_table, b.gold.fact))


def q_mart_reconciliation(spark, sf_dir):
    return R.mart_reconciliation(*Build(spark, sf_dir).marts())


def q_fact_parity_diff(spark, sf_dir):
    b = Build(spark, sf_dir)
    b.silver_table  # noqa: B018
    g = b.gold
    resolved = natural_fact(g.fact, g.dim_channel.df, g.dim_campaign.df)
    return R.set_diff_summary(
        R.in_cents(resolved), R.in_cents(silver_sums(b.silver_table)), "fact", "silver"
    )


def q_layer_row_counts(spark, sf_dir):
    """Rows of each table of a run, counted while its layers were written."""
    apply_runtime_conf(spark)
    wh, run_id = Warehouse(spark, scratch_path(spark, "warehouse")), "counted"
    wh.claim(run_id)
    write_layers(wh, run_id, to_bronze(raw_events(spark, sf_dir), sf_dir))
    rows = [(layer, table, n) for (layer, table), n in wh.row_counts(run_id).items()]
    return spark.createDataFrame(rows, "layer string, table_name string, row_count long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_raw_load": q_bronze_raw_load,
    "landing_roundtrip": q_landing_roundtrip,
    "silver_typed": q_silver_typed,
    "channel_canonical": q_channel_canonical,
    "title_case_letters": q_title_case_letters,
    "fx_normalise": q_fx_normalise,
    "silver_clean": q_silver_clean,
    "duplicate_rows_removed": q_duplicate_rows_removed,
    "dim_date": q_dim_date,
    "dim_channel": q_dim_channel,
    "dim_campaign": q_dim_campaign,
    "fact_campaign_performance": q_fact_campaign_performance,
    "report_channel_month": q_report_channel_month,
    "mart_totals": q_mart_totals,
    "mart_channels": q_mart_channels,
    "mart_monthly": q_mart_monthly,
    "monthly_metric_series": q_monthly_metric_series,
    "channel_metric_series": q_channel_metric_series,
    "kpi_long": q_kpi_long,
    "marts_document": q_marts_document,
    "marts_extract_totals": q_marts_extract_totals,
    "marts_extract_channels": q_marts_extract_channels,
    "marts_extract_monthly": q_marts_extract_monthly,
    "quality_checks": q_quality_checks,
    "quality_checks_violations": q_quality_checks_violations,
    "quality_checks_repeats": q_quality_checks_repeats,
    "orphan_facts": q_orphan_facts,
    "silver_canonical_violations": q_silver_canonical_violations,
    "silver_duplicate_groups": q_silver_duplicate_groups,
    "silver_duplicate_groups_violations": q_silver_duplicate_groups_violations,
    "spend_reconciliation": q_spend_reconciliation,
    "mart_reconciliation": q_mart_reconciliation,
    "fact_parity_diff": q_fact_parity_diff,
    "layer_row_counts": q_layer_row_counts,
}
