"""The end-to-end run: raw -> bronze -> silver -> gold -> gate -> publish.

Every layer is written to the run's own folder and read back before the next
layer is built, so each stage starts from Parquet (lineage cut, column pruning
on re-read) and a lost executor recomputes from the last written layer. The
quality gate reads the written tables; only a passed gate publishes the run.
A failed gate raises and leaves the previously published run in place.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from spendstar.operators.dimensions import build_dim_campaign, build_dim_channel, build_dim_date
from spendstar.operators.fact import aggregate_grain, build_fact
from spendstar.operators.keys import Keyed
from spendstar.operators.marts import channels_of, monthly_of, report_channel_month, rollup, totals_of
from spendstar.operators.quality import CheckResult, assert_quality, run_checks
from spendstar.operators.silver import build_silver
from spendstar.refdata import CHANNEL_GROUPS, FX_TO_DKK
from spendstar.schemas import RAW_COLUMNS
from spendstar.session import apply_runtime_conf, scratch_path
from spendstar.sources.extract import document_lines, write_extract
from spendstar.sources.files import Files
from spendstar.sources.landing import land, resolve_landing_uri
from spendstar.sources.raw_csv import check_credentials, load_bronze
from spendstar.sources.warehouse import LAYER_TABLES, STAGING, Warehouse


@dataclass
class RunSummary:
    run_id: str
    bronze: int
    silver: int
    gold: dict[str, int]
    checks: list[CheckResult] = field(default_factory=list)

    def as_dict(self) -> dict:
        return asdict(self)

    def tables(self) -> list[tuple[str, int]]:
        """(table, rows) in the order they were built."""
        layers = [("bronze", self.bronze), ("silver", self.silver)]
        return layers + [(f"gold/{name}", n) for name, n in self.gold.items()]

    def format(self) -> str:
        rows = "; ".join(f"{name}={n:,}" for name, n in self.tables())
        return f"published {self.run_id} after {len(self.checks)} passed checks: {rows}"


def run(
    spark: SparkSession,
    source_uri: str,
    warehouse_uri: str,
    *,
    run_id: str | None = None,
    landing_uri: str | None = None,
    rates: Mapping[str, float] = FX_TO_DKK,
    groups: Mapping[str, str] = CHANNEL_GROUPS,
    multiline: bool = False,
    credential_conf: str | None = None,
    publish: bool = True,
) -> RunSummary:
    """Build and publish one warehouse run from the raw CSV(s) at ``source_uri``.

    With ``landing_uri`` the raw files are first staged there and bronze reads
    the staged copy; without it the session's landing setting is asked. Deterministic
    for a given input: re-running yields the same tables, each run in its own folder.
    A ``run_id`` that has a folder already is refused, so no run is ever overwritten.
    ``multiline`` and ``credential_conf`` are options of ``read_raw_csv``.
    """
    apply_runtime_conf(spark)
    landing_uri = resolve_landing_uri(spark, landing_uri)
    for uri in (source_uri, landing_uri):
        check_credentials(spark, uri or "", credential_conf)
    wh = Warehouse(spark, warehouse_uri)
    run_id = run_id or wh.new_run_id()
    reading = {"multiline": multiline, "credential_conf": credential_conf}
    with wh.owning(run_id):
        source = land(spark, source_uri, landing_uri) if landing_uri else source_uri
        built = write_layers(wh, run_id, load_bronze(spark, source, **reading), rates, groups)
        checks = assert_quality(built.checks())
        if publish:
            wh.publish(run_id)
    counts = wh.row_counts(run_id)
    return RunSummary(
        run_id=run_id,
        bronze=counts["bronze", "campaign_events_raw"],
        silver=counts["silver", "campaign_events"],
        gold={table: counts["gold", table] for table in LAYER_TABLES["gold"]},
        checks=checks,
    )


@dataclass(frozen=True)
class Written:
    """The written tables of a run that the gate reads."""

    silver: DataFrame
    silver_rows: int
    gold: dict[str, DataFrame]

    def checks(self) -> DataFrame:
        g = self.gold
        dims = [g[name] for name in ("dim_date", "dim_channel", "dim_campaign")]
        return run_checks(self.silver, g["fact_campaign_performance"], *dims, silver_rows=self.silver_rows)


def write_layers(
    wh: Warehouse,
    run_id: str,
    raw: DataFrame,
    rates: Mapping[str, float] = FX_TO_DKK,
    groups: Mapping[str, str] = CHANNEL_GROUPS,
) -> Written:
    """Write all layers of a claimed run; ``wh.row_counts`` then has their rows, counted on the way."""
    bronze = wh.write(raw, run_id, "bronze", "campaign_events_raw")
    silver = wh.write(build_silver(bronze.select(*RAW_COLUMNS), rates), run_id, "silver", "campaign_events")

    # the grain aggregate (one scan of silver) feeds every gold table
    staging = f"{wh.run_uri(run_id)}/{STAGING}"
    grain_uri = f"{staging}/grain"
    aggregate_grain(silver).write.mode("overwrite").parquet(grain_uri)
    grain = wh.spark.read.parquet(grain_uri)

    # dimensions first; the fact joins the written keys. The three dimension
    # writes are independent jobs, submitted together so the scheduler overlaps them.
    ch = build_dim_channel(grain, groups, f"{staging}/channel_keys")
    cp = build_dim_campaign(grain, f"{staging}/campaign_keys")
    with ThreadPoolExecutor(max_workers=3) as pool:
        f_date = pool.submit(wh.write, build_dim_date(grain), run_id, "gold", "dim_date")
        f_ch = pool.submit(wh.write, ch.df, run_id, "gold", "dim_channel")
        f_cp = pool.submit(wh.write, cp.df, run_id, "gold", "dim_campaign")
        dim_date = f_date.result()
        dim_channel = Keyed(f_ch.result(), ch.rows)
        dim_campaign = Keyed(f_cp.result(), cp.rows)
    fact = wh.write(build_fact(grain, dim_channel, dim_campaign), run_id, "gold", "fact_campaign_performance")
    rows = wh.row_counts(run_id)["silver", "campaign_events"]
    tables = (dim_date, dim_channel.df, dim_campaign.df, fact)
    return Written(silver, rows, dict(zip(LAYER_TABLES["gold"], tables, strict=True)))


def published_gold(spark: SparkSession, warehouse_uri: str) -> dict[str, DataFrame]:
    """The gold tables of the newest published run, opened read-only."""
    wh = Warehouse(spark, warehouse_uri)
    names = ("dim_date", "dim_channel", "dim_campaign", "fact_campaign_performance")
    return {n: wh.read("gold", n) for n in names}


def report(spark: SparkSession, warehouse_uri: str) -> DataFrame:
    """The channel x month report over the published run."""
    g = published_gold(spark, warehouse_uri)
    return report_channel_month(g["fact_campaign_performance"], g["dim_channel"], g["dim_date"])


def write_report_csv(report_df: DataFrame, uri: str) -> str:
    """Write the report as CSV with a header (NULL as an empty cell), from the executors."""
    report_df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(uri)
    return uri


def format_report(report_df: DataFrame) -> Iterator[str]:
    """Lines of tab-separated text under the report's own column names, one partition at a time."""
    yield "\t".join(report_df.columns)
    for row in report_df.toLocalIterator():
        yield "\t".join("-" if v is None else str(v) for v in row)


@contextmanager
def _marts(spark: SparkSession, warehouse_uri: str) -> Iterator[tuple[DataFrame, DataFrame, DataFrame]]:
    """Totals, channels and months of the published run, from one scan of its fact."""
    g = published_gold(spark, warehouse_uri)
    uri = scratch_path(spark, "rollup")
    try:
        rollup(g["fact_campaign_performance"], g["dim_channel"], g["dim_date"]).write.parquet(uri)
        sums = spark.read.parquet(uri)
        yield totals_of(sums), channels_of(sums), monthly_of(sums)
    finally:
        Files(spark).remove(uri)


def build_marts(spark: SparkSession, warehouse_uri: str, generated_at: str, seed: int) -> dict:
    """The extract of the published run as a dict (nothing written).

    For callers in Python: the dict has an entry per channel and per month.
    :func:`export` writes the same document without holding it.
    """
    with _marts(spark, warehouse_uri) as (totals, channels, monthly):
        return {
            "generated_at": generated_at,
            "seed": int(seed),
            "totals": totals.first().asDict(),
            "channels": [r.asDict() for r in channels.toLocalIterator()],
            "monthly": [r.asDict() for r in monthly.toLocalIterator()],
        }


def export(
    spark: SparkSession, warehouse_uri: str, out_uri: str, generated_at: str, seed: int, *, single_file: bool = False
) -> str:
    """Write the extract of the published run to ``out_uri``; return that place.

    In parts with a manifest, or as one plain file that other programs can read.
    """
    with _marts(spark, warehouse_uri) as marts:
        return write_extract(spark, document_lines(*marts, generated_at, seed), out_uri, single_file)
