"""Warehouse layout: one Parquet table per layer table, per run, then publish.

    <root>/runs/<run_id>/<layer>/<table>/   Parquet, written with overwrite
    <root>/runs/<run_id>/_lease             created by the one owner, renewed while it works
    <root>/_published/<number>              taken by one publisher
    <root>/_published/<number>_<run_id>     empty marker, created after the gate

A run writes every layer into its own folder; the quality gate reads those
tables; only a passed gate creates the marker. Markers are numbered: each publisher
creates the number after the last one, exclusively, and tries the next if another came
first, so publications have one order whatever clocks and run ids say. Readers open the
run of the highest number, so a failed run never replaces the last good one. Reading a
layer back after writing it also cuts the lineage: a lost executor recomputes from
Parquet, not from the raw file.

``sweep`` removes what failed runs left: folders that were never published and whose
lease their owner gave back or no longer renews.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendstar import schemas
from spendstar.sources.files import Files

# A lease holds this long after its last renewal.
LEASE_SECONDS = 600
LEASE = "_lease"
STAGING = "_staging"

LAYER_TABLES: dict[str, tuple[str, ...]] = {
    "bronze": ("campaign_events_raw",),
    "silver": ("campaign_events",),
    "gold": ("dim_date", "dim_channel", "dim_campaign", "fact_campaign_performance"),
}

TABLE_SCHEMAS: dict[tuple[str, str], StructType] = {
    ("bronze", "campaign_events_raw"): schemas.BRONZE_SCHEMA,
    ("silver", "campaign_events"): schemas.SILVER_SCHEMA,
    ("gold", "dim_date"): schemas.DIM_DATE_SCHEMA,
    ("gold", "dim_channel"): schemas.DIM_CHANNEL_SCHEMA,
    ("gold", "dim_campaign"): schemas.DIM_CAMPAIGN_SCHEMA,
    ("gold", "fact_campaign_performance"): schemas.FACT_SCHEMA,
}


class Warehouse:
    """Layer tables under one root URI (local path, HDFS, S3A, ABFS...)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        # rows of the tables that this object wrote, counted while they were written
        self.rows: dict[tuple[str, str, str], int] = {}

    # -- layout -----------------------------------------------------------------
    @staticmethod
    def new_run_id() -> str:
        return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]

    def table_uri(self, run_id: str, layer: str, table: str) -> str:
        if table not in LAYER_TABLES.get(layer, ()):
            raise KeyError(f"unknown table {layer}.{table}")
        return f"{self.root}/runs/{run_id}/{layer}/{table}"

    def run_uri(self, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}"

    def ensure_layers(self, run_id: str) -> list[str]:
        """Create the three layer namespaces of a run (idempotent)."""
        for layer in LAYER_TABLES:
            self.files.make(f"{self.run_uri(run_id)}/{layer}")
        return list(LAYER_TABLES)

    # -- ownership ----------------------------------------------------------------
    def claim(self, run_id: str) -> None:
        """Take a run id for a new attempt; of several attempts with one id exactly one gets it."""
        if not self.files.create_new(f"{self.run_uri(run_id)}/{LEASE}"):
            raise FileExistsError(f"run {run_id} exists under {self.root}; every attempt needs its own id")
        self.ensure_layers(run_id)

    def renew(self, run_id: str) -> None:
        """Tell sweepers that the run is alive."""
        self.files.replace(f"{self.run_uri(run_id)}/{LEASE}", uuid.uuid4().hex)

    @contextmanager
    def owning(self, run_id: str, seconds: float = LEASE_SECONDS) -> Iterator[str]:
        """Claim a run and keep its lease while the block works; its staging is removed in any case.

        If the block fails, the lease is given back: the next sweep removes the run.
        """
        self.claim(run_id)
        done = threading.Event()

        def keep() -> None:
            while not done.wait(seconds / 3):
                self.renew(run_id)

        keeper = threading.Thread(target=keep, daemon=True)
        keeper.start()
        try:
            yield run_id
        except BaseException:
            done.set()
            keeper.join()
            self.files.remove(f"{self.run_uri(run_id)}/{LEASE}")
            raise
        finally:
            done.set()
            keeper.join()
            self.files.remove(f"{self.run_uri(run_id)}/{STAGING}")

    def sweep(self, seconds: float = LEASE_SECONDS, keep_published: int | None = None) -> list[str]:
        """Remove runs that were never published and have no living owner; return their ids.

        With ``keep_published`` published runs but the last so many go too. Times are
        those of the file system, not of this machine.
        """
        if not self.files.exists(f"{self.root}/runs"):
            return []
        probe = f"{self.root}/_probe-{uuid.uuid4().hex}"
        self.files.create_new(probe)
        now = self.files.time(probe)
        self.files.remove(probe)
        removed = []
        published = self.published_runs()
        old = published[:-keep_published] if keep_published else []
        for run_id in self.files.names(f"{self.root}/runs"):
            lease = f"{self.run_uri(run_id)}/{LEASE}"
            if run_id in old:
                pass
            elif run_id in published:
                continue
            elif self.files.exists(lease) and now - self.files.time(lease) < 1000 * seconds:
                continue
            elif run_id in self.published_runs():  # published since they were listed
                continue
            self.files.remove(self.run_uri(run_id))
            removed.append(run_id)
        return removed

    # -- write / read -----------------------------------------------------------
    def write(self, df: DataFrame, run_id: str, layer: str, table: str) -> DataFrame:
        """Write a table of a claimed run and return it read back; its rows are counted on the way."""
        seen = Observation(f"{layer}.{table}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").parquet(self.table_uri(run_id, layer, table))
        self.rows[run_id, layer, table] = int(seen.get["rows"])
        return self.read(layer, table, run_id=run_id)

    def row_counts(self, run_id: str) -> dict[tuple[str, str], int]:
        """(layer, table) -> rows, of the tables that were written through this object."""
        return {(layer, table): n for (run, layer, table), n in self.rows.items() if run == run_id}

    def read(self, layer: str, table: str, run_id: str | None = None) -> DataFrame:
        """Open a table of a run (default: the newest published run) read-only."""
        run_id = run_id or self.current_run()
        if run_id is None:
            raise FileNotFoundError(f"no published run under {self.root}")
        schema = TABLE_SCHEMAS[(layer, table)]
        df = self.spark.read.schema(schema).parquet(self.table_uri(run_id, layer, table))
        return df.select(*schema.fieldNames())

    # -- publish ----------------------------------------------------------------
    def _published_names(self) -> list[str]:
        folder = f"{self.root}/_published"
        names = self.files.names(folder) if self.files.exists(folder) else []
        return sorted((n for n in names if n[0].isdigit()), key=lambda n: int(n.split("_", 1)[0]))

    def publish(self, run_id: str) -> str:
        """Mark a run as published (call only after the quality gate passed)."""
        if not self.files.exists(self.run_uri(run_id)):
            raise FileNotFoundError(f"run {run_id} is gone: its lease ran out and it was swept")
        while True:
            names = self._published_names()
            number = int(names[-1].split("_", 1)[0]) + 1 if names else 1
            place = f"{self.root}/_published/{number:020d}"
            # a number that was taken and not used (its publisher died) is passed over
            if self.files.create_new(place):
                self.files.make(f"{place}_{run_id}")
                return run_id

    def published_runs(self) -> list[str]:
        """Run ids in the order of their publication."""
        return [n.split("_", 1)[1] for n in self._published_names() if "_" in n]

    def current_run(self) -> str | None:
        runs = self.published_runs()
        return runs[-1] if runs else None
