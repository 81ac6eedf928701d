"""Small surface: credentials, location resolution, layer namespaces, CLI."""

import os

import pytest

from spendstar.plans.cli import build_parser, main
from spendstar.session import scratch_path, shared_root
from spendstar.sources.landing import LANDING_CONF, resolve_landing_uri
from spendstar.sources.raw_csv import load_bronze, read_raw_csv
from spendstar.sources.warehouse import Warehouse


def test_object_store_needs_credentials(spark):
    with pytest.raises(ValueError):
        read_raw_csv(spark, "abfss://landing@acct.dfs.core.windows.net/x.csv",
                     credential_conf="fs.azure.account.key.acct.dfs.core.windows.net")


def test_landing_location_resolution(spark):
    assert resolve_landing_uri(spark, "explicit://a", "default://c") == "explicit://a"
    spark.conf.set(LANDING_CONF, "conf://b")
    try:
        assert resolve_landing_uri(spark, None, "default://c") == "conf://b"
    finally:
        spark.conf.unset(LANDING_CONF)
    assert resolve_landing_uri(spark, None, "default://c") == "default://c"


def test_layer_namespaces_and_read_only_open(spark, scratch):
    wh = Warehouse(spark, scratch + "/wh")
    run_id = wh.new_run_id()
    assert wh.ensure_layers(run_id) == ["bronze", "silver", "gold"]
    for layer in ("bronze", "silver", "gold"):
        assert os.path.isdir(f"{scratch}/wh/runs/{run_id}/{layer}")
    assert wh.current_run() is None
    with pytest.raises(FileNotFoundError):
        wh.read("gold", "dim_date")
    with pytest.raises(KeyError):
        wh.table_uri(run_id, "gold", "nope")


def test_bronze_stamps_lineage(spark, scratch):
    path = f"{scratch}/raw.csv"
    with open(path, "w") as fh:
        fh.write("event_date,channel,campaign_id,campaign_name,impressions,clicks,spend,conversions,currency,extra\n")
        fh.write('2026-01-05, Email ,CMP-1000,"Name, with comma",1,1,"",1,,x\n')
    b = load_bronze(spark, path).first()
    assert b.channel == " Email " and b.campaign_name == "Name, with comma"
    assert b.spend is None and b.currency is None
    assert b._source_file == path and b._ingested_at is not None
    both = read_raw_csv(spark, path, with_file_path=True).first()
    assert both._source_file.endswith("raw.csv")


def test_scratch_under_shared_folder(spark):
    root = shared_root(spark)
    assert scratch_path(spark, "x").startswith(root + "/work/x-")


def test_cli_defaults_and_help(capsys):
    args = build_parser().parse_args(["run", "--warehouse", "w"])
    assert (args.rows, args.seed, args.source, args.landing) == (5000, 42, None, None)
    assert main([]) == 0
    assert "generate" in capsys.readouterr().out
