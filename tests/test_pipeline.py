"""End-to-end runs: generate -> run -> gate -> publish; report; export; landing."""

import json

import pytest
from pyspark.sql import functions as F

from spendstar.operators.quality import DataQualityError
from spendstar.plans import pipeline as P
from spendstar.sources import generator as G
from spendstar.sources.extract import ExtractError, read_extract
from spendstar.sources.landing import land
from spendstar.sources.raw_csv import read_raw_csv
from spendstar.sources.warehouse import Warehouse


def test_generator_is_deterministic_with_duplicates(spark):
    a = G.generate_events(spark, 500, seed=1)
    b = G.generate_events(spark, 500, seed=1, num_partitions=7)
    assert a.count() == 505
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ids = {r.campaign_id for r in a.select("campaign_id").distinct().collect()}
    assert ids <= {f"CMP-{1000 + i}" for i in range(10)}
    assert a.groupBy(*a.columns).count().filter("count > 1").count() >= 1


def test_run_is_idempotent_and_published(spark, scratch):
    src = G.write_events(spark, 800, 21, f"{scratch}/raw")
    wh = f"{scratch}/wh"
    first = P.run(spark, src, wh)
    second = P.run(spark, src, wh)
    assert first.bronze == 808 and first.silver > 0
    assert first.gold == second.gold and first.gold["fact_campaign_performance"] > 0
    assert Warehouse(spark, wh).current_run() == second.run_id
    assert first.run_id in first.format() and "8 passed checks" in first.format()
    assert not (tmp := __import__("pathlib").Path(wh)).joinpath("runs", first.run_id, "_staging").exists() and tmp.exists()


def test_failed_gate_keeps_last_good_run(spark, scratch):
    src = G.write_events(spark, 300, 7, f"{scratch}/raw")
    wh = f"{scratch}/wh"
    good = P.run(spark, src, wh)
    # zero spend everywhere: every row is invalid, silver and fact are empty
    bad_src = f"{scratch}/bad"
    G.generate_events(spark, 50, 3).withColumn("spend", F.lit("0")).write.option("header", True).csv(bad_src)
    with pytest.raises(DataQualityError):
        P.run(spark, bad_src, wh)
    assert Warehouse(spark, wh).current_run() == good.run_id


def test_report_and_export(spark, scratch):
    src = G.write_events(spark, 900, 31, f"{scratch}/raw")
    wh = f"{scratch}/wh"
    P.run(spark, src, wh)
    rows = [tuple(r) for r in P.report(spark, wh).collect()]
    assert rows and rows == sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3]))
    text = list(P.format_report(P.report(spark, wh)))
    assert text[0].split("\t")[0] == "channel_group" and len(text) == len(rows) + 1
    csv_uri = P.write_report_csv(P.report(spark, wh), f"{scratch}/report_csv")
    back = spark.read.option("header", True).csv(csv_uri)
    assert back.count() == len(rows) and back.columns[:2] == ["channel_group", "channel_name"]
    out = f"{scratch}/out/marts.json"
    assert P.export(spark, wh, out, "2026-06-30T00:00:00Z", seed=31, single_file=True) == out
    doc = json.loads(open(out).read())
    assert P.build_marts(spark, wh, "2026-06-30T00:00:00Z", seed=31) == doc
    assert set(doc) == {"generated_at", "seed", "totals", "channels", "monthly"}
    assert doc["seed"] == 31 and len(doc["channels"]) == 6
    assert round(sum(c["spend_dkk"] for c in doc["channels"]), 2) == doc["totals"]["spend_dkk"]
    months = [m["year_month"] for m in doc["monthly"]]
    assert months == sorted(months) and months
    assert isinstance(doc["totals"]["conversions"], int)
    P.export(spark, wh, f"{scratch}/out/parts", "2026-06-30T00:00:00Z", seed=31)
    for place in (out, f"{scratch}/out/parts"):
        back = read_extract(spark, place)
        assert (back.generated_at, back.seed) == ("2026-06-30T00:00:00Z", 31)
        assert [r.asDict() for r in back.channels.collect()] == doc["channels"]
        assert [r.asDict() for r in back.monthly.collect()] == doc["monthly"]
        assert back.totals.first().asDict() == doc["totals"]


def test_extract_validator_rejects_bad_shape(spark, scratch):
    path = f"{scratch}/bad.json"
    with open(path, "w") as fh:
        fh.write('{"totals": {}}')
    with pytest.raises(ExtractError):
        read_extract(spark, path)


def test_landing_route_equals_disk_route(spark, scratch):
    raw = G.generate_events(spark, 300, 7).withColumn(
        "currency", F.when(F.col("currency") == "EUR", F.lit(" eur ")).otherwise(F.col("currency"))
    )
    disk = f"{scratch}/disk"
    from spendstar.sources.landing import write_raw_csv

    write_raw_csv(raw, disk)
    landed = land(spark, disk, f"{scratch}/landing")
    a, b = read_raw_csv(spark, disk), read_raw_csv(spark, landed)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter(F.col("currency") == " eur ").count() > 0
    wa = P.run(spark, disk, f"{scratch}/wa")
    wb = P.run(spark, disk, f"{scratch}/wb", landing_uri=f"{scratch}/landing2")
    assert (wa.bronze, wa.silver, wa.gold) == (wb.bronze, wb.silver, wb.gold)


def test_ragged_csv_fails(spark, scratch):
    path = f"{scratch}/ragged.csv"
    header = "event_date,channel,campaign_id,campaign_name,impressions,clicks,spend,conversions,currency"
    with open(path, "w") as fh:
        fh.write(header + "\n2026-01-05,Email,CMP-1,A,1,1,1.00,1,DKK\n2026-01-05,Email,CMP-1\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path).collect()
    with pytest.raises(Exception):
        read_raw_csv(spark, path).select("channel").count()


def test_a_used_run_id_is_refused_and_stays_published(spark, scratch):
    src = G.write_events(spark, 300, 11, f"{scratch}/raw")
    wh = f"{scratch}/wh"
    P.run(spark, src, wh, run_id="a")
    bad = f"{scratch}/bad"
    G.generate_events(spark, 50, 3).withColumn("spend", F.lit("0")).write.option("header", True).csv(bad)
    with pytest.raises(FileExistsError):
        P.run(spark, bad, wh, run_id="a")
    assert Warehouse(spark, wh).current_run() == "a"
    assert Warehouse(spark, wh).read("gold", "fact_campaign_performance").count() > 0


def test_landing_refuses_its_source_and_keeps_all_columns(spark, scratch):
    raw = G.generate_events(spark, 50, 7).withColumn("region", F.lit("north"))
    from spendstar.sources.landing import write_raw_csv

    src = write_raw_csv(raw, f"{scratch}/src")
    for place in (src, f"{src}/below", scratch):
        with pytest.raises(ValueError):
            land(spark, src, place)
    assert spark.read.option("header", True).csv(src).count() == raw.count()
    landed = land(spark, src, f"{scratch}/landed")
    assert spark.read.option("header", True).csv(landed).filter("region = 'north'").count() == raw.count()


def test_cells_with_line_breaks_through_the_run(spark, scratch):
    path = f"{scratch}/multi.csv"
    header = "event_date,channel,campaign_id,campaign_name,impressions,clicks,spend,conversions,currency"
    with open(path, "w") as fh:
        fh.write(header + '\n2026-01-05,Email,CMP-1,"two\nlines",1,1,1.00,1,DKK\n')
    done = P.run(spark, path, f"{scratch}/wm", multiline=True, landing_uri=f"{scratch}/landm")
    assert open(f"{scratch}/landm/multi.csv", "rb").read() == open(path, "rb").read()
    assert (done.bronze, done.silver) == (1, 1)


@pytest.mark.parametrize("text", ['[{"totals": {"spend_dkk": 1.0}, "channels": [], "monthly": []}]',
                                  '{"totals": {"spend_dkk": "NaN"}, "channels": [], "monthly": []}',
                                  '{"totals": {"spend_dkk": 1.0}, "channels": [], "monthly": []} {}'])
def test_extract_validator_is_strict(spark, scratch, text):
    path = f"{scratch}/x.json"
    with open(path, "w") as fh:
        fh.write(text)
    with pytest.raises(ExtractError):
        read_extract(spark, path)


def test_generator_distributions(spark):
    ev = G.generate_events(spark, 20_000, seed=5).select(
        F.col("event_date").cast("date").alias("d"),
        F.col("impressions").cast("long").alias("i"),
        F.col("clicks").cast("long").alias("c"),
        F.col("conversions").cast("long").alias("v"),
        F.col("spend").cast("double").alias("s"),
        "currency",
        "channel",
    )
    r = ev.agg(
        F.min("d"), F.max("d"), F.min("i"), F.max("i"),
        F.max(F.col("c") / F.col("i")), F.min(F.col("c") / F.col("i")),
        F.max(F.col("v") / F.greatest(F.col("c"), F.lit(1))),
        F.max(F.col("s") / F.greatest(F.col("c"), F.lit(1))),
    ).first()
    assert str(r[0]) == "2026-01-01" and str(r[1]) == "2026-04-30"
    assert 500 <= r[2] and r[3] <= 50_000
    assert r[4] <= 0.06 and r[5] >= 0.005 - 1 / 500 and r[6] <= 0.12 and r[7] <= 9.0
    cur = {x["currency"]: x["count"] for x in ev.groupBy("currency").count().collect()}
    assert set(cur) == {"DKK", "EUR", "SEK"} and cur["DKK"] > 2 * cur["EUR"]
    assert ev.filter(F.col("channel").startswith(" ")).count() > 0
    assert ev.filter(F.col("channel") == F.upper("channel")).count() > 0
