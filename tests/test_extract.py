"""The extract in parts: parallel lines, commit by manifest, strict reading."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from spendstar.sources import extract as X
from spendstar.sources.files import Files

AT = "2026-06-30T00:00:00Z"


def marts(spark, channels=3, months=2, spend=10.0):
    totals = spark.createDataFrame([(spend, 1.5, None, 7)], "spend_dkk double, ctr_pct double, cost_per_conversion double, conversions long")
    ch = spark.range(channels).select(
        F.lit("G").alias("channel_group"),
        F.format_string('c%07d "x", \\{}', "id").alias("channel_name"),
        (F.col("id") / 7).alias("spend_dkk"),
        F.col("id").alias("clicks"),
        F.lit(None).cast("long").alias("conversions"),
        F.lit(None).cast("double").alias("ctr_pct"),
        F.lit(1.0).alias("cost_per_conversion"),
    )
    mo = spark.range(months).select(
        F.format_string("2026-%02d", F.col("id") + 1).alias("year_month"),
        F.lit(1.0).alias("spend_dkk"),
        F.lit(2.0).alias("ctr_pct"),
        F.lit(None).cast("double").alias("cost_per_conversion"),
    )
    return totals, ch, mo


def whole(uri):
    manifest = json.load(open(f"{uri}/{X.MANIFEST}"))
    return "".join(open(f"{uri}/{manifest['version']}/{p['file']}").read() for p in manifest["parts"])


def test_many_channels_in_several_tasks(spark, scratch):
    """200,000 channels: several parts written, several tasks read, the parts are one JSON document."""
    uri = f"{scratch}/big"
    totals, ch, mo = marts(spark, 200_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        X.write_extract(spark, X.document_lines(totals, ch, mo, AT, 5), uri)
        back = X.read_extract(spark, uri)
        assert back.channels.rdd.getNumPartitions() > 2
        assert back.channels.exceptAll(ch).count() == 0 and back.channels.count() == 200_000
        assert back.monthly.exceptAll(mo).count() == 0 and back.totals.exceptAll(totals).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    manifest = json.load(open(f"{uri}/{X.MANIFEST}"))
    assert len(manifest["parts"]) > 1
    doc = json.loads(whole(uri))
    assert len(doc["channels"]) == 200_000 and doc["seed"] == 5
    names = [c["channel_name"] for c in doc["channels"]]
    assert names == sorted(names)


@pytest.mark.parametrize("sizes", [(0, 0), (1, 0), (0, 1), (4, 3)])
@pytest.mark.parametrize("single", [False, True])
def test_round_trip(spark, scratch, sizes, single):
    uri = f"{scratch}/x.json"
    totals, ch, mo = marts(spark, *sizes)
    X.write_extract(spark, X.document_lines(totals, ch, mo, AT, 5), uri, single)
    doc = json.loads(open(uri).read() if single else whole(uri))
    assert (len(doc["channels"]), len(doc["monthly"])) == sizes and doc["totals"]["cost_per_conversion"] is None
    back = X.read_extract(spark, uri)
    assert back.flattened().count() == 1 + sum(sizes)
    assert back.channels.exceptAll(ch).count() == 0 and back.monthly.exceptAll(mo).count() == 0


def test_failed_write_keeps_the_document(spark, scratch):
    for single in (False, True):
        uri = f"{scratch}/kept{single}"
        X.write_extract(spark, X.document_lines(*marts(spark), AT, 1), uri, single)
        totals, ch, mo = marts(spark, 5)
        broken = ch.withColumn("clicks", F.raise_error(F.lit("lost")).cast("long"))
        with pytest.raises(Exception, match="lost"):
            X.write_extract(spark, X.document_lines(totals, broken, mo, AT, 2), uri, single)
        back = X.read_extract(spark, uri)
        assert back.seed == 1 and back.channels.count() == 3
        assert not glob.glob(f"{uri}.parts*")
    # written but not committed: readers follow the manifest
    uri = f"{scratch}/keptFalse"
    version = json.load(open(f"{uri}/{X.MANIFEST}"))["version"]
    X.document_lines(*marts(spark, 9), AT, 3).orderBy("part", "key").select("line").write.text(f"{uri}/later")
    assert X.read_extract(spark, uri).channels.count() == 3
    # the next commit drops what no manifest names, but not the version before
    X.write_extract(spark, X.document_lines(*marts(spark, 2), AT, 4), uri)
    left = set(Files(spark).names(uri))
    assert version in left and "later" not in left and X.read_extract(spark, uri).seed == 4


def test_lost_or_changed_parts_are_noticed(spark, scratch):
    uri = f"{scratch}/lost"
    X.write_extract(spark, X.document_lines(*marts(spark), AT, 1), uri)
    part = glob.glob(f"{uri}/*/part-*")[0]
    with open(part, "a") as fh:
        fh.write("\n")
    with pytest.raises(X.ExtractError, match="manifest"):
        X.read_extract(spark, uri)


GOOD = [
    '{"generated_at": "t", "seed": 1, "totals":{"spend_dkk":1.0,"ctr_pct":null,"cost_per_conversion":null,"conversions":2}, "channels":[',
    '{"channel_group":"A","channel_name":"a","spend_dkk":1.0,"clicks":1,"conversions":1,"ctr_pct":1.0,"cost_per_conversion":1.0}',
    ',{"channel_group":"A","channel_name":"b","spend_dkk":1.0,"clicks":1,"conversions":1,"ctr_pct":1.0,"cost_per_conversion":1.0}',
    '], "monthly":[',
    '{"year_month":"2026-01","spend_dkk":1.0,"ctr_pct":1.0,"cost_per_conversion":1.0}',
    "]}",
]
FAULTS = {
    "no opening": GOOD[1:],
    "no middle": GOOD[:3] + GOOD[4:],
    "no end": GOOD[:5],
    "two ends": [*GOOD, "]}"],
    "text after": [*GOOD, "{}"],
    "missing comma": [*GOOD[:2], GOOD[2][1:], *GOOD[3:]],
    "comma first": [GOOD[0], "," + GOOD[1], *GOOD[2:]],
    "bare second": [GOOD[0], GOOD[2], GOOD[1], *GOOD[3:]],
    "cut entry": [*GOOD[:2], GOOD[2][:-9], *GOOD[3:]],
    "month among channels": [*GOOD[:2], "," + GOOD[4], *GOOD[3:]],
    "channel among months": [*GOOD[:4], GOOD[4], GOOD[2], GOOD[5]],
    "text as number": [GOOD[0].replace('"spend_dkk":1.0', '"spend_dkk":"1.0"'), *GOOD[1:]],
    "no totals": [GOOD[0].replace('"totals":{', '"sums":{'), *GOOD[1:]],
    "entry of wrong type": [*GOOD[:2], GOOD[2].replace('"clicks":1', '"clicks":"many"'), *GOOD[3:]],
}


def test_plain_lines_are_read(spark, scratch):
    path = f"{scratch}/good.json"
    with open(path, "w") as fh:
        fh.write("\n".join(GOOD))
    back = X.read_extract(spark, path)
    assert (back.channels.count(), back.monthly.count(), back.totals.first().conversions) == (2, 1, 2)


@pytest.mark.parametrize("fault", FAULTS)
def test_faulty_lines_are_refused(spark, scratch, fault):
    path = f"{scratch}/faulty.json"
    with open(path, "w") as fh:
        fh.write("\n".join(FAULTS[fault]) + "\n")
    with pytest.raises(X.ExtractError):
        X.read_extract(spark, path)


def test_other_layouts_are_read(spark, scratch):
    path = f"{scratch}/indented.json"
    with open(path, "w") as fh:
        json.dump(json.loads("\n".join(GOOD)), fh, indent=2)
    back = X.read_extract(spark, path)
    assert (back.seed, back.channels.count(), back.monthly.count()) == (1, 2, 1)
