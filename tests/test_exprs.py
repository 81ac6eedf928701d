"""Hand-made edge frames for the semantics that differ between engines."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from spendstar.functions import exprs as X
from spendstar.operators.dimensions import build_dim_campaign, build_dim_channel, build_dim_date
from spendstar.operators.silver import build_silver, typed_events

RAW = "event_date string, channel string, campaign_id string, campaign_name string, impressions string, clicks string, spend string, conversions string, currency string"


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW)


def row(**kw):
    base = dict(event_date="2026-01-05", channel="Email", campaign_id="CMP-1", campaign_name="A",
                impressions="100", clicks="10", spend="5.00", conversions="1", currency="DKK")
    base.update(kw)
    return tuple(base[c] for c in ("event_date", "channel", "campaign_id", "campaign_name", "impressions",
                                   "clicks", "spend", "conversions", "currency"))


def test_r2_matches_duckdb_round(spark):
    rnd = random.Random(3)
    vals = [rnd.uniform(0, 5000) * rnd.choice([1.0, 7.46, 0.64]) for _ in range(20000)]
    vals += [x / 1000 for x in range(0, 20000, 5)] + [0.125, 1.005, 2.675, -2.5, -0.125, 0.49999999999999994]
    vals += [-v for v in vals[:2000]]
    df = spark.createDataFrame([(v,) for v in vals], "x double").select("x", X.r2(F.col("x")).alias("r"))
    pdf = df.toPandas()
    con = duckdb.connect()
    con.register("t", pdf)
    bad = con.execute("select count(*) from t where r <> round(x, 2)").fetchone()[0]
    assert bad == 0


def test_half_cent_fx_tie(spark):
    # 0.25 EUR * 7.46 = 1.865 -> the double product decides, as in the reference
    out = typed_events(raw_df(spark, [row(spend="0.25", currency="EUR")])).first()
    assert out.spend_dkk == duckdb.connect().execute("select round(cast('0.25' as double) * 7.46, 2)").fetchone()[0]


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(5, 0, 1.0, 0)], "c long, i long, s double, v long")
    r = df.select(X.ctr_pct(F.col("c"), F.col("i")).alias("ctr"),
                  X.cost_per_conversion(F.col("s"), F.col("v")).alias("cpa")).first()
    assert r.ctr is None and r.cpa is None


def test_calendar_parts(spark):
    silver = spark.createDataFrame(
        [("2026-01-03",), ("2026-01-04",), ("2027-01-01",)], "d string"
    ).select(F.col("d").cast("date").alias("event_date"))
    got = {r.date_key: r for r in build_dim_date(silver).collect()}
    assert got[20260103].day_of_week == 6 and got[20260103].is_weekend
    assert got[20260104].day_of_week == 0 and got[20260104].is_weekend
    assert got[20270101].iso_week == 53 and got[20270101].month_name == "January"


def test_canonical_names_and_unicode_trim(spark):
    cases = [
        (" PAID  search-ads x\ty", "Paid  Search-ads X\ty"),
        (" email　", "Email"),
        (" paid social ", "Paid Social"),
        ("\tx\t", "\tx\t"),
        ("​q ", "​q"),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "c string")
    got = [r.n for r in df.select(X.canonical_name("c").alias("n")).collect()]
    assert got == [b for _, b in cases]


def test_currency_fallback_and_validity(spark):
    rows = [
        row(spend="10", currency="usd"),        # unknown -> 1.0
        row(spend="10", currency=None),         # missing -> 1.0
        row(spend="10", currency=" eur "),      # 7.46
        row(spend="0.004"),                     # rounds to 0 -> dropped
        row(clicks=None),                       # NULL measure -> dropped
        row(impressions="-1"),                  # negative -> dropped
    ]
    typed = typed_events(raw_df(spark, rows)).collect()
    assert [t.spend_dkk for t in typed[:3]] == [10.0, 10.0, 74.6]
    assert build_silver(raw_df(spark, rows)).count() == 2  # usd and NULL rows are identical


def test_cross_currency_twins_collapse(spark):
    rows = [row(spend="7.46", currency="DKK"), row(spend="1.00", currency="EUR")]
    assert build_silver(raw_df(spark, rows)).count() == 1


def test_lenient_text(spark):
    rows = [row(impressions="12.5", clicks="-2.5", conversions="1e5", event_date="2026/01/05"),
            row(event_date="2026-1-5"), row(event_date="2026-01-05 10:00:00"),
            row(event_date="\u3000 2026-01-05T10:00 "), row(event_date="\t2026-01-05\n", clicks="\t12\n")]
    t = typed_events(raw_df(spark, rows)).collect()
    assert (t[0].impressions, t[0].clicks, t[0].conversions) == (13, -3, 100000)
    assert {str(x.event_date) for x in t} == {"2026-01-05"}


@pytest.mark.parametrize(
    "bad",
    [dict(impressions="abc"), dict(event_date="2026-01"), dict(event_date="2026"),
     dict(spend="NaN"), dict(spend="1234567890123"), dict(event_date="2026-13-01"),
     dict(event_date="2026-01-05x"), dict(spend="inf"), dict(impressions="12d"), dict(impressions="12f"),
     dict(spend="0x1p3"), dict(spend="1.5F"), dict(spend="12D"), dict(event_date="2026-01-05 garbage"),
     dict(event_date="2026-01-05Tgarbage"), dict(event_date="2026-01-05 (BC)"), dict(event_date="+2026-01-05"),
     dict(event_date="2026/01-05"), dict(event_date="2026-01-05 25:00:00"), dict(event_date="2026-01-05 99:99"),
     dict(event_date="2026-01-05 10:60"), dict(event_date="2026-01-05 10:00:60"), dict(event_date="2026-01-0a"),
     dict(event_date="2026-01-05 24:30"), dict(spend="1-2"), dict(spend="\x0112"), dict(spend="12\x01"), dict(clicks="1,5"),
     dict(spend="."), dict(spend="+"), dict(clicks="1_0"), dict(event_date="2026--1-05"), dict(spend="1/2")],
)
def test_bad_text_fails_the_run(spark, bad):
    with pytest.raises(Exception):
        build_silver(raw_df(spark, [row(**bad)])).collect()


def test_two_names_one_id_and_null_keys_last(spark):
    silver = build_silver(raw_df(spark, [
        row(campaign_name="Zeta"), row(campaign_name="Alpha", clicks="11"),
        row(campaign_id=None, campaign_name="Beta", clicks="12"),
        row(channel=None, campaign_name="Beta", clicks="13"),
        row(channel="Podcast", campaign_name="Beta", clicks="14"),
    ]))
    camps = {r.campaign_id: r for r in build_dim_campaign(silver).df.collect()}
    assert camps["CMP-1"].campaign_name == "Alpha"
    assert camps[None].campaign_key == 2
    chans = {r.channel_name: r for r in build_dim_channel(silver).df.collect()}
    assert chans[None].channel_key == 3
    assert chans["Podcast"].channel_group == "Other" and chans["Email"].channel_group == "Owned"


def test_dedup_stats_counts_and_guards(spark):
    from spendstar.operators.silver import dedup_stats

    rows = [row(), row(), row(clicks="11"), row(impressions="-1")]
    r = dedup_stats(raw_df(spark, rows)).first()
    assert (r.valid_rows, r.silver_rows, r.duplicates_removed) == (3, 2, 1)
    with pytest.raises(Exception):
        dedup_stats(raw_df(spark, [row(spend="NaN")])).collect()


def test_every_letter_is_capitalised_as_the_engine_does(spark):
    """Each letter at a word's start and inside; letters newer than the engine's Unicode left out."""
    newer = {0x19B, 0x264, 0x1C89, 0x1C8A, *range(0xA7CB, 0xA7CE), *range(0xA7DA, 0xA7DD), *range(0x10D50, 0x10D86)}
    points = [k for k in range(1, 0x1E944) if not 0xD800 <= k <= 0xDFFF and k not in newer]
    texts = [f"{chr(k)}{chr(k)}a X{chr(k)} {chr(k)}" for k in points]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.canonical_name("t").alias("c")).toPandas()
    con = duckdb.connect()
    con.register("got", got)
    sql = (
        "select t, c, array_to_string(list_transform(string_split(trim(lower(t)), ' '), "
        "lambda x: upper(left(x, 1)) || substr(x, 2)), ' ') as want from got"
    )
    assert con.execute(f"select * from ({sql}) where c <> want").fetchall() == []
    assert len(got) == len(texts)


@pytest.mark.parametrize("text", ["24:00", "24:00:00", "24:00:01", "24:01", "23:59:59.9", "0:0", "7:8:9", "23:60", "99:99"])
def test_clock_ranges_equal_the_engine(spark, text):
    try:
        want = duckdb.connect().execute("select cast(? as date)", [f"2026-01-05 {text}"]).fetchone()[0]
    except duckdb.Error:
        want = None
    df = spark.createDataFrame([(f"2026-01-05 {text}",)], "t string").select(X.to_date_strict("t").alias("d"))
    if want is None:
        with pytest.raises(Exception):
            df.collect()
    else:
        assert df.first().d == want
