"""Layer sizes on the driver's sf0.001 tables, gold invariants, quality gate."""

import pytest

from spendstar.operators import quality as Q
from spendstar.operators import reconcile as R
from spendstar.plans.queries import Build, _fact_with_orphan

from .conftest import SF001


@pytest.fixture(scope="module")
def build(spark):
    return Build(spark, SF001)


def test_layer_sizes(build):
    # expected sizes computed independently with the source system's SQL semantics
    assert build.raw.count() == 6057
    assert build.silver_table.count() == 5874
    assert build.gold.fact.count() == 5222
    assert build.gold.dim_date.count() == 2274
    assert (build.gold.dim_channel.rows, build.gold.dim_campaign.rows) == (6, 10)


def test_spend_reconciles(build):
    r = R.spend_reconciliation(build.silver_table, build.gold.fact).first()
    assert r.matches and str(r.fact_spend_dkk) == "685438479.23"


def test_checks_pass_and_orphan_fails(build):
    g = build.gold
    results = Q.assert_quality(Q.run_checks(build.silver_table, g.fact, g.dim_date, g.dim_channel.df, g.dim_campaign.df))
    assert len(results) == 8 and all(r.passed for r in results)
    bad = Q.run_checks(build.silver_table, _fact_with_orphan(build), g.dim_date, g.dim_channel.df, g.dim_campaign.df)
    failed = [r for r in Q.collect_checks(bad) if not r.passed]
    assert [(r.name, r.offending_rows) for r in failed] == [("fact_refs_resolve", 1)]
    with pytest.raises(Q.DataQualityError):
        Q.assert_quality(bad)


def test_grain_unique_and_parity(build):
    from spendstar.operators.fact import natural_fact, silver_sums

    g = build.gold
    assert g.fact.groupBy("date_key", "channel_key", "campaign_key").count().filter("count > 1").count() == 0
    resolved = natural_fact(g.fact, g.dim_channel.df, g.dim_campaign.df)
    diff = R.set_diff_summary(R.in_cents(resolved), R.in_cents(silver_sums(build.silver_table)), "a", "b").first()
    assert diff.only_a == 0 and diff.only_b == 0 and diff.a_rows == diff.b_rows


def test_canonical_and_no_duplicates(build):
    v = R.silver_canonical_violations(build.silver_table).first()
    assert (v.untidy_channel_rows, v.invalid_measure_rows) == (0, 0)
    assert R.silver_duplicate_groups(build.silver_table).count() == 0


def test_set_diff_summary_has_multiset_semantics(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, None)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), (None, None), ("c", 3)], "k string, v int")
    r = R.set_diff_summary(left, right, "l", "r").first()
    assert (r.l_rows, r.r_rows) == (4, 5)
    assert r.only_l == left.exceptAll(right).count() == 1
    assert r.only_r == right.exceptAll(left).count() == 2


def test_null_channel_passes_checks_but_not_reconciliation(spark):
    # a NULL channel gets a dimension row; its facts drop at the inner join, none of
    # the eight checks notices, and the spend reconciliation does
    from spendstar.operators.gold import build_gold
    from spendstar.operators.silver import build_silver

    raw = spark.createDataFrame(
        [("2026-01-05", None, "CMP-1", "A", "10", "1", "5.00", "1", "DKK"),
         ("2026-01-05", "Email", "CMP-1", "A", "10", "1", "7.00", "1", "DKK")],
        "event_date string, channel string, campaign_id string, campaign_name string, impressions string, "
        "clicks string, spend string, conversions string, currency string",
    )
    silver = build_silver(raw)
    g = build_gold(silver)
    assert g.dim_channel.rows == 2 and g.fact.count() == 1
    results = Q.assert_quality(Q.run_checks(silver, g.fact, g.dim_date, g.dim_channel.df, g.dim_campaign.df))
    assert all(r.passed for r in results)
    rec = R.spend_reconciliation(silver, g.fact).first()
    assert not rec.matches and str(rec.difference) == "-5.00"


def test_a_folder_that_grows_is_seen(spark, scratch):
    spark.read.parquet(f"{SF001}/lineitem.parquet").limit(100).write.parquet(f"{scratch}/lineitem.parquet")
    before = Build(spark, scratch).raw.count()
    spark.read.parquet(f"{SF001}/lineitem.parquet").limit(500).write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    assert Build(spark, scratch).raw.count() > 5 * before


def test_a_grain_may_hold_more_than_a_single_event(spark):
    from spendstar.operators.gold import build_gold
    from spendstar.operators.silver import build_silver

    raw = spark.createDataFrame(
        [("2026-01-05", "Email", "CMP-1", "A", str(n), "1", "600000000000.00", "1", "DKK") for n in (10, 11)],
        "event_date string, channel string, campaign_id string, campaign_name string, impressions string, "
        "clicks string, spend string, conversions string, currency string",
    )
    silver = build_silver(raw)
    fact = build_gold(silver).fact
    assert str(fact.first().spend_dkk) == "1200000000000.00"
    assert R.spend_reconciliation(silver, fact).first().matches
