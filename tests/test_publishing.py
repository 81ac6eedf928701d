"""Ownership, publication order and sweeps of a warehouse."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from spendstar.operators.quality import DataQualityError
from spendstar.plans import pipeline as P
from spendstar.sources import generator as G
from spendstar.sources.warehouse import Warehouse


def together(n, work):
    """Run ``work(k)`` in n threads at once; what each returned or raised."""
    out, gate = [None] * n, threading.Barrier(n)

    def one(k):
        gate.wait()
        try:
            out[k] = work(k)
        except Exception as e:  # noqa: BLE001
            out[k] = e

    threads = [threading.Thread(target=one, args=(k,)) for k in range(n)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return out


def test_publishers_get_one_order(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    ids = [f"run_{k}" for k in range(8)]
    for run_id in ids:
        wh.claim(run_id)
    together(8, lambda k: Warehouse(spark, f"{scratch}/wh").publish(ids[k]))
    published = wh.published_runs()
    assert sorted(published) == ids and wh.current_run() == published[-1]
    numbers = sorted(n for n in os.listdir(f"{scratch}/wh/_published") if n.isdigit())
    assert [int(n) for n in numbers] == list(range(1, 9))
    # a number whose publisher died is passed over
    assert wh.files.create_new(f"{scratch}/wh/_published/{9:020d}")
    assert wh.current_run() == published[-1]
    wh.claim("later")
    wh.publish("later")
    assert wh.current_run() == "later"


def test_one_of_several_claims_succeeds(spark, scratch):
    done = together(6, lambda k: Warehouse(spark, f"{scratch}/wh").claim("same"))
    assert sum(isinstance(d, FileExistsError) for d in done) == 5 and done.count(None) == 1


def test_failed_runs_are_swept_and_living_ones_stay(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    src = G.write_events(spark, 300, 7, f"{scratch}/raw")
    good = P.run(spark, src, wh.root)
    bad = f"{scratch}/bad"
    G.generate_events(spark, 50, 3).withColumn("spend", F.lit("0")).write.option("header", True).csv(bad)
    with pytest.raises(DataQualityError):
        P.run(spark, bad, wh.root, run_id="failed")
    assert not os.path.exists(f"{wh.root}/runs/failed/_staging")
    wh.claim("alive")
    assert wh.sweep() == ["failed"]
    assert sorted(os.listdir(f"{wh.root}/runs")) == sorted(["alive", good.run_id])
    # nobody renewed it
    assert wh.sweep(seconds=0) == ["alive"]
    with pytest.raises(FileNotFoundError):
        wh.publish("alive")
    assert wh.read("gold", "dim_date").count() > 0
    P.run(spark, src, wh.root, run_id="newer")
    assert wh.sweep(keep_published=1) == [good.run_id] and wh.current_run() == "newer"


def test_a_lease_is_kept_while_the_run_works(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    with wh.owning("long", seconds=0.3):
        first = wh.files.read_small(f"{wh.root}/runs/long/_lease")
        threading.Event().wait(1.0)
        assert wh.files.read_small(f"{wh.root}/runs/long/_lease") != first
        assert wh.sweep(seconds=0.9) == []


def test_a_run_counts_nothing_twice(spark, scratch):
    src = G.write_events(spark, 400, 5, f"{scratch}/raw")
    wh = Warehouse(spark, f"{scratch}/wh")
    done = P.run(spark, src, wh.root)
    assert done.bronze == wh.read("bronze", "campaign_events_raw").count() == 404
    assert done.silver == wh.read("silver", "campaign_events").count()
    assert done.gold == {t: wh.read("gold", t).count() for t in done.gold}


def test_silver_check_by_known_rows(spark, scratch):
    src = G.write_events(spark, 100, 5, f"{scratch}/raw")
    wh = Warehouse(spark, f"{scratch}/wh")
    wh.claim("r")
    built = P.write_layers(wh, "r", P.load_bronze(spark, src))
    assert all(r.passed for r in built.checks().collect())
    none = P.Written(built.silver, 0, built.gold).checks().where("name = 'silver_not_empty'").first()
    assert (none.passed, none.offending_rows) == (False, 1)
