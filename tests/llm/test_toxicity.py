"""The factorization machine: interactions, its closed form, held-out labels."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendstar.llm import queries, toxicity
from tests.conftest import SF001


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Model(np.arange(7), rng.random(7), 0.3, rng.normal(size=7), rng.normal(size=(7, toxicity.FACTORS)))
    rows = [[], [2], [0, 3, 6], list(range(7))]
    for row, got in zip(rows, m.scores(rows), strict=True):
        z = m.bias + sum(m.weights[k] * m.values[k] for k in row)
        z += sum(
            (m.factors[j] @ m.factors[k]) * m.values[j] * m.values[k] for j in row for k in row if j < k
        )
        assert got == pytest.approx(1 / (1 + np.exp(-z)))
        x = np.zeros((1, 7))
        x[0, row] = m.values[row]
        assert m.log_odds(x)[0] == pytest.approx(z)


def test_learns_a_pair_that_additive_weights_miss():
    """Positive exactly if both or neither of two terms occur: no sum of weights can tell."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (2_000, 10)).astype(np.uint8)
    y = (x[:, 0] == x[:, 1]).astype(float)
    bias, w, v = toxicity.train(np.packbits(x, axis=1), np.ones(10), y, np.ones(2_000))
    m = toxicity.Model(np.arange(10), np.ones(10), bias, w, v)
    assert ((m.log_odds(x.astype(float)) > 0) == (y > 0)).mean() > 0.95


def test_held_out_documents(spark):
    """Trained on two thirds of sf0.1's labels; tested on the rest."""
    sf = SF001.replace("0.001", "0.1")
    rows = queries.op12_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    tested = rows.where("held_out").join(labels.where("toxic = most"), "doc_id").collect()
    toxic = [r.predicted for r in tested if r.toxic == 1]
    clean = [r.predicted for r in tested if r.toxic == 0]
    assert sum(toxic) / len(toxic) > 0.75
    assert sum(clean) / len(clean) < 0.01


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (toxicity.fit(docs, x, ~held) for x in (labels, flipped))
    assert first.bias == second.bias and np.array_equal(first.weights, second.weights)


def test_edge_rows(spark, edge, empty, clashing):
    labels = spark.createDataFrame(
        [(2, 0), (3, 0), (4, 1), (5, 1), (6, 0), (6, 1), (None, 1), (8, None), (9, 0), (10, 7)], "doc_id long, toxic int"
    )
    model = toxicity.fit(edge, labels, F.lit(True))
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    blank = {r.doc_id: r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(set(blank.values())) == 1
    clash = toxicity.score(clashing, toxicity.fit(clashing, labels.withColumn("y", F.lit(3)), F.lit(True))).collect()
    assert sorted(map(str, clash)) == sorted(map(str, rows))
    assert toxicity.score(empty, model).count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert toxicity.score(edge, toxicity.fit(edge, few, F.lit(True))).count() == len(rows)
    assert toxicity.fit(empty, labels, F.lit(True)).bias == 0.0


def test_equal_texts_count_once(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40)] + [(i, f"word{i} x") for i in range(40, 60)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 40).cast("int").alias("toxic"))
    # one text with forty copies is no evidence for its words
    assert len(toxicity.fit(docs, labels, F.lit(True)).slots) <= toxicity.FREQUENT
    telling, _ = toxicity.choose(
        pa.table({"slot": [1, 2], "n": [9, 30], "all": [9.0, 30.0], "toxic": [9.0, 1.0]}), 100.0, 10.0, 8, 0
    )
    assert telling.tolist() == [1]
