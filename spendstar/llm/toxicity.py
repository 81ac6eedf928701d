"""Toxicity by a factorization machine over hashed terms.

1. Terms: a text's lower-cased words and, marked as such, their first letters, so that
   forms of one stem share evidence. Each term is hashed to one of ``SLOTS`` slots.
2. Fitting uses at most about ``SAMPLE`` labelled documents of each label, chosen by a hash
   of the id, and weighs them up to the numbers they stand for; equal texts count once, or
   the rare words of a text with many copies would pass for a sign. Slots are counted
   with and without the label by grouped aggregation. Features are the ``TELLING`` slots that
   speak most for the label (G statistic, at least ``LEAST_GAIN``) and the ``FREQUENT`` ones
   most frequent among toxic documents, so that terms which mean something only beside
   others are there too. A feature's value is its inverse document frequency.
3. The machine's log-odds are a constant, a weight per feature and, for each pair of
   features, the inner product of two learned vectors: a pair such as an insult and a
   mention of a group can count for more than its two terms. It is trained in numpy on the
   driver on one bit per document and feature (bounded by the sample and the features).
4. Every whole text is scored in tasks; words' features are cached per worker.

Defined cases: a NULL or empty text, or one without words, has the constant's score;
rows without an id are scored and not learned from; labels other than 0 and 1 are not
learned from, an id with both labels counts by its mean; without labels of both kinds
each text scores the base rate (0.5 without labels); repeated rows each give a row; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import prepare

SAMPLE = 10_000
SLOTS = 1 << 18
TELLING, FREQUENT = 2_048, 64
# Half of a slot's G statistic; about what six toxic documents and no other one give.
LEAST_GAIN = 6.0
FACTORS = 8
STEMS = (4, 5, 6)
BATCH = 256
STEPS, LEAST_EPOCHS = 1_500, 20
LEARNING_RATE = 0.2
RIDGE = 1e-5
SEED = 12
CACHE_LIMIT = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def slots_of_word(word: str) -> list[int]:
    """Slots of a lower-cased word and of its first letters."""
    terms = [word] + [f"{word[:k]}*" for k in STEMS if len(word) > k]
    return [zlib.crc32(t.encode("utf-8", "replace")) % SLOTS for t in terms]


@dataclass
class Model:
    """Features (their slots, ascending, and values) and the machine's parameters."""

    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Of rows of feature values."""
        pairs = (x @ self.factors) ** 2 - (x * x) @ (self.factors**2)
        return self.bias + x @ self.weights + 0.5 * pairs.sum(axis=1)

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """Probabilities for documents given by the numbers of their features."""
        sizes = np.array([len(r) for r in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        at = np.array([k for r in rows for k in r], np.int64)
        x = self.values[at]
        both = np.zeros((len(rows), 1 + 2 * FACTORS))
        vx = self.factors[at] * x[:, None]
        np.add.at(both, owner, np.concatenate([(self.weights[at] * x)[:, None], vx, vx * vx], axis=1))
        pairs = both[:, 1 : 1 + FACTORS] ** 2 - both[:, 1 + FACTORS :]
        return _sigmoid(self.bias + both[:, 0] + 0.5 * pairs.sum(axis=1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(bits: np.ndarray, values: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = SEED):
    """Bias, weights and factors from packed feature bits, by Adagrad on the weighted logistic loss."""
    n, width = len(y), len(values)
    rng = np.random.default_rng(seed)
    rate = float(np.clip((weight * y).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    bias = float(np.log(rate / (1 - rate)))
    w = np.zeros(width, np.float32)
    v = rng.normal(0, 0.05, (width, FACTORS)).astype(np.float32)
    seen = [np.float32(1e-4), np.full(width, 1e-4, np.float32), np.full((width, FACTORS), 1e-4, np.float32)]
    scale = (weight / weight.mean()).astype(np.float32)
    values = values.astype(np.float32)
    for _ in range(max(LEAST_EPOCHS, STEPS * BATCH // n)):
        order = rng.permutation(n)
        for lo in range(0, n, BATCH):
            rows = order[lo : lo + BATCH]
            x = np.unpackbits(bits[rows], axis=1, count=width) * values
            xv = x @ v
            x2 = x * x
            z = bias + x @ w + 0.5 * ((xv**2) - x2 @ (v**2)).sum(axis=1)
            off = ((_sigmoid(z) - y[rows]) * scale[rows] / len(rows)).astype(np.float32)
            grad_w = x.T @ off + RIDGE * w
            grad_v = x.T @ (xv * off[:, None]) - (x2.T @ off)[:, None] * v + RIDGE * v
            grad_b = off.sum()
            for k, g in enumerate((grad_b, grad_w, grad_v)):
                seen[k] = seen[k] + g * g
            bias -= float(LEARNING_RATE * grad_b / np.sqrt(seen[0]))
            w -= LEARNING_RATE * grad_w / np.sqrt(seen[1])
            v -= LEARNING_RATE * grad_v / np.sqrt(seen[2])
    return bias, w.astype(float), v.astype(float)


def _labelled(labels: DataFrame, column: str, learned: Column) -> DataFrame:
    """(doc_id, y): one row an id."""
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("y"))
    return rows.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & learned).groupBy("doc_id").agg(
        F.avg("y").alias("y")
    )


def fit(docs: DataFrame, labels: DataFrame, learned: Column, column: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the documents whose label may be learned (``learned``, over doc_id)."""
    spark = docs.sparkSession
    prepare(spark)
    known = _labelled(labels, column, learned)
    toxic = F.col("y") > 0.5
    sizes = {r["toxic"]: r["n"] for r in known.groupBy(toxic.alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(bias={(): 0.0, (True,): 30.0, (False,): -30.0}[tuple(sizes)])
    share = {k: min(1.0, sample / n) for k, n in sizes.items()}
    mark = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30))
    bound = F.when(toxic, int(share[True] * (1 << 30))).otherwise(int(share[False] * (1 << 30)))
    # about two times ``sample`` ids, so the texts are not shuffled
    chosen = known.where(mark < bound).withColumn("weight", F.when(toxic, 1 / share[True]).otherwise(1 / share[False]))

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(3).to_pylist():
                words = set(_WORD.findall(text.lower()))
                found.append(sorted({s for w in words for s in slots_of_word(w)}))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(4), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "y", "weight", "text_key", "slots"],
            )

    rows = (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "y", "weight", "text", F.sha2("text", 256).alias("text_key"))
        .mapInArrow(to_slots, "doc_id long, y double, weight double, text_key string, slots array<int>")
        .groupBy("text_key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.avg("y").alias("y"),
            F.max("weight").alias("weight"),
            F.any_value("slots").alias("slots"),
        )
        .select("doc_id", "y", "weight", "slots")
        .checkpoint()
    )
    # at most ``SLOTS`` rows
    counted = (
        rows.select("y", "weight", F.explode("slots").alias("slot"))
        .groupBy("slot")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("y")).alias("toxic"))
        .where("n > 1")
        .toArrow()
    )
    total = rows.agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("y")).alias("toxic")).first()
    if not total["all"]:
        return Model()
    slots, values = choose(counted, total["all"], total["toxic"])
    if not len(slots):
        rate = min(max(total["toxic"] / total["all"], 1e-6), 1 - 1e-6)
        return Model(bias=float(np.log(rate / (1 - rate))))

    def to_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for own in batch.column(3).to_pylist():
                on = np.zeros(len(slots), np.uint8)
                on[np.flatnonzero(np.isin(slots, own))] = 1
                found.append(np.packbits(on).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.binary())], names=["doc_id", "y", "weight", "bits"]
            )

    sampled = rows.mapInArrow(to_bits, "doc_id long, y double, weight double, bits binary").toArrow()
    sampled = sampled.sort_by([("doc_id", "ascending"), ("bits", "ascending")])
    bits = np.frombuffer(b"".join(sampled.column("bits").to_pylist()), np.uint8).reshape(sampled.num_rows, -1)
    bias, w, v = train(bits, values, sampled.column("y").to_numpy(), sampled.column("weight").to_numpy())
    return Model(slots, values, bias, w, v)


def choose(
    counted: pa.Table, everything: float, toxic: float, telling: int = TELLING, frequent: int = FREQUENT
) -> tuple[np.ndarray, np.ndarray]:
    """Slots (ascending) to be features, and their values."""
    counted = counted.sort_by("slot")
    slot, n, hit = (counted.column(c).to_numpy().astype(float) for c in ("slot", "all", "toxic"))
    gain = np.zeros(len(slot))
    for cell, row, column in (
        (hit, n, toxic),
        (n - hit, n, everything - toxic),
        (toxic - hit, everything - n, toxic),
        (everything - n - toxic + hit, everything - n, everything - toxic),
    ):
        # sums of weights may be off by rounding
        expected = row * column / everything
        with np.errstate(divide="ignore", invalid="ignore"):
            gain += np.where((cell > 1e-9) & (expected > 1e-9), cell * np.log(cell / expected), 0.0)
    gain[hit * everything <= n * toxic] = 0
    first = np.argsort(-gain, kind="stable")[:telling]
    first = first[gain[first] >= LEAST_GAIN]
    common = np.argsort(-hit, kind="stable")
    rest = common[~np.isin(common, first)][:frequent]
    kept = np.sort(np.concatenate([first, rest]))
    values = np.log((everything + 1) / n[kept]) / np.log(everything + 1)
    # a term that is in every document tells nothing
    return slot[kept].astype(np.int64), np.maximum(values, 0.0)


class _Features(dict):
    """Numbers of the features of a lower-cased word."""

    def __init__(self, model: Model):
        super().__init__()
        self.number = {int(s): k for k, s in enumerate(model.slots)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_LIMIT:
            self.clear()
        out = tuple(k for s in slots_of_word(word) if (k := self.number.get(s)) is not None)
        if len(word) <= 48:
            self[word] = out
        return out


def features_of(text: str, features: _Features) -> list[int]:
    found: set[int] = set()
    for own in map(features.__getitem__, set(_WORD.findall(text.lower()))):
        found.update(own)
    return sorted(found)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        features = _Features(own)
        for batch in batches:
            found = own.scores([features_of(t, features) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    ).mapInArrow(judge, "doc_id long, score double")
