"""Quality classifier with hierarchical empirical Bayes over sites.

1. Evidence: a logistic regression over shape features of the whole text (shares
   of character classes, word and line statistics) gives each document a
   probability of good quality. It is fitted on the driver on a sample of at most
   about ``SAMPLE`` labelled documents (a parameter; chosen by a hash of the id).
2. Sites: the probabilities of all documents are summed per host and path, with
   grouped aggregation (partial sums, so a hot host is no hot task). Rates are
   shrunk twice: a host's rate toward the global one, a path's rate toward its
   host's. How strongly is estimated from the data: the moment estimate of the
   variance between sites gives the weight of the prior in documents, so sparse
   sites follow their parent and large ones their own documents.
3. Posterior: log-odds of the path's rate plus the document's log-likelihood
   ratio. Documents below ``THRESHOLD`` are rejected.

In ``documents`` the host is ``source`` and the path below it ``lang``.

Defined cases: a NULL text counts as empty; NULL hosts and paths are sites of
their own; labels that are NULL are not learned from; without labels of both
kinds the evidence is neutral and every document is kept; repeated rows each
count; an empty table gives no rows; other columns are kept or ignored, whatever
their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import prepare

SAMPLE = 20_000
RIDGE = 1.0
THRESHOLD = 0.5
# Bounds of a prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 10_000.0
# Sites up to which their rates are sent to all workers (some 100 bytes each); more are joined.
SITES_HELD = 200_000

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": b" \t",
    "break": b"\n\r",
    "stop": b".,;:",
    "shout": b"!?",
    "symbol": b"#$%&*@^~_=+<>\\`",
    "bar": b"|",
    "bracket": b"()[]{}/\"'-",
    "other": range(128, 256),
}
_OF_BYTE = np.zeros((256, len(_CLASSES)))
for _k, _members in enumerate(_CLASSES.values()):
    _OF_BYTE[list(_members), _k] = 1


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text."""
    data = (text or "").encode("utf-8", "replace")
    n = max(1, len(data))
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _OF_BYTE / n
    words = data.split()
    lines = data.split(b"\n")
    w, k = max(1, len(words)), len(lines)
    rest = [
        math.log1p(len(data)) / 10,
        len(data) / w / 10,
        len(set(words)) / w,
        len(set(lines)) / k,
        math.log1p(n / k) / 10,
        sum(x.endswith(b".") for x in lines) / k,
    ]
    return np.concatenate([shares, rest])


WIDTH = len(_CLASSES) + 6


@dataclass
class Model:
    """Logistic regression over standardised features and their squares."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(2 * WIDTH))
    scale: np.ndarray = field(default_factory=lambda: np.ones(2 * WIDTH))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 * WIDTH + 1))
    base_rate: float = 0.5

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (np.concatenate([x, x * x], axis=1) - self.mean) / self.scale
        z = np.clip(z, -8, 8) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Ridge-penalised maximum likelihood by Newton steps; neutral without both labels."""
    if len(y) == 0 or y.min() == y.max():
        return Model()
    full = np.concatenate([x, x * x], axis=1)
    mean, scale = full.mean(0), full.std(0) + 1e-6
    z = np.concatenate([np.ones((len(y), 1)), np.clip((full - mean) / scale, -8, 8)], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), RIDGE)
    penalty[0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - penalty * w
        hess = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 3 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w, float(y.mean()))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents; ``labels`` has doc_id and quality (0 or 1)."""
    prepare(docs.sparkSession)
    good = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        "quality in (0, 1) and doc_id is not null"
    )
    # one label an id; contradicting labels count by their mean
    good = good.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    total = good.count()
    if not total:
        return Model()
    share = min(1.0, sample / total)
    chosen = good.where(
        F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < int(share * (1 << 30))
    )

    @F.pandas_udf("array<double>")
    def shape(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tolist() for t in texts])

    rows = (
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
        .join(chosen, "doc_id")
        .select("doc_id", shape("text").alias("x"), "quality")
        .limit(2 * sample)
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, WIDTH)
    return train(x, np.array([r["quality"] for r in rows], dtype=float))


def evidence(model: Model, text: Column) -> Column:
    """The classifier's probability of good quality for a text column."""

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.probabilities(np.stack([features(t) for t in texts])))

    return judge(text)


def prior_weight(sites: DataFrame, n: str, total: str, mean: Column) -> float:
    """Weight in documents of the prior of ``sites`` (n documents with sum ``total``; prior mean)."""
    rate = F.col(total) / F.col(n)
    row = sites.agg(
        F.sum(F.col(n) * F.pow(rate - mean, 2)).alias("between"),
        F.sum(mean * (1 - mean)).alias("noise"),
        F.sum(F.col(n) * mean * (1 - mean)).alias("spread"),
        F.sum(F.col(n)).alias("n"),
    ).first()
    if not row["n"]:
        return LEAST_WEIGHT
    variance = (row["between"] - row["noise"]) / row["n"]
    inner = row["spread"] / row["n"]
    if variance <= inner / MOST_WEIGHT:
        return MOST_WEIGHT
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, inner / variance - 1))


@dataclass
class Sites:
    """Posterior rates by site (``table``: host, path, host_rate, path_rate) and the global rate."""

    table: DataFrame
    rate: float
    host_weight: float
    path_weight: float
    number: int


def site_rates(judged: DataFrame) -> Sites:
    """Empirical Bayes rates from all rows of ``judged`` (host, path, p)."""
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    top = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).first()
    rate = top["good"] / top["n"] if top["n"] else 0.5
    rate = min(max(rate, 1e-4), 1 - 1e-4)
    host_weight = prior_weight(hosts, "host_n", "host_good", F.lit(rate))
    hosts = hosts.withColumn(
        "host_rate", (F.col("host_good") + host_weight * rate) / (F.col("host_n") + host_weight)
    )
    both = paths.join(
        hosts.select(F.col("host").alias("__host"), "host_rate"),
        F.col("host").eqNullSafe(F.col("__host")),
    ).drop("__host")
    path_weight = prior_weight(both, "n", "good", F.col("host_rate"))
    return Sites(
        both.select(
            "host",
            "path",
            "host_rate",
            ((F.col("good") + path_weight * F.col("host_rate")) / (F.col("n") + path_weight)).alias(
                "path_rate"
            ),
        ).checkpoint(),
        rate,
        host_weight,
        path_weight,
        paths.count(),
    )


def _odds(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def with_posterior(judged: DataFrame, sites: Sites, base_rate: float) -> DataFrame:
    """``judged`` (host, path, p and any others) with host_rate, path_rate and posterior."""
    known = sites.table.select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), "host_rate", "path_rate"
    )
    joined = judged.join(
        F.broadcast(known) if sites.number <= SITES_HELD else known,
        judged["host"].eqNullSafe(F.col("__host")) & judged["path"].eqNullSafe(F.col("__path")),
        "left",
    ).drop("__host", "__path")
    prior = F.coalesce("path_rate", F.lit(sites.rate))
    ratio = _odds(F.col("p")) - _odds(F.lit(base_rate))
    return joined.withColumn("posterior", 1 / (1 + F.exp(-(_odds(prior) + ratio))))


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang"
) -> DataFrame:
    """Per document: doc_id, p_text, host_rate, path_rate, posterior, accepted."""
    model = fit(docs, labels)
    judged = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs[host].alias("host"),
        docs[path].alias("path"),
        evidence(model, docs["text"]).alias("p"),
    ).checkpoint()
    out = with_posterior(judged, site_rates(judged), model.base_rate)
    return out.select(
        "doc_id",
        F.col("p").alias("p_text"),
        "host_rate",
        "path_rate",
        "posterior",
        (F.col("posterior") >= THRESHOLD).alias("accepted"),
    )


def keep_accepted(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that are accepted, with their own columns."""
    model = fit(docs, labels)
    p = evidence(model, docs["text"])
    narrow = docs.select(docs[host].alias("host"), docs[path].alias("path"), p.alias("p"))
    sites = site_rates(narrow)
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[host].alias("host"),
        docs[path].alias("path"),
        p.alias("p"),
    )
    kept = with_posterior(whole, sites, model.base_rate).where(F.col("posterior") >= THRESHOLD)
    return kept.select("row.*")
