"""Language identification by a small bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in segments of ``SEGMENT`` bytes, each from a zero
state in both directions; at every position the two states give probabilities of
the learned languages, and a document's probabilities are the mean over the
positions of letters (bytes of ASCII letters and of non-ASCII characters). All bytes
of a text are read. Gates use the piecewise linear sigmoid ``clip(x/4 + 1/2, 0, 1)``,
the candidate state ``tanh``.

Training is backpropagation through time in numpy on the driver, over windows of
``SEGMENT`` bytes at pseudo-random places of a sample of the training documents:
about ``SAMPLE_PER_LANGUAGE`` windows (a parameter), and never more than twice as
many, for each language of the training rows, so the driver holds some 150 KB a
language at any corpus size. States and steps grow with the number of languages. The
weights, a few thousand with four languages, go to the workers within the function.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0;
with no training rows every text is ``und``; NULL languages are not learned from;
repeated rows each give a row; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import prepare

HIDDEN = 8  # with up to four languages
SEGMENT = 96
SAMPLE_PER_LANGUAGE = 1500
STEPS = 400  # with up to four languages
BATCH = 96
LEARNING_RATE = 0.03
BLOCK = 4096  # segments that go through the network at once
UNDETERMINED = "und"
# Bytes whose positions are pooled: ASCII letters and bytes of longer characters.
_POOLED = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Model:
    """Weights by direction: input table (256, 3h), recurrent (h, 2h) and (h, h), output (2h, k)."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def hidden_states(k: int) -> int:
    """States in each direction for ``k`` languages."""
    return HIDDEN * max(1, math.ceil(math.log2(max(k, 1)) / 2))


def training_steps(k: int) -> int:
    return math.ceil(STEPS * max(1.0, math.sqrt(k / 4)))


def _start(k: int, seed: int) -> dict[str, np.ndarray]:
    hidden = hidden_states(k)
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.5, (256, 3 * hidden))
        w["g" + d] = rng.normal(0, 0.3, (hidden, 2 * hidden))
        w["c" + d] = rng.normal(0, 0.3, (hidden, hidden))
    w["out"] = rng.normal(0, 0.3, (2 * hidden, k))
    w["bias"] = np.zeros(k)
    return {n: v.astype(np.float32) for n, v in w.items()}


def _scaled(w: dict, d: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input table (3h, 256) and recurrent weights, transposed, with the gates' scale folded in."""
    hidden = len(w["g" + d])
    table = np.ascontiguousarray(w["x" + d].T)
    table[: 2 * hidden] = table[: 2 * hidden] * 0.25 + 0.5
    gates = np.ascontiguousarray(w["g" + d].T) * np.float32(0.25)
    return table, gates, np.ascontiguousarray(w["c" + d].T)


def _states(w: dict, d: str, seg: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple]]:
    """(position, state before, state after, gates and candidate) along ``seg`` (positions, rows).

    States are (h, rows).
    """
    table, u_gates, u_cand = _scaled(w, d)
    hidden = len(w["g" + d])
    steps, rows = seg.shape
    h = np.zeros((hidden, rows), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        x = table.take(seg[t], axis=1)
        gates = u_gates @ h
        gates += x[: 2 * hidden]
        np.clip(gates, 0, 1, out=gates)
        update, reset = gates[:hidden], gates[hidden:]
        cand = u_cand @ (reset * h)
        cand += x[2 * hidden :]
        np.tanh(cand, out=cand)
        new = cand - h
        new *= update
        new += h
        yield t, h, new, (gates, cand)
        h = new


def _softmax(z: np.ndarray) -> np.ndarray:
    """Along the first axis, in place."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


def _gradients(w: dict, seg: np.ndarray, pooled: np.ndarray, target: np.ndarray):
    """Loss and gradients: cross-entropy at every pooled position, through time."""
    hidden = len(w["gf"])
    steps, rows = seg.shape
    runs = {d: sorted(_states(w, d, seg), key=lambda s: s[0]) for d in "fb"}
    # (2h, positions, rows)
    both = np.concatenate([np.stack([s[2] for s in runs[d]], axis=1) for d in "fb"])
    z = np.tensordot(w["out"], both, (0, 0)) + w["bias"][:, None, None]
    dz = _softmax(z)
    weight = (pooled / max(1, pooled.sum())).astype(np.float32)
    picked = dz[target[None, :], np.arange(steps)[:, None], np.arange(rows)[None, :]]
    loss = -float((np.log(picked + 1e-9) * weight).sum())
    dz[target[None, :], np.arange(steps)[:, None], np.arange(rows)[None, :]] -= 1
    dz *= weight
    grad = {"out": np.tensordot(both, dz, ((1, 2), (1, 2))), "bias": dz.sum((1, 2))}
    dboth = np.tensordot(w["out"], dz, (1, 0))
    order = np.argsort(seg, axis=None, kind="stable")
    values, starts = np.unique(seg.reshape(-1)[order], return_index=True)
    for k, d in enumerate("fb"):
        gg, gc = np.zeros_like(w["g" + d]), np.zeros_like(w["c" + d])
        dh = np.zeros((hidden, rows), np.float32)
        dx = np.empty((steps, rows, 3 * hidden), np.float32)
        for t, h, _, (gates, cand) in reversed(runs[d]) if d == "f" else runs[d]:
            dh = dh + dboth[k * hidden : (k + 1) * hidden, t]
            update, reset = gates[:hidden], gates[hidden:]
            dcand = dh * update * (1 - cand * cand)
            dreset_h = w["c" + d] @ dcand
            dgates = np.concatenate([dh * (cand - h), dreset_h * h])
            dgates *= ((gates > 0) & (gates < 1)) * np.float32(0.25)
            gc += (reset * h) @ dcand.T
            gg += h @ dgates.T
            dx[t, :, : 2 * hidden], dx[t, :, 2 * hidden :] = dgates.T, dcand.T
            dh = dh * (1 - update) + dreset_h * reset + w["g" + d] @ dgates
        gx = np.zeros_like(w["x" + d])
        gx[values] = np.add.reduceat(dx.reshape(-1, 3 * hidden)[order], starts, axis=0)
        grad |= {"x" + d: gx, "g" + d: gg, "c" + d: gc}
    return loss, grad


def train(windows: list[bytes], labels: list[str], steps: int | None = None, seed: int = 7) -> Model:
    """Fit the network with Adam on windows of at most ``SEGMENT`` bytes."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], {})
    seg = np.full((len(windows), SEGMENT), 32, np.uint8)
    for i, w in enumerate(windows):
        seg[i, : min(len(w), SEGMENT)] = np.frombuffer(w[:SEGMENT], np.uint8)
    number = {x: k for k, x in enumerate(languages)}
    target = np.array([number[x] for x in labels])
    steps = training_steps(len(languages)) if steps is None else steps
    by_language = [np.flatnonzero(target == k) for k in range(len(languages))]
    rng = np.random.default_rng(seed)
    w = _start(len(languages), seed)
    first = {n: np.zeros_like(v) for n, v in w.items()}
    second = {n: np.zeros_like(v) for n, v in w.items()}
    for step in range(1, steps + 1):
        lang = rng.integers(0, len(languages), BATCH)  # languages evenly, however frequent
        rows = np.array([by_language[k][rng.integers(0, len(by_language[k]))] for k in lang])
        part = seg[rows].T
        _, grad = _gradients(w, part, _POOLED[part], target[rows])
        rate = LEARNING_RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grad.items():
            np.clip(g, -1, 1, out=g)
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.99 * second[n] + 0.01 * g * g
            m, v = first[n] / (1 - 0.9**step), second[n] / (1 - 0.99**step)
            w[n] = (w[n] - rate * m / (np.sqrt(v) + 1e-6)).astype(np.float32)
    return Model(languages, w)


def _segments(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts as rows of ``SEGMENT`` (short ones filled with blanks), and their text."""
    count = np.array([-(-len(b) // SEGMENT) for b in data])
    seg = np.full((int(count.sum()), SEGMENT), 32, np.uint8)
    flat = seg.reshape(-1)
    at = 0
    for b, n in zip(data, count, strict=True):
        flat[at : at + len(b)] = np.frombuffer(b, np.uint8)
        at += int(n) * SEGMENT
    return seg, np.repeat(np.arange(len(data)), count)


def has_letter(text: str) -> bool:
    """Whether a text has a letter of any script (no number sign such as a half or a Roman numeral)."""
    return any(map(str.isalpha, text))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; every byte goes through the network."""
    out = np.zeros(len(texts))
    names = [UNDETERMINED] * len(texts)
    k = len(model.languages)
    lettered = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
    if not k or not lettered:
        return names, out
    w = model.weights
    hidden = len(w["gf"])
    sums = np.zeros((len(lettered), k))
    seg, owner = _segments([texts[i].encode("utf-8", "replace") for i in lettered])
    bias = w["bias"][:, None]
    out_f, out_b = np.ascontiguousarray(w["out"].T[:, :hidden]), np.ascontiguousarray(w["out"].T[:, hidden:])
    for lo in range(0, len(seg), BLOCK):
        part = np.ascontiguousarray(seg[lo : lo + BLOCK].T)
        forward = [out_f @ state for _, _, state, _ in _states(w, "f", part)]
        pooled = np.zeros((k, part.shape[1]), np.float32)
        for t, _, state, _ in _states(w, "b", part):
            p = out_b @ state
            p += forward[t]
            p += bias
            _softmax(p)
            p *= _POOLED[part[t]]
            pooled += p
        np.add.at(sums, owner[lo : lo + BLOCK], pooled.T)
    total = sums.sum(axis=1, keepdims=True)
    # a letter that is none of the pooled bytes does not exist, so totals are positive
    share = sums / np.maximum(total, 1e-30)
    best = share.argmax(axis=1)
    for j, i in enumerate(lettered):
        names[i], out[i] = model.languages[best[j]], float(min(1.0, share[j, best[j]]))
    return names, out


def fit(docs: DataFrame, trained_on: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Train on windows of the rows of ``docs`` (doc_id, text, lang) where ``trained_on`` holds.

    Which rows are sampled depends on hashes of their id and text alone.
    """
    prepare(docs.sparkSession)
    usable = docs.where(trained_on & docs["lang"].isNotNull() & docs["text"].isNotNull())
    share = F.least(F.lit(1.0), per_language / F.col("count"))
    rates = usable.groupBy("lang").count().select("lang", (share * (1 << 30)).cast("long").alias("rate"))
    # rows without an id are told apart by their text
    name = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    mark = F.pmod(F.xxhash64(name, F.lit("sample")), F.lit(1 << 30))
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SEGMENT, F.lit(1))) + 1
    rows = (
        usable.select("doc_id", "lang", "text", mark.alias("mark"))
        .join(F.broadcast(rates), "lang")
        .where(F.col("mark") < F.col("rate"))
        .select("doc_id", "lang", "mark", F.substring("text", place.cast("int"), F.lit(SEGMENT)).alias("w"))
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id", "w")))
        .where(F.col("n") <= 2 * per_language)
        .orderBy("doc_id", "w", "lang")
        .collect()
    )
    return train([r["w"].encode("utf-8", "replace") for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, lang_pred, score)."""
    prepare(docs.sparkSession)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = predict(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(
        label, "doc_id long, lang_pred string, score double"
    )


def language_column(model: Model, text: Column) -> Column:
    """A struct (lang_pred, score) of ``text``, to filter rows that keep all their columns."""
    @F.pandas_udf("lang_pred string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        names, score = predict(model, [t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": score})

    return label(text)
