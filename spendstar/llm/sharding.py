"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 by ascending ``doc_id`` (then size, text checksum), in
ranges: one shuffle of the narrow columns by range, a row number inside each
range, and the ranges' offsets (one number per range). A Feistel network over the
next even number of bits, walked along its cycle until it falls below N, permutes
the row numbers. Position p of the permutation lies in shard ``p mod S`` at slot
``p div S``: shard and slot of a row can be computed from its number, and the row
number from shard and slot (:func:`locate`, :func:`row_at`). Shard counts differ
by one at most, slots have no gaps.

Defined cases: a NULL text has size 8 and the checksum of the empty text; NULL
ids are numbered first; repeated rows each get a place of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendstar.llm.common import id_splits, prepare, range_of, shuffle_parts

ROUNDS = 6
RANGES_PER_PARTITION = 4


def half_bits(n: int) -> int:
    """Bits of each half: the smallest b with 4**b >= n."""
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (splitmix constants, fixed values) of x plus a round key."""
    z = x + np.uint64(key)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def round_keys(seed: int) -> list[int]:
    ids = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [int(k) for k in _mix(ids, seed & 0xFFFFFFFFFFFFFFFF)]


def _network(x: np.ndarray, bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    mask, b = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> b, x & mask
    for key in reversed(keys) if inverse else keys:
        if inverse:
            left, right = right ^ (_mix(left, key) & mask), left
        else:
            left, right = right, left ^ (_mix(right, key) & mask)
    return (left << b) | right


def permute(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Places of the numbers ``x`` (all below ``n``) in a permutation of 0..n-1."""
    bits, keys = half_bits(n), round_keys(seed)
    with np.errstate(over="ignore"):
        out = _network(np.asarray(x, dtype=np.uint64), bits, keys, inverse)
        outside = np.flatnonzero(out >= n)
        while outside.size:
            out[outside] = _network(out[outside], bits, keys, inverse)
            outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of global row ``row`` of ``n``."""
    p = int(permute(np.array([row]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The global row number at a shard's slot: the inverse of :func:`locate`."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(df: DataFrame, by: str, then: list[str], name: str = "row") -> tuple[DataFrame, int]:
    """``df`` with dense global numbers in column ``name``, and the number of rows."""
    parts = RANGES_PER_PARTITION * shuffle_parts(df.sparkSession)
    splits = id_splits(df, by, parts)
    ranged = df.withColumn("__range", range_of(F.col(by), splits))
    counts = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}
    starts, total = [], 0
    for k in range(len(splits) + 1):
        starts.append(total)
        total += counts.get(k, 0)
    within = Window.partitionBy("__range").orderBy(F.col(by).asc_nulls_first(), *then)
    row = F.row_number().over(within) - 1 + F.element_at(F.lit(starts), F.col("__range") + 1)
    return ranged.withColumn(name, row.cast("long")).drop("__range"), total


def shard_rows(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot) of every row of ``docs``."""
    prepare(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    sized = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, total = number_rows(sized, "doc_id", ["size", "text_crc32"])

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(permute(row.to_numpy(), total, seed))

    placed = numbered.withColumn("place", place("row"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").alias("slot"),
    )
