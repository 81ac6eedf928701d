"""Packing tokenised documents into fixed-length sequences by column generation.

A document's ids (with an end id) are cut into whole sequences of ``capacity`` ids
and a rest. The rests are packed as a cutting-stock problem over their length
histogram: rests of up to ``FINE`` ids are classes by their exact length, longer ones
are rounded up to ``GRAIN`` ids, so there are at most ``FINE + capacity / GRAIN``
classes however many documents there are. The linear program
over patterns (how many rests of each class share a sequence) starts from
first-fit decreasing; a knapsack dynamic program over the current prices finds the
pattern that lowers the cost most, until none does. The patterns' numbers are
rounded down, and what is left of each class, fewer than one sequence per pattern,
is packed first-fit decreasing into patterns that are used once. Only the
histogram reaches the driver.

Rests are then ranked inside their class (ranked inside hashed parts of the class,
plus the parts' offsets, so a class of a third of all rests is spread), and the rank
decides the pattern, sequence and place. All pieces fit: rounded lengths do.

Defined cases: a NULL text is the empty text, one piece that holds the end id;
repeated rows are packed one by one; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendstar.llm import bpe
from spendstar.llm.common import prepare, shuffle_parts

GRAIN = 8
FINE = 256
CACHE_LIMIT = 600_000
ROUNDS = 3_000

_CACHES: dict = {}


def _ids_value(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _worker_cache(path: str) -> bpe.PieceCache:
    if path not in _CACHES:
        _CACHES[path] = bpe.PieceCache(bpe.load(path), _ids_value, CACHE_LIMIT)
    return _CACHES[path]


def tokenised(docs: DataFrame, path: str, end_id: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """(doc_id, doc_tokens, crcs[, ids]): crcs are the checksums of the document's pieces."""
    prepare(docs.sparkSession)
    specials = bpe.special_strings(bpe.load(path))
    end = _ids_value([end_id])
    width = 4 * capacity
    names = ["doc_id", "doc_tokens", "crcs"] + ["ids"] * keep_ids

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _worker_cache(path)
        pattern = bpe.special_pattern(specials)
        marks = {k: _ids_value([v]) for k, v in specials.items()}
        for batch in batches:
            tokens, crcs, kept = [], [], []
            for text in batch.column(1).to_pylist():
                parts: list[bytes] = []
                for plain, special in bpe.cut_specials(text, marks, pattern):
                    parts.extend(cache.values_of(plain))
                    if special is not None:
                        parts.append(special)
                parts.append(end)
                ids = b"".join(parts)
                tokens.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[k : k + width]) for k in range(0, len(ids), width)])
                if keep_ids:
                    kept.append(ids)
            columns = [batch.column(0), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))]
            if keep_ids:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, doc_tokens long, crcs array<long>" + ", ids binary" * keep_ids
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).mapInArrow(
        tokenise, schema
    )


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per class of the most valuable pattern that fits (unbounded knapsack)."""
    order = np.argsort(sizes)
    sizes_up, prices_up = sizes[order], prices[order]
    fits = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    value = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        n = fits[c]
        if n:
            total = value[c - sizes_up[:n]] + prices_up[:n]
            k = int(total.argmax())
            if total[k] > value[c] + 1e-12:
                value[c], chosen[c] = total[k], k
    counts = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            counts[order[chosen[c]]] += 1
            c -= int(sizes_up[chosen[c]])
    return counts


def first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of patterns that meet the demand exactly, and their numbers.

    Patterns are filled first-fit decreasing with the classes that are left and used
    until one of those runs out. A class belongs to the pattern that uses it up, so
    the columns are independent; classes that run out together get one-class patterns.
    """
    m = len(sizes)
    basis, amount = np.zeros((m, m)), np.zeros(m)
    left = demand.astype(float).copy()
    open_ = left > 0
    for k in np.flatnonzero(~open_):
        basis[k, k] = capacity // sizes[k]
    descending = np.argsort(-sizes)
    while open_.any():
        room, counts = capacity, np.zeros(m)
        for k in descending:
            if open_[k]:
                counts[k], room = room // sizes[k], room % sizes[k]
        used = np.flatnonzero(counts)
        times = float((left[used] / counts[used]).min())
        left[used] -= times * counts[used]
        out = used[left[used] <= 1e-9 * demand[used]]
        for k in out:
            left[k], open_[k] = 0.0, False
            basis[k, k] = capacity // sizes[k]
        basis[:, out[0]], amount[out[0]] = counts, times
    return basis, amount


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS):
    """Patterns (rows of counts) and their real-valued numbers of an optimal linear program.

    Revised simplex over the constraints "every class exactly"; ``rounds`` bounds the
    pivots (any basis on the way is a valid packing, only less tight).
    """
    m = len(sizes)
    basis, amount = first_basis(sizes, demand, capacity)
    # the inverse by exchanging one column after another; the columns are triangular in the
    # order their classes run out, so no exchange meets a zero
    inverse = np.eye(m)
    for k in range(m):
        step = inverse @ basis[:, k]
        row = inverse[k] / step[k]
        inverse -= np.outer(step, row)
        inverse[k] = row
    cost = np.ones(m)
    for _ in range(rounds):
        prices = cost @ inverse
        pattern = best_pattern(np.maximum(prices, 0), sizes, capacity).astype(float)
        gain = float(prices @ pattern) - 1
        worst = int(prices.argmin())
        entering = 1.0
        if -prices[worst] > gain:  # leave a place empty: a column of cost 0
            pattern = np.zeros(m)
            pattern[worst], gain, entering = -1.0, float(-prices[worst]), 0.0
        if gain < 1e-7:
            break
        step = inverse @ pattern
        up = step > 1e-10
        if not up.any():
            break
        ratio = np.where(up, np.maximum(amount, 0) / np.where(up, step, 1), np.inf)
        out = int(ratio.argmin())
        by = ratio[out]
        amount -= by * step
        amount[out] = by
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out], cost[out] = pattern, entering
    return basis.T, amount, cost


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[np.ndarray, dict[int, int], int]]:
    """[(class sizes, counts by size, times)] that cover the histogram (size -> rests) exactly."""
    sizes = np.array(sorted(histogram))
    if not len(sizes):
        return []
    left = np.array([histogram[s] for s in sizes], dtype=np.int64)
    patterns, amount, cost = solve(sizes, left.astype(float), capacity)
    chosen: list[tuple[dict[int, int], int]] = []

    def use(counts: np.ndarray, times: int) -> None:
        nonlocal left
        times = int(min([times, *(left[counts > 0] // counts[counts > 0])]))
        if times > 0:
            left = left - times * counts
            chosen.append(({int(sizes[k]): int(counts[k]) for k in np.flatnonzero(counts)}, times))

    for k in np.argsort(-amount):
        if cost[k] > 0 and amount[k] >= 1 and patterns[k].any():
            use(patterns[k].astype(np.int64), int(amount[k] + 1e-9))
    # first-fit decreasing over what is left, fewer than one sequence per pattern
    while left.any():
        room, counts = capacity, np.zeros(len(sizes), dtype=np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            n = min(int(left[k]), room // int(sizes[k]))
            counts[k], room = n, room - n * int(sizes[k])
        use(counts, int(left.max()))
    return [(sizes, c, t) for c, t in chosen]


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, keep_ids: bool = False
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]."""
    spark = docs.sparkSession
    done = tokenised(docs, path, end_id, capacity, keep_ids).checkpoint()
    whole, rest = F.expr(f"doc_tokens div {capacity}"), F.col("doc_tokens") % capacity
    parts = shuffle_parts(spark)
    sized = done.select(
        "*",
        whole.alias("__whole"),
        rest.alias("__rest"),
        F.when(rest <= FINE, rest)
        .otherwise(F.least(F.ceil(rest / GRAIN) * GRAIN, F.lit(capacity)))
        .cast("int")
        .alias("__class"),
        # spreads a class; equal rows may meet, which is harmless
        F.pmod(F.xxhash64("doc_id", "crcs"), F.lit(parts)).alias("__part"),
    )
    histogram = {r["__class"]: r["count"] for r in sized.where("__rest > 0").groupBy("__class").count().collect()}
    plan = plan_sequences(histogram, capacity)

    rows, taken, first = [], dict.fromkeys(histogram, 0), 0
    for _, counts, times in plan:
        for place, (size, n) in enumerate(sorted(counts.items(), reverse=True)):
            rows.append((size, taken[size], taken[size] + n * times, first, n, place))
            taken[size] += n * times
        first += times
    packed_sequences = first
    places = spark.createDataFrame(
        rows,
        "__class int, __from long, __to long, __first long, __each long, __place int",
    )

    # rank in the class = rank in the part + rests of the class in earlier parts
    in_part = Window.partitionBy("__class", "__part").orderBy("doc_id", "doc_tokens", F.col("crcs"))
    ranked = sized.where("__rest > 0").withColumn("__k", F.row_number().over(in_part) - 1)
    earlier = (
        sized.where("__rest > 0")
        .groupBy("__class", "__part")
        .agg(F.count("*").alias("__n"))
        .withColumn(
            "__before",
            F.sum("__n").over(Window.partitionBy("__class").orderBy("__part")) - F.col("__n"),
        )
        .drop("__n")
    )
    rank = F.col("__k") + F.col("__before")
    placed = (
        ranked.join(earlier, ["__class", "__part"])
        .withColumn("__rank", rank)
        .join(
            F.broadcast(places),  # at most a few entries per class
            (ranked["__class"] == places["__class"])
            & (F.col("__rank") >= F.col("__from"))
            & (F.col("__rank") < F.col("__to")),
        )
    )
    within = Window.partitionBy("sequence_id").orderBy("__place", "__copy")
    ids = ["ids"] * keep_ids
    rests = (
        placed.select(
            "doc_id",
            (F.col("__whole") * capacity).alias("start"),
            F.col("__rest").alias("length"),
            F.element_at("crcs", -1).alias("ids_crc32"),
            "doc_tokens",
            (F.col("__first") + F.expr("(__rank - __from) div __each")).alias("sequence_id"),
            "__place",
            ((F.col("__rank") - F.col("__from")) % F.col("__each")).alias("__copy"),
            *ids,
        )
        .withColumn("offset", F.sum("length").over(within) - F.col("length"))
        .drop("__place", "__copy")
    )
    # whole sequences are numbered after the packed ones: by part, then inside the part
    long_docs = sized.where("__whole > 0")
    by_part = {r["__part"]: r["n"] for r in long_docs.groupBy("__part").agg(F.sum("__whole").alias("n")).collect()}
    starts, at = [], packed_sequences
    for k in range(parts):
        starts.append(at)
        at += by_part.get(k, 0)
    order = (
        Window.partitionBy("__part")
        .orderBy("doc_id", "doc_tokens", F.col("crcs"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    wholes = (
        long_docs.withColumn("__end", F.sum("__whole").over(order))
        .withColumn("__base", F.element_at(F.lit(starts), (F.col("__part") + 1).cast("int")) + F.col("__end") - F.col("__whole"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__whole") - 1)).alias("__i"))
        .select(
            "doc_id",
            (F.col("__i") * capacity).alias("start"),
            F.lit(capacity).cast("long").alias("length"),
            F.element_at("crcs", (F.col("__i") + 1).cast("int")).alias("ids_crc32"),
            "doc_tokens",
            (F.col("__base") + F.col("__i")).alias("sequence_id"),
            *ids,
            F.lit(0).cast("long").alias("offset"),
        )
    )
    out = rests.unionByName(wholes)
    if keep_ids:
        cut = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
        out = out.withColumn("ids", cut)
    return out
