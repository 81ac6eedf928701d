"""Periodic runs of words, found from Lyndon roots.

1. Only places where a stretch of ``SEED`` words occurs twice in a document can lie in a
   reported run: a run of length L >= max(24, 3 q) agrees with itself shifted by its
   period q over L - q >= 16 words, and the two copies of these stretches cover it. Hashes
   of all stretches mark those places; a collision marks more, never less.
2. Over each marked place the grouping phase of Baier's suffix sorter runs twice, over
   the words' numbers in ascending and in descending order. Suffixes are held in groups
   by their first word; from the highest group down, each suffix of a group extends the
   nearest suffix before it that is in a lower group. A suffix's group, when its turn
   comes, is its longest Lyndon prefix, so both Lyndon arrays come directly.
3. By the runs theorem each run holds, under one of the two orders, a Lyndon word as long
   as its period. Every entry of the arrays is such a root; longest common extensions
   to the right and to the left (doubling, then halving byte comparisons: exact) turn it
   into the run, and those that are long enough are kept.

Words are the stretches without ASCII white space (U+0020, U+0009 to U+000D).

Defined cases: a NULL or empty text, or one of white space only, has no words and no runs;
its collapsed text is empty. Runs of equal start are ordered by period. Repeated rows
each give a row; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import prepare

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
# Longest stretch that every reported run must contain twice: 2/3 of its least length.
SEED = 16

_BASE = 0x9E3779B97F4A7C15

RUNS = "array<struct<start: long, length: long, period: long>>"
_RUNS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_array(numbers: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place (the grouping phase)."""
    n = len(numbers)
    lists: list[list[int]] = []
    group = [0] * n
    of_number: dict[int, list[int]] = {}
    for i, x in enumerate(numbers):
        of_number.setdefault(x, []).append(i)
    for g, x in enumerate(sorted(of_number)):
        lists.append(of_number[x])
        for i in of_number[x]:
            group[i] = g
    context = [1] * len(lists)
    below = list(range(-1, len(lists) - 1))
    above = list(range(1, len(lists) + 1))
    lengths = [0] * n
    # places whose group had no turn yet, as a chain; place -1 (the last entry) is its end
    left, right = list(range(-1, n)), list(range(1, n + 2))
    left[n] = n - 1
    right[-1] = 0
    g = len(lists) - 1
    while g >= 0:
        size = context[g]
        # nearest lower suffix before each member, with how many members extend it
        extended: dict[int, int] = {}
        for i in lists[g]:
            if group[i] == g:
                lengths[i] = size
                p, r = left[i], right[i]
                right[p] = r
                left[r] = p
                if p >= 0:
                    extended[p] = extended.get(p, 0) + 1
        for times in sorted(set(extended.values()), reverse=True):
            made: dict[int, int] = {}
            for p, k in extended.items():
                if k == times:
                    old = group[p]
                    new = made.get(old)
                    if new is None:
                        new = made[old] = len(lists)
                        lists.append([])
                        context.append(context[old] + times * size)
                        upper = above[old]
                        below.append(old)
                        above.append(upper)
                        below[upper] = new
                        above[old] = new
                    group[p] = new
                    lists[new].append(p)
        lists[g] = []
        g = below[g]
    return lengths


def _agree_right(data: bytes, i: int, j: int, n: int) -> int:
    """How many words agree from i and j (i < j) on; four bytes a word."""
    k, step, most = 0, 1, n - j
    while step and k < most:
        step = min(step, most - k)
        if data[4 * (i + k) : 4 * (i + k + step)] == data[4 * (j + k) : 4 * (j + k + step)]:
            k += step
            step *= 2
        else:
            step //= 2
    return k


def _agree_left(data: bytes, i: int, j: int) -> int:
    """How many words agree before i and j (i < j)."""
    k, step = 0, 1
    while step and k < i:
        step = min(step, i - k)
        if data[4 * (i - k - step) : 4 * (i - k)] == data[4 * (j - k - step) : 4 * (j - k)]:
            k += step
            step *= 2
        else:
            step //= 2
    return k


def runs_of(numbers: list[int], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT):
    """All (start, length, period) of runs, by start and period."""
    n = len(numbers)
    data = np.array(numbers, dtype="<u4").tobytes()
    found = set()
    for order in (numbers, [-x for x in numbers]):
        end_of: dict[int, int] = {}  # per period, the end of the stretch that was extended last
        for i, period in enumerate(lyndon_array(order)):
            if period * least_exponent > n or i + period <= end_of.get(period, 0):
                continue
            after = _agree_right(data, i, i + period, n)
            before = _agree_left(data, i, i + period)
            end = i + period + after
            end_of[period] = end
            length = before + period + after
            if length >= least_length and length >= least_exponent * period:
                found.add((i - before, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_places(words: list[bytes], seed: int = SEED) -> list[tuple[int, int]]:
    """Stretches of places that lie in some ``seed`` words (a power of two) that occur twice."""
    n = len(words)
    if n <= seed:
        return []
    with np.errstate(over="ignore"):
        key = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        factor, k = np.uint64(_BASE), 1
        while k < seed:
            key = key[:-k] + key[k:] * factor
            factor, k = factor * factor * np.uint64(3), 2 * k
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, key)
    at[at == len(twice)] = 0
    starts = np.flatnonzero(twice[at] == key)
    breaks = np.flatnonzero(np.diff(starts) > seed)
    firsts = starts[np.concatenate(([0], breaks + 1))]
    lasts = starts[np.concatenate((breaks, [len(starts) - 1]))] + seed
    return list(zip(firsts.tolist(), lasts.tolist(), strict=True))


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs of a document's words."""
    out = []
    for lo, hi in repeated_places(words):
        if hi - lo < LEAST_LENGTH:
            continue
        number: dict[bytes, int] = {}
        numbers = [number.setdefault(w, len(number)) for w in words[lo:hi]]
        out += [(lo + s, length, q) for s, length, q in runs_of(numbers)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run beyond its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    keep, at = [], 0
    for lo, hi in sorted((s + q, s + length) for s, length, q in runs):
        keep += words[at:lo]
        at = max(at, hi)
    return b" ".join(keep + words[at:])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, runs (by start and period), collapsed text."""
    prepare(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text in batch.column(1).to_pylist():
                words = text.split()
                found = runs_of_words(words)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                texts.append(collapsed(words, found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(runs, _RUNS_ARROW),
                    pa.array(texts, pa.binary()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"),
    )
    found = rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
