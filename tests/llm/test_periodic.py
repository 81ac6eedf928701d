"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from spendstar.llm import periodic, queries
from tests.conftest import SF001


def plain_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[i:] < s[j:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(words, least, exponent):
    """By comparing the words with themselves at each distance."""
    numbers: dict = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=int)
    n, out = len(a), []
    for q in range(1, n // exponent + 1):
        same = np.diff(np.concatenate(([0], a[:-q] == a[q:], [0])).astype(int))
        for i, j in zip(np.flatnonzero(same == 1), np.flatnonzero(same == -1), strict=True):
            length = int(j - i + q)
            smaller = any((a[i : i + length - r] == a[i + r : i + length]).all() for r in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                out.append((int(i), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_arrays_and_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.5:
            s = (s[: rng.randint(1, 7)] * 30)[: rng.randint(1, 60)] + s[: rng.randint(0, 10)]
        assert periodic.lyndon_array(s) == plain_lyndon(s)
        assert periodic.runs_of(s, 2, 2) == plain_runs(s, 2, 2)
        words = [str(x).encode() for x in s]
        assert periodic.runs_of_words(words) == plain_runs(s, 24, 3)


def test_runs_of_long_repetitions():
    assert periodic.runs_of([7] * 100_000) == [(0, 100_000, 1)]
    unit = list(range(1_000))
    assert periodic.runs_of(unit * 3 + [0]) == [(0, 3_001, 1_000)]
    assert periodic.runs_of(unit * 2) == []


def test_collapsed_keeps_first_periods():
    words = [b"x"] + [b"a", b"b"] * 12 + [b"y"]
    runs = periodic.runs_of_words(words)
    assert runs == [(1, 24, 2)]
    assert periodic.collapsed(words, runs) == b"x a b y"


def test_query_equals_brute_force(spark):
    rows = queries.op11_periodic_runs(spark, SF001).collect()
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    found = 0
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words, 24, 3)
        found += len(runs)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        rest = " ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else None
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(rest.encode()).hexdigest()
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
    assert found


def test_highest_run_ties(spark):
    runs = [(0, 30, 10), (40, 90, 30), (200, 24, 8), (300, 31, 10)]
    rows = spark.createDataFrame([(runs,), (runs[:3],), ([],)], f"runs {periodic.RUNS}")
    best = rows.select(queries.highest_run(F.col("runs")).alias("b")).collect()
    assert [tuple(r.b) if r.b else None for r in best] == [(300, 31, 10), (0, 30, 10), None]


def test_edge_rows(spark, edge, empty, clashing):
    out = periodic.periodic_runs(edge)
    rows = out.collect()
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by_id[i].n_words, by_id[i].runs, by_id[i].collapsed) == (0, [], "")
    assert by_id[9].n_words == 20_000 and not by_id[9].runs
    assert periodic.periodic_runs(empty).count() == 0
    assert sorted(map(str, periodic.periodic_runs(clashing).collect())) == sorted(map(str, rows))
    assert queries.with_tails(edge).count() == edge.count()
