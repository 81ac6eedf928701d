"""Each operator against brute force, an exact round trip or held-out accuracy, and on edge rows."""

import hashlib
import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spendstar.llm import (
    bagminhash,
    bpe,
    fingerprints,
    hnsw,
    langid,
    lm,
    near_dedup,
    packing,
    pieces,
    quality,
    queries,
    sharding,
    token_counts,
)

from ..conftest import SF001
from .conftest import DOCS, EDGE

BPE = bpe.default_path("byte_bpe_50k.json")
PIECES = bpe.default_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"] or "", r["lang"]) for r in rows]


# -- fingerprints --------------------------------------------------------------------
def test_fingerprints_follow_the_contract(spark, texts):
    got = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, SF001).collect()}
    assert len(got) == len(texts)
    for k, (doc_id, text, _) in enumerate(texts):
        nxt = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + nxt[:cut]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)
        assert r["near_edited"] == 1 - (a ^ b).bit_count() / 64
        c = int(got[texts[(k + 1) % len(texts)][0]]["fingerprint"], 16)
        assert r["near_next"] == 1 - (a ^ c).bit_count() / 64
    edited = np.mean([r["near_edited"] for r in got.values()])
    assert edited > np.mean([r["near_next"] for r in got.values()]) + 0.2


def test_simhash_votes(spark):
    import xxhash

    words = "one two three two one two".split()
    votes = np.zeros(64)
    row = spark.range(1).select(
        *[
            F.xxhash64(F.lit(a), F.lit(b) if b else F.lit(None).cast("string")).alias(f"h{k}")
            for k, (a, b) in enumerate(zip(words, [*words[1:], None], strict=True))
        ]
    ).first()
    for k, w in enumerate(words):
        h = row[k] & (2**64 - 1)
        votes += [len(w) if h >> b & 1 else -len(w) for b in range(64)]
    want = sum(1 << b for b in range(64) if votes[b] > 0)
    df = spark.createDataFrame([(0, " one two three\ttwo one\n two ")], "k long, t string")
    got = fingerprints.simhash(df, ["k"], {"bits": "t"}).first()["bits"]
    assert got & (2**64 - 1) == want
    assert xxhash.xxh64_intdigest(b"one", 42) == spark.range(1).select(F.xxhash64(F.lit("one"))).first()[0] & (2**64 - 1)


def test_radius_search_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 60)]
    values = set(base)
    for b in base:
        for n in (1, 2, 3, 4):
            v = b
            for bit in rng.choice(64, n, replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "bits long")
    got = {(r["a"], r["b"]) for r in fingerprints.within_radius(df).collect()}
    want = {
        (min(a, b), max(a, b))
        for a, b in combinations(signed, 2)
        if ((a ^ b) & (2**64 - 1)).bit_count() <= fingerprints.RADIUS
    }
    assert got == want and len(want) > 100


def test_fingerprints_edges(spark, edge, empty, clashing):
    rows = fingerprints.document_fingerprints(edge).collect()
    assert len(rows) == len(EDGE)
    assert all(r["bits"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    same = [r["bits"] for r in rows if r["doc_id"] in (5, 6)]
    assert len(set(same)) == 1 and len(same) == 3
    assert fingerprints.document_fingerprints(clashing).count() == len(EDGE)
    assert fingerprints.document_fingerprints(empty).count() == 0


# -- token counts, packing -----------------------------------------------------------
def test_token_counts_equal_the_library(spark, texts, edge, empty, clashing):
    tok = bpe.load(BPE)
    got = {r["doc_id"]: r for r in queries.op2_token_counts(spark, SF001).collect()}
    for doc_id, text, _ in texts:
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (got[doc_id]["n_tokens"], got[doc_id]["n_bytes"]) == (n, len(text.encode()))
        assert got[doc_id]["over_limit"] == (n > 1024)
    rows = token_counts.count_tokens(clashing, BPE).collect()
    want = Counter((d, len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in EDGE)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want
    assert token_counts.count_tokens(empty, BPE).count() == 0


def test_piece_cache_equals_the_library():
    tok = bpe.load(BPE)
    cache = bpe.PieceCache(tok, packing._ids_value, 500)
    specials = bpe.special_strings(tok)
    marks = {k: packing._ids_value([v]) for k, v in specials.items()}
    rng = np.random.default_rng(0)
    alphabet = [*"abeintLL  .,!'\n\n\t0é日😀 ", "'s", "'ll", "<|endoftext|>", "  ", "\r\n", " \n", "\x1c", "́"]
    cases = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(3000)]
    for text in [*cases, " a.", "\n.", "a\n.b", "it's.", "x's,"]:
        parts = []
        for plain, special in bpe.cut_specials(text, marks, bpe.special_pattern(specials)):
            parts.extend(cache.values_of(plain))
            if special is not None:
                parts.append(special)
        got = np.frombuffer(b"".join(parts), "<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, text


def test_pieces_of_letters_and_the_older_cache_equal_the_library():
    tok = bpe.load(BPE)
    cache = bpe.PieceCache(tok, packing._ids_value, 40)
    assert cache.model is not None
    rng = np.random.default_rng(1)
    letters = [*"aAzZeinrstßÀÖØöøÿĀŁƀƻǃɏªµº×÷ɐ", "the", "tion"]
    words = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(400)]
    for _ in range(2000):
        text = " ".join(rng.choice(words, 5))
        got = np.frombuffer(b"".join(cache.values_of(text)), "<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, text
    assert len(cache) <= 21 and len(cache.older) <= 21  # half the limit each, and the piece that came last


def _check_pieces(rows, docs):
    """Pieces cover each document's ids once, sequences are gapless and not too long."""
    tok = bpe.load(BPE)
    want = Counter()
    for doc_id, text in docs:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        want[doc_id, len(ids)] += 1
        for r in rows:
            if r["doc_id"] == doc_id and r["doc_tokens"] == len(ids):
                part = ids[r["start"] : r["start"] + r["length"]]
                assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    covered = Counter()
    for r in rows:
        covered[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert covered == Counter({k: k[1] * n for k, n in want.items()})
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing_holds_every_id_once(spark, texts):
    rows = queries.op8_packing(spark, SF001).collect()
    used = _check_pieces(rows, [(d, t) for d, t, _ in texts])
    total = sum(r["length"] for r in rows)
    assert total / (2048 * used) > 0.95


def test_packing_edges(edge, empty, clashing):
    rows = packing.pack(clashing, BPE).collect()
    _check_pieces(rows, [(d, t) for d, t, *_ in EDGE])
    assert packing.pack(empty, BPE).count() == 0
    kept = packing.pack(edge, BPE, keep_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in kept)


def test_short_and_empty_texts_fill_their_sequences(spark):
    empty = spark.createDataFrame([(i, None if i % 2 else "") for i in range(4096)], "doc_id long, text string")
    rows = packing.pack(empty, BPE).collect()
    assert len(rows) == 4096 and len({r["sequence_id"] for r in rows}) == 2
    short = spark.createDataFrame([(i, " ".join(["word"] * (i % 40))) for i in range(4000)], "doc_id long, text string")
    rows = packing.pack(short, BPE).collect()
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048 and {r["doc_id"] for r in rows} == set(range(4000))
    assert len(used) <= 1.01 * sum(used.values()) / 2048 + 1


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 257, 40_000)
    sizes, counts = np.unique(lengths, return_counts=True)
    plan = packing.plan_sequences(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), 256)
    used = Counter()
    for _, pattern, times in plan:
        assert sum(s * n for s, n in pattern.items()) <= 256
        for s, n in pattern.items():
            used[s] += n * times
    assert used == Counter(lengths.tolist())
    assert sum(t for *_, t in plan) <= 1.01 * lengths.sum() / 256 + 1


# -- nearest neighbours --------------------------------------------------------------
def test_neighbours_recall_and_exact_scores(spark):
    got = queries.op3_nearest_neighbours(spark, SF001).collect()
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    data = {r["vec_id"]: np.array(r["embedding"], float) for r in rows if r["embedding"]}
    asked = [i for i in data if i % 100 == 0]
    hits = 0
    for q in asked:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        best = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)[:10]
        for _, i, score in mine:
            assert math.isclose(score, np.sqrt(((data[i] - data[q]) ** 2).sum()), rel_tol=1e-12)
        hits += len({m[1] for m in mine} & {i for _, i in best})
    assert hits / (10 * len(asked)) >= 0.9


def test_neighbours_edges(spark):
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [0.0, 2.0]), (7, [0.0, 2.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = [tuple(r) for r in hnsw.nearest(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 0.0), (100, 3, 7, math.sqrt(5))]
    assert hnsw.nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    # a very common vector: the smallest ids of its group
    many = spark.range(1, 3001).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    got = hnsw.nearest(many, F.col("vec_id") == 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 6, 7, 8, 9, 10, 11]


# -- SentencePiece -------------------------------------------------------------------
def test_pieces_equal_the_library_and_round_trip(spark, texts, edge, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: r for r in queries.op4_sentencepiece(spark, SF001).collect()}
    for doc_id, text, _ in texts:
        ids = np.array(sp.encode(text), "<u4").tobytes()
        assert (got[doc_id]["n_ids"], got[doc_id]["ids_crc32"]) == (len(ids) // 4, zlib.crc32(ids))
        assert got[doc_id]["round_trip"]
    encoder = pieces.Encoder(pieces.PieceModel(PIECES), limit=200)
    decoder = pieces.Decoder(encoder.model)
    rng = np.random.default_rng(0)
    alphabet = list("abeint ▁.\n0=-é日😀 ")
    cases = ["".join(rng.choice(alphabet, rng.integers(0, 120))) for _ in range(1500)]
    for text in [*cases, "", " ", "  ", "a" * 3000, "ab" * 1500 + " the" * 500, "<s> hi </s>"]:
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == sp.encode(text), text
        assert decoder.decode(ids) == sp.decode(sp.encode(text))
    rows = pieces.decode_ids(pieces.encode_texts(edge, PIECES), PIECES).collect()
    assert all(r["decoded"] == r["text"] for r in rows) and len(rows) == len(EDGE)
    assert pieces.encode_texts(empty, PIECES).count() == 0


def test_streaming_search_commits_and_scores():
    """A unigram search over a small vocabulary equals the best of all segmentations."""
    model = pieces.PieceModel(PIECES)
    model.bpe = False
    vocab = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.2, "aab": -4.0, "bb": -3.1}
    model.id_of = {p: i for i, p in enumerate(vocab)}
    model.text_of, model.score_of = list(vocab), list(vocab.values())
    model.longest, model.unknown_score = 3, -20.0
    rng = np.random.default_rng(2)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b"], rng.integers(1, 40)))
        stream = pieces.Stream(model)
        for c in text:
            stream.feed(c)
            # nothing that all surviving paths share is left uncommitted
            end = len(stream.text)
            alive = [k for k in range(max(0, end - model.longest + 1), end + 1) if stream.back[k] is not None]
            assert max(set.intersection(*[set(stream._path(k)) for k in alive])) == 0
        whole = pieces.Stream(model)
        whole.feed(text)
        assert whole.finish() == stream.finish()
        stream = pieces.Stream(model)
        stream.feed(text)
        got = sum(model.score_of[i] for i in stream.finish())
        best = [0.0]
        for j in range(1, len(text) + 1):
            best.append(max(best[j - n] + vocab[text[j - n : j]] for n in (1, 2, 3) if j >= n and text[j - n : j] in vocab))
        assert math.isclose(got, best[-1])


def test_short_parts_equal_the_streaming_search_and_frequent_ones_stay(monkeypatch):
    import sentencepiece

    model = pieces.PieceModel(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    searched = Counter()
    path, feed = getattr(pieces, "valid_path", None), pieces.Stream.feed

    def counted(m, text):
        searched[text] += 1
        return path(m, text)

    def fed(self, chars):
        searched[chars] += 1
        feed(self, chars)

    monkeypatch.setattr(pieces, "valid_path", counted, raising=False)
    monkeypatch.setattr(pieces.Stream, "feed", fed)
    rng = np.random.default_rng(5)
    syllables = ["th", "er", "on", "ing", "ed", "ti", "wh", "ö", "sch", "日", "é", "9", "😀"]
    encoder, often = pieces.Encoder(model, limit=200), "whereanding"
    for _ in range(300):
        words = ["".join(rng.choice(syllables, rng.integers(1, 7))) + rng.choice(["", ".", ",\n", "***"]) for _ in range(9)]
        text = " ".join([*words, often, often + ".", f"({often}),"])
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == sp.encode(text), text
    # a frequent word is searched once, with a blank before it and without, whatever follows it
    assert {t: k for t, k in searched.items() if often in t} == {f"▁{often}": 1, often: 1}
    assert len(encoder.cache) + len(encoder.older) <= 200
    for text in ["▁thering", "schtion", "a" * 40, "▁" * 9 + "was", "erstpf"]:
        stream = pieces.Stream(model)
        stream.feed(text)
        assert path(model, text) == stream.finish()


# -- language model ------------------------------------------------------------------
def test_base_scores_are_exact_and_the_model_is_better(spark, texts):
    got = {r["doc_id"]: r for r in queries.op5_lm_scores(spark, SF001).collect()}
    words = {d: [*t.encode().lower().split(), b"\n"] for d, t, _ in texts}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    counts = Counter(w for d, ws in words.items() if not out[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in words.items():
        r = got[d]
        assert r["held_out"] == out[d] and r["train_tokens"] == n and r["n_tokens"] == len(ws)
        assert r["n_known"] == sum(w in counts for w in ws)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.02 * sum(r["base_score"] for r in held)


def test_levels_equal_single_probes_and_hashes_keep_no_words():
    import sys

    rng = np.random.default_rng(7)
    segments, bits = 3, 4 * lm._BLOCK
    data = rng.integers(0, 1 << 63, segments * bits // 64, dtype=np.uint64) * np.uint64(2)
    data |= rng.integers(0, 1 << 63, len(data), dtype=np.uint64) << np.uint64(1)
    data[: bits // 64] = ~np.uint64(0)  # every level is found in the first segment
    short = rng.integers(0, 1 << 32, 400, dtype=np.uint64).astype(np.uint32)
    segment = rng.integers(0, segments, len(short)).astype(np.int32)
    flags = np.unpackbits(data.view(np.uint8), bitorder="little")

    def single(key, at):
        for q in range(1, lm.MOST_LEVELS + 1):
            block, z = lm._item(lm._mix(np.array([key], np.uint64)), q, bits)
            places = at * bits + block[0] * lm._BLOCK + 32 * np.arange(lm.PROBES) + ((z[0] * lm._SALTS) >> np.uint32(27))
            if not flags[places].all():
                return q - 1
        return lm.MOST_LEVELS

    with np.errstate(over="ignore"):
        want = [single(*x) for x in zip(short.tolist(), segment.tolist(), strict=True)]
    assert lm.read_levels(data, bits, short, segment).tolist() == want
    assert {0, lm.MOST_LEVELS} < set(want)
    for k in range(segments):
        at = np.flatnonzero(segment == k)
        assert lm.read_levels(data[k * bits // 64 : (k + 1) * bits // 64], bits, short[at]).tolist() == [want[i] for i in at]
    word = b"seldom-%d" % rng.integers(1 << 40)
    before = sys.getrefcount(word)
    assert lm._hashed([word, word]).tolist()[0] == lm._hashed([word])[0]
    assert sys.getrefcount(word) == before


def test_each_level_holds_a_whole_number(spark):
    rows = spark.range(1, 5001).select("id", lm.level(F.col("id")).alias("q")).collect()
    held = {}
    for r in rows:
        held.setdefault(r["q"], []).append(r["id"])
    assert sorted(held) == list(range(1, len(held) + 1))
    for q, counts in sorted(held.items())[:-1]:
        assert math.isclose(lm.VALUES[q], math.sqrt(min(counts) * max(counts)))


def test_filter_levels_are_never_too_low(spark):
    words = spark.range(1, 2001).select(F.xxhash64(F.col("id").cast("string")).alias("h"), F.col("id").alias("c"))
    pairs = spark.range(1, 2001).select(F.xxhash64("id").alias("pair"), (F.col("id") + 1).alias("c"))
    built = lm.build_filter(words, pairs)
    rows = pairs.collect()
    key = np.array([r["pair"] for r in rows], np.int64).view(np.uint64)
    got = built.counts(key, "pair")
    true = np.array([r["c"] for r in rows])
    assert (got >= 0.8 * true).all() and np.mean(got <= 1.25 * true) > 0.97
    absent = built.counts(key ^ np.uint64(0xABCDEF), "pair")
    assert np.mean(absent > 0) < 0.01


def test_pairs_seen_once_are_scored(spark, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT_BITS", 4096, raising=False)
    monkeypatch.setattr(lm, "CHUNK", 300, raising=False)
    docs = spark.createDataFrame([(i, f"x{i} y{i} z{i}") for i in range(500)], "doc_id long, text string")
    model = lm.train(docs)
    got = {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()}
    # the same scores where no worker holds the filter
    monkeypatch.setattr(lm, "HELD_BITS", 0, raising=False)
    assert got == {r["doc_id"]: r["score"] for r in lm.score(docs, model).collect()}
    assert len(got) == 500
    scale = 2000 + 1501 + 1
    seldom, often = 8 / 9, 8 / 508
    each = [1 / 508 + often * 2 / scale, *[1 / 9 + seldom * 2 / scale] * 2, 1 / 9 + seldom * 501 / scale]
    true = sum(math.log10(p) for p in each)
    assert np.mean([abs(x - true) < 0.2 for x in got.values()]) > 0.95
    assert model.filter.segments > 1  # the scores came from a filter in several segments


def test_lm_edges(edge, empty, clashing):
    model = lm.train(edge)
    rows = lm.score(clashing, model).collect()
    assert len(rows) == len(EDGE) and all(r["n_known"] == r["n_tokens"] for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    none = lm.train(empty)
    rows = lm.score(edge, none).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)
    assert lm.score(empty, none).count() == 0


# -- quality -------------------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    sf = SF001.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen, unseen = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = quality.classify(docs, seen).join(unseen, "doc_id").collect()
    right = np.mean([r["accepted"] == (r["quality"] == 1) for r in rows])
    kept = np.mean([r["accepted"] for r in rows if r["quality"] == 1])
    assert right > 0.95 and kept > 0.98


def test_shrinkage_equals_brute_force(spark):
    rows = [("a", "x", 0.9)] * 40 + [("a", "y", 0.2)] * 2 + [("b", "x", 0.4)] * 30 + [(None, "z", 0.5)] * 3
    df = spark.createDataFrame(rows, "host string, path string, p double")
    s = quality.site_rates(df)
    mean = np.mean([p for *_, p in rows])
    assert math.isclose(s.rate, mean)
    for r in s.table.collect():
        host = [p for h, _, p in rows if h == r["host"]]
        path = [p for h, q, p in rows if h == r["host"] and q == r["path"]]
        rate = (sum(host) + s.host_weight * mean) / (len(host) + s.host_weight)
        assert math.isclose(r["host_rate"], rate)
        assert math.isclose(r["path_rate"], (sum(path) + s.path_weight * rate) / (len(path) + s.path_weight))


def test_quality_edges(spark, edge, empty, clashing):
    labels = spark.createDataFrame([(5, 1), (8, 0), (8, None), (None, 1)], "doc_id long, quality int")
    assert quality.classify(clashing, labels).count() == len(EDGE)
    assert quality.classify(empty, labels).count() == 0
    rows = quality.classify(edge, labels.where("false")).collect()
    assert all(r["accepted"] for r in rows)
    assert quality.keep_accepted(clashing, labels).columns == clashing.columns


# -- sharding ------------------------------------------------------------------------
def test_shards_follow_their_law(spark, texts):
    rows = queries.op7_sharding(spark, SF001).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) <= set(range(24)) and len(rows) == len(texts)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    for k, (doc_id, text, _) in enumerate(texts):
        assert place[doc_id] == sharding.locate(k, len(texts), 24, queries.SHARD_SEED)
        assert sharding.row_at(*place[doc_id], len(texts), 24, queries.SHARD_SEED) == k
    one = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}
    assert all(one[d] == (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t, _ in texts)


@pytest.mark.parametrize("n", [1, 2, 3, 24, 25, 1000, 4097])
def test_permutation_is_one(n):
    out = sharding.permute(np.arange(n), n, seed=9)
    assert sorted(out.tolist()) == list(range(n))
    assert sharding.permute(out, n, seed=9, inverse=True).tolist() == list(range(n))


def test_sharding_edges(edge, empty, clashing):
    rows = sharding.shard_rows(clashing, 5).collect()
    assert sorted(r["row"] for r in rows) == list(range(len(EDGE)))
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {8}
    assert sharding.shard_rows(empty, 5).count() == 0


# -- language ------------------------------------------------------------------------
def test_language_on_held_out_documents(spark):
    sf = SF001.replace("0.001", "0.01")
    rows = queries.op9_language_id(spark, sf).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held if r["lang_pred"] != "und"]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(truth)


def test_every_language_is_learned(spark):
    """70 languages, each with its own words: all are predicted, none is rejected for their number."""
    rng = np.random.default_rng(4)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    rows = []
    for k in range(70):
        own = ["".join(rng.choice(letters, 5)) for _ in range(3)]
        for i in range(40 if k < 64 else 20):
            rows.append((len(rows), " ".join(rng.choice(own, 60)), f"l{k:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.lit(True))
    assert model.languages == sorted({r[2] for r in rows})
    names, score = langid.predict(model, [r[1] for r in rows])
    right = np.array([n == r[2] for n, r in zip(names, rows, strict=True)])
    rare = np.array([r[2] >= "l64" for r in rows])
    assert right.mean() > 0.95 and right[rare].mean() > 0.9
    assert np.mean(score >= corpus_pipeline.least_language_score(70)) > 0.99
    assert corpus_pipeline.least_language_score(4) == 0.4


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    w = {k: v.astype(np.float64) for k, v in langid._start(3, 1).items()}
    seg = rng.integers(97, 110, (6, 4)).astype(np.uint8)
    pooled, target = np.ones((6, 4), bool), np.array([0, 1, 2, 1])
    _, grad = langid._gradients(w, seg, pooled, target)
    for name in ("gf", "cb", "out", "bias", "xf"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old, step = w[name][at], 1e-2
        w[name][at] = old + step
        up = langid._gradients(w, seg, pooled, target)[0]
        w[name][at] = old - step
        down = langid._gradients(w, seg, pooled, target)[0]
        w[name][at] = old
        assert abs((up - down) / (2 * step) - grad[name][at]) < 0.05 * abs(grad[name][at]) + 2e-3


def test_language_edges(edge, empty, clashing):
    model = langid.train([b"the and of that with", "où être à l'école".encode()] * 20, ["en", "fr"] * 20, steps=20)
    rows = {r["doc_id"]: r for r in langid.identify(clashing, model).collect()}
    assert all(rows[k]["lang_pred"] == "und" and rows[k]["score"] == 0 for k in (1, 2, 3, 8))
    assert rows[5]["lang_pred"] in ("en", "fr")
    assert langid.identify(empty, model).count() == 0
    none = langid.fit(empty, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(edge, none).collect()} == {"und"}


# -- near duplicates -----------------------------------------------------------------
def _bag(text):
    w = (text or "").lower().split()
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def _similar(a, b):
    if not a and not b:
        return 1.0
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def _true_classes(rows):
    """Components of all links by brute force: (id, text) -> frozenset."""
    bags = [_bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if root(i) != root(j) and _similar(bags[i], bags[j]) >= 0.8:
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [rows[root(i)][0] for i in range(len(rows))]


def test_near_duplicates_equal_brute_force(spark, texts):
    rows = [(d, t) for d, t, _ in texts]
    got = {r["doc_id"]: r["class_id"] for r in queries.op10_near_dedup(spark, SF001).collect()}
    want = dict(zip([d for d, _ in rows], _true_classes(rows), strict=True))
    assert got == want


def test_near_duplicates_chains_and_borderline_groups(spark):
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 5000, 150)]
    rows = []
    for k in range(160):  # copies with more and more edits, and chains of them
        words = list(base if k % 3 else rows[-1][1].split()) if rows else list(base)
        for _ in range(int(rng.integers(0, 9))):
            words[int(rng.integers(0, 150))] = f"z{rng.integers(0, 10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(200 + k, " ".join(base)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df).collect()}
    want = dict(zip([d for d, _ in rows], _true_classes(rows), strict=True))
    assert got == want


def test_large_buckets_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "PER_TASK", 8)
    test_near_duplicates_chains_and_borderline_groups(spark)


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(1)
    hashes, errors = bagminhash.WordHashes(), []
    for _ in range(60):
        a = [f"w{x}" for x in rng.integers(0, 40, 60)] * int(rng.integers(1, 6))
        b = a[: int(len(a) * rng.uniform(0.4, 1))] + [f"z{x}" for x in rng.integers(0, 50, 20)]
        owner, h = bagminhash.shingles([" ".join(a), " ".join(b)], hashes)
        values = bagminhash.signatures(2, *bagminhash.counted(owner, h))
        errors.append((values[0] == values[1]).mean() - _similar(_bag(" ".join(a)), _bag(" ".join(b))))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_near_duplicate_edges(edge, empty, clashing):
    rows = near_dedup.near_duplicates(clashing).collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r["class_id"] for r in rows}
    assert by[1] == by[2] == by[3] == 1 and by[5] == by[6] == 5 and by[None] is None
    kept = near_dedup.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = sorted(kept.toPandas()["doc_id"].fillna(-1).astype(int))
    assert ids == [-1, 1, 4, 5, 7, 8, 9, 10]
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.keep_one(empty).count() == 0


# -- pipeline ------------------------------------------------------------------------
def test_pipeline_equals_its_stages_by_brute_force(spark, texts):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    kept, stages = docs, dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "near_dedup", "packing"]
    for name in ("language_id", "quality"):
        before = kept.count()
        kept = stages[name](spark, kept, SF001)
        assert kept.columns == docs.columns and 0.7 * before < kept.count() <= before
    rows = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    want = sorted(set(_true_classes(rows)))
    single = stages["near_dedup"](spark, kept, SF001)
    assert single.columns == docs.columns
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == want
    out = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"] for r in out} == set(want)
    _check_pieces(out, [(d, t) for d, t in rows if d in set(want)])


def test_pipeline_stages_on_edges(spark, empty, clashing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF001).count() == 0, name
        assert stage(spark, clashing, SF001).columns == clashing.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, clashing, SF001).count() >= len(EDGE)
    assert DOCS.fieldNames() == ["doc_id", "text", "lang", "source", "n_chars"]
