"""Queries over the given tables, one for each operator of this subpackage.

Each callable takes (spark, sf_dir) and applies its operator, with its usual
parameters, to its whole table. ``ORACLE_SQL`` holds DuckDB SQL where SQL can
express the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import alignment, bpe, fingerprints, hnsw, langid, lm, near_dedup, packing, periodic, pieces, quality, sharding, token_counts, toxicity
from spendstar.llm.common import table

TOKEN_LIMIT = 1024
SEQUENCE = 2048
END_ID = 1
SHARDS = 24
SHARD_SEED = 20
TOXIC_FROM = 0.7


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prints = fingerprints.document_fingerprints(docs).checkpoint()
    near = fingerprints.near_counts(prints)
    return prints.join(near, "bits").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_hex(F.col("bits")).alias("fingerprint"),
        fingerprints.as_hex(F.col("edited_bits")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        fingerprints.likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        (F.col("n_equal") - 1).alias("n_same_fingerprint"),
        F.col("n_near").alias("n_within_radius"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, bpe.default_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = bpe.default_path("piece_bpe_32k.model")
    both = pieces.decode_ids(pieces.encode_texts(docs, path), path)
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "n_ids",
        "ids_crc32",
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = lm.train(docs.where(~out))
    return lm.score(docs, model).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, bpe.default_path("byte_bpe_50k.json"), SEQUENCE, END_ID)
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs, ~F.coalesce(held_out, F.lit(False)))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def repeat_tail(doc_id: int, text: str) -> str:
    """The text's words, of which those from a place on repeat the first of them."""
    words = text.encode("utf-8", "replace").split()
    if not words:
        return text
    g, n = zlib.crc32(str(doc_id).encode()) // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    tail = (unit * (-(-(n - a) // p)))[: n - a]
    return b" ".join(words[:a] + tail).decode()


def with_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which a tenth of the documents, by their id, have a repeated tail."""

    @F.pandas_udf("string")
    def edit(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([repeat_tail(int(i), t) if t is not None else None for i, t in zip(ids, texts, strict=True)])

    doc_id = docs["doc_id"].cast("long")
    chosen = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    edited = edit(F.coalesce(doc_id, F.lit(0)), F.when(chosen, docs["text"]))
    return docs.select(doc_id.alias("doc_id"), F.coalesce(edited, docs["text"]).alias("text"))


def highest_run(runs: Column) -> Column:
    """The run of the greatest length / period (ties: smallest start, then period), NULL without runs.

    Of runs ordered by start and period a later one wins only if its exponent is greater.
    """
    return F.reduce(
        runs,
        F.get(runs, 0),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_tails(table(spark, sf_dir, "documents")))
    best = highest_run(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(lines, "\n"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aligned = alignment.align(docs, bpe.default_path("byte_bpe_50k.json"), bpe.default_path("piece_bpe_32k.model"))
    found = alignment.linked(aligned)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    narrow = found.withColumn("groups_sha256", digest).drop("groups")
    return alignment.with_rare_links(narrow, aligned).drop("row")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_token_counts": op2_token_counts,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_lm_scores": op5_lm_scores,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_near_dedup": op10_near_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_toxicity": op12_toxicity,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {}
