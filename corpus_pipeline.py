"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``. ``run`` applies them to the
``documents`` table. Texts, identifiers and sites are those of the row itself;
only the quality stage reads a second table, ``labels``, to fit its classifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import bpe, langid, near_dedup, packing, quality
from spendstar.llm.common import prepare, table
from spendstar.session import scratch_path

# A text whose best language has less of its letters than this is rejected; with more
# than four languages, each has less, and so the bound (see least_language_score).
LEAST_LANGUAGE_SCORE = 0.4
SEQUENCE = 2048
END_ID = 1


def least_language_score(languages: int) -> float:
    """The bound for a number of learned languages: 0.4 up to four, then by the root of their number."""
    return LEAST_LANGUAGE_SCORE * min(1.0, (4 / max(languages, 1)) ** 0.5)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no text, no letter, or no clear winner."""
    prepare(spark)
    model = langid.fit(docs, F.lit(True))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        langid.language_column(model, docs["text"]).alias("found"),
    )
    kept = rows.where(
        (F.col("found.lang_pred") != langid.UNDETERMINED)
        & (F.col("found.score") >= least_language_score(len(model.languages)))
    )
    return kept.select("row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose posterior of good quality is below one half."""
    return quality.keep_accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    prepare(spark)
    return packing.pack(docs, bpe.default_path("byte_bpe_50k.json"), SEQUENCE, END_ID)


STAGES = [
    ("language_id", identify_language),
    ("quality", classify_quality),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

# Learned models and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
