"""Token counts by a two-tier lookup, without shuffling pre-tokens.

Tier 1 is a table of the most frequent pieces and their token numbers, broadcast
to all workers; its size is bounded by ``FREQUENT`` entries of at most
``bpe.MAX_CACHED_CHARS`` characters (under 16 MB). It is found in one pass over
all texts: each task counts its own pieces in a bounded counter and passes on
only its ``PER_TASK`` most frequent. Tier 2 encodes the other pieces through a
cache that lives in each Python worker. Which pieces are in either tier changes
the speed, never the counts.

Defined cases: a NULL text counts as empty (0 bytes, 0 tokens); repeated rows
each give a row; an empty table gives no rows; columns other than ``doc_id`` and
``text`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import bpe
from spendstar.llm.common import prepare

FREQUENT = 65_536
PER_TASK = 16_384
COUNTER_LIMIT = 600_000
CACHE_LIMIT = 500_000

_CACHES: dict = {}


def _prune(counts: Counter, keep: int) -> Counter:
    return Counter(dict(counts.most_common(keep)))


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(text.split(" ")[1:])
        if len(counts) > COUNTER_LIMIT:
            counts = _prune(counts, COUNTER_LIMIT // 2)
    top = [(w, n) for w, n in counts.most_common(PER_TASK) if 0 < len(w) <= bpe.MAX_CACHED_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        names=["piece", "n"],
    )


def frequent_pieces(texts: DataFrame, size: int = FREQUENT) -> list[str]:
    """At most ``size`` of the most frequent pieces of all texts (bounded list)."""
    rows = (
        texts.mapInArrow(_count_pieces, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(size)
        .collect()
    )
    return [r["piece"] for r in rows]


def length_table(pieces: list[str], tokenizer) -> dict[str, int]:
    """Token number of each piece after a blank."""
    enc = tokenizer.encode_batch([" " + p for p in pieces], add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, enc, strict=True)}


def _worker_cache(path: str, key: str, table: dict[str, int]) -> bpe.PieceCache:
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = bpe.PieceCache(bpe.load(path), len, CACHE_LIMIT, table)
    return _CACHES[key]


def count_tokens(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text"))
    tokenizer = bpe.load(path)
    table = length_table(frequent_pieces(texts, frequent), tokenizer)
    sent = spark.sparkContext.broadcast(table)
    specials = bpe.special_strings(tokenizer)
    key = f"{path} {id(sent)} {len(table)}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _worker_cache(path, key, sent.value)
        pattern = bpe.special_pattern(specials)
        for batch in batches:
            n_tokens = []
            for text in batch.column(2).to_pylist():
                n = 0
                for plain, special in bpe.cut_specials(text, specials, pattern):
                    n += sum(cache.values_of(plain)) + (special is not None)
                n_tokens.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    ).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
