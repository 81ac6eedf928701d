"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Tokens are the words of the text (lower-cased A-Z, split at ASCII white space) and
one end. All training texts are counted: words exactly, and pairs of neighbouring
tokens by a 64-bit key. A count c is kept as its level 1 + floor(log_b c), less the
levels below it that hold no whole number, and the filter holds an n-gram of level q as the q items (n-gram, 1) ... (n-gram, q):
its level is read back by probing for 1, 2, ... until an item is missing, so a
count is never read too low, and too high with small probability.

The filter holds every word and every pair, those seen once too. Its size follows the
corpus: the items are counted, and it has ``ITEM_BITS`` bits for each, in segments
of about ``SEGMENT_BITS``; all bits of an n-gram lie in one segment, which one task
fills. The ``PROBES`` bits of an item lie in one block of as many 32-bit words, one in
each word, so a look-up reads one line of memory. Inside a segment an n-gram goes by 32 bits of its key (a segment has far fewer
n-grams than that tells apart). Texts are read in chunks of about ``CHUNK`` tokens. A
filter of at most ``HELD_BITS`` is sent to the workers, which look up a chunk's distinct
keys in it; of a larger one no process holds more than a segment: the distinct keys of
a chunk go to their segments, and the levels come back to the chunk. Both read the same
bits and give the same scores.

    P(w | h) = c(hw) / (c(h) + A) + A / (c(h) + A) * (c(w) + 1) / (N + V + 1)

(every token is followed by one, so h's pairs sum to c(h)); a document's score is the sum of log10 P over
its tokens. The add-one base score uses exact counts: those of the most frequent
words (at most ``FREQUENT``, 16 bytes each) are broadcast, the other words of each
document are joined with the table of counts.

Defined cases: a NULL text is the empty text, one end token; NULL ids are training
rows; repeated rows each count and are scored; with no training row N and V are 0
and every token is unknown; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm.common import prepare
from spendstar.session import scratch_path

END = b"\n"  # no word holds a line break
SEGMENT_BITS = 1 << 22
HELD_BITS = 1 << 30
PROBES = 8
ITEM_BITS = 12
_BLOCK = 32 * PROBES  # bits
BASE = 2.0**0.5
ADDED = 8.0
FREQUENT = 1 << 19
CHUNK = 1 << 19
_KIND = {"word": 1, "pair": 2}
_SEED = 42  # Spark's
MOST_LEVELS = 128
_FLUSH = 4_000_000
_READ = 1 << 15  # keys looked up at a time
_DEALT = 1_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _C1
    z = (z ^ (z >> np.uint64(27))) * _C2
    return z ^ (z >> np.uint64(31))


def tokens(text: bytes) -> list[bytes]:
    """Words of a text (bytes fold and split in ASCII only), and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def _hashed(words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of words (a table of them is slower: most of it lies outside the CPU's caches)."""
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words, repeat(_SEED)), np.uint64, len(words))


def pair_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys of each token with the one before it (a text's first token: with an end)."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[starts] = _hashed([END])
    return (_mix(before) & ~_LOW) | (_mix(h + _GOLD) >> np.uint64(32))


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    counts: Counter = Counter()
    for batch in batches:
        for text in _texts(batch, 0):
            counts.update(tokens(text))
        if len(counts) > 600_000:
            yield flush(counts)
            counts.clear()
    yield flush(counts)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if keys:
            pair, n = np.unique(np.concatenate(keys), return_counts=True)
            for lo in range(0, len(pair), 100_000):
                part = slice(lo, lo + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[part].view(np.int64)), pa.array(n[part].astype(np.int64))],
                    names=["pair", "n"],
                )

    keys: list[np.ndarray] = []
    held = 0
    for batch in batches:
        words: list[bytes] = []
        starts = []
        for text in _texts(batch, 0):
            starts.append(len(words))
            words.extend(tokens(text))
        if words:
            keys.append(pair_keys(_hashed(words), np.array(starts)))
            held += len(words)
        if held > _FLUSH:
            yield from flush(keys)
            keys, held = [], 0
    yield from flush(keys)


def _bounds(power: int) -> tuple[int, int]:
    """The least and greatest whole number from ``BASE ** power`` to below the next power."""
    return math.ceil(BASE**power - 1e-6), math.ceil(BASE ** (power + 1) - 1e-6) - 1


# powers of the base from which to the next no whole number lies
_EMPTY = [p for p in range(MOST_LEVELS) if _bounds(p)[0] > _bounds(p)[1]]


def level(count: Column) -> Column:
    """Level of a count that is at least 1."""
    power = F.floor(F.log(count) / math.log(BASE) + 1e-9)
    q = 1 + power
    for p in _EMPTY:
        q = q - F.when(power > p, 1).otherwise(0)
    return F.least(q, F.lit(MOST_LEVELS)).cast("int")


def _values() -> np.ndarray:
    """The count that each level stands for (0: none): the middle of its whole numbers, in logarithms."""
    powers = [p for p in range(MOST_LEVELS + len(_EMPTY)) if p not in _EMPTY][:MOST_LEVELS]
    return np.array([0.0, *[math.sqrt(math.prod(_bounds(p))) for p in powers]])


VALUES = _values()


def segment_of(key: np.ndarray, segments: int) -> np.ndarray:
    return (((_mix(key ^ _C1) >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int32)


def _short(key: np.ndarray) -> np.ndarray:
    """What names an item key inside its segment."""
    return (key & _LOW).astype(np.uint32)


def _by_segment(key: np.ndarray, segments: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of item keys by segment, and (segment, from, to) of each run in it."""
    segment = segment_of(key, segments)
    order = np.argsort(segment, kind="stable")
    numbers, cuts = np.unique(segment[order], return_index=True)
    return order, list(zip(numbers.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True))


def _item(mixed: np.ndarray, q: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks, inside their segment, of the items (short key as ``_mix`` gives it, q), and what their bits follow from."""
    z = _mix(mixed + np.uint64(q) * _GOLD)
    block = ((z >> np.uint64(32)) * np.uint64(bits // _BLOCK)) >> np.uint64(32)
    return block.astype(np.int64), (z & _LOW).astype(np.uint32)


with np.errstate(over="ignore"):
    _SALTS = (_mix(np.arange(1, PROBES + 1, dtype=np.uint64) * _GOLD) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def typed_key(key: np.ndarray, kind: str) -> np.ndarray:
    """Item key of a word hash or pair key."""
    return _mix(key + np.uint64(_KIND[kind]) * _GOLD)


def read_levels(data: np.ndarray, bits: int, short: np.ndarray, segment: np.ndarray | None = None) -> np.ndarray:
    """Levels of items (short keys) by probing 1, 2, ... until an item is missing.

    ``data`` are the 64-bit words of one segment, or of all segments one after another, ``segment`` then says
    which one an item belongs to.
    """
    blocks = data.reshape(-1, _BLOCK // 64)
    out = np.zeros(len(short), np.uint8)
    with np.errstate(over="ignore"):
        for lo in range(0, len(short), _READ):
            part = slice(lo, lo + _READ)
            mixed = _mix(short[part].astype(np.uint64))
            first = None if segment is None else segment[part].astype(np.int64) * (bits // _BLOCK)
            alive = np.arange(len(mixed))
            for q in range(1, MOST_LEVELS + 1):
                if not len(alive):
                    break
                block, z = _item(mixed, q, bits)
                # each of the block's words, moved so that the item's bit in it is the lowest
                held = blocks.take(block if first is None else block + first, axis=0).view(np.uint32)
                held >>= np.multiply.outer(z, _SALTS) >> np.uint32(27)
                hit = np.flatnonzero(np.bitwise_and.reduce(held, axis=1) & np.uint32(1))
                alive, mixed = alive[hit], mixed[hit]
                first = None if first is None else first[hit]
                out[lo + alive] = q
    return out


@dataclass
class Filter:
    """The filter as rows (segment, data) of ``segments`` segments with ``bits`` bits each."""

    rows: DataFrame
    segments: int
    bits: int

    def held(self) -> np.ndarray:
        """All segments, one after another."""
        size = self.bits // 64
        out = np.zeros(self.segments * size, np.uint64)
        for r in self.rows.toLocalIterator():
            out[r["segment"] * size : (r["segment"] + 1) * size] = np.frombuffer(r["data"], np.uint64)
        return out

    def counts(self, key: np.ndarray, kind: str) -> np.ndarray:
        """Counts of a few n-grams, read on the driver, segment by segment."""
        with np.errstate(over="ignore"):
            typed = typed_key(key, kind)
            segment = segment_of(typed, self.segments)
        out = np.zeros(len(key))
        for r in self.rows.where(F.col("segment").isin(np.unique(segment).tolist())).toLocalIterator():
            at = np.flatnonzero(segment == r["segment"])
            out[at] = VALUES[read_levels(np.frombuffer(r["data"], np.uint64), self.bits, _short(typed[at]))]
        return out


def build_filter(words: DataFrame, pairs: DataFrame) -> Filter:
    """The filter of all word counts (word hash ``h``, ``c``) and pair counts (``pair``, ``c``)."""
    items = None
    for kind, df, key in (("word", words, "h"), ("pair", pairs, "pair")):
        part = df.select(F.col(key).alias("key"), F.lit(_KIND[kind]).alias("kind"), level(F.col("c")).alias("q"))
        items = part if items is None else items.unionByName(part)
    wanted = (items.agg(F.sum("q")).first()[0] or 0) * ITEM_BITS
    segments = max(1, math.ceil(wanted / SEGMENT_BITS))
    bits = _BLOCK * max(1, math.ceil(wanted / segments / _BLOCK))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Short keys and levels of many items at a time, by segment."""

        def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            key, q = (np.concatenate(x) for x in zip(*held, strict=True))
            order, runs = _by_segment(key, segments)
            short, q = _short(key)[order], q[order]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in runs], pa.int32()),
                    pa.array([short[lo:hi].tobytes() for _, lo, hi in runs], pa.binary()),
                    pa.array([q[lo:hi].tobytes() for _, lo, hi in runs], pa.binary()),
                ],
                names=["segment", "short", "q"],
            )

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            key, kind, q = (c.to_numpy() for c in batch.columns)
            with np.errstate(over="ignore"):
                key = _mix(key.view(np.uint64) + kind.astype(np.uint64) * _GOLD)
            held.append((key, q.astype(np.uint8)))
            rows += len(key)
            if rows > _DEALT:
                yield flush(held)
                held, rows = [], 0
        if rows:
            yield flush(held)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bits of each segment; its items come one run after another."""

        def done(segment: int, filled: np.ndarray) -> pa.RecordBatch:
            packed = np.packbits(filled, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], names=["segment", "data"])

        held, filled = -1, np.zeros(0, bool)
        for batch in batches:
            for segment, short, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != held:
                    if held >= 0:
                        yield done(held, filled)
                    held, filled = segment, np.zeros(bits, bool)
                short, q = np.frombuffer(short, np.uint32), np.frombuffer(q, np.uint8)
                with np.errstate(over="ignore"):
                    mixed = _mix(short.astype(np.uint64))
                    for least in range(1, int(q.max()) + 1):
                        block, z = _item(mixed[q >= least], least, bits)
                        for k, salt in enumerate(_SALTS):
                            filled[block * _BLOCK + 32 * k + ((z * salt) >> np.uint32(27))] = True
        if held >= 0:
            yield done(held, filled)

    rows = (
        items.mapInArrow(deal, "segment int, short binary, q binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(fill, "segment int, data binary")
    )
    return Filter(_written(rows, "lm-filter"), segments, bits)


@dataclass
class Model:
    """Counts of the training tokens, and what is broadcast to score texts."""

    words: DataFrame  # word, c, h
    total: int
    distinct: int
    filter: Filter
    frequent: object  # broadcast (sorted hashes, counts)
    frequent_from: int


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from Parquet in the shared folder (a checkpoint's rows are several times larger).

    The shuffles that led to it are not needed again: Spark may remove them at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def train(texts: DataFrame) -> Model:
    """Count the texts of a DataFrame with a ``text`` column."""
    spark: SparkSession = texts.sparkSession
    prepare(spark)
    text = texts.select(F.coalesce(texts["text"], F.lit("")).alias("text"))
    words = _written(
        text.mapInArrow(_count_words, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("c"))
        .withColumn("h", F.xxhash64("word")),
        "lm-words",
    )
    pairs = _written(
        text.mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("c")),
        "lm-pairs",
    )
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # the smallest count from which words number at most FREQUENT
    cut, seen = 1, 0
    for r in sorted(words.groupBy(level(F.col("c")).alias("q")).agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).collect(), key=lambda r: -r["q"]):
        if seen + r["n"] > FREQUENT:
            cut = r["hi"] + 1
            break
        seen += r["n"]
    top = words.where(F.col("c") >= cut).select("h", "c").toArrow()  # at most FREQUENT rows
    h = top["h"].to_numpy().view(np.uint64) if top.num_rows else np.zeros(0, np.uint64)
    c = top["c"].to_numpy() if top.num_rows else np.zeros(0, np.int64)
    order = np.argsort(h)
    sc = spark.sparkContext
    return Model(
        words,
        int(sums["n"]),
        int(sums["v"]),
        build_filter(words, pairs),
        sc.broadcast((h[order], c[order])),
        int(cut),
    )


_ROWS = "doc_id long, n_tokens long, known long, base double, rare array<binary>"
_COLUMNS = [f.split() for f in _ROWS.split(", ")]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype(np.int32).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.int32)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    total, distinct = model.total, model.distinct
    sent_frequent = model.frequent
    segments, bits = model.filter.segments, model.filter.bits
    scale = float(total + distinct + 1)

    def read(ids: list, starts: list[int], words: list[bytes]) -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, int]:
        """A chunk's documents without their scores, item keys (words, then pairs), sides and pair of each token."""
        keys, counts = sent_frequent.value
        start = np.array(starts)
        ends = np.append(start[1:], len(words))
        h = _hashed(words)
        with np.errstate(over="ignore"):
            word, back = np.unique(h, return_inverse=True)
            # a token's probability follows from its pair: computed once for each
            pair, of_pair = np.unique(pair_keys(h, start), return_inverse=True)
            asked = np.concatenate([typed_key(word, "word"), typed_key(pair, "pair")])
        # the token before: the one to the left, for a text's first token an end
        left = np.concatenate([back[-1:], back[:-1]])
        left[start] = back[-1]
        some_at = np.empty(len(pair), np.int64)  # a place of each pair: all its places have the same sides
        some_at[of_pair] = np.arange(len(h))
        at = np.searchsorted(keys, word)
        at[at == len(keys)] = 0
        frequent = keys[at] == word if len(keys) else np.zeros(len(word), bool)
        exact = np.where(frequent, counts[at] if len(keys) else 0, 0)
        known, base = frequent[back], np.where(frequent, np.log10((exact + 1) / scale), 0.0)[back]
        rare_at = np.flatnonzero(~known)
        rare = [words[i] for i in rare_at.tolist()]
        cut = np.searchsorted(rare_at, np.append(start, len(words)))
        fields = [
            pa.array(ids, pa.int64()),
            pa.array(ends - start, pa.int64()),
            pa.array(np.add.reduceat(known.astype(np.int64), start)),
            pa.array(np.add.reduceat(base, start)),
            pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(rare, pa.binary())),
        ]
        return fields, asked, np.concatenate([left[some_at], back[some_at]]), of_pair, len(word)

    def sums(found: np.ndarray, sides: np.ndarray, of_pair: np.ndarray, n_words: int, lengths: np.ndarray) -> np.ndarray:
        """Scores of a chunk's documents from the counts of its words and pairs."""
        of_word, c_pair = found[:n_words], found[n_words:]
        c_before, c_word = of_word[sides[: len(c_pair)]], of_word[sides[len(c_pair) :]]
        # no pair is seen more often than its first token
        c_pair = np.minimum(c_pair, c_before)
        p = c_pair / (c_before + ADDED) + ADDED / (c_before + ADDED) * (c_word + 1) / scale
        logs = np.log10(np.minimum(p, 1.0))[of_pair]
        return np.add.reduceat(logs, np.cumsum(lengths) - lengths)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids: list = []
        starts: list[int] = []
        words: list[bytes] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch, 1), strict=True):
                ids.append(doc_id)
                starts.append(len(words))
                words.extend(tokens(text))
                if len(words) >= CHUNK:
                    yield read(ids, starts, words)
                    ids, starts, words = [], [], []
        if words:
            yield read(ids, starts, words)

    def rate_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = sent_filter.value
        for fields, asked, sides, of_pair, n_words in chunks(batches):
            with np.errstate(over="ignore"):
                segment = segment_of(asked, segments)
            found = VALUES[read_levels(data, bits, _short(asked), segment)]
            score = sums(found, sides, of_pair, n_words, fields[1].to_numpy())
            yield pa.RecordBatch.from_arrays([*fields, pa.array(score)], names=[*[n for n, _ in _COLUMNS], "score"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a chunk: the documents, and the distinct keys to look up, by segment."""

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        for fields, asked, sides, of_pair, n_words in chunks(batches):
            with np.errstate(over="ignore"):
                order, runs = _by_segment(asked, segments)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            short = _short(asked)[order]
            asks = [pa.array([r[0] for r in runs], pa.int32()), pa.array([short[lo:hi].tobytes() for _, lo, hi in runs], pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [
                    one(pa.StructArray.from_arrays(fields, names=[n for n, _ in _COLUMNS])),
                    one(pa.StructArray.from_arrays(asks, names=["segment", "data"])),
                    pa.array([n_words]),
                    pa.array([len(asked) - n_words]),
                    pa.array([_packed(of_pair)], pa.binary()),
                    pa.array([_packed(sides)], pa.binary()),
                    pa.array([_packed(place)], pa.binary()),
                ],
                names=["docs", "asks", "words", "pairs", "of_pair", "sides", "place"],
            )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Levels for the keys of each chunk; a segment's bits come before what is asked of it."""
        held, data = -1, None
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for segment, number, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != held:
                    held, data = segment, np.zeros(bits // 64, np.uint64)
                if number < 0:
                    data = np.frombuffer(blob, np.uint64)
                else:
                    out.append((number, segment, read_levels(data, bits, np.frombuffer(blob, np.uint32)).tobytes()))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                    names=["chunk", "segment", "data"],
                )

    def rate(asked: pa.Table, answers: pa.Table) -> pa.Table:
        row = {n: asked.column(n)[0].as_py() for n in ("words", "pairs", "of_pair", "sides", "place")}
        docs = asked.column("docs").combine_chunks()
        docs = (docs.chunk(0) if isinstance(docs, pa.ChunkedArray) else docs).flatten()
        lengths = docs.field("n_tokens").to_numpy()
        n_words, n_pairs = row["words"], row["pairs"]
        by_segment = np.argsort(answers.column("segment").to_numpy())
        blobs = answers.column("data").to_pylist()
        found = VALUES[np.frombuffer(b"".join([blobs[i] for i in by_segment.tolist()]), np.uint8)]
        found = found[_unpacked(row["place"], n_words + n_pairs)]
        of_pair = _unpacked(row["of_pair"], int(lengths.sum()))
        scores = sums(found, _unpacked(row["sides"], 2 * n_pairs), of_pair, n_words, lengths)
        return pa.table([*docs.flatten(), pa.array(scores)], names=[*[n for n, _ in _COLUMNS], "score"])

    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    if segments * bits <= HELD_BITS:
        sent_filter = docs.sparkSession.sparkContext.broadcast(model.filter.held())
        rated = texts.mapInArrow(rate_held, f"{_ROWS}, score double")
    else:
        asked = (
            texts.mapInArrow(
                ask,
                f"docs array<struct<{', '.join(f'{n}: {t}' for n, t in _COLUMNS)}>>, "
                "asks array<struct<segment: int, data: binary>>, "
                "words long, pairs long, of_pair binary, sides binary, place binary",
            )
            .withColumn("chunk", F.monotonically_increasing_id())
            .checkpoint()
        )
        answers = (
            model.filter.rows.select("segment", F.lit(-1).cast("long").alias("chunk"), "data")
            .unionByName(asked.select("chunk", F.inline("asks")))
            .repartition("segment")
            .sortWithinPartitions("segment", "chunk")
            .mapInArrow(look_up, "chunk long, segment int, data binary")
        )
        rated = (
            asked.drop("asks")
            .groupBy("chunk")
            .cogroup(answers.groupBy("chunk"))
            .applyInArrow(rate, f"{_ROWS}, score double")
        )
    rated = rated.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    # words beyond the broadcast ones: joined with their exact counts, summed by row
    rare = (
        rated.select("row", F.explode("rare").alias("word"))
        .join(model.words.select("word", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(scale))).alias("rare_base"),
            F.count("c").alias("rare_known"),
        )
    )
    return rated.join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
