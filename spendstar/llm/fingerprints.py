"""SimHash fingerprints of documents with DataFrame functions only.

Terms are pairs of neighbouring words (white-space separated; the last word pairs
with nothing), so every non-blank text has a term. Each occurrence of a term
votes with its 64-bit hash, weighted by the length of its first word: for every
bit the weights of terms that have it set are summed, and the fingerprint's bit
is 1 if they outweigh the rest. Votes for bits b and b+32 are summed in one
64-bit number, in lanes of 32 bits; the weights of a text add up to less than its
number of characters, which Spark bounds below 2**31, so lanes never overflow.

The terms of a document are exploded, hashed and summed in the task that holds
the document; only the documents are shuffled.

:func:`within_radius` finds all pairs of distinct fingerprints that differ in at
most ``radius`` bits. The 64 bits are cut into ``blocks``; two fingerprints that
differ in r bits agree in at least ``blocks - r`` blocks, so each choice of that
many blocks is a table keyed by those blocks, and one of the tables has any such
pair under one key. A pair is taken from the first table that has it.

Defined cases: a NULL text is the empty text; a text without words has the
fingerprint of sixteen zeros; equal texts have equal fingerprints; repeated rows
each give a row; ids that are NULL come first in the order; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendstar.llm.common import id_splits, prepare, range_of, shuffle_parts

BITS = 64
LANES = 32
RANGES_PER_PARTITION = 4

# Search: radius and number of blocks the fingerprint is cut into.
RADIUS = 3
BLOCKS = 6


def simhash(df: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` plus a fingerprint column (long) per entry of ``texts`` (name -> text column).

    ``keys`` must tell rows apart. Where ``df`` is already partitioned by some of
    them, nothing is shuffled.
    """
    words = df.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("which"), F.split(F.trim(F.col(c)), r"\s+").alias("w"))
                    for k, c in enumerate(texts.values())
                ]
            )
        ).alias("t"),
    ).select(*keys, F.col("t.which").alias("__which"), F.col("t.w").alias("__w"))
    pairs = words.select(
        *keys,
        "__which",
        F.explode(F.arrays_zip(F.col("__w"), F.expr("slice(__w, 2, size(__w))").alias("__n"))).alias(
            "__pair"
        ),
    )
    first = F.col("__pair").getField("__w")
    second = F.col("__pair").getField("__n")
    votes = pairs.select(
        *keys,
        "__which",
        F.xxhash64(first, second).alias("__h"),
        F.length(first).cast("long").alias("__weight"),
    )
    lane_mask = F.lit((1 << LANES) | 1)
    sums = [
        F.sum(
            F.shiftrightunsigned("__h", b).bitwiseAND(lane_mask) * F.col("__weight")
        ).alias(f"__v{b}")
        for b in range(LANES)
    ]
    voted = votes.groupBy(*keys, "__which").agg(F.sum("__weight").alias("__all"), *sums)
    low_mask = F.lit((1 << LANES) - 1)
    bits = F.lit(0).cast("long")
    for b in range(LANES):
        low = F.col(f"__v{b}").bitwiseAND(low_mask)
        high = F.shiftrightunsigned(f"__v{b}", LANES)
        bits = bits.bitwiseOR(F.when(low * 2 > F.col("__all"), F.lit(1 << b)).otherwise(F.lit(0)))
        top = 1 << (b + LANES)
        top = top - (1 << 64) if top >= 1 << 63 else top
        bits = bits.bitwiseOR(F.when(high * 2 > F.col("__all"), F.lit(top)).otherwise(F.lit(0)))
    prints = voted.select(*keys, "__which", bits.alias("__bits"))
    return prints.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("__which") == k, F.col("__bits"))).alias(name)
            for k, name in enumerate(texts)
        ]
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def with_next(docs: DataFrame) -> DataFrame:
    """Whole texts beside the text of the next document by ascending ``doc_id``.

    Documents are dealt into ranges of ``doc_id``; the first documents of each
    range are also dealt, marked, to the range before it (those of the first
    non-empty range to the last), so that a range finds every next document by
    itself. Columns: ``__range``, ``__row`` (number in the range, marked rows
    last), ``__extra``, doc_id, text, next_text.
    """
    parts = RANGES_PER_PARTITION * shuffle_parts(docs.sparkSession)
    base = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    splits = id_splits(base, "doc_id", parts)
    ranged = base.withColumn("__range", range_of(F.col("doc_id"), splits))
    # one row per range
    heads = ranged.groupBy("__range").agg(
        F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("head")
    )
    ends = sorted((r["__range"], r["head"]) for r in heads.collect())
    before = {ends[i][0]: (ends[i - 1][0], i == 0) for i in range(len(ends))}
    n = len(splits) + 1
    head_of, range_before, wraps = [None] * n, [0] * n, [False] * n
    for k, head in ends:
        head_of[k] = head
        range_before[k], wraps[k] = before[k]

    def at(values: list, kind: str) -> Column:
        items = F.array(*[F.lit(v).cast(kind) for v in values]) if n < 64 else F.lit(values)
        return F.element_at(items.cast(f"array<{kind}>"), F.col("__range") + 1)

    head_of = [h if h is not None else 0 for h in head_of]
    is_head = F.coalesce("doc_id", F.lit(-(1 << 63))) == at(head_of, "bigint")
    own = F.struct(F.col("__range").alias("r"), F.lit(0).alias("x"))
    again = F.struct(at(range_before, "int").alias("r"), F.when(at(wraps, "boolean"), 2).otherwise(1).alias("x"))
    dealt = ranged.select(
        "doc_id",
        "text",
        F.explode(F.when(is_head, F.array(own, again)).otherwise(F.array(own))).alias("__to"),
    ).select("doc_id", "text", F.col("__to.r").alias("__range"), F.col("__to.x").alias("__extra"))
    # the text decides between rows of one id
    order = Window.partitionBy("__range").orderBy(
        "__extra", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"
    )
    return dealt.select(
        "__range",
        F.row_number().over(order).alias("__row"),
        "__extra",
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next_text"),
    )


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by the first of the next text."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(next_text, F.lit(1), cut))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, bits, edited_bits, next_bits (longs)."""
    prepare(docs.sparkSession)
    rows = with_next(docs).withColumn(
        "edited", F.coalesce(edited(F.col("text"), F.col("next_text")), F.col("text"))
    )
    keyed = rows.select(
        "__range",
        "__row",
        "__extra",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "text",
        "edited",
    )
    keys = ["__range", "__row", "__extra", "doc_id", "n_chars", "edited_sha256"]
    prints = simhash(keyed, keys, {"bits": "text", "edited_bits": "edited"})
    order = Window.partitionBy("__range").orderBy("__row")
    return (
        prints.withColumn("next_bits", F.lead("bits").over(order))
        .where("__extra = 0")
        .drop("__range", "__row", "__extra")
    )


def within_radius(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b) for all distinct values a < b of ``prints`` (column ``bits``) within ``radius`` bits.

    ``prints`` must hold each value once. Columns ``a`` and ``b`` are longs.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("the radius must be below the number of blocks")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        m = ((1 << (hi - lo)) - 1) << lo
        masks.append(m)
    tables = []
    for chosen in combinations(range(blocks), blocks - radius):
        m = sum(masks[k] for k in chosen)
        tables.append(m - (1 << 64) if m >= 1 << 63 else m)
    permuted = prints.select(
        F.col("bits"),
        F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m).cast("long")) for m in tables])),
    ).select(F.col("pos").alias("tab"), F.col("col").alias("key"), "bits")
    left = permuted.withColumnRenamed("bits", "a")
    right = permuted.withColumnRenamed("bits", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    # the first table whose blocks all agree
    first = F.lit(len(tables))
    for k in range(len(tables) - 1, -1, -1):
        first = F.when(differ.bitwiseAND(F.lit(tables[k]).cast("long")) == 0, k).otherwise(first)
    found = left.join(
        right,
        (left["tab"] == right["tab"])
        & (left["key"] == right["key"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(differ) <= radius)
        & (first == left["tab"]),
    )
    return found.select("a", "b")


def near_counts(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(bits, n_equal, n_near): rows with the same fingerprint, and with another within the radius.

    ``prints`` has one row per document; equal fingerprints are counted first, so
    a group of copies is one entry of the tables.
    """
    groups = prints.groupBy("bits").agg(F.count("*").alias("n_equal")).checkpoint()
    links = within_radius(groups, radius, blocks)
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.a", "l.b")
    sizes = groups.select(F.col("bits").alias("b"), F.col("n_equal").alias("n"))
    near = both.join(sizes, "b").groupBy(F.col("a").alias("bits")).agg(F.sum("n").alias("n_near"))
    return groups.join(near, "bits", "left").select(
        "bits", "n_equal", F.coalesce("n_near", F.lit(0)).alias("n_near")
    )
