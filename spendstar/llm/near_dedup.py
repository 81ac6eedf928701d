"""Near-duplicate classes of documents by BagMinHash bands and verified overlap.

Two texts are linked if their multisets of five-word shingles have a weighted
Jaccard similarity of at least ``THRESHOLD``; a class is a connected component of
the links. Candidates are texts that agree in a band of a BagMinHash signature
(:mod:`spendstar.llm.bagminhash`): with 25 bands of 5 components a pair at the
threshold is found with probability 0.99995.

1. One pass over whole texts makes signatures and a 128-bit digest of the multiset.
   Equal digests are one *node* from here on, so a group of copies, however large,
   is one row.
2. In every bucket (nodes that share a band's key) all nodes are compared with the
   bucket's centre only: the node whose own buckets are largest in sum, usually the
   original of a group of edited copies. The comparisons are dealt by centre and
   salted, so a centre with very many partners is spread over tasks.
3. Links found so far join nodes to components. Buckets whose nodes lie in more than
   one component are searched for the missing links: pairs of different components
   whose first common band is the bucket's are compared exactly if their sizes, and
   the counts of their elements by bin, do not rule the threshold out. Links inside a component are
   not needed; of those between components one is enough. Large buckets are cut
   into blocks and each pair of blocks is a task of its own.
4. Components of all links give the classes. Only links, never all pairs, are
   written; nothing but counts reaches the driver.

Defined cases: a NULL text counts as empty; empty texts are copies of each other;
a text of fewer than five words is one shingle; repeated rows are copies; the
document that stays is the one with the smallest id (NULL ids last, then by a
hash of the text), exactly one row of each class; an empty table gives no rows;
other columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm import bagminhash as bag
from spendstar.llm.common import prepare

THRESHOLD = 0.8
# Partners of a centre that are compared in one task.
PER_TASK = 512
# Bytes of texts whose shingles are signed at once.
PART_BYTES = 1 << 20
# Nodes of a block of a large bucket.
BLOCK = 2048
# Bins of the counts that bound from above how many elements two multisets share.
BIN_BITS = 8
NO_ID = (1 << 63) - 1

_HASHES: list[bag.WordHashes] = []


def _hashes() -> bag.WordHashes:
    if not _HASHES:
        _HASHES.append(bag.WordHashes())
    return _HASHES[0]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    )


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch whose working arrays are bounded: few texts, and few bytes beside a single long text."""
    column = batch.schema.get_field_index("text")
    lo = size = 0
    for hi, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if hi > lo and (size + n > PART_BYTES or hi - lo == bag.MOST_TEXTS):
            yield batch.slice(lo, hi - lo), batch.column(column).slice(lo, hi - lo).to_pylist()
            lo, size = hi, 0
        size += n
    if batch.num_rows:
        yield batch.slice(lo), batch.column(column).slice(lo).to_pylist()


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, id, key, digest, bands) of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for batch in batches:
            for part, texts in _parts(batch):
                n = len(texts)
                owner, h = bag.shingles(texts, hashes)
                high, low = bag.digests(n, *bag.expanded(owner, h))
                values = bag.signatures(n, *bag.counted(owner, h))
                keys = bag.band_keys(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.array([f"{a:016x}{b:016x}" for a, b in zip(high.tolist(), low.tolist(), strict=True)]),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), bag.BANDS).cast(
                            pa.list_(pa.int64())
                        ),
                    ],
                    names=["doc_id", "id", "key", "digest", "bands"],
                )

    return _keyed(docs).mapInArrow(
        sign, "doc_id long, id long, key long, digest string, bands array<long>"
    )


def _bags(rows: DataFrame) -> DataFrame:
    """(node, elements) of rows (node, text): the sorted elements of the multiset, as bytes; a task makes one a node."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        made: set[int] = set()
        for batch in batches:
            # the join brings a text's repeated rows to one task (or few): one bag each is enough
            new = []
            for k, node in enumerate(batch.column(0).to_pylist()):
                if node not in made:
                    made.add(node)
                    new.append(k)
            for part, texts in _parts(batch.take(pa.array(new, pa.int64())) if len(new) < batch.num_rows else batch):
                owner, h = bag.expanded(*bag.shingles(texts, hashes))
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                out = [h[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out, pa.binary())], names=["node", "elements"]
                )

    return rows.select("node", "text").mapInArrow(make, "node long, elements binary")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): equal labels in a connected component.

    Each round points every node to its smallest neighbour, joins the pointers to
    those found before and contracts the links; links inside a component vanish.
    """
    spark = links.sparkSession
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    left = links.select("a", "b").where("a != b").distinct().checkpoint()
    labels = None
    while not left.isEmpty():
        step = (
            left.select(both.alias("l"))
            .groupBy(F.col("l.a").alias("node"))
            .agg(F.min("l.b").alias("least"))
            .select("node", F.least("node", "least").alias("label"))
            .checkpoint()
        )
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = (
                labels.join(moved, "label", "left")
                .select("node", F.coalesce("to", "label").alias("label"))
                .checkpoint()
            )
        a = step.select(F.col("node").alias("a"), F.col("label").alias("la"))
        b = step.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        left = (
            left.join(a, "a")
            .join(b, "b")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .where("a != b")
            .distinct()
            .checkpoint()
        )
    if labels is None:
        return spark.createDataFrame([], "node long, label long")
    return labels


def _compare_with_centre(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between a centre and the partners dealt to this task."""
    found = []
    centre = rows["centre"].iloc[0]
    own = rows.loc[rows["node"] == centre, "elements"]
    if len(own):
        c = np.frombuffer(own.iloc[0], np.uint64)
        for node, elements in zip(rows["node"], rows["elements"], strict=True):
            if node != centre and bag.similarity(c, np.frombuffer(elements, np.uint64)) >= THRESHOLD:
                found.append((min(node, centre), max(node, centre)))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64").drop_duplicates()


def _search_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different components among the nodes of a bucket's block or pair of blocks."""
    rows = rows.drop_duplicates("node").sort_values("node")
    bucket = rows["bucket"].iloc[0]
    nodes = rows["node"].to_numpy()
    bands = np.stack(rows["bands"].to_numpy())
    sets = [np.frombuffer(e, np.uint64) for e in rows["elements"]]
    sizes = np.array([len(s) for s in sets])
    bins = np.empty((len(sets), 1 << BIN_BITS), np.int32)
    for k, s in enumerate(sets):
        bins[k] = np.bincount((s >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS)
    block = rows["block"].to_numpy()
    cross = rows["x"].iloc[0] != rows["y"].iloc[0]
    band = int(np.flatnonzero(bands[0] == bucket)[0])
    labels, group = np.unique(rows["label"].to_numpy(), return_inverse=True)
    group = group.copy()
    found = []
    for i in range(len(nodes) - 1):
        rest = slice(i + 1, None)
        maybe = group[rest] != group[i]
        if cross:
            maybe &= block[rest] != block[i]
        small, large = np.minimum(sizes[rest], sizes[i]), np.maximum(sizes[rest], sizes[i])
        maybe &= small >= THRESHOLD * large
        at = np.flatnonzero(maybe) + i + 1
        if band and len(at):
            at = at[~(bands[at, :band] == bands[i, :band]).any(axis=1)]
        if len(at):
            # a bin's smaller count bounds what the two share there
            most = np.concatenate([np.minimum(bins[at[k : k + 128]], bins[i]).sum(axis=1) for k in range(0, len(at), 128)])
            at = at[most * (1 + THRESHOLD) >= THRESHOLD * (sizes[at] + sizes[i]) - 1e-6]
        for j in at:
            if group[i] != group[j] and bag.similarity(sets[i], sets[j]) >= THRESHOLD:
                group[group == group[j]] = group[i]
                found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _nodes(rows: DataFrame) -> DataFrame:
    """One row per digest: node (a number), the row that stands for it, bands, copies."""
    return (
        rows.groupBy("digest")
        .agg(
            F.min_by(F.struct("id", "key", "bands"), F.struct("id", "key")).alias("r"),
            F.count("*").alias("copies"),
        )
        .select(F.monotonically_increasing_id().alias("node"), "digest", "r.*", "copies")
        .checkpoint()
    )


def find_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the nodes of each class."""
    members = nodes.select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = members.join(shared, "bucket").checkpoint()
    busy = members.groupBy("node").agg(F.sum("size").alias("busy"))
    centres = (
        members.join(busy, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("busy", (-F.col("node")).alias("node"))).alias("m"))
        .select("bucket", (-F.col("m.node")).alias("centre"))
    )
    partners = (
        members.join(centres, "bucket").where("node != centre").select("node", "centre").distinct()
    ).checkpoint()

    texts = (
        nodes.join(busy.select("node"), "node", "left_semi")
        .select("node", "id", "key")
        .join(_keyed(docs).select("id", "key", "text"), ["id", "key"])
    )
    bags = _bags(texts).checkpoint()

    counts = partners.groupBy("centre").agg(F.ceil(F.count("*") / PER_TASK).alias("tasks"))
    dealt = partners.join(counts, "centre").select(
        "node", "centre", F.pmod(F.xxhash64("node"), F.col("tasks")).alias("task")
    )
    own = counts.select(
        F.col("centre").alias("node"),
        "centre",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"),
    )
    first = (
        dealt.unionByName(own)
        .join(bags, "node")
        .groupBy("centre", "task")
        .applyInPandas(_compare_with_centre, "a long, b long")
    ).checkpoint()

    labels = components(first)
    known = members.join(labels, "node", "left").select(
        "bucket", "node", "size", F.coalesce("label", "node").alias("label")
    )
    open_buckets = (
        known.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo != hi")
        .select("bucket")
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # the pairs of blocks that have this one; a pair of equal blocks only if there is just one,
    # or beside another: inside pairs of a block are searched in its own task
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("block")).alias("x"), F.greatest(o, F.col("block")).alias("y")),
    )
    tasks = (
        known.join(open_buckets, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("pair", F.explode(pairs))
        .select("bucket", "node", "label", "block", "pair.x", "pair.y")
        .join(nodes.select("node", "bands"), "node")
        .join(bags, "node")
    )
    second = tasks.groupBy("bucket", "x", "y").applyInPandas(_search_block, "a long, b long")
    return first.unionByName(second)


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, id, key, digest) and classes by digest: (digest, class_id, keep_key, copies, ...)."""
    prepare(docs.sparkSession)
    rows = signed(docs).checkpoint()
    nodes = _nodes(rows)
    labels = components(find_links(docs, nodes))
    named = nodes.join(labels, "node", "left").select(
        "digest", "id", "key", "copies", F.coalesce("label", "node").alias("label")
    )
    whole = named.groupBy("label").agg(
        F.min(F.struct("id", "key")).alias("first"),
        F.sum("copies").alias("class_rows"),
        F.count("*").alias("class_texts"),
    )
    by_digest = named.join(whole, "label").select(
        "digest",
        F.col("first.id").alias("class_id"),
        F.col("first.key").alias("class_key"),
        "copies",
        "class_rows",
        "class_texts",
    )
    return rows.select("doc_id", "id", "key", "digest"), by_digest


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, class_id (its smallest id), copies, class_rows, class_texts, kept."""
    rows, by_digest = classes(docs)
    return rows.join(by_digest, "digest").select(
        "doc_id",
        F.when(F.col("class_id") != NO_ID, F.col("class_id")).alias("class_id"),
        ((F.col("id") == F.col("class_id")) & (F.col("key") == F.col("class_key"))).alias("kept"),
        "copies",
        "class_rows",
        "class_texts",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class, its own columns."""
    rows, by_digest = classes(docs)
    stay = (
        rows.join(by_digest, "digest")
        .where("id = class_id and key = class_key")
        .groupBy("id", "key")
        .agg(F.count("*").alias("times"))
    )
    whole = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("key"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    ).join(stay, ["id", "key"])
    once = whole.where("times = 1").select("row.*")
    again = whole.where("times > 1").groupBy("id", "key").agg(F.first("row").alias("row")).select("row.*")
    return once.unionByName(again)
