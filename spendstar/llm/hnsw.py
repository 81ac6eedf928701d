"""Approximate nearest neighbours by one navigable small-world graph per shard.

Equal vectors are one entry, with the ids that share it (the smallest ``k + 1``
are all that a result of ``k`` can need), so a very common vector is one node of
a graph. Distinct vectors are dealt to shards by hash, about ``PER_SHARD`` each. A
shard's hierarchical graph is built in its task by inserting its vectors one after
another, and is stored as one row of flat arrays: vectors, levels, and for each
level the neighbours of each node, -1 for none. Queries are dealt in blocks of at
most ``QUERY_BLOCK``; each block meets each shard's row once, and the shards' best
are merged per query.

Distances are Euclidean in double precision on the original vectors.

Defined cases: vectors that are NULL, empty, zero or hold NULL, NaN or infinite
components take no part, nor do rows without an id; vectors of another length
than the most frequent one take no part; of rows with one id and equal vectors
one takes part; ties go to the smaller id; fewer candidates than ``k`` give all of
them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendstar.llm.common import prepare

PER_SHARD = 3_000
QUERY_BLOCK = 1_024
DEGREE = 12  # neighbours of a node on upper levels; twice as many on the lowest
BUILD_WIDTH = 40
SEARCH_WIDTH = 80
TOP_LEVEL = 6


class Graph:
    """Flat arrays of one shard: vectors (n, d), level of each node, neighbours by level."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.levels, self.links = vectors, levels, links
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.entry = int(levels.argmax()) if len(levels) else -1

    def distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        d = self.vectors[nodes] - query
        return np.einsum("ij,ij->i", d, d)

    def search_level(
        self, query: np.ndarray, starts: list[tuple[float, int]], level: int, width: int
    ) -> list[tuple[float, int]]:
        """The ``width`` nearest found from ``starts`` on one level, nearest first."""
        links = self.links[level]
        seen = np.zeros(len(self.levels), bool)
        seen[[n for _, n in starts]] = True
        todo = list(starts)
        heapq.heapify(todo)
        best = [(-d, n) for d, n in starts]
        heapq.heapify(best)
        while todo:
            d, node = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            for dn, n in zip(self.distances(query, near).tolist(), near.tolist(), strict=True):
                if len(best) < width:
                    heapq.heappush(best, (-dn, n))
                    heapq.heappush(todo, (dn, n))
                elif dn < -best[0][0]:
                    heapq.heapreplace(best, (-dn, n))
                    heapq.heappush(todo, (dn, n))
        return sorted((-d, n) for d, n in best)

    def search(self, query: np.ndarray, k: int, width: int) -> list[tuple[float, int]]:
        """About the ``k`` nearest nodes as (squared distance, node)."""
        if self.entry < 0:
            return []
        at = [(float(self.distances(query, np.array([self.entry]))[0]), self.entry)]
        for level in range(int(self.levels[self.entry]), 0, -1):
            at = self.search_level(query, at, level, 1)
        found = self.search_level(query, at, 0, max(width, k))
        if len(found) < k and len(found) < len(self.levels):
            # parts of the graph were not reached: look at the rest as well
            rest = np.setdiff1d(np.arange(len(self.levels)), [n for _, n in found])
            found = sorted(found + list(zip(self.distances(query, rest).tolist(), rest.tolist(), strict=True)))
        return found[:k]


def _choose(graph: Graph, found: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours in different directions: nearer to the node than to one chosen before."""
    if len(found) <= 1:
        return [n for _, n in found]
    nodes = [n for _, n in found]
    x, norms = graph.vectors[nodes], graph.norms[nodes]
    apart = norms[:, None] + norms[None, :] - 2 * (x @ x.T)
    to_kept = np.full(len(nodes), np.inf)
    kept, passed = [], []
    for i, (d, n) in enumerate(found):
        if len(kept) == most:
            break
        if to_kept[i] > d:
            kept.append(n)
            np.minimum(to_kept, apart[i], out=to_kept)
        else:
            passed.append(n)
    return kept + passed[: most - len(kept)]


def build(vectors: np.ndarray, seed: int = 11) -> Graph:
    """Insert all vectors one after another."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / np.log(DEGREE)).astype(np.int64), TOP_LEVEL)
    top = int(levels.max()) if n else 0
    links = [np.full((n, DEGREE * (2 if lv == 0 else 1)), -1, np.int32) for lv in range(top + 1)]
    graph = Graph(vectors, levels, links)
    if not n:
        return graph
    graph.entry, high = 0, int(levels[0])
    for node in range(1, n):
        query, own = vectors[node], int(levels[node])
        at = [(float(graph.distances(query, np.array([graph.entry]))[0]), graph.entry)]
        for level in range(high, own, -1):
            at = graph.search_level(query, at, level, 1)
        for level in range(min(high, own), -1, -1):
            at = graph.search_level(query, at, level, BUILD_WIDTH)
            near = links[level]
            chosen = _choose(graph, at, DEGREE)
            near[node, : len(chosen)] = chosen
            for other in chosen:
                free = np.flatnonzero(near[other] < 0)
                if len(free):
                    near[other, free[0]] = node
                    continue
                ring = np.append(near[other], node)
                d = graph.distances(vectors[other], ring)
                order = np.argsort(d, kind="stable")
                keep = _choose(graph, [(float(d[i]), int(ring[i])) for i in order], near.shape[1])
                near[other] = -1
                near[other, : len(keep)] = keep
        if own > high:
            graph.entry, high = node, own
    graph.entry = int(levels.argmax())
    return graph


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part; v is an array of doubles."""
    v = vectors[vector_col].cast("array<double>")
    return vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


_INDEX = "shard int, n long, width int, vectors binary, ids binary, ends binary, levels binary, links binary"


def build_index(rows: DataFrame, k: int, per_shard: int = PER_SHARD) -> DataFrame:
    """One row per shard with its graph; ``rows`` are (vec_id, v). Vectors of one length share shards."""
    # -0.0 + 0.0 = 0.0: equal vectors have equal bits
    rows = rows.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()
    # the k + 1 smallest ids of a vector, first within a part of its rows
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    first = rows.withColumn("part", part).withColumn(
        "r", F.row_number().over(Window.partitionBy("v", "part").orderBy("vec_id"))
    ).where(F.col("r") <= k + 1)
    owners = (
        first.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
        .where(F.col("r") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .checkpoint()
    )
    width = F.size("v")
    # a row per length of vectors
    sizes = owners.groupBy(width.alias("width")).agg(F.ceil(F.count("*") / per_shard).alias("shards"))

    def make(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.assign(lead=[int(i[0]) for i in batch["ids"]]).sort_values("lead")
        vectors = np.stack([np.asarray(v, np.float64) for v in batch["v"]])
        ids = [np.asarray(i, np.int64) for i in batch["ids"]]
        graph = build(vectors)
        return pd.DataFrame(
            {
                "shard": [int(batch["shard"].iloc[0])],
                "n": [len(batch)],
                "width": [vectors.shape[1]],
                "vectors": [vectors.tobytes()],
                "ids": [np.concatenate(ids).tobytes()],
                "ends": [np.cumsum([len(i) for i in ids]).astype(np.int64).tobytes()],
                "levels": [graph.levels.tobytes()],
                "links": [b"".join(level.tobytes() for level in graph.links)],
            }
        )

    shard = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    placed = owners.withColumn("width", width).join(F.broadcast(sizes), "width").withColumn("shard", shard)
    return placed.select("width", "shard", "v", "ids").groupBy("width", "shard").applyInPandas(make, _INDEX)


def load_graph(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph of an index row, the ids of all nodes and where each node's ids end."""
    n, width = int(row["n"]), int(row["width"])
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, width)
    levels = np.frombuffer(row["levels"], np.int64)
    flat, at, links = np.frombuffer(row["links"], np.int32), 0, []
    for level in range(int(levels.max()) + 1):
        degree = DEGREE * (2 if level == 0 else 1)
        links.append(flat[at : at + n * degree].reshape(n, degree))
        at += n * degree
    return Graph(vectors, levels, links), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = SEARCH_WIDTH,
    per_shard: int = PER_SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of each query.

    ``is_query`` is a condition on ``vec_id``; a query's own id is no candidate.
    """
    prepare(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    index = build_index(rows, k, per_shard).checkpoint()
    queries = rows.where(is_query).distinct()
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    marked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # each block goes to each shard of vectors of its queries' length
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = (
        marked.withColumn("width", F.size("v"))
        .join(F.broadcast(index.groupBy("width").agg(F.collect_set("shard").alias("numbers"))), "width")
        .select("vec_id", "v", "block", "width", F.explode("numbers").alias("shard"))
    )

    def search(key, shard_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard_rows) and len(asked):
            graph, ids, ends = load_graph(shard_rows.iloc[0])
            for query_id, v in zip(asked["vec_id"], asked["v"], strict=True):
                v = np.asarray(v, np.float64)
                own = []
                # one more than k: the query itself may be among them
                for d, node in graph.search(v, k + 1, width):
                    for i in ids[ends[node - 1] if node else 0 : ends[node]].tolist():
                        if i != query_id:
                            own.append((int(query_id), float(np.sqrt(d)), i))
                own.sort(key=lambda r: (r[1], r[2]))
                out.extend(own[:k])
        return pd.DataFrame(out, columns=["query_id", "score", "vec_id"]).astype(
            {"query_id": "int64", "score": "float64", "vec_id": "int64"}
        )

    found = (
        left.groupBy("width", "shard", "block")
        .cogroup(right.groupBy("width", "shard", "block"))
        .applyInPandas(search, "query_id long, score double, vec_id long")
    )
    # one id may stand on several rows with different vectors: the nearest counts
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
