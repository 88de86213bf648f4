"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The tree is fitted on the `FIT_ROWS` vectors with the smallest hashes of their ids; every vector is then put into its leaf. A query
walks the tree with a priority queue: the node whose centre has the largest inner product with it comes first, and a node taken from
the queue puts its children in. It visits the first leaves that come out.

How many is calibrated: for `CALIBRATION_QUERIES` queries, the true neighbours among all vectors are found by brute force, and the leaves are widened until
`TARGET_RECALL` of them lie in visited leaves. Scores are exact: inner products of the original vectors in double precision, summed component by component, so
that equal vectors have equal scores.

How it runs: the tree goes to the tasks with their code; it has at most `BRANCH` ^ `DEPTH` leaves. A large leaf's vectors are dealt
into parts of about `PART_ROWS`, the queries that visit it into blocks of about `QUERY_ROWS`. Each (leaf, part, block) is a task's group of bounded size, and the best
of all are merged by query.

Defined results: rows with a null id, a null, empty or zero vector, or a null or non-finite component take no part; rows equal in id and
vector are one. Rows of equal id with different vectors each take part: the result has the best pairs with other ids of all an id's vectors. Each length of
vectors has a tree of its own, since only vectors of one length have a product. Equal scores go to the smaller id. Queries visit further leaves
until these hold k other vectors, so that with fewer candidates than k all are returned. Without queries or candidates the result is empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_sample, ship, stash
from .vectors import best, matrix, merge_best, usable

K = 20
FIT_ROWS = 16_384
BRANCH, DEPTH = 8, 3
LEAF_ROWS = 64
PART_ROWS = 16_384
QUERY_ROWS = 2048
ROUNDS = 12
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.95
NO_ID = np.iinfo(np.int64).max


@dataclass
class Tree:
    """Nodes by number: the centre and the children of each; a node without children is a leaf with a number of its own."""

    centres: np.ndarray
    children: list[list[int]]
    leaf_no: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf_no) + 1

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at each node, the child with the nearest centre."""
        out = np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_no[node]
                continue
            near = _nearest(vectors[rows], self.centres[kids])
            waiting += [(kid, rows[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return out

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """The leaves in the order in which they leave the priority queue."""
        reach = (self.centres @ query).tolist()
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                yield self.leaf_no[node]
            for kid in kids:
                heapq.heappush(queue, (-reach[kid], kid))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (vectors @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)


def fit_tree(sample: np.ndarray, branch: int = BRANCH, depth: int = DEPTH, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Split by k-means from the top; a node of few rows, at the last level, or of equal rows stays a leaf."""
    rng = np.random.default_rng(0)
    tree = Tree(np.zeros((0, sample.shape[1])), [[]], [-1])
    centres = [sample.mean(axis=0)]
    waiting = [(0, 0, sample)]
    while waiting:
        node, level, rows = waiting.pop(0)
        kinds = np.unique(rows, axis=0) if level < depth and len(rows) > leaf_rows else rows[:0]
        if len(kinds) < 2:
            tree.leaf_no[node] = tree.leaves
            continue
        means = kinds[rng.choice(len(kinds), min(branch, len(kinds)), replace=False)]
        for _ in range(ROUNDS):
            near = _nearest(rows, means)
            means = np.stack([rows[near == i].mean(axis=0) if (near == i).any() else m for i, m in enumerate(means)])
        near = _nearest(rows, means)
        for i, m in enumerate(means):
            kid = len(tree.children)
            tree.children[node].append(kid)
            tree.children.append([])
            tree.leaf_no.append(-1)
            centres.append(m)
            waiting.append((kid, level + 1, rows[near == i] if (near == i).any() else rows[:0]))
    tree.centres = np.stack(centres)
    return tree


def inner(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component in order."""
    out = np.zeros((len(queries), len(vectors)))
    for x, y in zip(queries.T, vectors.T, strict=True):
        out += x[:, None] * y
    return out


def _best_of(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), NO_ID, np.int64)
    for i in range(0, len(queries), 256):
        for j in range(0, len(vectors), 4096):
            q, v = slice(i, i + 256), slice(j, j + 4096)
            got = inner(queries[q], vectors[v])
            rivals = np.broadcast_to(ids[v], got.shape)
            got = np.where(rivals == query_ids[q][:, None], -np.inf, got)
            scores[q], found[q] = merge_best(scores[q], found[q], got, np.where(got == -np.inf, NO_ID, rivals), k)
    return scores, found


@dataclass
class Index:
    """The tree, the indexed rows (vec_id, vec, leaf) and the rows of each leaf."""

    tree: Tree
    rows: DataFrame
    sizes: np.ndarray


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> list[Index]:
    """For each length of vectors: a tree fitted on a bounded sample, and every usable row in it."""
    ship(vectors.sparkSession)
    rows = stash(usable(vectors, id_col, vec_col, nonzero=True).distinct(), "ann-vectors")
    lengths = [r[0] for r in rows.select(F.size("vec")).distinct().orderBy(F.size("vec")).collect()]  # a row for each length
    return [_build(rows.filter(F.size("vec") == d)) for d in lengths]


def _build(rows: DataFrame) -> Index:
    tree = fit_tree(np.array(hash_sample(rows, FIT_ROWS, "vec_id", "vec").toPandas()["vec"].tolist()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.leaf_of(matrix(b.column(1))) if b.num_rows else np.array([], np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf.astype(np.int32))], names=["vec_id", "vec", "leaf"])

    rows = stash(rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("leaf", T.IntegerType())])), "ann-index")
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, n in rows.groupBy("leaf").count().collect():  # a row for each leaf
        sizes[leaf] = n
    return Index(tree, rows, sizes)


def leaves_to_visit(index: Index, is_query: Column, k: int = K, target: float = TARGET_RECALL) -> int:
    """How many leaves hold `target` of the true neighbours, for a sample of the queries against all rows."""
    sample = hash_sample(index.rows.filter(is_query), CALIBRATION_QUERIES, "vec_id", seed=1).toPandas()
    if not len(sample):
        return 1
    queries, query_ids = np.array(sample["vec"].tolist()), sample["vec_id"].to_numpy()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task keeps the best of all its batches, and sends those.
        scores, found = np.full((len(queries), k), -np.inf), np.full((len(queries), k), NO_ID, np.int64)
        leaves = np.zeros((len(queries), k), np.int32)
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
            s, f = _best_of(queries, query_ids, matrix(b.column(1)), ids, k)
            order = np.argsort(ids, kind="stable")
            at = order[np.searchsorted(ids[order], np.where(f == NO_ID, ids[order[0]], f))]
            s, f, x = (np.concatenate(pair, axis=1) for pair in ((scores, s), (found, f), (leaves, leaf[at])))
            first = np.lexsort((f, -s), axis=1)[:, :k]
            scores, found, leaves = (np.take_along_axis(y, first, axis=1) for y in (s, f, x))
        q, at = np.nonzero(found != NO_ID)
        cols = [query_ids[q], found[q, at], scores[q, at], leaves[q, at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["query_id", "vec_id", "score", "leaf"])

    found = index.rows.mapInArrow(near, "query_id long, vec_id long, score double, leaf int")
    true = best(found, k, F.col("score"), "leaf").select("query_id", "leaf").toPandas()  # at most k rows for each of the sample
    place = {q: {leaf: i for i, leaf in enumerate(index.tree.best_bins(v))} for q, v in zip(query_ids, queries, strict=True)}
    needed = np.sort([place[q][leaf] + 1 for q, leaf in zip(true["query_id"], true["leaf"], strict=True)])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) if len(needed) else 1


def _groups(index: Index, is_query: Column, visits: int, k: int) -> DataFrame:
    """(leaf, part, block, is_query, vec_id, vec): a leaf's vectors once for each block of its queries, and these once for each of its parts."""
    tree, sizes = index.tree, index.sizes

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = []
            for q in matrix(b.column(1)):
                held, seen = 0, []
                for n, leaf in enumerate(tree.best_bins(q)):
                    if n >= visits and held > k:
                        break
                    held += sizes[leaf]
                    if sizes[leaf]:
                        seen.append(leaf)
                leaves.append(seen)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["vec_id", "vec", "leaves"])

    queries = index.rows.filter(is_query).select("vec_id", "vec")
    routed = T.StructType([*queries.schema.fields, T.StructField("leaves", T.ArrayType(T.IntegerType()))])
    queries = stash(queries.mapInArrow(route, routed), "ann-queries").select(F.explode("leaves").alias("leaf"), "vec_id", "vec")
    visitors = np.zeros(tree.leaves, np.int64)
    for leaf, n in queries.groupBy("leaf").count().collect():  # a row for each leaf
        visitors[leaf] = n

    def of_leaf(counts: np.ndarray) -> Column:
        return F.element_at(F.array(*map(F.lit, counts.tolist())), F.col("leaf") + 1)

    def dealt(seed: int, counts: Column) -> Column:
        return F.pmod(F.xxhash64("vec_id", "vec", F.lit(seed)), counts.cast("long")).cast("int")

    def each(counts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), counts.cast("int") - 1))

    parts, blocks = of_leaf(np.maximum(1, -(-sizes // PART_ROWS))), of_leaf(np.maximum(1, -(-visitors // QUERY_ROWS)))
    visited = index.rows.filter(of_leaf(visitors) > 0)
    held = visited.select("leaf", dealt(0, parts).alias("part"), each(blocks).alias("block"), F.lit(False).alias("is_query"), "vec_id", "vec")
    queries = queries.select("leaf", each(parts).alias("part"), dealt(1, blocks).alias("block"), F.lit(True).alias("is_query"), "vec_id", "vec")
    return held.unionByName(queries)


def search(index: Index, is_query: Column, visits: int, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of every indexed row with `is_query` (over vec_id), in its first `visits` leaves."""

    def run(group: pa.Table) -> pa.Table:
        q, v = group.filter(group["is_query"]), group.filter(pa.compute.invert(group["is_query"]))
        if not len(q) or not len(v):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        ids = q["vec_id"].to_numpy()
        scores, found = _best_of(matrix(q["vec"]), ids, matrix(v["vec"]), v["vec_id"].to_numpy(), k)
        kept = found != NO_ID
        return pa.table({"query_id": np.broadcast_to(ids[:, None], found.shape)[kept], "vec_id": found[kept], "score": scores[kept]})

    found = _groups(index, is_query, visits, k).groupBy("leaf", "part", "block").applyInArrow(run, "query_id long, vec_id long, score double")
    return best(found, k, F.col("score"))


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", target: float = TARGET_RECALL) -> DataFrame:
    """Build, calibrate and search."""
    found = [search(index, is_query, leaves_to_visit(index, is_query, k, target), k) for index in build(vectors, id_col, vec_col)]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if len(found) == 1:
        return found[0]
    # An id may have vectors of several lengths.
    return best(reduce(DataFrame.unionByName, found).drop("rank"), k, F.col("score"))
