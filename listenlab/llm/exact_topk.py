"""Exact top-k by integer inner product: ball trees per shard, searched by branch and bound.

Each component x becomes floor(scale * x). A shard's vectors form a ball tree; a node with centre c and radius r holds no vector
whose product with q is above q.c + |q| r. A query visits leaves in the order of that bound, and stops at the first whose bound is
below its kth score so far.

How it runs: vectors are cut by space, along planes fitted on the `FIT_ROWS` vectors with the smallest hashes, into cells of about `SHARD_ROWS`, and a cell that
holds more (a common vector) into parts by hash. Each part is a shard; its ball tree is built once and written. The queries of a cell make blocks of about `QUERY_ROWS`, with a ball of their own.
First each block searches a shard of its own cell. Its kth scores are then shared: a shard is searched for a block only if the bound of the two balls
reaches the smallest of them, and the tree is searched for those that reach each query's. A (block, shard) pair is one row of bounded size;
balls are compared in as many lanes as there are partitions. The best of all are merged by query. Nothing but the sample and a row for each cell comes to the driver.

Defined results: rows with a null id, a null or empty vector, or a null or non-finite component take no part; rows equal in id and vector
are one. Rows of equal id with different vectors each take part: the result has the best pairs with other ids of all an id's vectors. Equal scores go to the smaller id. A query with fewer candidates than k returns all. Vectors of another length than
the query's are no candidates. Without queries or candidates the result is empty. Extra columns take no part. Products are exact while their
size stays below 2^53, in double precision; larger ones are computed with Python's integers and clipped to a long.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import hash_sample, ship, stash
from .vectors import best, matrix, merge_best, usable

K = 20
SCALE = 64
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF = 256
FIT_ROWS = 16_384
#: Rows of the sample for each cell, at least.
LEAST_SAMPLE = 16
ROUNDS = 8
NO_ID = np.iinfo(np.int64).max


class BallTree:
    """A ball tree kept as its levels: the nodes of a level, then the leaves with their rows."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.vectors = vectors
        groups = [np.arange(len(vectors))]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # centres, radii, the parent of each node
        parents = np.zeros(1, np.int64)
        while True:
            centres = np.stack([vectors[g].mean(axis=0) for g in groups])
            radii = np.array([np.sqrt(((vectors[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centres, strict=True)])
            self.levels.append((centres, radii, parents))
            if max(map(len, groups)) <= leaf:
                break
            halves, parents = [], []
            for i, (g, c) in enumerate(zip(groups, centres, strict=True)):
                if len(g) <= leaf:
                    halves.append(g)
                    parents.append(i)
                    continue
                # Along the line between two far points, cut at the median, so that equal points are cut too.
                a = vectors[g[((vectors[g] - c) ** 2).sum(axis=1).argmax()]]
                b = vectors[g[((vectors[g] - a) ** 2).sum(axis=1).argmax()]]
                order = np.argsort(vectors[g] @ (b - a), kind="stable")
                halves += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
                parents += [i, i]
            groups, parents = halves, np.array(parents)
        self.leaves = groups

    def bounds(self, queries: np.ndarray, at_least: np.ndarray) -> np.ndarray:
        """The upper bound of each query in each leaf; -inf below a node whose bound doesn't reach `at_least`."""
        norms = np.sqrt((queries**2).sum(axis=1))
        above = np.full((len(queries), 1), np.inf)
        for centres, radii, parents in self.levels:
            own = queries @ centres.T + norms[:, None] * radii
            own += 1e-9 * (np.abs(own) + 1)  # rounding must not hide an equal score
            above = np.minimum(above[:, parents], own)
            above[above < at_least[:, None]] = -np.inf
        return above


def products(queries: np.ndarray, vectors: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; in double precision if all of them are below 2^53."""
    if exact:
        return queries @ vectors.T
    big = np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in v] for v in vectors], object).T
    return np.clip(big, -(2**63), 2**63 - 1)


def search(tree: BallTree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, at_least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of each query among those of at least `at_least`; empty places have NO_ID."""
    n = len(queries)
    largest = np.sqrt((tree.vectors**2).sum(axis=1).max()) * np.sqrt((queries**2).sum(axis=1).max())
    exact = bool(largest < 2**52)
    scores = np.full((n, k), -np.inf, float if exact else object)
    found = np.full((n, k), NO_ID, np.int64)
    bounds = tree.bounds(queries, at_least)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = at_least.copy()
    for step in range(order.shape[1]):
        leaf = order[:, step]
        reach = bounds[np.arange(n), leaf]
        open_ = np.flatnonzero((reach >= kth) & (reach > -np.inf))
        if not len(open_):
            break
        for x in np.unique(leaf[open_]):
            q = open_[leaf[open_] == x]
            rows = tree.leaves[x]
            got = products(queries[q], tree.vectors[rows], exact)
            rivals = np.broadcast_to(ids[rows], got.shape)
            got = np.where(rivals == query_ids[q][:, None], -np.inf, got)
            scores[q], found[q] = merge_best(scores[q], found[q], got, np.where(got == -np.inf, NO_ID, rivals), k)
            top = scores[q][:, k - 1].astype(float)
            kth[q] = np.maximum(kth[q], top if exact else top - 1e-9 * np.abs(top))
    return scores, found


_INT, _LONG, _DOUBLE, _BYTES = T.IntegerType(), T.LongType(), T.DoubleType(), T.BinaryType()
_VECTOR = T.ArrayType(_DOUBLE)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SHARD = _schema(dim=_INT, cell=_INT, part=_INT, centre=_VECTOR, radius=_DOUBLE, tree=_BYTES)
BLOCK = _schema(dim=_INT, cell=_INT, block=_INT, home=_INT, centre=_VECTOR, radius=_DOUBLE, norm=_DOUBLE, queries=_BYTES)
HITS = _schema(hits=T.ArrayType(_schema(query_id=_LONG, vec_id=_LONG, score=_LONG)))
BOUNDS = _schema(kth=_BYTES, least=_DOUBLE)


@dataclass
class Cells:
    """Space cut by planes: vectors whose product with a node's direction is at most its cut go left; a node without children is a cell."""

    directions: list[np.ndarray]
    cuts: list[float]
    children: list[tuple[int, int] | None]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector: the number of its node."""
        out = np.zeros(len(vectors), np.int32)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            kids = self.children[node]
            if kids is None or not len(rows):
                out[rows] = node
                continue
            left = vectors[rows] @ self.directions[node] <= self.cuts[node]
            waiting += [(kids[0], rows[left]), (kids[1], rows[~left])]
        return out


def fit_cells(sample: np.ndarray, cells: int) -> Cells:
    """Cut the cell of most rows between two means, until there are `cells`; equal vectors stay together."""
    out = Cells([np.zeros(0)], [0.0], [None])
    heap = [(-len(sample), 0, sample)]
    made = 1
    while heap and made < cells:
        n, node, rows = heapq.heappop(heap)
        a = rows[((rows - rows.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        b = rows[((rows - a) ** 2).sum(axis=1).argmax()]
        for _ in range(ROUNDS):
            left = rows @ (b - a) <= (b - a) @ (a + b) / 2
            if left.all() or not left.any():
                break
            a, b = rows[left].mean(axis=0), rows[~left].mean(axis=0)
        along, cut = rows @ (b - a), float((b - a) @ (a + b) / 2)
        if not along.min() <= cut < along.max():
            continue
        out.directions[node], out.cuts[node], out.children[node] = b - a, cut, (len(out.cuts), len(out.cuts) + 1)
        for kid in (rows[along <= cut], rows[along > cut]):
            heapq.heappush(heap, (-len(kid), len(out.cuts), kid))
            out.directions.append(np.zeros(0))
            out.cuts.append(0.0)
            out.children.append(None)
        made += 1
    return out


def _ball(vectors: np.ndarray) -> tuple[list[float], float]:
    centre = vectors.mean(axis=0)
    return centre.tolist(), float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max()))


def _placed(rows: DataFrame, k: int) -> DataFrame:
    """`rows` (vec_id, vec, is_query) with dim, cell, and the parts and blocks of the cell."""
    sizes = dict(rows.groupBy(F.size("vec")).count().collect())  # a row for each length of vectors
    sample = hash_sample(rows, FIT_ROWS, "vec_id", "vec").toPandas()["vec"]
    cells = {}
    for d, n in sizes.items():
        own = np.array([v for v in sample if len(v) == d])
        cells[d] = fit_cells(own, min(-(-n // SHARD_ROWS), -(-len(own) // LEAST_SAMPLE))) if len(own) else Cells([np.zeros(0)], [0.0], [None])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dim = pa.compute.list_value_length(b.column(1)).to_numpy(zero_copy_only=False).astype(np.int32)
            cell = np.zeros(b.num_rows, np.int32)
            for d in np.unique(dim):
                own = np.flatnonzero(dim == d)
                cell[own] = cells[int(d)].of(matrix(b.column(1).take(pa.array(own))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dim), pa.array(cell)], names=["vec_id", "vec", "is_query", "dim", "cell"])

    rows = stash(rows.mapInArrow(place, "vec_id long, vec array<double>, is_query boolean, dim int, cell int"), "topk-placed")
    count = rows.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q"))
    count = count.select("dim", "cell", F.ceil(F.col("n") / SHARD_ROWS).alias("parts"), F.greatest(F.ceil(F.col("q") / QUERY_ROWS), F.lit(1)).alias("blocks"))
    # Written, so that its size is known when the rows are joined to it: a small table then goes to the rows.
    return rows.join(stash(count, "topk-cells"), ["dim", "cell"])


@dataclass
class Index:
    """Shards (dim, cell, part, centre, radius, tree) and query blocks (dim, cell, block, home, centre, radius, norm, queries)."""

    shards: DataFrame
    blocks: DataFrame


def build(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> Index:
    """Cut the usable rows by space and write each shard's tree and each block's queries once."""
    ship(vectors.sparkSession)
    rows = usable(vectors, id_col, vec_col)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double"))).distinct()
    placed = _placed(stash(rows.withColumn("is_query", F.coalesce(is_query, F.lit(False))), "topk-vectors"), k)
    by_hash = lambda seed, n: F.pmod(F.xxhash64("vec_id", "vec", F.lit(seed)), F.col(n)).cast("int")

    def shard(key: tuple, group: pa.Table) -> pa.Table:
        vecs, ids = matrix(group["vec"]), group["vec_id"].to_numpy()
        row = {n: [x.as_py()] for n, x in zip(("dim", "cell", "part"), key, strict=True)}
        row["centre"], row["radius"] = ([x] for x in _ball(vecs))
        return _table(row | {"tree": [pickle.dumps((BallTree(vecs), ids))]}, SHARD)

    def block(key: tuple, group: pa.Table) -> pa.Table:
        vecs, ids = matrix(group["vec"]), group["vec_id"].to_numpy()
        row = {n: [x.as_py()] for n, x in zip(("dim", "cell", "block", "home"), key, strict=True)}
        row["centre"], row["radius"] = ([x] for x in _ball(vecs))
        return _table(row | {"norm": [float(np.sqrt((vecs**2).sum(axis=1).max()))], "queries": [pickle.dumps((vecs, ids))]}, BLOCK)

    dealt = placed.withColumn("part", by_hash(0, "parts"))
    # Dealt by part, so that a cell of many parts is not one task.
    dealt = dealt.select("dim", "cell", "part", "vec_id", "vec").repartition("dim", "cell", "part")
    shards = stash(dealt.groupBy("dim", "cell", "part").applyInArrow(shard, SHARD), "topk-shards")
    asked = placed.filter("is_query").withColumn("block", by_hash(1, "blocks")).withColumn("home", (F.col("block") % F.col("parts")).cast("int"))
    # A small part may have got no row; then the block starts from any bound.
    asked = asked.select("dim", "cell", "block", "home", "vec_id", "vec").repartition("dim", "cell", "block", "home")
    blocks = stash(asked.groupBy("dim", "cell", "block", "home").applyInArrow(block, BLOCK), "topk-blocks")
    return Index(shards, blocks)


def _table(columns: dict, schema: T.StructType) -> pa.Table:
    return pa.table(columns, schema=to_arrow_schema(schema))


def _search_rows(rows: DataFrame, k: int, first: bool) -> DataFrame:
    """Search each row's tree for its queries: hits, and for the `first` search the queries' kth scores and the least of them."""
    out = T.StructType([*(f for f in rows.schema if f.name not in ("tree", "kth", *(() if first else ("queries",)))), *HITS])
    if first:
        out = T.StructType([*out, *BOUNDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                queries, query_ids = pickle.loads(row["queries"])
                kth = np.full(len(queries), -np.inf) if first else np.frombuffer(row["kth"])
                scores, found = np.zeros((len(queries), 0), np.int64), np.zeros((len(queries), 0), np.int64)
                if row["tree"] is not None:
                    tree, ids = pickle.loads(row["tree"])
                    scores, found = search(tree, ids, queries, query_ids, kth, k)
                kept = found != NO_ID
                hits = [np.broadcast_to(query_ids[:, None], found.shape)[kept], found[kept], scores[kept].astype(np.int64)]
                struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in hits], names=["query_id", "vec_id", "score"])
                row["hits"] = pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct)
                if first:
                    last = kept[:, k - 1] if kept.shape[1] >= k else np.zeros(len(queries), bool)
                    kth[last] = scores[last, k - 1].astype(float) if last.any() else 0.0
                    kth -= np.where(np.abs(kth) < 2**52, 0.0, 1e-9 * np.abs(kth))  # larger ones are rounded
                    row["kth"], row["least"] = kth.tobytes(), float(kth.min())
                schema = to_arrow_schema(out)
                yield pa.RecordBatch.from_arrays([row[f.name] if f.name == "hits" else pa.array([row[f.name]], f.type) for f in schema], names=out.names)

    return rows.mapInArrow(run, out)


def first_search(index: Index, k: int = K) -> DataFrame:
    """The blocks with their hits in a shard of their own cell, and the kth scores to be reached elsewhere."""
    own = index.shards.select("dim", "cell", F.col("part").alias("home"), "tree")
    return stash(_search_rows(index.blocks.join(own, ["dim", "cell", "home"], "left"), k, True), "topk-first")


def pairs_to_search(index: Index, searched: DataFrame) -> DataFrame:
    """(dim, cell, block, shard_cell, part) of each block and each other shard whose balls' bound reaches the block's least kth score."""
    lanes = int(searched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = index.shards.select("dim", F.col("cell").alias("shard_cell"), "part", "centre", "radius")
    s = s.withColumn("lane", F.pmod(F.xxhash64("shard_cell", "part"), F.lit(lanes)).cast("int"))
    q = searched.select("dim", "cell", "block", "home", F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"), "norm", "least")
    q = q.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    # q.c + |q| r, with q within its own ball
    bound = dot("q_centre", "centre") + F.col("q_radius") * F.sqrt(dot("centre", "centre")) + F.col("norm") * F.col("radius")
    other = ~((F.col("cell") == F.col("shard_cell")) & (F.col("part") == F.col("home")))
    return q.join(s, ["dim", "lane"]).filter(other & (bound + 1e-9 * (F.abs(bound) + 1) >= F.col("least"))).select("dim", "cell", "block", "shard_cell", "part")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with `is_query` (over vec_id) its k best other rows."""
    index = build(vectors, is_query, k, id_col, vec_col, scale)
    searched = first_search(index, k)
    pairs = pairs_to_search(index, searched).join(searched.select("dim", "cell", "block", "queries", "kth"), ["dim", "cell", "block"])
    trees = index.shards.select("dim", F.col("cell").alias("shard_cell"), "part", "tree")
    more = _search_rows(pairs.join(trees, ["dim", "shard_cell", "part"]), k, False)
    return best(searched.select(F.inline("hits")).unionByName(more.select(F.inline("hits"))), k, F.col("score"))
