"""What the two vector searches share: usable vectors, query blocks and shards, the best k of several lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str, nonzero: bool = False) -> DataFrame:
    """(vec_id, vec) with vec an array of double; rows that cannot take part are left out.

    Those are rows with a null id, a null or empty vector, or a null or non-finite component; with `nonzero` also zero vectors.
    """
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(F.col("vec_id").isNotNull() & (F.size("vec") > 0))
    infinite = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = rows.filter(~F.exists("vec", infinite))
    if nonzero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    return rows


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best(found: DataFrame, k: int, score: Column, *more: str) -> DataFrame:
    """Of (query_id, vec_id, score, more) the k best of each query with their rank; equal scores go to the smaller vec_id."""
    order = W.partitionBy("query_id").orderBy(score.desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *more)


def merge_best(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row the k best of two lists of scores; equal scores go to the smaller id."""
    s, i = np.concatenate([scores, more], axis=1), np.concatenate([ids, more_ids], axis=1)
    if s.shape[1] > 4 * k:
        # Keep all that tie with the kth score, then order those.
        kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        width = int((s >= kth[:, None]).sum(axis=1).max())
        if width < s.shape[1]:
            at = np.argpartition(-s, width - 1, axis=1)[:, :width]
            s, i = np.take_along_axis(s, at, axis=1), np.take_along_axis(i, at, axis=1)
    order = np.argsort(i, axis=1, kind="stable")
    s, i = np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)
    order = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)
