"""Vectors as blocks of rows, shared by the two vector searches.

A search sets a stated set of queries against all rows: candidates are packed
into blocks of bounded size, queries likewise, and every query block meets the
candidate blocks of one lane at a time in an ordinary equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_EVERY = 100


def usable(vectors: DataFrame, zero_too: bool = True) -> DataFrame:
    """vec_id and components as doubles, without rows that lack an id or whose
    vector is null, empty, or holds a null or non-finite component."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = v.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite)
    return ok if zero_too else ok.filter(F.exists("v", lambda x: x != 0))


def stated_queries(rows: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """Rows whose id the number divides; one per id, of several the smallest vector."""
    return rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column with lists of one length as a matrix."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks (dim, ids, components) of at most ``size`` rows with one length."""
    held: dict[int, tuple[list, list]] = {}

    def block(dim: int) -> pa.RecordBatch:
        ids, parts = held.pop(dim)
        return pa.RecordBatch.from_pydict({
            "dim": pa.array([dim], pa.int32()), "ids": pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
            "data": pa.array([np.concatenate(parts).tobytes()], pa.binary())})

    for b in batches:
        ids, col = b.column(0).to_numpy(), b.column(1)
        dims = np.array([len(x) for x in col]) if b.num_rows else np.zeros(0, int)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            data = matrix(col.take(pa.array(rows)))
            for lo in range(0, len(rows), size):
                mine = held.setdefault(dim, ([], []))
                mine[0].append(ids[rows[lo:lo + size]])
                mine[1].append(data[lo:lo + size])
                if sum(map(len, mine[0])) >= size:
                    yield block(dim)
    for dim in list(held):
        yield block(dim)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, ids, data): at most 2 * size rows to a block."""
    return rows.select("vec_id", "v").mapInArrow(partial(_packed, size=size), "dim int, ids binary, data binary")


FOUND = "query_id long, vec_id long, score {}"


def best(pairs: DataFrame, k: int, ascending: bool) -> DataFrame:
    """Ranks 1 to k of each query's rows, ties to the smaller id."""
    by = F.col("score").asc() if ascending else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(by, F.col("vec_id")))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


