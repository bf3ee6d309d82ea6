"""Exact top-k inner products by an impact-ordered index, a score at a time.

Components are scaled and floored to integers. A block's index lists, for each
dimension, its rows in ``LEVELS`` segments of equal width by their value. For a
query every segment has an impact: the least its rows gain in that dimension
over the worst row. Segments are taken by descending impact from all dimensions
together, adding the impact to their rows' sums. What a sum can still miss is
bounded by the segments' widths and, for each dimension, by the best segment
not yet taken; rows that cannot reach the k-th best sum are out by proof.
Processing stops once few possible members are left, or nothing is left to
take, and the possible members are scored exactly.

Cases: rows without id, and vectors that are null, empty or hold null or
non-finite components take no part; a query's own id is no candidate; vectors
of another length are no candidates; a repeated row is a candidate each time
and one query; ties go to the smaller id; an empty table gives no rows. Scaled
components must fit 31 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm import vectors
from snapmart.llm.common import stored

LEVELS = 8
BLOCK = 4096
QUERIES = 256
FEW = 64  # possible members at which scoring them is cheaper than going on


class Index:
    """Posting segments of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        self.ids, self.data = ids, data.astype(np.int64)
        low, high = self.data.min(axis=0), self.data.max(axis=0)
        step = np.maximum(1, -(-(high - low + 1) // LEVELS))
        level = (self.data - low) // step
        self.rows, self.dim, first, last = [], [], [], []
        for d in range(data.shape[1]):
            order = np.argsort(level[:, d], kind="stable")
            cuts = np.flatnonzero(np.diff(level[order, d])) + 1
            for rows in np.split(order, cuts):
                values = self.data[rows, d]
                self.rows.append(rows)
                self.dim.append(d)
                first.append(values.min())
                last.append(values.max())
        self.dim, self.first, self.last = np.array(self.dim), np.array(first), np.array(last)
        self.low, self.high = low, high

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of rows among which the block's k best are."""
        worst = np.where(q > 0, self.low, self.high) * q
        a, b = self.first * q[self.dim], self.last * q[self.dim]
        impact, most = np.minimum(a, b) - worst[self.dim], np.maximum(a, b) - worst[self.dim]
        order = np.argsort(-impact, kind="stable")
        ends = np.zeros(len(q), np.int64)  # segments of each dimension, best first
        np.add.at(ends, self.dim, 1)
        rest = np.zeros(len(q), np.int64)  # the most a row can have in what is not yet taken
        np.maximum.at(rest, self.dim, most)
        width = np.zeros(len(q), np.int64)
        sums = np.zeros(len(self.ids), np.int64)
        own = self.ids == query_id
        others = len(self.ids) - int(own.sum())
        if not others:
            return self.ids[:0], sums[:0]
        k = min(k, others)
        sums[own] = -(1 << 62)
        most_in_order, dim_in_order = most[order], self.dim[order]
        possible, every = None, max(1, len(order) // 8)
        for at in range(0, len(order), every):
            for s in order[at:at + every].tolist():
                if impact[s]:
                    sums[self.rows[s]] += impact[s]
            done = order[at:at + every]
            np.maximum.at(width, self.dim[done], (most - impact)[done])
            rest[:] = 0
            np.maximum.at(rest, dim_in_order[at + every:], most_in_order[at + every:])
            unsure = int(np.maximum(width, rest).sum())
            bar = np.partition(sums, len(sums) - k)[len(sums) - k]
            possible = np.flatnonzero((sums + unsure >= bar) & ~own)
            if len(possible) <= max(FEW, k):
                break
        return self.ids[possible], self.data[possible] @ q


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    held, index = None, None
    for b in batches:
        for block, dim, ids, data, q_ids, q_data in zip(*(b.column(c).to_pylist() for c in (
                "block", "dim", "ids", "data", "q_ids", "q_data")), strict=True):
            if block != held:
                held, index = block, Index(np.frombuffer(ids, "<i8"), np.frombuffer(data, np.float64).reshape(-1, dim))
            out = []
            for query_id, q in zip(np.frombuffer(q_ids, "<i8").tolist(), np.frombuffer(q_data, np.float64).reshape(-1, dim), strict=True):
                found, score = index.search(query_id, q.astype(np.int64), k)
                top = np.lexsort((found, -score))[:k]
                out.append((np.full(len(top), query_id), found[top], score[top]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             names=["query_id", "vec_id", "score"])


def top_k(vecs: DataFrame, k: int = 10, scale: int = 1024, every: int = vectors.QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each stated query."""
    spark = vecs.sparkSession
    ints = vectors.usable(vecs).select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    # a lane per core: each candidate block is in one lane, the queries visit all
    lanes = max(1, spark.sparkContext.defaultParallelism)
    index = stored(vectors.blocks(ints, BLOCK).withColumn("block", F.monotonically_increasing_id())
                   .withColumn("lane", F.pmod(F.hash("block"), F.lit(lanes))), "impact-blocks")
    asked = stored(vectors.blocks(vectors.stated_queries(ints, every), QUERIES).select(
        F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "impact-queries")
    visits = asked.withColumn("q_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    met = index.join(visits, (F.col("lane") == F.col("q_lane")) & (F.col("dim") == F.col("q_dim"))).select(
        "block", "dim", "ids", "data", "q_ids", "q_data")
    found = met.mapInArrow(partial(_search, k=k), vectors.FOUND.format("long"))
    return vectors.best(found, k, ascending=False)
