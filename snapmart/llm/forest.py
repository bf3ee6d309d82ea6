"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits the space by planes half-way between two random vectors. The
planes are fitted on at most ``SAMPLE`` rows, one tree to a task, so a forest
is of bounded size and fits every executor; the index then files every row
under its leaf in each tree. A query walks all trees through one priority
queue, nearest unexplored side first, until the leaves it has opened hold the
share ``visit`` of all rows (counted on the sample, rows in several trees'
leaves each time). Rows in opened leaves are candidates; their distances are
computed exactly on the original vectors. A leaf's rows stay where their block
is, so a vector that fills a third of the table fills no task.

Cases: rows without id, and vectors that are null, empty, zero or hold null or
non-finite components take no part, nor do vectors whose length differs from
the sample's most frequent one; a query's own id is no candidate; a repeated
row is a candidate each time and one query; ties go to the smaller id; an empty
table gives no rows. ``visit`` is a share, so each query's work grows with the
table; vectors that cluster less than these need a larger share.
"""

from __future__ import annotations

import heapq
import pickle
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm import vectors
from snapmart.llm.common import stored

SAMPLE = 32_768
TREES = 16
LEAF = 48  # sample rows at which a node is not split further
VISIT = 1.25
BLOCK = 4096
QUERIES = 256

#: normals, offsets, children (below, above; negative: leaf -1 - i), share of the sample in each leaf
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grow(sample: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    rng = np.random.default_rng(seed)
    normals, offsets, children, shares = [], [], [], []
    root = np.arange(len(sample))
    todo = [(root, -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = _plane(sample[rows], rng) if len(rows) > leaf else None
        if split is None:
            here = -1 - len(shares)
            shares.append(len(rows) / len(sample))
        else:
            here = len(normals)
            normal, offset, above = split
            normals.append(normal), offsets.append(offset), children.append([0, 0])
            todo += [(rows[~above], here, 0), (rows[above], here, 1)]
        if parent >= 0:
            children[parent][side] = here
    dim = sample.shape[1]
    return (np.array(normals).reshape(-1, dim), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), np.array(shares))


def _plane(points: np.ndarray, rng: np.random.Generator):
    """A plane that leaves at least a tenth on either side, or none that does."""
    for _ in range(5):
        a, b = points[rng.choice(len(points), 2, replace=False)]
        normal = a - b
        if not (size := np.linalg.norm(normal)):
            continue
        normal = normal / size
        offset = normal @ (a + b) / 2
        above = points @ normal > offset
        if 0.1 <= above.mean() <= 0.9:
            return normal, offset, above
    normal = rng.standard_normal(points.shape[1])
    normal /= np.linalg.norm(normal)
    offset = np.median(points @ normal)
    above = points @ normal > offset
    return (normal, offset, above) if above.any() else None


def file_rows(tree: Tree, data: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    normals, offsets, children, _ = tree
    at = np.full(len(data), 0 if len(normals) else -1)
    while len(rows := np.flatnonzero(at >= 0)):
        node = at[rows]
        above = np.einsum("ij,ij->i", data[rows], normals[node]) > offsets[node]
        at[rows] = children[node, above.astype(int)]
    return -1 - at


def opened(trees: list[Tree], q: np.ndarray, visit: float) -> list[np.ndarray]:
    """For each tree, which leaves a query opens."""
    found = [np.zeros(len(t[3]), bool) for t in trees]
    margins = [t[0] @ q - t[1] for t in trees]
    queue = [(0.0, n, 0 if len(t[0]) else -1) for n, t in enumerate(trees)]
    heapq.heapify(queue)
    seen = 0.0
    while queue and seen < visit:
        far, n, node = heapq.heappop(queue)
        while node >= 0:
            m, (below, above) = margins[n][node], trees[n][2][node]
            near, other = (above, below) if m > 0 else (below, above)
            heapq.heappush(queue, (max(far, abs(m)), n, int(other)))
            node = int(near)
        found[n][-1 - node] = True
        seen += trees[n][3][-1 - node]
    return found


def _grow(batches: Iterator[pa.RecordBatch], sample: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        trees = [pickle.dumps(grow(sample, seed)) for seed in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(trees, pa.binary())], names=["seed", "tree"])


def fit(rows: DataFrame, sample_rows: int = SAMPLE, trees: int = TREES) -> tuple[int, list[Tree]]:
    """(dimension, forest) on at most ``sample_rows`` rows, by smallest hash of their id."""
    spark = rows.sparkSession
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow()
    if not chosen.num_rows:
        return 0, []
    lists = chosen.column(0).combine_chunks()
    dims = np.array([len(x) for x in lists])
    dim = min(Counter(dims.tolist()).items(), key=lambda c: (-c[1], c[0]))[0]
    sample = vectors.matrix(lists.take(pa.array(np.flatnonzero(dims == dim))))
    grown = spark.range(0, trees, 1, trees).mapInArrow(partial(_grow, sample=sample), "seed long, tree binary").collect()
    return dim, [pickle.loads(bytes(r["tree"])) for r in sorted(grown, key=lambda r: r["seed"])]


def _index(batches: Iterator[pa.RecordBatch], trees: list[Tree]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        leaves = []
        for dim, data in zip(b.column("dim").to_pylist(), b.column("data").to_pylist(), strict=True):
            data = np.frombuffer(data, np.float64).reshape(-1, dim)
            leaves.append(np.stack([file_rows(t, data) for t in trees]).astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves, pa.binary())], names=[*b.schema.names, "leaves"])


def _ask(batches: Iterator[pa.RecordBatch], trees: list[Tree], visit: float) -> Iterator[pa.RecordBatch]:
    """Opened leaves of each query in a block, as bits."""
    for b in batches:
        out = []
        for dim, data in zip(b.column("dim").to_pylist(), b.column("data").to_pylist(), strict=True):
            bits = [np.concatenate(opened(trees, q, visit)) for q in np.frombuffer(data, np.float64).reshape(-1, dim)]
            out.append(np.packbits(np.stack(bits), axis=1).tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "opened"])


def _search(batches: Iterator[pa.RecordBatch], sizes: list[int], k: int) -> Iterator[pa.RecordBatch]:
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for b in batches:
        for dim, ids, data, leaves, q_ids, q_data, q_open in zip(*(b.column(c).to_pylist() for c in (
                "dim", "ids", "data", "leaves", "q_ids", "q_data", "q_opened")), strict=True):
            ids, data = np.frombuffer(ids, "<i8"), np.frombuffer(data, np.float64).reshape(-1, dim)
            leaf = np.frombuffer(leaves, "<i4").reshape(len(sizes), -1) + starts[:-1, None]
            q_ids, q_data = np.frombuffer(q_ids, "<i8"), np.frombuffer(q_data, np.float64).reshape(-1, dim)
            bits = np.unpackbits(np.frombuffer(q_open, np.uint8).reshape(len(q_ids), -1), axis=1, count=int(starts[-1])).astype(bool)
            out = []
            for query_id, q, is_open in zip(q_ids.tolist(), q_data, bits, strict=True):
                rows = np.flatnonzero(is_open[leaf].any(axis=0) & (ids != query_id))
                score = np.sqrt(np.square(data[rows] - q).sum(axis=1))
                top = np.lexsort((ids[rows], score))[:k]
                out.append((np.full(len(top), query_id), ids[rows[top]], score[top]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             names=["query_id", "vec_id", "score"])


def nearest(vecs: DataFrame, k: int = 10, every: int = vectors.QUERY_EVERY, sample_rows: int = SAMPLE,
            trees: int = TREES, visit: float = VISIT) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest found of each stated query."""
    spark = vecs.sparkSession
    rows = vectors.usable(vecs, zero_too=False)
    dim, forest = fit(rows, sample_rows, trees)
    if not forest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == dim)
    lanes = max(1, spark.sparkContext.defaultParallelism)
    index = vectors.blocks(rows, BLOCK).mapInArrow(partial(_index, trees=forest), "dim int, ids binary, data binary, leaves binary")
    index = stored(index.withColumn("lane", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(lanes)).cast("int")),
                   "forest-index")
    asked = vectors.blocks(vectors.stated_queries(rows, every), QUERIES).mapInArrow(
        partial(_ask, trees=forest, visit=visit), "dim int, ids binary, data binary, opened binary")
    asked = stored(asked.select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("opened").alias("q_opened")),
                   "forest-queries")
    visits = asked.withColumn("q_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    met = index.join(visits, F.col("lane") == F.col("q_lane")).drop("lane", "q_lane")
    found = met.mapInArrow(partial(_search, sizes=[len(t[3]) for t in forest], k=k), vectors.FOUND.format("double"))
    return vectors.best(found, k, ascending=True)
