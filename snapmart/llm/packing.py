"""Best-fit packing after Martello-Toth dominance reduction.

Every document becomes token ids with an end id behind them; only longer ones
are cut into pieces of the sequence length. Packing needs nothing but how many
pieces there are of each length: at most ``capacity`` numbers, whatever the
corpus. On these counts the reduction fixes sets of up to three lengths that
provably dominate every other set with the same largest piece, many bins at a
time; best-fit decreasing packs what remains. The plan is a short list of
fills "the pieces of this length with these ranks go into these sequences",
and each row looks up its own place by its rank among pieces of its length.
Ranks are counted within each task and completed by the counts of the tasks
before it, so that no length, however common, meets in one task.

Cases: null text is the empty document (its end id alone); repeated rows are
packed each; equal lengths are interchangeable, ties go by task and position;
an empty table gives no rows; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm import tokens
from snapmart.llm.common import stored, texts
from snapmart.llm.workers import give_back

REMEMBERED = 400_000  # pieces in each of two generations per worker: a word is few bytes, learning one is dear
GROUP = 512  # rows encoded together
TIDY = 4  # groups after which a task gives freed memory back
#: One fill: pieces of ``size`` ranked from ``rank`` on, ``n`` of them, ``each`` per
#: sequence, into the sequences from ``first`` on, from position ``at`` on.
Fill = tuple[int, int, int, int, int, int]


class Plan:
    """Fills of one packing, made from the counts of each length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, Counter({s: n for s, n in counts.items() if n > 0})
        self.bins, self.fills, self.fixed = 0, [], 0
        self._rank: dict[int, int] = defaultdict(int)

    def _fill(self, size: int, n: int, each: int, first: int, at: int) -> None:
        self.fills.append((size, self._rank[size], n, each, first, at))
        self._rank[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]

    def fix(self, sizes: list[int], bins: int) -> None:
        """``bins`` sequences holding one piece of each of ``sizes``."""
        at = 0
        for size in dict.fromkeys(sizes):
            each = sizes.count(size)
            self._fill(size, bins * each, each, self.bins, at)
            at += size * each
        self.bins += bins
        self.fixed += bins

    def best_fit(self) -> None:
        """Best-fit decreasing: all pieces of a length at once, each into the
        fullest sequence that takes it. Sequences with equal room form groups."""
        room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        order: list[int] = []

        def put(r: int, first: int, n: int) -> None:
            if n and r:
                if not room[r]:
                    bisect.insort(order, r)
                room[r].append((first, n))

        for size in sorted(self.left, reverse=True):
            while n := self.left.get(size, 0):
                i = bisect.bisect_left(order, size)
                if i < len(order):
                    r = order[i]
                    first, bins = room[r].pop()
                    if not room[r]:
                        order.pop(i)
                else:
                    r = self.capacity
                    first, bins = self.bins, -(-n // (r // size))
                    self.bins += bins
                each = r // size
                full = min(bins, n // each)
                if full:
                    self._fill(size, full * each, each, first, self.capacity - r)
                    put(r - each * size, first, full)
                else:
                    full = 1
                    self._fill(size, n, n, first, self.capacity - r)
                    put(r - n * size, first, 1)
                put(r, first + full, bins - full)


def dominating(left: Counter, size: int, capacity: int) -> tuple[list[int], int] | None:
    """The set that dominates every feasible set with one piece of ``size``, and
    how many such sequences to fix; None if no set of up to three is proven to.

    Set A dominates B if B's pieces can be split among A's so that no piece of
    A is exceeded. Removing pieces removes feasible sets and never adds any, so
    a proof holds as long as the fixed lengths last."""
    free = capacity - size
    rest = {s: n - (s == size) for s, n in left.items() if s <= free and n > (s == size)}
    if not rest:
        return [size], left[size]
    a = max(rest)
    times = lambda sizes: min(left[s] // sizes.count(s) for s in sizes)
    if a == free or most_filled(rest, free, a) <= a:
        return [size, a], times([size, a])
    rest_a = {s: n - (s == a) for s, n in rest.items() if s <= free - a and n > (s == a)}
    three = sorted(s for s, n in rest.items() for _ in range(min(n, 3)))[:3]
    if rest_a and (len(three) < 3 or sum(three) > free):  # at most two others fit
        b = max(rest_a)
        second = max((q for q, n in rest.items() if any(
            p >= q and p + q <= free and (p > q or n > 1) for p in rest)), default=0)
        if second <= b:
            return [size, a, b], times([size, a, b])
    return None


def most_filled(rest: dict[int, int], free: int, enough: int) -> int:
    """The largest sum up to ``free`` that pieces of ``rest`` reach; stops
    early once ``enough`` is exceeded."""
    mask, reach = (1 << (free + 1)) - 1, 1
    for s, n in sorted(rest.items(), reverse=True):
        n, k = min(n, free // s), 1
        while n > 0:
            k = min(k, n)
            reach = (reach | reach << (s * k)) & mask
            n, k = n - k, k * 2
        if reach.bit_length() - 1 > enough:
            return reach.bit_length() - 1
    return reach.bit_length() - 1


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Reduce, then best-fit the remainder."""
    p = Plan(counts, capacity)
    for size in sorted(counts, reverse=True):
        while p.left.get(size) and (found := dominating(p.left, size, capacity)):
            p.fix(*found)
    p.best_fit()
    return p


PIECE = ("piece int, start long, length long, ids binary, part int, rank long")


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end: bytes, remembered: int) -> Iterator[pa.RecordBatch]:
    part, ranks = TaskContext.get().partitionId(), Counter()
    for b in batches:
        for lo in range(0, b.num_rows, GROUP):
            rows = b.slice(lo, GROUP)
            at, piece, start, length, ids, rank = [], [], [], [], [], []
            for i, got in enumerate(tokens.encode(path, rows.column(1).to_pylist(), tokens.words, remembered)):
                got += end
                for k, s in enumerate(range(0, len(got), 4 * capacity)):
                    cut = got[s:s + 4 * capacity]
                    n = len(cut) // 4
                    at.append(i), piece.append(k), start.append(s // 4), length.append(n), ids.append(cut), rank.append(ranks[n])
                    ranks[n] += 1
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([part] * len(at), pa.int32()),
                 pa.array(rank, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "part", "rank"])
            if lo // GROUP % TIDY == TIDY - 1:
                give_back()
    give_back()


def _place(batches: Iterator[pa.RecordBatch], fills: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Replace the last column, the rank among pieces of that length, by sequence and offset."""
    starts = fills[:, 0] << 48 | fills[:, 1]
    for b in batches:
        size, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
        f = fills[np.searchsorted(starts, size << 48 | rank, "right") - 1] if len(size) else fills[:0]
        k = rank - f[:, 1]
        cols = [b.column(i) for i in range(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(f[:, 4] + k // f[:, 3]), pa.array(f[:, 5] + k % f[:, 3] * size)],
            names=[*b.schema.names[:-1], "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
         keep: list[Column] | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ``keep`` (columns made
    from ``ids``; the ids themselves by default), sequence_id, offset. A worker
    remembers two generations of ``remembered`` words: fewer take less memory and
    more time, and change no row."""
    src = texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()
    cut = src.mapInArrow(partial(_pieces, path=tokenizer_path, capacity=capacity,
                                 end=int(end_id).to_bytes(4, "little"), remembered=remembered), f"doc_id {id_type}, {PIECE}")
    kept = [F.col("ids")] if keep is None else keep
    cut = stored(cut.select("doc_id", "piece", "start", "length", *kept, "part", "rank"), "pieces")
    by_task = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    fills = np.array(sorted(plan(counts, capacity).fills), dtype=np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = cut.join(ahead, ["part", "length"]).select(
        *[c for c in cut.columns if c not in ("part", "rank")], (F.col("rank") + F.col("ahead")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(partial(_place, fills=fills), f"{schema}, sequence_id long, offset long")
