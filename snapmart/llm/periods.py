"""Periodic runs of words, found scale by scale in overlapping tiles.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)``
long, that cannot be extended. Periods are taken by octaves [P, 2P):

* Explode: an octave's tiles are 16P words long (``TILE`` at least, so small
  octaves share theirs) and overlap by 8P or more. Since 8P covers four periods, a run that
  leaves a tile has a fragment of four periods or more in every tile it meets,
  and neighbouring fragments overlap by as much.
* Solve: a tile is cut at every multiple of P. For a boundary c, the Z-function
  of the words behind it says for each q how far they equal the words behind
  c + q. Values of P or more show as equal names of P words (a name of 2P is
  made from two of P); boundaries in a row with such values are one
  fragment, whose ends are Z-values below P, read forward from its last and
  backward from its first boundary. Every fragment is compared word by word.
  A period that is a multiple of a smaller one is recognised by the names and
  dropped in every tile.
* Stitch: fragments are shuffled by document and period; those that overlap by a
  period or more become one run.

Tiles of documents of more than 2 * TILE bytes are dealt over the cluster; the
others, a tile each, are solved where they are read.

Words are the texts' stretches without ASCII white space. Cases: null and empty
texts have no words and no runs; rows are told apart by id and text (two 64-bit
hashes), so repeated rows get equal results; null ids are kept; an empty table
gives no rows; other columns are ignored; a long text may have any length, its
row of words being held by one task at a time. Runs may overlap; all are told,
by start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import texts
from snapmart.llm.hashing import U, mix

TILE = 1 << 14  # words; a power of two, 16 at least
TOGETHER = 1 << 16  # words of tiles that are solved in one go
KEY = ["h1", "h2"]
RUNS = "array<struct<start: bigint, period: bigint, length: bigint>>"


def tiles(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, start, stop) of the tiles of n words."""
    if n < 6:
        return
    last = (n // 4).bit_length() - 1  # of the longest period that can occur four times
    if n <= tile:
        yield 0, last, 0, n
        return
    shared = min(last, (tile // 16).bit_length() - 1)
    groups = [(0, shared, tile)] + [(k, k, 16 << k) for k in range(shared + 1, last + 1)]
    for lo, hi, length in groups:
        if n <= length:
            yield lo, last, 0, n
            return
        for start in range(0, n, length // 2):
            yield lo, hi, start, min(n, start + length)
            if start + length >= n:
                break


@lru_cache(1 << 16)
def _primes(q: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= q:
        if not q % p:
            found.append(p)
            while not q % p:
                q //= p
        p += 1
    return (*found, q) if q > 1 else tuple(found)


def _z_back(w: np.ndarray, at: int, q: int, most: int) -> int:
    """How many words before ``at`` equal those q further on (fewer than ``most``, unless the tile begins)."""
    lo = max(0, at - most)
    other = np.flatnonzero(w[lo:at] != w[lo + q:at + q])
    return at - lo - 1 - int(other[-1]) if len(other) else at - lo


def _z_ahead(w: np.ndarray, at: int, q: int, most: int) -> int:
    """How many words from ``at`` on equal those q further on."""
    hi = max(at, min(len(w) - q, at + most))
    other = np.flatnonzero(w[at:hi] != w[at + q:hi + q])
    return int(other[0]) if len(other) else hi - at


def solve(w: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, stop) of the fragments in a row of word numbers, for
    the periods of the octaves ``first`` to ``last``."""
    n = len(w)
    names = mix(w.astype(np.uint64) + U(1)) | U(1)
    for k in range(last + 1):
        p = 1 << k
        if 4 * p > n:
            return
        if k:  # names of p words from names of half as many
            names = mix(names[:n - p + 1] * U(0x9E3779B97F4A7C15) ^ mix(names[p // 2:n - p // 2 + 1] + U(k))) | U(1)
        if k < first:
            continue
        blocks = n // p
        padded = np.zeros((blocks + 1) * p, np.uint64)
        padded[:len(names)] = names
        same = np.flatnonzero(padded[:blocks * p:p, None] == padded[p:].reshape(blocks, p))
        if not len(same):
            continue
        key = np.sort((same & (p - 1)) * (blocks + 1) + (same >> k))
        head = np.flatnonzero(np.append(True, np.diff(key) != 1))
        many = np.diff(np.append(head, len(key)))
        enough = many >= (5 if p == 1 else 2)  # three periods of equal words hold two whole blocks
        for x, m in zip(key[head[enough]].tolist(), many[enough].tolist(), strict=True):
            q, c = p + x // (blocks + 1), x % (blocks + 1) * p
            if any(names[c] == names[c + d] and names[c + q - p] == names[c + q - p + d] for d in (q // f for f in _primes(q))):
                continue
            start, stop = c - _z_back(w, c, q, p), c + m * p
            stop += _z_ahead(w, stop, q, p)
            apart = np.flatnonzero(w[start:stop] != w[start + q:stop + q]) + start  # none, unless names collided
            edges = [start - 1, *apart.tolist(), stop]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi - lo - 1 + q >= max(6, 4 * q):
                    yield q, lo + 1, hi + q


def _numbers(text: bytes) -> np.ndarray:
    """A text's words as numbers, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(word, len(seen)) for word in text.split()], np.int32)


FRAGMENT = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
Tile = tuple[int, int, int, int, int, np.ndarray]  # h1, h2, first octave, last octave, start, words


def _solve_together(rows: list[Tile]) -> Iterator[pa.RecordBatch]:
    """Tiles one after the other, their numbers made distinct, as one row of words."""
    found = []
    for first in sorted({r[2] for r in rows}):
        own = [r for r in rows if r[2] == first]
        at = np.cumsum([0] + [len(r[5]) for r in own])
        tops = np.cumsum([0] + [int(r[5].max()) + 1 for r in own])
        row = np.concatenate([r[5].astype(np.int64) + top for r, top in zip(own, tops, strict=False)])
        for period, start, stop in solve(row, first, max(r[3] for r in own)):
            n = int(np.searchsorted(at, start, "right")) - 1
            h1, h2, _, _, begin, _ = own[n]
            found.append((h1, h2, period, begin + start - int(at[n]), begin + stop - int(at[n])))
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=FRAGMENT)


def _solved(rows: Iterator[Tile]) -> Iterator[pa.RecordBatch]:
    group, size = [], 0
    for r in rows:
        group.append(r)
        size += len(r[5])
        if size >= TOGETHER:
            yield from _solve_together(group)
            group, size = [], 0
    if group:
        yield from _solve_together(group)


def _tiles(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[Tile]:
    for b in batches:
        for h1, h2, text in zip(*(b.column(n).to_pylist() for n in (*KEY, "text")), strict=True):
            w = _numbers(text)
            for first, last, start, stop in tiles(len(w), tile):
                yield h1, h2, first, last, start, w[start:stop]


def _explode(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    for row in _tiles(batches, tile):
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*row[:5], row[5].tobytes()), types, strict=True)],
                                         names=[*KEY, "first", "last", "start", "words"])


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            for *row, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield *row, np.frombuffer(words, np.int32)
    return _solved(rows())


def _solve_texts(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    return _solved(_tiles(batches, tile))


def stitch(fragments: DataFrame) -> DataFrame:
    """(h1, h2, period, start, stop) of whole runs from those of fragments."""
    row = Window.partitionBy(*KEY, "period").orderBy("start", "stop")
    before = F.max("stop").over(row.rowsBetween(Window.unboundedPreceding, -1))
    anew = fragments.withColumn("anew", F.when(F.col("start") <= before - F.col("period"), 0).otherwise(1))
    numbered = anew.withColumn("run", F.sum("anew").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*KEY, "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def find_runs(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, text (null as the empty one) and
    ``runs``, an array of (start, period, length) by start, then period."""
    src = texts(docs).withColumns({"h1": F.xxhash64("doc_id", "text"), "h2": F.xxhash64(F.lit(1), "doc_id", "text")})
    words = src.select(*KEY, F.col("text").cast("binary").alias("text"))
    one_tile = F.octet_length("text") <= 2 * tile
    kind = "h1 long, h2 long, period long, start long, stop long"
    near = words.filter(one_tile).mapInArrow(partial(_solve_texts, tile=tile), kind)
    dealt = words.filter(~one_tile).mapInArrow(
        partial(_explode, tile=tile), "h1 long, h2 long, first int, last int, start long, words binary")
    far = dealt.repartition(*KEY, "first", "start").mapInArrow(_solve_tiles, kind)
    run = F.struct("start", "period", (F.col("stop") - F.col("start")).alias("length"))
    runs = stitch(near.union(far)).groupBy(*KEY).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    found = src.join(runs, KEY, "left")
    return found.select("doc_id", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, runs in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("runs").to_pylist(), strict=True):
            words = text.split()
            if runs:
                kept = np.ones(len(words), bool)
                for r in runs:
                    kept[r["start"] + r["period"]:r["start"] + r["length"]] = False
                words = [words[i] for i in np.flatnonzero(kept).tolist()]
            out.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary()).cast(pa.string()), b.column("runs")],
                                         names=["doc_id", "text", "runs"])


def collapse(found: DataFrame) -> DataFrame:
    """doc_id, runs, and the text with one period of each run left: its words,
    without those that a run holds after its first period, joined by one space."""
    id_type = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text", "runs").mapInArrow(_collapse, f"doc_id {id_type}, text string, runs {RUNS}")


def digests(collapsed: DataFrame) -> DataFrame:
    """Number of runs, the run with the most periods (ties: smallest start,
    then period), and hashes of all runs and of the collapsed text."""
    def more(a, b):
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(x > y, -1).when(x < y, 1).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(
            F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    best = F.try_element_at(F.array_sort("runs", more), F.lit(1))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    rows = collapsed.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


def _stutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        for n, h in enumerate(b.column("h").to_pylist()):
            if h is not None and h % 10 == 0 and (words := (texts[n] or "").encode().split()):
                g = h // 10
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                said = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
                texts[n] = b" ".join(said).decode()
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def with_stutter(docs: DataFrame) -> DataFrame:
    """The documents of the query: a tenth of them, by a hash of the id, repeat
    the words from some word on with a period. Words of those are joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", h.alias("h")).mapInArrow(_stutter, f"doc_id {id_type}, text string")
