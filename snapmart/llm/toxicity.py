"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of single words, neighbouring pairs, and pairs with
one or two words between, hashed to ``DIMENSIONS`` places. The learner keeps a
rate for each coordinate and L1 keeps most weights at exactly zero, so a model
is a short list of (place, weight) that any executor can hold: at most
``DIMENSIONS`` numbers, whatever the corpus. It is fitted on at most
``max_rows`` labelled rows, taken by smallest hash of their id; scoring reads
every whole text once, without a shuffle.

Rows whose crc32(id as text) leaves 0 modulo ``FOLDS`` are held out of the fit.

Cases: null and empty texts have no features and get the score of the bias;
repeated rows are scored each; of several labels for one id the highest
counts; labels without a document, null labels and null ids teach nothing; a
null id is not held out; with no usable label every score is 0.5's prior (the
bias stays 0); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm import hashing
from snapmart.llm.common import stored, texts
from snapmart.llm.workers import give_back, lean

BITS = 20
DIMENSIONS = 1 << BITS
MAX_ROWS = 20_000
FOLDS = 5
U = np.uint64
ODD = U(0x9E3779B97F4A7C15)

Model = tuple[float, np.ndarray, np.ndarray]  # bias, places, weights


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every word, pair and skip-pair; places may repeat."""
    words, at = hashing.word_hashes(data, off, hashing.LETTERS)
    row = np.repeat(np.arange(len(off) - 1), np.diff(at))
    rows, places = [row], [hashing.mix(words)]
    for gap in (1, 2, 3):
        same = np.flatnonzero(row[gap:] == row[:-gap]) if len(row) > gap else row[:0]
        rows.append(row[same])
        places.append(hashing.mix(words[same] * ODD + words[same + gap] + U(gap)))
    return np.concatenate(rows), (np.concatenate(places) >> U(64 - BITS)).astype(np.int64)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, off in hashing.slices(b.column(0)):
            row, place = features(data, off)
            own = np.unique(row << BITS | place)
            ends = np.searchsorted(own >> BITS, np.arange(hi - lo + 1))
            place = (own & (DIMENSIONS - 1)).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [b.column(1).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                 pa.array([place[a:z].tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                names=["turn", "toxic", "places"])


def fit(examples: list[tuple[int, np.ndarray]], epochs: int = 4, alpha: float = 0.15, beta: float = 1.0,
        l1: float = 30.0, l2: float = 1.0) -> Model:
    """FTRL-proximal over (label, places). Place 0 of the state is the bias,
    which is not penalised. The rarer label weighs as much as the other in all,
    so that 0.5 parts the two wherever the labels' share lies."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    ones = sum(y for y, _ in examples)
    heavy = (len(examples) - ones) / ones if ones else 1.0

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        lasso = np.where(i == 0, 0.0, l1)
        w = -(zi - np.sign(zi) * lasso) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= lasso, 0.0, w)

    for _ in range(epochs):
        for y, places in examples:
            i = np.concatenate([[0], places.astype(np.int64) + 1])
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (heavy if y else 1.0)
            rate = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - rate * w
            n[i] += g * g
    w = weights(np.arange(DIMENSIONS + 1))
    places = np.flatnonzero(w[1:])
    return float(w[0]), places, w[1:][places].astype(np.float64)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples = [(y, np.frombuffer(p.as_buffer(), "<u4")) for b in batches  # views of the batches, no copies
                for y, p in zip(b.column("toxic").to_pylist(), b.column("places"), strict=True)]
    if examples:
        bias, places, w = fit(examples)
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.append(places, -1), pa.int64()), "weight": pa.array(np.append(w, bias))})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    usable = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out("label_id"))
    chosen = (usable.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
              .withColumn("turn", F.xxhash64("label_id")).orderBy("turn", "label_id").limit(max_rows))
    chosen = stored(chosen, "toxicity-chosen")
    read = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "turn", "toxic")
    examples = stored(read.mapInArrow(lean(_examples), "turn long, toxic int, places binary"), "toxicity-examples")
    # a bounded sample in one task; a repeated row teaches once
    one = examples.dropDuplicates(["turn"]).repartitionByRange(1, "turn").sortWithinPartitions("turn")
    rows = one.mapInArrow(lean(_fit), "place long, weight double").collect()  # at most DIMENSIONS + 1 numbers
    found = sorted((r["place"], r["weight"]) for r in rows)
    bias = found.pop(0)[1] if found else 0.0
    return bias, np.array([p for p, _ in found], np.int64), np.array([w for _, w in found], np.float64)


def _score(batches: Iterator[pa.RecordBatch], model: Model, at: int) -> Iterator[pa.RecordBatch]:
    bias, places, weights = model
    table = np.zeros(DIMENSIONS)
    table[places] = weights
    for b in batches:
        scores = []
        for lo, hi, data, off in hashing.slices(b.column(at)):
            row, place = features(data, off)
            told = np.flatnonzero(table[place])
            own = np.unique(row[told] << BITS | place[told])
            logit = bias + np.bincount(own >> BITS, table[own & (DIMENSIONS - 1)], hi - lo)
            scores.append(1 / (1 + np.exp(-np.clip(logit, -700, 700))))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                         names=[*b.schema.names, "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: more likely toxic), predicted."""
    src = texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()
    scored = src.mapInArrow(lean(partial(_score_ids, model=model)), f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _score_ids(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in _score(batches, model, 1):
        yield b.select(["doc_id", "score"])


def keep_clean(docs: DataFrame, model: Model, at_most: float = 0.5) -> DataFrame:
    """The rows whose score is under ``at_most``, columns as they were. Only
    texts go to Python and only scores come back; rows wait in the JVM, which can
    spill them."""

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in batches:
            plain = pa.RecordBatch.from_arrays([text.fill_null("")], names=["text"])
            yield from (b.column(1) for b in _score(iter([plain]), model, 0))
        give_back()

    return docs.filter(F.arrow_udf(scores, "double")("text") < at_most)
