"""Exact removal of repeated byte passages by grouping windows, in place of a radix sort of suffixes.

Only the first ``length`` bytes of a suffix matter: two suffixes that agree so
far start a repeated window. No pass orders suffixes by their leading bytes:
windows are grouped in three steps, called digits here, and a group that falls
to one is settled and goes no further.

* First digit: of the ``ANCHOR``-byte strings inside a suffix's window the one
  with the smallest hash (the last of equals). It depends on the window alone,
  so equal windows share it, at the same distance. Neighbouring suffixes share
  it too: they travel as one run, about one for every 76 bytes, and only
  anchors that occur twice go on.
* Second digit: the whole content of a run. Equal runs repeat in every window.
* Last digit, for one member of each class of runs where runs of one anchor
  differ: the single windows, ordered by (anchor, distance, content). Equal
  groups are exactly the repeated windows.

A group of runs of one anchor with more than ``GROUP`` classes is not ordered
in one task; its windows are counted by a shuffled aggregation instead.

Contents are compared by two independent 64-bit hashes (anchor and window).

Cases: null text is empty; texts shorter than ``length`` lose nothing; matches
never cross rows; a repeated row repeats all its windows, its twin's too, and
every copy loses them; rows are told apart by doc_id and text, so equal rows
get equal results; a null id is a value like others; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm import hashing
from snapmart.llm.common import recounted, release, stored, texts
from snapmart.llm.workers import lean

ANCHOR = 50
GROUP = 4096
SEGMENT = 1 << 20  # bytes of rows looked at together, or of one long row
U = np.uint64
LOW32 = U(0xFFFFFFFF)


def _segments(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, first byte of each in its row, bytes, offsets): rows together up
    to SEGMENT bytes; a longer row in parts that overlap by length - 1."""
    for lo, hi, data, off in hashing.slices(column, SEGMENT):
        if hi - lo == 1 and len(data) > SEGMENT + length:
            for at in range(0, len(data) - length + 1, SEGMENT):
                part = data[at:at + SEGMENT + length - 1]
                yield np.array([lo]), np.array([at]), part, np.array([0, len(part)])
        else:
            yield np.arange(lo, hi), np.zeros(hi - lo, np.int64), data, off


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w neighbours."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def runs(data: np.ndarray, off: np.ndarray, length: int, contents: bool):
    """Runs of suffixes with one anchor: (row, first start, last start, anchor's
    position, anchor hash, hash of the run's content). Starts count from the
    beginning of ``data``."""
    row = np.repeat(np.arange(len(off) - 1), np.maximum(off[1:] - off[:-1] - length + 1, 0))
    if not len(row):
        return None
    first = np.cumsum(np.maximum(off[1:] - off[:-1] - length + 1, 0)) - np.maximum(off[1:] - off[:-1] - length + 1, 0)
    start = np.arange(len(row)) - first[row] + off[row]
    h = hashing.WORDS.prefix(data)
    n = len(data) - ANCHOR + 1
    grams = hashing.mix((h[ANCHOR:] - h[:n]) * hashing.WORDS.back[:n])
    packed = (grams & ~LOW32) | (LOW32 - np.arange(n, dtype=np.uint64))
    at = (LOW32 - (sliding_min(packed, length - ANCHOR + 1)[start] & LOW32)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(at)) - 1
    anchor = at[lo]
    content = None
    if contents:
        h = hashing.LONG.prefix(data)
        content = hashing.LONG.ranges(h, start[lo], start[hi] + length)
    return row[lo], start[lo], start[hi], anchor, grams[anchor], content


def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, data, off in _segments(b.column(1), length):
            if found := runs(data, off, length, contents=False):
                yield pa.RecordBatch.from_arrays([pa.array(found[4].view(np.int64))], names=["anchor"])


RUNS = "anchor long, behind int, ahead int, content long, text_hash int, at long"


def _runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """behind, ahead: the anchor's distance from the run's first and last suffix."""
    for b in batches:
        for rows, base, data, off in _segments(b.column(1), length):
            if found := runs(data, off, length, contents=True):
                row, lo, hi, anchor, gram, content = found
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows[row])), pa.array(gram.view(np.int64)), pa.array((anchor - lo).astype(np.int32)),
                     pa.array((anchor - hi).astype(np.int32)), pa.array(content.view(np.int64)),
                     b.column(2).take(pa.array(rows[row])), pa.array(lo - off[row] + base[row])],
                    names=["doc_id", "anchor", "behind", "ahead", "content", "text_hash", "at"])


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Replace the text, the last column but one, by each listed run's bytes."""
    for b in batches:
        at, out = [], []
        text = b.column(b.num_columns - 2).cast(pa.large_binary())
        for i, (t, spans) in enumerate(zip(text, b.column(b.num_columns - 1).to_pylist(), strict=True)):
            t = t.as_buffer()
            for s in spans:
                at.append(i)
                out.append((s["anchor"], s["behind"], s["ahead"], s["many"], s["big"], s["at"],
                            bytes(t[s["at"]:s["at"] + s["behind"] - s["ahead"] + length])))
        cols = list(zip(*out, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [b.column(i).take(pa.array(at, pa.int64())) for i in range(2)] +
            [pa.array(c, t) for c, t in zip(cols, CUT_TYPES, strict=True)],
            names=["doc_id", "text_hash", "anchor", "behind", "ahead", "many", "big", "at", "bytes"])


CUT_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
CUT = "text_hash int, anchor long, behind int, ahead int, many long, big boolean, at long, bytes binary"


def _windows(b: pa.RecordBatch, length: int):
    """Every window of the runs in ``b``: (row in b, start in its text, hash of
    anchor, distance and content)."""
    get = lambda c: b.column(b.schema.get_field_index(c))
    behind, ahead = (get(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("behind", "ahead"))
    anchor = get("anchor").to_numpy(zero_copy_only=False).view(np.uint64)
    data = np.frombuffer(b"".join(get("bytes").to_pylist()), np.uint8)
    count = behind - ahead + 1
    base = np.concatenate([[0], np.cumsum(count + length - 1)])[:-1]
    row = np.repeat(np.arange(len(count)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    h = hashing.LONG.prefix(data)
    wide = hashing.LONG.ranges(h, base[row] + k, base[row] + k + length)
    key = hashing.mix(wide ^ hashing.mix(anchor[row] + (behind[row] - k).astype(np.uint64)))
    return row, get("at").to_numpy(zero_copy_only=False)[row] + k, key


def _repeated(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows, from rows sorted by anchor with whole groups."""
    def settle(rows: pa.RecordBatch) -> pa.RecordBatch:
        row, start, key = _windows(rows, length)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        many = rows.column(rows.schema.get_field_index("many")).to_numpy(zero_copy_only=False)
        hit = np.flatnonzero(again & (many[row] == 1))
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(hit)) - 1 if len(hit) else lo
        take = pa.array(row[hit[lo]])
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(take), rows.column(1).take(take), pa.array(start[hit[lo]]), pa.array(start[hit[hi]] + length)],
            names=["doc_id", "text_hash", "lo", "hi"])

    left = None
    for b in batches:
        if not b.num_rows:
            continue
        b = b if left is None else pa.concat_batches([left, b])
        a = b.column(b.schema.get_field_index("anchor"))
        a = a.to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(a, a[-1]))  # the last group may go on
        if cut:
            for lo in _whole_groups(a[:cut]):
                yield settle(b.slice(*lo))
        left = b.slice(cut)
    if left is not None:
        yield settle(left)


def _whole_groups(anchors: np.ndarray, most: int = 4096) -> Iterator[tuple[int, int]]:
    """(first, number) of stretches of whole groups with about ``most`` rows."""
    lo = 0
    while lo < len(anchors):
        hi = len(anchors) if lo + most >= len(anchors) else int(np.searchsorted(anchors, anchors[lo + most], "right"))
        yield lo, hi - lo
        lo = hi


def _listed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 2048):
            rows = b.slice(lo, 2048)
            row, start, key = _windows(rows, length)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([rows.column(0).take(take), rows.column(1).take(take), pa.array(start), pa.array(key.view(np.int64))],
                                             names=["doc_id", "text_hash", "lo", "key"])


def repeated_spans(src: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, lo, hi): byte ranges covered by repeated windows;
    they may overlap. ``src``: doc_id, text, text_hash."""
    spark, id_type = src.sparkSession, src.schema["doc_id"].dataType.simpleString()
    anchors = src.mapInArrow(lean(partial(_anchors, length=length)), "anchor long")
    shared = stored(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "suffix-anchors")
    release(spark)
    found = stored(src.mapInArrow(lean(partial(_runs, length=length)), f"doc_id {id_type}, {RUNS}").join(shared, "anchor"), "suffix-runs")
    release(spark)
    run = ["anchor", "behind", "ahead", "content"]
    classes = stored(found.groupBy(*run).agg(F.count("*").alias("many"), F.min(F.struct("doc_id", "text_hash", "at")).alias("one")),
                     "suffix-classes")
    whole = found.join(classes.filter("many > 1").select(*run), run, "left_semi").select(
        "doc_id", "text_hash", F.col("at").alias("lo"), (F.col("at") + F.col("behind") - F.col("ahead") + length).alias("hi"))
    mixed = stored(classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("many").alias("least"))
                   .filter("kinds > 1 and least = 1").select("anchor", (F.col("kinds") > GROUP).alias("big")), "suffix-mixed")
    release(spark)
    open_ = classes.join(mixed, "anchor").select("one.doc_id", "one.text_hash", F.struct(
        "anchor", "behind", "ahead", "many", "big", F.col("one.at").alias("at")).alias("run"))
    by_text = open_.groupBy("doc_id", "text_hash").agg(F.collect_list("run").alias("runs"))  # at most a text's own runs
    b = by_text.select(F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"), "runs")
    with_text = src.join(b, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash"))).select(
        "doc_id", "text_hash", "text", "runs")
    cut = stored(with_text.mapInArrow(lean(partial(_cut_out, length=length)), f"doc_id {id_type}, {CUT}")
                 .dropDuplicates(["doc_id", "text_hash", "anchor", "behind", "ahead", "at"]), "suffix-open", compression="zstd")
    release(spark)
    part = f"doc_id {id_type}, text_hash int, lo long, hi long"
    some = (cut.filter("not big").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(lean(partial(_repeated, length=length)), part))
    each = stored(cut.filter("big").mapInArrow(lean(partial(_listed, length=length)), f"doc_id {id_type}, text_hash int, lo long, key long"),
                  "suffix-windows")
    twice = stored(each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "suffix-twice")
    many = each.join(twice, "key", "left_semi").select("doc_id", "text_hash", "lo", (F.col("lo") + length).alias("hi"))
    spans = stored(whole.union(some).union(many), "suffix-spans")
    release(spark)
    return spans


KEPT = "kept binary, n_bytes long, n_removed long, n_spans long, removed array<struct<lo:bigint,hi:bigint>>"


def _kept(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for b in batches:
        kept, size, gone, spans = [], [], [], []
        for t, found in zip(b.column(at).cast(pa.large_binary()), b.column(b.num_columns - 1), strict=True):
            t, merged = (t.as_py() or b""), []
            for s in sorted((s["lo"], s["hi"]) for s in found.as_py() or []):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append([*s])
            ends = [0, *(x for m in merged for x in m), len(t)]
            kept.append(b"".join(t[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)))
            size.append(len(t)), gone.append(len(t) - len(kept[-1])), spans.append([{"lo": a, "hi": z} for a, z in merged])
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(kept, pa.binary()), pa.array(size, pa.int64()),
             pa.array(gone, pa.int64()), pa.array(map(len, spans), pa.int64()), pa.array(spans, spans_type)],
            names=[*b.schema.names[:-1], "kept", "n_bytes", "n_removed", "n_spans", "removed"])


def remove(docs: DataFrame, length: int = 200, whole_row: bool = False) -> DataFrame:
    """One row per input row: doc_id, text, if asked for ``row`` (all of the
    input's columns but the text), kept (the remaining bytes), n_bytes, n_removed, n_spans,
    removed (the merged byte ranges)."""
    src = texts(docs).withColumn("text_hash", F.hash("text"))
    spans = repeated_spans(src, length)
    hits = spans.groupBy(F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash")).agg(
        F.collect_set(F.struct("lo", "hi")).alias("found"))
    more = [F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")] if whole_row else []
    row = docs.select("doc_id", "text", *more)
    joined = row.join(hits, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.hash(F.coalesce("text", F.lit(""))) == F.col("b_hash")),
                      "left").select(*row.columns, "found")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row.schema)
    return joined.mapInArrow(lean(partial(_kept, at=1)), f"{schema}, {KEPT}")


def digests(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))




def clean(docs: DataFrame, length: int = 200) -> DataFrame:
    """The same rows and columns, repeated passages cut out of ``text`` and, if
    there, n_chars counted anew. A character that a cut leaves broken goes too."""
    cut = remove(docs, length, whole_row=True)
    whole = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", "")
    text = F.when(F.col("n_removed") > 0, whole).otherwise(F.col("text"))
    return recounted(cut.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]))
