"""Secret scan with corpus-wide ownership frequency.

One pass finds candidate spans in every whole text. A candidate's value is
then known only by its SHA-256; the hashes are aggregated over the corpus by
distinct repository and owner. A value held by many owners is an example
copied around; one held by few looks live. Owners count over distinct documents: a
value that all its many owners hold in near copies of a few documents is still
one of those few. Documents are told apart by sketches of their five-word
shingles (see ``distinct_documents``). Fixed-format spans (``assign``,
``access``, ``hex``) are always reported; opaque mixed-case runs are added
(kind ``opaque``) only where the ownership count says that they look live.

Cases: null text is empty and gives no spans; a null repository or owner
counts as one unnamed repository or owner; a repeated row counts once more as
a document but not as an owner; rows keep their own result each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm import jaccard
from snapmart.llm.common import recounted, stored
from snapmart.llm.workers import lean

# Span kinds in order of listing and their patterns.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a leftmost run of 24 or more is a whole run
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
MIN_ASSIGN, MIN_ACCESS = 6, 20


def find_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of one text, by start then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted(out)
    for m in OPAQUE.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and v.upper() != v != v.lower() and not any(
                s < m.end() and m.start() < e for s, _, e, _ in base):
            out.append((m.start(), 3, m.end(), v))
    return sorted(out)


SPANS = "array<struct<start:int,kind:int,end:int,hash:string>>"
BINS = 64  # a sketch is the smallest shingle hash of each bin, by 32 bits
ALIKE = 0.7  # estimated similarity of near copies; copies of 0.8 and more lie above it but for rare chance
PARTS = 64  # a value's documents are told apart in so many parts first


def sketch(text: str) -> bytes:
    """The smallest five-word shingle hash in each of ``BINS`` ranges, 0 where there is none."""
    data = np.frombuffer(text.encode(), np.uint8)
    grams = next(jaccard.shingle_sets(data, np.array([0, len(data)]), 5))
    bins, first = np.unique((grams >> np.uint64(58)).astype(np.int64), return_index=True)
    out = np.zeros(BINS, "<u4")
    out[bins] = (grams[first] >> np.uint64(26)).astype("<u4")
    return out.tobytes()


def _scan(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))
    for b in batches:
        spans, sketches = [], []
        for t in (t.as_py() or "" for t in b.column(n_keys)):
            found = find_spans(t)
            spans.append([{"start": s, "kind": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()} for s, k, e, v in found])
            sketches.append(sketch(t) if found else None)
        cols = [b.column(i) for i in range(n_keys)] + [pa.array(spans, kind), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=[b.schema.field(i).name for i in range(n_keys)] + ["spans", "sketch"])


def candidates(docs: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """Per row: row number, doc_id, repository, owner, candidate spans and, with
    any, the text's sketch, stored once, so texts are scanned once and never shuffled."""
    src = docs.select("doc_id", repo.cast("string").alias("repo"), owner.cast("string").alias("owner"),
                      F.col("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    found = src.mapInArrow(lean(partial(_scan, n_keys=3)), f"doc_id {id_type}, repo string, owner string, spans {SPANS}, sketch binary")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: distinct repositories and owners, and spans.
    A value that a third of all rows hold shrinks before the shuffle to one
    row for each (repository, owner) and task."""
    seen = (found.select(F.explode("spans.hash").alias("hash"), "repo", "owner")
            .groupBy("hash", "repo", "owner").agg(F.count("*").alias("n")))
    name = lambda c: F.coalesce(F.col(c), F.lit(""))
    return seen.groupBy("hash").agg(
        F.countDistinct(name("repo")).alias("n_repos"), F.countDistinct(name("owner")).alias("n_owners"),
        F.sum("n").alias("n_spans"))


def _unlike(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of each key's sketches (sorted by key) those unlike all kept before, ``most`` at most."""
    key, kept = None, np.zeros((0, BINS), "<u4")
    for b in batches:
        rows = []
        for i, k in enumerate(b.column("key").to_pylist()):
            if k != key:
                key, kept = k, kept[:0]
            if len(kept) == most:
                continue
            mine = np.frombuffer(b.column("sketch")[i].as_buffer(), "<u4")
            same = ((kept == mine) & (mine > 0)).sum(axis=1)
            if not (same >= ALIKE * ((kept > 0) | (mine > 0)).sum(axis=1)).any():
                kept = np.vstack([kept, mine])
                rows.append(i)
        yield b.select(["hash", "sketch"]).take(pa.array(rows, pa.int64()))


def distinct_documents(found: DataFrame, hashes: DataFrame, most: int) -> DataFrame:
    """(hash, n_docs) of each of ``hashes``: documents holding it that are no
    near copies of one another, counted up to ``most``, which is all that a
    limit under ``most`` asks. Equal sketches are one row before the shuffle. The
    rest is sifted in ``PARTS`` parts for each value, then the at most ``most`` survivors of
    each part together: a task holds ``most`` sketches, whatever a value's share of the rows."""
    rows = (found.filter(F.size("spans") > 0).select(F.explode(F.array_distinct("spans.hash")).alias("hash"), "sketch")
            .join(hashes.select("hash"), "hash", "left_semi").distinct())
    for key in (F.concat("hash", F.pmod(F.xxhash64("sketch"), F.lit(PARTS)).cast("string")), F.col("hash")):
        rows = (rows.withColumn("key", key).repartition("key").sortWithinPartitions("key", "sketch")
                .mapInArrow(partial(_unlike, most=most), "hash string, sketch binary"))
    return rows.groupBy("hash").agg(F.count("*").alias("n_docs"))


def scan(docs: DataFrame, repo: Column | None = None, owner: Column | None = None,
         max_owners: int = 3, max_repos: int = 6) -> DataFrame:
    """One row per input row: doc_id and ``spans`` (start, kind, end, hash,
    n_owners, n_repos, live), by start then kind. ``live``: held by at most
    ``max_owners`` owners and ``max_repos`` repositories with documents of their own."""
    repo = F.concat_ws("/", "source", "lang") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    found = candidates(docs, repo, owner)
    owned = stored(ownership(found), "secret-owners")
    wide = owned.filter((F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos))
    n_docs = distinct_documents(found, wide, max(max_owners, max_repos) + 1)
    owned = stored(owned.join(n_docs, "hash", "left"), "secret-documents")
    one = found.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*")
    told = (one.join(owned, "hash").groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "hash", "n_owners", "n_repos",
        ((F.least("n_owners", "n_docs") <= max_owners)  # null n_docs: not asked, held by few
         & (F.least("n_repos", "n_docs") <= max_repos)).alias("live")))).alias("spans")))
    return found.select("row", "doc_id").join(told, "row", "left").drop("row")


def reported(spans: str = "spans") -> Column:
    """Spans that count: fixed-format ones, and opaque ones that look live."""
    return F.filter(F.coalesce(F.col(spans), F.array()), lambda s: (s.kind < 3) | s.live)


def digests(scanned: DataFrame) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    said = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s.kind + 1), s.start.cast("string"), s.end.cast("string"))))
    every = scanned.select("doc_id", reported().alias("every"))
    base = F.filter("every", lambda s: s.kind < 3)
    count = lambda k: F.size(F.filter("every", lambda s: s.kind == k)).cast("long")
    return every.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(said(base), 256).alias("base_sha256"), said(F.col("every")).alias("spans"),
        F.size(F.filter("every", lambda s: s.live)).cast("long").alias("n_live"))


def _redact(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t, spans in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
            for s in sorted(spans or [], key=lambda s: -s["start"]):
                t = t[:s["start"]] + MASK + t[s["end"]:]
            out.append(t)
        cols = [pa.array(out, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])


MASK = "[secret]"


def redact(docs: DataFrame, **options) -> DataFrame:
    """The same rows and columns, live-looking spans in ``text`` replaced by
    a mask; widely copied examples stay. Overlapping spans are merged first.
    Rows are told apart by doc_id and text."""
    key = [F.col("doc_id"), F.xxhash64("text").alias("text_hash")]
    spans = scan(docs.withColumn("doc_id", F.struct(*key)), **options)
    live = spans.select("doc_id", F.filter(reported(), lambda s: s.live).alias("hit")).filter(F.size("hit") > 0)
    merged = F.aggregate(
        "hit", F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1).end > s.start),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1).start.alias("start"), F.greatest(F.element_at(acc, -1).end, s.end).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(s.start.alias("start"), s.end.alias("end"))))))
    hits = live.groupBy(F.col("doc_id.doc_id").alias("hit_id"), F.col("doc_id.text_hash").alias("hit_hash")).agg(
        F.first("hit").alias("hit")).select("hit_id", "hit_hash", merged.alias("hit"))
    joined = docs.join(hits, docs["doc_id"].eqNullSafe(hits["hit_id"]) & (F.xxhash64(docs["text"]) == hits["hit_hash"]),
                       "left").select(*[docs[c] for c in docs.columns], hits["hit"])
    return recounted(joined.mapInArrow(lean(partial(_redact, at=docs.columns.index("text"))), docs.schema))
