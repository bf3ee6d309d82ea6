"""Byte-level BPE of whole texts, long ones by tree concatenation, and back.

Ordinary texts are encoded piece by piece (see ``tokens``). A long text becomes
rows that are encoded anywhere in the cluster: stretches between safe cuts, and
where there is no safe cut for ``UNSPLIT`` characters, the halves of halves of
that stretch. The halves are joined pairwise, as a tree:

* Splitting into words looks at most two characters ahead, so all but the last
  words of the left half are final; from there the words are read anew until a
  word ends where a word of the right half ends.
* Within one word that spans the joint, a window of ids on both sides is decoded
  and encoded again, and grows until its first id agrees with the left half's
  and its last with the right half's. Then every two neighbouring ids are
  neighbours in an encoding of their own text, which for merges by rank makes
  the whole sequence the encoding of the whole word.

Cases: null text is the empty one and has no ids; special strings of the
vocabulary become their ids, as the library does; repeated rows are encoded
each; null ids are kept; an empty table gives no rows; other columns are
ignored. A text's ids are gathered in one task, as its text is one row.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm import tokens
from snapmart.llm.common import stored, texts

# Fixed value: how the tokenizer splits text into words.
WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

LONG = 1 << 16  # characters; longer texts are encoded in several tasks
UNSPLIT = 2048  # characters without a safe cut before they are halved
LEAF = 1024
WINDOW = 8
STRETCH = 4096  # pieces that are encoded in one go

#: A stretch of text as words: (word, its ids).
Words = list[tuple[str, list[int]]]

_bytes: dict[str, list[bytes]] = {}


def id_bytes(path: str) -> list[bytes]:
    """The bytes of each id. The vocabulary writes a byte as a character: the
    printable ones of Latin-1 as themselves, the rest, in order, from 256 on."""
    if path not in _bytes:
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        rest = [b for b in range(256) if b not in own]
        char = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        with open(path, encoding="utf-8") as file:  # all that decoding needs, in less memory than the library
            said = json.load(file)
        vocab = said["model"]["vocab"] | {t["content"]: t["id"] for t in said["added_tokens"]}
        found = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            found[i] = bytes(char[c] for c in t) if all(c in char for c in t) else t.encode()
        _bytes[path] = found
    return _bytes[path]


def encode_words(path: str, text: str) -> Words:
    """One leaf: its words, each with its ids."""
    words = WORD.findall(text)
    return list(zip(words, (array("I", i).tolist() for i in tokens.library_ids(path, words)), strict=True))


def seam(path: str, left: list[int], right: list[int]) -> list[int]:
    """The ids of one word from the ids of its two parts."""
    table, k = id_bytes(path), WINDOW
    inner = lambda i: 0x80 <= table[i][0] < 0xC0  # starts within a character
    while True:
        i, j = max(0, len(left) - k), min(len(right), k)
        while i and inner(left[i]):
            i -= 1
        while j < len(right) and inner(right[j]):
            j += 1
        text = b"".join(table[x] for x in left[i:] + right[:j]).decode()
        mid = array("I", tokens.library_ids(path, [text])[0]).tolist()
        if (not i or mid[0] == left[i]) and (j == len(right) or mid[-1] == right[j - 1]):
            return left[:i] + mid + right[j:]
        k *= 2


def concatenate(path: str, left: Words, right: Words) -> Words:
    """The words of two neighbouring stretches as one."""
    if not left or not right:
        return left or right
    at = len(left)
    seen = 0
    while at and seen < 3:  # words that end within the last two characters may go on
        at -= 1
        seen += len(left[at][0])
    tail, head = left[at:], left[:at]
    before = "".join(w for w, _ in tail)
    joint = len(before)
    ends, pos = {}, joint
    for n, (w, _) in enumerate(right):
        pos += len(w)
        ends[pos] = n
    text = before + "".join(w for w, _ in right)
    known = {(0, w): ids for w, ids in tail} | {(1, right[0][0]): right[0][1]}
    pos, fresh = 0, []
    while True:
        m = WORD.match(text, pos)
        word, start = m[0], pos
        if start < joint < m.end():
            a, b = word[:joint - start], word[joint - start:]
            ids = [known.get((side, part)) or array("I", tokens.library_ids(path, [part])[0]).tolist()
                   for side, part in ((0, a), (1, b))]
            if WORD.fullmatch(a) and WORD.fullmatch(b):
                fresh.append((word, seam(path, *ids)))
            else:  # parts that are not words by themselves, such as an apostrophe and its letter
                fresh.append((word, array("I", tokens.library_ids(path, [word])[0]).tolist()))
        else:
            fresh.append((word, array("I", tokens.library_ids(path, [word])[0]).tolist()))
        pos = m.end()
        if pos >= joint and (pos == joint or pos in ends):
            return head + fresh + (right if pos == joint else right[ends[pos] + 1:])


def tree(path: str, leaves: list[Words]) -> Words:
    """Join neighbours, then neighbours of those, until one is left."""
    while len(leaves) > 1:
        leaves = [concatenate(path, *leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0] if leaves else []


def halves(text: str, leaf: int = LEAF) -> list[str]:
    if len(text) <= leaf:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], leaf) + halves(text[mid:], leaf)


def split_long(text: str, specials: list[str], unsplit: int = UNSPLIT, leaf: int = LEAF) -> list[tuple[int, int, str]]:
    """(kind, unit, text) in order. Kinds: 0 a stretch to encode as it is, 2 a
    leaf of a halved unit; special strings are stretches of their own."""
    parts = regex.split("(" + "|".join(map(regex.escape, specials)) + ")", text) if specials else [text]
    out, unit = [], 0
    for n, part in enumerate(parts):
        if n % 2:
            out.append((0, unit, part))
            unit += 1
            continue
        plain: list[str] = []
        for piece in (*tokens.pieces(part), None):
            if piece is None or len(piece) > unsplit or len(plain) == STRETCH:
                if plain:
                    out.append((0, unit, "".join(plain)))
                    unit, plain = unit + 1, []
            if piece is None:
                break
            if len(piece) > unsplit:
                out += [(2, unit, h) for h in halves(piece, leaf)]
                unit += 1
            else:
                plain.append(piece)
    return out


def _specials(path: str) -> list[str]:
    return sorted((t.content for t in tokens.tokenizer(path)[0].get_added_tokens_decoder().values()), key=len, reverse=True)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1024):
            rows = b.slice(lo, 1024)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(list(tokens.encode(path, rows.column(1).to_pylist(), tokens.pieces)), pa.binary())],
                names=["doc_id", "ids"])


def _split(batches: Iterator[pa.RecordBatch], path: str, unsplit: int, leaf: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            parts = split_long(b.column(1)[i].as_py(), _specials(path), unsplit, leaf)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([i] * len(parts))), pa.array(range(len(parts)), pa.int32()),
                 *(pa.array([p[k] for p in parts], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string())))],
                names=["row", "seq", "kind", "unit", "text"])


def _encode_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, counts = [], []
        for kind, text in zip(b.column("kind").to_pylist(), b.column("text").to_pylist(), strict=True):
            if kind:
                words = encode_words(path, text)
                counts.append([len(i) for _, i in words])
                ids.append(array("I", [x for _, i in words for x in i]).tobytes())
            else:
                counts.append([])
                ids.extend(tokens.encode(path, [text], tokens.pieces))
        leaf = [t if k else None for k, t in zip(b.column("kind").to_pylist(), b.column("text").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("seq"), b.column("unit"), pa.array(leaf, pa.string()), pa.array(ids, pa.binary()),
             pa.array(counts, pa.list_(pa.int32()))], names=["row", "seq", "unit", "leaf", "ids", "counts"])


def _gather(rows: pd.DataFrame, path: str) -> pd.DataFrame:
    rows = rows.sort_values("seq")
    out = b""
    for _, unit in rows.groupby("unit", sort=True):
        if unit["leaf"].isna().all():
            out += b"".join(unit["ids"])
            continue
        leaves = []
        for text, ids, counts in zip(unit["leaf"], unit["ids"], unit["counts"], strict=True):
            ids, ends = np.frombuffer(ids, "<u4").tolist(), np.cumsum(counts).tolist()
            leaves.append([(w, ids[z - c:z]) for w, c, z in zip(WORD.findall(text), counts, ends, strict=True)])
        out += array("I", [x for _, i in tree(path, leaves) for x in i]).tobytes()
    return pd.DataFrame({"row": [rows["row"].iloc[0]], "ids": [out]})


def encode(docs: DataFrame, path: str, unsplit: int = UNSPLIT, leaf: int = LEAF, long: int = LONG) -> DataFrame:
    """One row per input row: doc_id and ids (binary, see ``tokens``)."""
    src = texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()
    hard = (F.length("text") > long) | F.col("text").rlike(f"[^ \\n]{{{unsplit + 1}}}")
    short = src.filter(~hard).mapInArrow(partial(_encode, path=path), f"doc_id {id_type}, ids binary")
    rest = stored(src.filter(hard).withColumn("row", F.monotonically_increasing_id()), "bpe-long")
    parts = rest.select("row", "text").mapInArrow(
        partial(_split, path=path, unsplit=unsplit, leaf=leaf), "row long, seq int, kind int, unit int, text string")
    done = parts.repartition("row", "seq").mapInArrow(
        partial(_encode_parts, path=path), "row long, seq int, unit int, leaf string, ids binary, counts array<int>")

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        return _gather(rows, path)
    joined = done.groupBy("row").applyInPandas(gather, "row long, ids binary")
    return short.union(rest.select("row", "doc_id").join(joined, "row", "left").select(
        "doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")))


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = id_bytes(path)
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            rows = b.slice(lo, 256)
            out = [b"".join(map(table.__getitem__, np.frombuffer(i.as_buffer(), "<u4").tolist())).decode("utf-8", "replace")
                   for i in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(out, pa.string())], names=["doc_id", "ids", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text that the ids decode to, special ids as their strings."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, path=path), f"doc_id {id_type}, ids binary, text string")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
