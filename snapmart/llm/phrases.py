"""Collocations by dynamic itemset counting: phrases that come up often, scored
by how strongly they hold together.

Documents are dealt into shards, which are scanned in a cycle, one a step. Words
are counted in the first cycle. A phrase of two words or more becomes active at
the step at which the later of its two subphrases (without its last, without its
first word) reaches the threshold in what has been counted of it so far; from
the next step on it is counted for one full cycle, so phrases of all lengths are
counted in the same scans. Counting ends when a full cycle has made nothing
active.

* A step writes one table of (lang, phrase, count) for its shard. The sum of a
  phrase over the last full cycle of such tables is what has been counted of it
  so far: never more than its true count, and the true count at the end of its
  cycle. So a phrase's count is its largest sum, and phrases below the threshold
  need no record of when they became active.
* Tasks learn which subphrases are active from two bit tables of a fixed size,
  one of those that reached the threshold within the last cycle, one of those
  before. A false hit costs needless counting of a phrase that cannot reach
  the threshold or has reached it already, and changes no result.
* Counts are added up in each slice of text. Phrases travel and are kept many to
  a row, dealt into parts by their hashes: lines of phrases and as many counts.
  A part meets in one task with what it holds of the cycle's other tables, so
  one shuffle a step gives the shard's table and the sums over the cycle, and
  phrases below the threshold never become rows. The number of parts grows with
  the texts. Phrases are told apart by themselves; hashes only deal them.

Text: A-Z in lower case, split at ``.,;:!?`` and line ends into pieces, pieces
into words at spaces and tabs. Cases: null text is the empty one and gives
nothing; a null lang counts as ``und``; repeated rows count each time; null ids
are like others (ids are not read); an empty table gives no rows; other columns
are ignored. All ties are ordered (see ``collocations``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import release, stored
from snapmart.llm.hashing import LOWER, WORDS, U, mix
from snapmart.llm.workers import lean
from snapmart.session import input_bytes, scratch_path

LONGEST = 4  # words of a phrase
BITS = 25  # a bit table holds 2**BITS bits, 4 MB
SLICE = 1 << 21  # bytes of texts of one language that are counted together
PART = 1 << 22  # bytes of stored texts for each part that phrases are dealt into
#: Phrases of one part, language and length: a line each, their counts, and the counts' sum.
LINES = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("length", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])
LINES_DDL = "part int, lang string, length int, phrases binary, counts binary, n long"
PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("length", pa.int32()), ("f", pa.int64())])

# What ends a piece, what separates words.
BREAK, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
BREAKS = np.zeros(256, bool)
BREAKS[list(BREAK)] = True
LETTERS = ~BREAKS
LETTERS[list(BLANK)] = False

ENDS = re.compile(b"[" + re.escape(BREAK) + b"]")

Bits = np.ndarray


class Words:
    """The words of a slice: where they stand, their numbers and hashes, and
    up to which word the piece of each goes on."""

    def __init__(self, texts: list[bytes]):
        data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        letter = LETTERS[data]
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        if letter[0]:
            edge = np.append(0, edge)
        start, end = edge[::2], edge[1::2]
        self.n = len(start)
        size = end - start
        piece = np.cumsum(BREAKS[data])[start] if self.n else start
        last = np.append(np.flatnonzero(np.diff(piece)), self.n - 1)
        self.room = np.repeat(last, np.diff(np.append(-1, last))) - np.arange(self.n)  # words behind in the piece
        stop = np.zeros(len(data), bool)
        stop[end] = True
        data[stop] = 32
        self.spaced = data[letter | stop]  # every word and a space
        self.at = np.cumsum(size + 1) - size - 1
        self.size = size
        offsets = np.append(0, np.cumsum(size)).astype(np.int32)
        coded = pa.StringArray.from_buffers(self.n, pa.py_buffer(offsets), pa.py_buffer(data[letter])).dictionary_encode()
        self.number = np.asarray(coded.indices).astype(np.int64)
        spelled = coded.dictionary
        own = np.frombuffer(spelled.buffers()[1], np.int32)[:len(spelled) + 1].astype(np.int64)
        letters = np.frombuffer(spelled.buffers()[2] or b"", np.uint8)[:own[-1]]
        self.hashes = WORDS.ranges(WORDS.prefix(letters), own[:-1], own[1:])[self.number]

    def lines(self, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The phrases that begin with the given words, a line each, and where the lines start and the last ends."""
        begin = self.at[first]
        size = self.at[first + length - 1] + self.size[first + length - 1] + 1 - begin
        offsets = np.append(0, np.cumsum(size))
        take = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
        data = self.spaced[take]
        data[offsets[1:] - 1] = 10
        return data, offsets


def _hit(bits: Bits, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> U(64 - (8 * len(bits)).bit_length() + 1)
    return (bits[(place >> U(3)).astype(np.int64)] >> (place & U(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def _longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more."""
    return mix(hashes * U(0x9E3779B97F4A7C15) + word)


def _lang(hashes: np.ndarray, lang: str) -> np.ndarray:
    seed = WORDS.prefix(np.frombuffer(lang.encode(), np.uint8))[-1]
    return mix(hashes ^ mix(np.array([seed + U(1)], np.uint64)))


def _lines(part: np.ndarray, lang: str, length: int, data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Lines of phrases and their counts, ordered by part, as one row a part."""
    parts, begin = np.unique(part, return_index=True)
    ends = np.append(begin, len(part))
    counts = counts.astype("<i8")
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.repeat(lang, len(parts)).cast(pa.string()), pa.repeat(pa.scalar(length, pa.int32()), len(parts)),
         pa.BinaryArray.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offsets[ends].astype(np.int32)), pa.py_buffer(data)]),
         pa.BinaryArray.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer((8 * ends).astype(np.int32)), pa.py_buffer(counts)]),
         pa.array(np.add.reduceat(counts, begin), pa.int64())], schema=LINES)


def count_slice(texts: list[bytes], lang: str, all_words: bool, recent: Bits | None, older: Bits | None, parts: int) -> Iterator[pa.RecordBatch]:
    """Phrases of one length each with their counts: words, if asked for, and the active phrases."""
    words = Words(texts)
    if not words.n:
        return

    def dealt(first, length, hashes, many):
        part = (hashes % U(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        return _lines(part[order], lang, length, *words.lines(first[order], length), many[order])
    here = np.arange(words.n)
    hashes = of_word = _lang(words.hashes, lang)
    if all_words:
        first, many = np.unique(words.number, return_index=True, return_counts=True)[1:]
        yield dealt(first, 1, hashes[first], many)
    if recent is None:
        return
    for length in range(2, LONGEST + 1):
        # which of the phrases one word shorter (those at ``here``) have reached the threshold, and when
        now = _hit(recent, hashes)
        ever = now | _hit(older, hashes)
        all_hashes = np.zeros(words.n + 1, np.uint64)
        state = np.zeros(words.n + 1, np.uint8)
        all_hashes[here], state[here] = hashes, ever + 2 * (ever & now)
        left, right = state[here], state[here + 1]
        both = (left & 1 & right).astype(bool) & (words.room[here] >= length - 1)
        if not both.any():
            return
        chosen = ((left | right) >= 2)[both]
        here = here[both]
        hashes = _longer(all_hashes[here], of_word[here + length - 1])
        active = here[chosen]
        if not len(active):
            continue
        key = words.number[active] << 32 | words.number[active + 1]
        if length == 3:  # more than two numbers do not fit one key: pairs are numbered anew
            key = np.unique(key, return_inverse=True)[1] << 32 | words.number[active + 2]
        elif length == 4:
            more = words.number[active + 2] << 32 | words.number[active + 3]
            numbers = np.unique(np.concatenate([key, more]), return_inverse=True)[1]
            key = numbers[:len(active)] << 32 | numbers[len(active):]
        first, many = np.unique(key, return_index=True, return_counts=True)[1:]
        yield dealt(active[first], length, hashes[chosen][first], many)


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """A long text, cut where pieces end."""
    lo = 0
    while len(text) - lo > most and (end := ENDS.search(text, lo + most)):
        yield text[lo:end.start()]
        lo = end.end()
    yield text[lo:] if lo else text


def _count(batches: Iterator[pa.RecordBatch], all_words: bool, active: Broadcast | None, most: int, parts: int) -> Iterator[pa.RecordBatch]:
    recent, older = active.value if active else (None, None)

    def counted(texts, lang):
        return count_slice(texts, lang, all_words, recent, older, parts)
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            *whole, text = _parts(text, most)
            for part in whole:
                yield from counted([part], lang)
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] >= most:
                del sizes[lang]
                yield from counted(waiting.pop(lang), lang)
        while sum(sizes.values()) >= 8 * most:  # very many languages
            lang = max(sizes, key=sizes.get)
            del sizes[lang]
            yield from counted(waiting.pop(lang), lang)
    for lang, texts in waiting.items():
        yield from counted(texts, lang)


def _read(lines: list[pa.Scalar]) -> pa.Array:
    """The phrases of some rows, each with its line end."""
    data = np.frombuffer(b"".join(p.as_buffer() for p in lines), np.uint8)
    offsets = np.append(0, np.flatnonzero(data == 10) + 1)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def _written(phrases: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lines of phrases that end in line ends, and where they start and the last ends."""
    off = np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset:phrases.offset + len(phrases) + 1]
    return np.frombuffer(phrases.buffers()[2] or b"", np.uint8)[off[0]:off[-1]], off - off[0]


def _summed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of whole parts: the new rows added up, and the sums of new and older
    ones that reach ``least``. The last column says which rows are new, and then
    which are sums."""
    held: dict[tuple[int, str, int], list[tuple[pa.Scalar, pa.Scalar, bool]]] = {}
    for b in batches:
        keys = zip(*(b.column(c).to_pylist() for c in ("part", "lang", "length")), strict=True)
        for key, *row in zip(keys, b.column("phrases"), b.column("counts"), b.column("new").to_pylist(), strict=True):
            held.setdefault(key, []).append(row)
    while held:
        (part, lang, length), rows = held.popitem()
        coded = _read([p for p, _, _ in rows]).dictionary_encode()
        number, spelled = np.asarray(coded.indices), coded.dictionary
        counts = np.frombuffer(b"".join(c.as_buffer() for _, c, _ in rows), "<i8")
        new = np.repeat([n for _, _, n in rows], [len(c.as_buffer()) // 8 for _, c, _ in rows])
        # as doubles, whole numbers are exact up to 2**53
        own = np.bincount(number[new], counts[new], len(spelled)).astype(np.int64)
        every = own + np.bincount(number[~new], counts[~new], len(spelled)).astype(np.int64)
        for sums, n, chosen in ((False, own, own > 0), (True, every, every >= least)):
            if chosen.any():
                out = _lines(np.full(chosen.sum(), part), lang, length, *_written(spelled.filter(pa.array(chosen))), n[chosen])
                yield out.append_column("sums", pa.array([sums]))


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each phrase."""
    for b in batches:
        for lang, length, phrases, counts in zip(b.column("lang").to_pylist(), b.column("length").to_pylist(), b.column("phrases"), b.column("counts"), strict=True):
            spelled = pc.utf8_slice_codeunits(_read([phrases]), 0, -1).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(spelled)).cast(pa.string()), spelled, pa.repeat(pa.scalar(length, pa.int32()), len(spelled)),
                 pa.array(np.frombuffer(counts.as_buffer(), "<i8"), pa.int64())], schema=PHRASES)


def _places(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The bits of phrases: which 64 of them, and which of those."""
    for b in batches:
        of = b.column("lang").dictionary_encode()
        for k, lang in enumerate(of.dictionary.to_pylist()):
            words = Words([p.encode() for p in b.column("phrase").filter(pc.equal(of.indices, k)).to_pylist()])
            one = _lang(words.hashes, lang)
            at = np.append(0, np.flatnonzero(words.room == 0)[:-1] + 1)  # the first word of each phrase
            h = one[at]
            for n in range(1, LONGEST):
                more = words.room[at] >= n
                h[more] = _longer(h[more], one[at[more] + n])
            place = (h >> U(64 - size)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array((U(1) << (place & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])


def _bits(reached: DataFrame, size: int) -> Bits:
    """The bit table of some phrases: at most 2**(size - 6) rows come to the driver, however many phrases there are."""
    rows = (reached.select("lang", "phrase").mapInArrow(lean(partial(_places, size=size)), "word long, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << (size - 6), np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def _dealt(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Documents in a table of their own with a shard number each, evenly
    whatever they hold; and into how many parts their phrases are dealt."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"),
                       (F.monotonically_increasing_id() % shards).cast("int").alias("shard"))
    path = scratch_path(spark, "phrase-shards")
    rows.write.partitionBy("shard").parquet(path)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(spark, path) // PART)
    return spark.read.schema(rows.schema).parquet(path), parts


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def _so_far(tables: list[DataFrame], likely: list[DataFrame]) -> DataFrame:
    """The rows of phrases that one of the tables makes likely. These few are
    hashed, not sorted: a merge would sort all rows of all tables by their phrases."""
    return _union(tables).join(_union(likely).hint("shuffle_hash"), ["lang", "phrase"], "left_semi")


def _step(new: DataFrame, tables: list[DataFrame], least: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """A step's table and the sums that reach ``least`` in it and the cycle's other tables."""
    rows = _union([new.withColumn("new", F.lit(True)), *(t.withColumn("new", F.lit(False)) for t in tables)])
    summed = rows.repartition(parts, "part").mapInArrow(lean(partial(_summed, least=least)), f"{LINES_DDL}, sums boolean")
    path = scratch_path(new.sparkSession, "phrase-counts")
    summed.write.partitionBy("sums").parquet(path)
    both = new.sparkSession.read.schema(summed.schema).parquet(path)
    table, sums = (both.filter(F.col("sums") == kind).drop("sums") for kind in (False, True))
    return table, stored(sums.mapInArrow(lean(_spread), "lang string, phrase string, length int, f long"), "phrase-sums")


def count_phrases(docs: DataFrame, least: int, shards: int = 3, bits: int = BITS, slice_bytes: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of up to LONGEST words that come up ``least``
    times or more in their language (lang, phrase, length, f), and the number of
    words of each language (lang, n)."""
    spark = docs.sparkSession
    dealt, parts = _dealt(docs, shards)
    tables, frequent, news = [], [], []
    older = np.zeros(1 << (bits - 3), np.uint8)
    while True:
        step = len(tables)
        recent = np.bitwise_or.reduce(news) if news else None
        if step >= shards and not recent.any():
            break
        active = spark.sparkContext.broadcast((recent, older)) if news else None
        scan = dealt.filter(F.col("shard") == step % shards).select("lang", "text")
        counts = scan.mapInArrow(lean(partial(_count, all_words=step < shards, active=active, most=slice_bytes, parts=parts)), LINES_DDL)
        table, sums = _step(counts, tables[max(0, step - shards + 1):], least, parts)
        tables.append(table)
        reached = sums.filter(F.col("length") < LONGEST).select("lang", "phrase")
        if frequent:
            reached = reached.join(_union(frequent), ["lang", "phrase"], "left_anti")
        frequent.append(sums)
        news.append(_bits(reached, bits))
        if len(news) > shards:
            older |= news.pop(0)
        if active:
            active.destroy()
        release(spark)
    counted = _union(frequent).groupBy("lang", "phrase", "length").agg(F.max("f").alias("f"))
    words = _union(tables[:shards]).filter(F.col("length") == 1).groupBy("lang").agg(F.sum("n").alias("n"))
    return stored(counted, "phrases"), words


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(25,0)")


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, **counting) -> DataFrame:
    """The ``most`` best phrases of two words or more of each language.

    A phrase is cut after each of its words; a cut scores
    floor(2000000 * a / (l + r)), a, l and r being the counts of the phrase and
    of the two parts, and the lowest cut (then the first) is the phrase's. A
    phrase within a longer one that has four fifths of its count or more goes.
    Order: score, then a, largest first, then the phrase by its UTF-8 bytes.
    ``counting``: see ``count_phrases``. Columns: lang, rank, phrase, a, l, r, n (words of the language), score.
    """
    counted, words = count_phrases(docs, least, **counting)
    found = counted.filter(F.col("length") > 1).withColumnRenamed("f", "a")
    k = F.explode(F.sequence(F.lit(1), F.col("length") - 1))
    cuts = found.withColumn("k", k).withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumns({c: _exact(c) for c in "alr"}).withColumn("score", F.expr("2000000 * a div (l + r)"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = ("flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1),"
             " i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    longer = (found.filter(F.col("length") > 2).select("lang", F.explode(F.expr(inner)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * _exact("longer") < 80 * F.col("a")))
    place = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(place).cast("long")).filter(F.col("rank") <= most)
    return best.join(words, "lang").select(
        "lang", "rank", "phrase", *(c.cast("long") for c in (F.col("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"))),
        "n", F.col("cut.score").alias("score"))
