"""Token counts of every prefix of a text, by dynamic programming over its bytes.

For merges by rank, the encoding of a prefix is the encoding of a shorter prefix
and one token more: the only token that ends there and stays apart from the
last token of the shorter prefix, whatever merges run over both. So one pass
over a word's bytes keeps, for each prefix, its last token and its count. Two
tokens stay apart if no merge joins a piece at the end of the first with a piece
at the start of the second while both pieces exist.

Around that, what the tokenizer does before merging is followed for each prefix:
a prefix that ends within white space has that white space as one word, one that
ends within ``'re``, ``'ve`` or ``'ll`` has an apostrophe and letters, and one
that ends within a special string has ordinary text. ``counts`` holds, for every
prefix of one character or more, the count that the library gives for that
prefix, so truncations and budgets are looked up and nothing is encoded again.

Cases: null text is the empty one, with no prefix and no tokens; special strings
count as one token, as the library's default has it; repeated rows are counted
each; null ids are kept; an empty table gives no rows; other columns are
ignored. A text, being one row, is counted in one task, in time and memory in
proportion to its length; no text and no word has a longest size.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm import tokens
from snapmart.llm.bpe import id_bytes
from snapmart.llm.common import texts

REMEMBERED = 400_000  # pieces, and words, in each of two generations: those met again outlive the others
SHORT = 64  # characters; longer pieces and words are counted each time
PAIRS = 1 << 20  # pairs of tokens whose verdict is remembered
SLICE = 1 << 20  # characters whose counts go out together
SHARE = 4096  # characters whose counts fit two bytes beside the count before them; SHORT at least
OTHER = re.compile(r"[^\S \n]")
BLANK = regex.compile(r"\p{White_Space}+")
NEVER = 1 << 62

# Contractions of three characters, which no prefix of them is; how the
# tokenizer splits text into words, with the letters, digits and white space of Latin-1.
ENDINGS = {"'re", "'ve", "'ll"}
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


class Merges:
    """The tokenizer's tokens by their bytes, and how each came about."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        vocab = said["model"]["vocab"]
        self.bytes = id_bytes(path)
        self.specials = sorted((t["content"] for t in said["added_tokens"]), key=len, reverse=True)
        special_ids = {t["id"] for t in said["added_tokens"]}
        self.ids = {b: i for i, b in enumerate(self.bytes) if b and i not in special_ids}
        self.size = list(map(len, self.bytes))
        self.longest = max(map(len, self.ids))
        self.rank: dict[int, int] = {}  # (left, right) as one number -> rank of their merge
        self.made = [-1] * len(self.bytes)  # rank at which a token comes about; a single byte is there at first
        self.parts: dict[int, tuple[int, int]] = {}
        for n, pair in enumerate(said["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, both = vocab[a], vocab[b], vocab[a + b]
            self.rank[left << 32 | right] = n
            if both not in self.parts:
                self.parts[both], self.made[both] = (left, right), n
        self.verdicts: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.before = tokens.tokenizer(path)[0].pre_tokenizer
        self.split = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None

    def _edge(self, token: int, side: int) -> list[int]:
        """The pieces at one end of a token as they grow, from a byte to the token."""
        found = [token]
        while token in self.parts:
            token = self.parts[token][side]
            found.append(token)
        return found[::-1]

    def apart(self, left: int, right: int) -> bool:
        """Whether no merge runs over the joint of two tokens, in order of rank."""
        key = left << 32 | right
        verdict = self.verdicts.get(key)
        if verdict is None:
            ends, starts = self._edge(left, 1), self._edge(right, 0)
            i = j = 0
            while True:
                joint = self.rank.get(ends[i] << 32 | starts[j], NEVER)
                grow_left = self.made[ends[i + 1]] if i + 1 < len(ends) else NEVER
                grow_right = self.made[starts[j + 1]] if j + 1 < len(starts) else NEVER
                if joint < grow_left and joint <= grow_right:  # of equal ranks the leftmost pair merges first
                    verdict = False
                elif grow_left == grow_right == NEVER:
                    verdict = True
                elif grow_left <= grow_right:
                    i += 1
                    continue
                else:
                    j += 1
                    continue
                break
            if len(self.verdicts) >= PAIRS:
                self.verdicts.clear()
            self.verdicts[key] = verdict
        return verdict

    def _extend(self, data: bytes, last: list[int], counts: list[int]) -> None:
        """Go on to the end of a word, some bytes of which are done: the last
        token and the count at each. Just one token fits, so the likely ones
        are tried first: one that grows the last token, then short ones."""
        ids, verdict, apart, size = self.ids.get, self.verdicts.get, self.apart, self.size
        for i in range(len(last) + 1, len(data) + 1):
            grown = i - 1 - size[last[-1]] if last else 0
            for j in chain((grown,), range(i - 1, max(-1, i - 1 - self.longest), -1)):
                token = ids(data[j:i])
                if token is not None:
                    if not j:
                        counts.append(1)
                        break
                    fits = verdict(last[j - 1] << 32 | token)
                    if fits or fits is None and apart(last[j - 1], token):
                        counts.append(counts[j - 1] + 1)
                        break
            last.append(token)

    def word(self, data: bytes) -> list[int]:
        """Counts after each byte of one word."""
        counts: list[int] = []
        self._extend(data, [], counts)
        return counts

    def _characters(self, word: str) -> Sequence[int]:
        counts = self.words.get(word)
        if counts is None:
            data = word.encode()
            counts = _whole_characters(data, word, self.word(data))
        return counts

    def learn_words(self, new: set[str]) -> None:
        """Remember the counts of words. In order, they share their beginnings,
        which are counted once. Two generations are kept, as of pieces."""
        if len(self.words) > REMEMBERED:
            self.words, self.older_words = {}, self.words
        before, last, counts = b"", [], []
        for data, word in sorted((w.encode(), w) for w in new.difference(self.words)):
            if (known := self.older_words.get(word)) is None:
                same = 0
                for x, y in zip(before, data, strict=False):
                    if x != y:
                        break
                    same += 1
                del last[same:], counts[same:]
                self._extend(data, last, counts)
                before, known = data, _whole_characters(data, word, counts)
            self.words[word] = known

    def plain(self, text: str) -> list[int]:
        """Counts after each character of a text without special strings."""
        out, base, done = [], 0, 0
        blanks = {m.start(): m.end() for m in BLANK.finditer(text)}
        for start, end in self.words_of(text):
            word = text[start:end]
            counts = self._characters(word)
            if end > done:
                if start in blanks and (blanks[start] > start + 1 or blanks[start] == end):
                    done = blanks[start]  # as prefixes that end in this white space see it: one word
                    out += [base + c for c in self._characters(text[start:done])]
                else:
                    told = counts
                    if word in ENDINGS:
                        told = [counts[0], self._characters("'")[0] + self._characters(word[1])[0], counts[2]]
                    out += [base + c for c in told[max(done - start, 0):]]
                    done = end
            base += counts[-1]
        return out

    def words_of(self, text: str) -> list[tuple[int, int]]:
        if tokens.LATIN(text):
            return [m.span() for m in LATIN_WORD.finditer(text)]
        return [at for _, at in self.before.pre_tokenize_str(text)]

    def piece(self, text: str) -> list[int]:
        """Counts after each character of a piece, special strings and all."""
        found = self.split.search(text) if self.split else None
        if not found:
            return self.plain(text)
        out = self.plain(text[:found.end() - 1])
        total = (out[found.start() - 1] if found.start() else 0) + 1
        return [*out, total, *(total + c for c in self.piece(text[found.end():]))]

    def _shares(self, piece: str, words: list[str] | None) -> list[bytes]:
        """The counts of a piece in shares of at most SHARE characters, each from the end of the share before."""
        if words is None:
            counts = self.piece(piece)
        else:
            counts = []
            for w in words:
                base = counts[-1] if counts else 0
                counts += [base + c for c in self._characters(w)]
        shares, base = [], 0
        for lo in range(0, len(counts), SHARE):
            shares.append(array("h", [c - base for c in counts[lo:lo + SHARE]]).tobytes())
            base = counts[min(lo + SHARE, len(counts)) - 1]
        return shares

    def learn(self, parts: set[str]) -> dict[str, list[bytes]]:
        """Remember the counts of pieces behind a space (or a line feed, which
        they then begin with) and return those of pieces too long for that.
        Two generations are kept: once the younger is full it becomes the
        older one, and what is met again comes back from there."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new, long, words = {}, {}, set()
        for part in parts:
            if (share := self.older.get(part)) is not None:
                self.known[part] = share
                continue
            piece = part if part[:1] == "\n" else " " + part
            new[part] = piece, _simple(piece)
            words.update(w for w in new[part][1] or () if len(w) <= SHORT)
        self.learn_words(words)
        for part, (piece, own) in new.items():
            shares = self._shares(piece, own)
            if len(part) < SHORT:
                self.known[part] = shares[0]
            else:
                long[part] = shares
        return long

    def counted(self, group: list[str]) -> list[list[bytes]]:
        """Texts' counts in shares (little-endian, two bytes a character)."""
        cut, missing = [], set()
        for text in group:
            first, *rest = text.replace("\n", " \n").split(" ")
            if OTHER.search(text) or not (first or not rest) or first == "\n" or "" in rest or "\n" in rest:
                first, *rest = tokens.pieces(text)  # white space that is not a single character within the text
                rest = [p[1:] if p[0] == " " else p for p in rest]
            found = list(map(self.known.get, rest))
            new = None in found
            if new:
                missing.update(p for p, share in zip(rest, found, strict=True) if share is None)
            cut.append((first, rest, found, new))
        long = self.learn(missing) if missing else {}
        out = []
        for first, rest, found, new in cut:
            shares = self._shares(first, None)
            if not new:
                out.append(shares + found)
                continue
            for part, share in zip(rest, found, strict=True):
                if share is not None:
                    shares.append(share)
                elif part in long:
                    shares += long[part]
                else:
                    shares.append(self.known[part])
            out.append(shares)
        return out


def _whole_characters(data: bytes, word: str, counts: list[int]) -> tuple[int, ...]:
    if len(data) == len(word):
        return tuple(counts)
    return tuple(c for c, after in zip(counts, chain(data[1:], b"\0"), strict=True) if not 0x80 <= after < 0xC0)


def _simple(piece: str) -> list[str] | None:
    """The words of a piece of Latin-1 with white space at most in front, as a
    single character, if its counts are those of its words one after the other."""
    if not tokens.LATIN(piece) or "<" in piece or BLANK.search(piece, 1):
        return None
    words = LATIN_WORD.findall(piece)
    return words if ENDINGS.isdisjoint(words) else None


_loaded: dict[str, Merges] = {}


def merges(path: str) -> Merges:
    if path not in _loaded:
        _loaded[path] = Merges(path)
    return _loaded[path]


def prefix_counts(path: str, group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all prefixes of some texts, one after the other, and where each text's counts end."""
    own = merges(path)
    shares = own.counted(group)
    flat = list(chain.from_iterable(shares))
    counts = np.frombuffer(b"".join(flat), "<i2").astype(np.int32)
    ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
    if flat:
        lengths = np.fromiter(map(len, flat), np.int64, len(flat)) // 2
        totals = counts[np.cumsum(lengths) - 1]
        before = np.cumsum(totals, dtype=np.int64) - totals
        many = np.fromiter(map(len, shares), np.int64, len(shares))
        first = np.cumsum(many) - many
        before -= np.repeat(before[np.minimum(first, len(flat) - 1)], many)
        counts += np.repeat(before.astype(np.int32), lengths)
    return counts, ends


def _groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    lo, size, group = 0, 0, []
    for n in range(len(column)):
        group.append(column[n].as_py())
        size += len(group[-1])
        if size >= SLICE:
            yield lo, group
            lo, size, group = n + 1, 0, []
    if group:
        yield lo, group


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, group in _groups(b.column(b.num_columns - 1)):
            counts, ends = prefix_counts(path, group)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(counts))
            rows = b.slice(lo, len(group))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, "counts"])


def count_prefixes(docs: DataFrame, path: str) -> DataFrame:
    """One row per input row: doc_id, text (null as the empty one) and
    ``counts``, the number of tokens of each prefix of 1, 2, 3 ... characters."""
    src = texts(docs)
    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(partial(_count, path=path), f"doc_id {id_type}, text string, counts array<int>")


def total() -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.try_element_at("counts", F.lit(-1)), F.lit(0)).cast("long")


def within(limit: int) -> Column:
    """Characters of the longest prefix of at most ``limit`` tokens."""
    fits = F.transform("counts", lambda c, i: F.when(c <= limit, i + 1))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")


def truncate(counted: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_tokens, over_limit, and the longest prefix of at most
    ``limit`` tokens with its own count: looked up, nothing is encoded."""
    kept = counted.withColumn("n_kept", within(limit))
    return kept.select(
        "doc_id", total().alias("n_tokens"), (total() > limit).alias("over_limit"),
        F.substring(F.col("text"), F.lit(1), F.col("n_kept").cast("int")).alias("text"),
        F.coalesce(F.try_element_at("counts", F.nullif(F.col("n_kept"), F.lit(0)).cast("int")), F.lit(0)).cast("long").alias("kept_tokens"))


def digests(counted: DataFrame, limit: int) -> DataFrame:
    return counted.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), total().alias("n_tokens"),
                          (total() > limit).alias("over_limit"))
