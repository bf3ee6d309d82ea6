"""Token ids of whole texts by a public tokenizer, shared by the packing and BPE operators.

Ids travel as ``binary``: little-endian unsigned 32-bit, four bytes an id. A
text is cut where no token of the tokenizer can cross; each cut piece is
encoded by the library once per worker and remembered within a bound, so a
corpus costs its distinct words rather than its length.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from snapmart.llm import workers

CACHED = 100_000  # pieces in each of two generations per worker: those met again outlive the others
SLICE = 1 << 21  # characters cut at a time, so a batch's pieces need little memory
STEP = 1 << 18  # pieces whose ids are put in place at a time

#: Before a single space or line feed that stands between two other characters.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

LATIN = re.compile(r"[\x00-\xff]*").fullmatch

SIGNS = ".,;:!?"

SPACE = "\u0120"  # how byte-level vocabularies write a space

_loaded: dict[str, tuple] = {}
_older: dict[str, dict[str, bytes]] = {}


def tokenizer(path: str):
    """The tokenizer of this worker, its memory of pieces, and which ids mark a word."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        marks = np.zeros(tok.get_vocab_size(), dtype=bool)
        for token, i in tok.get_vocab().items():  # ends a word, or starts one behind a space
            marks[i] = token.endswith("</w>") or token.startswith(SPACE)
        _loaded[path] = tok, {}, marks
        _older[path] = {}
        workers.remembered(forget)
    return _loaded[path]


def forget() -> None:
    """Drop all remembered pieces."""
    for path, (_, known, _) in _loaded.items():
        known.clear()
        _older[path].clear()


def spaced(text: str) -> str:
    """Pieces with one space between them, for tokenizers that lower-case, and
    drop white space before they split. The library looks for special strings
    before it normalises, so only what can hold none, and is the same
    lower-cased first, is lower-cased here: Latin-1 has no marks to compose and
    lower-cases within itself."""
    cut = text.replace("\n", " ")
    if "<|" not in text and (text.isascii() or LATIN(text)):
        return cut.lower()
    return " ".join([p.lower() if LATIN(p) and "<|" not in p else p for p in cut.split(" ")])


def words(text: str) -> list[str]:
    return spaced(text).split(" ")


def pieces(text: str) -> list[str]:
    """Pieces for byte-level tokenizers: a piece keeps the space before it."""
    return CUT.split(text)


def library_ids(path: str, texts: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in tokenizer(path)[0].encode_batch_fast(texts, add_special_tokens=False)]


def _plain_ids(path: str, plain: list[str], space: str) -> list[bytes]:
    """Ids of words of letters only, many to a call. Each is one token or more,
    the last (or, with its space in front, the first) of which is marked by the
    vocabulary; where marks and words differ in number, one by one."""
    tok, _, marks = tokenizer(path)
    out, step = [], 256
    groups = [plain[i:i + step] for i in range(0, len(plain), step)]
    for group, e in zip(groups, tok.encode_batch_fast([space.join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, dtype="<u4")
        at = np.flatnonzero(marks[ids]) + (1 if space else 0)
        if len(at) != len(group):
            out += library_ids(path, group)
            continue
        ends = at if space else np.append(at[1:], len(ids))
        blob, lo = ids.tobytes(), 0
        for hi in (4 * ends).tolist():
            out.append(blob[lo:hi])
            lo = hi
    return out


def letters(word: str) -> bool:
    """Letters only, also after a tokenizer's normalisation."""
    return word.isalpha() and (word.isascii() or LATIN(word) is not None or unicodedata.normalize("NFC", word).lower().isalpha())


def _learn(path: str, new: set[str], cut: Callable) -> None:
    """Remember the ids of ``new`` pieces. A word of letters with one sign
    behind it is the word's ids and the sign's."""
    known, lead = tokenizer(path)[1], "" if cut is words else " "
    plain, other, pairs, at = set(), [], [], len(lead)
    for p in new:
        word = p[at:] if p[:at] == lead else ""
        if word.isalpha():
            if word.isascii() or letters(word):
                plain.add(p)
            else:
                other.append(p)
        elif word and word[-1] in SIGNS and letters(word[:-1]):
            pairs.append(p)
            if p[:-1] not in known:
                plain.add(p[:-1])
            if p[-1] not in known:
                other.append(p[-1])
        else:
            other.append(p)
    known.update(zip(other, library_ids(path, other), strict=True))
    plain = list(plain)
    known.update(zip(plain, _plain_ids(path, plain, "" if lead else " "), strict=True))
    known.update((p, known[p[:-1]] + known[p[-1]]) for p in pairs)


def encode(path: str, texts: list[str], cut: Callable[[str], list[str]], cached: int = CACHED) -> Iterator[bytes]:
    """The ids of each text, in order; two generations of about ``cached`` pieces are remembered."""
    known = tokenizer(path)[1]
    for group in _slices(texts):
        if cut is words:  # Arrow numbers the pieces, so only distinct ones are looked up
            parts = pc.split_pattern(pa.array([spaced(t) for t in group], pa.large_string()), " ")
            coded = parts.values.dictionary_encode()
            learnt = _learnt(path, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), cut, cached)
            yield from _joined(learnt, np.asarray(coded.indices), np.diff(parts.offsets))
        else:
            parts = [cut(t) for t in group]
            _learnt(path, list(set().union(*parts)), cut, cached)
            for p in parts:
                yield b"".join(map(known.__getitem__, p))


def _learnt(path: str, spelled: list[str], cut: Callable, cached: int) -> list[bytes]:
    """The ids of some pieces, which are remembered from here on."""
    known, older = tokenizer(path)[1], _older[path]
    if len(known) > cached:
        older.clear()
        older.update(known)
        known.clear()
    learnt = list(map(known.get, spelled))
    if missing := [i for i, ids in enumerate(learnt) if ids is None]:
        new = {spelled[i] for i in missing}
        again = older.keys() & new  # looks up the fewer in the more; a set's intersection walks all of a dict
        known.update((p, older[p]) for p in again)
        _learn(path, new - again, cut)
        for i in missing:
            learnt[i] = known[spelled[i]]
    return learnt


def _joined(learnt: list[bytes], number: np.ndarray, lengths: np.ndarray) -> Iterator[bytes]:
    """The ids of each text from those of its pieces: ``learnt``, by number."""
    size = np.fromiter(map(len, learnt), np.int64, len(learnt)) // 4
    ids, first = np.frombuffer(b"".join(learnt), "<u4"), np.cumsum(size) - size
    blobs, ends = [], []
    for lo in range(0, len(number), STEP):
        some = number[lo:lo + STEP]
        n = size[some]
        end = np.cumsum(n)
        blobs.append(ids[np.repeat(first[some] - end + n, n) + np.arange(n.sum())].tobytes())
        ends.append(end + (ends[-1][-1] if ends else 0))
    blob, lo = b"".join(blobs), 0
    end = np.concatenate([np.zeros(1, np.int64), *ends])
    for hi in (4 * end[np.cumsum(lengths)]).tolist():
        yield blob[lo:hi]
        lo = hi


def _slices(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= SLICE:
            yield group
            group, size = [], 0
    if group:
        yield group
