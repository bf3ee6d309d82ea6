import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from snapmart.llm import periods, queries  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.util import edge_docs, no_docs, texts_of  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plainly(w):
    """(start, length, period) of all runs, each period compared at every place."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            y = x
            while y < n - q and w[y] == w[y + q]:
                y += 1
            if y - x + q >= max(6, 4 * q) and not any(w[x:y + q - d] == w[x + d:y + q] for d in range(1, q)):
                out.append((x, y - x + q, q))
            x = y + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def stuttering(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(words):
    runs = plainly(words)
    kept = [True] * len(words)
    for s, n, q in runs:
        kept[s + q:s + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for w, k in zip(words, kept, strict=True) if k)))


def digest(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def random_words(rnd):
    n, k = rnd.randrange(160), rnd.choice([1, 2, 2, 3, 5, 20])
    w = [rnd.randrange(k) for _ in range(n)]
    if n and rnd.random() < 0.7:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange((n - a) // 3 + 1)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rnd.random() < 0.5:
            w[rnd.randrange(n)] = 99
    return w


@pytest.mark.parametrize("tile", [16, 32, 1 << 14])
def test_tiles_give_all_runs(tile):
    rnd = random.Random(tile)
    for _ in range(400):
        w = random_words(rnd)
        parts = sorted((q, s + x, s + y) for lo, hi, s, e in periods.tiles(len(w), tile)
                       for q, x, y in periods.solve(np.array(w[s:e], np.int32), lo, hi))
        got = []
        for q, x, y in parts:
            if got and got[-1][0] == q and x <= got[-1][2] - q:
                got[-1] = q, got[-1][1], max(y, got[-1][2])
            else:
                got.append((q, x, y))
        assert sorted(((x, y - x, q) for q, x, y in got), key=lambda r: (r[0], r[2])) == plainly(w)


def test_colliding_names_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(periods, "_primes", lambda q: ())
    monkeypatch.setattr(periods, "mix", lambda h: h & periods.U(6))  # few names, many of them equal
    rnd = random.Random(4)
    for _ in range(60):
        w = random_words(rnd)[:60]
        got = {(x, y - x, q) for lo, hi, s, e in periods.tiles(len(w)) for q, x, y in periods.solve(np.array(w[s:e], np.int32), lo, hi)}
        assert set(plainly(w)) <= got
        assert all(w[x:x + n - q] == w[x + q:x + n] for x, n, q in got)


@pytest.mark.parametrize("tile", [16, 64, 1 << 14])
def test_runs_of_documents(spark, tile):
    rnd = random.Random(7)
    rows = [(i, " \t".join(f"w{x}" for x in random_words(rnd)) + " ") for i in range(150)]
    rows += [(1, "a b " * 700), (None, "x " * 50), (None, "x " * 50), (400, "é\x0bé\n" * 40), (401, None), (402, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = periods.find_runs(docs, tile)
    assert found.columns == ["doc_id", "text", "runs"]
    got = sorted((r.doc_id or -1, *digest(r)[-2:]) for r in periods.digests(periods.collapse(found)).collect())
    assert got == sorted((i or -1, *expected(WORD.findall(t or ""))[-2:]) for i, t in rows)


def test_query_matches_brute_force(spark):
    texts = texts_of(SF0001)
    rows = queries.op12_periodic_runs(spark, SF0001).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        assert digest(r) == expected(stuttering(r.doc_id, WORD.findall(texts[r.doc_id] or ""))), r.doc_id


def test_edges(spark):
    docs = edge_docs(spark)
    rows = periods.digests(periods.collapse(periods.find_runs(periods.with_stutter(docs)))).collect()
    want = sorted((r.doc_id or -1, expected(stuttering(r.doc_id, WORD.findall(r.text or "")) if r.doc_id else WORD.findall(r.text or "")))
                  for r in docs.filter("doc_id IS NULL OR doc_id <> 3").collect())
    assert sorted((r.doc_id or -1, digest(r)) for r in rows if r.doc_id != 3) == want
    long = next(r for r in rows if r.doc_id == 3)
    assert (long.n_runs, long.start, long.period, long.length) == (1, 0, 3, 12_000)
    assert periods.digests(periods.collapse(periods.find_runs(no_docs(spark)))).collect() == []
