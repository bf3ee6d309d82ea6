"""Page chains against a walk page by page."""

import random

from snapmart.operators import page_chains

SCHEMA = "listing string, token string, next_token string"


def walk(rows):
    """One row per chain, by the plainest reading."""
    nexts, copies = {}, {}
    for listing, token, to in rows:
        key = (listing, token or "")
        copies[key] = copies.get(key, 0) + 1
        nexts[key] = min([t for t in (nexts.get(key), to) if t is not None], default=None)
    named = {(k[0], t) for k, t in nexts.items() if t is not None}
    out, rings = [], set()
    for start in nexts:
        seen, at = [], start
        while at in nexts and at not in seen:
            seen.append(at)
            at = (at[0], nexts[at]) if nexts[at] is not None else None
        if at in seen:
            ring = seen[seen.index(at):]
            rings.add((start[0], min(t for _, t in ring), len(ring), None, None, True))
            if start not in named:
                out.append((*start, None, None, None, True))
        elif start not in named:
            out.append((*start, len(seen), sum(copies[s] > 1 for s in seen), at[1] if at else None, False))
    return sorted([*out, *rings], key=str)


def check(spark, rows):
    got = page_chains.chains(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == walk(rows)


def test_whole_missing_repeated_and_loops(spark):
    rows = [("a", None, "1"), ("a", "1", "2"), ("a", "2", None),          # whole
            ("b", None, "1"), ("b", "1", "2"), ("b", "3", None),          # page 2 missing
            ("c", None, "1"), ("c", None, "1"), ("c", "1", None),         # first page twice
            (None, None, "1"), (None, "1", None),                         # a listing without a name
            ("d", "7", "8"), ("d", "8", "7"), ("d", "5", "7"), ("e", "x", "x")]
    check(spark, rows)


def test_random_links_and_a_long_chain(spark):
    rng = random.Random(3)
    rows = [("r", str(i), rng.choice([None, *map(str, range(60))])) for i in range(40)]
    rows += [("long", str(i), str(i + 1)) for i in range(500)]
    check(spark, rows)


def test_no_pages(spark):
    assert page_chains.chains(spark.createDataFrame([], SCHEMA)).collect() == []
