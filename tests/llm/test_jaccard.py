import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from snapmart.llm import graph, jaccard, queries
from tests.conftest import SF0001
from tests.llm.util import edge_docs, no_docs, texts_of


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n, num, den):
    """[(doc_id, set size, smallest id reachable)] by comparing all pairs that share an n-gram."""
    sets, at = [shingles(t, n) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    both, up = Counter(), list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for own in at.values():
        both.update((a, b) for k, b in enumerate(own) for a in own[:k])
    for (a, b), same in both.items():
        if den * same >= num * (len(sets[a]) + len(sets[b]) - same):
            up[top(a)] = top(b)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)].append(d)
    return sorted(((d, len(sets[i]), min(low[top(i)], default=None)) for i, (d, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    assert found(queries.op4_parity_jaccard(spark, SF0001)) == brute(sorted(texts_of(SF0001).items()), 3, 9, 10)


@pytest.mark.parametrize("chunk", [2, 1024])
def test_near_copies_of_every_degree(spark, monkeypatch, chunk):
    """Chains of near copies around the threshold, in buckets larger than a chunk."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows, d = [], 0
    for size in (3, 12, 25, 60, 300):
        for _ in range(3):
            base = [rnd.choice(vocab) for _ in range(size)]
            for _ in range(9):
                near = list(base)
                for _ in range(rnd.randrange(0, max(2, size // 20))):
                    near[rnd.randrange(size)] = rnd.choice(vocab)
                base = near if rnd.random() < 0.5 else base
                rows.append(((d * 37) % 1009, " ".join(near)))
                d += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard.join(df, 3, 9, 10)) == brute(rows, 3, 9, 10)


def test_edges(spark):
    docs = edge_docs(spark, [(9, "ONE  two", "en", "a", 1)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jaccard.join(docs, 3, 9, 10)) == brute(rows, 3, 9, 10)
    assert jaccard.join(no_docs(spark)).collect() == []
    kept = jaccard.keep_one(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "4", "5", "None"] and kept[0].__fields__ == docs.columns


@pytest.mark.parametrize("num,den", [(9, 10), (8, 10)])
def test_similar_sets_share_a_key(num, den):
    """The guarantee behind the join, on sets of many sizes and the worst allowed difference."""
    rnd = np.random.default_rng(3)
    for size in [*range(1, 400, 7), 2000, 9000]:
        keys = lambda x: set(np.concatenate([np.zeros(0, np.uint64), *(jaccard.block_keys(x, *b) for b in jaccard.bands(len(x), num, den))]).tolist())
        most = size * (den - num) // den
        for gone in {most, most // 2}:  # a has ``gone`` members that b lacks, or b is that much larger
            h = rnd.integers(1, 1 << 63, size + gone, dtype=np.uint64)
            for a, b in ((h[:size], h[gone:]), (h[gone:size], h[:size]), (h[:size], h)):
                same = len(np.intersect1d(a, b))
                if gone and same and den * same >= num * (len(a) + len(b) - same):
                    assert keys(a) & keys(b)
                    assert jaccard.open_pair(len(a), jaccard.parity(a), len(b), jaccard.parity(b), num, den)
        assert len(keys(h[:size])) <= size + 40


def test_lower_similarities_are_refused(spark):
    with pytest.raises(ValueError):
        jaccard.join(no_docs(spark), 5, 7, 10)


def test_void_blocks_are_dealt_anew(monkeypatch):
    """Sets with far too many blocks: every guarantee falls to later dealings and combinations."""
    rnd = np.random.default_rng(4)
    for turns in (1, 3):
        monkeypatch.setattr(jaccard, "TURNS", turns)
        for _ in range(50):
            h = rnd.integers(1, 1 << 63, 13, dtype=np.uint64)
            a, b = h[:12], h[1:]
            keys = [set(jaccard.block_keys(x, 0, 9, 6).tolist()) for x in (a, b)]  # 2 differences, 9 = 2 + 1 + 6 blocks
            assert keys[0] & keys[1]


def test_components_of_a_long_chain(spark):
    rnd = random.Random(4)
    names = rnd.sample(range(10_000), 300)
    links = [(a, b) for a, b in zip(names, names[1:], strict=False) if a % 7] + [(names[0], names[0])]
    want = {}
    for n in names:
        want[n] = n
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(want[a], want[b])
            changed |= want[a] != low or want[b] != low
            want[a] = want[b] = low
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for link in links for x in link}
    assert got == {n: want[n] for n in linked}


def test_shared_keys_by_counting():
    """Packed ranges find the keys of several sets, however the batches fall."""
    rnd = np.random.default_rng(8)
    pairs = np.empty(5000, jaccard.PAIR)
    pairs["key"], pairs["fp"] = rnd.integers(-900, 900, 5000) * (1 << 52), rnd.integers(-3, 3, 5000)
    want = sorted(k for k in set(pairs["key"].tolist()) if len(set(pairs["fp"][pairs["key"] == k].tolist())) > 1)
    import pyarrow as pa
    for step in (7, 1000, 5000):
        parts = [jaccard.ends_of_keys(pairs[i:i + step]).tobytes() for i in range(0, 5000, step)]
        batch = pa.RecordBatch.from_pydict({"part": pa.array([0] * len(parts), pa.int32()), "pairs": pa.array(parts, pa.binary())})
        got = [k for b in jaccard._shared(iter([batch])) for k in b.column(0).to_pylist()]
        assert got == want
    assert [b.num_rows for b in jaccard._shared(iter([]))] == [0]


def _near_group(size, apart):
    """Rows of one bucket, all components their own: every pair differs in 2 * ``apart`` members."""
    rnd = np.random.default_rng(5)
    base = rnd.integers(1, 1 << 63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base, rnd.integers(1, 1 << 63, apart, dtype=np.uint64)])) for _ in range(size)]
    return sets, [{"key": 1, "lo": 0, "hi": 0, "own": 0, "id": i, "comp": i, "n": len(h), "bits": jaccard.parity(h).tobytes(),
                   "members": h.tobytes()} for i, h in enumerate(sets)]


def _told(work, rows):
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pylist(rows[i:i + 17]) for i in range(0, len(rows), 17)]
    return [p for b in work(iter(batches), num=9, den=10) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]


@pytest.mark.parametrize("apart,linked", [(10, True), (17, False)])
def test_a_group_of_near_copies_gives_no_more_pairs_than_members(apart, linked):
    """A group of m near copies whose sketches leave pairs open told m * (m - 1) / 2 pairs before."""
    sets, rows = _near_group(80, apart)
    pairs = jaccard.open_across(rows, 9, 10)[0]
    assert len(pairs) > 800
    assert len({tuple(p) for p in pairs.tolist()}) == len(pairs)
    told = _told(jaccard._likeliest, rows)
    assert 0 < len(told) < 80
    assert set(_told(jaccard._undecided, rows)) == {(1, int(i)) for i in np.unique(pairs)}
    joined = _told(jaccard._joined, rows)
    assert len(joined) == (79 if linked else 0)
    assert all(jaccard.similar(sets[a], sets[b], 9, 10) for a, b in joined)
    assert graph_of(told) == graph_of([tuple(p) for p in pairs.tolist()])


def graph_of(links):
    low = {}

    def top(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        low[max(a, b)] = min(a, b)
    return {x: top(x) for x in low}


def test_more_members_get_more_ranges_of_keys(spark, monkeypatch):
    """A task held all keys of a range, however many there were."""
    assert jaccard.key_ranges(0, 8) == jaccard.key_ranges(jaccard.RANGE * 8, 8) == 8
    assert jaccard.key_ranges(jaccard.RANGE * 30 + 1, 8) == 31
    monkeypatch.setattr(jaccard, "RANGE", 1000)
    rows = [(i, f"{' '.join(f'w{i % 50}x{k}' for k in range(60))} {i}") for i in range(100)]
    assert found(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10)) == brute(rows, 3, 9, 10)


def test_shared_keys_come_with_their_sets():
    """Members of shared keys took a second scan and shuffle of every key of every text."""
    rnd = np.random.default_rng(9)
    few = jaccard.FEW
    sizes = dict(enumerate([1, 2, 3, few - 1, few, few + 1, 5 * few] * 4, -14))
    fps = {k: rnd.choice(1 << 40, many, replace=False).tolist() for k, many in sizes.items()}
    rows = [(k << 50, fp) for k, own in fps.items() for fp in own] * 2  # equal sets repeat
    rnd.shuffle(rows)
    pairs = np.array([tuple(r) for r in rows], jaccard.PAIR)
    import pyarrow as pa
    for step in (50, 1000, len(pairs)):
        parts = [jaccard.few_of_keys(pairs[i:i + step], few + 1).tobytes() for i in range(0, len(pairs), step)]
        batch = pa.RecordBatch.from_pydict({"part": pa.array([0] * len(parts), pa.int32()), "pairs": pa.array(parts, pa.binary())})
        got = [r for b in jaccard._sharing(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        want = [(k << 50, fp) for k, own in fps.items() for fp in (sorted(own) if len(own) <= few else [None]) if len(own) > 1]
        assert got == want
    assert [b.num_rows for b in jaccard._sharing(iter([]))] == [0]


def test_keys_of_many_and_of_few_sets_find_their_members(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(2 * jaccard.FEW)]
    rows += [(1000 + i, f"{' '.join(f'v{i % 20}x{k}' for k in range(60))} {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shared = jaccard.shared_keys(df, 3, 9, 10, 10000).collect()
    assert {r.fp is None for r in shared} == {True, False}
    assert found(jaccard.join(df, 3, 9, 10)) == brute(rows, 3, 9, 10)
