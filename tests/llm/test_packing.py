import random
import zlib
from collections import Counter
from functools import lru_cache

import pytest

P = pytest.importorskip("public_tokenizers")

from snapmart.llm import packing, queries, tokens  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.util import edge_docs, no_docs, texts_of  # noqa: E402

PATH = P.path("word_bpe_49k.json")


def bins_of(plan):
    held = {}
    for size, _, n, each, first, at in plan.fills:
        for k in range(n):
            held.setdefault(first + k // each, []).append((at + k % each * size, size))
    return held


def check_plan(counts, capacity):
    plan = packing.plan(dict(counts), capacity)
    held, packed, ranks = bins_of(plan), Counter(), {}
    for size, rank, n, *_ in sorted(plan.fills):
        assert rank == ranks.get(size, 0)
        ranks[size] = rank + n
    for pieces in held.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
            packed[size] += 1
        assert at <= capacity
    assert packed == Counter(counts) and set(held) == set(range(plan.bins))
    return plan


@lru_cache(maxsize=None)
def fewest(items, capacity):
    """Exact number of bins by trying every set that holds the first item."""
    if not items:
        return 0
    best = len(items)
    first, rest = items[0], items[1:]

    def fill(i, room, left):
        nonlocal best
        best = min(best, 1 + fewest(tuple(left), capacity))
        for k in range(i, len(left)):
            if left[k] <= room:
                fill(k, room - left[k], left[:k] + left[k + 1:])
    fill(0, capacity - first, list(rest))
    return best


def test_plans_hold_every_piece_once():
    rnd = random.Random(1)
    for capacity in (7, 50, 2048):
        for _ in range(30):
            counts = {rnd.randint(1, capacity): rnd.randint(1, 40) for _ in range(rnd.randint(0, 30))}
            plan = check_plan(counts, capacity)
            assert plan.bins >= -(-sum(s * n for s, n in counts.items()) // capacity)


def test_a_fixed_set_costs_no_bin():
    """Fixing a dominating set never makes the best packing worse."""
    rnd = random.Random(2)
    for _ in range(150):
        items = [rnd.randint(1, 20) for _ in range(rnd.randint(1, 8))]
        left = Counter(items)
        found = packing.dominating(left, max(items), 20)
        if found:
            sizes, bins = found
            rest = left - Counter({s: sizes.count(s) * bins for s in sizes})
            whole = fewest(tuple(sorted(items, reverse=True)), 20)
            assert bins + fewest(tuple(sorted(rest.elements(), reverse=True)), 20) == whole


def test_small_instances_are_packed_almost_best():
    rnd = random.Random(3)
    over = 0
    for _ in range(60):
        items = [rnd.randint(1, 20) for _ in range(8)]
        over += packing.plan(Counter(items), 20).bins - fewest(tuple(sorted(items, reverse=True)), 20)
    assert over <= 2


def check_rows(rows, texts, capacity=2048):
    ids = {d: tokens.library_ids(PATH, [t or ""])[0] + b"\0\0\0\0" for d, t in texts.items()}
    seen, sequences = Counter(), {}
    for r in rows:
        cut = ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]
        assert r.start == r.piece * capacity and r.length == len(cut) // 4 and r.ids_crc32 == zlib.crc32(cut)
        seen[r.doc_id, r.piece] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, b in ids.items():
        assert all(seen[d, k] for k in range(-(-len(b) // (4 * capacity))))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return seen


def test_query_matches_the_library(spark):
    rows = queries.op1_best_fit_packing(spark, SF0001).collect()
    seen = check_rows(rows, texts_of(SF0001))
    assert set(seen.values()) == {1}
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.02 * total / 2048 + 1


def test_edges(spark):
    from pyspark.sql import functions as F
    docs = edge_docs(spark)
    rows = packing.pack(docs, PATH, keep=[F.crc32("ids").alias("ids_crc32")]).collect()
    seen = check_rows(rows, {r.doc_id: r.text for r in docs.collect()})
    assert seen[4, 0] == 2 and seen[None, 0] == 1
    assert packing.pack(no_docs(spark), PATH).collect() == []
    whole = packing.pack(docs, PATH).filter("doc_id = 4").first()
    assert bytes(whole.ids) == tokens.library_ids(PATH, ["one two"])[0] + b"\0\0\0\0"


@pytest.mark.parametrize("step,cached", [(3, 5), (1 << 18, 5), (1 << 18, 100_000)])
def test_only_distinct_words_are_looked_up(monkeypatch, step, cached):
    """A word was looked up each time it came up; ids are the library's, however pieces are put in place."""
    monkeypatch.setattr(tokens, "STEP", step)
    asked = []
    learnt = tokens._learnt
    monkeypatch.setattr(tokens, "_learnt", lambda path, spelled, *a: asked.append(spelled) or learnt(path, spelled, *a))
    texts = ["", " ", "\n", "The the, THE cat", "Ünï çødé 漢字 <|endoftext|> É é", "a  b\t\nc!!", "the cat sat. " * 50]
    for _ in range(2):
        assert list(tokens.encode(PATH, texts, tokens.words, cached)) == tokens.library_ids(PATH, texts)
    assert all(len(set(a)) == len(a) < 25 for a in asked) and len(asked) == 2
    assert list(tokens.encode(PATH, [], tokens.words, cached)) == []


def test_tasks_bound_what_they_remember_and_give_memory_back(monkeypatch):
    """Freed memory was held for good, and every caller's workers remembered 400,000 words twice."""
    import pyarrow as pa
    task = type("Task", (), {"partitionId": lambda self: 0})
    monkeypatch.setattr(packing.TaskContext, "get", task)
    given = []
    monkeypatch.setattr(packing, "give_back", lambda: given.append(1))
    texts = [f"the cat{i} sat" for i in range(5000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(5000), "text": texts})
    rows = {}
    for remembered in (50, 100_000):
        tokens.forget()
        out = list(packing._pieces(iter([batch]), PATH, 2048, b"\0\0\0\0", remembered))
        rows[remembered] = [i for b in out for i in b.column("ids").to_pylist()]
        if remembered == 50:
            assert len(tokens.tokenizer(PATH)[1]) + len(tokens._older[PATH]) < 2500
    assert rows[50] == rows[100_000] == [i + b"\0\0\0\0" for i in tokens.library_ids(PATH, texts)]
    assert len(given) == 2 * 3
