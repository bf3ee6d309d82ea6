import hashlib
import random
from collections import Counter

import pytest

from snapmart.llm import queries, suffixes
from tests.conftest import SF0001
from tests.llm.util import edge_docs, no_docs, texts_of


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and not p for g, p in zip(gone, b"\0" + gone, strict=False))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digests(df).collect()), key=repr)


def want(rows, length):
    return sorted(((d, *b) for (d, _), b in zip(rows, brute([(t or "").encode() for _, t in rows], length), strict=True)), key=repr)


def test_query_matches_brute_force(spark):
    rows = sorted(texts_of(SF0001).items())
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op5_radix_suffix_dedup(spark, SF0001).collect()), key=repr)
    assert got == want(rows, 200)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("group,segment", [(4096, 1 << 20), (1, 1 << 20), (4096, 300)])
def test_overlaps_near_the_threshold(spark, monkeypatch, group, segment):
    """Passages of lengths around the threshold, periodic text, groups and texts larger than a task's share."""
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "SEGMENT", segment)
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (55, 63, 64, 65, 66, 90, 200)]
    rows = [(i, "".join(rnd.choice(shared + [text(40)]) for _ in range(rnd.randrange(8)))) for i in range(60)]
    rows += [(100, "ab" * 400), (101, "z" * 700), (102, text(1500)), (100, "ab" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(suffixes.remove(df, 64)) == want(rows, 64)


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(suffixes.remove(docs, 200)) == want(rows, 200)
    assert suffixes.remove(no_docs(spark), 200).collect() == []
    cleaned = suffixes.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    assert cleaned.filter("doc_id = 2").first().text is None and cleaned.filter("doc_id = 3").first().n_chars < 9000


def test_a_text_travels_once(spark):
    """The row that goes with the text held the text again."""
    docs = edge_docs(spark, [(8, "q" * 700, "en", "a", 700), (None, "q" * 700, "en", "a", 700)])
    assert suffixes.remove(docs, 200, whole_row=True).schema["row"].dataType.names == [c for c in docs.columns if c != "text"]
    got = suffixes.clean(docs, 200)
    assert got.schema.names == docs.schema.names and got.count() == docs.count()
    assert {(r.doc_id, r.text, r.lang, r.n_chars) for r in got.collect() if r.source == "a" and r.doc_id in (None, 4, 8)} == {
        (4, "one two", "en", 7), (8, "", "en", 0), (None, "", "en", 0)}
