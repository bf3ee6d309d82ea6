import random
import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from snapmart.llm import phrases, queries  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.util import edge_docs, no_docs  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(rows, least, most):
    """All phrases counted, scored and ranked one by one."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = {}
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inner = {}
    for (lang, *w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                part = (lang, *w[i:i + m])
                inner[part] = max(inner.get(part, 0), a)
    for (lang, *w), a in found.items():
        if 100 * inner.get((lang, *w), 0) >= 80 * a:
            continue
        score, k = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, rank, p.decode(), -a, le, r, n[lang], -score) for lang, own in out.items()
                  for rank, (score, a, p, le, r) in enumerate(sorted(own)[:most], 1))


def random_docs(seed, n):
    rnd = random.Random(seed)
    words = ["the", "New", "york", "City", "é", "漢", "a-b", "x\x00", "of", "%%%"]
    for _ in range(n):
        text = "".join(rnd.choice(words[:rnd.choice((2, 4, 10))]) + rnd.choice([" ", " ", " ", "\t ", "  ", ", ", ".\n", "\x0b", "!?"])
                       for _ in range(rnd.randrange(40)))
        yield (rnd.choice([text, text, text.upper(), "", None, " .,"]), rnd.choice(["en", "en", "en", "fr", None, "und"]))


@pytest.mark.parametrize("shards,slice_size,bits", [(1, 50, 26), (2, 1 << 21, 26), (3, 200, 7), (5, 1, 26)])
def test_collocations_match_brute_force(spark, shards, slice_size, bits):
    rows = list(random_docs(shards, 300))
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for least, best in ((6, 15),) if shards > 1 else ((12, 2000),):
        got = phrases.collocations(docs, least, best, shards=shards, bits=bits, slice_bytes=slice_size)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == plainly(rows, least, best)


def test_counts_of_all_lengths_are_true_counts(spark):
    """Phrases that reach the threshold in the last shard only, so longer ones need further cycles."""
    rows = [("one two three four", "en")] * 12 + [("one two, three. four", "en")] * 3 + [("x y z", "en")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    counted, words = phrases.count_phrases(docs, 12, 4)
    assert {r.phrase: r.f for r in counted.collect()} == {
        "one": 15, "two": 15, "three": 15, "four": 15, "one two": 15, "two three": 12, "three four": 12,
        "one two three": 12, "two three four": 12, "one two three four": 12}
    assert words.collect()[0].n == 69


def test_long_texts_are_cut_between_pieces():
    text = b"a b. c d, e f\n" * 100
    parts = list(phrases._parts(text, 50))
    assert len(parts) > 10 and all(p.strip().startswith((b"a", b"c", b"e")) for p in parts if p.strip())
    assert b"".join(parts).count(b"a b") == 100
    assert list(phrases._parts(b"x" * 500, 50)) == [b"x" * 500]


def test_query_runs_whole(spark):
    rows = queries.op13_phrase_mining(spark, SF0001).collect()
    assert rows and max(r.rank for r in rows) <= 2000


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    got = phrases.collocations(docs, 2, 50).collect()
    assert sorted(map(tuple, got)) == plainly(rows, 2, 50)
    assert phrases.collocations(no_docs(spark), 2, 50).collect() == []


def test_tables_are_not_sorted_for_the_likely_phrases(spark):
    """Every step sorted all rows of a cycle's tables by their phrases."""
    table = spark.createDataFrame([("en", "a b", 2), ("fr", "a b", 3), ("en", "c", 1)], "lang string, phrase string, n long")
    likely = spark.createDataFrame([("en", "a b"), ("en", "a b")], "lang string, phrase string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = phrases._so_far([table, table], [likely, likely.limit(0)])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, got.collect())) == [("en", "a b", 2)] * 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_phrases_travel_many_to_a_row(spark):
    """Each phrase was a row of its own in every shuffle and table, however seldom it came up."""
    import pyarrow as pa
    rows = [(f"w{i} common pair, once{i} more", "en") for i in range(200)] + [("common pair", None)] * 3
    docs = pa.RecordBatch.from_pydict({"lang": [r[1] or "und" for r in rows], "text": [r[0].encode() for r in rows]})
    everything = (np.full(1 << 20, 255, np.uint8),) * 2
    active = type("Active", (), {"value": everything})
    new = pa.Table.from_batches(list(phrases._count(iter([docs]), True, active, 300, 4)), phrases.LINES)
    table, sums = phrases._step(spark.createDataFrame(new), [], 100, 4)
    assert table.count() <= 4 * 2 * 4 < table.agg({"n": "sum"}).first()[0]
    assert {(r.lang, r.phrase, r.length, r.f) for r in sums.collect()} == {
        ("en", "common", 1, 200), ("en", "pair", 1, 200), ("en", "more", 1, 200), ("en", "common pair", 2, 200)}
    again, more = phrases._step(spark.createDataFrame(new), [table, table], 600, 4)
    assert {(r.phrase, r.f) for r in more.collect()} == {("common", 600), ("pair", 600), ("more", 600), ("common pair", 600)}
    assert again.groupBy("lang", "length").sum("n").orderBy("lang", "length").collect() == table.groupBy("lang", "length").sum("n").orderBy("lang", "length").collect()


def test_bits_of_many_phrases_are_those_that_texts_look_up():
    import pyarrow as pa
    spelled = [("en", "a"), ("fr", "a"), ("en", "b a"), ("en", "a b c"), ("fr", "漢 é")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*spelled, strict=True)], names=["lang", "phrase"])
    bits = np.zeros(1 << 19, np.int64)
    for b in phrases._places(iter([batch]), 25):
        np.bitwise_or.at(bits, b.column(0).to_numpy(), b.column(1).to_numpy())
    for lang, phrase in [*spelled, ("fr", "b a")]:
        one = phrases._lang(phrases.Words([phrase.encode()]).hashes, lang)
        h = one[:1]
        for w in one[1:]:
            h = phrases._longer(h, w)
        assert phrases._hit(bits.view(np.uint8), h)[0] == ((lang, phrase) in spelled)
