import random

import pytest

P = pytest.importorskip("public_tokenizers")

from snapmart.llm import prefixes, queries, tokens  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.util import edge_docs, no_docs, texts_of  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ab", "'strevlmd", "0123456789", "!?.,'\"-=#", "é漢字ñß𝒳", " \n\t\xa0　\x1c\x85", "aA1!' \n", "x"]


def plainly(text):
    """Every prefix encoded by the library."""
    tok = tokens.tokenizer(PATH)[0]
    return [len(e.ids) for e in tok.encode_batch([text[:p] for p in range(1, len(text) + 1)], add_special_tokens=False)]


def random_texts(n, seed, longest=40):
    rnd = random.Random(seed)
    for k in range(n):
        own = ALPHABETS[k % len(ALPHABETS)]
        text = "".join(rnd.choice(rnd.choice(ALPHABETS)) if rnd.random() < 0.25 else rnd.choice(own) for _ in range(rnd.randrange(1, longest)))
        yield text[:7] + "<|endoftext|>" + text[7:] if rnd.random() < 0.1 else text


def test_every_prefix_equals_the_library():
    group = [*random_texts(1500, 3), "", "it's we're they've I'll don't 're 'r", "a  b \n c\n\nd\te ", "<|endof<|endoftext|><|endoftext|>\n x"]
    counts, ends = prefixes.prefix_counts(PATH, group)
    lo = 0
    for text, hi in zip(group, ends.tolist(), strict=True):
        assert counts[lo:hi].tolist() == plainly(text), repr(text)
        lo = hi


def test_each_token_is_the_encoding_of_its_bytes():
    own = prefixes.merges(PATH)
    assert all(own.word(b)[-1] == 1 for b in own.ids)


def test_forgotten_pieces_are_learned_again(monkeypatch):
    monkeypatch.setattr(prefixes, "REMEMBERED", 5)
    monkeypatch.setattr(prefixes, "SHARE", prefixes.SHORT)
    monkeypatch.setattr(prefixes, "_loaded", {})
    text = " ".join(random_texts(60, 8)) + " " + "long" * 90 + " end"
    for _ in range(2):
        assert prefixes.prefix_counts(PATH, [text])[0].tolist() == plainly(text)


def test_long_words_take_time_in_proportion():
    text = "ab'll" * 4000 + " " * 20_000 + "漢字é" * 3000
    counts, _ = prefixes.prefix_counts(PATH, [text])
    for p in (1, 777, 20_000, 30_000, 40_000, len(text)):
        assert counts[p - 1] == len(tokens.tokenizer(PATH)[0].encode(text[:p], add_special_tokens=False).ids)


def test_query_matches_the_library(spark):
    texts = texts_of(SF0001)
    rows = queries.op11_prefix_token_counts(spark, SF0001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(tokens.library_ids(PATH, [texts[r.doc_id]])[0]) // 4
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_truncation_is_the_longest_prefix_in_the_budget(spark):
    docs = edge_docs(spark, [(6, "we're told don't 're  stop <|endoftext|> now", "en", "a", 1)])
    counted = prefixes.count_prefixes(docs, PATH)
    wanted = {(r.doc_id, r.text): plainly(r.text) for r in counted.collect() if len(r.text) < 100}
    for limit in (0, 1, 3, 8):
        rows = {r.doc_id: r for r in prefixes.truncate(counted, limit).collect()}
        for (doc_id, text), counts in wanted.items():
            fit = max([0, *(p for p, c in enumerate(counts, 1) if c <= limit)])
            r = rows[doc_id]
            assert (r.text, r.kept_tokens) == (text[:fit], counts[fit - 1] if fit else 0)
            assert (r.n_tokens, r.over_limit) == (counts[-1] if counts else 0, bool(counts) and counts[-1] > limit)


def test_edges(spark):
    docs = edge_docs(spark)
    counted = prefixes.count_prefixes(docs, PATH)
    assert counted.columns == ["doc_id", "text", "counts"]
    rows = prefixes.digests(counted, 512).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), len(tokens.library_ids(PATH, [r.text or ""])[0]) // 4)
                  for r in docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in rows) == want
    assert prefixes.digests(prefixes.count_prefixes(no_docs(spark), PATH), 512).collect() == []
