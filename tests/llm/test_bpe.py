import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from snapmart.llm import bpe, queries, tokens  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.util import edge_docs, no_docs, texts_of  # noqa: E402

PATH = P.path("byte_bpe_50k.json")
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ab", "'strevlmd", "0123456789", "!?.,'\"-=#", "é漢字ñß𝒳", " \n\t\xa0　", "aA1!' \n"]


def one_by_one(text, unsplit, leaf):
    out, units = b"", {}
    parts = bpe.split_long(text, bpe._specials(PATH), unsplit, leaf)
    assert "".join(p[2] for p in parts) == text
    for kind, unit, part in parts:
        units.setdefault(unit, []).append((kind, part))
    for unit in sorted(units):
        if units[unit][0][0] == 0:
            out += b"".join(tokens.encode(PATH, [p for _, p in units[unit]], tokens.pieces))
        else:
            words = bpe.tree(PATH, [bpe.encode_words(PATH, p) for _, p in units[unit]])
            out += np.array([i for _, ids in words for i in ids], "<u4").tobytes()
    return out


def test_tree_equals_the_library():
    rnd = random.Random(5)
    for n in range(600):
        own = ALPHABETS[n % len(ALPHABETS)]
        text = "".join(rnd.choice(rnd.choice(ALPHABETS)) if rnd.random() < 0.2 else rnd.choice(own) for _ in range(rnd.randrange(1, 120)))
        if rnd.random() < 0.2:
            text = text[:10] + "<|endoftext|>" + text[10:]
        want = tokens.library_ids(PATH, [text])[0]
        for unsplit, leaf in ((8, 3), (20, 7)):
            assert one_by_one(text, unsplit, leaf) == want, text
        ids = np.frombuffer(want, "<u4").tolist()
        assert b"".join(bpe.id_bytes(PATH)[i] for i in ids).decode("utf-8", "replace") == \
            tokens.tokenizer(PATH)[0].decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("name,cut", [("word_bpe_49k.json", tokens.words), ("byte_bpe_50k.json", tokens.pieces)])
def test_pieces_equal_the_library(name, cut):
    path, rnd = P.path(name), random.Random(1)
    chars = " \n\t  ab'sStreLll123!?é́ßΣσİ\x1c\x85\xa0 　中漢𝒳٣"
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["a<|endoftext|> b", "<|endoftext|>\nx", " <|endoftext|> "]
    texts += ["a" + c + " b" + c + "\nc " + c + " d" + c for c in map(chr, range(0x3100)) if not 0xD800 <= ord(c) < 0xE000]
    assert list(tokens.encode(path, texts, cut)) == tokens.library_ids(path, texts)


@pytest.mark.parametrize("name, cut", [("word_bpe_49k.json", tokens.words), ("byte_bpe_50k.json", tokens.pieces)])
def test_capitals_stay_until_special_strings_are_found(name, cut):
    """Special strings in capitals are none; some capitals compose with a mark only in lower case."""
    texts = ["a <|EndOfText|> b", "a <|ENDOFTEXT|>, <|StartOfText|>x", "<|startoftext|>A<|EndOfText|>B<|endoftext|>\nC"]
    texts += [a + c + b for c in ("T\u0308", "J\u030c", "\u0391\u0342", "\u03ab\u0301", "\u0130", "\u0958", "\ufb1d", "\u03a3")
              for a in ("", "x ", "X") for b in ("", "Y.", ".", " <|EndOfText|>")]
    assert list(tokens.encode(P.path(name), texts, cut)) == tokens.library_ids(P.path(name), texts)


def check(rows, texts):
    tok = tokens.tokenizer(PATH)[0]
    for r in rows:
        ids = tokens.library_ids(PATH, [texts[r.doc_id] or ""])[0]
        text = tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), r


def test_query_matches_the_library(spark):
    texts = texts_of(SF0001)
    rows = queries.op7_tree_bpe(spark, SF0001).collect()
    check(rows, texts)
    assert len(rows) == len(texts)


def test_edges_and_long_texts(spark):
    more = [(6, "x" * 50_000, "en", "a", 1), (7, "ab'll" * 4000 + "<|endoftext|>" + " 漢字é" * 3000 + "  " * 3000, "en", "a", 1)]
    docs = edge_docs(spark, more)
    run = lambda d, **o: bpe.digests(bpe.decode(bpe.encode(d, PATH, **o), PATH)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for options in ({}, {"long": 1000, "unsplit": 64, "leaf": 16}):
        rows = run(docs, **options)
        check(rows, texts)
        assert len(rows) == 9
    assert run(no_docs(spark)) == []
