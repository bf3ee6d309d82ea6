import hashlib
import random
import re

import numpy as np

from snapmart.llm import queries, secrets
from tests.conftest import SF001
from tests.llm.util import edge_docs, no_docs, texts_of


def base(text):
    """The fixed-format spans, by the plainest reading."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 6)
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def check(rows, texts):
    for r in rows:
        spans = base(texts[r.doc_id] or "")
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), r
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("opaque")) == said


def test_query_matches_brute_force(spark):
    texts = texts_of(SF001)
    rows = queries.op10_secret_scan(spark, SF001).collect()
    check(rows, texts)
    assert len(rows) == len(texts) and sum(r.n_assign for r in rows) > 0


KEY = "AKIA" + "Z9" * 9
TOKEN = "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
MORE = [(10 + i, f"doc {i} {KEY} and api_key: 'x{i}yz123'", "en", f"s{i}", 1) for i in range(5)] + [
    (20, f"mine {TOKEN} password=hunter22 PassWord = 'abc'", "en", "s1", 1), (21, "deadbeef" * 4 + "g" + "AKIA" * 6, "en", "s1", 1),
    (22, "toKen=\"" + "a1" * 20 + "\" ſecret=abcdefgh", "en", "s1", 1)]


def test_owners_part_examples_from_live_ones(spark):
    docs = edge_docs(spark, MORE)
    rows = {r.doc_id: r.spans for r in secrets.scan(docs).collect()}
    shared = [s for s in rows[10] if s.kind == 1]
    assert shared[0].n_owners == 5 and not shared[0].live
    assert all(s.live for s in rows[10] if s.kind == 0)
    told = secrets.digests(secrets.scan(docs)).collect()
    check(told, {r.doc_id: r.text for r in docs.collect()})
    assert [r.spans.split(",")[0] for r in told if r.doc_id == 20] == ["opaque:5:45"]


def test_edges_and_redaction(spark):
    docs = edge_docs(spark, MORE)
    assert secrets.scan(no_docs(spark)).collect() == []
    rows = secrets.digests(secrets.scan(docs)).collect()
    assert len(rows) == docs.count() and all(r.spans == "" for r in rows if r.doc_id in (None, 1, 2, 4))
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert TOKEN not in texts[20][0] and "hunter22" not in texts[20][0] and texts[20][1] == len(texts[20][0])
    assert KEY in texts[10][0] and "x0yz123" not in texts[10][0]
    assert texts[2][0] is None and texts[5][0] == "Ünï çødé 漢字 \t\n x" and clean.count() == docs.count()


def test_copies_of_one_document_do_not_make_an_example(spark):
    """A mirror in other sources is no owner of its own, nor are two that agree by chance."""
    mirrored = [(30 + i, f"see {TOKEN} here", "en", f"s{i}", 1) for i in range(5)]
    few = [(40 + i, f"doc {i} holds {KEY} for {i}", "en", f"s{i}", 1) for i in range(2)]
    for more in (mirrored, few):
        rows = {r.doc_id: r.spans for r in secrets.scan(edge_docs(spark, more)).collect()}
        assert all(s.n_owners == len(more) and s.live for d, *_ in more for s in rows[d])
        assert all(rows[d] for d, *_ in more)


def prose(seed, n=120):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_owners_count_over_distinct_documents(spark):
    """One key in one sentence under 40 owners is an example; a key in 40 near copies of one document is live."""
    sentence = f"set the key in your settings file like this {KEY} and then start the client again as before"
    example = [(100 + i, " ".join([*prose(i), sentence, *prose(-i - 1)]), "en", f"s{i}", 1) for i in range(40)]
    near = []
    for i in range(40):
        words = prose(999)
        words[3 + 2 * i] = f"edit{i}"
        near.append((200 + i, " ".join([*words[:60], TOKEN, *words[60:]]), "en", f"s{i}", 1))
    rows = {r.doc_id: r.spans for r in secrets.scan(edge_docs(spark, example + near)).collect()}
    for d, *_ in example:
        assert [(s.n_owners, s.n_repos, s.live) for s in rows[d] if s.kind == 1] == [(40, 40, False)]
    for d, *_ in near:
        assert [(s.n_owners, s.live) for s in rows[d] if s.kind == 3] == [(40, True)]


def test_sketches_estimate_similarity():
    words = prose(5, 400)
    other = [*words[:200], "new", *words[201:]]
    a, b, c = (np.frombuffer(secrets.sketch(" ".join(w)), "<u4") for w in (words, other, prose(6, 400)))
    assert ((a == b) & (a > 0)).sum() >= secrets.ALIKE * secrets.BINS and ((a == c) & (a > 0)).sum() == 0
    assert len(secrets.sketch("one")) == 4 * secrets.BINS
