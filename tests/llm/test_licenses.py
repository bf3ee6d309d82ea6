import random

from snapmart.llm import licenses, queries
from tests.conftest import SF001
from tests.llm.util import edge_docs, no_docs, texts_of


def test_query_finds_every_notice(spark):
    """The notices of the test documents stand on lines of their own."""
    notices = {t: n for n, t in licenses.TEMPLATES.items() if n.endswith("notice")}
    want = set()
    for d, text in texts_of(SF001).items():
        raw, at = text.encode(), 0
        for line in raw.split(b"\n"):
            if line.decode() in notices:
                want.add((d, notices[line.decode()], at, at + len(line) - 1))
            at += len(line) + 1
    rows = queries.op8_patience_licenses(spark, SF001).collect()
    got = {(r.doc_id, r.license, r.start, r.end) for r in rows if r.coverage == 1.0}
    strip = {(d, n, s) for d, n, s, _ in want}
    assert {(d, n, s) for d, n, s, _ in got} >= strip and len(strip) > 10
    plain = licenses.Templates(licenses.TEMPLATES)  # without the hashed search for seeds
    assert sorted((r.doc_id, r.license, r.start, r.end, r.matched_words, r.template_words) for r in rows) == sorted(
        (d, *hit) for d, t in texts_of(SF001).items() for hit in plain.scan(t.encode(), licenses.COVERAGE))


def test_the_longest_rise():
    rnd = random.Random(1)
    for _ in range(200):
        second = rnd.sample(range(12), rnd.randrange(8))
        pairs = list(enumerate(second))
        best = 0
        for mask in range(1 << len(pairs)):
            some = [b for i, b in pairs if mask >> i & 1]
            if some == sorted(some):
                best = max(best, len(some))
        got = licenses.longest_rise(pairs)
        assert len(got) == best and got == sorted(got) and [b for _, b in got] == sorted(b for _, b in got)


def test_alignment_is_a_common_sequence():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.choice(b"abcdefgh"[:k]) for _ in range(rnd.randrange(12))] for k in (8, 6))
        a, b = ([bytes([x]) for x in s] for s in (a, b))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(licenses.align(a, a)) == len(a)


MIT = licenses.TEMPLATES["MIT"]


def test_copies_changes_and_edges(spark):
    changed = MIT.replace("substantial", "large").replace("merge, publish,", "").upper()
    more = [(10, f"intro\n{MIT}\nbetween {changed} end", "en", "a", 1), (11, "the license of the software " * 50, "en", "a", 1),
            (12, "Released under the\n  MIT   license", "en", "a", 1), (13, "x " * 30_000 + MIT, "en", "a", 1)]
    docs = edge_docs(spark, more)
    rows = licenses.scan(docs).collect()
    got = sorted((r.doc_id, r.license) for r in rows)
    assert got == [(10, "MIT"), (10, "MIT"), (12, "MIT notice"), (13, "MIT")]
    cover = sorted(r.coverage for r in rows if r.doc_id == 10)
    assert 0.9 < cover[0] < 1 == cover[1]
    assert licenses.scan(no_docs(spark)).collect() == []


def test_copies_that_repeat_close_together():
    """N copies with gaps of 0, 1, T/2 and T words, against a plain search."""
    known = licenses.Templates(licenses.TEMPLATES)
    for name, ws in known.words:
        copy = b" ".join(ws)
        for n in (2, 3, 10):
            for gap in (0, 1, len(ws) // 2, len(ws)):
                for filler in ([b"w%d" % k for k in range(gap)], ws[::-1][:gap]):  # strange words; the template's own
                    raw = b" ".join([b" ".join([copy, *filler])] * n)
                    want, at = [], raw.find(copy)
                    while at >= 0:
                        want.append((name, at, at + len(copy), len(ws), len(ws)))
                        at = raw.find(copy, at + len(copy))
                    assert len(want) == n
                    assert [h for h in known.scan(raw, licenses.COVERAGE) if h[0] == name] == want, (name, n, gap)


def test_changed_copies_that_repeat_close_together():
    """Every copy differs in words that stand anywhere in it, or holds a seed too many."""
    rnd = random.Random(3)
    known = licenses.Templates(licenses.TEMPLATES)
    for name, ws in known.words[4:]:
        for change in ("replace", "drop", "stray"):
            raws, want, at = [], [], 0
            for _ in range(6):
                some = list(ws)
                k = rnd.randrange(4, len(ws) - 4)
                some[k:k + 1] = {"replace": [b"other"], "drop": [], "stray": [ws[k], *ws[2:5]]}[change]
                raws.append(b" ".join(some))
                want.append((at, at + len(raws[-1])))
                at += len(raws[-1]) + len(b" and ")
            got = [h for h in known.scan(b" and ".join(raws), licenses.COVERAGE) if h[0] == name]
            assert [h[1:3] for h in got] == want, (name, change)
            assert all(h[3] >= len(ws) - 1 for h in got)
