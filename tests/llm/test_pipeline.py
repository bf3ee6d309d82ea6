import zlib

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import __spark_entry__ as E  # noqa: E402
from snapmart.llm import queries, secrets, tokens, toxicity  # noqa: E402
from snapmart.llm.common import table  # noqa: E402
from tests.conftest import SF0001  # noqa: E402
from tests.llm.test_jaccard import brute as groups  # noqa: E402
from tests.llm.test_packing import PATH, check_rows  # noqa: E402
from tests.llm.test_suffixes import brute as repeats  # noqa: E402
from tests.llm.util import edge_docs  # noqa: E402


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "suffix-array dedup", "secret scans", "best-fit packing"]
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


def test_each_stage_against_brute_force(spark):
    docs = table(spark, SF0001, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    model = toxicity.train(docs, table(spark, SF0001, "labels"))
    clean = stages["toxicity"](spark, docs, SF0001)
    kept = {r.doc_id: r.text for r in clean.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted}
    assert clean.columns == columns and set(kept) == {r.doc_id for r in docs.collect()} - toxic

    one = stages["n-gram Jaccard join"](spark, clean, SF0001)
    left = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == columns and set(left) == {c for _, _, c in groups(sorted(kept.items()), 5, 8, 10)}
    assert all(kept[d] == t for d, t in left.items())

    cut = stages["suffix-array dedup"](spark, one, SF0001)
    got = {r.doc_id: r for r in cut.collect()}
    rows = sorted(left.items())
    for (d, text), (size, gone, _, _) in zip(rows, repeats([t.encode() for _, t in rows], 200), strict=True):
        assert got[d].n_chars == len(got[d].text) and size - gone - len(got[d].text.encode()) in range(0, 12 * (gone > 0) + 1)
        assert gone or got[d].text == text
    assert cut.columns == columns

    hidden = stages["secret scans"](spark, cut, SF0001)
    masked = {r.doc_id: r.text for r in hidden.collect()}
    assert hidden.columns == columns and set(masked) == set(left)
    for r in secrets.scan(cut).collect():
        if not any(s.live for s in r.spans or []):
            assert masked[r.doc_id] == got[r.doc_id].text
        else:
            assert secrets.MASK in masked[r.doc_id]

    packed = stages["best-fit packing"](spark, hidden, SF0001).collect()
    assert set(check_rows(packed, masked).values()) == {1}
    assert {r.doc_id for r in packed} == set(left)
    whole = sorted((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF0001).collect())
    assert whole == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_stages_take_edges_and_empty_tables(spark):
    docs = edge_docs(spark)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, rows, SF0001)
            assert (out.count() == 0) == (rows.count() == 0)


def test_the_result_holds_the_training_sequences(spark):
    """The last stage's ids are those of the texts it was given, not their digest only."""
    docs = edge_docs(spark)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = dict(corpus_pipeline.STAGES)["best-fit packing"](spark, docs, SF0001).collect()
    for r in rows:
        whole = tokens.library_ids(PATH, [texts[r.doc_id]])[0] + b"\0\0\0\0"
        assert bytes(r.ids) == whole[4 * r.start:4 * (r.start + r.length)] and r.ids_crc32 == zlib.crc32(r.ids)
    assert {r.doc_id for r in rows} == set(texts)


def test_stages_begin_with_executors_tidied(spark, monkeypatch):
    """Heaps that one stage had filled kept their size beside the next one's workers."""
    from snapmart.llm import common

    def collections():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())
    before = collections()
    common.tidy(spark)
    assert collections() > before
    tidied = []
    monkeypatch.setattr(corpus_pipeline, "tidy", tidied.append)
    for _, stage in corpus_pipeline.STAGES:
        with pytest.raises(Exception):  # no documents: nothing but the beginning is run
            stage(spark, None, None)
    assert tidied == [spark] * 5
