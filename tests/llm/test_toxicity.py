import zlib

import numpy as np
import pyarrow as pa

from snapmart.llm import hashing, queries, toxicity
from tests.conftest import SF0001
from tests.llm.util import edge_docs, no_docs

SF01 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = queries.op3_ftrl_toxicity(spark, SF01).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in rows)
    told = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = (np.array([s for s, y in told if y == want]) for want in (1, 0))
    assert np.mean(toxic[:, None] > clean[None]) > 0.95
    assert np.mean(toxic >= 0.5) > 0.7 and np.mean(clean < 0.5) > 0.98


def test_a_few_words_decide():
    examples = [(k % 2, np.unique(np.array([k % 2, 10 + k % 7, 20 + k % 11], np.uint32))) for k in range(200)]
    bias, places, w = toxicity.fit(examples, l1=1.0)
    weight = dict(zip(places.tolist(), w.tolist(), strict=True))
    assert weight[1] > 0 > weight[0] and all(abs(weight.get(p, 0)) < 0.5 for p in range(10, 31))


def test_features_of_a_row_do_not_depend_on_its_neighbours():
    texts = ["You are a cat", "", "cat", "a b c d e", "YOU are, a cat!"]
    def places(column):
        out = []
        for lo, hi, data, off in hashing.slices(column, 4):
            row, place = toxicity.features(data, off)
            out += [sorted(place[row == r].tolist()) for r in range(hi - lo)]
        return out
    alone = [places(pa.array([t]))[0] for t in texts]
    assert places(pa.array(texts)) == alone and alone[0] == alone[4] and [len(a) for a in alone] == [10, 0, 1, 14, 10]


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (77, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (None, 1, 2)}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert toxicity.score(no_docs(spark), model).collect() == []
    untaught = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, untaught).collect()} == {0.5}
    clean = toxicity.keep_clean(docs, model, at_most=1.1)
    assert clean.columns == docs.columns and clean.count() == 7


def test_fit_does_not_see_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a[0] == b[0] and np.array_equal(a[1], b[1]) and np.array_equal(a[2], b[2])
