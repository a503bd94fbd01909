import numpy as np
import pyarrow as pa

from medallion.llm import quality_net as qn
from medallion.llm.common import fold_of
from medallion.llm.queries import op4_quality_classifier

from .common import documents, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op4_quality_classifier(spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    m = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = m[m.held_out]
    assert (held.predicted == held.quality).mean() >= 0.97


def test_edge_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(16)] + [(None, 1), (2, None)], "doc_id long, quality int")
    got = qn.quality_scores(documents(spark), labels, learn=fold_of("doc_id", 3) != 1).collect()
    assert len(got) == documents(spark).count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    empties = {r.score for r in got if r.doc_id in (5, 6, 7)}
    assert len(empties) == 1
    assert len({r.score for r in got if r.doc_id == 1}) == 1  # repeated rows


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert qn.quality_scores(empty(spark), labels, learn=fold_of("doc_id", 3) != 1).count() == 0
    assert {r.score for r in qn.quality_scores(documents(spark), labels, learn=fold_of("doc_id", 3) != 1).collect()} == {0.5}


def test_word_vectors_against_brute_force(spark):
    docs = documents(spark)
    cols, signs = qn.index_vectors()
    want = np.zeros((qn.SLOTS, qn.DIMS))
    for r in docs.select("text").collect():
        slots, _ = qn.unit_slots(pa.array([r.text or ""]))
        for i in range(len(slots)):
            for j in range(max(0, i - qn.WINDOW), min(len(slots), i + qn.WINDOW + 1)):
                if i != j:
                    np.add.at(want[slots[i]], cols[slots[j]], signs[slots[j]])
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(qn.word_vectors(docs), want, atol=1e-5)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = qn.fit_network(x, y)
    p = net.scores(x)
    assert abs(p.mean() - y.mean()) < 0.03
    top = p > 0.8
    assert abs(p[top].mean() - y[top].mean()) < 0.05
