"""Quality rules: counts against brute force, the learned list against planted rules and held-out labels."""
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import quality_rules as qr
from medallion.llm import queries as q

from .common import documents, empty

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def failed(n_words, n_repeat):
    return n_words < 20 or 100 * n_repeat > 30 * n_words


def key(t):
    return tuple((x is None, x) for x in t)


def test_edge_rows_against_brute_force(spark):
    df = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (10, 0)], "doc_id long, quality int")
    got = qr.quality_rules(df, labels).collect()
    want = sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=key)
    assert sorted(((r.doc_id, *[r[c] for c in qr.COUNTS[:5]]) for r in got), key=key) == want
    assert all(r.base_failed == failed(r.n_words, r.n_repeat_words) and r.kept == (not r.base_failed) for r in got)
    assert qr.quality_rules(empty(spark), labels).collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_windows_against_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        words = [rng.choice("ab") if rng.random() < .5 else rng.choice("abcdefgh") for _ in range(rng.randrange(0, 90))]
        cut = rng.randrange(0, len(words) + 1)
        texts.append((" " if rng.random() < .5 else "\n").join(words + words[cut:cut + rng.randrange(5, 14)]))
    import pyarrow as pa
    found = qr._count_batch(pa.array(texts, pa.string()))
    assert [tuple(int(found[c][i]) for c in qr.COUNTS[:5]) for i in range(len(texts))] == [brute(t) for t in texts]


def test_learns_planted_rules_and_prunes():
    rng = np.random.default_rng(5)
    n = 3000
    x = {s: rng.random(n) for s in qr.STATISTICS}
    bad = (x["symbol_share"] > 0.9) | ((x["mark_share"] > 0.6) & (x["upper_share"] > 0.8))
    noisy = bad ^ (rng.random(n) < 0.01)
    found = qr.learn_list(x, noisy)
    test = {s: rng.random(5000) for s in qr.STATISTICS}
    truth = (test["symbol_share"] > 0.9) | ((test["mark_share"] > 0.6) & (test["upper_share"] > 0.8))
    assert ((found.first_rule(test) > 0) == truth).mean() > 0.97
    assert all(1 <= len(r) <= qr.MAX_TERMS for r in found.rules) and "otherwise keep" in str(found)
    for one_class in (np.zeros(n, bool), np.ones(n, bool)):
        assert qr.learn_list(x, one_class).rules == []
    assert qr.learn_list({s: np.zeros(0) for s in x}, np.zeros(0, bool)).rules == []


def test_spark_expression_equals_the_list(spark):
    rng = random.Random(8)
    rows = [tuple([i] + [rng.randrange(0, 50) for _ in qr.COUNTS]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in qr.COUNTS))
    rules = qr.DecisionList([(qr.Term("symbol_share", True, 1.5), qr.Term("n_words", False, 20.0)), (qr.Term("again_share", True, 0.7),)])
    got = df.select("doc_id", rules.column().alias("rule"), *[qr.statistic(s).alias(s) for s in qr.STATISTICS]).orderBy("doc_id").collect()
    x = {s: np.array([r[s] for r in got]) for s in qr.STATISTICS}
    assert [r.rule or 0 for r in got] == rules.first_rule(x).tolist()


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0
    got = qr.quality_rules(docs, labels.where(~held)).join(labels.where(held), "doc_id").where("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in got) / len(got)
    clean = [r for r in got if r.quality]
    assert right > 0.95 and sum(r.kept for r in clean) / len(clean) > 0.97


def test_query_on_the_given_table(spark, sf_small):
    got = q.queries()["op13_quality_rules"](spark, sf_small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert {r.doc_id: tuple(r[c] for c in qr.COUNTS[:5]) for r in got} == {i: brute(t) for i, t in docs.items()}
    assert all(not (r.kept and r.base_failed) for r in got)
