import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from medallion.llm import langid, secret_forest
from medallion.llm.common import fold_of

from .common import documents, empty, simple, words
from .test_exact_dedup import norm
from .test_packing import check
from .test_simhash_bytes import slow_fingerprint
from .common import smallest_reachable


def corpus(rng):
    texts = []
    for i in range(30):
        t = words(rng, 120)
        texts += [t, t + " ", t.replace(" ", "  ", 1)] if i % 3 == 0 else [t]
        if i % 5 == 0:
            texts.append(t + f" password={rng.getrandbits(72):018x} end")
    return texts + ["1234 5678", None, ""]


def brute(docs, spark):
    """The pipeline's stages one by one on plain Python rows (language and forest decisions shared)."""
    model = langid.fit_languages(docs, learn=fold_of("doc_id", 5) != 0)
    rows = [(r.doc_id, r.text) for r in langid.predict_languages(docs, model).collect() if not r.lang_rejected]
    best = {}
    for d, t in rows:
        k = norm(t)
        if k not in best or (-len(t or ""), d) < (-len(best[k][1] or ""), best[k][0]):
            best[k] = (d, t)
    rows = sorted(best.values())
    fps = [slow_fingerprint(t) for _, t in rows]
    comp = smallest_reachable(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    rows = [r for i, r in enumerate(rows) if comp[i] == i]
    kept = simple(spark, []).unionByName(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], docs.schema))
    found = {}
    for r in secret_forest.scan_secrets(kept).where("is_secret").collect():
        found.setdefault(r.doc_id, []).append(r.value)
    out = []
    for d, t in rows:
        for v in sorted(found.get(d, []), key=len, reverse=True):
            t = t.replace(v, secret_forest.MASK)
        out.append((d, t))
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs = simple(spark, corpus(random.Random(1)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = docs
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, got, str(tmp_path))
        assert got.columns == docs.columns, name
    want = brute(docs, spark)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want
    assert any(secret_forest.MASK in t for _, t in want)
    pieces = cp.run(spark, str(tmp_path))
    assert "pipeline" in entry.queries() and cp.ORACLE_SQL is None
    from medallion.llm.packing import pack
    from medallion.llm.queries import WORD_BPE, tokenizer_file
    ids = pack(got, tokenizer_file(WORD_BPE))
    check(ids.collect(), want)
    full = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces.collect()}
    assert full == {tuple(r) for r in ids.select("doc_id", "start", "length", F.crc32("ids")).collect()}


def test_every_stage_takes_edge_rows_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in cp.STAGES:
            assert stage(spark, docs, "/nowhere").count() <= 10 * docs.count()
