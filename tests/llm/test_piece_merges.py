import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from medallion.llm import piece_merges as pm
from medallion.llm import sentencepiece_scan as sc
from medallion.llm.queries import PIECE_BPE, op2_sentencepiece, tokenizer_file

from .common import documents, empty, simple, words

PATH = tokenizer_file(PIECE_BPE)
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
SMALL = "/root/testdata/sf0.01"


def by_chunks(text, size):
    m = pm.Merges.load(PATH)
    rows = list(pm.chunks_of(m, sc.escape(text), size))
    asked = [r for r in rows if r[4] < 0 or r[5] < 0]
    states = pm.walk([m.relation(*r[1:]) for r in asked], pm.KNOWN, pm.KNOWN)
    found = {r[0]: (a, b) for r, a, b in zip(asked, states, states[1:])}
    ids = []
    for k, x, lead, n, i, j in rows:
        i, j = (i if i >= 0 else found[k][0] % pm.WIDTH), (j if j >= 0 else found[k][1] % pm.WIDTH)
        ids += np.frombuffer(m.encode(x[lead + i:lead + n + j]), "<u4").tolist()
    return ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aabet h in日☃\n\U0001F388xyz▁", min_size=1, max_size=90), st.sampled_from([1, 2, 3, 7, 16, 40]),
       st.sampled_from([0, 3, 512]))
def test_ids_equal_the_library(text, size, reach):
    was, pm.REACH = pm.REACH, reach
    try:
        assert by_chunks(text, size) == SP.encode(text)
    finally:
        pm.REACH = was


def test_stretches_without_boundaries_equal_the_library():
    rng = random.Random(2)
    for text in ["x" * 3000, " " * 2000 + "a", "".join(rng.choice("thein") for _ in range(4000)), "ab" * 1500, "=" * 2500]:
        assert by_chunks(text, 700) == SP.encode(text)


def collect_ids(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.doc_id, r.thash), {})[r.chunk] = np.frombuffer(r.ids, "<u4").tolist()
    return {k: [i for c in sorted(v) for i in v[c]] for k, v in out.items()}


def test_whole_pieces_are_found(spark):
    ids = next(iter(collect_ids(pm.encode(simple(spark, ["Elle"]), PATH)).values()))
    assert [SP.id_to_piece(i) for i in ids] == ["▁Elle"]


def test_documents_equal_the_library_and_decode_to_their_text(spark, monkeypatch):
    monkeypatch.setattr(pm, "BLOCK", 4)
    rng = random.Random(5)
    texts = ["".join(rng.choice("thein") for _ in range(9000)), "x" * 9000, words(rng, 3000), "日本語" * 2000]
    docs = documents(spark).select("doc_id", "text").union(simple(spark, texts, 100).select("doc_id", "text"))
    enc = pm.encode(docs, PATH, chunk=600)
    want = {(r.doc_id, tuple(SP.encode(r.text or ""))) for r in docs.collect()}
    assert {(k[0], tuple(v)) for k, v in collect_ids(enc).items()} == want
    back = {}
    for r in sc.decode(enc, PATH).collect():
        back.setdefault((r.doc_id, r.thash), {})[r.chunk] = r.text
    assert {(k[0], "".join(v[c] for c in sorted(v))) for k, v in back.items()} == {(r.doc_id, r.text or "") for r in docs.collect()}
    assert pm.encode(empty(spark), PATH).count() == 0


def test_the_query_counts_the_ids_of_the_library(spark):
    got = {r.doc_id: r.n for r in op2_sentencepiece(spark, SMALL).groupBy("doc_id").agg({"n_ids": "sum"}).toDF("doc_id", "n").collect()}
    assert got == {r.doc_id: len(SP.encode(r.text or "")) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
