import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from medallion.llm import sentencepiece_scan as sc
from medallion.llm.queries import PIECE_BPE, tokenizer_file

from .common import documents, empty, simple, words

PATH = tokenizer_file(PIECE_BPE)


def whole(v, text):
    x = sc.escape(text)
    best, back = v.forward(x, 0, len(x))
    return best[len(x)], v.trace(x, back, 0, len(x))


def by_chunks(v, text, size):
    x = sc.escape(text)
    cs = [sc.Chunk(v, x[s:s + size + v.longest - 1], min(size, len(x) - s), x[s - 1] if s else "") for s in range(0, len(x), size)]
    mats = [c.matrix() for c in cs]
    half = len(mats) // 2  # any grouping gives the same product
    total = mats[0]
    for m in mats[1:]:
        total = sc.product(total, m)
    if half:
        left, right = mats[0], mats[half]
        for m in mats[1:half]:
            left = sc.product(left, m)
        for m in mats[half + 1:]:
            right = sc.product(right, m)
        assert sc.product(left, right)[0, 0] == total[0, 0]
    states = sc.walk(mats, 0, 0)
    return int(total[0, 0]), [i for c, a, b in zip(cs, states, states[1:]) for i in c.encode(a, b)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aabet h in日☃\n\U0001F388xyz", min_size=1, max_size=90), st.sampled_from([1, 2, 3, 7, 16, 40]))
def test_scan_equals_the_whole_text_program(text, size):
    v = sc.Vocabulary.load(PATH)
    score, _ = whole(v, text)
    total, ids = by_chunks(v, text, size)
    assert total == score
    assert b"".join(v.surface[i] for i in ids)[1:].decode() == text
    known = {i: s for s, i in v.pieces.values()}
    if all(i in known for i in ids):
        assert sum(known[i] for i in ids) == score


def test_scores_equal_the_library_under_the_same_scores():
    m = pb.ModelProto()
    m.ParseFromString(open(PATH, "rb").read())
    m.trainer_spec.model_type = 1  # the library's best-score segmentation
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    v, rng = sc.Vocabulary.load(PATH), random.Random(3)
    known = {i: s for s, i in v.pieces.values()}
    for _ in range(60):
        text = " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 9))) for _ in range(8))
        score, ids = whole(v, text)
        assert sum(known[i] for i in sp.encode(text)) == score == sum(known[i] for i in ids)


def collect_ids(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.chunk):
        out.setdefault((r.doc_id, r.thash), {})[r.chunk] = np.frombuffer(r.ids, "<u4").tolist()
    return {k: [i for c in sorted(v) for i in v[c]] for k, v in out.items()}


def test_edge_rows_round_trip_and_equal_unchunked(spark):
    docs = documents(spark)
    enc = sc.encode(docs, PATH, chunk=500)
    assert enc.where("chunk > 3").count() > 0
    texts = {}
    for r in sc.decode(enc, PATH).collect():
        texts.setdefault((r.doc_id, r.thash), {})[r.chunk] = r.text
    got = {(k[0], "".join(v[c] for c in sorted(v))) for k, v in texts.items()}
    assert got == {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}
    v = sc.Vocabulary.load(PATH)
    known = {i: s for s, i in v.pieces.values()}
    for (doc_id, _), ids in collect_ids(sc.encode(simple(spark, [words(random.Random(7), 900)] * 3), PATH, chunk=300)).items():
        assert sum(known[i] for i in ids) == whole(v, words(random.Random(7), 900))[0]


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sc, "BLOCK", 4)
    text = "".join(random.Random(5).choice("thein") for _ in range(700))  # no place that collapses the state
    enc = sc.encode(simple(spark, [text]), PATH, chunk=20)
    assert enc.count() == 36
    v = sc.Vocabulary.load(PATH)
    known = {i: s for s, i in v.pieces.values()}
    ids = next(iter(collect_ids(enc).values()))
    assert sum(known[i] for i in ids) == whole(v, text)[0]


def test_empty_table(spark):
    assert sc.decode(sc.encode(empty(spark), PATH), PATH).count() == 0
