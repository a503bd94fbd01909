import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medallion.llm import packing
from medallion.llm.queries import WORD_BPE, op1_packing, tokenizer_file

from .common import documents, edge_rows, empty

SMALL = "/root/testdata/sf0.001"


def check(pieces, rows):
    tok = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    by_seq = {}
    for r in pieces:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for s in by_seq.values():  # gapless, full or a power of two
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and len(r.ids) == 4 * r.length > 0
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    want = {}
    for i, text in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes()
        want.setdefault((i, ids), []).append(i)
    got = {}
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, ps in by_doc.items():
        copies = sum(p.start == 0 for p in ps)
        for _, same in itertools.groupby(sorted(ps, key=lambda p: p.doc_tokens), key=lambda p: p.doc_tokens):
            same = sorted(same, key=lambda p: (p.start, p.length))
            assert sum(p.length for p in same) % same[0].doc_tokens == 0
            if copies == 1:
                assert [p.start for p in same] == list(np.cumsum([0] + [p.length for p in same[:-1]]))
                got.setdefault((i, b"".join(p.ids for p in same)), []).append(i)
    multi = {i for i, ps in by_doc.items() if sum(p.start == 0 for p in ps) > 1}
    assert set(got) == {k for k in want if k[0] not in multi}


def test_edge_rows(spark):
    pieces = packing.pack(documents(spark), tokenizer_file(WORD_BPE)).collect()
    rows = [r[:2] for r in edge_rows()]
    check(pieces, rows)
    assert sum(p.start == 0 for p in pieces) == len(rows)


def test_real_documents_and_digests(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(packing.pack(docs, tokenizer_file(WORD_BPE), tokens_per_range=20_000).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    q = op1_packing(spark, SMALL)
    assert q.agg(F.countDistinct("doc_id")).first()[0] == docs.count()
    assert q.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_empty_table(spark):
    assert packing.pack(empty(spark), tokenizer_file(WORD_BPE)).count() == 0


@pytest.mark.parametrize("text", ["Hello, World!! it's DON'T x--y 12,3", "<|startoftext|>a <|endoftext|> b", "É́a é İstanbul ΣΑΣ",
                                  "a b c", "...!!", "", "word. word, WORD!", "x" * 3000])
def test_word_wise_encoding_equals_the_tokenizer(text):
    import pyarrow as pa
    tok = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    ids, ends = packing.encode_batch(pa.array([text, "next one"]), tokenizer_file(WORD_BPE))
    assert ids[:ends[0]].tolist() == tok.encode(text, add_special_tokens=False).ids
    assert ids[ends[0]:].tolist() == tok.encode("next one", add_special_tokens=False).ids


def test_hilbert_neighbours_are_one_step_apart():
    bits = 3
    pts = np.array(list(itertools.product(range(8), repeat=3)))
    key = packing.hilbert_key(pts, bits)
    assert sorted(key) == list(range(512))
    steps = np.abs(np.diff(pts[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pack(docs, tokenizer_file(WORD_BPE)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    mixed = {}
    for p in pieces:
        mixed.setdefault(p.sequence_id, set()).add(p.lang)
    assert np.mean([len(v) == 1 for v in mixed.values()]) > 0.6


def test_every_letter_before_a_mark_has_the_librarys_ids():
    """All letters of U+0080-U+2FFFF with punctuation behind them, alone and in a word."""
    import pyarrow as pa
    path = tokenizer_file(WORD_BPE)
    tok = Tokenizer.from_file(path)
    letters = [chr(c) for c in range(0x80, 0x30000) if chr(c).isalpha()]
    words = [w for c in letters for w in (c + ".", "ab" + c + ",", c + "x!")] + ["BELEDİYESİ.", "İLİ,", "ΟΔΟΣ.", "don't.", "x'", "...", "Straße!?"]
    for lo in range(0, len(words), 50_000):
        part = words[lo:lo + 50_000]
        ids, ends = packing.encode_batch(pa.array(part), path)
        want = [e.ids for e in tok.encode_batch(part, add_special_tokens=False)]
        got = [ids[s:e].tolist() for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
        assert got == want


def test_long_documents_are_cut_into_rows(spark):
    docs = spark.createDataFrame([(i, "word %d " % i * 9000) for i in range(3)] + [(9, "short")], "doc_id long, text string")
    rows = packing.tokenise(docs, tokenizer_file(WORD_BPE)).collect()
    assert all(len(r.ids) <= 4 * packing.CHUNK_IDS for r in rows) and len(rows) > 8
    check(packing.pack(docs, tokenizer_file(WORD_BPE), tokens_per_range=5000).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_word_pool_holds_no_words():
    """A full pool of words as objects took so much of two workers that an executor went over its memory."""
    import tracemalloc

    import pyarrow as pa

    from medallion.llm.words import HashPool, hashed_words
    text = " ".join(f"Word{i}{'x' * (i % 90)}" for i in range(200_000)) + " word7xxxxxxx <|é"
    texts = pa.array(["", text, " \n", "Ab ab"])
    hashes, starts, ends, offsets, data = hashed_words(texts, True)
    words = [data[s:e].tobytes().decode().lower() for s, e in zip(starts, ends)]
    assert words == (text + " Ab ab").lower().split() and offsets.tolist() == [0, 0, 200_002, 200_002, 200_004]
    assert len(set(hashes.tolist())) == len(set(words))
    tracemalloc.start()
    pool = HashPool(lambda new: [[len(w), int(w[4:].rstrip("x") or 0) if w.startswith("word") else 0] for w in new])
    for _ in range(2):
        slots, begin, n, ids = pool.lookup(hashes, starts, ends, data, True)
        at = begin[slots]
        assert (n[slots] == 2).all() and ids[at].tolist() == [len(w) for w in words]
        assert ids[at[:200_000] + 1].tolist() == list(range(200_000))
    del slots, begin, n, ids, at
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 15 << 20


def test_whole_texts_are_read_few_at_a_time(spark):
    packing.tokenise(documents(spark), tokenizer_file(WORD_BPE))
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
