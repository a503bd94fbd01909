import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from medallion.llm import exact_dedup as ed

from .common import DOC_SCHEMA, documents, edge_rows, empty, simple


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(norm(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, i))
    return {k: (min(v), len(v)) for k, v in groups.items()}


def test_every_edge_row_against_brute_force(spark):
    rows = edge_rows()
    got = ed.exact_dedup(documents(spark)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        (best, n) = sha[r.text_sha256]
        assert (r.keep_id, r.group_size) == (None if best[1] else best[2], n)
    assert sum(r.kept for r in got) == len(want)  # one of repeated rows stays


def test_empty_table_gives_no_rows(spark):
    assert ed.exact_dedup(empty(spark)).count() == 0
    assert ed.drop_exact_duplicates(empty(spark)).count() == 0


def test_filtering_keeps_one_row_a_group_and_all_columns(spark):
    docs = documents(spark)
    kept = ed.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted(norm(r.text) for r in kept.collect()) == sorted(brute(edge_rows()))


def test_longest_original_text_stays(spark):
    got = {r.doc_id: r for r in ed.exact_dedup(simple(spark, ["a b", "a  b", "ab", "a  b"])).collect()}
    assert [got[i].keep_id for i in range(4)] == [1] * 4 and [got[i].kept for i in range(4)] == [False, True, False, False]


def test_index_inserts_and_deletes_live_digests(spark):
    docs = simple(spark, ["t%d" % (i % 700) for i in range(1000)])
    state = ed.update_index(ed.sign(docs), n_shards=3)
    live = {bytes(r.digest): r.n_rows for r in ed.live_keys(state).collect()}
    assert len(live) == 700 and sum(live.values()) == 1000
    gone = ed.sign(simple(spark, ["t%d" % i for i in range(500)]))
    state = ed.update_index(gone, state, kind="delete")
    left = {bytes(r.digest): r.n_rows for r in ed.live_keys(state).collect()}
    assert len(left) == 500 and sum(left.values()) == 500  # t0..t299 had two rows each
    again = ed.update_index(ed.sign(simple(spark, ["t450", "new"])), state)
    assert ed.live_keys(again).count() == 502


def test_deleting_the_keeper_renews_it(spark):
    """Every row can go, the kept one too, over several batches; strangers change nothing."""
    def rows(*r):
        return ed.sign(spark.createDataFrame(list(r), "doc_id long, text string"))
    index = ed.ContentIndex().insert(rows((1, "a  b"), (2, "a b"), (3, "ab"), (4, "other")))
    index = index.insert(rows((5, "a  b"), (1, "a  b"), (None, "a   b")))

    def live():
        return {(r.n_rows, r.keep_id, r.keep_chars) for r in index.live_keys().collect()}

    assert live() == {(6, None, 5), (1, 4, 5)}
    index = index.delete(rows((None, "a   b"), (9, "a b"), (2, "a  b"), (7, "unknown")))
    assert live() == {(5, 1, 4), (1, 4, 5)}
    index = index.delete(rows((1, "a  b")))
    assert live() == {(4, 1, 4), (1, 4, 5)}     # the row repeated in the second batch is still live
    index = index.delete(rows((1, "a  b"), (1, "a  b"), (4, "other")))
    assert live() == {(3, 5, 4)}
    index = index.delete(rows((5, "a  b"), (2, "a b"), (3, "ab")))
    assert live() == set()
    index = index.insert(rows((8, "ab")))
    assert live() == {(1, 8, 2)}
    assert ed.ContentIndex().delete(rows((1, "a"))).state is None


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=300))
def test_shard_index_equals_a_counter(ops):
    index, model = ed.ShardIndex(0), {}
    for insert, k in ops:
        d = hashlib.sha256(bytes([k])).digest()
        if insert:
            index.insert(d, 1, (0, False, k, 0))
            model[d] = model.get(d, 0) + 1
        else:
            index.delete(d, 1)
            if d in model:
                model[d] -= 1
                if not model[d]:
                    del model[d]
    assert {d: e[0] for d, e in index.items()} == model
    assert all(index.find(d) is not None for d in model)


def test_overflow_resizes_from_the_stored_keys():
    index = ed.ShardIndex(0)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(2000)]
    for d in digests:
        index.insert(d, 1, (0, False, 0, 0))
    assert index.resizes >= 8 and all(index.find(d) for d in digests)
    assert index.find(hashlib.sha256(b"other").digest()) is None


def test_filter_false_positives_do_not_merge():
    index = ed.ShardIndex(0)
    a = b"\x01" * 8 + b"a" * 24
    b = b"\x01" * 8 + b"b" * 24  # same filter key, other digest
    index.insert(a, 1, (0, False, 1, 0))
    index.insert(b, 1, (0, False, 2, 0))
    assert len(dict(index.items())) == 2
    index.delete(a, 1)
    assert index.find(b) is not None and index.find(a) is None


def test_hot_digest_reaches_its_shard_pre_aggregated(spark):
    rng = random.Random(0)
    docs = simple(spark, ["hot" if i % 3 == 0 else "t%d" % rng.randrange(10 ** 6) for i in range(900)]).repartition(6)
    ops = ed._ops(ed.sign(docs), "insert", 2).groupBy("digest").count().collect()
    assert max(r["count"] for r in ops) <= ed.SALTS
    assert DOC_SCHEMA
