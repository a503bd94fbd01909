import random

import pytest

from medallion.llm import line_dedup as ld

from .common import documents, empty, simple, words


def brute(rows):
    """Line numbers that go, per document, for rows of (doc_id, text)."""
    def word_set(line):
        return frozenset("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).split())
    lines = sorted(((d is None, d or 0, k, line) for d, t in rows for k, line in enumerate((t or "").split("\n"))))
    gone, seen = {}, []
    for no_id, d, k, line in lines:
        s = word_set(line)
        key = None if no_id else d
        gone.setdefault(key, [])
        if not s:
            continue
        if any((line == x and (no_id, d, k) != at) or (line != x and 5 * len(s & y) >= 4 * len(s | y)) for at, x, y in seen):
            gone[key].append(k)
        seen.append(((no_id, d, k), line, s))
    return gone


def test_edge_rows(spark):
    docs = documents(spark)
    got = {r.doc_id: r.removed for r in ld.removed_lines(docs, rarity_slots=1 << 12).collect()}
    distinct = {r[0]: r for r in docs.select("doc_id", "text").collect()}
    want = brute([(r[0], r[1]) for r in distinct.values()])
    want = {d: want[d] for d in want}
    for d in want:
        assert sorted(set(got[d])) == want[d], d
    assert sorted(set(got[7])) == []  # lines without words stay


@pytest.mark.parametrize("slots", [64, 1 << 14])
def test_near_copies_against_brute_force(spark, slots):
    rng = random.Random(6)
    lines = []
    for _ in range(40):
        base = words(rng, rng.randrange(1, 14), 600).split()
        for _ in range(rng.randrange(1, 6)):
            t = list(base)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = "n%d" % rng.randrange(30)
            lines.append(" ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
    rng.shuffle(lines)
    texts = ["\n".join(lines[i:i + 5]) for i in range(0, len(lines), 5)]
    got = {r.doc_id: (r.removed, r.n_lines) for r in ld.removed_lines(simple(spark, texts), rarity_slots=slots).collect()}
    want = brute(list(enumerate(texts)))
    assert {d: r for d, (r, _) in got.items()} == want
    assert sum(map(len, want.values())) > 20
    assert all(n == t.count("\n") + 1 for t, (_, n) in zip(texts, (got[i] for i in range(len(texts)))))


@pytest.mark.parametrize("list_rows", [3, 1 << 12])
def test_long_lists_are_cut_into_blocks(spark, list_rows):
    """Lines of a few common words, near copies of long ones, and lines that only seem near."""
    rng = random.Random(9)
    pool = ["w%d" % i for i in range(9)]
    base = ["k%d" % i for i in range(60)]
    lines = [" ".join(rng.sample(pool, rng.randrange(3, 7))) for _ in range(60)]
    lines += [" ".join(w if rng.random() > p else "z%d" % rng.randrange(400) for w in base) for p in (.02, .05, .1, .13) for _ in range(15)]
    rng.shuffle(lines)
    docs = simple(spark, ["\n".join(lines[i:i + 4]) for i in range(0, len(lines), 4)])
    got = {r.doc: sorted(r.removed) for r in ld._removed(docs, ld.SIMILARITY, "text", "doc_id", 1 << 10, list_rows).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_near_pairs_that_fail_are_asked_again(spark):
    """Maps that hardly differ though the words do: the earliest near line is not similar, a later one is."""
    def with_bit(bit, k):
        import xxhash
        i, out = 0, []
        while len(out) < k:
            w = "q%d" % i
            if xxhash.xxh64_intdigest(w.encode()) >> 57 == bit:
                out.append(w)
            i += 1
        return out
    same = with_bit(5, 40)
    first, second = same[:10], same[5:20]
    third = second[:-1] + ["other"]
    texts = [" ".join(first + same[20:22]), " ".join(second), " ".join(third), " ".join(same[20:40])]
    got = {r.doc_id: r.removed for r in ld.removed_lines(simple(spark, texts), rarity_slots=64).collect()}
    assert got == brute(list(enumerate(texts))) and got[2] == [0]


def test_helper_names_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b\na b", "x", "y")], "doc_id long, text string, __removed string, __doc string")
    assert [tuple(r) for r in ld.dedup_lines(docs, rarity_slots=1 << 10).collect()] == [(1, "a b", "x", "y")]


def test_texts_lose_the_removed_lines_only(spark):
    docs = simple(spark, ["a b c d e\nsame line here\n", "x\na b c d e\nsame line here", None])
    out = {r.doc_id: r.text for r in ld.dedup_lines(docs, rarity_slots=1 << 10).collect()}
    assert out == {0: "a b c d e\nsame line here\n", 1: "x", 2: None}
    assert ld.dedup_lines(docs, rarity_slots=1 << 10).columns == docs.columns


def test_rows_without_an_id_have_one_result_each(spark):
    docs = spark.createDataFrame([(None, "a b c d e\nx"), (None, "y\na b c d e"), (5, "a b c d e")], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.n_lines, tuple(r.removed)) for r in ld.removed_lines(docs, rarity_slots=1 << 10).collect())
    assert got == [(False, 1, ()), (True, 2, (0,)), (True, 2, (1,))]


def test_empty_table(spark):
    assert ld.removed_lines(empty(spark), rarity_slots=1 << 10).count() == 0


def test_words_are_counted_over_all_slots(spark):
    texts = ["one two Two", "two three\none", None, "x" * 70 + " " + "X" * 70, "é É\x0bthree \x1c"]
    lines = simple(spark, texts).selectExpr("text as t")
    counts = ld.word_counts(lines, ld.RARITY_SLOTS)
    assert sorted(counts[counts > 0].tolist()) == [8, 8, 8, 12]    # one, three, x...: 2 each; two: 3
    assert len(counts) == ld.RARITY_SLOTS


def test_lines_are_asked_again_of_similar_sizes_only(spark):
    """All lines of a failed line's words came back before, so their number grew with the square of a list's length."""
    rng = random.Random(3)
    rows = [(rng.randrange(4), d, 0, rng.randrange(1, 60), 0, 99, rng.getrandbits(5), rng.getrandbits(3)) for d in range(400)]
    posted = spark.createDataFrame(rows, "tok int, doc long, line int, n int, pos int, often int, bits0 long, bits1 long")
    asked = [r for r in rows if r[1] % 40 == 39]
    got = {r.doc for r in ld._asked_again(posted, posted.where("doc % 40 = 39"), (4, 5)).collect()}

    def alike(x, y):
        d = (x[6] ^ y[6]).bit_count() + (x[7] ^ y[7]).bit_count()
        return x[0] == y[0] and (x == y or x[1] < y[1] and 4 * x[3] <= 5 * y[3] and 4 * y[3] <= 5 * x[3]
                                 and 9 * min(x[3], y[3]) >= 4 * (x[3] + y[3]) and 9 * d <= x[3] + y[3])
    assert got == {x[1] for x in rows if any(alike(x, y) for y in asked)}
    assert 2 * len(got) < len(rows)


@pytest.mark.parametrize("n", [1, 40])
def test_only_words_that_may_have_long_lists_are_counted(spark, n):
    texts = [f"common word{i} other{i % 50} word{i} more{i % 50}" for i in range(200)]
    firsts = ld.distinct_lines(simple(spark, texts), rarity_slots=1 << 16, list_rows=n)
    lists = firsts.selectExpr("posexplode(toks) as (pos, tok)", "often")
    true = {r.tok for r in lists.groupBy("tok").count().where(f"count > {n}").collect()}
    assert true <= {r.tok for r in lists.where("pos >= often").collect()}


@pytest.mark.parametrize("list_rows, part_rows", [(4, 30), (1 << 12, 30), (1 << 12, 1 << 20)])
def test_rows_of_lists_move_packed(spark, list_rows, part_rows):
    """Every word of every line was a row of its own in the shuffle and the sort."""
    rng = random.Random(4)
    rows = [(d // 3, d % 3, 10 + rng.randrange(4), rng.sample(range(-6, 6), 3), 0, 1 << rng.randrange(3), rng.getrandbits(2), 0, rng.random() < .5)
            for d in range(120)]
    lines = spark.createDataFrame(rows, "doc long, line int, n int, toks array<int>, often int, bits0 long, bits1 long, pos int, ask boolean")
    found = ld.list_pairs(lines, every=True, list_rows=list_rows, part_rows=part_rows)
    assert "posexplode" not in found._jdf.queryExecution().executedPlan().toString()

    def meet(x, y):
        d, n = (x[5] ^ y[5]).bit_count() + (x[6] ^ y[6]).bit_count(), x[2] + y[2]
        return any(9 * min(x[2] - x[3].index(t), y[2] - y[3].index(t)) >= 4 * n and 9 * d <= n
                   and 4 * x[2] <= 5 * y[2] and 4 * y[2] <= 5 * x[2] for t in set(x[3]) & set(y[3]))
    want = {(y[0], y[1], x[0], x[1]) for i, x in enumerate(rows) for y in rows[i + 1:] if y[8] and meet(x, y)}
    assert {tuple(r)[:4] for r in found.collect()} == want and len(want) > 100


def test_a_line_does_not_meet_itself(spark):
    """Two words of a line alike in 32 bits put it into one list twice; it was then similar to itself."""
    import numpy as np
    import pyarrow as pa
    from medallion.llm.words import hashed_words
    many = ["u%d" % i for i in range(400_000)]
    low = hashed_words(pa.array(many), True)[0] & np.uint64(0xFFFFFFFF)
    order = np.argsort(low, kind="stable")
    k = int(np.flatnonzero(low[order][1:] == low[order][:-1])[0])
    pair = [many[order[k]], many[order[k + 1]]]
    common = ["c%d" % i for i in range(7)]
    texts = [" ".join(pair + common), " ".join(pair + ["d%d" % i for i in range(12)])] + [f"{c} alone{i} here{j}" for i, c in enumerate(common) for j in range(5)]
    got = {r.doc_id: r.removed for r in ld.removed_lines(simple(spark, texts), rarity_slots=1 << 20).collect()}
    assert got == brute(list(enumerate(texts))) and got[0] == []
