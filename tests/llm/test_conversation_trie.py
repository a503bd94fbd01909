"""The prefix trie against a brute-force trie over Python tuples."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm import conversation_trie as ct
from medallion.llm import queries as q

SCHEMA = "conv_id long, turn long, role string, text string, turns string, part string, conv string, base string, node_key string"
CLASH = ("x",) * 5


def rebuilt(rows, graft=True):
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            whole = f"{len(role.encode())}:{role}{text}".encode()
            by[c].append(((t is not None, t or 0), hashlib.md5(whole).digest(), (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in by.items()}
    if not graft:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        saved[p] = sum(saved[k] for k in kids) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p)))).encode()).hexdigest())
                  for p, m in members.items())


def found(df):
    return sorted(tuple(r[c] for c in ct.NODE_COLUMNS) for r in df.collect())


def sample(seed, n_convs, vocab, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n_convs * 2), n_convs):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None]) if vocab > 3 else "user",
                         rng.choice(["a", "bb", "ü", None, ""][:vocab]), *CLASH))
    for c in range(10_000, 10_000 + n_convs):  # a group of copies holding half of all rows
        rows += [(c, t, "user", f"hot {t}", *CLASH) for t in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,vocab,longest,cells", [(1, 2, 4, 1 << 20), (2, 2, 5, 12), (3, 5, 9, 40), (4, 1, 12, 7)])
def test_random_against_brute_force(spark, seed, vocab, longest, cells):
    rows = sample(seed, 60, vocab, longest)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ct.prefix_trie(df, base=F.expr("conv_id - conv_id % 5"), head=F.expr("crc32(cast(conv_id as string)) % 9"),
                         block_cells=cells)
    assert found(got) == brute(rebuilt(rows))
    assert found(ct.prefix_trie(df, block_cells=cells)) == brute(rebuilt(rows, graft=False))


def test_edges(spark):
    long = [(900, t, "user", f"t{t}", *CLASH) for t in range(1500)]
    rows = [(1, None, "user", "null turn first", *CLASH), (1, 0, "user", "then zero", *CLASH), (2, 0, None, None, *CLASH),
            (2, 0, None, None, *CLASH), (3, 5, "user", "x" * 100_000, *CLASH), (4, 0, "", "", *CLASH), (None, 0, "user", "no id", *CLASH),
            (7, 0, "user", "own", *CLASH), (-3, 0, "user", "negative", *CLASH)] + long + long[:1]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ct.prefix_trie(df, block_cells=64)) == brute(rebuilt(rows, graft=False))
    empty = ct.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ct.NODE_COLUMNS


def test_query_on_the_given_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = q.queries()["op11_conversation_trie"](spark, sf_small)
    assert found(got) == brute(rebuilt(rows))


def test_many_ranges_and_blocks_agree(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        small = found(ct.prefix_trie(df, block_cells=9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert small == found(ct.prefix_trie(df))
