"""SimHash near-dedup over a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes.  Two fingerprints within
``max_bits`` differing bits differ in at most that many bytes, so they share at
least ``8 - max_bits`` positional bytes.  The index therefore posts every
distinct fingerprint under each set of ``8 - max_bits`` positions with the bytes
found there: a pair reaches the guaranteed count exactly if it meets in a
posting list.  A list can hold no more than 256**max_bits fingerprints however
large the corpus grows, because all of its members share the other bytes.
Within a list the shared positional bytes of each pair are tallied, pairs at the
minimum are kept and their bit distance is verified; only a spanning forest of
the verified links leaves the task, so large groups of near copies never emit
all their pairs.
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, keep_rows, materialise, prepare, text_of
from .components import components

SEED = 42
CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of a whole text as an unsigned 64-bit number (0 without words)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = iter([h(b" ".join(words), SEED)])
        total = 1
    else:
        hashes = (h(b" ".join(t), SEED) for t in zip(*(islice(words, i, None) for i in range(shingle))))
        total = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    while True:
        part = np.fromiter(islice(hashes, CHUNK), dtype="<u8")
        if not len(part):
            break
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", id_col: str = "doc_id",
                 extra: dict | None = None) -> DataFrame:
    """``doc_id, fp`` (signed long holding the 64 bits) per row, plus ``extra`` columns."""
    prepare(docs.sparkSession)
    extra = extra or {}
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                      *[c.alias(n) for n, c in extra.items()])

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            cols = [b.column(n) for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps.view(np.int64))],
                                             names=[n for n in b.schema.names if n != "text"] + ["fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "text")
    return src.mapInArrow(run, schema + ", fp long")


def postings(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(positions, bytes)`` keys of every distinct fingerprint with their members."""
    masks = []
    for positions in combinations(range(8), 8 - max_bits):
        mask = sum(0xFF << (8 * p) for p in positions)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("positions"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
                     for i, m in enumerate(masks)])
    return (fps.select("fp", F.explode(keys).alias("k")).groupBy("k.positions", "k.bytes")
            .agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))


def _links(members: np.ndarray, max_bits: int, block: int = 1024):
    """Spanning links of one posting list: tally shared bytes, verify bits."""
    a = np.sort(members.astype(np.int64)).view(np.uint64)
    n = len(a)
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    byte = a.view(np.uint8).reshape(n, 8)
    out = []
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        for lo2 in range(lo, n, block):
            hi2 = min(n, lo2 + block)
            shared = np.zeros((hi - lo, hi2 - lo2), dtype=np.uint8)
            for p in range(8):
                shared += byte[lo:hi, None, p] == byte[None, lo2:hi2, p]
            i, j = np.nonzero(shared >= 8 - max_bits)
            i, j = i + lo, j + lo2
            ok = i < j
            i, j = i[ok], j[ok]
            near = np.bitwise_count(a[i] ^ a[j]) <= max_bits
            for x, y in zip(i[near], j[near]):
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    out.append((x, y))
    signed = a.view(np.int64)
    return [(int(signed[x]), int(signed[y])) for x, y in out]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """``(src, dst)`` fingerprints whose links span every group of linked ones."""

    def run(batches):
        for b in batches:
            pairs = []
            for m in b.column("members"):
                pairs += _links(m.values.to_numpy(zero_copy_only=False), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                              pa.array([p[1] for p in pairs], pa.int64())], names=["src", "dst"])

    return postings(fps, max_bits).select("members").mapInArrow(run, "src long, dst long").distinct()


def simhash_near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text_col: str = "text",
                       id_col: str = "doc_id", extra: dict | None = None) -> DataFrame:
    """One row per input row: ``doc_id, fp, component_id`` plus ``extra`` columns.

    component_id is the smallest doc_id reachable through links of at most
    ``max_bits`` differing bits.  Null text counts as empty; texts without words
    have fingerprint zero and link like any other; rows repeated with one id stay
    rows; a row without an id takes part and gets its group's smallest id, null if
    the group has none; an empty table gives no rows."""
    signed = materialise(fingerprints(docs, shingle, text_col, id_col, extra), "simhash")
    reps = signed.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = components(links(reps.select("fp"), max_bits))
    placed = reps.join(groups, reps["fp"] == groups["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    placed = materialise(placed, "simhash_groups")
    smallest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    member = placed.join(smallest, "component").select(F.col("fp").alias("fp2"), "component_id")
    return signed.join(member, F.col("fp") == F.col("fp2")).select(
        *[c for c in signed.columns], "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text_col: str = "text",
                         id_col: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` for one row of each group: the smallest doc_id.

    A group whose rows have no id keeps one of them by text hash; null, empty and wordless
    texts are one group; rows repeated with id and text leave one; whatever the names of the
    other columns, they come back unchanged; an empty table stays empty."""
    text = text_of(text_col)
    row, thash = free_names(docs, "id", "thash")
    found = simhash_near_dedup(docs, shingle, max_bits, text_col, id_col, {"thash": F.xxhash64(text)})
    group = F.coalesce(F.col("component_id"), F.col("fp"))
    best = found.groupBy(F.col("component_id").isNull().alias("none"), group.alias("g")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash")).alias("b"))
    keep = best.select(F.col("b.doc_id").alias(row), F.col("b.thash").alias(thash))
    keyed = docs.withColumns({row: F.col(f"`{id_col}`").cast("long"), thash: F.xxhash64(text)})
    return keep_rows(docs, keyed, [row, thash], keep)
