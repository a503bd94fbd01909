"""Exact dedup by a cuckoo-filter index over content digests.

The index is a table split into shards by digest.  A shard holds a cuckoo
filter (16-bit fingerprints, buckets of four, partial-key hashing) and the
stored keys in content buckets.  A digest that the filter does not know is new;
a hit is verified against the full digests of the content bucket, so a false
positive of the filter never merges two texts.  Deleting a digest's last row
removes its fingerprint and key; when an insertion finds no place, the shard's
filter is rebuilt at twice the size from its stored keys.
"""

from __future__ import annotations

import math
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, keep_rows, materialise, text_of

WHITE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
SALTS = 8
ROWS_PER_SHARD = 100_000
SLOTS = 4
MAX_KICKS = 200

STATE_SCHEMA = ("shard int, kind string, digest binary, n_rows long, neg_len long, no_id boolean, "
                "doc_id long, rid long, log2_buckets int, slots binary")


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


class CuckooFilter:
    """Approximate set of 64-bit keys with deletion; ``add`` is False when full."""

    def __init__(self, log2_buckets: int = 4, slots: bytes | None = None):
        self.log2 = log2_buckets
        self.mask = (1 << log2_buckets) - 1
        self.slots = array("H", slots or bytes(2 * SLOTS << log2_buckets))
        self.turn = 0

    @staticmethod
    def _fingerprint(key: int) -> int:
        return (key >> 48) or 1

    def places(self, key: int) -> tuple[int, int, int]:
        fp = self._fingerprint(key)
        a = key & self.mask
        return fp, a, self._other(a, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x5BD1E995)) & self.mask

    def _find(self, bucket: int, value: int) -> int:
        lo = bucket * SLOTS
        for i in range(lo, lo + SLOTS):
            if self.slots[i] == value:
                return i
        return -1

    def contains(self, key: int) -> bool:
        fp, a, b = self.places(key)
        return self._find(a, fp) >= 0 or self._find(b, fp) >= 0

    def add(self, key: int) -> bool:
        fp, a, b = self.places(key)
        for bucket in (a, b):
            i = self._find(bucket, 0)
            if i >= 0:
                self.slots[i] = fp
                return True
        bucket = b
        for _ in range(MAX_KICKS):
            self.turn = (self.turn + 1) % SLOTS
            i = bucket * SLOTS + self.turn
            fp, self.slots[i] = self.slots[i], fp
            bucket = self._other(bucket, fp)
            i = self._find(bucket, 0)
            if i >= 0:
                self.slots[i] = fp
                return True
        return False

    def remove(self, key: int) -> bool:
        fp, a, b = self.places(key)
        for bucket in (a, b):
            i = self._find(bucket, fp)
            if i >= 0:
                self.slots[i] = 0
                return True
        return False


class ShardIndex:
    """One shard: the filter plus the stored keys in content buckets."""

    def __init__(self, log2_buckets: int = 4, slots: bytes | None = None):
        self.filter = CuckooFilter(log2_buckets, slots)
        self.content: dict[int, dict[bytes, list]] = {}
        self.resizes = 0

    @staticmethod
    def key(digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little")

    def _bucket(self, key: int) -> int:
        return key & self.filter.mask

    def store(self, digest: bytes, entry: list) -> None:
        self.content.setdefault(self._bucket(self.key(digest)), {})[digest] = entry

    def find(self, digest: bytes) -> list | None:
        key = self.key(digest)
        if not self.filter.contains(key):
            return None
        return self.content.get(self._bucket(key), {}).get(digest)  # verified by the full digest

    def insert(self, digest: bytes, n_rows: int, best: tuple) -> None:
        entry = self.find(digest)
        if entry is not None:
            entry[0] += n_rows
            entry[1] = min(entry[1], best)
            return
        self.store(digest, [n_rows, best])
        if not self.filter.add(self.key(digest)):
            self._resize()

    def delete(self, digest: bytes, n_rows: int) -> None:
        entry = self.find(digest)
        if entry is None:
            return
        entry[0] -= n_rows
        if entry[0] <= 0:
            key = self.key(digest)
            self.content[self._bucket(key)].pop(digest)
            self.filter.remove(key)

    def items(self):
        return ((d, e) for bucket in self.content.values() for d, e in bucket.items())

    def _resize(self) -> None:
        stored = list(self.items())
        log2 = self.filter.log2
        while True:
            log2 += 1
            self.resizes += 1
            self.filter = CuckooFilter(log2)
            if all(self.filter.add(self.key(d)) for d, _ in stored):
                break
        self.content = {}
        for d, e in stored:
            self.store(d, e)


def _apply(table: pa.Table) -> pa.Table:
    """Apply the inserts, then the deletes, of one shard to its stored state."""
    names = [c.split()[0] for c in STATE_SCHEMA.split(", ")]
    rows = list(zip(*(table.column(n).to_pylist() for n in names)))
    by: dict[str, list] = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    shard = rows[0][0]
    index = ShardIndex()
    for r in by.get("filter", []):
        index = ShardIndex(r[8], r[9])
    for kind in ("key", "insert", "delete"):
        for _, _, digest, n, neg, no_id, doc_id, rid, _, _ in by.get(kind, []):
            best = (neg, no_id, doc_id or 0, rid)
            if kind == "delete":
                index.delete(digest, n)
            elif kind == "key":
                index.store(digest, [n, best])
            else:
                index.insert(digest, n, best)
    out = [(shard, "key", d, n, b[0], b[1], None if b[1] else b[2], b[3], None, None)
           for d, (n, b) in index.items()]
    out.append((shard, "filter", None, None, None, None, None, None, index.filter.log2,
                index.filter.slots.tobytes()))
    types = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, types[c.split()[1]]) for n, c in zip(names, STATE_SCHEMA.split(", "))])
    return pa.Table.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*out), schema)], schema=schema)


def sign(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, rid, digest, n_chars`` of every row, written once (small rows)."""
    text = text_of(text_col)
    return materialise(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
        F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"), F.length(text).cast("long").alias("n_chars")),
        "signed")


def _ops(signed: DataFrame, kind: str, n_shards: int) -> DataFrame:
    """Rows of one digest pre-aggregated into at most ``SALTS`` operations."""
    best = F.struct((-F.col("n_chars")).alias("neg_len"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    g = (signed.groupBy("digest", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).alias("salt"))
         .agg(F.count("*").alias("n_rows"), F.min(best).alias("b")))
    return g.select(F.pmod(F.xxhash64("digest"), F.lit(n_shards)).cast("int").alias("shard"), F.lit(kind).alias("kind"),
                    "digest", "n_rows", "b.neg_len", "b.no_id", "b.doc_id", "b.rid",
                    F.lit(None).cast("int").alias("log2_buckets"), F.lit(None).cast("binary").alias("slots"))


def update_index(signed: DataFrame, state: DataFrame | None = None, kind: str = "insert",
                 n_shards: int | None = None) -> DataFrame:
    """Insert (or with ``kind="delete"`` remove) signed rows; returns the new state.

    The number of shards follows the rows and is fixed for the life of a state;
    a digest of hot copies reaches its shard as at most ``SALTS`` rows.  The keeper of a
    digest is renewed by ``ContentIndex`` only, which also holds a digest's members."""
    if n_shards is None:
        n_shards = (max(1, math.ceil(signed.count() / ROWS_PER_SHARD)) if state is None
                    else (state.agg(F.max("shard")).first()[0] or 0) + 1)
    return _advance(signed.sparkSession, state, _ops(signed, kind, n_shards), n_shards)


def _advance(spark, state: DataFrame | None, ops: DataFrame, n_shards: int) -> DataFrame:
    if state is None:
        # every shard gets its filter, also one that no digest falls into
        state = spark.range(n_shards).select(
            F.col("id").cast("int").alias("shard"), F.lit("filter").alias("kind"), F.lit(None).cast("binary").alias("digest"),
            *[F.lit(None).cast(t).alias(c) for c, t in (("n_rows", "long"), ("neg_len", "long"), ("no_id", "boolean"),
                                                        ("doc_id", "long"), ("rid", "long"))],
            F.lit(4).alias("log2_buckets"), F.lit(bytes(2 * SLOTS << 4)).alias("slots"))
    return materialise(state.unionByName(ops).groupBy("shard").applyInArrow(_apply, STATE_SCHEMA), "cuckoo")


def live_keys(state: DataFrame) -> DataFrame:
    return state.where("kind = 'key'").select("digest", "n_rows", F.col("doc_id").alias("keep_id"),
                                              F.col("rid").alias("keep_rid"), (-F.col("neg_len")).alias("keep_chars"))


MEMBER = ["digest", "neg_len", "no_id", "doc_id"]


def members_of(signed: DataFrame) -> DataFrame:
    """Signed rows as counted members: ``MEMBER`` columns and ``n``."""
    return (signed.select("digest", (-F.col("n_chars")).alias("neg_len"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
            .groupBy(*MEMBER).agg(F.count("*").alias("n")))


class ContentIndex:
    """The cuckoo index with the members of every digest, so that any live row can be deleted.

    The shards know which digests are live and how many rows each has; the members (one row
    per digest, length and id, with a count) name the keeper anew when a kept row goes.  Members
    are only grouped and joined, never gathered by digest.  Deleting a row that is not
    live (another id, length or text) changes nothing."""

    def __init__(self, state: DataFrame | None = None, members: DataFrame | None = None):
        self.state, self.members = state, members

    def insert(self, signed: DataFrame) -> "ContentIndex":
        found = members_of(signed)
        if self.members is not None:
            found = self.members.unionByName(found).groupBy(*MEMBER).agg(F.sum("n").alias("n"))
        return ContentIndex(update_index(signed, self.state), materialise(found, "members"))

    def delete(self, signed: DataFrame) -> "ContentIndex":
        if self.state is None:
            return self
        gone = members_of(signed).withColumnRenamed("n", "gone")
        same = [F.col(f"m.{c}").eqNullSafe(F.col(f"g.{c}")) for c in MEMBER]
        both = self.members.alias("m").join(gone.alias("g"), same, "left").select(
            *[f"m.{c}" for c in MEMBER], "n", F.least("n", F.coalesce("gone", F.lit(0))).alias("gone"))
        both = materialise(both, "deletions")
        n_shards = (self.state.agg(F.max("shard")).first()[0] or 0) + 1
        null = {c: F.lit(None).cast(t) for c, t in (("neg_len", "long"), ("no_id", "boolean"), ("doc_id", "long"), ("rid", "long"),
                                                    ("log2_buckets", "int"), ("slots", "binary"))}
        ops = both.where("gone > 0").groupBy("digest").agg(F.sum("gone").alias("n_rows")).select(
            F.pmod(F.xxhash64("digest"), F.lit(n_shards)).cast("int").alias("shard"), F.lit("delete").alias("kind"), "digest", "n_rows",
            *[c.alias(n) for n, c in null.items()])
        left = both.select(*MEMBER, (F.col("n") - F.col("gone")).alias("n")).where("n > 0")
        return ContentIndex(_advance(signed.sparkSession, self.state, ops, n_shards), materialise(left, "members"))

    def live_keys(self) -> DataFrame:
        """``digest, n_rows, keep_id, keep_chars`` of every live digest; the keeper is the longest
        live row, then the smallest id (a null id last)."""
        best = self.members.groupBy("digest").agg(F.min(F.struct(*MEMBER[1:])).alias("b"))
        return self.state.where("kind = 'key'").select("digest", "n_rows").join(best, "digest").select(
            "digest", "n_rows", F.col("b.doc_id").alias("keep_id"), (-F.col("b.neg_len")).alias("keep_chars"))


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal normalised texts the row with the most code points stays, then the
    smallest id (a null id last), then one of repeated rows.  Null text counts
    as empty; an empty table gives no rows; other columns are ignored."""
    signed = sign(docs, text_col, id_col)
    keys = live_keys(update_index(signed))
    return signed.join(keys, "digest").select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns unchanged: of equal normalised texts the
    one that ``exact_dedup`` keeps.

    Null and empty texts are one group; rows repeated with id and text leave one; whatever
    the names of the other columns, they come back unchanged; an empty table stays empty."""
    text = text_of(text_col)
    digest, chars, row = free_names(docs, "digest", "chars", "id")
    keyed = docs.withColumns({digest: F.unhex(F.sha2(normalised(text).cast("binary"), 256)),
                              chars: F.length(text).cast("long"),
                              row: F.col(f"`{id_col}`").cast("long")})
    keys = live_keys(update_index(sign(docs, text_col, id_col)))
    keep = keys.select(F.col("digest").alias(digest), F.col("keep_id").alias(row), F.col("keep_chars").alias(chars))
    return keep_rows(docs, keyed, [digest, row, chars], keep)
