"""Line dedup by an exact set-similarity join.

A line is the set of its words (ASCII letters in lower case).  The words of every
line are ordered by rarity over the whole corpus; two lines with Jaccard
similarity of at least t share a word among the first n - ceil(t n) + 1 of each.
Every distinct line is posted once under each of those words, with its size, the word's
position and a 128-bit map of its words.  A task reads whole lists, some at a time: the length
filter, the positional filter and the map (bits that differ are words that differ)
remove nearly all pairs of a list before any text is moved; the rest is verified on
the words themselves.  A line goes if an earlier line is equal or similar to it.

Where a line meets one that its map hardly differs from, that pair alone is sent out,
so a group of near copies costs one pair a line and list, not all pairs.  A line whose pair
then fails the verification is asked again for all its pairs, so no match is missed.
Lists longer than ``LIST_ROWS`` are cut into blocks, and pairs of blocks go to different tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialise, prepare, text_of
from .words import as_strings, hashed_words, joined

SIMILARITY = (4, 5)       # 0.8 as a fraction
RARITY_SLOTS = 1 << 22    # words are counted in this many hash slots
SLOTS_A_ROW = 4096        # slots whose counts are shuffled as one row
LIST_ROWS = 4096          # lines of a word's list that one task compares at once
PART_ROWS = 50_000        # rows of lists, about, that a task holds at once
PACK_ROWS = 1024          # rows of lists shuffled as one row at most
TEXT_BUCKETS = 1 << 22    # bound of the broadcast filter on the lines whose words are verified
LINE_BATCH = 2000         # lines in one Arrow batch, if they fit its bytes
JOIN_ROWS, JOIN_BYTES = 40_000, 12 << 20


# rows without an id are numbered from here by their text's hash, after all ids
NO_ID = 1 << 62


def _unnamed(text_col: str) -> Column:
    return F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text_of(text_col)), 3)


def explode_lines(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``doc, line_no, line`` of every line; a row without an id is placed by its text."""
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), _unnamed(text_col)).alias("doc"),
                       F.posexplode(F.split(text_of(text_col), "\n")).alias("line_no", "line"))


# 128-bit key of a line, as two longs from independent seeds
KEYS = ["a", "b"]


def line_keys(line: str = "line") -> list[Column]:
    return [F.xxhash64(F.col(line)).alias("a"), F.xxhash64(F.lit(7), F.col(line)).alias("b")]


def word_sets(lines: DataFrame) -> DataFrame:
    """``doc, line, words``: the 64-bit hashes of the distinct words of every ``text``."""
    def run(batches):
        for b in joined(batches, JOIN_ROWS, JOIN_BYTES):
            hashes, _, _, offsets, _ = hashed_words(as_strings(b.column("text")), True)
            row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            key = (row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24))
            order = np.argsort(key)
            key, sorted_ = key[order], hashes[order]
            if np.any((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])):   # different words alike in 40 bits
                sorted_ = hashes[np.lexsort((hashes, row))]
            hashes = sorted_
            once = np.ones(len(hashes), bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
            ends = np.cumsum(np.bincount(row[once], minlength=b.num_rows))
            words = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(hashes[once].view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("line"), words], names=["doc", "line", "words"])

    return lines.select("doc", "line", "text").mapInArrow(run, "doc long, line int, words array<long>")


def word_counts(lines: DataFrame, slots: int) -> np.ndarray:
    """Occurrences per hash slot over all lines, as eighths of their binary logarithm: a table
    of one byte a slot that tells counts apart up to 2 ** 31."""
    def run(batches):
        total = np.zeros(slots, np.int64)
        for b in joined(batches, JOIN_ROWS, JOIN_BYTES):
            np.add.at(total, (hashed_words(as_strings(b.column("t")), True)[0] % np.uint64(slots)).astype(np.int64), 1)
        for part in range(0, slots, SLOTS_A_ROW):
            used = np.flatnonzero(total[part:part + SLOTS_A_ROW])
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part // SLOTS_A_ROW], pa.int32()), pa.array([used.astype("<u2").tobytes()], pa.binary()),
                     pa.array([total[part + used].astype("<i8").tobytes()], pa.binary())], names=["part", "s", "n"])

    def added(batches):
        total = {}
        for b in batches:
            for part, at, n in zip(*(b.column(c).to_pylist() for c in ("part", "s", "n"))):
                total.setdefault(part, np.zeros(SLOTS_A_ROW, np.int64))[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<i8")
        for part, n in total.items():
            used = np.flatnonzero(n)
            scaled = np.minimum(np.floor(np.log2(n[used]) * 8), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([used.astype("<u2").tobytes()], pa.binary()), pa.array([scaled.tobytes()], pa.binary())],
                names=["part", "s", "n"])

    schema = "part int, s binary, n binary"
    packed = lines.mapInArrow(run, schema).repartition("part").mapInArrow(added, schema)
    out = np.zeros(slots, np.uint8)
    for r in packed.toLocalIterator():
        out[r["part"] * SLOTS_A_ROW + np.frombuffer(r["s"], "<u2").astype(np.int64)] = np.frombuffer(r["n"], np.uint8)
    return out


LINE_SCHEMA = "a long, b long, doc long, line int, n int, toks array<int>, often int, bits0 long, bits1 long, more boolean"


def posted_lines(lines: DataFrame, counts: np.ndarray, similarity=SIMILARITY, list_rows: int = LIST_ROWS) -> DataFrame:
    """``LINE_SCHEMA``: key, place, size, rare words (hashes of 32 bits) and map of every line with a
    word; ``more``: it is repeated; from the word ``often`` on, the slots count so much that lists may be longer than ``list_rows``.

    Words are ordered by (count, hash): any order shared by all lines keeps the
    join exact.  A word whose slot counts one is in no other line and is not
    posted.  Of a line repeated inside a batch, the earliest is kept."""
    num, den = similarity
    shared = lines.sparkSession.sparkContext.broadcast(counts)
    many = min(math.floor(math.log2(max(list_rows, 1)) * 8), 255)

    def run(batches):
        table = shared.value
        for b in joined(batches, JOIN_ROWS, JOIN_BYTES):
            ka, kb = b.column("a").to_numpy(), b.column("b").to_numpy()
            order = np.lexsort((b.column("line_no").to_numpy(), b.column("doc").to_numpy(), kb, ka))
            ka, kb = ka[order], kb[order]
            once = np.concatenate([[True], (ka[1:] != ka[:-1]) | (kb[1:] != kb[:-1])])
            more = pa.array(np.diff(np.append(np.flatnonzero(once), len(order))) > 1)
            b = b.take(pa.array(order[once]))
            hashes, _, _, offsets, _ = hashed_words(as_strings(b.column("line")), True)
            if not len(hashes):
                continue
            rank = table[(hashes % np.uint64(len(table))).astype(np.int64)]
            line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            key = (line.astype(np.uint64) << np.uint64(40)) | (rank.astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32))
            order = np.argsort(key)         # per line, its words by rarity
            key, sorted_ = key[order], hashes[order]
            if np.any((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])):   # different words alike in 32 bits
                order = np.lexsort((hashes, rank, line))
                sorted_ = hashes[order]
            line = line[order]
            once = np.concatenate([[True], (sorted_[1:] != sorted_[:-1]) | (line[1:] != line[:-1])])
            hashes, rank, line = sorted_[once], rank[order][once], line[once]
            first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
            size = np.diff(np.append(first, len(line)))
            bit = hashes >> np.uint64(57)
            one = np.uint64(1) << (bit & np.uint64(63))
            maps = [np.bitwise_or.reduceat(np.where((bit >> np.uint64(6)) == half, one, np.uint64(0)), first) for half in (0, 1)]
            n = np.repeat(size, size)
            pos = np.arange(len(line)) - np.repeat(first, size)
            take = (pos < n - -(-num * n // den) + 1) & (rank > 0)
            lists = np.concatenate([[0], np.cumsum(np.add.reduceat(take.astype(np.int64), first))])
            often = np.add.reduceat((take & (rank < many)).astype(np.int32), first)
            rows = pa.array(line[first])
            toks = (hashes[take] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(rows) for c in ("a", "b", "doc", "line_no")], pa.array(size.astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(toks)),
                 pa.array(often.astype(np.int32)), *[pa.array(m.view(np.int64)) for m in maps], more.take(rows)],
                names=["a", "b", "doc", "line", "n", "toks", "often", "bits0", "bits1", "more"])

    return lines.select("doc", "line_no", *KEYS, "line").mapInArrow(run, LINE_SCHEMA)


AT = ["doc", "line"]
PAIR_SCHEMA = "doc long, line int, odoc long, oline int, alone boolean"


def _pairs_of(rows: dict, similarity, every: bool) -> pa.RecordBatch | None:
    """Candidate pairs (later, earlier) of whole lists, sorted by list and ``n``."""
    num, den = similarity
    n, doc, line, ask, side = (rows.get(c) for c in ("n", "doc", "line", "ask", "side"))
    rest = n - rows["pos"]
    bits0, bits1 = (rows[c].view(np.uint64) for c in ("bits0", "bits1"))
    empty = 1 - (np.bitwise_count(bits0).astype(np.int64) + np.bitwise_count(bits1)) / 128  # share of unset bits
    ends = np.append(np.flatnonzero(rows["list"][1:] != rows["list"][:-1]) + 1, len(n))
    left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(n))  # members from here on
    lo, hi, far = [], [], []
    at = np.arange(len(n))
    for k in range(1, int(left.max())):
        at = at[left[at] > k]
        at = at[n[at + k] * num <= n[at] * den]     # those after them are longer still
        if not len(at):
            break
        x, y = at, at + k
        ok = np.minimum(rest[x], rest[y]) * (num + den) >= (n[x] + n[y]) * num
        if ask is not None:
            ok &= ask[x] | ask[y]
        if side is not None:
            ok &= (side[x] < 0) | (side[x] != side[y])
        x, y = x[ok], y[ok]
        d = np.bitwise_count(bits0[x] ^ bits0[y]).astype(np.int64) + np.bitwise_count(bits1[x] ^ bits1[y])
        ok = d * (num + den) <= (n[x] + n[y]) * (den - num)
        lo.append(x[ok])
        hi.append(y[ok])
        far.append(d[ok])
    if not lo:
        return None
    lo, hi, far = np.concatenate(lo), np.concatenate(hi), np.concatenate(far)
    turn = (doc[lo] > doc[hi]) | ((doc[lo] == doc[hi]) & (line[lo] > line[hi]))
    lo, hi = np.where(turn, hi, lo), np.where(turn, lo, hi)
    ok = (doc[lo] != doc[hi]) | (line[lo] != line[hi])     # a line is there twice if two of its words are alike in 32 bits
    if ask is not None:
        ok &= ask[hi]
    lo, hi, far = lo[ok], hi[ok], far[ok]
    alone = np.zeros(len(lo), bool)
    if not every and len(lo):   # of a line's near candidates in a list, the earliest alone
        # a word that differs shows about as often as a bit of the map is unset
        guess = (far + 1) / np.maximum(np.minimum(empty[lo], empty[hi]), 0.01)
        near = guess * (num + den) <= (n[lo] + n[hi]) * (den - num)
        order = np.lexsort((line[lo], doc[lo], ~near, hi))
        lo, hi, near = lo[order], hi[order], near[order]
        top = np.concatenate([[True], hi[1:] != hi[:-1]])
        settled = np.repeat(near[top], np.diff(np.append(np.flatnonzero(top), len(hi))))
        keep = ~settled | top
        lo, hi, alone = lo[keep], hi[keep], settled[keep]
    if not len(lo):
        return None
    return pa.RecordBatch.from_arrays([pa.array(doc[hi]), pa.array(line[hi]), pa.array(doc[lo]), pa.array(line[lo]), pa.array(alone)],
                                      names=["doc", "line", "odoc", "oline", "alone"])


def _list_type(cut: bool, ask: bool) -> np.dtype:
    """A row of a list; ``side``: its block, or -1 where all pairs of the list are wanted."""
    return np.dtype([("list", "<u8" if cut else "<u4"), ("doc", "<i8"), ("line", "<i4"), ("n", "<i4"), ("pos", "<i4"),
                     ("bits0", "<u8"), ("bits1", "<u8"), *([("side", "<i4")] if cut else []), *([("ask", "?")] if ask else [])])


def _mixed(*numbers: np.ndarray) -> np.ndarray:
    out = np.uint64(0)
    for x in numbers:
        out = (out ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def _in_blocks(rows: np.ndarray, toks: np.ndarray, blocks: np.ndarray):
    """``rows`` in steps, those of the long lists ``toks`` once for every pair of ``blocks`` they are in.

    Lists that share a hash are compared as one, which loses no pair."""
    at = np.minimum(np.searchsorted(toks, rows["list"]), len(toks) - 1)
    times = np.where(toks[at] == rows["list"], blocks[at], 1)
    total = np.cumsum(times)
    steps = np.searchsorted(total, np.arange(0, total[-1], PART_ROWS))
    edges = np.unique(np.append(steps, len(rows))).tolist()
    for lo, hi in zip(edges, edges[1:]):
        n = times[lo:hi]
        part = rows[lo:hi].repeat(n)
        x = np.arange(len(part)) - np.repeat(np.cumsum(n) - n, n)
        n = np.repeat(n, n)
        blk = (_mixed(part["doc"], part["line"]) % n.astype(np.uint64)).astype(np.int64)
        part["side"] = np.where(blk == x, -1, blk)
        mixed = _mixed(part["list"], np.minimum(blk, x), np.maximum(blk, x)) | np.uint64(1 << 63)
        part["list"] = np.where(n > 1, mixed, part["list"])
        yield part


def list_pairs(lines: DataFrame, similarity=SIMILARITY, every: bool = False, list_rows: int = LIST_ROWS,
               part_rows: int = PART_ROWS) -> DataFrame:
    """``PAIR_SCHEMA``: candidates of every line (of those that ``ask``, where that column is) from the lists of
    ``lines`` (``doc, line, n, toks, often, bits0, bits1``, and ``pos``: the position of the first of ``toks``).
    ``alone``: other candidates of its list were left out.

    The rows of a list are dealt to parts of about ``part_rows`` by the list's hash and move packed; a task takes one
    part after the other.  Of lists longer than ``list_rows``, pairs of blocks are dealt as lists of their own."""
    words = lines.select("often", "pos", F.posexplode("toks").alias("k", "tok")).where("pos + k >= often")
    hot = words.groupBy("tok").count().where(F.col("count") > list_rows).toLocalIterator()
    hot = np.array(sorted((r["tok"] % (1 << 32), -(-r["count"] // list_rows), r["count"]) for r in hot), np.int64).reshape(-1, 3)
    total = (lines.agg(F.sum(F.size("toks"))).first()[0] or 0) + int((hot[:, 2] * (hot[:, 1] - 1)).sum())
    parts = max(1, -(-total // part_rows))
    names = [*AT, "n", "pos", "bits0", "bits1", *[c for c in ("ask",) if c in lines.columns]]
    kind = _list_type(len(hot) > 0, "ask" in names)
    shared = lines.sparkSession.sparkContext.broadcast((hot[:, 0].astype(np.uint64), hot[:, 1]))

    def deal(batches):
        toks, blocks = shared.value
        for b in joined(batches, JOIN_ROWS, JOIN_BYTES // 4):
            ends = b.column("toks").offsets.to_numpy().astype(np.int64)
            size = np.diff(ends)
            row = np.repeat(np.arange(b.num_rows), size)
            rows = np.empty(len(row), kind)
            rows["list"] = b.column("toks").values.to_numpy()[ends[0]:ends[-1]].view(np.uint32)
            for c in names:
                rows[c] = b.column(c).to_numpy(zero_copy_only=False)[row]
            rows["pos"] += (np.arange(len(row)) - np.repeat(ends[:-1] - ends[0], size)).astype(np.int32)
            for rows in (_in_blocks(rows, toks, blocks) if len(toks) and len(rows) else [rows]):
                part = (_mixed(rows["list"]) % np.uint64(parts)).astype(np.min_scalar_type(parts))
                order = np.argsort(part, kind="stable")
                rows, part = rows[order], part[order]
                cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(rows)]
                cuts = [k for lo, hi in zip(cuts, cuts[1:]) for k in range(lo, hi, PACK_ROWS)]
                packed = [rows[lo:hi].tobytes() for lo, hi in zip(cuts, [*cuts[1:], len(rows)])]
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts].astype(np.int32)), pa.array(packed, pa.binary())], names=["part", "rows"])

    def pairs(packed):
        rows = np.concatenate(packed)
        if "side" in kind.names:
            order = np.lexsort((rows["n"], rows["list"]))
        else:
            order = np.argsort((rows["list"].astype(np.uint64) << np.uint64(32)) | rows["n"].astype(np.uint64))
        return _pairs_of({c: rows[c][order] for c in kind.names}, similarity, every)

    def run(batches):
        held, at = [], None
        for b in batches:
            for part, rows in zip(b.column("part").to_pylist(), b.column("rows")):
                if part != at and held:
                    found, held = pairs(held), []
                    if found is not None:
                        yield found
                at = part
                held.append(np.frombuffer(rows.as_buffer(), kind))
        if held:
            found = pairs(held)
            if found is not None:
                yield found

    dealt = lines.select(*names, "toks").mapInArrow(deal, "part int, rows binary")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(run, PAIR_SCHEMA)


def _verified(pairs: DataFrame, lines: DataFrame, similarity) -> DataFrame:
    """``doc, line`` of the later lines of pairs whose word sets (as 64-bit hashes of the words)
    reach the similarity.

    The texts of the lines named by pairs are filtered by a broadcast set of at most
    ``TEXT_BUCKETS`` hashes before they are shuffled."""
    num, den = similarity
    bucket = F.pmod(F.xxhash64("doc", "line"), F.lit(TEXT_BUCKETS)).cast("int")
    named = pairs.select(*AT).union(pairs.select("odoc", "oline")).distinct()
    wanted = F.broadcast(named.select(bucket.alias("bucket")).distinct())
    texts = lines.select("doc", F.col("line_no").alias("line"), F.col("line").alias("text")).withColumn("bucket", bucket)
    sets = word_sets(texts.join(wanted, "bucket", "left_semi").join(named, AT, "left_semi").dropDuplicates(AT))
    sets = materialise(sets, "word_sets")
    both = F.size(F.array_intersect("wa", "wb"))
    return (pairs.select(*AT, "odoc", "oline").distinct().join(sets.withColumnRenamed("words", "wa"), AT)
            .join(sets.select(F.col("doc").alias("odoc"), F.col("line").alias("oline"), F.col("words").alias("wb")), ["odoc", "oline"])
            .where(both * den >= (F.size("wa") + F.size("wb") - both) * num).select(*AT).distinct())


def distinct_lines(docs: DataFrame, similarity=SIMILARITY, text_col: str = "text", id_col: str = "doc_id",
                   rarity_slots: int = RARITY_SLOTS, list_rows: int = LIST_ROWS) -> DataFrame:
    """``LINE_SCHEMA`` of the first occurrence of every distinct line with a word."""
    prepare(docs.sparkSession, rows=LINE_BATCH)
    counts = word_counts(docs.select(text_of(text_col).alias("t")), rarity_slots)
    lines = explode_lines(docs, text_col, id_col).select("*", *line_keys())
    first = F.min(F.struct(*AT, "n", "toks", "often", "bits0", "bits1")).alias("f")
    return materialise(posted_lines(lines, counts, similarity, list_rows).repartition(*KEYS).groupBy(*KEYS)
                       .agg(first, (F.max("more") | (F.count("*") > 1)).alias("more")).select(*KEYS, "f.*", "more"), "distinct_lines")


def _asked_again(posted: DataFrame, asked: DataFrame, similarity) -> DataFrame:
    """The rows of ``posted`` that pass the filters with a later line of ``asked`` in a list, and ``asked`` itself.

    A broadcast set of at most ``TEXT_BUCKETS`` hashes, of words with the sizes that lines similar
    to those of ``asked`` can have, comes before any row is shuffled."""
    num, den = similarity
    size = F.floor(F.log(F.col("n")) / math.log(1.05 * den / num))     # of similar lines, differs by one at most
    bucket = F.pmod(F.xxhash64("tok", "size"), F.lit(TEXT_BUCKETS)).cast("int").alias("bucket")
    sizes = F.explode(F.array(size - 1, size, size + 1)).alias("size")
    wanted = F.broadcast(asked.select("tok", sizes).select(bucket).distinct())
    near = posted.withColumn("size", size).withColumn("bucket", bucket).join(wanted, "bucket", "left_semi").drop("size", "bucket")
    x, y = (lambda c: F.col(f"x.{c}").cast("long")), (lambda c: F.col(f"y.{c}").cast("long"))
    differ = F.bit_count(x("bits0").bitwiseXOR(y("bits0"))) + F.bit_count(x("bits1").bitwiseXOR(y("bits1")))
    same = (x("doc") == y("doc")) & (x("line") == y("line"))
    earlier = (x("doc") < y("doc")) | ((x("doc") == y("doc")) & (x("line") < y("line")))
    alike = ((x("n") * num <= y("n") * den) & (y("n") * num <= x("n") * den)
             & (F.least(x("n") - x("pos"), y("n") - y("pos")) * (num + den) >= (x("n") + y("n")) * num)
             & (differ * (num + den) <= (x("n") + y("n")) * (den - num)))
    return near.alias("x").join(asked.alias("y"), (F.col("x.tok") == F.col("y.tok")) & (same | (earlier & alike)), "left_semi")


def similar_lines(firsts: DataFrame, docs: DataFrame, similarity=SIMILARITY, text_col: str = "text", id_col: str = "doc_id",
                  list_rows: int = LIST_ROWS) -> DataFrame:
    """``doc, line`` of the distinct lines that an earlier, different line is similar to."""
    lines = explode_lines(docs, text_col, id_col)
    posted = firsts.select(*AT, "n", "often", "bits0", "bits1", F.posexplode("toks").alias("pos", "tok"))
    whole = firsts.withColumn("pos", F.lit(0))
    pairs = materialise(list_pairs(whole, similarity, list_rows=list_rows), "line_pairs")
    settled = materialise(_verified(pairs, lines, similarity), "settled_lines")
    failed = materialise(pairs.where("alone").select(*AT).distinct().join(settled, AT, "left_anti"), "failed_lines")
    if failed.isEmpty():
        return settled
    again = _asked_again(posted, materialise(posted.join(failed, AT, "left_semi"), "failed_words"), similarity)
    again = again.join(failed.withColumn("ask", F.lit(True)), AT, "left").withColumn("ask", F.coalesce("ask", F.lit(False)))
    again = materialise(again.withColumn("toks", F.array("tok")).drop("tok"), "lines_again")
    more = materialise(list_pairs(again, similarity, every=True, list_rows=list_rows), "line_pairs")
    return settled.union(_verified(more, lines, similarity)).distinct()


def _removed(docs: DataFrame, similarity, text_col: str, id_col: str, rarity_slots: int, list_rows: int = LIST_ROWS) -> DataFrame:
    firsts = distinct_lines(docs, similarity, text_col, id_col, rarity_slots, list_rows)
    later = similar_lines(firsts, docs, similarity, text_col, id_col, list_rows).withColumn("similar", F.lit(True))
    known = firsts.select(*AT, *KEYS, "more").join(later, AT, "left").where("more or similar").select(
        *KEYS, F.struct(*AT).alias("first"), F.coalesce("similar", F.lit(False)).alias("similar"))
    keyed = explode_lines(docs, text_col, id_col).select("doc", "line_no", *line_keys())
    judged = keyed.join(known, KEYS, "left")    # a line without words, or that is neither repeated nor similar, is not known and stays
    gone = F.coalesce(F.col("similar") | (F.col("first") < F.struct("doc", F.col("line_no").alias("line"))), F.lit(False))
    return judged.groupBy("doc").agg(
        F.count("*").alias("n_lines"), F.sort_array(F.collect_list(F.when(gone, F.col("line_no")))).alias("removed"))


def removed_lines(docs: DataFrame, similarity=SIMILARITY, text_col: str = "text", id_col: str = "doc_id",
                  rarity_slots: int = RARITY_SLOTS) -> DataFrame:
    """``doc_id, n_lines, removed`` (line numbers in order) for every document.

    Ids are below 2**62 and name one text; rows without an id come last, one result
    each, placed by their text.  Order is doc_id, then line number.  A line goes if an earlier line
    is the same, or has Jaccard similarity of at least ``similarity`` with it,
    whether or not that earlier line stays.  Lines without words stay.  Null text
    counts as empty (one empty line); repeated rows count as one document whose
    lines occur repeatedly; an empty table gives no rows; other columns are
    ignored."""
    return _removed(docs, similarity, text_col, id_col, rarity_slots).select(F.when(F.col("doc") < NO_ID, F.col("doc")).alias("doc_id"), "n_lines", "removed")


def dedup_lines(docs: DataFrame, similarity=SIMILARITY, text_col: str = "text", id_col: str = "doc_id",
                rarity_slots: int = RARITY_SLOTS) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text_col``; no row goes.

    Null text stays null; rows without an id are told apart by their text; repeated rows lose
    the same lines; whatever the names of the other columns, they come back unchanged; an
    empty table gives no rows."""
    place = F.coalesce(F.col(f"`{id_col}`").cast("long"), _unnamed(text_col))
    at, lines = free_names(docs, "doc", "removed")
    gone = _removed(docs, similarity, text_col, id_col, rarity_slots).where(F.size("removed") > 0).select(
        F.col("doc").alias(at), F.col("removed").alias(lines))
    found = docs.join(gone, place == F.col(at), "left")
    kept = F.expr(f"array_join(filter(split(`{text_col}`, '\\n'), (x, i) -> not array_contains(`{lines}`, i)), '\\n')")
    return found.select(*[(F.when(F.col(lines).isNotNull(), kept).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col
                           else F.col(f"`{c}`")) for c in docs.columns])
