"""Prefix trie of conversations from padded turn-id matrices.

A conversation is the sequence of its turns' digests (16 bytes over role and
text).  Sequences are range-sorted by their bytes, so every node of the trie (a
distinct sequence of first turns) is a run of consecutive rows.  A task takes its
rows in blocks of bounded size: turn digests become integers in a matrix padded
with zero, numpy's ``lexsort`` orders the rows, column change masks accumulated
with OR from left to right mark where the nodes of every depth start, and
``reduceat`` over those starts aggregates every depth.

Nodes that hold a block's first or last row may go on in the next block or range.
They stay open: each block leaves the path of its first and of its last row, two
neighbours' paths are merged (equal nodes add up, nodes that can grow no more are
closed from the deepest up), first within the task and then, from the few open
nodes that each range leaves, in one small pass over the ranges.

A conversation is held whole, with 24 bytes a turn; no group of conversations is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, discard, materialise, prepare, scratch_path

DIGEST = 16
BLOCK_CELLS = 1 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
ROOT_KEY = bytes(DIGEST)

SEQ_SCHEMA = "conv_id long, turns binary, sizes binary"
PART_SCHEMA = ("kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
               "saved_tokens long, ends_sha256 string, node_key binary, parent_key binary, "
               "part long, side int, chunk int, shared long, size long, ends binary")
_FIELDS = [c.split() for c in PART_SCHEMA.split(", ")]
_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t])
                    for n, t in _FIELDS])
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_rows(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``conv_id, turn, digest, size`` of every row; null role or text counts as empty."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (convs.where(F.col(f"`{conv_col}`").isNotNull())
            .select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                    F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.octet_length(text).cast("long").alias("size")))


def sequences(convs: DataFrame, base: Column | None = None, head: Column | None = None, **columns) -> DataFrame:
    """``conv_id, turns, sizes``: each conversation's turn digests and text sizes in order.

    With ``base`` and ``head`` (expressions of ``conv_id``), a conversation's first
    ``head`` turns are those of conversation ``base`` (fewer if that has fewer), which
    must be its own base; its own turns after its first ``head`` follow."""
    prepare(convs.sparkSession)
    rows = turn_rows(convs, **columns).withColumns({
        "base": (F.col("conv_id") if base is None else base).cast("long"),
        "head": (F.lit(0) if head is None else head).cast("long")})
    order = [F.col("base"), (F.col("conv_id") != F.col("base")), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"),
             F.col("size")]
    src = rows.repartition("base").sortWithinPartitions(*order).select("conv_id", "base", "head", "digest", "size")

    def run(batches):
        out, held = [], 0
        conv = group = None
        head_turns = head_sizes = b""  # of the group's base conversation
        limit, turns, sizes = 0, [], []

        def finish():
            nonlocal head_turns, head_sizes
            own_t, own_s = b"".join(turns), b"".join(sizes)
            if conv == group:
                head_turns, head_sizes = own_t, own_s
            out.append((conv, head_turns[:DIGEST * limit] + own_t[DIGEST * limit:], head_sizes[:8 * limit] + own_s[8 * limit:]))
            return len(own_t) * 2 + DIGEST * limit

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, bases, heads = (b.column(i).to_numpy() for i in range(3))
            digests = b"".join(b.column(3).to_pylist())
            size = b.column(4).to_numpy().astype("<i8").tobytes()
            cuts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [n]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if ids[lo] != conv:
                    if conv is not None:
                        held += finish()
                    conv, turns, sizes = int(ids[lo]), [], []
                    if bases[lo] != group:
                        group, head_turns, head_sizes = int(bases[lo]), b"", b""
                    limit = int(heads[lo])
                turns.append(digests[DIGEST * lo:DIGEST * hi])
                sizes.append(size[8 * lo:8 * hi])
            if held > BATCH_BYTES:
                yield _sequence_batch(out)
                out, held = [], 0
        if conv is not None:
            finish()
        if out:
            yield _sequence_batch(out)

    return src.mapInArrow(run, SEQ_SCHEMA)


def _sequence_batch(rows):
    ids, turns, sizes = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(turns, pa.binary()), pa.array(sizes, pa.binary())],
                                      names=["conv_id", "turns", "sizes"])


class Node:
    """A node that may still grow; sums hold its closed children only."""

    __slots__ = ("key", "depth", "size", "n", "conv", "children", "leaves", "saved", "ends")

    def __init__(self, key, depth, size, n, conv, children, leaves, saved, ends):
        self.key, self.depth, self.size, self.n, self.conv = key, depth, size, n, conv
        self.children, self.leaves, self.saved, self.ends = children, leaves, saved, ends

    def absorb(self, other: "Node") -> None:
        self.n += other.n
        self.conv = min(self.conv, other.conv)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends += other.ends

    def close(self, parent: "Node | None") -> tuple:
        """The finished node as a row; its sums go to the parent."""
        leaves = self.leaves if self.children else 1
        saved = self.saved + (self.n - 1) * self.size
        if parent is not None:
            parent.children += 1
            parent.leaves += leaves
            parent.saved += saved
        sha = hashlib.sha256()
        for i, ids in enumerate(self.ends):
            sha.update(b"," + ids if i else ids)
        return ("spine", self.conv, self.depth, None, self.n, self.children, leaves, saved, sha.hexdigest(), self.key,
                parent.key if parent is not None else None, None, None, None, None, None, None)


class Paths:
    """Open nodes of consecutive rows: the first row's path and the last row's path.

    Nodes that hold both rows are the same objects in both lists."""

    __slots__ = ("first", "last")

    def __init__(self, first: list, last: list):
        self.first, self.last = first, last

    def shared(self) -> int:
        """Depth of the deepest node that holds all the rows."""
        d = 0
        while d + 1 < min(len(self.first), len(self.last)) and self.first[d + 1] is self.last[d + 1]:
            d += 1
        return d

    def merge(self, right: "Paths", emit) -> "Paths":
        """Join with the paths of the rows that follow."""
        a, b = self.last, right.first
        mine, theirs = self.shared(), right.shared()
        same = 0
        while same + 1 < min(len(a), len(b)) and a[same + 1].key == b[same + 1].key:
            same += 1
        for d in range(same + 1):
            a[d].absorb(b[d])
        for d in range(len(b) - 1, max(same, theirs), -1):
            emit(b[d].close(b[d - 1] if d - 1 > same else a[same]))
        for d in range(len(a) - 1, max(same, mine), -1):
            emit(a[d].close(a[d - 1]))
        joint = min(same, theirs)
        for d in range(same, max(joint, mine), -1):
            emit(a[d].close(a[d - 1]))
        return Paths(self.first, a[:joint + 1] + right.last[joint + 1:])

    def close(self, emit) -> None:
        top = self.shared()
        for path in (self.last, self.first):
            for d in range(len(path) - 1, top, -1):
                emit(path[d].close(path[d - 1]))
        for d in range(top, -1, -1):
            emit(self.first[d].close(self.first[d - 1] if d else None))


def _keys(turns: bytes) -> list[bytes]:
    """Keys of the nodes on a sequence's path, from the root on."""
    out = [ROOT_KEY]
    for i in range(0, len(turns), DIGEST):
        out.append(hashlib.md5(out[-1] + turns[i:i + DIGEST]).digest())
    return out


def _joined(ids) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def block_nodes(convs: np.ndarray, turns: list[bytes], sizes: list[bytes]):
    """``(batches, paths)`` of a block of rows: finished nodes, and the open ones."""
    n = len(convs)
    lens = np.array([len(t) // DIGEST for t in turns], np.int64)
    width = int(lens.max())
    flat = np.frombuffer(b"".join(turns), f"S{DIGEST}")
    ids = np.unique(flat, return_inverse=True)[1] + 1 if len(flat) else np.zeros(0, np.int64)
    at = np.repeat(np.arange(n), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    matrix = np.zeros((n, width), np.int32)
    matrix[at] = ids
    size = np.zeros((n, width), np.int64)
    size[at] = np.frombuffer(b"".join(sizes), "<i8")
    order = np.lexsort((convs, *matrix.T[::-1]))
    matrix, size, lens, convs = matrix[order], size[order], lens[order], convs[order]
    change = np.ones((n, width), bool)
    change[1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)

    first_keys, last_keys = _keys(turns[order[0]]), _keys(turns[order[-1]])
    first, last = [None] * (int(lens[0]) + 1), [None] * (int(lens[-1]) + 1)
    leaf_at, saved_at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    inner = np.zeros(n, bool)        # starts of the valid nodes one level deeper
    below = {}                       # sums of open nodes one level deeper, by their start row
    batches = []
    for d in range(width, -1, -1):
        starts = np.flatnonzero(change[:, d - 1]) if d else np.zeros(1, np.int64)
        ends = np.append(starts[1:], n)
        valid = lens[starts] >= d
        counts = ends - starts
        low = np.minimum.reduceat(convs, starts)
        children = np.add.reduceat(inner.astype(np.int64), starts)
        leaves = np.add.reduceat(leaf_at, starts)
        saved = np.add.reduceat(saved_at, starts)
        exact = np.add.reduceat((lens == d).astype(np.int64), starts)  # first in their group
        open_ = valid & ((starts == 0) | (ends == n))
        done = np.flatnonzero(valid & ~open_)
        deeper, below = below, {}
        for g in np.flatnonzero(open_):
            s, e = int(starts[g]), int(ends[g])
            kids = [v for k, v in deeper.items() if s <= k < e]
            below[s] = (int(leaves[g]), int(saved[g]))
            node = Node(first_keys[d] if s == 0 else last_keys[d], d, int(size[s, d - 1]) if d else 0, e - s, int(low[g]),
                        int(children[g]) - len(kids), int(leaves[g]) - sum(k[0] for k in kids),
                        int(saved[g]) - sum(k[1] for k in kids), [_joined(convs[s:s + exact[g]])] if exact[g] else [])
            if s == 0:
                first[d] = node
            if e == n:
                last[d] = node
        if len(done):
            own = saved[done] + (counts[done] - 1) * size[starts[done], d - 1]
            is_leaf = children[done] == 0
            n_leaves = np.where(is_leaf, 1, leaves[done])
            saved_at[starts[done]] += (counts[done] - 1) * size[starts[done], d - 1]
            leaf_at[starts[done]] += is_leaf
            above = np.flatnonzero(change[:, d - 2]) if d > 1 else np.zeros(1, np.int64)
            up = np.searchsorted(above, starts[done], side="right") - 1
            up_end = np.append(above[1:], n)[up]
            up_open = (above[up] == 0) | (up_end == n)
            up_conv = np.minimum.reduceat(convs, above)[up]
            sha = [hashlib.sha256(_joined(convs[s:s + k])).hexdigest() if k else EMPTY_SHA
                   for s, k in zip(starts[done].tolist(), exact[done].tolist())]
            keys = [None if not o else first_keys[d - 1] if a == 0 else last_keys[d - 1]
                    for o, a in zip(up_open.tolist(), above[up].tolist())]
            m = len(done)
            batches.append(_batch({
                "kind": pa.array(["node"] * m), "conv_id": pa.array(low[done], pa.int64()), "depth": pa.array(np.full(m, d, np.int64)),
                "parent_conv_id": pa.array(up_conv, pa.int64(), mask=up_open), "n_convs": pa.array(counts[done], pa.int64()),
                "n_children": pa.array(children[done], pa.int64()), "n_leaves": pa.array(n_leaves, pa.int64()),
                "saved_tokens": pa.array(own, pa.int64()), "ends_sha256": pa.array(sha), "parent_key": pa.array(keys, pa.binary())}, m))
        inner = np.zeros(n, bool)
        inner[starts[valid]] = True
    return batches, Paths(first, last)


def _batch(columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _rows_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _open_rows(paths: Paths, part: int):
    """Rows that carry a range's open nodes to the pass over all ranges."""
    shared = paths.shared()
    for side, path, lo in ((0, paths.first, 0), (1, paths.last, shared + 1)):
        for node in path[lo:]:
            for chunk, ids in enumerate(node.ends or [None]):
                yield ("open", node.conv, node.depth, None, node.n, node.children, node.leaves, node.saved, None, node.key, None,
                       part, side, chunk, shared, node.size, ids)


def _read_open(rows: list[dict]) -> Paths:
    sides: tuple[list, list] = ([], [])
    for r in rows:
        path = sides[r["side"]]
        ends = [] if r["ends"] is None else [r["ends"]]
        if r["chunk"]:
            path[-1].ends += ends
        else:
            path.append(Node(r["node_key"], r["depth"], r["size"], r["n_convs"], r["conv_id"], r["n_children"], r["n_leaves"],
                             r["saved_tokens"], ends))
    return Paths(sides[0], sides[0][:rows[0]["shared"] + 1] + sides[1])


def _shard(block_cells: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        paths, rows = None, []
        convs, turns, sizes, widest, held = [], [], [], 0, 0

        def flush():
            nonlocal paths
            done, found = block_nodes(np.array(convs, np.int64), turns, sizes)
            paths = found if paths is None else paths.merge(found, rows.append)
            return done

        for b in batches:
            for conv, turn, size in zip(*(b.column(i).to_pylist() for i in range(3))):
                wide = max(widest, len(turn) // DIGEST + 1)
                if convs and wide * (len(convs) + 1) > block_cells:
                    yield from flush()
                    convs, turns, sizes, wide = [], [], [], len(turn) // DIGEST + 1
                widest = wide
                convs.append(conv)
                turns.append(turn)
                sizes.append(size)
            if rows:
                yield _rows_batch(rows)
                rows.clear()
        if convs:
            yield from flush()
        if paths is not None:
            rows.extend(_open_rows(paths, part))
        for lo in range(0, len(rows), 1000):
            yield _rows_batch(rows[lo:lo + 1000])

    return run


def _across_ranges(batches):
    """Merge the open nodes of all ranges, in their order; only one range's at a time are held."""
    paths, rows, held, part = None, [], [], None

    def take():
        nonlocal paths
        found = _read_open(held)
        paths = found if paths is None else paths.merge(found, rows.append)

    for b in batches:
        for r in b.to_pylist():
            if r["part"] != part:
                if held:
                    take()
                held, part = [], r["part"]
            held.append(r)
        if rows:
            yield _rows_batch(rows)
            rows.clear()
    if held:
        take()
    if paths is not None:
        paths.close(rows.append)
    for lo in range(0, len(rows), 1000):
        yield _rows_batch(rows[lo:lo + 1000])


def prefix_trie(convs: DataFrame, base: Column | None = None, head: Column | None = None, block_cells: int = BLOCK_CELLS,
                **columns) -> DataFrame:
    """One row per node of the trie over all conversations: ``conv_id`` (its smallest
    member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` (over
    the subtree: a node's members but one, times the bytes of its last text) and
    ``ends_sha256`` (of the comma-joined ids of the conversations that end there).

    ``base`` and ``head`` graft other conversations' first turns (see ``sequences``); the
    keywords ``conv_col, turn_col, role_col, text_col`` name the columns, others are
    ignored.  Turns are ordered by number, null first, equal numbers by their digest;
    repeated rows are turns of their own.  Null role or text counts as empty; rows of no
    conversation (null id) are left out; a conversation without turns ends at the root;
    an empty table has no node, not even a root."""
    spark = convs.sparkSession
    seqs = materialise(sequences(convs, base, head, **columns), "sequences")
    parts = (seqs.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
             .select("conv_id", "turns", "sizes").mapInArrow(_shard(block_cells), PART_SCHEMA))
    path = scratch_path(spark, "trie")
    parts.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    discard(seqs)
    schema = ", ".join(f"{n} {t}" for n, t in _FIELDS[1:]) + ", kind string"
    table = spark.read.schema(schema).parquet(path)
    left = (table.where("kind = 'open'").select(*[n for n, _ in _FIELDS]).repartition(1)
            .sortWithinPartitions("part", "side", "depth", "chunk"))
    top = materialise(left.mapInArrow(_across_ranges, PART_SCHEMA), "trie_top")
    spine = table.where("kind = 'spine'").select(*NODE_COLUMNS, "node_key", "parent_key").unionByName(
        top.select(*NODE_COLUMNS, "node_key", "parent_key"))
    nodes = table.where("kind = 'node'").select(*NODE_COLUMNS, "parent_key")
    # open nodes are few (a path of turns per block), so the planner picks the join by their size
    names = spine.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("up"))
    asking = nodes.where("parent_key is not null").unionByName(spine.where("parent_key is not null").drop("node_key"))
    found = asking.join(names, "parent_key").withColumn("parent_conv_id", F.col("up")).select(*NODE_COLUMNS)
    return (nodes.where("parent_key is null").select(*NODE_COLUMNS)
            .unionByName(spine.where("parent_key is null").select(*NODE_COLUMNS)).unionByName(found))
