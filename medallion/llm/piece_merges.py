"""SentencePiece encoding by a model's own merges, over chunks of giant documents.

A boundary of the encoding splits it: the merges on both sides never meet, so each
side is encoded alone.  A place whose two neighbouring characters stand together in
no piece is always a boundary (a space mark after another character is one), so the
stretch between two space marks is encoded once per distinct string and cached.

Where a boundary lies at the cut of a chunk follows from the stretch around the cut.
Only where that stretch is longer than ``REACH`` states are carried: a state is the
piece over the cut, and two pieces may follow one another if and only if the model
encodes their joined text to just the two.  A chunk is then the relation of the
pieces over its first cut to those over its last, relations combine associatively
(chunks into blocks, blocks into the document), and exactly one path remains.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, text_of
from .sentencepiece_scan import BLOCK, CHUNK, MARK, escape

REACH = 512           # characters on either side of a cut that are searched for boundaries
CACHED = 64           # longer units are not cached
CACHE_SIZE = 400_000
KNOWN = -1            # the state at a cut whose boundary is known
WIDTH = 1 << 10       # a state is WIDTH times the characters before the cut plus those after it

_UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_MODELS: dict[str, "Merges"] = {}


class Merges:
    """The merges of a model file, on escaped text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("not a model of merges with byte pieces")
        proto.normalizer_spec.add_dummy_prefix = False  # escape() has set it
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        names = [p.piece for p in proto.pieces]
        normal = [i for i, p in enumerate(proto.pieces) if p.type in (pb.ModelProto.SentencePiece.NORMAL,
                                                                      pb.ModelProto.SentencePiece.USER_DEFINED)]
        self.pieces = {names[i] for i in normal}
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece of this vocabulary crosses a space mark")
        self.longest = max(map(len, self.pieces), default=1)
        self.pairs = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        # characters of each piece; a character written as bytes counts at its first byte
        self.chars = [len(n) for n in names]
        for i, p in enumerate(proto.pieces):
            if p.type == pb.ModelProto.SentencePiece.BYTE:
                self.chars[i] = 0 if 0x80 <= int(names[i][3:5], 16) < 0xC0 else 1
        self.cache: dict[str, bytes] = {}
        self.follow: dict[tuple[str, str], bool] = {}

    @classmethod
    def load(cls, path: str) -> "Merges":
        if path not in _MODELS:
            _MODELS[path] = cls(path)
        return _MODELS[path]

    def encode(self, x: str) -> bytes:
        """Ids of an escaped text between two boundaries, as little-endian 32-bit."""
        units, cache = _UNITS.findall(x), self.cache
        new = [u for u in set(units) if u not in cache]
        if not new:
            return b"".join([cache[u] for u in units])
        found = {u: np.asarray(ids, dtype="<u4").tobytes() for u, ids in zip(new, self.sp.encode(new, num_threads=1))}
        if len(cache) + len(found) > CACHE_SIZE:
            found.update((u, cache[u]) for u in set(units) if u in cache)
            cache.clear()
        out = b"".join([cache[u] if u in cache else found[u] for u in units])
        cache.update((u, ids) for u, ids in found.items() if len(u) <= CACHED)
        return out

    def lengths(self, x: str) -> list[int]:
        """Characters of each piece of an escaped text between two boundaries."""
        return [n for n in (self.chars[i] for i in self.sp.encode(x)) if n]

    def boundary(self, x: str, at: int) -> int:
        """Characters from ``at`` to the first boundary there or after, or -1 if only a scan can tell."""
        if at in (0, len(x)):
            return 0
        first, last = at, at
        while first and x[first - 1:first + 1] in self.pairs:
            first -= 1
            if at - first > REACH:
                return -1
        if first == at:
            return 0
        while last < len(x) and x[last - 1:last + 1] in self.pairs:
            last += 1
            if last - at > REACH:
                return -1
        place = first
        for n in self.lengths(x[first:last]):
            if place >= at:
                break
            place += n
        return place - at

    def may_follow(self, a: str, b: str) -> bool:
        got = self.follow.get((a, b))
        if got is None:
            if len(self.follow) > CACHE_SIZE:
                self.follow.clear()
            got = self.follow[a, b] = self.lengths(a + b) == ([len(a), len(b)] if a else [len(b)])
        return got

    def ends(self, x: str, start: int):
        """Ends of the pieces that may start at ``start``; a character alone always may."""
        return [e for e in range(start + 1, min(start + self.longest, len(x)) + 1) if e == start + 1 or x[start:e] in self.pieces]

    def relation(self, x: str, lead: int, size: int, entry: int, exit_: int) -> list[tuple[int, int]]:
        """Pairs of the states at the cuts ``lead`` and ``lead + size`` of ``x`` that a path of pieces joins."""
        end = lead + size
        if entry >= 0:
            entries = {(lead + entry, lead + entry): KNOWN}
        else:
            entries = {(s, e): WIDTH * (lead - s) + e - lead for s in range(max(0, lead - self.longest), lead)
                       for e in self.ends(x, s) if e >= lead}
        names = list(entries.values())
        reached: dict[int, dict[int, int]] = {}  # end: start: entries as bits
        for k, (s, e) in enumerate(entries):
            reached.setdefault(e, {})[s] = 1 << k
        last = end + max(exit_, 0)
        out = {}
        for p in range(min(reached), min(last, len(x)) + self.longest + 1):
            here = reached.pop(p, None)
            if not here:
                continue
            if exit_ < 0 and p >= end:
                for s, bits in here.items():
                    out[WIDTH * (end - s) + p - end] = bits
                continue
            if exit_ >= 0 and p >= last:
                for bits in here.values() if p == last else ():
                    out[KNOWN] = out.get(KNOWN, 0) | bits
                continue
            for e in self.ends(x, p):
                bits = 0
                for s, b in here.items():
                    if self.may_follow(x[s:p], x[p:e]):
                        bits |= b
                if bits:
                    to = reached.setdefault(e, {})
                    to[p] = to.get(p, 0) | bits
        return [(names[k], v) for v, bits in out.items() for k in range(len(names)) if bits >> k & 1]


def product(a, b) -> list[tuple[int, int]]:
    """The relation ``a`` and then the relation ``b``."""
    onward: dict[int, list[int]] = {}
    for u, v in b:
        onward.setdefault(u, []).append(v)
    return list({(u, w) for u, v in a for w in onward.get(v, ())})


def walk(relations, entry: int, exit_: int) -> list[int]:
    """States at every cut of the path through ``relations``."""
    reached = [{entry}]
    for r in relations:
        reached.append({v for u, v in r if u in reached[-1]})
    states = [exit_]
    for k in range(len(relations) - 1, -1, -1):
        states.append(next(u for u, v in relations[k] if v == states[-1] and u in reached[k]))
    return states[::-1]


def chunks_of(m: Merges, x: str, chunk: int):
    """``chunk, x, lead, size, entry, exit`` of every chunk of an escaped text.

    ``lead`` characters before and ``longest`` after the chunk's own are kept;
    ``entry`` and ``exit`` are the characters from each cut to the next boundary."""
    entry = 0
    for k in range(max(1, -(-len(x) // chunk))):
        start, end = k * chunk, min(len(x), (k + 1) * chunk)
        lead = min(start, m.longest)
        after = entry - (end - start) if entry >= end - start else m.boundary(x, end)
        yield k, x[start - lead:end + m.longest], lead, end - start, entry, after
        entry = after


def _chunk_rows(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    def run(batches):
        m = Merges.load(path)
        names = ["doc_id", "thash", "chunk", "x", "lead", "size", "entry", "exit"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), *[pa.int32()] * 4]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            rows = []
            for doc_id, thash, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "thash", "t"))):
                for row in chunks_of(m, escape(text), chunk):
                    rows.append((doc_id, thash, *row))
                    if len(rows) == 64:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    return docs.mapInArrow(run, "doc_id long, thash long, chunk int, x string, lead int, size int, entry int, exit int")


def _pack(pairs) -> bytes:
    return np.asarray(sorted(pairs), dtype="<i4").tobytes()


def _unpack(col) -> list:
    return [[tuple(p) for p in np.frombuffer(c, "<i4").reshape(-1, 2).tolist()] for c in col.to_pylist()]


def _states(chunks: DataFrame, path: str) -> DataFrame:
    """``doc_id, thash, chunk, s, e``: the states at both cuts of the chunks with an unknown boundary."""
    key = ["doc_id", "thash"]

    def relations(batches):
        m = Merges.load(path)
        for b in batches:
            cells = [_pack(m.relation(*row)) for row in zip(*(b.column(c).to_pylist() for c in ("x", "lead", "size", "entry", "exit")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "thash", "chunk")), pa.array(cells, pa.binary())],
                                             names=["doc_id", "thash", "chunk", "r"])

    def fold(t: pa.Table) -> pa.Table:
        t, total = t.sort_by("chunk"), None
        for r in _unpack(t.column("r")):
            total = r if total is None else product(total, r)
        return t.slice(0, 1).select([*key, "block"]).append_column("r", pa.array([_pack(total)], pa.binary()))

    def steps(t: pa.Table, at: str, entry: int, exit_: int) -> pa.Table:
        t = t.sort_by(at)
        s = walk(_unpack(t.column("r")), entry, exit_)
        return (t.select([*key, at]).append_column("s", pa.array(s[:-1], pa.int32()))
                .append_column("e", pa.array(s[1:], pa.int32())))

    def over_blocks(t: pa.Table) -> pa.Table:
        return steps(t, "block", KNOWN, KNOWN)

    def over_chunks(left: pa.Table, right: pa.Table) -> pa.Table:
        return steps(left, "chunk", right.column("s")[0].as_py(), right.column("e")[0].as_py())

    rel = materialise(chunks.where("entry < 0 or exit < 0").select(*key, "chunk", "x", "lead", "size", "entry", "exit").mapInArrow(
        relations, "doc_id long, thash long, chunk int, r binary").dropDuplicates([*key, "chunk"])
        .withColumn("block", F.floor(F.col("chunk") / BLOCK).cast("int")), "chunk_relations")
    by_block = [*key, "block"]
    blocks = rel.groupBy(*by_block).applyInArrow(fold, "doc_id long, thash long, block int, r binary")
    fixed = blocks.groupBy(*key).applyInArrow(over_blocks, "doc_id long, thash long, block int, s int, e int")
    return rel.groupBy(*by_block).cogroup(fixed.groupBy(*by_block)).applyInArrow(
        over_chunks, "doc_id long, thash long, chunk int, s int, e int")


def encode(docs: DataFrame, model_path: str, chunk: int = CHUNK, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, thash, chunk, n_chars, ids`` (little-endian unsigned 32-bit) per chunk.

    A document's ids are its chunks' ids in order, and a piece belongs to the chunk
    in which it starts; ``n_chars`` counts the chunk's own escaped characters.  Null
    and empty texts give one chunk without ids; repeated rows repeat their chunks; an
    empty table gives no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("t")).withColumn("thash", F.xxhash64("t"))

    def small(batches):
        m = Merges.load(model_path)
        for b in batches:
            xs = [escape(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("thash"), pa.array([0] * len(xs), pa.int32()), pa.array([len(x) for x in xs], pa.int64()),
                 pa.array([m.encode(x) for x in xs], pa.binary())], names=["doc_id", "thash", "chunk", "n_chars", "ids"])

    def giant(batches):
        m = Merges.load(model_path)
        for b in batches:
            cells = [m.encode(x[lead + i:lead + n + j]) for x, lead, n, i, j in
                     zip(*(b.column(c).to_pylist() for c in ("x", "lead", "size", "entry", "exit")))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "thash", "chunk")), b.column("size").cast(pa.int64()), pa.array(cells, pa.binary())],
                names=["doc_id", "thash", "chunk", "n_chars", "ids"])

    rows = _chunk_rows(src.where(F.length("t") >= chunk), model_path, chunk)
    states = _states(rows, model_path).withColumnsRenamed({"doc_id": "d2", "thash": "h2", "chunk": "c2"})
    reach = lambda known, state: F.when(F.col(known) >= 0, F.col(known)).otherwise(F.col(state) % WIDTH)
    scanned = rows.where("entry < 0 or exit < 0").join(
        states, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("thash") == F.col("h2")) & (F.col("chunk") == F.col("c2"))).withColumns(
        {"entry": reach("entry", "s"), "exit": reach("exit", "e")})
    cols = ["doc_id", "thash", "chunk", "x", "lead", "size", "entry", "exit"]
    out = "doc_id long, thash long, chunk int, n_chars long, ids binary"
    return (src.where(F.length("t") < chunk).mapInArrow(small, out)
            .union(rows.where("entry >= 0 and exit >= 0").select(*cols).mapInArrow(giant, out))
            .union(scanned.select(*cols).mapInArrow(giant, out)))
