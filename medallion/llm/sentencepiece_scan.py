"""SentencePiece encoding and decoding by a max-plus parallel scan.

Encoding is the segmentation of the escaped text into pieces of the vocabulary
with the largest sum of piece scores (a character without a piece falls back to
byte pieces).  A giant document is cut into chunks.  The boundary state of a cut
is how far the piece that crosses it reaches beyond it, so a chunk is a matrix of
best scores from each entry state to each exit state, and the matrices combine by
the associative max-plus product: chunks into blocks, blocks into the document.
Walking back over the products fixes the entry and exit state of every block and
chunk, after which each chunk is traced back on its own.  Scores are integers, so
products are exact in any grouping.

Inside a chunk, places that no piece can cross (a space mark after another
character) collapse the state, so the stretch between two such places is solved
once per distinct string and cached.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, text_of

MARK = "▁"
NEG = -(1 << 60)
CHUNK = 16_384
BLOCK = 256           # chunks per block; a string holds fewer than BLOCK blocks
SCALE = 100           # scores are kept as integers of this fraction
UNKNOWN_PENALTY = 10

_VOCABS: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Pieces, integer scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = {names[i]: (round(sp.get_score(i) * SCALE), i) for i in normal}
        usual = [s for s, _ in self.pieces.values() if s > -SCALE * 10 ** 8]
        self.unknown = min(usual, default=0) - UNKNOWN_PENALTY * SCALE
        self.longest = max(map(len, self.pieces), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece of this vocabulary crosses a space mark")
        self.heads = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}  # beginnings of pieces
        self.surface = [b""] * size
        for i in normal:
            self.surface[i] = names[i].replace(MARK, " ").encode("utf-8")
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b])
        self.cache: dict[str, tuple[int, tuple]] = {}

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        if path not in _VOCABS:
            _VOCABS[path] = cls(path)
        return _VOCABS[path]

    def forward(self, x: str, start: int, expand: int):
        """Best scores and back links from ``start``; pieces start before ``expand``."""
        stop = min(len(x), expand + self.longest - 1)
        best, back = [NEG] * (stop + 1), [None] * (stop + 1)
        best[start] = 0
        pieces, heads, longest = self.pieces, self.heads, self.longest
        for p in range(start, min(expand, stop)):
            here = best[p]
            if here == NEG:
                continue
            single = False
            for e in range(p + 1, min(p + longest, stop) + 1):
                part = x[p:e]
                if part not in heads:
                    break
                got = pieces.get(part)
                if got is not None:
                    single = single or e == p + 1
                    if here + got[0] > best[e]:
                        best[e], back[e] = here + got[0], (p, got[1])
            if not single and here + self.unknown > best[p + 1]:
                best[p + 1], back[p + 1] = here + self.unknown, (p, -1)
        return best, back

    def trace(self, x: str, back, start: int, end: int) -> list[int]:
        parts = []
        while end > start:
            p, i = back[end]
            parts.append([i] if i >= 0 else [self.bytes[b] for b in x[p:end].encode("utf-8", "surrogatepass")])
            end = p
        return [i for part in reversed(parts) for i in part]

    def unit(self, u: str) -> tuple[int, tuple]:
        """Score and ids of a stretch that no piece crosses."""
        got = self.cache.get(u)
        if got is None:
            if len(self.cache) > 400_000:
                self.cache.clear()
            best, back = self.forward(u, 0, len(u))
            got = self.cache[u] = (best[len(u)], tuple(self.trace(u, back, 0, len(u))))
        return got


def escape(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
_CUT = re.compile(f"(?<=[^{MARK}]){MARK}")


class Chunk:
    """One chunk: its ``size`` own characters, then what a crossing piece may need."""

    def __init__(self, vocab: Vocabulary, x: str, size: int, before: str):
        self.v, self.x, self.m = vocab, x, size
        cuts = [c.start() for c in _CUT.finditer(x[:size + 1])]
        if not before or (x[:1] == MARK and before != MARK):
            cuts = [0] + cuts
        self.cuts = cuts

    def matrix(self) -> np.ndarray:
        """Best scores from every entry state to every exit state."""
        width = self.v.longest
        out = np.full((width, width), NEG, dtype=np.int64)
        if not self.cuts:
            for i in range(min(width, self.m + width)):
                self._row(out[i], i, 0)
            return out
        c1, ck = self.cuts[0], self.cuts[-1]
        middle = sum(self.v.unit(u)[0] for u in _UNIT.findall(self.x[c1:ck]))
        tail = np.full(width, NEG, dtype=np.int64)
        self._row(tail, ck, 0)
        for i in range(min(width, c1 + 1)):
            head = self.v.forward(self.x[:c1], i, c1)[0][c1]
            if head > NEG:
                out[i] = np.where(tail > NEG, tail + head + middle, NEG)
        return out

    def _row(self, row, start, add):
        if start >= self.m:  # nothing of this chunk is left: the entry passes on
            if start - self.m < len(row):
                row[start - self.m] = add
            return
        best, _ = self.v.forward(self.x, start, self.m)
        for j in range(len(row)):
            if self.m + j < len(best) and best[self.m + j] > NEG:
                row[j] = best[self.m + j] + add

    def encode(self, entry: int, exit_: int) -> list[int]:
        """Ids of the pieces that start in this chunk, for its fixed states."""
        v, end = self.v, self.m + exit_
        if entry >= self.m and not (self.cuts and self.cuts[0] >= entry):
            return []
        if not self.cuts:
            return v.trace(self.x, v.forward(self.x, entry, self.m)[1], entry, end)
        c1, ck = self.cuts[0], self.cuts[-1]
        ids = v.trace(self.x, v.forward(self.x[:c1], entry, c1)[1], entry, c1)
        unit = v.unit
        for u in _UNIT.findall(self.x[c1:ck]):
            ids += unit(u)[1]
        if ck < self.m:
            tail = self.x[ck:end]
            if end == self.m and len(self.x) == self.m:
                ids += unit(tail)[1] if tail else ()
            else:
                ids += v.trace(self.x, v.forward(self.x, ck, self.m)[1], ck, end)
        return ids


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices (or of a row vector and a matrix)."""
    out = (a[..., :, None] + b[None] if a.ndim == 2 else a[:, None] + b).max(axis=-2)
    return np.maximum(out, NEG)


def walk(mats: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """States at every inner and outer boundary of a best path through ``mats``."""
    width = mats[0].shape[0]
    v = np.full(width, NEG, dtype=np.int64)
    v[entry] = 0
    vs = [v]
    for m in mats:
        vs.append(product(vs[-1], m))
    states = [exit_]
    for k in range(len(mats) - 1, -1, -1):
        states.append(int(np.argmax(vs[k] + mats[k][:, states[-1]])))
    return states[::-1]


def _chunk_rows(docs: DataFrame, vocab_path: str, chunk: int):
    """``doc_id, thash, chunk, x, size, before`` of every chunk of the given documents."""
    def run(batches):
        longest = Vocabulary.load(vocab_path).longest
        names = ["doc_id", "thash", "chunk", "x", "size", "before"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()]
        for b in batches:
            for doc_id, thash, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "thash", "t"))):
                x = escape(text)
                rows = []
                for k in range(0, max(1, -(-len(x) // chunk))):
                    s = k * chunk
                    rows.append((doc_id, thash, k, x[s:s + chunk + longest - 1], min(chunk, len(x) - s), x[s - 1] if k else ""))
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.mapInArrow(run, "doc_id long, thash long, chunk int, x string, size int, before string")


def _states(chunks: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, thash, chunk, entry, exit`` by the scan over chunk matrices."""
    key = ["doc_id", "thash"]

    def mats(batches):
        v = Vocabulary.load(vocab_path)
        for b in batches:
            cells = [Chunk(v, x, n, p).matrix().astype("<i8").tobytes()
                     for x, n, p in zip(*(b.column(c).to_pylist() for c in ("x", "size", "before")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "thash", "chunk")), pa.array(cells, pa.binary())],
                                             names=["doc_id", "thash", "chunk", "m"])

    def unpack(col):
        cells = col.to_pylist()
        width = int(round((len(cells[0]) // 8) ** 0.5))
        return [np.frombuffer(c, "<i8").reshape(width, width) for c in cells]

    def fold(t: pa.Table) -> pa.Table:
        t = t.sort_by("chunk")
        total = None
        for m in unpack(t.column("m")):
            total = m if total is None else product(total, m)
        first = t.slice(0, 1).select(["doc_id", "thash", "block"])
        return first.append_column("m", pa.array([total.astype("<i8").tobytes()], pa.binary()))

    def over_blocks(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        s = walk(unpack(t.column("m")), 0, 0)
        return (t.select(["doc_id", "thash", "block"]).append_column("entry", pa.array(s[:-1], pa.int32()))
                .append_column("exit", pa.array(s[1:], pa.int32())))

    def over_chunks(left: pa.Table, right: pa.Table) -> pa.Table:
        t = left.sort_by("chunk")
        s = walk(unpack(t.column("m")), right.column("entry")[0].as_py(), right.column("exit")[0].as_py())
        return (t.select(["doc_id", "thash", "chunk"]).append_column("entry", pa.array(s[:-1], pa.int32()))
                .append_column("exit", pa.array(s[1:], pa.int32())))

    mat = materialise(chunks.select(*key, "chunk", "x", "size", "before").mapInArrow(
        mats, "doc_id long, thash long, chunk int, m binary").dropDuplicates([*key, "chunk"])
        .withColumn("block", F.floor(F.col("chunk") / BLOCK).cast("int")), "chunk_matrices")
    by_block = [*key, "block"]
    blocks = mat.groupBy(*by_block).applyInArrow(fold, "doc_id long, thash long, block int, m binary")
    fixed = blocks.groupBy(*key).applyInArrow(over_blocks, "doc_id long, thash long, block int, entry int, exit int")
    return mat.groupBy(*by_block).cogroup(fixed.groupBy(*by_block)).applyInArrow(
        over_chunks, "doc_id long, thash long, chunk int, entry int, exit int")


def encode(docs: DataFrame, model_path: str, chunk: int = CHUNK, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, thash, chunk, n_chars, ids`` (little-endian unsigned 32-bit) per chunk.

    A document's ids are its chunks' ids in order; ``n_chars`` counts the chunk's
    own escaped characters.  Null and empty texts give one chunk without ids; of
    segmentations with equal scores the longest last piece wins inside a chunk and
    the shortest reach at a cut; repeated rows repeat their chunks; an empty table
    gives no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("t")).withColumn("thash", F.xxhash64("t"))
    giant = _chunk_rows(src.where(F.length("t") >= chunk), model_path, chunk)
    small = _chunk_rows(src.where(F.length("t") < chunk), model_path, chunk).withColumns(
        {"entry": F.lit(0), "exit": F.lit(0)})
    states = _states(giant, model_path).withColumnsRenamed({"doc_id": "d2", "thash": "h2", "chunk": "c2"})
    placed = giant.join(states, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("thash") == F.col("h2"))
                        & (F.col("chunk") == F.col("c2"))).drop("d2", "h2", "c2")

    def run(batches):
        v = Vocabulary.load(model_path)
        for b in batches:
            cells = [np.asarray(Chunk(v, x, n, p).encode(i, j), dtype="<u4").tobytes() for x, n, p, i, j in
                     zip(*(b.column(c).to_pylist() for c in ("x", "size", "before", "entry", "exit")))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "thash", "chunk")), b.column("size").cast(pa.int64()), pa.array(cells, pa.binary())],
                names=["doc_id", "thash", "chunk", "n_chars", "ids"])

    cols = ["doc_id", "thash", "chunk", "x", "size", "before", "entry", "exit"]
    out = "doc_id long, thash long, chunk int, n_chars long, ids binary"
    return small.select(*cols).mapInArrow(run, out).union(placed.select(*cols).mapInArrow(run, out))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` plus ``text``: each chunk's text; chunks in order make the document."""
    def run(batches):
        surface = Vocabulary.load(model_path).surface
        for b in batches:
            texts = []
            for k, ids in zip(b.column("chunk").to_pylist(), b.column("ids").to_pylist()):
                raw = b"".join([surface[i] for i in np.frombuffer(ids, "<u4").tolist()])
                texts.append((raw[1:] if k == 0 else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "text"])

    return encoded.mapInArrow(run, encoded.withColumn("text", F.lit("")).schema)
