"""Packing along a space-filling curve.

Documents are tokenised, their hashed token vectors are projected to a few
dimensions, and a Hilbert key orders them so that similar documents are
neighbours.  The rows are range-sorted by the key and every range packs its
documents end to end into sequences.  The rest of a range, shorter than a
sequence, is cut into sequences whose lengths are powers of two, which need no
padding; so no range depends on another and nothing passes through the driver
but a handful of totals.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialise, prepare, text_of
from .words import HashPool, as_strings, gather_ragged, hashed_words, joined

SEQ_LEN = 2048
END_ID = 1
VECTOR_DIM = 1024
CURVE_DIMS = 3
CURVE_BITS = 16
TOKENS_PER_RANGE = 8_000_000
CHUNK_IDS = 8192        # ids in one row that is range-sorted: long documents weigh as many rows
JOIN_ROWS, JOIN_BYTES = 1500, 3 << 20
ARROW_BYTES = 4 << 20   # the JVM's and the worker's buffers of one Arrow batch
READ_ROWS = 512         # whole texts, or rows of ids, in one Parquet batch of the JVM
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

_POOLS: dict[str, HashPool] = {}
_PLAIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def _byte_letters() -> dict[int, str]:
    """Letters as byte-level vocabularies spell them: a byte that is a visible
    Latin-1 character stands for itself, the others take code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelt = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}
    return {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


@lru_cache(maxsize=None)
def _ends_in_letter(last: str) -> bool:
    """Whether a word's last letter is still one after the vocabulary's normalising (NFC and
    lower case): some letters end in a combining mark, which goes with the marks behind it."""
    return last.isalpha() and unicodedata.normalize("NFC", last).lower()[-1].isalpha()


def _word_pool(path: str) -> HashPool:
    """Ids per white-space-separated word; the vocabulary never joins two of them."""
    if path not in _POOLS:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        model, table = tok.model, _byte_letters()

        def encode_many(words):
            # a word's letters and the marks after it are separate units of the vocabulary
            split, new = [], {}
            for w in words:
                stem = w.rstrip(string.punctuation)
                pair = (stem, w[len(stem):]) if stem and len(stem) < len(w) and "<|" not in w and _ends_in_letter(stem[-1]) else (w, "")
                split.append(pair)
                new[pair[0]] = new[pair[1]] = ()
            new.pop("", None)
            rest = []
            for p in new:
                if _PLAIN.fullmatch(p):  # one unit: no normalising and splitting needed
                    low = p.lower()
                    new[p] = [t.id for t in model.tokenize(low if low.isascii() else low.translate(table))]
                else:
                    rest.append(p)
            for p, e in zip(rest, tok.encode_batch(rest, add_special_tokens=False)):
                new[p] = e.ids
            new[""] = []
            return [new[a] + new[b] if b else new[a] for a, b in split]

        _POOLS[path] = HashPool(encode_many)
    return _POOLS[path]


def encode_batch(texts: pa.Array, path: str):
    """``(ids, ends)``: all ids of the texts, flat, and each text's end."""
    import pyarrow.compute as pc
    # the vocabulary is lower case; fewer distinct words
    lower = not pc.any(pc.match_substring(texts, "<|")).as_py()
    hashes, begins, stops, offsets, data = hashed_words(texts, lower)
    slots, starts, lengths, pool = _word_pool(path).lookup(hashes, begins, stops, data, lower)
    ids, ends = gather_ragged(slots, starts, lengths, pool)
    ends = np.concatenate([[0], ends])
    return ids, ends[offsets[1:]] if len(offsets) > 1 else np.zeros(0, np.int64)


def _projection() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((VECTOR_DIM, CURVE_DIMS)).astype(np.float32)


def tokenise(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, start, n, ids, tie, x0..``: a document's ids with the end id, cut into rows of at
    most ``CHUNK_IDS`` (from ``start``, of ``n`` in all), a checksum of them all, and the projected vector."""
    prepare(docs.sparkSession, ARROW_BYTES, READ_ROWS)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        proj = _projection()
        for b in joined(batches, JOIN_ROWS, JOIN_BYTES):
            n = b.num_rows
            ids, ends = encode_batch(as_strings(b.column("text")), tokenizer_path)
            begins = np.concatenate([[0], ends[:-1]])
            xs = np.empty((n, CURVE_DIMS))
            for lo in range(0, n, 250):
                hi = min(n, lo + 250)
                doc = np.repeat(np.arange(hi - lo), ends[lo:hi] - begins[lo:hi])
                h = ((ids[begins[lo]:ends[hi - 1]].astype(np.int64) * 0x9E3779B1) >> 7) % VECTOR_DIM
                count = np.bincount(doc * VECTOR_DIM + h, minlength=(hi - lo) * VECTOR_DIM)
                vec = np.log1p(count.astype(np.float32).reshape(hi - lo, -1))
                vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
                xs[lo:hi] = vec @ proj
            wide = np.insert(ids, ends, END_ID).astype("<u4")
            cut = np.concatenate([[0], ends + np.arange(1, n + 1)])
            raw = memoryview(wide).cast("B")
            tie = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(cut.tolist(), cut[1:].tolist())]
            length = np.diff(cut)
            rows = -(-length // CHUNK_IDS)
            doc = np.repeat(np.arange(n), rows)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)) * CHUNK_IDS
            at = cut[doc] + start
            end = np.minimum(at + CHUNK_IDS, cut[doc + 1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length[doc]),
                 pa.array([raw[4 * s:4 * e] for s, e in zip(at.tolist(), end.tolist())], pa.binary()),
                 pa.array(np.array(tie, np.int64)[doc]), *[pa.array(xs[doc, k]) for k in range(CURVE_DIMS)]],
                names=["doc_id", "start", "n", "ids", "tie", *[f"x{k}" for k in range(CURVE_DIMS)]])
            pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, "doc_id long, start long, n long, ids binary, tie long, "
                          + ", ".join(f"x{k} double" for k in range(CURVE_DIMS)))


def hilbert_key(coords: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows), as int64."""
    x = coords.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the curve's rotations and reflections from the top bit down
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            x[0] = np.where(flip, x[0] ^ p, x[0])
            t = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] ^= t
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class RangePacker:
    """Packs the documents of one range in order; holds back one sequence."""

    def __init__(self, seq_len: int, first_id: int):
        self.seq_len, self.next_id = seq_len, first_id
        self.fill, self.held = 0, []

    def add(self, doc_id, first: int, ids: bytes, n: int):
        """Pieces of the sequences that these ids of a document of ``n`` complete; ``first`` are before them."""
        size, start, out = len(ids) // 4, 0, []
        while start < size:
            take = min(size - start, self.seq_len - self.fill)
            self.held.append((doc_id, first + start, take, ids[4 * start:4 * (start + take)], n, self.next_id, self.fill))
            start += take
            self.fill += take
            if self.fill == self.seq_len:
                out += self.held
                self.fill, self.held, self.next_id = 0, [], self.next_id + 1
        return out

    def finish(self):
        """The rest, cut into sequences of power-of-two lengths."""
        out, room, at = [], 0, 0
        left = self.fill
        for doc_id, start, length, ids, n, _, _ in self.held:
            done = 0
            while done < length:
                if not room:
                    room = 1 << (left.bit_length() - 1)
                    left -= room
                    at, seq, self.next_id = 0, self.next_id, self.next_id + 1
                take = min(room, length - done)
                out.append((doc_id, start + done, take, ids[4 * done:4 * (done + take)], n, seq, at))
                done, room, at = done + take, room - take, at + take
        self.held, self.fill = [], 0
        return out


def _pieces(rows) -> pa.RecordBatch:
    names = [c.split()[0] for c in PIECES.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, text_col: str = "text", id_col: str = "doc_id",
         tokens_per_range: int = TOKENS_PER_RANGE) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit.  Null text counts as empty and
    leaves its end id; a very long document runs on over many sequences; equal
    keys and repeated rows are ordered by id and content; an empty table gives
    no pieces; other columns are ignored.  ``seq_len`` must be a power of two."""
    spark = docs.sparkSession
    rows = materialise(tokenise(docs, tokenizer_path, text_col, id_col), "tokens")
    xs = [f"x{k}" for k in range(CURVE_DIMS)]
    stats = rows.where("start = 0").agg(F.sum("n").alias("n"), *[F.avg(x).alias(f"m{x}") for x in xs],
                     *[F.stddev_pop(x).alias(f"s{x}") for x in xs]).first()
    mean = np.array([stats[f"m{x}"] or 0.0 for x in xs])
    dev = np.array([stats[f"s{x}"] or 1.0 for x in xs])
    total = stats["n"] or 0
    ranges = max(math.ceil(total / tokens_per_range), min(spark.sparkContext.defaultParallelism, math.ceil(total / 500_000)), 1)

    @pandas_udf("long")
    def curve(a, b, c):
        z = (np.column_stack([a, b, c]) - mean) / dev
        u = 1 / (1 + np.exp(-1.702 * np.clip(z, -30, 30)))
        return __import__("pandas").Series(hilbert_key(np.minimum((u * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1)))

    def run(batches):
        from pyspark import TaskContext
        packer = RangePacker(seq_len, TaskContext.get().partitionId() << 33)
        for b in batches:
            out = []
            for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "ids", "n"))):
                out += packer.add(*row)
            yield _pieces(out)
        yield _pieces(packer.finish())

    keyed = rows.select("doc_id", "start", "n", "ids", "tie", curve(*[F.col(x) for x in xs]).alias("key"))
    order = ["key", "doc_id", "tie", "start"]
    return (keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
            .select("doc_id", "start", "ids", "n").mapInArrow(run, PIECES))
