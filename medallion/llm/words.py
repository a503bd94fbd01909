"""Vectorised word handling inside Arrow batches.

A batch of texts is split into words once, the words are dictionary-encoded,
and per-word work is done once per distinct word; flat numpy gathers then
rebuild the per-document sequences."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


ENCODE_WORDS = 20_000
HASH_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
HASH_CHUNK = 1 << 16            # bytes whose running sums are held at a time
LONG_WORD = 64                  # longer words, in bytes, are hashed one by one
PROBES = 4


def as_strings(col: pa.Array) -> pa.Array:
    """The column as strings, null counted as empty."""
    return pc.fill_null(col.cast(pa.string()), "")


def joined(batches, rows: int, size: int):
    """Consecutive record batches joined up to about ``rows`` rows or ``size`` bytes: work per
    distinct word is then done less often."""
    held, n, weight = [], 0, 0
    for b in batches:
        if held and (n + b.num_rows > rows or weight + b.nbytes > size):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n, weight = [], 0, 0
        if b.num_rows:
            held.append(b)
            n, weight = n + b.num_rows, weight + b.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def split_words(texts: pa.Array):
    """``(codes, distinct, offsets)``: word codes of all texts in order, the
    distinct words, and per-text offsets into ``codes``.  Words are separated by
    runs of ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    enc = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes = enc.indices.to_numpy(zero_copy_only=False)
    distinct = enc.dictionary.to_pylist()
    offsets = offsets - offsets[0]
    if "" in distinct:
        keep = codes != distinct.index("")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return codes, distinct, offsets


@lru_cache(maxsize=None)
def _hash_tables():
    """``(spaces, plain, lower, powers, inverse)``: which bytes are ASCII white space, a random
    number per byte without and with ASCII lower case, and the base's powers and their inverses."""
    spaces = np.zeros(256, bool)
    spaces[[0x20, *range(0x09, 0x0E)]] = True
    plain = np.random.default_rng(5).integers(1, 2**64 - 1, 256, dtype=np.uint64)
    lower = plain.copy()
    lower[ord("A"):ord("Z") + 1] = plain[ord("a"):ord("z") + 1]

    def powers(base):
        first = np.full(HASH_CHUNK + LONG_WORD, base, np.uint64)
        first[0] = 1
        return np.multiply.accumulate(first)
    return spaces, plain, lower, powers(HASH_BASE), powers(pow(HASH_BASE, -1, 2**64))


def hashed_words(texts: pa.Array, lower: bool):
    """``(hashes, starts, ends, offsets, data)``: a 64-bit hash and the place in ``data`` (UTF-8
    bytes) of every word of all texts in order, and per-text offsets into them.  Words are
    separated by runs of ASCII white space; ``lower`` counts ASCII letters as lower case.

    A hash is a polynomial in the bytes, read off running sums, so no word becomes an object."""
    spaces, plain, low, powers, inverse = _hash_tables()
    _, bounds, data = texts.buffers()
    n = len(texts)
    bounds = np.frombuffer(bounds, np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    cut = np.ones(len(data) + 1, bool)      # whether a text begins here or the byte before is white space
    space = spaces[data]
    cut[1:-1] = space[:-1]
    cut[bounds] = True
    starts = np.flatnonzero(cut[:-1] & ~space)
    cut[:-1] |= space                       # now: whether a word cannot go on here
    ends = np.flatnonzero(cut[1:] & ~space) + 1
    offsets = np.searchsorted(starts, bounds)
    hashes = np.empty(len(starts), np.uint64)
    codes = low if lower else plain
    chunks = np.searchsorted(starts, np.arange(0, len(data) + HASH_CHUNK, HASH_CHUNK))
    for k, (lo, hi) in enumerate(zip(chunks.tolist(), chunks[1:].tolist())):
        if lo < hi:
            part = codes[data[k * HASH_CHUNK:(k + 1) * HASH_CHUNK + LONG_WORD]]
            part *= powers[:len(part)]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=sums[1:])
            s = starts[lo:hi] - k * HASH_CHUNK
            e = np.minimum(ends[lo:hi] - k * HASH_CHUNK, len(part))
            hashes[lo:hi] = (sums[e] - sums[s]) * inverse[s]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        word = data[starts[i]:ends[i]].tobytes()
        hashes[i] = xxhash.xxh64_intdigest(word.lower() if lower else word)
    return hashes, starts, ends, offsets, data


def gather_ragged(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray):
    """Concatenate ``pool[starts[c]:starts[c]+lengths[c]]`` for every code ``c``;
    returns the flat array and the end position of each code's slice."""
    lens = lengths[codes]
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    if total == 0:
        return pool[:0], ends
    at = np.arange(total, dtype=np.int64) - np.repeat(ends - lens, lens) + np.repeat(starts[codes], lens)
    return pool[at], ends


class WordPool:
    """Per-word id sequences kept across batches of one worker.

    The pool takes words until it holds ``limit``; later ones, mostly rare, are encoded for
    their batch only."""

    def __init__(self, encode_many, limit: int = 400_000):
        self.encode_many = encode_many
        self.limit = limit
        self.index = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def lookup(self, words: list[str]):
        """``(slots, starts, lengths, pool)``: slot of every word."""
        slots = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(slots < 0)
        if not len(missing):
            return slots, self.starts, self.lengths, self.pool
        new = [words[i] for i in missing.tolist()]
        lengths, ids = [], []
        for lo in range(0, len(new), ENCODE_WORDS):     # Python objects of few words at a time
            found = self.encode_many(new[lo:lo + ENCODE_WORDS])
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(lengths[-1].sum())))
        lengths, ids = np.concatenate(lengths), np.concatenate(ids)
        first = len(self.starts)
        slots[missing] = np.arange(first, first + len(new))
        starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        lengths, pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, ids])
        if len(self.index) < self.limit:
            self.index.update(zip(new, range(first, first + len(new))))
            self.starts, self.lengths, self.pool = starts, lengths, pool
        return slots, starts, lengths, pool


class HashPool:
    """Like ``WordPool``, by the hashes of ``hashed_words``: no word is kept, only its hash in an
    open table, so a full pool takes some 30 MB of a worker's memory."""

    def __init__(self, encode_many, limit: int = 400_000, slots: int = 1 << 20):
        self.encode_many, self.limit = encode_many, limit
        self.table = np.full(slots, -1, np.int32)
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        slots = np.full(len(hashes), -1, np.int64)
        open_, at = np.arange(len(hashes)), (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)
        for _ in range(PROBES if len(self.keys) else 0):
            found = self.table[at]
            hit = (found >= 0) & (self.keys[found] == hashes[open_])
            slots[open_[hit]] = found[hit]
            more = ~hit & (found >= 0)
            open_, at = open_[more], (at[more] + 1) & (len(self.table) - 1)
        return slots

    def _keep(self, hashes: np.ndarray, slots: np.ndarray):
        at = (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)
        for _ in range(PROBES):     # a word without a free place is encoded again whenever it comes
            free = self.table[at] < 0
            self.table[at[free]] = slots[free]
            more = self.table[at] != slots
            slots, at = slots[more], (at[more] + 1) & (len(self.table) - 1)

    def lookup(self, hashes, begins, ends, data, lower: bool):
        """``(slots, starts, lengths, pool)``: slot of every word of ``hashed_words``."""
        slots = self._find(hashes)
        missing = np.flatnonzero(slots < 0)
        if not len(missing):
            return slots, self.starts, self.lengths, self.pool
        missing = missing[np.argsort(hashes[missing], kind="stable")]
        first = np.concatenate([[True], hashes[missing[1:]] != hashes[missing[:-1]]])
        new = missing[first]
        lengths, ids = [], []
        for lo in range(0, len(new), ENCODE_WORDS):     # Python objects of few words at a time
            part = new[lo:lo + ENCODE_WORDS]
            words = [data[s:e].tobytes() for s, e in zip(begins[part].tolist(), ends[part].tolist())]
            found = self.encode_many([(w.lower() if lower else w).decode() for w in words])
            lengths.append(np.fromiter(map(len, found), np.int32, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(lengths[-1].sum())))
        lengths, ids = np.concatenate(lengths), np.concatenate(ids)
        known = len(self.starts)
        slots[missing] = known + np.cumsum(first) - 1
        starts = np.concatenate([self.starts, (len(self.pool) + np.cumsum(lengths) - lengths).astype(np.int32)])
        lengths, pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, ids])
        if known < self.limit:
            self.keys = np.concatenate([self.keys, hashes[new]])
            self.starts, self.lengths, self.pool = starts, lengths, pool
            self._keep(hashes[new], np.arange(known, known + len(new)))
        return slots, starts, lengths, pool
