"""Quality classifier: random-indexing word vectors, a two-layer network, calibration.

Every word has a sparse ternary index vector (from its hash).  The vector of a
word is the sum of the index vectors of its neighbours over the whole corpus.
Words are hashed to a fixed number of slots, so the table's size is a parameter.
A document pools the vectors of its words (mean and mean square); a two-layer
network in numpy scores the pooled vector, and one temperature, fitted on rows
kept apart from the training rows, calibrates its probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, text_of
from .words import WordPool, as_strings, gather_ragged, split_words

SLOTS = 8192
DIMS = 32
NONZERO = 4
WINDOW = 2
FIT_ROWS = 20_000      # labelled rows that the network is fitted on, at most
HIDDEN = 32
EPOCHS = 60
STEP = 1 << 18

_UNITS: list[WordPool] = []


def _units(words):
    """Slots of a word's units: its letters, its marks, and its shape."""
    out = []
    for w in words:
        core = w.strip("!?.,;:|#$%&*()[]\"'")
        marks = w[len(w.rstrip("!?.,;:|#$%&*()[]\"'")):] if core else w
        units = []
        if core:
            units.append("w:" + core.lower())
            if len(core) > 2 and core.isupper():
                units.append("shape:upper")
            elif any(c.isdigit() for c in core):
                units.append("shape:digit")
        if marks:
            units.append("m:" + marks)
        out.append([xxhash.xxh32_intdigest(u.encode("utf-8", "surrogatepass")) % SLOTS for u in units])
    return out


def unit_slots(texts: pa.Array):
    """``(slots, ends)``: unit slots of all texts in order and each text's end.

    A word equal to the one before it adds the unit "repeat"."""
    if not _UNITS:
        _UNITS.append(WordPool(_units))
    codes, distinct, offsets = split_words(texts)
    slots, starts, lengths, pool = _UNITS[0].lookup(distinct)
    flat, ends = gather_ragged(slots[codes] if len(codes) else np.zeros(0, np.int64), starts, lengths, pool)
    first = np.zeros(len(codes) + 1, bool)
    first[offsets[:-1]] = True
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again &= ~first[:-1]
    before = np.concatenate([[0], ends])
    if again.any():
        flat = np.insert(flat, before[1:][again], xxhash.xxh32_intdigest(b"shape:repeat") % SLOTS)
        before = before + np.concatenate([[0], np.cumsum(again)])
    return flat, before[offsets[1:]]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Columns and signs of every slot's sparse ternary index vector."""
    rng = np.random.default_rng(3)
    cols = np.argsort(rng.random((SLOTS, DIMS)), axis=1)[:, :NONZERO]
    return cols, np.where(rng.random((SLOTS, NONZERO)) < 0.5, -1, 1)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The table of word vectors from all rows of ``docs``, one unit row per slot."""
    prepare(docs.sparkSession)

    def run(batches):
        cols, signs = index_vectors()
        total = np.zeros(SLOTS * DIMS)
        for b in batches:
            slots, ends = unit_slots(as_strings(b.column("t")))
            edge = np.zeros(len(slots) + 1, np.int64)
            edge[ends[ends < len(slots)]] = 1
            doc = np.cumsum(edge)[:len(slots)]
            for gap in range(1, WINDOW + 1):
                for lo in range(0, len(slots) - gap, STEP):
                    x, y = slots[lo:lo + STEP], slots[lo + gap:lo + gap + STEP]
                    x = x[:len(y)]
                    same = doc[lo:lo + len(x)] == doc[lo + gap:lo + gap + len(x)]
                    x, y = x[same], y[same]
                    for k in range(NONZERO):
                        total += np.bincount(x * DIMS + cols[y, k], weights=signs[y, k], minlength=SLOTS * DIMS)
                        total += np.bincount(y * DIMS + cols[x, k], weights=signs[x, k], minlength=SLOTS * DIMS)
        table = total.reshape(SLOTS, DIMS).astype(np.int64)
        used = np.nonzero(table.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(table[used, d]) for d in range(DIMS)]],
                                         names=["slot", *[f"d{d}" for d in range(DIMS)]])

    sums = docs.select(text_of(text_col).alias("t")).mapInArrow(run, "slot int, " + ", ".join(f"d{d} long" for d in range(DIMS)))
    rows = sums.groupBy("slot").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS)]).collect()  # SLOTS rows at most
    out = np.zeros((SLOTS, DIMS))
    for r in rows:
        out[r["slot"]] = r[1:]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-9)).astype(np.float32)


def pool_documents(docs: DataFrame, vectors: np.ndarray, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` plus ``pooled``: mean and mean square of the word vectors, log length."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    src = docs.select(*columns, text_of(text_col).alias("__text"))

    def run(batches):
        table = shared.value
        wide = np.hstack([table, table * table])
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            slots, ends = unit_slots(as_strings(b.column("__text")))
            begins = np.concatenate([[0], ends[:-1]])
            out = np.zeros((n, 2 * DIMS + 2), np.float32)
            for i in range(n):
                s = slots[begins[i]:ends[i]]
                if len(s):
                    count = np.bincount(s, minlength=SLOTS).astype(np.float32)
                    seen = np.nonzero(count)[0]
                    out[i, :2 * DIMS] = count[seen] @ wide[seen] / len(s)
                    out[i, -2], out[i, -1] = np.log1p(len(s)), len(seen) / len(s)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(list(out), pa.list_(pa.float32()))],
                                             names=[*columns, "pooled"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text")
    return src.mapInArrow(run, types + ", pooled array<float>")


@dataclass
class Network:
    mean: np.ndarray
    dev: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.dev) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, hidden: int = HIDDEN) -> Network:
    """Adam on the logistic loss; every fifth row is kept for the temperature."""
    rng = np.random.default_rng(1)
    if not len(x):
        return Network(np.zeros(1), np.ones(1), np.zeros((1, 1)), np.zeros(1), np.zeros(1), 0.0)
    apart = np.arange(len(x)) % 5 == 4
    xt, yt = x[~apart], y[~apart]
    net = Network(xt.mean(axis=0), xt.std(axis=0) + 1e-6, rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]),
                  np.zeros(hidden), rng.standard_normal(hidden) * np.sqrt(1 / hidden), 0.0)
    z = (xt - net.mean) / net.dev
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for lo in range(0, len(z), 256):
            idx = order[lo:lo + 256]
            a = z[idx] @ params[0] + params[1]
            h = np.maximum(a, 0)
            err = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -60, 60))) - yt[idx]) / len(idx)
            back = np.outer(err, params[2]) * (a > 0)
            grads = [z[idx].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ err + 1e-4 * params[2], np.array([err.sum()])]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= 0.003 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    net.b2 = float(params[3][0])
    if apart.any():
        logit, yc = net.logits(x[apart]), y[apart]
        grid = np.exp(np.linspace(-2.5, 2.5, 101))
        loss = [np.mean(np.logaddexp(0, logit / s) - yc * logit / s) for s in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", id_col: str = "doc_id",
                   label_col: str = "quality", fit_rows: int = FIT_ROWS, extra: dict | None = None) -> DataFrame:
    """One row per document: ``doc_id, score, predicted`` and ``extra`` columns.

    ``learn`` (on ``doc_id``) names the rows whose labels may be used.  Word vectors
    come from all texts.  Null and empty texts are scored from an all-zero pooled
    vector; rows without a usable label are only scored; repeated rows repeat their
    score; without any label every score is 0.5; an empty table gives no rows."""
    extra = extra or {}
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *[c.alias(n) for n, c in extra.items()],
                       F.col(f"`{text_col}`").alias("text"))
    vectors = word_vectors(base, "text")
    pooled = materialise(pool_documents(base, vectors, ["doc_id", *extra], "text"), "pooled")
    marks = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
             .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull()).where(learn)
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    train = (pooled.select("doc_id", "pooled").dropDuplicates(["doc_id"]).join(marks, "doc_id")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select("pooled", "y").collect())
    x = np.array([r["pooled"] for r in train], dtype=float).reshape(len(train), 2 * DIMS + 2)
    net = fit_network(x, np.array([r["y"] for r in train], dtype=float))
    known = bool(len(train))
    shared = spark.sparkContext.broadcast(net)
    keep = ["doc_id", *extra]

    def run(batches):
        n = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            score = (n.scores(np.stack(b.column("pooled").to_numpy(zero_copy_only=False)).astype(float)) if known
                     else np.full(b.num_rows, 0.5))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(score, pa.float64()),
                                              pa.array((score >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pooled.schema if f.name != "pooled")
    return pooled.mapInArrow(run, types + ", score double, predicted int")
