"""Language ID by the nearest of several clustered centroids per language.

A text becomes a vector of hashed byte 2-grams and 3-grams of its lower-cased
letters, weighted (1 + log tf) * idf and normalised.  Each language has several
centroids (spherical k-means); the text takes the language of the centroid with
the highest cosine, and is rejected when it is farther from that centroid than
the centroid's own limit, which is set on learning rows kept out of the clustering.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, prepare, text_of

DIM = 4096
# Vectors used to fit the centroids and their limits, all languages together.
# Document frequencies are counted over every learning row; only this samples.
FIT_ROWS = 2400
CENTROIDS = 3
HELD_EVERY = 4      # every fourth sampled row sets limits and is not clustered
# A text is rejected below a multiple of the 1st percentile of the reach (see
# `reach`) of its centroid's rows held out of the clustering: the first for texts
# of up to 100 distinct n-grams, which one key or number can fill, the second from
# 300 on, rising evenly between.
REJECT_FACTORS = (0.4, 0.65)
FEW, MANY = 100, 300
REPEATS = 8         # an n-gram is expected to come this often at most
LETTER = regex.compile(r"\p{L}")

_SPACE = np.arange(256, dtype=np.uint8)
_SPACE[[i for i in range(128) if not chr(i).isalpha()]] = 32


def gram_counts(texts: pa.Array, dim: int = DIM) -> np.ndarray:
    """Counts of the hashed n-grams, one row per text (whole texts)."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")).cast(pa.large_binary())
    n = len(low)
    lengths = pc.binary_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    if not n or not lengths.sum():
        return np.zeros((n, dim), np.int64)
    data = np.frombuffer(b"".join(low.to_pylist()), dtype=np.uint8)
    out = np.zeros(n * dim, np.int64)
    ends = np.cumsum(lengths)
    step = 1 << 20
    for lo in range(0, len(data), step):  # bounded temporaries for very long texts
        a = _SPACE[data[lo:lo + step + 2]].astype(np.uint32)
        m = min(step, len(data) - lo)
        row = np.searchsorted(ends, np.arange(lo, lo + m), side="right")
        left = ends[row] - np.arange(lo, lo + m)
        for size in (2, 3):
            k = min(m, len(a) - size + 1)
            if k <= 0:
                continue
            code = a[:k] * np.uint32(0x9E3779B1) + a[1:k + 1] * np.uint32(0x85EBCA77)
            if size == 3:
                code = code * np.uint32(31) + a[2:k + 2] * np.uint32(0xC2B2AE3D)
            code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
            inside = left[:k] >= size
            out += np.bincount((row[:k] * dim + code % dim)[inside], minlength=n * dim)
    return out.reshape(n, dim)


def term_weights(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0).astype(np.float32)


def unit(weights: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = weights * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(term_weights(counts), idf)


def reach(cosine: np.ndarray, distinct: np.ndarray, total: np.ndarray, typical: np.ndarray) -> np.ndarray:
    """The cosine over the part of a centroid that so many n-grams can cover: a short
    text holds few of its language's n-grams, however typical they are, and a long
    one that repeats a few has no such excuse."""
    covered = np.maximum(distinct, np.minimum(total, typical) / REPEATS)
    return cosine / np.sqrt(np.clip(covered / typical, 1e-9, 1.0))


@dataclass
class LanguageModel:
    """Everything a prediction needs; its size depends on parameters only."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limit: np.ndarray    # 1st percentile of the held-out rows' reach
    typical: np.ndarray  # distinct n-grams of the fitting rows, median
    factors: tuple = REJECT_FACTORS

    def predict(self, texts: pa.Array):
        n = len(texts)
        lang, score, rejected = np.full(n, "und", dtype=object), np.zeros(n), np.ones(n, dtype=bool)
        has = np.array([bool(t) and LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
        if n and has.any() and len(self.centroids):
            counts = gram_counts(texts)
            sims = weigh(counts, self.idf) @ self.centroids.T
            best = sims.argmax(axis=1)
            top = sims[np.arange(n), best]
            names = np.array(self.languages, dtype=object)[self.owner[best]]
            lang = np.where(has, names, "und")
            score = np.where(has, np.clip(top, 0.0, 1.0), 0.0).astype(float)
            distinct = (counts > 0).sum(axis=1)
            far = reach(top, distinct, counts.sum(axis=1), self.typical[best])
            factor = np.interp(distinct, (FEW, MANY), self.factors)
            rejected = ~has | (far < factor * self.limit[best])
        return lang, score, rejected


def _document_frequencies(train: DataFrame, dim: int):
    def run(batches):
        df, n = np.zeros(dim, np.int64), 0
        for b in batches:
            df += (gram_counts(b.column("text"), dim) > 0).sum(axis=0)
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dim, dtype=np.int32)),
                                          pa.array(np.concatenate([[n], df]))], names=["dim", "df"])

    rows = train.select("text").mapInArrow(run, "dim int, df long").groupBy("dim").agg(F.sum("df").alias("df")).collect()
    got = {r["dim"]: r["df"] for r in rows}  # dim + 1 rows at most
    return np.array([got.get(i, 0) for i in range(dim)], float), got.get(-1, 0)


def _cluster(x: np.ndarray, k: int, rng: np.random.Generator):
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(15):
        own = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (own == j).any():
                m = x[own == j].mean(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-9)
    return c, (x @ c.T).argmax(axis=1)


def fit_languages(docs: DataFrame, learn: Column | None = None, lang_col: str = "lang", text_col: str = "text",
                  id_col: str = "doc_id", fit_rows: int = FIT_ROWS, per_language: int = CENTROIDS,
                  reject_factors: tuple = REJECT_FACTORS, dim: int = DIM) -> LanguageModel:
    """Learn from the rows where ``learn`` holds and ``lang`` is not null."""
    prepare(docs.sparkSession)
    train = docs.where(F.col(f"`{lang_col}`").isNotNull() & text_of(text_col).rlike(r"\p{L}"))
    if learn is not None:
        train = train.where(learn)
    train = train.select(F.col(f"`{lang_col}`").alias("lang"), text_of(text_col).alias("text"),
                         F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1_000_000)).alias("h"))
    df, n = _document_frequencies(train, dim)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], idf, np.zeros((0, dim), np.float32), np.zeros(0, int), np.zeros(0), np.zeros(0), reject_factors)
    quota = max(8, fit_rows // len(sizes))
    pick = F.lit(False)
    for lang, size in sizes.items():
        pick = pick | ((F.col("lang") == lang) & (F.col("h") < int(1_000_000 * quota / size) + 1))

    def run(batches):
        for b in batches:
            c = gram_counts(b.column("text"), dim)
            w = term_weights(c).astype("<f4")
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("h"), pa.array([r.tobytes() for r in w], pa.binary()),
                                              pa.array(c.sum(axis=1))], names=["lang", "h", "v", "total"])

    sample = (train.where(pick).select("lang", "h", "text").mapInArrow(run, "lang string, h long, v binary, total long")
              .orderBy("h", "lang", "v").limit(2 * fit_rows).collect())
    languages, rng = sorted(sizes), np.random.default_rng(7)
    cents, owner, limit, typical = [], [], [], []
    for i, lang in enumerate(languages):
        mine = [r for r in sample if r["lang"] == lang]
        if not mine:
            continue
        weights = np.stack([np.frombuffer(r["v"], "<f4") for r in mine])
        total = np.array([r["total"] for r in mine])
        held = np.arange(len(mine)) % HELD_EVERY == HELD_EVERY - 1
        x, distinct = unit(weights, idf), (weights > 0).sum(axis=1)
        c, own = _cluster(x[~held], per_language, rng)
        size = np.array([max(1.0, float(np.median(distinct[~held][own == j]))) if (own == j).any() else 1.0 for j in range(len(c))])
        check = held if held.any() else ~held
        sims = x[check] @ c.T
        near = sims.argmax(axis=1)
        far = reach(sims.max(axis=1), distinct[check], total[check], size[near])
        for j in range(len(c)):
            # a centroid that few held-out rows reach takes the language's limit
            rows = far[near == j] if (near == j).sum() >= 20 else far
            cents.append(c[j])
            owner.append(i)
            typical.append(size[j])
            limit.append(float(np.percentile(rows, 1)))
    return LanguageModel(languages, idf, np.array(cents, np.float32), np.array(owner), np.array(limit), np.array(typical),
                         reject_factors)


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred, score, lang_rejected`` in place of columns of those names.

    Null text and text without a letter: ``und``, score 0, rejected.  Very long
    texts are read whole; repeated rows get equal answers; with nothing learned
    every row is ``und``."""
    prepare(docs.sparkSession)
    new = ["lang_pred", "score", "lang_rejected"]
    (whole,) = free_names(docs, "text")
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).withColumn(whole, text_of(text_col))
    rest = [c for c in base.columns if c != whole]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            lang, score, rejected = m.predict(b.column(whole))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in rest], pa.array(lang.tolist(), pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected)], names=rest + new)

    schema = base.drop(whole).schema.add("lang_pred", "string").add("score", "double").add("lang_rejected", "boolean")
    return base.mapInArrow(run, schema)
