"""Quality rules: a learned decision list over document statistics.

Counts are taken from every whole text.  Sequential covering learns an ordered list
of rules from labelled rows: a rule is grown as a conjunction of thresholds by the
gain of information over the rejected rows that no earlier rule covers, pruned on
rows kept apart, accepted if it is precise there, and the rows it covers are taken
away before the next one grows.  The list is emitted as one Spark conditional
expression over the statistics, so that scoring needs no Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, text_of
from .words import as_strings, split_words

WINDOW = 8              # words in a repeated window
FIT_ROWS = 20_000       # labelled rows that the rules are learned from, at most
MAX_RULES, MAX_TERMS = 16, 4
MIN_COVER = 4           # rejected rows that a rule must cover where it grows
MIN_PRECISION = 0.9     # share of rejected rows among those a rule covers, on the rows kept apart
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits",
          "n_marks", "n_again"]
PATTERNS = {"n_symbols": r"[#*$%&|<>]", "n_upper": r"\p{Lu}", "n_digits": r"[0-9]", "n_marks": r"[!?]"}
WHITE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D

STATISTICS = {
    "n_words": ("n_words", None), "mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"), "again_share": ("n_again", "n_words")}


def statistic(name: str) -> Column:
    """A statistic as an expression over the count columns (0 where nothing is counted)."""
    part, whole = STATISTICS[name]
    if whole is None:
        return F.col(part).cast("double")
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def repeat_words(codes: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """True for every word inside a window of ``window`` words that its text holds twice or more.

    Windows are named exactly: pairs of words get numbers, then pairs of those, and so on."""
    n = len(codes) - window + 1
    out = np.zeros(len(codes), bool)
    if n <= 0:
        return out
    name, width = codes.astype(np.int64), 1
    while width < window:  # a power of two
        name = name[:len(name) - width] * (int(name.max()) + 1) + name[width:]
        name = np.unique(name, return_inverse=True)[1]
        width *= 2
    inside = np.flatnonzero(doc[:n] == doc[window - 1:])
    key = name[inside] * (int(doc[-1]) + 1) + doc[inside]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = inside[count[back] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:-1] > 0


def _count_batch(texts: pa.Array) -> dict[str, np.ndarray]:
    n = len(texts)
    codes, distinct, offsets = split_words(texts)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    words = pa.array(distinct, pa.string())

    def total(per_word):
        per_word = per_word.to_numpy(zero_copy_only=False).astype(np.int64) if len(distinct) else np.zeros(1, np.int64)
        return np.bincount(doc, weights=per_word[codes], minlength=n).astype(np.int64) if len(codes) else np.zeros(n, np.int64)

    out = {"n_words": np.diff(offsets), "word_chars": total(pc.utf8_length(words))}
    for name, pattern in PATTERNS.items():
        out[name] = total(pc.count_substring_regex(words, pattern))
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(texts.to_pylist()):
        own = [x for x in text.split("\n") if x.strip(WHITE)]
        lines[i], dups[i] = len(own), len(own) - len(set(own))
    out["n_lines"], out["n_dup_lines"] = lines, dups
    pair = np.unique(doc * (len(distinct) + 1) + codes)
    out["n_distinct"] = np.bincount(pair // (len(distinct) + 1), minlength=n)
    again = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    out["n_again"] = np.bincount(doc[1:][again], minlength=n)
    out["n_repeat_words"] = np.bincount(doc[repeat_words(codes, doc)], minlength=n)
    return out


def document_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and the counts of every row's whole text (null or empty: all zero)."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                found = _count_batch(as_strings(b.column(1)))
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(found[c].astype(np.int64)) for c in COUNTS]],
                                                 names=["doc_id", *COUNTS])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("t")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Term:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        stat = statistic(self.name)
        return stat > self.threshold if self.above else stat <= self.threshold

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.threshold if self.above else x[self.name] <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered conjunctions; a document that meets one is rejected by it, others are kept."""

    rules: list[tuple[Term, ...]] = field(default_factory=list)

    def column(self) -> Column:
        """The number (from 1) of the first rule that a row meets, null where none does."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            met = rule[0].column()
            for term in rule[1:]:
                met = met & term.column()
            out = F.when(met, i) if out is None else out.when(met, i)
        return F.lit(None).cast("int") if out is None else out.cast("int")

    def first_rule(self, x: dict[str, np.ndarray]) -> np.ndarray:
        """The same over numpy columns, 0 where no rule is met."""
        out = np.zeros(len(next(iter(x.values()))), int)
        for i, rule in enumerate(self.rules, 1):
            out[(out == 0) & _meets(rule, x)] = i
        return out

    def __str__(self) -> str:
        return "\n".join(f"{i}. reject if " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1)) + "\notherwise keep"


def _meets(rule, x) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for term in rule:
        out &= term.holds(x)
    return out


def _best_term(x: dict, bad: np.ndarray, at: np.ndarray) -> tuple[float, Term | None]:
    """The threshold with the greatest gain of information on the rows ``at``."""
    p0, n0 = int(bad[at].sum()), int((~bad[at]).sum())
    base = np.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for name, values in x.items():
        v = values[at]
        order = np.argsort(v, kind="stable")
        v, y = v[order], bad[at][order]
        cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
        if not len(cuts):
            continue
        p_low = np.cumsum(y)[cuts - 1]
        for above, p, n in ((False, p_low, cuts - p_low), (True, p0 - p_low, n0 - (cuts - p_low))):
            ok = p >= MIN_COVER
            if not ok.any():
                continue
            gain = np.where(ok, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - base), -1.0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, found = float(gain[i]), Term(name, above, float((v[cuts[i]] + v[cuts[i] - 1]) / 2))
    return best, found


def _grow(x: dict, bad: np.ndarray, left: np.ndarray) -> tuple[Term, ...]:
    rule: list[Term] = []
    at = np.flatnonzero(left)
    while len(rule) < MAX_TERMS and (~bad[at]).any():
        _, term = _best_term(x, bad, at)
        if term is None:
            break
        rule.append(term)
        at = at[term.holds({k: v[at] for k, v in x.items()})]
    return tuple(rule)


def _prune(rule: tuple[Term, ...], x: dict, bad: np.ndarray, left: np.ndarray) -> tuple[Term, ...]:
    """The shortest beginning of the rule with the best worth on the rows kept apart."""
    def worth(r):
        met = left & _meets(r, x)
        p, n = int((met & bad).sum()), int((met & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0
    options = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(options, key=lambda r: (worth(r), -len(r))) if options else rule


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray) -> DecisionList:
    """Sequential covering over numpy columns; every third row is kept apart for pruning."""
    found = DecisionList()
    apart = np.arange(len(bad)) % 3 == 2
    grow_x, prune_x = ({k: v[m] for k, v in x.items()} for m in (~apart, apart))
    grow_bad, prune_bad = bad[~apart], bad[apart]
    grow_left, prune_left = np.ones(len(grow_bad), bool), np.ones(len(prune_bad), bool)
    while len(found.rules) < MAX_RULES and (grow_left & grow_bad).sum() >= MIN_COVER and (grow_left & ~grow_bad).any():
        rule = _prune(_grow(grow_x, grow_bad, grow_left), prune_x, prune_bad, prune_left)
        if not rule:
            break
        met = prune_left & _meets(rule, prune_x)
        if not met.any() or prune_bad[met].mean() < MIN_PRECISION:
            break
        found.rules.append(rule)
        grow_left &= ~_meets(rule, grow_x)
        prune_left &= ~met
    return found


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def learn_rules(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                fit_rows: int = FIT_ROWS) -> DecisionList:
    """A decision list from the labelled rows of ``counts`` (label 0: reject) that pass the base rules.

    At most ``fit_rows`` labelled rows are used, chosen by a hash of the id; rows without a
    label or an id teach nothing; without rows of both labels the list is empty."""
    marks = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
             .where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y")))
    stats = counts.where(~base_failed()).select("doc_id", *[statistic(s).alias(f"s{i}") for i, s in enumerate(STATISTICS)])
    one = stats.groupBy("doc_id").agg(F.min(F.struct(*stats.columns[1:])).alias("s"))
    rows = (one.join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select("s.*", "y").collect())
    x = {s: np.array([r[i] for r in rows], float) for i, s in enumerate(STATISTICS)}
    return learn_list(x, np.array([r["y"] < 0.5 for r in rows], bool))


def quality_rules(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
                  fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed, kept`` and ``rule`` (the first
    learned rule it meets, null where none).

    Null and empty texts have no words and fail the base rules; repeated rows repeat their
    result; other columns are ignored; an empty table gives no rows; without labels only the
    base rules speak."""
    counts = materialise(document_counts(docs, text_col, id_col), "counts")
    rules = learn_rules(counts, labels, id_col, label_col, fit_rows)
    return (counts.withColumns({"base_failed": base_failed(), "rule": rules.column()})
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
            .select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule", *COUNTS[5:]))
