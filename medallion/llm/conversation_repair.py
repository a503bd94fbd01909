"""Conversation structure repair by weighted CYK parsing over spans.

A valid conversation's role initials match ``(s?(ua)+)?``.  The repair grammar in
Chomsky normal form has one symbol ``X(i,j)`` for every pair of states of that
expression: a span of rows derives ``X(i,j)`` by edits that lead from state i to
state j.  A terminal rule covers one row (Keep, Rerole or Delete) with any
insertions before and after it (the insertion closure); a binary rule
``X(i,j) -> X(i,k) X(k,j)`` joins two neighbouring spans.  A cell holds the least
``(cost, audit)`` of a symbol over a span, the audit being the edits' initials.

Cells are combined bottom-up by span length.  As the symbols are pairs of states,
every split of a span gives the same cells, so each span is built from one split:
spans of two rows from rows, of four from two, and so on, a span's cells once per
distinct sequence of row kinds.  Equal costs never leave one audit a prefix of
another (the longer one would have paid for more insertions), so the least audit of
a joined span is the join of least audits.

A conversation passes through its task twice in one sorted stream: first one byte a
row, from which the repair is found, then the texts, which are written or hashed as
they come; no conversation's text is held.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_BYTES, prepare

WHITE = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D
INITIALS = "sua"           # row kind = 4 * (place here, or 3) + fault
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
ABSENT = 255               # a row that only says that its conversation exists
LEGAL = {(0, 1), (1, 2), (2, 1)}
START, FINAL, STATES = 0, (0, 3), 4
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
KEEP, REROLE, DELETE, INSERT, INCOMPLETE = 0, 2, 3, 2, 1
MEMO_ROWS, MEMO_SPANS = 16, 200_000

REPORT_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                 "repaired_sha256 string")
TURNS_SCHEMA = "conv_id long, place long, edit string, role string, text string"


def _better(cells: list, i: int, j: int, cost: int, audit: str) -> None:
    at = i * STATES + j
    if cells[at] is None or (cost, audit) < cells[at]:
        cells[at] = (cost, audit)


def join_cells(left: tuple, right: tuple) -> tuple:
    """The cells of two neighbouring spans taken as one."""
    out: list = [None] * (STATES * STATES)
    for i in range(STATES):
        for k in range(STATES):
            a = left[i * STATES + k]
            if a is None:
                continue
            for j in range(STATES):
                b = right[k * STATES + j]
                if b is not None:
                    _better(out, i, j, a[0] + b[0], a[1] + b[1])
    return tuple(out)


def _closure() -> tuple:
    """Cells of the empty span: insertions only."""
    cells: list = [None] * (STATES * STATES)
    for i in range(STATES):
        cells[i * STATES + i] = (0, "")
    one = list(cells)
    for role in "ua":
        for i, j in STEPS[role].items():
            _better(one, i, j, INSERT, "I")
    for _ in range(STATES):
        cells = join_cells(tuple(cells), tuple(one))
    return tuple(cells)


def _row_cells(kind: int) -> tuple:
    cells: list = [None] * (STATES * STATES)
    initial, fault = divmod(kind, 4)
    for i in range(STATES):
        _better(cells, i, i, DELETE, "D")
    if fault not in (BLANK, DUPLICATE):
        more = INCOMPLETE if fault == TRUNCATED else 0
        if initial < len(INITIALS):
            for i, j in STEPS[INITIALS[initial]].items():
                _better(cells, i, j, KEEP + more, "K")
        for role in "ua":
            for i, j in STEPS[role].items():
                _better(cells, i, j, REROLE + more, "R")
    return join_cells(join_cells(CLOSURE, tuple(cells)), CLOSURE)


CLOSURE = _closure()
ROW_CELLS = {kind: _row_cells(kind) for kind in range(16)}
_memo: dict[bytes, tuple] = {}


def span_cells(kinds: bytes) -> tuple:
    """Cells of a whole span of row kinds, built by doubling span lengths."""
    if not kinds:
        return CLOSURE
    level = [(kinds[i:i + 1], ROW_CELLS[kinds[i]]) for i in range(len(kinds))]
    while len(level) > 1:
        if len(_memo) > MEMO_SPANS:
            _memo.clear()
        above = []
        for at in range(0, len(level) - 1, 2):
            (a, x), (b, y) = level[at], level[at + 1]
            span = a + b if a is not None and b is not None and len(a) + len(b) <= MEMO_ROWS else None
            cells = _memo.get(span) if span is not None else None
            if cells is None:
                cells = join_cells(x, y)
                if span is not None:
                    _memo[span] = cells
            above.append((span, cells))
        if len(level) % 2:
            above.append(level[-1])
        level = above
    return level[0][1]


def repair(kinds: bytes) -> tuple[int, str]:
    """The least ``(cost, audit)`` that makes a conversation of these rows valid."""
    cells = span_cells(kinds)
    return min(c for j in FINAL if (c := cells[START * STATES + j]) is not None)


def _kind(role: Column, text: Column, again: Column) -> Column:
    body = F.rtrim(text, F.lit(WHITE))
    fault = (F.when(body == "", BLANK).when(again, DUPLICATE)
             .when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    initial = F.position(F.substring(role, 1, 1), F.lit(INITIALS)) - 1
    return F.when((F.length(role) > 0) & (initial >= 0), initial).otherwise(len(INITIALS)) * 4 + fault


def _stream(convs: DataFrame, present: Column | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Per conversation: its rows' kinds (``texted`` 0), then its rows with their texts (1)."""
    prepare(convs.sparkSession)
    blank = F.lit(" ")
    rows = convs.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`").cast("string"), blank).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), blank).alias("text"),
                        (F.lit(True) if present is None else present).alias("present"))
    # one exchange: the window and both sorts keep the partitioning by conversation
    first = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.repartition("conv_id").withColumn("again", F.row_number().over(first) > 1)
    kind = F.when(F.col("present"), _kind(F.col("role"), F.col("text"), F.col("again"))).otherwise(ABSENT)
    rows = rows.select("conv_id", "turn", "role", "text", "again", kind.cast("int").alias("kind"),
                       F.explode(F.when(F.col("present"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("texted"))
    return (rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "texted", F.col("turn").asc_nulls_first(), "role", "text", "again")
            .select("conv_id", "texted", "turn", "kind", *[F.when(F.col("texted") == 1, F.col(c)).alias(c) for c in ("role", "text")]))


class _Rewrite:
    """Replays a repair over a conversation's rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _written(self) -> str:
        """The role that a replaced or inserted row must have here."""
        role = "assistant" if self.state in STEPS["a"] else "user"
        self.state = STEPS[role[0]][self.state]
        return role

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._written(), ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[role[0]][self.state]
            yield edit, role, text
        elif edit == "R":
            yield edit, self._written(), text


class _Conversation:
    """One conversation in the stream: figures first, then its rewritten rows."""

    def __init__(self, conv_id):
        self.conv_id, self.kinds = conv_id, []
        self.cost, self.rewrite, self.sha, self.place = 0, None, hashlib.sha256(), 0
        self.low = self.high = None
        self.n_turns = 0

    def slim(self, turns: list, kinds: np.ndarray) -> None:
        self.kinds.append(kinds.astype(np.uint8).tobytes())
        for t in turns:
            if t is not None and t != self.high:
                self.n_turns += 1
                self.low = t if self.low is None else self.low
                self.high = t

    def solve(self) -> None:
        if self.rewrite is None:
            self.kinds = b"".join(self.kinds)
            self.cost, audit = repair(self.kinds) if self.kinds else (0, "")
            self.rewrite = _Rewrite(audit)

    def written(self, edits):
        for edit, role, text in edits:
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            self.sha.update(b"\n" + line if self.place else line)
            yield self.conv_id, self.place, edit, role, text
            self.place += 1

    def report(self) -> tuple:
        kinds = np.frombuffer(self.kinds, np.uint8)
        fault, initial = kinds % 4, (kinds // 4).tolist()
        counts = [int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)]
        illegal = sum(pair not in LEGAL for pair in zip(initial[:-1], initial[1:]))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.n_turns
        return self.conv_id, gaps, *counts, illegal, self.cost, self.rewrite.audit, self.sha.hexdigest()


_TYPES = {"long": pa.int64(), "string": pa.string()}


def _run(schema: str, whole: bool):
    fields = [(n, _TYPES[t]) for n, t in (c.split() for c in schema.split(", "))]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

    def run(batches):
        out, held, conv = [], 0, None

        def take(rows):
            nonlocal held
            for r in rows:
                if whole:
                    out.append(r)
                    held += 64 + len(r[4])

        def finish():
            nonlocal held
            conv.solve()
            take(conv.written(conv.rewrite.inserted()))
            if not whole:
                out.append(conv.report())
                held += 200 + len(conv.rewrite.audit)

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, texted = b.column(0).to_pylist(), b.column(1).to_numpy()
            turns = b.column(2).to_pylist()
            kinds = b.column(3).to_numpy()
            cuts = [0] + [i for i in range(1, n) if ids[i] != ids[i - 1] or texted[i] != texted[i - 1]] + [n]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if conv is None or ids[lo] != conv.conv_id:
                    if conv is not None:
                        finish()
                    conv = _Conversation(ids[lo])
                if texted[lo] == 0:
                    there = kinds[lo:hi] != ABSENT
                    conv.slim([t for t, p in zip(turns[lo:hi], there.tolist()) if p], kinds[lo:hi][there])
                else:
                    conv.solve()
                    for role, text in zip(b.column(4).slice(lo, hi - lo).to_pylist(), b.column(5).slice(lo, hi - lo).to_pylist()):
                        take(conv.written(conv.rewrite.row(role, text)))
                if held > BATCH_BYTES:
                    if out:
                        yield batch(out)
                    out.clear()
                    held = 0
        if conv is not None:
            finish()
        if out:
            yield batch(out)

    return run


def repair_report(convs: DataFrame, present: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256``.

    Rows are taken by turn (null first), equal turns by role, then text, repeated rows beside
    each other.  Null role or text counts as one space, an empty role can only be replaced or
    deleted; a null id is a conversation of its own.  Rows where ``present`` is false count
    for nothing but their conversation's existence: one with no other rows has zeros, an empty
    audit and the hash of the empty string.  Other columns are ignored; an empty table gives
    no rows."""
    src = _stream(convs, present, conv_col, turn_col, role_col, text_col)
    return src.mapInArrow(_run(REPORT_SCHEMA, whole=False), REPORT_SCHEMA)


def repaired_turns(convs: DataFrame, present: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations' rows: ``conv_id, place`` (from 0), ``edit`` (K, R or I),
    ``role, text``; deleted rows are gone.  Input as for ``repair_report``."""
    src = _stream(convs, present, conv_col, turn_col, role_col, text_col)
    return src.mapInArrow(_run(TURNS_SCHEMA, whole=True), TURNS_SCHEMA)
