"""Conversation repair against a row-by-row shortest path and against full CYK over all splits."""
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from medallion.llm import conversation_repair as cr
from medallion.llm import queries as q

SCHEMA = "conv_id long, turn long, role string, text string, kind string, texted string, again string, place string, present string"
CLASH = ("x",) * 5
VALID = re.compile(r"(s?(ua)+)?")
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Dijkstra-like: best (cost, audit, lines) per (row, state), insertions relaxed in place."""
    best = {0: (0, "", ())}

    def insert(states):
        for _ in range(4):
            for s, (c, a, lines) in list(states.items()):
                for r in "ua":
                    if (s, r) in NEXT:
                        put(states, NEXT[s, r], (c + 2, a + "I", lines + ({"u": "user:", "a": "assistant:"}[r],)))

    def put(states, s, v):
        if s not in states or v[:2] < states[s][:2]:
            states[s] = v

    insert(best)
    for (role, text), mark in zip(rows, marks):
        new = {}
        for s, (c, a, lines) in best.items():
            put(new, s, (c + 3, a + "D", lines))
            if mark in ("blank", "duplicate"):
                continue
            extra = 1 if mark == "truncated" else 0
            if (s, role[:1]) in NEXT:
                put(new, NEXT[s, role[:1]], (c + extra, a + "K", lines + (f"{role}:{text}",)))
            for full in ("user", "assistant"):
                if (s, full[0]) in NEXT:
                    put(new, NEXT[s, full[0]], (c + 2 + extra, a + "R", lines + (f"{full}:{text}",)))
        insert(new)
        best = new
    return min((best[s] for s in (0, 3) if s in best), key=lambda v: v[:2])


def expected(original, rows):
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        by[c].append((t is not None, t or 0, role, text, t))
    out = []
    for c in {r[0] for r in original}:
        mine = sorted(by[c])
        if not mine:
            out.append((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
            continue
        pairs = [(r[2], r[3]) for r in mine]
        marks = faults(pairs)
        turns = {r[4] for r in mine} - {None}
        cost, audit, lines = cheapest(pairs, marks)
        initials = [p[0][:1] for p in pairs]
        assert VALID.fullmatch("".join(x[0] for x in lines))
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[marks.count(m) for m in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_all_short_sequences_against_every_split():
    def all_splits(kinds):
        table = {(i, i + 1): cr.ROW_CELLS[k] for i, k in enumerate(kinds)}
        for length in range(2, len(kinds) + 1):
            for i in range(len(kinds) - length + 1):
                options = {cr.join_cells(table[i, m], table[m, i + length]) for m in range(i + 1, i + length)}
                assert len(options) == 1  # every split gives the same cells
                table[i, i + length] = options.pop()
        return table[0, len(kinds)]
    rng = random.Random(1)
    for n in range(1, 7):
        for _ in range(40):
            kinds = bytes(rng.randrange(16) for _ in range(n))
            assert cr.span_cells(kinds) == all_splits(kinds)


def test_repairs_are_valid_and_least():
    roles = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
    for n in range(4):
        for kinds in itertools.product(range(16), repeat=n):
            rows = [(roles[k // 4], f"t{i}") for i, k in enumerate(kinds)]
            marks = [["", "blank", "duplicate", "truncated"][k % 4] for k in kinds]
            assert cr.repair(bytes(kinds)) == cheapest(rows, marks)[:2]


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "cut off", "", None, " \t\n", "Why?  ", "done.\n", "ü.", " ", "é"]) or ""
            rows.append((c, t + 2 * rng.randrange(2) if t else None if rng.random() < .2 else 0, role, text, *CLASH))
    rows += rows[:7] + [(n + 1, None, None, None, *CLASH), (None, 3, "user", "Hello.", *CLASH)]
    rows += [(n + 2, t, ["user", "assistant", "system"][t % 3 if t % 7 else 2], "text %d." % (t % 50), *CLASH) for t in range(3000)]
    rng.shuffle(rows)
    return rows


def test_report_and_turns_against_brute_force(spark):
    rows = sample(3, 120)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = expected(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows])
    assert found(cr.repair_report(df)) == want
    lines = defaultdict(list)
    for r in cr.repaired_turns(df).orderBy("conv_id", "place").collect():
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    sha = {w[0]: w[-1] for w in want}
    assert all(hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() == sha[c] for c in sha)
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(empty).collect() == [] and cr.repaired_turns(empty).collect() == []


def test_damaged_rows_against_brute_force(spark):
    rows = sample(9, 150)
    got = cr.repair_report(q.damaged_conversations(spark.createDataFrame(rows, SCHEMA)), present=F.col("present"))
    assert found(got) == expected(rows, damage(rows))


def test_query_on_the_given_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(q.queries()["op12_conversation_repair"](spark, sf_small)) == expected(rows, damage(rows))
