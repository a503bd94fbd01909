"""Small fixtures shared by the tests of the training-data operators."""
import random

CLASH = ["digest", "score", "component_id", "ids", "h", "key", "value", "kept", "rid", "fp", "t", "n", "chunk", "lang_pred"]
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              + ", ".join(f"{c} string" for c in CLASH))


def words(rng, n, vocab=60):
    return " ".join("w%s%s" % (rng.choice("abcdefgh"), "xyzuv"[rng.randrange(5)] * (1 + rng.randrange(vocab // 10))) for _ in range(n))


def edge_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    rng = random.Random(4)
    long_text = words(rng, 4000)
    base = words(rng, 200)
    texts = {1: base, 2: base, 3: base + "  ", 4: base.replace(" ", "\n"), 5: None, 6: "", 7: " \t\n", 8: "a", 9: "A",
             10: long_text, 11: long_text + " tail", 12: "Überall ☃ 日本 \U0001F388", 13: "1234 !!", None: "no id here at all",
             14: base + " z", 15: "x" * 5000}
    rows = [(i, t, None if i in (3, 5) else "en", None if i == 4 else "s", None if i == 6 else len(t or "")) for i, t in texts.items()]
    rows += [rows[0], rows[0]]  # repeated rows
    return [r + tuple("clash" for _ in CLASH) for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def simple(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def smallest_reachable(nodes, links):
    """Brute-force components: node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
