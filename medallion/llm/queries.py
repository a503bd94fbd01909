"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (conversation_repair, conversation_trie, embedding_itq, exact_dedup, langid, license_rules, line_dedup, packing,
               piece_merges, quality_net, quality_rules, secret_forest, sentencepiece_scan, simhash_bytes)
from .common import fold_of, table

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    return public_tokenizers.path(name)


def _unsigned_hex(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def op1_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_sentencepiece(spark, sf_dir):
    model = tokenizer_file(PIECE_BPE)
    encoded = piece_merges.encode(table(spark, sf_dir, "documents"), model)
    return sentencepiece_scan.decode(encoded, model).select(
        "doc_id", "chunk", "n_chars", (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


def op3_embedding_near_dedup(spark, sf_dir):
    return embedding_itq.embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark, sf_dir):
    held = F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False))
    return quality_net.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                      learn=fold_of("doc_id", 3) != 1, extra={"held_out": held}).select(
        "doc_id", "held_out", "score", "predicted")


def op5_license_scan(spark, sf_dir):
    found = license_rules.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", " ").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs, learn=fold_of("doc_id", 5) != 0)
    held = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return langid.predict_languages(docs.select("doc_id", "text", held), model).select(
        "doc_id", "held_out", "lang_pred", "score", "lang_rejected")


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir):
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def op9_secret_scan(spark, sf_dir):
    found = secret_forest.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "position", "part", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                        "score", "is_secret")


def op10_simhash_near_dedup(spark, sf_dir):
    return simhash_bytes.simhash_near_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", _unsigned_hex("fp").alias("fingerprint"), "component_id")


def op11_conversation_trie(spark, sf_dir):
    """Conversations rebuilt on the first turns of their group of five."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"), base=F.expr("conv_id - conv_id % 5"),
                                         head=F.expr("crc32(cast(conv_id as string)) % 9"))


def damaged_conversations(convs):
    """``conversations`` with the contract's damage; dropped rows stay with ``present`` false."""
    blank = F.lit(" ")
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = convs.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place.cast("binary")) % 20).alias("k"))
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("k") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark, sf_dir):
    rows = damaged_conversations(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_report(rows, present=F.col("present"))


def op13_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", *quality_rules.COUNTS[:5], "base_failed", "kept", "rule")


EMBEDDING_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(vec_id, reach) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON v.vec_id = c.vec_id LEFT JOIN n ON v.vec_id = n.a
"""

EXACT_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS h
           FROM documents),
g AS (SELECT h, count(*) AS group_size, max(n) AS top FROM t GROUP BY h),
k AS (SELECT t.h, min(t.doc_id) AS keep_id FROM t JOIN g ON t.h = g.h AND t.n = g.top GROUP BY t.h)
SELECT t.doc_id, k.keep_id, g.group_size, t.doc_id = k.keep_id AS kept, t.h AS text_sha256
FROM t JOIN g ON t.h = g.h JOIN k ON t.h = k.h
"""



def _license_sql() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in license_rules.known_sentences())
    named: dict = {}
    for name, seq in license_rules.RULES:
        named.setdefault(name, []).append(f"regexp_matches(' ' || ids || ' ', ' {' ([^ ]+ )*?'.join(seq)} ')")
    rules = ", ".join(f"CASE WHEN {' OR '.join(tests)} THEN '{name}' END" for name, tests in named.items())
    return f"""
WITH d AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[.!?]+([\\x20\\x09-\\x0D]|$)',
                                                      chr(10) || '\\1', 'g'), chr(10)) AS a FROM documents),
s AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM d),
k AS (SELECT * FROM (VALUES {known}) AS v(sentence, id)),
h AS (SELECT s.doc_id, string_agg(k.id, ' ' ORDER BY s.i) AS ids
      FROM s JOIN k ON trim(regexp_replace(s.x, '[^a-z0-9]+', ' ', 'g')) = k.sentence GROUP BY s.doc_id)
SELECT d.doc_id, coalesce(h.ids, '') AS sentence_ids, CASE WHEN ids IS NULL THEN '' ELSE concat_ws(',', {rules}) END AS licenses
FROM d LEFT JOIN h ON d.doc_id = h.doc_id
"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_license_scan": op5_license_scan,
    "op6_language_id": op6_language_id,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_quality_rules": op13_quality_rules,
}
ORACLES = {"op3_embedding_near_dedup": EMBEDDING_SQL, "op5_license_scan": _license_sql(), "op7_exact_dedup": EXACT_SQL}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
