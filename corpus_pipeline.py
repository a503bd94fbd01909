"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, secret scans, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import exact_dedup, langid, packing, secret_forest, simhash_bytes
from medallion.llm.common import fold_of, materialise
from medallion.llm.queries import WORD_BPE, tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the centroids recognise; rejected ones go."""
    model = langid.fit_languages(docs, learn=fold_of("doc_id", 5) != 0)
    found = langid.predict_languages(docs, model)
    return found.where(~F.col("lang_rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash_bytes.drop_near_duplicates(docs, shingle=3, max_bits=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets that the forest confirms masked."""
    return secret_forest.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    pieces = packing.pack(docs, tokenizer_file(WORD_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("secret_scan", secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage_{name}")
    return docs


# language ID, SimHash and tokenisation are beyond SQL; tests hold it against a brute-force run
ORACLE_SQL = None
