"""Columns named like the operators' helpers pass through unchanged."""
from medallion.llm import exact_dedup, langid, secret_forest, simhash_bytes
from medallion.llm.common import fold_of

NAMES = ["__values", "__sid", "__shash", "__id", "__thash", "__masked", "__digest", "__chars", "__text", "__k___id"]


def test_helper_names_do_not_clash(spark):
    key = "aws_secret_access_key = wJalrXUtnFEMIK7MDENGbPxRfiCYzzKQ8dTq9sLp"
    names = NAMES
    rows = [(i, t, "en", "s", len(t), *[f"{n}{i}" for n in names]) for i, t in enumerate(
        ["the same text here", "the same  text here", key + " and some words", "another text with words"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` string" for n in names))
    for out in (exact_dedup.drop_exact_duplicates(docs), simhash_bytes.drop_near_duplicates(docs), secret_forest.mask_secrets(docs)):
        assert out.columns == docs.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)
    found = langid.predict_languages(docs, langid.fit_languages(docs, learn=fold_of("doc_id", 5) != 0))
    assert all(r["__text"] == f"__text{r.doc_id}" for r in found.collect())
