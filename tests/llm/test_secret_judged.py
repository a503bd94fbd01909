"""The forest on judged forms that it did not learn from, and on look-alikes of secrets."""
import pytest
from pyspark.sql import functions as F

from medallion.llm import judged_forms as jf
from medallion.llm import secret_forest as sf
from medallion.llm.common import materialise

from .common import simple

SMALL = "/root/testdata/sf0.01"
HEXA = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"
HARMLESS = ["password=${DB_PASSWORD_1}", "password = os.environ['PGPASS2']", "api_key=YOUR_TOKEN_HERE_123", "secret_name=my-service-secret-v2",
            f"{HEXA}  sha256 of it, sha256 {HEXA}", "run 123e4567-e89b-12d3-a456-426614174000 as uuid", f"commit {HEXA[:40]}"]
SECRET = [("bearer %s", "8fK2mQ9xTz7LwPa3RbV6"), ('password: "%s"', "correct horse battery staple"), ("Authorization: Bearer %s", "b1946ac92492d2347c6235b4"),
          ("password = '%s'", "two  blanks and\ttabs")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


def test_every_judged_form_holds_one_candidate(spark):
    n = sf.find_candidates(jf.judged_documents(spark)).groupBy("doc_id").count()
    form = F.floor(F.col("doc_id") / jf.COPIES)
    assert [tuple(r) for r in n.agg(F.max("count"), F.count_distinct(form)).collect()] == [(1, len(jf.forms()))]


def test_precision_and_recall_on_forms_held_out(spark, docs):
    """Each form is scored by a forest that never saw it; all forms count."""
    words = materialise(sf.dictionary(docs), "dictionary")
    true = hits = secrets = 0
    for fold in range(4):
        held = {f for forms in (jf.SECRET, jf.HARMLESS) for i, f in enumerate(forms) if i % 4 == fold}
        forest = sf.fit_forest(sf.judged_findings(docs, words, lambda f: f not in held))
        rows = sf.score_findings(sf.judged_findings(docs, words, held.__contains__), forest).select("label", (F.col("score") >= 0.5).alias("hit")).collect()
        true += sum(r.hit and r.label == 1 for r in rows)
        hits += sum(r.hit for r in rows)
        secrets += sum(r.label == 1 for r in rows)
    assert true / hits >= 0.85 and true / secrets >= 0.95    # precision 0.90, recall 0.99 when written


def test_look_alikes_stay_and_phrases_go_whole(spark, docs):
    texts = HARMLESS + [f"wax {form % value} wbyy correct two" for form, value in SECRET]
    mine = simple(spark, texts).select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text")
    out = {r.doc_id - 10_000_000: r.text for r in sf.mask_secrets(docs.union(mine)).where("doc_id >= 10000000").collect()}
    assert [out[i] for i in range(len(HARMLESS))] == HARMLESS
    assert [out[len(HARMLESS) + i] for i in range(len(SECRET))] == [f"wax {form % sf.MASK} wbyy correct two" for form, _ in SECRET]


def test_phrases_open_long_and_repeated(spark):
    texts = ['password: "no end ' + "a b " * 50_000, 'token="' + "a " * 50_000 + '"', 'password="a b c d e" and password="a b c d e"', 'password=""', "password='  '"]
    got = {}
    for r in sf.find_candidates(simple(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.part, r.position, len(r.value)))
    assert got[1] == [(-1, 0, 99_999)] and got[2] == [(-1, 0, 9)]
    assert not {3, 4} & set(got)
