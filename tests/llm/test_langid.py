import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from medallion.llm import langid
from medallion.llm.common import fold_of
from medallion.llm.queries import op6_language_id

from .common import documents, empty

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op6_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and len(held) > 100
    assert (held.lang == held.lang_pred).mean() >= 0.98
    assert got.score.between(0, 1).all()
    assert got.lang_rejected.sum() == 0  # clean documents stay, short ones too


def test_edge_rows(spark):
    docs = documents(spark)
    model = langid.fit_languages(docs)
    got = langid.predict_languages(docs, model)
    assert set(docs.columns) <= set(got.columns)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count()
    for i in (5, 6, 7, 13):  # null, empty, white space, no letter
        assert (rows[i].lang_pred, rows[i].score, rows[i].lang_rejected) == ("und", 0.0, True)
    assert rows[1].lang_pred == rows[12].lang_pred == "en"


def test_empty_table_and_nothing_learned(spark):
    model = langid.fit_languages(empty(spark))
    assert langid.predict_languages(empty(spark), model).count() == 0
    assert {r.lang_pred for r in langid.predict_languages(documents(spark), model).collect()} == {"und"}


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, "abc def ghi" if i % 2 else "xyz uvw rst", "aa" if i % 2 else "bb") for i in range(200)],
                                 "doc_id long, text string, lang string")
    poisoned = docs.withColumn("lang", F.when(fold_of("doc_id", 5) == 0, F.lit("cc")).otherwise(F.col("lang")))
    assert langid.fit_languages(poisoned, learn=fold_of("doc_id", 5) != 0).languages == ["aa", "bb"]


def test_gram_counts_do_not_cross_texts_and_read_whole_texts():
    both = langid.gram_counts(pa.array(["ab", None, "cd", "x" * 3_000_000]))
    assert both[0].sum() == 1 and both[1].sum() == 0
    assert both[3].sum() == 2_999_999 + 2_999_998
    one = langid.gram_counts(pa.array(["cd"]))
    assert (both[2] == one[0]).all()


def test_far_texts_are_rejected():
    idf = np.ones(langid.DIM, np.float32)
    v = langid.weigh(langid.gram_counts(pa.array(["the cat sat on the mat"])), idf)
    m = langid.LanguageModel(["en"], idf, v, np.array([0]), np.array([0.2]), np.array([float((v > 0).sum())]))
    lang, score, rejected = m.predict(pa.array(["the cat on the mat", "qqqzzzxxx", "12"]))
    assert lang.tolist() == ["en", "en", "und"] and rejected.tolist() == [False, True, True] and score[0] > 0.5


FOREIGN = [  # languages that the table does not hold, filler, tags, digits and one letter
    "Suomi on tasavalta Pohjois-Euroopassa ja sen pääkaupunki on Helsinki. Maassa puhutaan suomea ja ruotsia, ja siellä on paljon "
    "järviä sekä metsiä. Kesällä päivät ovat pitkiä ja talvella lyhyitä, ja monet viettävät lomansa mökillä veden äärellä.",
    "Türkiye Cumhuriyeti topraklarının büyük bölümü Anadolu'da bulunan bir ülkedir. Başkenti Ankara ve en kalabalık şehri İstanbul'dur.",
    "Polska jest państwem położonym w Europie Środkowej. Stolicą kraju jest Warszawa, a językiem urzędowym jest język polski.",
    "<div><p><span></span></p></div>" * 60, "0123456789abcdef" * 175, "x" * 5000]


def test_languages_that_were_not_learned_are_rejected_and_every_clean_text_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit_languages(docs, learn=fold_of("doc_id", 5) != 0)
    assert model.predict(pa.array(FOREIGN))[2].all()
    assert langid.predict_languages(docs, model).where("lang_rejected").count() == 0
