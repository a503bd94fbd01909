"""License scans and secret scans."""
import random
import re

from pyspark.sql import functions as F

from medallion.llm import license_rules as lr
from medallion.llm import secret_forest as sf
from medallion.llm.queries import op5_license_scan, op9_secret_scan

from .common import documents, empty, simple, words

SMALL = "/root/testdata/sf0.01"


def no_python(df):
    return not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_license_rules_need_their_sentences_in_order(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    asis = 'The software is provided "as is", without warranty of any kind!'
    got = {r.doc_id: r.licenses for r in lr.scan_licenses(simple(spark, [
        f"{grant}\nwords between. {notice} {asis}", f"{asis} {notice} {grant}", "Licensed under the   APACHE License, version 2.0.",
        "All rights reserved", "not all rights reserved here", "Released under the MIT License. All rights reserved."])).collect()}
    assert got == {0: ["MIT-text"], 1: [], 2: ["Apache-2.0"], 3: ["all-rights-reserved"], 4: [], 5: ["MIT", "all-rights-reserved"]}


def test_licenses_on_edge_rows_and_empty(spark):
    got = lr.scan_licenses(documents(spark))
    assert got.count() == documents(spark).count() and {tuple(r.licenses) for r in got.collect()} == {()}
    assert lr.scan_licenses(empty(spark)).count() == 0
    assert no_python(op5_license_scan(spark, SMALL))


def secret_texts():
    rng, out, true = random.Random(8), [], []
    for i in range(120):
        kind, body = i % 4, words(rng, 30)
        hexa = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        aws = "AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16))
        card = "".join(rng.choice("0123456789") for _ in range(16))
        value = [aws, hexa, card, None][kind]
        out.append(f"{body} " + ["%s" % aws, f'token = "{hexa}"', card, "plain"][kind] + f" {words(rng, 5)}")
        true.append((value, kind in (0, 1)))
    return out, true


def test_forest_separates_secrets_from_numbers(spark):
    texts, true = secret_texts()
    got = {r.value: r.is_secret for r in sf.scan_secrets(simple(spark, texts)).collect()}
    want = {v: s for v, s in true if v}
    assert set(got) == set(want)
    assert got == want


def test_masking_keeps_every_row_and_changes_secrets_only(spark):
    texts, true = secret_texts()
    docs = simple(spark, texts + [None, "", texts[0]])
    out = sf.mask_secrets(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(texts) + 3
    for i, (t, (v, s)) in enumerate(zip(texts, true)):
        assert rows[i].text == (t.replace(v, sf.MASK) if s else t)
        assert rows[i].n_chars == len(rows[i].text)
    assert rows[len(texts)].text is None


def test_given_labels_override_the_seed(spark):
    texts, _ = secret_texts()
    docs = simple(spark, texts)
    values = sf.find_candidates(docs).select("value").distinct()
    flipped = values.select("value", F.when(F.col("value").rlike("^[0-9]+$"), 1).otherwise(0).alias("label"))
    got = {r.value: r.is_secret for r in sf.scan_secrets(docs, labelled=flipped).collect()}
    assert all(s == v.isdigit() for v, s in got.items())


def test_labels_of_one_class_and_edge_rows(spark):
    got = {r.value: r.is_secret for r in sf.scan_secrets(simple(spark, ["x password=f00dbeefcafe1234ab y"])).collect()}
    assert got == {"f00dbeefcafe1234ab": True}
    docs = documents(spark)
    assert sf.scan_secrets(docs).count() == 0
    assert sf.mask_secrets(docs).count() == docs.count()
    assert sf.scan_secrets(empty(spark)).count() == 0 and sf.mask_secrets(empty(spark)).count() == 0


def test_secret_scan_is_native(spark):
    got = op9_secret_scan(spark, SMALL)
    assert no_python(got)
    assert got.where("is_secret").count() > 0
