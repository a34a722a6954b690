from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewright.llm import boosting
from framewright.llm.language import LANGUAGES, train_network
from framewright.llm.queries import p10_errors, p10_profile
from framewright.llm.reading import errors_by_source, fit_levels, grade_documents, measures, shared_measures

EASY = ["The dog ran home.", "Mom made tea.", "He saw the ring.", "It was cold.", "She shut the gate."]
MIDDLE = ["The older brother hides the letter because nobody believed the story.", "The driver follows the stranger to the harbor after a long talk.", "When the guests arrive she plans a surprise for the banquet."]
HARD = ["The dissimulation of the dynasty, whose intergenerational authority had been inadequately scrutinized, destabilizes the evidentiary status of documents.", "It is precisely this disproportionate legitimation, together with an otherwise conventional apparatus, which problematizes verisimilitude."]


def test_trees():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 5))
    y = np.where(x[:, 1] > 0.3, 2.0, 0.0) + np.sin(2 * x[:, 3])
    m = boosting.fit(x[:400], y[:400])
    assert np.mean((boosting.predict(m, x[400:]) - y[400:]) ** 2) < 0.1 * y.var()
    knots, levels = boosting.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 4]))
    assert list(np.interp([1, 4], knots, levels)) == [1, 4] and (np.diff(levels) >= 0).all()


SPANISH = ("El perro corre. Mamá hizo té. Él vio el anillo. Hacía frío. Ella no vino. ", "La legitimación desproporcionada de la dinastía, cuya autoridad intergeneracional no había sido examinada adecuadamente, desestabiliza el estatuto probatorio de los documentos que los protagonistas recuperaron. ")
CHINESE = ("狗跑了。妈妈来了。他不说。天很冷。", "王朝合法性叙事结构之内在矛盾，由于跨世代权威关系缺乏充分审查，从而动摇了文献证据地位，并且消解了观众对历史真实性的期待。")


@pytest.fixture(scope="module")
def net():
    bank = {"en": [*EASY, *MIDDLE, *HARD, "The cook told a lie.", "She went home with the dog."], "es": [*SPANISH[0].strip().split(". "), *SPANISH[1].split(", "), "Mi madre guardó el sello hasta que el abogado lo quemó."], "zh": [*CHINESE[0].split("。")[:-1], *CHINESE[1].split("，")]}
    rnd = np.random.default_rng(2)
    rows = [(k, ". ".join(x.strip(".") for x in rnd.choice(bank[lang], 4)) + ".", lang) for k in range(300) for lang in [list(bank)[k % 3]]]
    return train_network(pd.DataFrame(rows, columns=["k", "text", "lang"]), LANGUAGES)


def test_measures():
    assert np.isfinite(measures("")).all() and np.isfinite(measures("?? 12")).all() and np.isfinite(measures("a " * 50_000)).all()


def test_held_out(spark, net):
    rnd = np.random.default_rng(3)
    rows, grades, truth = [], [], {}
    for k in range(240):
        level = k % 3 + 1
        truth[k] = level
        rows.append((k, " ".join(rnd.choice((EASY, MIDDLE, HARD)[level - 1], 5)), "abcd"[k % 4], "x"))
        if k < 150:
            grades.append((k, level))
    rows += [(900, None, "a", "x"), (901, "  ", None, "x"), (902, "Mi madre guardó el sello hasta que el abogado lo quemó.", "a", "x"), (None, "no key at all", "a", "x"), rows[0]]
    grades += [(7, None), (12345, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k string").withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    got = {r.doc_id: r for r in grade_documents(docs, labels, "doc_id", "text", "lang", "source", "grade", net=net)[0].collect()}
    assert len(got) == 243 and all(got[k].level is None for k in (900, 901, 902))
    assert sum(round(got[k].level) == truth[k] for k in range(150, 240)) >= 85
    assert all(r.level is None for r in grade_documents(docs, labels.limit(0), "doc_id", "text", "lang", "source", "grade", net=net)[0].collect())
    assert grade_documents(docs.limit(0), labels, "doc_id", "text", "lang", "source", "grade", net=net)[0].count() == 0


def test_every_language(spark, net):
    assert shared_measures(["12:30 --- 77"], ["en"]) is None and np.isfinite(shared_measures(["你好，世界。", "a " * 9_000], ["zh", "fr"])).all()
    rnd = np.random.default_rng(4)
    rows = [(k, " ".join(rnd.choice((EASY, MIDDLE, HARD)[k % 3], 5)), "abcd"[k % 4]) for k in range(120)]
    grades = [(k, k % 3 + 1) for k in range(120)]
    rows += [(201, SPANISH[0], "a"), (202, SPANISH[1], "a"), (203, CHINESE[0], "a"), (204, CHINESE[1], "a"), (205, "12:30 ---", "a"), (206, " ", "a"), (207, None, "a"), (208, EASY[0] * 3 + "\n\n" + SPANISH[0], "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame(grades, "doc_id long, grade int")
    got, english = ({r.doc_id: r for r in grade_documents(docs, labels, "doc_id", "text", "lang", "source", "grade", every=e, net=net)[0].collect()} for e in (True, False))
    assert {k for k, r in got.items() if r.level is None} == {206, 207}
    assert got[202].level > got[201].level + 0.5 and got[204].level > got[203].level + 0.5 and got[205].level == 1
    assert all(got[k] == english[k] for k in range(120)) and not any(got[k].english for k in range(201, 209))


def test_profile_has_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = p10_profile(spark, sf_dir).collect()
    assert sum(r.n_docs for r in got) == docs.count()
    assert sum(r.n_level_1 + r.n_level_2 + r.n_level_3 for r in got) == docs.filter(r"text rlike '[^\s\uFEFF]'").count()


def test_the_level_is_calibrated_and_its_error_known(spark, sf_dir, net):
    docs = spark.createDataFrame([(k, " ".join((EASY, MIDDLE, HARD)[k % 3]), None, "ab"[k % 2]) for k in range(60)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(k, k % 3 + 1) for k in range(60)], "doc_id long, grade int")
    graded, model = grade_documents(docs, labels, "doc_id", "text", "lang", "source", "grade", net=net)
    for r in graded.filter("english").collect():
        assert r.level == pytest.approx(float(np.clip(np.interp(r.raw_level, model["knots"], model["levels"]), 1, 3)))
    assert [(s, n) for s, n, _, _ in errors_by_source(model)] == [("a", 30), ("b", 30)] and errors_by_source(None) == []
    assert fit_levels(docs, labels.limit(0), "doc_id", "text", "source", "grade") is None
    assert p10_errors(spark, sf_dir).columns == ["source", "n_graded", "mean_error", "share_right"]
