"""Language and toxicity: held-out accuracy, calibration, and odd input."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, linear, ngrams, toxicity

SYLLABLES = {"en": "the and ing tion er wh sh of".split(), "de": "sch ung keit der über ach ein".split(), "fr": "eau ç tion é qu oi les aux".split()}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.choice((1, 2, 3)))) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(1)
    return [(i, text(rng, lang := rng.choice(list(SYLLABLES))), lang, "src0") for i in range(600)]


SCHEMA = "doc_id long, text string, lang string, source string"
ODD = [(9001, None, "en", "s"), (9002, "", "en", "s"), (9003, "123 !!", "de", "s"), (9004, "the wh " * 100_000, None, "s"), (None, "sch ung", "de", "s")]


@pytest.fixture(scope="module")
def model(spark, documents):
    docs = spark.createDataFrame(documents + ODD, SCHEMA)
    return langid.fit(langid.training_rows(docs), "doc_id", "text", "lang")


def test_held_out_accuracy_and_odd_rows(spark, documents, model):
    docs = spark.createDataFrame(documents + ODD, SCHEMA)
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    held = [(i, lang) for i, _, lang, _ in documents if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([found[i].lang_pred == lang for i, lang in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (9001, 9002, 9003)] == ["und"] * 3 and found[9004].lang_pred == "en"


def test_held_out_rows_are_never_learned_from(spark, documents):
    docs = spark.createDataFrame(documents, SCHEMA)
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "xx").otherwise(F.col("lang")))
    assert "xx" not in langid.fit(langid.training_rows(wrong), "doc_id", "text", "lang").languages


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None, "s")], SCHEMA)
    model = langid.fit(docs, "doc_id", "text", "lang")
    assert langid.predict(docs, model).first().lang_pred == "und"
    assert langid.predict(docs.limit(0), langid.fit(docs.limit(0), "doc_id", "text", "lang")).collect() == []


def test_keep_leaves_columns(spark, documents, model):
    docs = spark.createDataFrame(documents + ODD, SCHEMA)
    kept = langid.keep(docs, model)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & {d[0] for d in documents}) >= 0.98 * len(documents) and not ids & {9001, 9002, 9003}


@pytest.fixture(scope="module")
def labelled(documents):
    rng = random.Random(2)
    docs, labels = [], []
    for i, t, lang, source in documents * 2:
        k = len(docs)
        toxic, poor = rng.random() < 0.2, rng.random() < 0.2
        words = t.split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(("blorgy", "blorgish", "zwackel")))
        docs.append((k, " ".join(f"{w}!!" if poor else w for w in words), lang, source))
        labels.append((k, int(not poor), int(toxic)))
    return docs, labels


def test_toxic_documents_are_found(spark, labelled):
    docs, labels = labelled
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(None, 1, 1), (5, None, 1), (70_000, 1, 1)], "doc_id long, quality int, toxic int")
    all_docs = spark.createDataFrame(docs + ODD, SCHEMA)
    model = toxicity.fit(all_docs, known)
    found = {r.doc_id: r for r in toxicity.predict(all_docs, model).collect()}
    assert len(found) == len(docs) + len(ODD)
    unseen = [(found[i].toxic, bool(t)) for i, _, t in labels if i % 3 == 0]
    assert np.mean([a == b for a, b in unseen]) > 0.97
    assert not any(found[i].toxic for i in (9001, 9002, 9003, 9004))
    kept = toxicity.keep(all_docs, model)
    assert kept.schema == all_docs.schema
    assert kept.count() == sum(not r.toxic for r in found.values())


def test_later_links_learn_from_earlier_ones(spark):
    """Where the second category follows from the first alone, its link leans on it."""
    rng = random.Random(3)
    rows = []
    for k in range(400):
        first = rng.random() < 0.5
        rows.append((k, text(rng, "en", 20) + (" blorgy" if first else " zwackel"), "en", "s", int(first)))
    docs = spark.createDataFrame([r[:4] for r in rows], SCHEMA)
    labels = spark.createDataFrame([(r[0], r[4], r[4]) for r in rows], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, labels).links[1].earlier[0] > 0


def test_no_labels(spark, documents):
    docs = spark.createDataFrame(documents[:3], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r.toxic for r in toxicity.predict(docs, model).collect()] == [False] * 3


def test_ftrl_drops_useless_features_and_separates():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        label = int(rng.integers(0, 3))
        rows.append((np.array([label, 3 + int(rng.integers(0, 50))]), np.array([1.0, 1.0]), label))
    w = linear.Ftrl(l1=2.0).fit(rows, 53, 3)
    assert np.mean(linear.logits_of(w, rows).argmax(axis=1) == [r[2] for r in rows]) == 1.0
    assert (w[3:53] == 0).mean() > 0.9


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(1)
    true = rng.standard_normal((4000, 3))
    labels = np.array([rng.choice(3, p=linear.softmax(x)) for x in true])
    assert abs(linear.temperature(true * 4, labels) - 4) < 0.6


def test_ngrams_of_a_long_text_are_taken_in_blocks(monkeypatch):
    long = "".join(random.Random(1).choice("abcdé ") for _ in range(5000))
    whole = ngrams.counts(long, (1, 2, 3), 12)
    monkeypatch.setattr(ngrams, "BLOCK", 97)
    assert (ngrams.counts(long, (1, 2, 3), 12) == whole).all()
    assert whole.sum() > 10_000
