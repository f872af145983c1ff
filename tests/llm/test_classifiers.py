import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import learn, quality, toxicity

CASES = [(quality, quality.score_quality, "quality", 0.7), (toxicity, toxicity.score_toxicity, "toxic", 0.3)]


@pytest.fixture(scope="module")
def medium(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.mark.parametrize("module,score,label,threshold", CASES)
def test_held_out_labels_are_predicted(medium, module, score, label, threshold):
    docs, labels = medium
    rows = score(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    right = sum(r.predicted == r[label] for r in held) / len(held)
    assert right >= (0.97 if label == "quality" else 0.9)


@pytest.mark.parametrize("module,score,label,threshold", CASES)
def test_held_out_labels_and_other_columns_do_not_matter(medium, module, score, label, threshold):
    docs, labels = medium
    flipped = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col(label)).otherwise(F.col(label)))
    one = {r.doc_id: r.score for r in score(docs, labels).collect()}
    two = {r.doc_id: r.score for r in score(docs.select("doc_id", F.lit(None).cast("string").alias("lang"), "text"), flipped).collect()}
    assert one == pytest.approx(two, abs=1e-9)


@pytest.mark.parametrize("module,score,label,threshold", CASES)
def test_hard_rows(spark, hard, hard_rows, module, score, label, threshold):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(1, 18)] + [(None, 1, "x"), (4, None, "x"), (5, 9, "x")], f"doc_id long, {label} int, text string")
    rows = score(hard, labels).collect()
    assert sorted((repr(r.doc_id) for r in rows)) == sorted(repr(r[0]) for r in hard_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[3] == by_id[4]  # null and empty


@pytest.mark.parametrize("module,score,label,threshold", CASES)
def test_without_labels_nothing_is_known(hard, none, spark, module, score, label, threshold):
    labels = spark.createDataFrame([], f"doc_id long, {label} int")
    assert {r.score for r in score(hard, labels).collect()} == {0.5}
    assert score(none, labels).collect() == []


def test_sample_is_bounded_and_not_held_out(medium):
    rows = learn.label_sample(*medium, "quality", 50).collect()
    assert len(rows) == 50 and all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in rows)


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert (0, 1) in [p[:2] for p in model["pairs"]]
    assert ((quality.predict(model, x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_buckets_do_not_depend_on_blocks(monkeypatch):
    text = "An idiot, so to say; nothing but trash. " * 20
    whole = np.unique(np.concatenate(list(toxicity.buckets(text))))
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    assert (np.unique(np.concatenate(list(toxicity.buckets(text)))) == whole).all()


def test_ngrams_are_of_characters_of_any_script():
    def held(text):
        return set(np.concatenate(list(toxicity.buckets(text))).tolist())

    text = "Grüße, Идиот 😀 trash"
    padded = f" {text.lower()} "
    grams = {padded[i: i + n] for n in toxicity.GRAMS for i in range(len(padded) - n + 1)}
    assert len(held(text)) == len(grams)
    assert held("ÄRGER ИДИОТ") == held("ärger идиот") and held("a\tb c d") == held("a b c d")
    assert held("x" + text) & held(text) and not held("яяяяяя") & held("zzzzzz")


def test_kept_documents_have_all_columns(medium):
    docs, labels = medium
    kept = quality.keep_good(docs, labels)
    want = {r.doc_id for r in quality.score_quality(docs, labels).filter("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(900, 940)] + [(None, "t")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(2000)] + [(None, 1)], "doc_id long, quality int")
    got = learn.label_sample(docs, marks, "quality", 50).collect()
    assert {r.doc_id for r in got} <= set(range(900, 940)) and 20 < len(got) <= 40
    assert len(learn.label_sample(docs, marks, "quality", 5).collect()) == 5 and learn.label_sample(docs.limit(0), marks, "quality", 5).collect() == []
