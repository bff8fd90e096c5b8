"""Quality and toxicity scores: held-out rows, awkward rows, and the parts they are made of."""

import random

import messy
import numpy as np
import pytest

from lendstrata.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.9)])
def test_held_out_rows_are_predicted(spark, module, label, least):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    found = module.score_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(found) > 50
    assert (found.predicted == found[label]).mean() >= least
    assert found.score.between(0, 1).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_held_out_labels_have_no_influence(spark, module):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    other = labels.selectExpr("doc_id", f"CASE WHEN crc32(string(doc_id)) % {5 if module is quality else 4} = {0 if module is quality else 2} "
                              "THEN 1 - quality ELSE quality END AS quality", f"CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (module.score_documents(docs, x).toPandas().sort_values("doc_id") for x in (labels, other))
    assert np.allclose(a.score, b.score)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows(spark, module):
    docs = messy.documents(spark)
    labels = messy.labels(spark, [(i, i % 2, (i + 1) % 2) for i in range(14)] + [(None, 1, 1), (3, None, None), (4, 0, 0), (4, 1, 1)])
    found = module.score_documents(docs, labels).toPandas()
    assert len(found) == docs.count()
    assert found.score.between(0, 1).all() and set(found.predicted) <= {0, 1}
    empty = found[found.doc_id.isin([0, 1, 2])]
    assert empty.score.nunique() == 1  # null, empty and blank texts alike


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels_or_rows(spark, module):
    found = module.score_documents(messy.documents(spark), messy.labels(spark)).toPandas()
    assert np.allclose(found.score, 0.5)
    assert module.score_documents(messy.empty(spark), messy.labels(spark, [(1, 1, 0)])).count() == 0


def test_drop_toxic_keeps_columns(spark):
    docs = messy.documents(spark)
    assert toxicity.drop_toxic(docs, messy.labels(spark), 0.6).columns == docs.columns
    assert toxicity.drop_toxic(docs, messy.labels(spark), 0.6).count() == docs.count()


def maximal(scores):
    """Maximal segments by their recursive definition: the best run, then what is left and right of it."""
    out = []

    def best(a, b):
        runs = [(sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        top = max((r for r in runs if r[0] > 1e-12), default=None)
        if top:
            best(a, top[3])
            out.append((top[3], top[4] - 1, round(top[0], 6)))
            best(top[4], b)

    best(0, len(scores))
    return out


def test_segments_are_the_maximal_ones():
    rng = random.Random(1)
    for _ in range(200):
        n, drift = rng.randrange(1, 12), 0.25
        scores = [rng.choice([-drift, -drift, 1.37, 0.61, 2.93]) + rng.random() / 100 if rng.random() < 0.6 else -drift for _ in range(n)]
        scores = [s if s > 0 else -drift for s in scores]
        places = np.array([i for i, s in enumerate(scores) if s > 0], np.int64)
        got = toxicity.segments(np.array([scores[i] for i in places]), places, drift)
        assert [(a, b, round(s, 6)) for a, b, s in got] == maximal(scores)


def test_toxic_passage_is_found(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    from pyspark.sql import functions as F

    model = toxicity.fit(docs, labels, toxicity.learns(F.col("doc_id")))
    text = "the of and in " * 30 + "stupid idiot worthless trash " + "the of and in " * 30
    row = spark.createDataFrame([(text,)], "text string").select(toxicity.passages(model, "text").alias("p")).first()["p"]
    at = int(np.argmax(row["nats"]))
    assert row["words"] == 244 and 118 <= row["starts"][at] <= 121 and 123 <= row["ends"][at] <= 124
    assert row["score"] > 0.5


def test_temperature_softens_overconfident_logits():
    rng = np.random.default_rng(0)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert quality.temperature(3 * z, y) == pytest.approx(3, rel=0.15)


def test_context_vectors_follow_neighbours(spark):
    p = quality.Params()
    docs = spark.createDataFrame([("cat sits here",), ("dog sits here",), ("rock falls down",)] * 20, "text string")
    vectors = quality.word_vectors(docs, p)
    import pyarrow as pa

    from lendstrata.llm import text as tx

    def row(word):
        for _, _, data, offsets in tx.slices(pa.array([word])):
            return vectors[quality._buckets(tx.words(data, offsets, punctuation=True), p)[0]]

    assert row("cat") @ row("dog") > 0.99 > 0.5 > abs(row("cat") @ row("rock"))
