"""Trained sentiment: fitted, saved, scored in batches as one by one."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltchurn.plans import enrich, sentiment

BAD = ["terrible slow service", "I am angry about the awful bill", "bad terrible support", "awful, angry and slow"]
FINE = ["meter reading sent", "the invoice arrived today", "address change request", "reading of the meter today"]
GOOD = ["great friendly help", "I am happy, thanks for the great offer", "excellent friendly support", "happy with excellent help"]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(t, c) for c, texts in enumerate((BAD, FINE, GOOD)) for t in texts * 3] + [(None, 0), ("  ", 2), ("unlabelled", None)]
    return sentiment.train_sentiment(spark.createDataFrame(rows, "text string, class int"), "text", "class")


def test_batches_equal_one_by_one(spark, trained):
    texts = BAD + FINE + GOOD + [None, "", " \n\t", "ÜBEL terrible 123", "great " * 20_000, "...", "great great"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, interaction_summary string").repartition(3)
    for size in (1, 32):
        got = {r["id"]: r for r in sentiment.model_sentiment(rows, trained, batch_size=size).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            r = got[i]
            scores = [r["sentiment_neg"], r["sentiment_neu"], r["sentiment_pos"]]
            if not (t or "").strip():
                assert scores == [None] * 3 and r["sentiment_label"] is None
            else:
                assert scores == pytest.approx(trained.predict([t])[0].tolist(), abs=1e-12) and sum(scores) == pytest.approx(1)
                assert r["sentiment_label"] == ("negative", "neutral", "positive")[int(np.argmax(scores))]


def test_learns_its_classes(trained):
    assert [int(c) for c in trained.predict(["angry and awful", "meter reading", "happy, great"]).argmax(axis=1)] == [0, 1, 2]


def test_saved_and_read_back(spark, trained):
    path = os.path.join(tempfile.mkdtemp(prefix="vc-sentiment-"), "model")
    trained.save(spark, path)
    again = sentiment.SentimentModel.load(spark, path)
    assert (again.weights == trained.weights).all() and (again.intercepts == trained.intercepts).all()


def test_enrichment_takes_a_model(spark, trained):
    rows = spark.createDataFrame([("a", None, BAD[1]), ("b", None, None)], "customer_id string, date date, interaction_summary string")
    got = {r["customer_id"]: r for r in enrich.enrich_interactions(rows, trained).collect()}
    assert got["a"]["sentiment_label"] == "negative" and got["b"]["sentiment_label"] is None
    assert {"customer_intent", "has_interaction"} <= set(got["a"].asDict())


def test_two_classes_and_no_rows(spark):
    rows = spark.createDataFrame([(t, 0) for t in BAD] + [(t, 2) for t in GOOD], "text string, class int")
    chances = sentiment.train_sentiment(rows, "text", "class").predict(["awful", "great"])
    assert (chances[:, 1] < 1e-9).all() and chances[0, 0] > 0.5 and chances[1, 2] > 0.5
    with pytest.raises(ValueError):
        sentiment.train_sentiment(rows.where(F.lit(False)), "text", "class")
