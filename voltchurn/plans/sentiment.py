"""Sentiment by a trained model (X4, X6): multinomial logistic regression over hashed words.

Training is a distributed MLlib fit over every labelled row.  The fitted model is
a small matrix (classes x buckets, a parameter bounds it) which is saved as a
table and goes to the workers with the scoring function; a worker unpacks it
once and scores texts in batches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltchurn.functions import text as tx
from voltchurn.operators.frames import cut_lineage
from voltchurn.plans.model import PlainLogisticRegression

CLASSES = ("negative", "neutral", "positive")
BUCKETS = 1 << 12
BATCH_SIZE = 32
_WORD = re.compile(r"[^\W\d_]+")


def word_buckets(text: str, size: int) -> list[int]:
    """The bucket of every word (run of letters, lower-cased) of a text."""
    return [zlib.crc32(w.encode("utf-8", "replace")) % size for w in _WORD.findall(text.lower())]


@dataclass(frozen=True)
class SentimentModel:
    """Weights (classes x buckets) and intercepts; texts are unit vectors of word counts."""

    weights: np.ndarray
    intercepts: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> np.ndarray:
        """Chances (texts x classes); a text without words has those of the intercepts."""
        size = self.weights.shape[1]
        logits = np.tile(self.intercepts, (len(texts), 1))
        for k, text in enumerate(texts):
            found, counts = np.unique(np.array(word_buckets(text or "", size), dtype=np.int64), return_counts=True)
            if len(found):
                logits[k] += self.weights[:, found] @ (counts / np.sqrt((counts**2).sum()))
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per class: its name, intercept and weights."""
        rows = [(CLASSES[c], float(self.intercepts[c]), self.weights[c].tolist()) for c in range(len(CLASSES))]
        spark.createDataFrame(rows, "class string, intercept double, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SentimentModel":
        rows = {r["class"]: r for r in spark.read.parquet(path).collect()}       # one row per class
        return cls(np.array([rows[c]["weights"] for c in CLASSES]), np.array([rows[c]["intercept"] for c in CLASSES]))


def train_sentiment(df: DataFrame, text_col: str, label_col: str, buckets: int = BUCKETS, reg: float = 1e-3,
                    max_iter: int = 100) -> SentimentModel:
    """A model from texts and their classes (0 negative, 1 neutral, 2 positive).

    Rows with a NULL class or a blank text are left out; every other row counts.
    A class without rows gets no chance.
    """
    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [str(b) for b in word_buckets(t, buckets)])

    rows = df.where(F.col(label_col).isin(0, 1, 2) & ~tx.is_blank(text_col)) \
        .select(words(F.col(text_col).cast("string")).alias("words"), F.col(label_col).cast("double").alias("label"))
    counts = CountVectorizerModel.from_vocabulary([str(b) for b in range(buckets)], inputCol="words", outputCol="counts")
    ready = cut_lineage(Normalizer(inputCol="counts", outputCol="features").transform(counts.transform(rows)).select("features", "label"))
    if ready.isEmpty():
        raise ValueError("no labelled text to train on")
    model = Pipeline(stages=[PlainLogisticRegression(family="multinomial", regParam=reg, maxIter=max_iter)]).fit(ready).stages[-1]
    seen = model.numClasses                        # 1 + the highest class in the rows
    weights, intercepts = np.zeros((len(CLASSES), buckets)), np.full(len(CLASSES), -1e9)
    weights[:seen], intercepts[:seen] = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    present = {int(r[0]) for r in ready.select("label").distinct().collect()}
    intercepts[[c for c in range(len(CLASSES)) if c not in present]] = -1e9
    return SentimentModel(weights, intercepts)


def model_sentiment(df: DataFrame, model: SentimentModel, text_col: str = "interaction_summary", batch_size: int = BATCH_SIZE) -> DataFrame:
    """``df`` with sentiment_neg, _neu, _pos and the label of the largest; NULL for blank texts.

    One row per row of ``df``; whole texts are scored, ``batch_size`` at a time.
    """
    def make():
        return lambda texts: model.predict(texts.tolist())

    score = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    scored = df.withColumn("_scores", F.when(~tx.is_blank(text_col), score(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    parts = {f"sentiment_{short}": F.col("_scores")[k] for k, short in enumerate(("neg", "neu", "pos"))}
    out = scored.withColumns(parts).drop("_scores")
    return out.withColumn("sentiment_label", F.when(F.col("sentiment_neg").isNotNull(), tx.sentiment_label(*parts)))
