"""Interaction enrichment (X2, X4, X6): intent, presence flag, sentiment."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltchurn.functions import text as tx

SENTIMENT_COLS = ("sentiment_neg", "sentiment_neu", "sentiment_pos", "sentiment_label")


def enrich_intent(df: DataFrame, text_col: str = "interaction_summary", date_col: str = "date",
                  rules=tx.INTENT_RULES) -> DataFrame:
    """X2 + X3: add ``customer_intent`` and ``has_interaction``."""
    cols = {}
    if text_col in df.columns:
        cols["customer_intent"] = tx.classify_intent(text_col, rules)
    has_date = F.col(date_col).isNotNull() if date_col in df.columns else F.lit(False)
    has_text = ~tx.is_blank(text_col) if text_col in df.columns else F.lit(False)
    cols["has_interaction"] = (has_date | has_text).cast("int")
    return df.withColumns(cols)


def lexicon_sentiment(df: DataFrame, text_col: str = "interaction_summary") -> DataFrame:
    """X4 default scorer: word-list shares, JVM-side; blank texts get NULLs.

    neg = n/(1+n+p), pos = p/(1+n+p), neu = 1/(1+n+p) over the whole text.
    """
    tmp = df.withColumns({"_blank": tx.is_blank(text_col),
                          "_p": tx.word_hits(text_col, tx.POSITIVE_WORDS),
                          "_n": tx.word_hits(text_col, tx.NEGATIVE_WORDS)})
    den = (F.lit(1) + F.col("_p") + F.col("_n")).cast("double")
    ok = ~F.col("_blank")
    out = tmp.withColumns({
        "sentiment_neg": F.when(ok, F.col("_n") / den),
        "sentiment_neu": F.when(ok, F.lit(1.0) / den),
        "sentiment_pos": F.when(ok, F.col("_p") / den),
    })
    out = out.withColumn("sentiment_label", F.when(ok, tx.sentiment_label(
        "sentiment_neg", "sentiment_neu", "sentiment_pos")))
    return out.drop("_blank", "_p", "_n")


def model_sentiment(df: DataFrame, scorer: Callable[[pd.Series], pd.DataFrame],
                    text_col: str = "interaction_summary") -> DataFrame:
    """X4 with a real model: ``scorer(texts) -> DataFrame[negative, neutral, positive]``.

    Runs in Arrow batches through ``mapInPandas``; the scorer is loaded once
    per Python worker by the caller's closure.  Blank texts are not sent.
    """
    out_schema = T.StructType(df.schema.fields + [
        T.StructField("sentiment_neg", T.DoubleType()),
        T.StructField("sentiment_neu", T.DoubleType()),
        T.StructField("sentiment_pos", T.DoubleType()),
    ])

    def run(batches):
        for pdf in batches:
            t = pdf[text_col]
            mask = t.fillna("").astype(str).str.strip().ne("")
            for c in ("sentiment_neg", "sentiment_neu", "sentiment_pos"):
                pdf[c] = float("nan")
            if mask.any():
                s = scorer(t[mask].astype(str))
                pdf.loc[mask, "sentiment_neg"] = s["negative"].to_numpy()
                pdf.loc[mask, "sentiment_neu"] = s["neutral"].to_numpy()
                pdf.loc[mask, "sentiment_pos"] = s["positive"].to_numpy()
            yield pdf

    scored = df.mapInPandas(run, out_schema)
    scored = scored.withColumns({c: F.when(~F.isnan(c), F.col(c))
                                 for c in ("sentiment_neg", "sentiment_neu", "sentiment_pos")})
    return scored.withColumn("sentiment_label", F.when(F.col("sentiment_neg").isNotNull(),
                                                       tx.sentiment_label("sentiment_neg", "sentiment_neu",
                                                                          "sentiment_pos")))


def enrich_interactions(df: DataFrame, scorer=None, text_col: str = "interaction_summary",
                        rules=tx.INTENT_RULES) -> DataFrame:
    """Intent always; sentiment by the given scorer (a trained ``SentimentModel`` or a
    function of texts), else the word-list default."""
    out = enrich_intent(df, text_col=text_col, rules=rules)
    if text_col not in out.columns:
        return out
    if scorer is None:
        return lexicon_sentiment(out, text_col)
    if hasattr(scorer, "predict"):
        from voltchurn.plans import sentiment

        return sentiment.model_sentiment(out, scorer, text_col)
    return model_sentiment(out, scorer, text_col)
