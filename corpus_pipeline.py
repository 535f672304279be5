"""Corpus pipeline: documents -> cleaned, deduplicated, packed pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet under ``spark.checkpoint.dir`` and rereads it
for the next one.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltchurn.llm import jaccard, lines, packing, secret_scan, toxicity
from voltchurn.llm.queries import table, vocab_path
from voltchurn.llm.workers import set_worker_env
from voltchurn.session import bound_batches, put_on_worker_path, scratch_path

#: no SQL form (the stages train a model and pack online): tested against brute force
ORACLE_SQL = None


#: bytes of one Arrow batch: the stages follow one another in executors whose heaps are full by then
BATCH_BYTES = 1 << 20


def _ready(spark: SparkSession) -> None:
    put_on_worker_path(spark)
    set_worker_env(spark)
    bound_batches(spark, BATCH_BYTES)


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars made to agree with the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (5): trained on ``labels``; documents scored 0.3 or more go."""
    _ready(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, limit=0.3).where(~F.col("toxic")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (4): lines that an earlier document holds are cut out."""
    return _with_length(lines.dedup_lines(docs, min_chars=10).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (6): one document of each group of near copies stays
    (5-word shingles, similarity 0.8 or more)."""
    _ready(spark)
    return jaccard.keep_one_of_each(docs, num=80, den=100, words=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (7): every span found is replaced by ``[SECRET]``."""
    found = secret_scan.scan_secrets(docs)
    return _with_length(found.withColumn("text", secret_scan.redact(F.col("text"), F.col("secret_spans"))).select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (9): the pieces of all documents in windows of 2048 tokens."""
    _ready(spark)
    return packing.pack_documents(docs, vocab_path(), window=2048, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{k}-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
