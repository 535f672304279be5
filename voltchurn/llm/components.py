"""Connected components of an edge table, with intermediate tables on shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voltchurn.session import scratch_path


#: rows of an edge or label table that make a part of it
ROWS_PER_PART = 200_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read back."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b longs): label is the
    smallest node reachable.

    Each round a node takes the least of its own label, its neighbours' labels
    and its label's label.  Minima are combined before each shuffle, so a node
    with very many edges is no hot group; every round is one written table.
    """
    counted = Observation()
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = saved(both.observe(counted, F.count("*").alias("n")), f"{name}-edges")
    # written in parts of a fixed size, however many partitions a shuffle has
    parts = 1 + counted.get["n"] // ROWS_PER_PART
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = saved(labels.coalesce(parts), f"{name}-labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(of, "b").select(F.col("a").alias("node"), "near")
        jump = labels.join(labels.select(F.col("node").alias("label"), F.col("label").alias("near")), "label").select("node", "near")
        own = labels.select("node", F.col("label").alias("near"))
        changed = Observation()
        following = own.withColumn("old", F.col("near")).unionByName(near.unionByName(jump), allowMissingColumns=True) \
            .groupBy("node").agg(F.min("near").alias("label"), F.max("old").alias("old")) \
            .observe(changed, F.count_if(F.col("label") != F.col("old")).alias("n"))
        labels = saved(following.coalesce(parts), f"{name}-labels").select("node", "label")
        if not changed.get["n"]:
            return labels
