"""Line dedup over levelled sorted runs of line hashes.

Documents arrive in batches of ascending id.  A batch's line keys are reduced
to one row per key, merge-joined to the runs of keys seen so far, and what the
runs do not hold becomes a new run: a table bucketed and sorted by the hash, so
that joining it needs no shuffle.  ``fanout`` runs of one level are merged into
one run of the next level before the next batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltchurn.session import scratch_path

# The white space stripped from a line's ends, and the letters
# that are lower-cased (no others are).
STRIP = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: a null id stands behind all others
LAST_ID = 2**63 - 1
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(STRIP))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Runs of (h1, h2, first) in ``spark.checkpoint.dir``; keys are disjoint."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 2):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.base = scratch_path(spark, f"lines-{uuid.uuid4().hex}")
        self.levels: list[list[str]] = []
        self.tables: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.repartition(self.buckets, *HASH).write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", os.path.join(self.base, name)).saveAsTable(name))
        self.tables.append(name)
        return name

    def _fresh(self, name: str) -> DataFrame:
        return self.spark.table(name).where("fresh")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def compact(self) -> None:
        """Merges every level that holds ``fanout`` runs into the next one."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                merged = self._fresh(self.levels[k][0])
                for name in self.levels[k][1:]:
                    merged = merged.unionByName(self._fresh(name))
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self._write(merged))
                self.levels[k] = []
            k += 1

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch of (id, h1, h2) rows, all ids above those before.

        Returns the batch's keys that some other document holds too, with the
        first id that holds them: (h1, h2, first).
        """
        self.compact()
        keys = lines.groupBy(*HASH).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        seen = F.lit(None).cast("long")
        for k, name in enumerate(self.runs()):
            run = self._fresh(name).select(*HASH, F.col("first").alias(f"first_{k}"))
            keys = keys.join(run, HASH, "left")
            seen = F.coalesce(seen, F.col(f"first_{k}"))
        out = keys.select(*HASH, F.coalesce(seen, "lo").alias("first"), seen.isNull().alias("fresh"),
                          (seen.isNotNull() | (F.col("lo") < F.col("hi"))).alias("shared"))
        name = self._write(out)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        return self.spark.table(name).where("shared").select(*HASH, "first")

    def forget(self) -> None:
        """Takes the tables out of the catalog (their files stay for readers)."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines dropped that an earlier document holds already.

    A line's key is the line stripped and lower-cased (``line_key``).  Keys of
    at least ``min_chars`` code points found in two or more documents lose all
    their lines except those of the smallest id.  Every other line stays, in
    order; kept lines are joined by line feeds.  All columns of ``docs`` stay;
    the columns ``n_lines`` and ``n_dropped`` are set (replaced if present).

    A null text is one empty line and stays null.  Rows with the same id are
    one document; rows with a null id are one document behind all others.  The
    number of batches sets how the input is fed to the runs, not the result.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = LineRuns(spark, buckets, fanout)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                      F.col(text_col).cast("string").alias("text"))
    edges = _edges(src, batches)
    batch = F.lit(0)
    for e in edges:
        batch = batch + F.when(F.col("id") > e, 1).otherwise(0)
    key = F.col("key")
    lines = (src.select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
             .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"),
                     batch.alias("batch")))
    path = os.path.join(store.base, "lines")
    lines.write.partitionBy("batch").parquet(path)
    schema = "id long, text_hash long, pos int, h1 long, h2 long, batch int"
    shared = None
    for b in range(len(edges) + 1):
        part = spark.read.schema(schema).parquet(path).where(F.col("batch") == b)
        found = store.add(part).withColumn("batch", F.lit(b))
        shared = found if shared is None else shared.unionByName(found)
    stored = spark.read.schema(schema).parquet(path)
    drops = (stored.join(shared, ["batch", *HASH]).where(F.col("id") != F.col("first"))
             .groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("dropped")))
    store.forget()
    return _apply(docs, drops, id_col, text_col)


def _edges(src: DataFrame, batches: int) -> list[int]:
    """At most ``batches - 1`` ascending ids that cut the input into batches."""
    cuts = [k / batches for k in range(1, batches)]
    if not cuts:
        return []
    found = src.agg(F.percentile_approx("id", cuts, 1000).alias("q")).first()["q"]
    return sorted(set(found or []))


def _apply(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kept_cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_cols]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    lines = lines_of(F.col("row")[text_col])
    # runs of kept lines lie between neighbouring dropped positions
    before = F.concat(F.array(F.lit(-1)), F.col("dropped"))
    after = F.concat(F.col("dropped"), F.array(F.size("lines")))
    spans = F.arrays_zip(before.alias("a"), after.alias("b"))
    joined = left.join(drops, ["id", "text_hash"], "left").select("row", "dropped", lines.alias("lines"))
    kept = F.flatten(F.transform(spans, lambda z: F.slice("lines", z["a"] + 2, z["b"] - z["a"] - 1)))
    text = F.when(F.col("dropped").isNull(), F.col("row")[text_col]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in kept_cols],
                         F.size("lines").cast("long").alias("n_lines"),
                         F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"))
