"""Approximate nearest neighbours by a forest of random-projection trees.

The trees' hyperplanes are fitted on a bounded sample and every row is put in
one leaf of every tree.  A query walks all trees at once, through one priority
queue by how far beyond a hyperplane it would have to be, and takes leaves
until they hold its search budget.  The rows of its leaves are then ranked by
exact distance.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096             # rows of a leaf, or queries to it, that meet in one group


@dataclass(frozen=True)
class Tree:
    """A full binary tree: normals and thresholds of each level's nodes."""

    normals: list[np.ndarray]
    thresholds: list[np.ndarray]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for normal, threshold in zip(self.normals, self.thresholds):
            node = 2 * node + (np.einsum("ij,ij->i", x, normal[node]) > threshold[node])
        return node


def grow_tree(sample: np.ndarray, depth: int, rng: np.random.Generator) -> Tree:
    """Splits the sample at the median of a projection, level by level.

    A node's direction is the difference of two of its points; without two
    different points it is drawn at random.
    """
    node = np.zeros(len(sample), dtype=np.int64)
    normals, thresholds = [], []
    for level in range(depth):
        n_nodes = 1 << level
        normal = np.zeros((n_nodes, sample.shape[1]))
        threshold = np.zeros(n_nodes)
        order = np.argsort(node, kind="stable")
        cuts = np.searchsorted(node[order], np.arange(n_nodes + 1))
        following = 2 * node
        for k in range(n_nodes):
            own = order[cuts[k]:cuts[k + 1]]
            direction = np.zeros(sample.shape[1])
            if len(own) > 1:
                i, j = rng.choice(len(own), 2, replace=False)
                direction = sample[own[i]] - sample[own[j]]
            if not direction.any():
                direction = rng.standard_normal(sample.shape[1])
            normal[k] = direction / np.linalg.norm(direction)
            if len(own):
                shade = sample[own] @ normal[k]
                threshold[k] = np.median(shade)
                following[own] += shade > threshold[k]
        node = following
        normals.append(normal)
        thresholds.append(threshold)
    return Tree(normals, thresholds)


def search_leaves(forest: list[Tree], population: list[np.ndarray], query: np.ndarray, budget: float):
    """(tree, leaf) pairs in the shared queue's order until they hold ``budget`` rows."""
    queue = [(0.0, t, 0, 0) for t in range(len(forest))]
    held = 0
    while queue and held < budget:
        reach, t, level, node = heapq.heappop(queue)
        tree = forest[t]
        if level == len(tree.normals):
            if population[t][node]:
                held += int(population[t][node])
                yield t, node
            continue
        side = float(tree.normals[level][node] @ query - tree.thresholds[level][node])
        near = 2 * node + (side > 0)
        heapq.heappush(queue, (reach, t, level + 1, near))
        heapq.heappush(queue, (max(reach, abs(side)), t, level + 1, near ^ 1))


def _bad(vector: Column) -> Column:
    return F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the distinct rows with a finite vector other than zero.

    Vectors of another length than the most common one take no part, nor do
    null ids.  Rows that repeat an id stay where their vectors differ.
    """
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    src = src.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~_bad(F.col("v"))) \
        .where(F.exists("v", lambda x: x != 0))
    sizes = src.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if sizes:
        src = src.where(F.size("v") == sizes[0]["size"])
    return src.distinct()


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The vectors of a batch, in double precision (they travel as they were stored)."""
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = 8, sample_rows: int = 16_384,
                       leaf_rows: int = 32, share: float = 1.5, seed: int = 42,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean) of each query's ``k`` nearest found.

    ``queries`` holds the ids of the rows that ask; candidates are all other
    rows.  Nearest first, ties to the smaller id; with fewer candidates all are
    returned.  Rows that ``valid_vectors`` leaves out neither ask nor answer.
    An id that several vectors share answers by the nearest of them and asks with
    all of them: its neighbours are the nearest to any.

    Equal vectors are one candidate that stands for its k + 1 smallest ids, so
    a vector that fills a third of the table is one row.  ``sample_rows`` bounds
    what the trees are fitted on; ``share`` is the search budget: the rows of
    the leaves a query takes, a row counting once per tree, as a share of the
    candidates.  Vectors without neighbourhood structure need a large one for a
    good recall, others do with a few thousandths.  Rows and queries meet by
    subtree, in blocks of BLOCK_ROWS rows at most.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = valid_vectors(vectors, id_col, vector_col)
    kind = dict(rows.dtypes)["v"]
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    smallest = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    distinct = smallest.groupBy("v").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))
    total = distinct.count()
    asked = rows.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id")
    sample = distinct.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    points = np.array(sample.column("v").to_pylist() or np.zeros((0, 1)), dtype=np.float64)
    depth = max(0, min(round(math.log2(max(total, 1) / leaf_rows)), int(math.log2(max(sample.num_rows, 1) / 4))))
    top = min(depth, max(0, math.ceil(math.log2(max(total, 1) / BLOCK_ROWS))))
    inside = depth - top                        # levels below the subtree that rows and queries meet in
    rng = np.random.default_rng(seed)
    forest = spark.sparkContext.broadcast([grow_tree(points, depth, rng) for _ in range(trees)])

    def assign(batches):
        for batch in batches:
            x = _matrix(batch, "v")
            for t, tree in enumerate(forest.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t), pa.int32()), pa.array(tree.leaves(x) if len(x) else [], pa.int64()),
                     batch.column("id"), batch.column("v"), batch.column("ids")], ["tree", "leaf", "id", "v", "ids"])

    placed = distinct.select("id", "v", "ids").mapInArrow(assign, f"tree int, leaf long, id long, v {kind}, ids array<long>")
    population = [np.zeros(1 << depth, dtype=np.int64) for _ in range(trees)]
    for r in placed.groupBy("tree", "leaf").count().collect():      # trees * 2^depth rows at most
        population[r["tree"]][r["leaf"]] = r["count"]
    known = spark.sparkContext.broadcast(population)

    def walk(batches):
        for batch in batches:
            out = []
            for q, (i, x) in enumerate(zip(batch.column("id").to_pylist(), _matrix(batch, "v"))):
                taken: dict = {}
                for t, leaf in search_leaves(forest.value, known.value, x, share * total):
                    taken.setdefault((t, leaf >> inside), []).append(leaf)
                out += [(t, subtree, i, q, leaves) for (t, subtree), leaves in taken.items()]
            tree, subtree, ids, q, leaves = zip(*out) if out else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree, pa.int32()), pa.array(subtree, pa.int64()), pa.array(ids, pa.int64()),
                 batch.column("v").take(pa.array(q, pa.int64())), pa.array(leaves, pa.list_(pa.int64()))],
                ["tree", "subtree", "id", "v", "leaves"])

    wanted = asked.select("id", "v").mapInArrow(walk, f"tree int, subtree long, id long, v {kind}, leaves array<long>")
    # how many blocks each subtree's rows are cut into: at most trees * 2^top rows
    sums = [p.reshape(1 << top, -1).sum(axis=1) for p in population]
    blocks = spark.createDataFrame([(t, k, max(1, -(-int(n) // BLOCK_ROWS))) for t, p in enumerate(sums) for k, n in enumerate(p)],
                                   "tree int, subtree long, blocks int")
    none = F.array().cast("array<long>")
    members = placed.withColumn("subtree", F.shiftright("leaf", inside)).join(F.broadcast(blocks), ["tree", "subtree"]) \
        .select("tree", "subtree", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"),
                "id", "v", "ids", F.array("leaf").alias("leaves"))
    asking = wanted.join(F.broadcast(blocks), ["tree", "subtree"]) \
        .select("tree", "subtree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("role"),
                "id", "v", none.alias("ids"), "leaves")
    met = members.unionByName(asking).repartition(parts, "tree", "subtree", "block").sortWithinPartitions("tree", "subtree", "block", "role", "id")

    def rank(batches):
        group, ids, lists, held, leaf = None, [], [], [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("tree", "subtree", "block"))))
            role, own, x = batch.column("role").to_pylist(), batch.column("id").to_pylist(), _matrix(batch, "v")
            leaves = batch.column("leaves").to_pylist()
            id_lists = batch.column("ids")
            out = []
            at = 0
            while at < len(keys):
                if keys[at] != group:
                    group, ids, lists, held, leaf = keys[at], [], [], [], []
                end = at
                while end < len(keys) and keys[end] == group and role[end] == role[at]:
                    end += 1
                if role[at] == 0:
                    ids += own[at:end]
                    lists += id_lists.slice(at, end - at).to_pylist()
                    leaf += [x[0] - (group[1] << inside) for x in leaves[at:end]]
                    held.append(x[at:end])
                elif held:
                    if len(held) > 1:
                        held = [np.concatenate(held)]
                    wanted_leaf = np.zeros((end - at, 1 << inside), dtype=bool)
                    for q, taken in enumerate(leaves[at:end]):
                        wanted_leaf[q, np.array(taken) - (group[1] << inside)] = True
                    out += _closest(own[at:end], x[at:end], lists, held[0], wanted_leaf[:, leaf], k)
                at = end
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    found = met.mapInArrow(rank, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _closest(query_ids, queries: np.ndarray, lists, rows: np.ndarray, candidate: np.ndarray, k: int):
    """(query, id, distance) of each query's k nearest ids among its candidates.

    A matrix product finds who can be among the k + 1 nearest, with room for
    its rounding; their distances are then computed from the differences.
    """
    out = []
    length = np.einsum("ij,ij->i", rows, rows)
    for lo in range(0, len(queries), 256):
        part = queries[lo:lo + 256]
        own = np.einsum("ij,ij->i", part, part)
        square = own[:, None] + length[None, :] - 2 * part @ rows.T
        square[~candidate[lo:lo + 256]] = np.inf
        if len(rows) > k + 1:
            limit = np.partition(square, k, axis=1)[:, k] + 1e-9 * (own + length.max())
        else:
            limit = np.full(len(part), np.inf)
        for q in range(len(part)):
            near = np.nonzero((square[q] <= limit[q]) & candidate[lo + q])[0]
            exact = np.sqrt(((rows[near] - part[q]) ** 2).sum(axis=1))
            me = query_ids[lo + q]
            best = sorted((float(d), i) for d, j in zip(exact, near) for i in lists[j] if i != me)[:k]
            out += [(me, i, d) for d, i in best]
    return out
