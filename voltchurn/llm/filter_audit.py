"""Interaction audit of filters: what each removes under every order of applying them.

A document's failures are a mask of filters; a table has at most 2^n masks, so
one aggregation reduces the corpus to counts by part and mask.  Orders are
numbered by their Lehmer rank, under which all orders that begin with the same
k filters are an interval of (n - k)! ranks.  A mask's documents go at step k in
exactly those orders whose first k filters end in the first one of the mask.
So for every mask and beginning the count is added where the interval starts and
taken off where it ends; running sums over the ranks give all orders at once.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.llm.components import saved
from voltchurn.llm.lines import LAST_ID, STRIP

# What separates words, and the marks of filter D.
BLANK = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3

COUNTS = ("docs", "good", "toxic")
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure of the filters A to D, which a text alone decides."""
    whole = F.coalesce(text, F.lit(""))
    bare = F.btrim(whole, F.lit(STRIP))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(whole, F.lit("[A-Z]")) > MAX_CAPITAL_PERCENT * F.char_length(whole),
        "D": whole.rlike(MARKS),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, docs, good, toxic): documents by part and failed filters.

    Bit k of a mask is filter k of FILTERS.  E fails where a smaller id has the
    same text; a null id stands behind all others, and rows that repeat an id
    and its text fail or pass together.  Texts are named by their SHA-256, so
    only thin rows are shuffled.  The documents of one text agree in A to D;
    they are counted by part and labels first, so a text that very many
    documents share is a few rows when its smallest id is sought.  Repeated
    labels of an id count as 1 where any of them does.
    """
    thin = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).alias("text_id"),
        sum((F.when(bad, 1 << k).otherwise(0) for k, bad in enumerate(text_failures(F.col(text_col).cast("string")).values())), F.lit(0)).alias("mask"))
    # written, so that the join below is between two scans and a hot id can be split
    known = saved(labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
                  .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "audit-labels")
    flag = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = thin.join(known, "id", "left").select("id", "part", "text_id", "mask", flag("good"), flag("toxic"))
    group = ["text_id", "mask", "part", "good", "toxic"]
    same_id = rows.groupBy(*group, "id").agg(F.count("*").alias("n"))
    groups = same_id.groupBy(*group).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    # one row per text, part and labels: each text's smallest id
    least = groups.groupBy("text_id").agg(F.collect_list(F.struct("mask", "part", "good", "toxic", "n", "first")).alias("of"),
                                          F.min("first.id").alias("least"))
    one = least.select(F.inline("of"), "least")
    passing = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    fail_bit = 1 << FILTERS.index("E")
    split = one.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), passing.alias("n")),
        F.struct((F.col("mask") + fail_bit).alias("mask"), (F.col("n") - passing).alias("n")))).alias("x")).where("x.n > 0")
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("docs"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def lehmer_rank(order: str, filters: str = FILTERS) -> int:
    """Place of an order among all in lexicographic order."""
    left, rank = sorted(filters), 0
    for k, letter in enumerate(order):
        rank += left.index(letter) * factorial(len(filters) - 1 - k)
        left.remove(letter)
    return rank


def beginnings(filters: str = FILTERS):
    """(letters, first rank, one past the last) of every beginning of an order."""
    n = len(filters)
    for k in range(1, n + 1):
        for letters in permutations(sorted(filters), k):
            rest = "".join(sorted(set(filters) - set(letters)))
            lo = lehmer_rank("".join(letters) + rest, filters)
            yield letters, lo, lo + factorial(n - k)


def audit_part(masks: np.ndarray, counts: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """(ranks x steps) tables of one part from its masks and their counts.

    ``counts``: one row per mask; documents, those of good, of toxic label.
    """
    n = len(filters)
    bit = {letter: 1 << k for k, letter in enumerate(filters)}
    edges = {name: np.zeros((factorial(n) + 1, n), dtype=np.int64) for name in ("removed", "good_lost", "toxic_lost", "redundant", "unique_fails")}
    for letters, lo, hi in beginnings(filters):
        step, last = len(letters) - 1, bit[letters[-1]]
        before = sum(bit[x] for x in letters[:-1])
        fails = (masks & last) > 0
        early = (masks & before) > 0
        here = counts[fails & ~early].sum(axis=0)
        for name, amount in (("removed", here[0]), ("good_lost", here[1]), ("toxic_lost", here[2]),
                             ("redundant", counts[fails & early, 0].sum()), ("unique_fails", counts[masks == last, 0].sum())):
            edges[name][lo, step] += amount
            edges[name][hi, step] -= amount
    out = {name: np.cumsum(e, axis=0)[:-1] for name, e in edges.items()}
    out["kept"] = counts[:, 0].sum() - np.cumsum(out["removed"], axis=1)
    letter_at = np.array([[filters.index(x) for x in order] for order in permutations(sorted(filters))])
    totals = np.bincount(letter_at.ravel(), weights=out["removed"].ravel(), minlength=n).astype(np.int64)
    out["shapley"] = totals[letter_at]
    return out


def audit_orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``failure_counts``.

    A part is one group of at most 2^n rows, so no task holds more than that.
    kept: documents left after the step; removed: taken by it; redundant: failing
    its filter but gone before; unique_fails: failing this filter alone;
    good_lost, toxic_lost: removed ones by label; shapley: what the step's filter
    removes, summed over all orders.
    """
    orders = ["".join(p) for p in permutations(sorted(filters))]
    n = len(filters)

    def one_part(rows: pd.DataFrame) -> pd.DataFrame:
        tables = audit_part(rows["mask"].to_numpy(), rows[list(COUNTS)].to_numpy(), filters)
        out = pd.DataFrame({"part": rows["part"].iloc[0], "filter_order": np.repeat(orders, n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))})
        for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"):
            out[name] = tables[name].ravel()
        return out

    return counts.groupBy("part").applyInPandas(one_part, SCHEMA)


def audit_filters(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The audit of the five filters over every whole text of ``docs``.

    A null text counts as empty, a null part as the empty part; an empty table
    has no parts and gives no rows.  Columns other than id, text and part are
    not read, so their names cannot clash.
    """
    return audit_orders(failure_counts(docs, labels, **columns))
