"""Ranked lexical search: range maxima over posting lists bound document intervals.

The stated queries are taken in blocks of bounded size.  One pass over the texts
finds, per document, its number of terms and which of the block's terms it has;
from that come the counts over all documents.  Then every task searches the
documents it reads, an index block at a time:

* a posting list holds a term's documents in order and their impacts, with a
  sparse table of range maxima (places of the maxima) over it;
* a query's bound for an interval of documents is the sum of its terms' weighted
  range maxima there, and all intervals wait in one queue, best bound first;
* the best interval is split at a document of maximum impact: of the term whose
  weighted maximum is greatest.  That document is scored exactly, what lies on
  either side goes back with bounds of its own;
* it ends when no bound can reach the k-th best score found.

Each block gives at most k documents a query; the k best of all are merged.  A
first round of a few steps in every block finds scores that the k-th best of all
is not below; with these every block leaves early, the sooner the more documents
there are in all.
"""

from __future__ import annotations

import heapq
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltchurn.llm.components import saved
from voltchurn.llm.lines import LAST_ID
from voltchurn.llm.vocab import span_hashes

BATCH_BYTES = 1 << 20
#: postings of one index block (a document's stay together)
BLOCK_POSTINGS = 1 << 20
#: stated queries are searched in blocks of so many items, or fewer with so many bytes of text
QUERY_ITEMS, QUERY_BYTES = 4096, 8 << 20
#: documents scored per query and index block to find what the k-th best score is at least
PROBE_STEPS = 64
IMPACT_SCALE = 1_000_000_000
MERGE_SALT = 64

#: bytes that belong to terms: digits, letters, and all of code points from U+0080 on
_TERM_BYTE = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM_BYTE[_lo:_hi] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NO_TERM = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


# ---------------------------------------------------------------- terms

def _pieces(texts: list[bytes]):
    """(pieces, text of each) runs of about BATCH_BYTES; a longer text is cut between terms."""
    run, owner, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > BATCH_BYTES:
                gap = _NO_TERM.search(text, at + BATCH_BYTES)
                end = gap.start() if gap else end
            run.append(text[at:end])
            owner.append(i)
            size += end - at + 1
            if size >= BATCH_BYTES:
                yield run, owner
                run, owner, size = [], [], 0
            at = end
            if at >= len(text):
                break
    if run:
        yield run, owner


def term_hashes(texts: list[bytes]):
    """Yields (64-bit hash of each term occurrence, its text) by runs of texts."""
    for run, owner in _pieces(texts):
        raw = _LOWER[np.frombuffer(b"\n".join(run) + b"\n", dtype=np.uint8)]
        inside = _TERM_BYTE[raw]
        starts = np.nonzero(inside & np.concatenate([[True], ~inside[:-1]]))[0]
        ends = np.nonzero(inside[:-1] & ~inside[1:])[0] + 1
        piece = np.searchsorted(np.cumsum([len(p) + 1 for p in run]), starts, side="right")
        if len(starts):
            yield span_hashes(raw, starts, ends), np.asarray(owner)[piece]


def _encoded(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in column.to_pylist()]


@dataclass(frozen=True)
class QueryBlock:
    """Queries by number: ``hashes`` are their distinct terms' (ascending); query q
    has the terms ``terms[first[q]:first[q + 1]]``, ``times`` each."""

    hashes: np.ndarray
    first: np.ndarray
    terms: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> "QueryBlock":
        found = list(term_hashes(texts))
        h = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
        owner = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
        hashes, term = np.unique(h, return_inverse=True)
        pair, times = np.unique(owner * max(len(hashes), 1) + term, return_counts=True)
        first = np.searchsorted(pair, np.arange(len(texts) + 1) * max(len(hashes), 1))
        return cls(hashes, first, pair % max(len(hashes), 1), times)


def document_terms(docs: DataFrame, block: QueryBlock) -> DataFrame:
    """(id, n, terms, tfs) of every document with terms: the number of its terms
    with repeats, and the block's terms in it (ascending) with their occurrences."""
    hashes = block.hashes

    def run(batches):
        for batch in batches:
            texts = _encoded(batch.column("text"))
            n = np.zeros(len(texts), dtype=np.int64)
            pairs, counts = [], []
            for h, owner in term_hashes(texts):
                n += np.bincount(owner, minlength=len(texts))
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    known = hashes[at] == h
                    p, c = np.unique(owner[known] * len(hashes) + at[known], return_counts=True)
                    pairs.append(p)
                    counts.append(c)
            pair = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            pair, inverse = np.unique(pair, return_inverse=True)          # the pieces of a long text come together
            tf = np.bincount(inverse, weights=np.concatenate(counts) if counts else None, minlength=len(pair)).astype(np.int64)
            width = max(len(hashes), 1)
            ends = np.searchsorted(pair, np.arange(len(texts) + 1) * width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in ((pair % width).astype(np.int32), tf)]
            rows = pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), *lists], ["id", "n", "terms", "tfs"])
            yield rows.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "id long, n long, terms array<int>, tfs array<long>")


# ---------------------------------------------------------------- index and search

def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A posting's share of its term's weight, in 64-bit integers."""
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (IMPACT_SCALE * tf) // (1000 * tf + 8 * m)


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


class ImpactIndex:
    """Posting lists of a block of documents with range-maximum tables."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        """``doc``: place in ``ids`` (ascending) of each posting's document."""
        order = np.lexsort((doc, term))
        self.ids, self.doc, self.impact = ids, doc[order].astype(np.int64), impact[order]
        term = term[order].astype(np.int64)
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.key = (term << 32) | self.doc
        # row j names the place of the greatest impact among 2^j postings from each place on
        longest = int(np.diff(self.first).max(initial=0))
        self.maxima = np.empty((max(longest.bit_length(), 1), len(term)), dtype=np.int32)
        self.maxima[0] = np.arange(len(term))
        for j in range(1, len(self.maxima)):
            half, last = 1 << (j - 1), self.maxima[j - 1]
            a, b = last[:-half], last[half:]
            self.maxima[j, :-half] = np.where(self.impact[b] > self.impact[a], b, a)
            self.maxima[j, -half:] = last[-half:]
        self.level = np.maximum(np.frexp(np.arange(longest + 1))[1] - 1, 0)      # of a range's size
        self.scored = 0

    def range_maxima(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The place of the greatest impact in each range of one list (any place for an empty range)."""
        level = self.level[hi - lo]
        a = self.maxima[level, np.minimum(lo, len(self.doc) - 1)]
        b = self.maxima[level, hi - (1 << level)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def bounds(self, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
        """(bound, document to split at) of intervals, each a row of its terms' ranges."""
        top = self.range_maxima(lo, hi)
        part = np.where(lo < hi, self.impact[top] * weight, 0)
        best = part.argmax(axis=1)
        return list(zip(part.sum(axis=1).tolist(), self.doc[top[np.arange(len(best)), best]].tolist()))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int = 1, steps: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, place) of a score of ``floor`` or more (1 at least),
        highest first, ties by place; after ``steps`` documents, the best so far."""
        has = (self.first[terms + 1] > self.first[terms]) & (weights > 0)
        terms, weight = terms[has], weights[has]
        if not len(terms):
            return []
        base = terms.astype(np.int64) << 32
        lo, hi = self.first[terms], self.first[terms + 1]
        (bound, at), = self.bounds(lo[None], hi[None], weight)
        waiting = [(-bound, at, lo, hi)]              # a document splits one interval only: no ties beyond it
        best: list[tuple[int, int]] = []              # heap of (score, -place): the worst first
        needed = max(floor, 1)                        # a bound below it cannot help; ties may, by place
        last = len(self.doc) - 1
        until = self.scored + steps if steps else math.inf
        while waiting and -waiting[0][0] >= needed and self.scored < until:
            _, at, lo, hi = heapq.heappop(waiting)
            self.scored += 1
            place = np.searchsorted(self.key, base | at)
            held = (place < hi) & (self.doc[np.minimum(place, last)] == at)
            score = int((self.impact[place[held]] * weight[held]).sum())
            if score >= needed:
                heapq.heappush(best, (score, -at))
                if len(best) > k:
                    heapq.heappop(best)
                if len(best) == k:
                    needed = max(needed, best[0][0])
            sides = (np.stack([lo, place + held]), np.stack([place, hi]))
            for side, (bound, split) in enumerate(self.bounds(*sides, weight)):
                if bound >= needed:
                    heapq.heappush(waiting, (-bound, split, sides[0][side], sides[1][side]))
        return [(s, -p) for s, p in sorted(best, key=lambda x: (-x[0], -x[1]))]


def _index_blocks(batches, n_docs: int, n_terms: int, width: int):
    """ImpactIndex of every BLOCK_POSTINGS postings of the rows of ``document_terms``."""
    kept, size = [], 0

    def built():
        ids = np.concatenate([x[0] for x in kept])
        n = np.concatenate([x[1] for x in kept])
        count = np.concatenate([x[2] for x in kept])
        term = np.concatenate([x[3] for x in kept])
        tf = np.concatenate([x[4] for x in kept])
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        return ImpactIndex(ids[order], np.repeat(place, count), term, impacts(tf, np.repeat(n, count), n_docs, n_terms), width)

    for batch in batches:
        rows = 1024
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            terms, tfs = part.column("terms"), part.column("tfs")
            count = np.diff(terms.offsets.to_numpy())
            kept.append((part.column("id").to_numpy(), part.column("n").to_numpy(), count,
                         terms.flatten().to_numpy(), tfs.flatten().to_numpy()))
            size += int(count.sum())
            if size >= BLOCK_POSTINGS:
                yield built()
                kept, size = [], 0
    if kept:
        yield built()


def _best(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, block: QueryBlock, k: int) -> DataFrame:
    """(query, rank, id, score): the k best of ``docs`` (id, text) for every query of the block."""
    found = saved(document_terms(docs, block), "search-terms")
    totals = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    width = len(block.hashes)
    df = np.zeros(width, dtype=np.int64)
    held = found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toPandas()   # at most the block's terms
    df[held["t"].to_numpy(dtype=np.int64)] = held["df"].to_numpy(dtype=np.int64)
    n_docs, n_terms = int(totals["docs"]), int(totals["terms"])
    weight = term_weights(df, n_docs)

    def best_of_blocks(floors: np.ndarray, steps: int | None) -> DataFrame:
        def run(batches):
            for index in _index_blocks(batches, n_docs, n_terms, width):
                query, ids, score = [], [], []
                for q in range(len(floors)):
                    at = slice(block.first[q], block.first[q + 1])
                    for s, p in index.search(block.terms[at], weight[block.terms[at]] * block.times[at], k, int(floors[q]), steps):
                        query.append(q)
                        ids.append(index.ids[p])
                        score.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
                                                 ["query", "id", "score"])

        found_in = found.mapInArrow(run, "query int, id long, score long").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(MERGE_SALT)))
        # merged in two steps: a query's rows grow with the number of blocks
        return _best(_best(found_in, ["query", "salt"], k).drop("rank", "salt"), ["query"], k)

    # what a few steps find in every block bounds the k-th best score of all from below
    floors = np.ones(len(block.first) - 1, dtype=np.int64)
    probed = best_of_blocks(floors, PROBE_STEPS).where(F.col("rank") == k).select("query", "score").toPandas()   # a row per query at most
    floors[probed["query"].to_numpy(dtype=np.int64)] = probed["score"].to_numpy(dtype=np.int64)
    return best_of_blocks(floors, None)


def query_blocks(items: DataFrame):
    """Lists of (item_id, text bytes) of the stated queries, bounded by QUERY_ITEMS and QUERY_BYTES."""
    rows, size = [], 0
    for r in items.toLocalIterator():
        text = (r["text"] or "").encode("utf-8", "replace")
        if rows and (len(rows) == QUERY_ITEMS or size + len(text) > QUERY_BYTES):
            yield rows
            rows, size = [], 0
        rows.append((r["item_id"], text))
        size += len(text)
    if rows:
        yield rows


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item.

    Terms are runs of digits, letters A-Z (lower-cased) and code points from
    U+0080 on.  Items without terms, or whose terms no document has, give no
    rows, nor do documents without terms.  Rows that repeat an id are documents
    (items) of their own; a null doc_id comes last among equal scores.  Terms are
    known by 64-bit hash: only a document's term that meets one of a block's by
    chance could be taken for it.  The driver holds one block of items and a
    count for each of its terms.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    out = None
    for rows in query_blocks(asked):
        block = QueryBlock.of([t for _, t in rows])
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], "query int, item_id long")
        found = search_block(src, block, k).join(F.broadcast(names), "query") \
            .select("item_id", "rank", F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
