"""Ranked search against scoring every document, and its parts by themselves."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from voltchurn.llm import ranked_search as rs
from voltchurn.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """docs: (id, text); a sorted list of (item_id, rank, doc_id, score) rows."""
    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in found:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, rs.LAST_ID if i is None else i))
        out += [(item, r, None if i == rs.LAST_ID else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


def result(spark, docs, items, k=10):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, score int")
    i = spark.createDataFrame([(*r, 0.5) for r in items], "item_id long, text string, doc_id double")
    rows = [tuple(r) for r in rs.ranked_search(d, i, k).select("item_id", "rank", "doc_id", "score").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


WORDS = ["the", "of", "a", "Zürich", "ÉTÉ", "x1", "été", "naïve", "foo_bar", "don't", "日本", "alpha", "beta", "gamma", "delta", *(f"w{i}" for i in range(40))]


def random_rows(rng, n):
    return [(i, " ".join(rng.choice(WORDS[:rng.choice([4, 15, len(WORDS)])]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_against_every_document(spark, monkeypatch, block):
    monkeypatch.setattr(rs, "BLOCK_POSTINGS", block)
    rng = random.Random(4)
    docs = random_rows(rng, 300)
    docs += [(1000 + i, docs[7][1]) for i in range(30)]                       # ties
    docs += [(3, docs[3][1]), (3, "alpha alpha w1"), (None, docs[7][1]), (2000, None), (2001, ""), (2002, "!?"), (2003, "beta, " * 50_000)]
    items = [(i, t) for i, t in random_rows(rng, 15)] + [(50, docs[7][1]), (51, None), (52, "..."), (53, "unheardof"), (None, "alpha w2"), (54, "w3 w3 w3 beta")]
    assert result(spark, docs, items) == brute(docs, items)
    assert result(spark, docs, items, k=1) == brute(docs, items, k=1)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rs, "QUERY_ITEMS", 4)
    rng = random.Random(6)
    docs, items = random_rows(rng, 80), random_rows(rng, 10)
    assert result(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert result(spark, [], [(1, "alpha")]) == []
    assert result(spark, [(1, "alpha"), (2, None)], []) == []
    assert result(spark, [(1, "..."), (2, None)], [(1, "alpha")]) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(rs, "BATCH_BYTES", 50)
    texts = ["alpha Beta " * 40, "", "x" * 300, "ü" * 60 + " y", " " * 200]
    n = np.zeros(len(texts), dtype=int)
    seen = [Counter() for _ in texts]
    for h, owner in rs.term_hashes([t.encode() for t in texts]):
        for x, o in zip(h.tolist(), owner.tolist()):
            seen[o][x] += 1
            n[o] += 1
    assert n.tolist() == [80, 0, 1, 2, 0]
    assert [sorted(c.values()) for c in seen] == [[40, 40], [], [1], [1, 1], []]


def index_of(rng, docs, width):
    rows = [(d, t) for d in range(docs) for t in range(width) if rng.random() < (0.9 if t == 0 else 0.2)]
    doc, term = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    return rs.ImpactIndex(np.arange(docs), doc, term, np.array([rng.randrange(1, 50) for _ in rows]), width), rows


def test_range_maxima():
    rng = random.Random(8)
    index, _ = index_of(rng, 100, 5)
    for _ in range(300):
        t = rng.randrange(5)
        lo, hi = sorted(rng.randrange(index.first[t], index.first[t + 1] + 1) for _ in range(2))
        if lo < hi:
            at = int(index.range_maxima(np.array([lo]), np.array([hi]))[0])
            assert lo <= at < hi and index.impact[at] == index.impact[lo:hi].max()


def test_search_stops_early_and_a_floor_keeps_what_reaches_it():
    rng = random.Random(9)
    index, _ = index_of(rng, 3000, 6)
    weights = np.array([1, 40, 50, 60, 70, 80])
    score = np.zeros(3000, dtype=int)
    np.add.at(score, index.doc, index.impact * np.repeat(weights, np.diff(index.first)))
    expected = sorted(((-s, p) for p, s in enumerate(score.tolist())))[:10]
    assert index.search(np.arange(6), weights, 10) == [(-s, p) for s, p in expected]
    assert index.scored < 1000
    floor = -expected[4][0]
    assert index.search(np.arange(6), weights, 10, floor) == [(-s, p) for s, p in expected if -s >= floor]
    assert all(score[p] == s for s, p in index.search(np.arange(6), weights, 10, 1, 20))


def test_the_query_against_every_document(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_ranked_search"](spark, SF).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got) == brute(docs, items)
