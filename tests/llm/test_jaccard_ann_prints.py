"""Jaccard join, nearest neighbours and fingerprints against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from voltchurn.llm import ann, fingerprints, jaccard
from voltchurn.llm.components import components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < k else frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute_groups(docs, num, den, k):
    sets = [shingles(t, k) for _, t in docs]
    group = list(range(len(docs)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
                group[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(docs):
        least[root(x)] = min(least.get(root(x), (True, 0)), (i is None, i or 0))
    shown = lambda p: None if p[0] else p[1]
    return sorted([(i, len(sets[x]), shown(least[root(x)])) for x, (i, _) in enumerate(docs)], key=str)


def copies(seed=11):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(2000)] + ["the", "of", "and"] * 150
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    docs = []
    for family in range(45):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 11, 12, 20, 40, 90, 300]))]
        if family % 3 == 0:
            words = words[:len(words) // 2] + passage.split() + words[len(words) // 2:]
        docs.append(" ".join(words))
        for _ in range(rng.choice([0, 1, 3, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                if copy:
                    k = rng.randrange(len(copy))
                    copy[k:k + rng.randint(0, 1)] = [f"z{rng.randrange(10**6)}"]
            docs.append(("\n" if rng.random() < 0.5 else " ").join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    ids = rng.sample(range(10**6), len(docs))
    return list(zip(ids, docs)) + [(10**6, None), (10**6 + 1, " \t\n"), (None, docs[0]), (ids[1], docs[40]), (ids[2], docs[2])]


@pytest.mark.parametrize("num,words,local,pivots", [(90, 3, 256, 256), (90, 3, 2, 2), (80, 5, 256, 256), (80, 5, 2, 256), (60, 1, 2, 2)])
def test_groups_equal_brute_force(spark, monkeypatch, num, words, local, pivots):
    monkeypatch.setattr(jaccard, "LOCAL_DOCS", local)        # 2: nearly every region takes the pivot levels
    monkeypatch.setattr(jaccard, "FIRST_PIVOTS", pivots)     # 2: in several levels
    docs = copies()
    df = spark.createDataFrame([(i, t, 5, "r") for i, t in docs], "doc_id long, text string, id int, region string")
    got = jaccard.jaccard_components(df, num, 100, words)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_groups(docs, num, 100, words)


def test_a_chain_in_one_large_region_stays_connected(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LOCAL_DOCS", 4)
    monkeypatch.setattr(jaccard, "FIRST_PIVOTS", 4)
    base = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(base[k:k + 80])) for k in range(40)]          # neighbours link, the ends do not
    got = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), 90, 100, 3)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_groups(docs, 90, 100, 3)


def test_a_key_of_a_third_of_all_sets_is_folded_before_it_is_shuffled():
    rng = np.random.default_rng(3)
    folded, edges, on, all_rows = jaccard._Heads(), [], [], []
    for _ in range(20):                                       # slices of one task
        nodes = rng.choice(10**9, 300, replace=False)
        keys = np.where(np.arange(300) % 3 == 0, 7, rng.integers(100, 2500, 300))
        family = np.repeat(rng.choice(10**9, 12), 9)          # near copies share many keys
        nodes, keys = np.concatenate([nodes, family]), np.concatenate([keys, np.tile(np.arange(10**6, 10**6 + 9), 12)])
        key, node, linked, head = folded.fold(nodes, keys)
        all_rows += list(zip(keys.tolist(), nodes.tolist()))
        on += list(zip(key.tolist(), node.tolist()))
        edges += list(zip(linked.tolist(), head.tolist()))
    assert sum(k == 7 for k, _ in on) == 1
    assert len(on) + len(edges) <= len(all_rows)

    def groups(rows, links):
        least = {}

        def root(x):
            while least.setdefault(x, x) != x:
                x = least[x]
            return x

        first = {}
        for a, b in links + [(n, first.setdefault(k, n)) for k, n in rows]:
            a, b = root(a), root(b)
            least[max(a, b)] = min(a, b)
        return {x: root(x) for x in list(least)}

    assert groups(on, edges) == groups(all_rows, [])
    assert [len(x) for x in folded.fold(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0, 0, 0]


def test_salted_heads_connect_what_shares_a_key(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "KEY_PARTS", 5)
    rows = [(7, n) for n in range(200)] + [(8, 199), (8, 500), (9, 900)]
    heads = jaccard._salted_heads(spark.createDataFrame(rows, "key long, node long"))
    got = {r["node"]: r["label"] for r in components(heads.selectExpr("node as a", "head as b")).collect()}
    assert got == {n: 0 for n in [*range(200), 500]}
    held = heads.groupBy("head").count().agg({"count": "max"}).first()[0]
    assert held < 100                                         # no head gathers a whole key


def test_pivots_in_blocks_by_bytes(spark, monkeypatch):
    for name, value in (("LOCAL_DOCS", 2), ("FIRST_PIVOTS", 8), ("PIVOT_BYTES", 300)):
        monkeypatch.setattr(jaccard, name, value)
    docs = copies(15)
    got = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), 80, 100, 5)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_groups(docs, 80, 100, 5)


def test_linked_sets_share_a_key():
    docs = [t or "" for _, t in copies(12)]
    hashes, sizes = jaccard.shingle_sets([t.encode() for t in docs])
    sets = [shingles(t, 3) for t in docs]
    assert sizes.tolist() == [len(s) for s in sets]
    values, counts = np.unique(hashes, return_counts=True)
    for t in (jaccard.Threshold(90, 100), jaccard.Threshold(60, 100)):
        for frequent in (np.zeros(0, np.uint64), values[counts > 8]):
            keys = [set(k.tolist()) for k in jaccard.block_keys(hashes, sizes, frequent, t)]
            for a in range(len(docs)):
                for b in range(a):
                    inter = len(sets[a] & sets[b])
                    if sets[a] != sets[b] and inter and t.linked(inter, len(sets[a] | sets[b])):
                        assert keys[a] & keys[b]


def test_one_document_of_each_group_stays(spark):
    docs = copies(13)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, n string")
    kept = jaccard.keep_one_of_each(df, 80, 100, 5)
    assert kept.columns == df.columns
    got = {r["doc_id"] for r in kept.collect()}           # an id with two texts may head two groups
    groups = brute_groups(docs, 80, 100, 5)
    assert got == {i for i, n, c in groups if i == c}
    assert jaccard.keep_one_of_each(df.limit(0)).count() == 0
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(100, 7), (200, 201), (201, 202), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 31)}, 100: 1, 200: 200, 201: 200, 202: 200}


# ------------------------------------------------------------------- vectors

def brute_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        out[q] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(14)
    rows = [(int(i), rng.standard_normal(16).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[100][1]) for i in range(200)]                 # one vector fills a part of the table
    odd = [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] + [1.0] * 15), (5300, [None] + [1.0] * 15), (5400, [1.0] * 4),
           (None, [1.0] * 16), (5500, []), (5600, [float("inf")] * 16)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, id string")
    rows = [(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows]
    got = {}
    for r in ann.nearest_neighbours(df, df.where("vec_id % 100 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert got.keys() == want.keys()
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hit += len({i for _, i, _ in found} & {i for i, _ in want[q]})
    assert hit / (10 * len(want)) >= 0.9
    assert [(i, s) for _, i, s in sorted(got[100])] == want[100]           # ties go to the smaller ids
    everything = ann.nearest_neighbours(df, df.where("vec_id % 100 = 0"), share=100.0).collect()
    assert {(r["query_id"], r["vec_id"]) for r in everything} == {(q, i) for q, w in want.items() for i, _ in w}


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0])], schema)
    assert [tuple(r) for r in ann.nearest_neighbours(two, two).orderBy("query_id").collect()] == [(0, 1, 7, 2**0.5), (7, 1, 0, 2**0.5)]
    assert ann.nearest_neighbours(two.limit(1), two).count() == 0
    assert ann.nearest_neighbours(two.limit(0), two).count() == 0


# -------------------------------------------------------------- fingerprints

def test_window_levels_equal_brute_force():
    rng = random.Random(15)
    buf = np.frombuffer(bytes(rng.choice(b"aaab cde") for _ in range(400)) + bytes(range(200)), dtype=np.uint8)
    for at, level in enumerate(fingerprints.window_levels(buf)):
        _, n = np.unique(buf[at:at + fingerprints.WINDOW], return_counts=True)
        p = n / fingerprints.WINDOW
        entropy = -(p * np.log2(p)).sum() / np.log2(fingerprints.WINDOW)
        assert abs(level - entropy * (fingerprints.LEVELS - 1)) <= 0.51


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_fingerprints_do_not_depend_on_the_batch_and_tell_likeness():
    rng = random.Random(16)
    texts = [prose(rng, n).encode() for n in (0, 1, 3, 8, 15, 30, 60, 200, 900, 4000, 60_000)]
    ranks = fingerprints.rarity(fingerprints.level_counts(texts))
    together = fingerprints.chains(texts, ranks)
    for t, chain in zip(texts, together):
        alone = fingerprints.chains([t], ranks)[0]
        assert (alone == chain).all()
        assert fingerprints.likeness(alone, chain) == 1.0
        assert (fingerprints.parse(fingerprints.render(chain)) == chain).all()
    counted = sum(fingerprints.level_counts([t]) for t in texts)
    assert (counted == fingerprints.level_counts(texts)).all()
    for k, t in enumerate(texts[7:9]):                       # a changed word spoils 32 bytes on either side
        words = t.decode().split()
        words[len(words) // 2] = "changed"
        near, half, other = fingerprints.chains([" ".join(words).encode(), t[:len(t) // 2] + texts[9][:len(t) // 2], prose(rng, len(words)).encode()], ranks)
        own = together[k + 7]
        assert fingerprints.likeness(own, near) > 0.75
        assert 0.25 < fingerprints.likeness(own, half) < 0.85
        assert fingerprints.likeness(own, other) < 0.15


def test_edited_texts_and_neighbours(spark):
    rng = random.Random(17)
    rows = [(i, prose(rng, rng.choice([0, 1, 5, 50, 200])) + "é日") for i in rng.sample(range(10**12), 60)] + [(3, None), (-5, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string").repartition(3)
    ranks = fingerprints.corpus_ranks(df)
    got = {r["doc_id"]: r for r in fingerprints.compare_edited(df, ranks).collect()}
    rows.sort()
    texts = [t or "" for _, t in rows]
    chains = fingerprints.chains([t.encode() for t in texts], ranks)
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        nxt = (k + 1) % len(rows)
        half = len(texts[k]) // 2
        edited = texts[k][:len(texts[k]) - half] + texts[nxt][:half]
        edited_chain = fingerprints.chains([edited.encode()], ranks)[0]
        assert got[i]["n_chars"] == len(texts[k])
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["fingerprint"] == fingerprints.render(chains[k])
        assert got[i]["edited_fingerprint"] == fingerprints.render(edited_chain)
        assert got[i]["near_edited"] == fingerprints.likeness(chains[k], edited_chain)
        assert got[i]["near_next"] == fingerprints.likeness(chains[k], chains[nxt])
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(df, ranks).collect()}
    assert plain == {i: r["fingerprint"] for i, r in got.items()}


def test_fingerprint_edge_rows(spark):
    schema = "doc_id long, text string"
    ranks = fingerprints.rarity(np.zeros(fingerprints.LEVELS, np.int64))
    alone = spark.createDataFrame([(4, "the only document")], schema)
    assert fingerprints.compare_edited(alone, ranks).first()["near_next"] == 1.0
    twice = spark.createDataFrame([(None, "no id"), (2, "same"), (2, "same"), (2, "other")], schema)
    got = fingerprints.compare_edited(twice, ranks).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == [("2", 4), ("2", 4), ("2", 5), ("None", 5)]
    assert fingerprints.compare_edited(alone.limit(0), fingerprints.corpus_ranks(alone.limit(0))).count() == 0


def test_rows_that_repeat_an_id_with_other_vectors_are_candidates(spark):
    import random

    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(0, 150, 3)]           # a second vector of the same id
    rows += rows[:20]                                                                      # and rows that repeat as they are
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), k=5, share=100.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 50, 100):
        near = {}
        for i, v in rows:
            for j, u in rows:
                if j == q and i != q:
                    d = float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum()))
                    near[i] = min(near.get(i, d), d)
        want = sorted((d, i) for i, d in near.items())[:5]
        assert [(i, pytest.approx(d)) for d, i in want] == [(i, d) for _, i, d in sorted(got[q])]
