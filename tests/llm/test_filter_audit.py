"""Filter audit against applying every order to every document."""

import random
import re
from itertools import permutations

import numpy as np

from voltchurn.llm import filter_audit as fa

GOOD = " ".join(f"word{i}" for i in range(220))


def brute(rows, labels):
    """rows: (id, text, lang); labels: (id, quality, toxic)."""
    last = fa.LAST_ID
    fails, parts = [], []
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if any((u or "") == t and (last if j is None else j) < (last if i is None else i) for j, u, _ in rows):
            f.add("E")
        fails.append(f)
        parts.append(lang or "")
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in set(parts):
        mine = [k for k in range(len(rows)) if parts[k] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                redundant = [k for k in mine if f in fails[k] and k not in left]
                left = [k for k in left if f not in fails[k]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(redundant), sum(fails[k] == {f} for k in mine),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]] if isinstance(row[-1], str) else row[-1]
    return out


def spark_result(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, mask int, part string")
    got = fa.audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]] for r in got}
    assert len(out) == len(got)
    return out


def test_against_every_order(spark):
    rng = random.Random(3)
    pool = [GOOD, GOOD + " #", "AB " * 220, "x " * 300, "x " * 300 + "|", "", None, " \t\n", GOOD.upper(), "short", "Short $", GOOD + "\x0b\x0cword0", "é" * 50,
            "a b" + " " * 5000 + "c", "w\x1cv " * 250]
    rows = [(rng.choice([*range(40), None]), rng.choice(pool), rng.choice(["en", "de", None, ""])) for _ in range(120)]
    rows += rows[:10]                                                    # repeated rows
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(30), *range(10), None]]
    assert spark_result(spark, rows, labels) == brute(rows, labels)


def test_one_text_holds_most_rows(spark):
    rows = [(k, GOOD if k % 3 else f"{GOOD} {k}", "en" if k % 2 else "de") for k in range(400)]
    assert spark_result(spark, rows, [(1, 1, 0), (4, 0, 1)]) == brute(rows, [(1, 1, 0), (4, 0, 1)])


def test_empty_tables(spark):
    assert spark_result(spark, [], [(1, 1, 1)]) == {}
    got = spark_result(spark, [(1, GOOD, "en")], [])
    assert len(got) == 600 and all(v == [1, 0, 0, 0, 0, 0, 0] for v in got.values())


def test_ranks_and_intervals():
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [fa.lehmer_rank(o) for o in orders] == list(range(120))
    for letters, lo, hi in fa.beginnings():
        assert [o for o in orders if o.startswith("".join(letters))] == orders[lo:hi]


def test_shapley_shares_add_up():
    rng = np.random.default_rng(1)
    masks = np.arange(32)
    counts = rng.integers(0, 1000, (32, 3))
    tables = fa.audit_part(masks, counts)
    by_letter = {order[k]: tables["shapley"][r, k] for r, order in enumerate(permutations("ABCDE")) for k in range(5)}
    assert sum(by_letter.values()) == 120 * counts[1:, 0].sum()
