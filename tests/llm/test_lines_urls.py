"""Line dedup and url filter against plain Python."""

import random

import pytest

from voltchurn.llm import lines, urls

STRIP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute_lines(docs, min_chars=10):
    """Rows of one id are one document; a null id stands last."""
    place = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(place(i))
    out = []
    for i, text in docs:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != place(i))]
        dropped = len(all_lines) - len(kept)
        out.append((i, text if not dropped else "\n".join(kept), len(all_lines), dropped))
    return sorted(out, key=str)


def corpus(seed=4):
    rng = random.Random(seed)
    pool = [f"a line number {k}" for k in range(40)] + ["short", "", "  Padded Line Number One\t", "padded line number one",
                                                        "ÉCOLE DES LIGNES", "école des lignes", "the hottest line of all"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8)))) for i in rng.sample(range(1000), 80)]
    docs += [(i, docs[0][1] + "\nthe hottest line of all") for i in range(2000, 2040)]
    return docs + [(3000, None), (3001, ""), (None, "a line number 3\nonly here, in no other"), (3002, "same twice x\nsame twice x"),
                   (3002, "same twice x\nanother line here"), (3003, "\n" * 500 + "a line number 1")]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "keep", 9, 9) for i, t in docs], "doc_id long, text string, id string, n_lines int, dropped int")
    got = lines.dedup_lines(df, batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "text", "id", "dropped", "n_lines", "n_dropped"]
    assert sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()], key=str) == brute_lines(docs)


def test_line_dedup_of_nothing(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_compacted_and_keep_the_first_holder(spark):
    store = lines.LineRuns(spark, buckets=3, fanout=2)
    schema = "id long, h1 long, h2 long"
    for b in range(5):
        found = store.add(spark.createDataFrame([(10 * b, 1, 1), (10 * b + 1, 100 + b, 0)], schema))
        assert [tuple(r) for r in found.collect()] == ([(1, 1, 0)] if b else [])
    assert len(store.runs()) < 5
    keys = [tuple(r) for name in store.runs() for r in spark.table(name).where("fresh").select("h1", "first").collect()]
    assert sorted(keys) == sorted([(1, 0)] + [(100 + b, 10 * b + 1) for b in range(5)])
    store.forget()


# ---------------------------------------------------------------------- urls

def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "https://example.net": ("example.net", "", None, "allow"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "ftp://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"),
        "//x.org/fr/": ("", "", None, "allow"),
        "http://x.org/fr/://y.net/": ("x.org", "/fr/://y.net/", "org/fr/", "allow"),
        "http://x.net?a=/": ("x.net", "", None, "allow"),
        "http://É.com/\nz": ("É.com", "/\nz", None, "allow"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages, none).collect()}
    assert got == dict(enumerate(cases.values()))


def brute_bounds(outcomes, z):
    """The levels' shrinkage in plain Python: host -> (posterior mean, lower bound)."""
    def levels(host):
        parts = host.split(".")
        cut = 3 if ".".join(parts[-2:]) in urls.SUFFIXES else 2
        return ".".join(parts[-cut:]), ".".join(parts[-cut + 1:])

    def strength(groups):
        scatter = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in groups)
        room = sum(n * (n - 1) * m * (1 - m) for n, k, m in groups)
        return min(max(1 / (scatter / room) - 1, 1.0), 1e6) if room > 0 and scatter > 0 else 1e6

    hosts = {}
    for h, bad in outcomes:
        n, k = hosts.get(h, (0, 0))
        hosts[h] = (n + (bad is not None), k + (bad or 0))
    total = [sum(x) for x in zip(*hosts.values())]
    means = {"": total[1] / total[0] if total[0] else 0.0}
    for pick in (lambda h: (levels(h)[1], ""), lambda h: (levels(h)[0], levels(h)[1]), lambda h: (h, levels(h)[0])):
        groups = {}
        for h, (n, k) in hosts.items():
            name, parent = pick(h)
            a = groups.setdefault(name, [0, 0, means[parent]])
            a[0] += n
            a[1] += k
        s = strength([tuple(g) for g in groups.values()])
        priors = {name: (s * m + k, s * (1 - m) + n - k) for name, (n, k, m) in groups.items()}
        means = {**{name: a / (a + b) for name, (a, b) in priors.items()}}
    return {h: (a / (a + b), a / (a + b) - z * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5) for h, (a, b) in priors.items()}


def test_reputation_equals_brute_force_and_blocks_bad_hosts(spark):
    rng = random.Random(6)
    rate = {"good.site.com": 0.02, "bad.site.com": 0.9, "x.mixed.org": 0.3, "y.mixed.org": 0.4, "a.b.co.uk": 0.1, "few.bad.org": 1.0}
    outcomes = [(h, int(rng.random() < r)) for h, r in rate.items() for _ in range(3 if h == "few.bad.org" else 60)]
    outcomes += [("unseen.site.com", None), ("good.site.com", None)]
    df = spark.createDataFrame(outcomes, "host string, bad int")
    got = {r["host"]: (r["post_mean"], r["lower_bound"]) for r in urls.host_reputation(df).collect()}
    want = brute_bounds(outcomes, 1.6448536269514722)
    assert got.keys() == want.keys()
    for h in want:
        assert got[h] == pytest.approx(want[h], rel=1e-9, abs=1e-12)
    pages = spark.createDataFrame([(k, f"http://{h}/p") for k, (h, _) in enumerate(outcomes)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(outcomes)] + [(None, 1), (10**6, 1)], "page_id long, bad int")
    verdicts = {r["host"]: r["verdict"] for r in urls.judge_urls(pages, labels, rules=()).collect()}
    assert verdicts["bad.site.com"] == "block" and verdicts["good.site.com"] == "allow"
    assert verdicts == {h: "block" if low > 0.3 else "allow" for h, (_, low) in want.items()}


def test_urls_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, spark.createDataFrame([], "page_id long, bad int")).count() == 0
