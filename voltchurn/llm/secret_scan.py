"""Secret scans: fixed patterns, and a battery of randomness tests.

Runs of token characters are candidates.  Each is given the narrowest encoding
that holds it, and tested against a uniform draw from that alphabet: chi-squared
of the character counts, number of runs of low and high characters, and serial
correlation of neighbours.  A candidate that no test rejects as random still
has to be told from written text.  Two bounds, tighter with length, on the chance of
such a token in text do that: one from its changes between character classes,
one from its pairs of neighbouring characters, under the corpus's own pairs
against the uniform draw.  The Benjamini-Hochberg rule over all candidates of
the corpus sets the limit on the smaller, doubled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6
KINDS = ("assign", "access", "hex", "random")

DIGITS, UPPERS, LOWERS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: encodings, narrowest first: name, pattern, alphabet in the encoding's order
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", r"^[a-z]+$", LOWERS),
    ("upper", r"^[A-Z]+$", UPPERS),
    ("base32", r"^[A-Z2-7]+=*$", UPPERS + "234567"),
    ("base36", r"^[0-9a-z]+$", DIGITS + LOWERS),
    ("BASE36", r"^[0-9A-Z]+$", DIGITS + UPPERS),
    ("alnum", r"^[0-9A-Za-z]+$", DIGITS + UPPERS + LOWERS),
    ("base64", r"^[A-Za-z0-9+/]+=*$", UPPERS + LOWERS + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", UPPERS + LOWERS + DIGITS + "-_"),
    ("mixed", r"", UPPERS + LOWERS + DIGITS + "+/-_="),
)
NOT_TOKEN = r"[^A-Za-z0-9+/_=-]+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
# Rational approximation of erfc (error below 1.5e-7).
ERFC_P, ERFC_A = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
#: what pairs are counted of: the characters of tokens, without case
SYMBOLS = DIGITS + LOWERS + "+/-_="
#: weight of the uniform draw in the pairs of text, as a count and as a share
PRIOR_COUNT, PRIOR_SHARE = 40.0, 0.05
#: p-values below 10^-MAX_EXP count as that; bins of the corpus histogram per power of ten
MAX_EXP, BINS_PER_EXP = 30, 100


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct<start,end>> of all matches, leftmost and non-overlapping."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(F.transform(gaps, F.char_length), F.lit(1), F.size(found)).alias("gap"),
                         F.transform(found, F.char_length).alias("size"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    step = lambda s, x: F.struct(
        (s["at"] + x["gap"] + x["size"]).alias("at"),
        F.array_append(s["out"], F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["size"]).alias("end"))).alias("out"))
    return F.aggregate(pairs, zero, step, lambda s: s["out"])


def _none(kind: str = "array<struct<start:int,end:int>>") -> Column:
    return F.array().cast(kind)


def with_fields(items: Column, **fields) -> Column:
    """Adds computed fields to every struct of an array.

    One pass per call, so that a later field reads an earlier one's value
    rather than repeating its expression.
    """
    def add(c):
        out = c
        for name, f in fields.items():
            out = out.withField(name, f(c))
        return out

    return F.transform(items, add)


def encoding_of(token: Column) -> Column:
    """Number in ENCODINGS of the narrowest encoding that holds the token."""
    out = F.lit(len(ENCODINGS) - 1)
    for k in reversed(range(len(ENCODINGS) - 1)):
        out = F.when(token.rlike(ENCODINGS[k][1]), k).otherwise(out)
    return out


def _squares(c: Column) -> Column:
    """Sum over the alphabet of the squared character counts."""
    counts = F.transform(F.split(c["alphabet"], ""), lambda a: F.char_length(c["body"]) - F.char_length(F.replace(c["body"], a, F.lit(""))))
    return F.aggregate(counts, F.lit(0.0), lambda s, k: s + k.cast("double") * k.cast("double"))


def _changes(c: Column) -> Column:
    """Neighbours of which one is in the alphabet's lower half, one in the upper."""
    bits = F.transform(c["index"], lambda i: (i >= c["half"]).cast("int"))
    pairs = F.zip_with(F.slice(bits, F.lit(1), F.size(bits) - 1), F.slice(bits, F.lit(2), F.size(bits) - 1), lambda a, b: F.abs(a - b))
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + x).cast("double")


def _products(c: Column) -> Column:
    """Sum of the products of neighbours' distances from the alphabet's middle."""
    far = F.transform(c["index"], lambda i: i - (c["size"] - 1) / 2)
    pairs = F.zip_with(F.slice(far, F.lit(1), F.size(far) - 1), F.slice(far, F.lit(2), F.size(far) - 1), lambda a, b: a * b)
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def _erfc(x: Column, t: Column) -> Column:
    poly = F.lit(0.0)
    for a in reversed(ERFC_A):
        poly = (poly + a) * t
    return poly * F.exp(-x * x)


def battery(items: Column) -> Column:
    """Adds p_uniform, p_runs and p_serial to structs with a ``token``.

    Under a uniform draw from the token's alphabet: upper tail of the
    chi-squared statistic of its character counts (normal, with the exact mean
    and variance), two-sided tail of the number of changes between the lower
    and the upper half of the alphabet, two-sided tail of the lag-1 serial
    correlation of the characters' places in it.
    """
    alphabets = F.array(*[F.lit(e[2]) for e in ENCODINGS])
    items = with_fields(items, kind=lambda c: encoding_of(c["token"]), bare=lambda c: F.rtrim(c["token"], F.lit("=")))
    items = with_fields(items, alphabet=lambda c: F.element_at(alphabets, c["kind"] + 1),
                        body=lambda c: F.when(c["bare"] == "", c["token"]).otherwise(c["bare"]))
    items = with_fields(items, n=lambda c: F.char_length(c["body"]).cast("double"),
                        size=lambda c: F.char_length(c["alphabet"]).cast("double"),
                        half=lambda c: F.floor(F.char_length(c["alphabet"]) / 2).cast("double"),
                        index=lambda c: F.transform(F.split(c["body"], ""), lambda ch: F.instr(c["alphabet"], ch).cast("double") - 1))
    items = with_fields(items, squares=_squares, changes=_changes, products=_products,
                        p_change=lambda c: 2 * c["half"] * (c["size"] - c["half"]) / (c["size"] * c["size"]))
    many = lambda c, z: F.when(c["n"] > 1, z).otherwise(0.0)
    items = with_fields(
        items,
        z_uniform=lambda c: many(c, (c["size"] / c["n"] * c["squares"] - c["n"] - (c["size"] - 1))
                                 / F.sqrt(2 * (c["size"] - 1) * (c["n"] - 1) / c["n"])),
        z_runs=lambda c: many(c, (c["changes"] - (c["n"] - 1) * c["p_change"])
                              / F.sqrt((c["n"] - 1) * c["p_change"] * (1 - c["p_change"]))),
        z_serial=lambda c: many(c, c["products"] * 12 / (c["size"] * c["size"] - 1) / F.sqrt(c["n"] - 1)))
    names = ("uniform", "runs", "serial")
    items = with_fields(items, **{f"x_{k}": (lambda c, k=k: F.abs(c[f"z_{k}"]) / math.sqrt(2)) for k in names})
    items = with_fields(items, **{f"t_{k}": (lambda c, k=k: 1 / (1 + ERFC_P * c[f"x_{k}"])) for k in names})
    items = with_fields(items, **{f"p_{k}": (lambda c, k=k: _erfc(c[f"x_{k}"], c[f"t_{k}"])) for k in names})
    return with_fields(items, p_uniform=lambda c: F.when(c["z_uniform"] >= 0, c["p_uniform"] / 2).otherwise(1 - c["p_uniform"] / 2))


def text_exponents(items: Column, text_change_rate: float) -> Column:
    """Adds ``exponent``: -log10 of a bound on the chance that text changes
    character class (digit, upper, lower, other) as often as the ``token``.

    A capital before a small letter counts as one, as words in names begin so.
    Chernoff's bound on a binomial upper tail over the n - 1 neighbouring
    pairs, so short tokens cannot get a small value.
    """
    r0 = text_change_rate
    items = with_fields(items, pairs=lambda c: F.char_length(c["token"]).cast("double") - 1,
                        classes=lambda c: F.translate(c["token"], DIGITS + UPPERS + LOWERS + "+/-_=", "d" * 10 + "u" * 26 + "l" * 26 + "s" * 5))
    items = with_fields(items, classes=lambda c: F.replace(c["classes"], F.lit("ul"), F.lit("ll")))
    items = with_fields(items, blocks=lambda c: F.regexp_count(c["classes"], F.lit("d+|u+|l+|s+")))
    items = with_fields(items, rate=lambda c: F.when(c["pairs"] > 0, (c["blocks"] - 1) / c["pairs"]).otherwise(0.0))
    items = with_fields(items, bits=lambda c: F.when(
        c["rate"] > r0, c["rate"] * F.ln(c["rate"] / r0)
        + F.when(c["rate"] < 1, (1 - c["rate"]) * F.ln((1 - c["rate"]) / (1 - r0))).otherwise(0.0)).otherwise(0.0))
    return with_fields(items, exponent=lambda c: F.least(c["pairs"] * c["bits"] / math.log(10), F.lit(float(MAX_EXP))))


def pair_counts(text: Column, docs: DataFrame) -> list[int]:
    """How often each symbol follows each within the runs of token characters of
    all documents, by place of the first times len(SYMBOLS) plus that of the second.

    Equal runs are counted first; what reaches the driver is one row per pair.
    """
    runs = docs.select(F.explode(F.split(text, NOT_TOKEN)).alias("run")).groupBy("run").count()
    chars = F.transform(F.split(F.lower("run"), ""), lambda ch: F.instr(F.lit(SYMBOLS), ch) - 1)
    size = len(SYMBOLS)
    places = runs.where(F.char_length("run") > 1).select("count", chars.alias("at"))
    pairs = F.zip_with(F.slice("at", F.lit(1), F.size("at") - 1), F.slice("at", F.lit(2), F.size("at") - 1), lambda a, b: a * size + b)
    out = [0] * (size * size)
    for r in places.select("count", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("count").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out


def _numbers(values) -> Column:
    """A literal array of doubles."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def pair_exponents(items: Column, counts: list[int]) -> Column:
    """Adds ``pair_exponent``: -log10 of a bound on the chance that text holds
    pairs of characters as unlike its own as the ``body``.

    Text draws a character after another as ``counts`` say, mixed with the
    uniform draw from the encoding.  By Markov's inequality the ratio of the
    two draws' chances of a token is 1/p or more with chance p at most.  Case
    does not count; unseen characters of small corpora give no evidence.
    """
    size = len(SYMBOLS)
    pairs = _numbers(counts)
    totals = [sum(counts[k * size:(k + 1) * size]) for k in range(size)]
    rows, priors = _numbers(totals), _numbers(PRIOR_COUNT + PRIOR_SHARE * n for n in totals)
    draws = _numbers(e[2].lower().count(ch) / len(e[2]) for e in ENCODINGS for ch in SYMBOLS)
    items = with_fields(items, places=lambda c: F.transform(F.split(F.lower(c["body"]), ""), lambda ch: F.instr(F.lit(SYMBOLS), ch) - 1))

    def ratio(c, a, b):
        draw, prior = draws[c["kind"] * size + b], priors[a]
        return F.when(draw > 0, F.ln(draw * (rows[a] + prior) / (pairs[a * size + b] + prior * draw))).otherwise(0.0)

    items = with_fields(items, ratios=lambda c: F.zip_with(
        F.slice(c["places"], F.lit(1), F.size(c["places"]) - 1), F.slice(c["places"], F.lit(2), F.size(c["places"]) - 1), lambda a, b: ratio(c, a, b)))
    return with_fields(items, pair_exponent=lambda c: F.aggregate(c["ratios"], F.lit(0.0), lambda s, x: s + x) / math.log(10))


def candidates(text: Column, min_length: int, alpha: float, text_change_rate: float, counts: list[int]) -> Column:
    """array<struct<start,end,exponent>>: every candidate, with exponent 0 where
    a test (each at a third of ``alpha``) rejects it as random.

    The exponent is that of twice the smaller of the two bounds under text.
    """
    pattern = CANDIDATE % min_length
    spans = F.when(text.rlike(pattern), spans_of(text, pattern)).otherwise(_none())
    items = with_fields(spans, token=lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]))
    items = pair_exponents(text_exponents(battery(items), text_change_rate), counts)
    items = with_fields(items, exponent=lambda c: F.greatest(F.lit(0.0), F.least(
        F.greatest(c["exponent"], c["pair_exponent"]) - math.log10(2), F.lit(float(MAX_EXP)))))
    return F.transform(items, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"),
        F.when(3 * F.least(c["p_uniform"], c["p_runs"], c["p_serial"]) >= alpha, c["exponent"]).otherwise(0.0).alias("exponent")))


def discovery_limit(docs: DataFrame, found: str, rate: float) -> float:
    """Benjamini-Hochberg limit, as an exponent, over all candidates of ``docs``.

    The exponents are counted in fixed bins (at most MAX_EXP * BINS_PER_EXP + 1
    rows, whatever the input); a bin counts as its least exponent.
    """
    bins = docs.select(F.explode(found).alias("c")).groupBy(F.floor(F.col("c.exponent") * BINS_PER_EXP).alias("bin")).count().collect()
    total = sum(r["count"] for r in bins)
    above, limit = 0, math.inf
    for r in sorted(bins, key=lambda r: -r["bin"]):
        above += r["count"]
        exponent = r["bin"] / BINS_PER_EXP
        if exponent > 0 and 10.0 ** -exponent <= rate * above / total:
            limit = exponent
    return limit


def scan_secrets(docs: DataFrame, text_col: str = "text", min_length: int = 20, alpha: float = 0.001,
                 false_discovery_rate: float = 0.01, text_change_rate: float = 0.15) -> DataFrame:
    """``docs`` with ``secret_spans``: array<struct<start,rank,end,kind>> by start.

    Base kinds come from fixed patterns; kind ``random`` adds the candidates
    that the battery and the false-discovery rule leave, where no base span
    overlaps.  Positions are code points, ends exclusive.  A null or empty text
    has no spans.  Built-in functions only; no row leaves its partition (runs of
    token characters are counted over a shuffle), the corpus enters through its
    pairs of characters and one bounded histogram.
    """
    src = docs.drop("secret_spans")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    random = candidates(text, min_length, alpha, text_change_rate, pair_counts(text, src))
    limit = discovery_limit(src.select(random.alias("found")), "found", false_discovery_rate)
    keys = F.when(text.rlike(ASSIGN), spans_of(text, ASSIGN)).otherwise(_none())
    values = F.when(text.rlike(ASSIGN), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(_none("array<string>"))
    cols = [F.col(f"`{c}`") for c in src.columns]
    src = src.select(F.struct(*cols).alias("row"), keys.alias("keys"), values.alias("values"),
                     F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS)).otherwise(_none()).alias("access"),
                     F.when(text.rlike(HEX), spans_of(text, HEX)).otherwise(_none()).alias("hex"), random.alias("random"))
    assign = F.transform(F.filter(F.arrays_zip("keys", "values"), lambda x: F.char_length(x["values"]) >= ASSIGN_MIN), lambda x: x["keys"])
    src = src.select("row", assign.alias("assign"), "access", "hex", F.filter("random", lambda x: x["exponent"] >= limit).alias("random"))

    def tagged(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                     s["end"].alias("end"), F.lit(kind).alias("kind")))

    base = F.concat(*[tagged(k, F.col(k)) for k in KINDS[:3]])
    src = src.select("row", base.alias("base"), tagged("random", F.col("random")).alias("random"))
    free = F.filter("random", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return src.select("row.*", F.array_sort(F.concat("base", free)).alias("secret_spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s, x):
        new = F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))) \
            .otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), new.alias("out"))

    done = F.aggregate(spans, zero, step)
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.char_length(text))))
