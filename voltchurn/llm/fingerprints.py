"""Document fingerprints: digests of a text's improbable byte windows.

Every 32-byte window has an entropy; windows whose entropy is rare in the
corpus are improbable.  Among each 32 neighbouring windows the most improbable
one wins; windows that win often are the text's features.  Features are
inserted into a chain of Bloom filters, and two chains are compared by the
overlap of their bits beyond what chance gives, as a share of the greatest
possible.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltchurn.llm.lines import LAST_ID
from voltchurn.llm.vocab import span_hashes

WINDOW = 32
LEVELS = 1001                 # entropy in thousandths of its maximum
WEAK = 100                    # windows below this entropy come last
FEW = 4                       # texts of fewer than so many times WINDOW windows hold smaller contests
POPULAR = 8                   # wins that make a feature
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
CHUNK = 1 << 18               # bytes handled at once; a longer text is a chunk of its own

_F = np.arange(WINDOW + 1, dtype=np.float64)
_F[1:] *= np.log2(_F[1:])
#: growth of c log2 c when a byte's count goes from c - 1 to c, as integers that add up exactly
_STEP = np.concatenate([[0], np.diff(np.round(_F * 2**20).astype(np.int64))])


def window_levels(buf: np.ndarray) -> np.ndarray:
    """Entropy level (0 to 1000) of every WINDOW-byte window of a byte array."""
    n = len(buf)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)  # of the same byte, in WINDOW bytes from / up to here
    for d in range(1, WINDOW):
        same = buf[:-d] == buf[d:]
        ahead[:-d] += same
        behind[d:] += same
    first = _STEP[np.array([np.count_nonzero(buf[:i + 1] == buf[i]) for i in range(WINDOW)])].sum()
    change = _STEP[behind[WINDOW:]] - _STEP[ahead[:n - WINDOW]]
    total = np.concatenate([[first], first + np.cumsum(change)])
    most = np.log2(WINDOW)
    entropy = most - total / (WINDOW * 2.0**20)
    return np.clip(np.round(entropy / most * (LEVELS - 1)), 0, LEVELS - 1).astype(np.int64)


def _chunks(texts: list[bytes]):
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def level_counts(texts: list[bytes]) -> np.ndarray:
    """Number of windows at each entropy level, windows across texts left out."""
    out = np.zeros(LEVELS, np.int64)
    for lo, hi in _chunks(texts):
        buf = np.frombuffer(b"".join(texts[lo:hi]), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts[lo:hi]])
        levels = window_levels(buf)
        text_end = np.repeat(ends, [len(t) for t in texts[lo:hi]])[: len(levels)]
        out += np.bincount(levels[np.arange(len(levels)) + WINDOW <= text_end], minlength=LEVELS)
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of every level: 0 for the rarest; weak levels come last."""
    level = np.arange(LEVELS)
    order = np.lexsort((level, counts, level < WEAK))
    out = np.empty(LEVELS, np.int64)
    out[order] = level
    return out


def _sliding_min(x: np.ndarray) -> np.ndarray:
    """Least of every WINDOW neighbours (WINDOW a power of two)."""
    step = 1
    while step < WINDOW:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x


def features(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each feature, its 64-bit hash) in order of text and position.

    A text shorter than a window is one feature as a whole (none if empty); one
    with too few windows for a full contest holds contests among a quarter of
    them, and every winner is a feature.  Equal features of a text count once.
    """
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum(lens) - lens
    n_windows = lens - WINDOW + 1
    owner, at, size = [], [], []
    short = np.nonzero((lens > 0) & (n_windows < 1))[0]
    owner.append(short)
    at.append(starts[short])
    size.append(lens[short])
    levels = window_levels(buf)
    key = (ranks[levels] << 40) | np.arange(len(levels))
    few = np.nonzero((n_windows >= 1) & (n_windows < FEW * WINDOW))[0]
    for i in few:
        own = key[starts[i]:starts[i] + n_windows[i]]
        contest = np.lib.stride_tricks.sliding_window_view(own, max(1, len(own) // 4)).min(axis=1)
        best = np.unique(contest) & ((1 << 40) - 1)
        owner.append(np.full(len(best), i))
        at.append(best)
        size.append(np.full(len(best), WINDOW))
    many = np.nonzero(n_windows >= FEW * WINDOW)[0]
    if len(many):
        winners = _sliding_min(key) & ((1 << 40) - 1)
        text_of = np.repeat(np.arange(len(texts)), lens)[: len(winners)]
        contest = np.arange(len(winners)) + 2 * WINDOW - 1 <= (starts + lens)[text_of]
        wins = np.bincount(winners[contest], minlength=len(levels))
        window_text = np.repeat(np.arange(len(texts)), lens)[: len(levels)]
        wins[n_windows[window_text] < FEW * WINDOW] = 0
        most = np.zeros(len(texts), np.int64)
        np.maximum.at(most, window_text[wins > 0], wins[wins > 0])
        chosen = np.nonzero((wins > 0) & (wins >= np.minimum(POPULAR, most)[window_text]))[0]
        owner.append(window_text[chosen])
        at.append(chosen)
        size.append(np.full(len(chosen), WINDOW))
    owner, at, size = np.concatenate(owner), np.concatenate(at), np.concatenate(size)
    h = span_hashes(buf, at, at + size) if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((at, h, owner))
    owner, at, h = owner[order], at[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    owner, at, h = owner[new], at[new], h[new]
    order = np.lexsort((at, owner))
    return owner[order], h[order]


def chains(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Bloom filter chain of every text: array (filters, FILTER_BITS / 8)."""
    out: list[np.ndarray] = []
    for lo, hi in _chunks(texts):
        owner, h = features(texts[lo:hi], ranks)
        n = np.bincount(owner, minlength=hi - lo)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        n_filters = -(-n // FILTER_FEATURES)
        first = np.cumsum(n_filters) - n_filters
        row = first[owner] + place // FILTER_FEATURES
        bits = np.zeros((int(n_filters.sum()), FILTER_BITS), dtype=bool)
        for k in range(HASHES):
            bits[row, ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        out.extend(packed[f:f + m] for f, m in zip(first, n_filters))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: mean best overlap of the shorter chain's filters with the other's.

    The overlap of two filters counts beyond the share that two unrelated
    filters with as many bits have, relative to the most there can be; the mean
    is weighted by the filters' bits.  Two empty chains are alike (1), an empty
    one is unlike any other (0).
    """
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    bits_a, bits_b = np.bitwise_count(a).sum(axis=1).astype(float), np.bitwise_count(b).sum(axis=1).astype(float)
    total = 0.0
    for row, n in zip(a, bits_a):
        both = np.bitwise_count(row[None, :] & b).sum(axis=1).astype(float)
        most = np.minimum(n, bits_b)
        chance = n * bits_b / FILTER_BITS
        room = most - chance
        score = np.where(room > 0, (both - chance) / np.where(room > 0, room, 1.0), both >= most)
        total += n * float(np.clip(score, 0.0, 1.0).max())
    return float(total / bits_a.sum())


def render(chain: np.ndarray) -> str:
    """The chain as text: number of filters, then the bits in base64."""
    return f"{len(chain)}:" + base64.b64encode(chain.tobytes()).decode()


def parse(fingerprint: str) -> np.ndarray:
    n, _, bits = fingerprint.partition(":")
    return np.frombuffer(base64.b64decode(bits), dtype=np.uint8).reshape(int(n), FILTER_BITS // 8)


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rarity of the entropy levels over all windows of all texts.

    Each partition counts its own windows; LEVELS sums reach the driver.
    """
    def count(batches):
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            total += level_counts([(t or "").encode("utf-8", "replace") for t in batch.column(0).to_pylist()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS), pa.int32()), pa.array(total, pa.int64())], ["level", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS, np.int64)
    for r in rows:
        counts[r["level"]] = r["n"]
    return rarity(counts)


def fingerprint_documents(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every whole text (null: empty); no shuffle.

    Equal texts have equal fingerprints under the same ``ranks``.
    """
    def run(batches):
        for batch in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([render(c) for c in chains(texts, ranks)], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fingerprint string")


# --------------------------------------------------- edited texts, neighbours

def _with_neighbours(docs: DataFrame, parts: int) -> DataFrame:
    """(bucket, closing, id, text): rows in id order within buckets of ids.

    Bucket edges are quantiles of the ids, so a row's bucket depends on its id
    alone; every bucket ends with a copy of the next bucket's first document
    (``closing``), after the last comes the first of all.
    """
    edges = docs.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)], 10 * parts).alias("q")).first()["q"] if parts > 1 else []
    edges = np.array(sorted(set(edges or [])), dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="left").astype(np.int32))

    placed = docs.withColumn("bucket", bucket_of("id")).withColumn("closing", F.lit(False))
    firsts = sorted((r["bucket"], r["id"]) for r in placed.groupBy("bucket").agg(F.min("id").alias("id")).collect())
    if not firsts:
        return placed
    before = {i: firsts[k - 1][0] for k, (_, i) in enumerate(firsts)}
    target = F.create_map(*[F.lit(x) for i, b in before.items() for x in (i, b)])
    closing = docs.where(F.col("id").isin(list(before))).withColumn("bucket", F.element_at(target, F.col("id"))) \
        .withColumn("closing", F.lit(True))
    return placed.unionByName(closing)


def compare_edited(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's fingerprint beside that of its edited text and of its neighbour.

    The edited text has the last floor(n_chars/2) code points replaced by the
    first as many (or all) of the next document, in ascending id; after the
    last comes the first.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text is empty.  A null id comes after all others; rows with the same
    id follow each other in the order of their texts' hashes.  Texts are
    shuffled once, into buckets of neighbouring ids sorted on disk, and
    streamed: a task holds one batch and one row.
    """
    spark: SparkSession = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                      F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dealt = _with_neighbours(src, parts).repartition(parts, "bucket") \
        .sortWithinPartitions("bucket", "closing", "id", "no_id", F.xxhash64("text"), "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        held = None                                   # the last row, until its next document is known
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bucket", "closing", "id", "no_id", "text")]
            rows = list(zip(*cols))
            prints = chains([r[4].encode("utf-8", "replace") for r in rows], ranks)
            queue = ([held] if held else []) + list(zip(rows, prints))
            pairs = [(a, b) for a, b in zip(queue, queue[1:]) if not a[0][1] and a[0][0] == b[0][0]]
            held = queue[-1]
            edited = []
            for (row, _), (nxt, _) in pairs:
                half = len(row[4]) // 2
                edited.append((row[4][:len(row[4]) - half] + nxt[4][:half]).encode("utf-8", "replace"))
            out = []
            for ((row, fp), (_, next_fp)), text, edited_fp in zip(pairs, edited, chains(edited, ranks)):
                out.append((None if row[3] else row[2], len(row[4]), hashlib.sha256(text).hexdigest(), render(fp),
                            render(edited_fp), likeness(fp, edited_fp), likeness(fp, next_fp)))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
