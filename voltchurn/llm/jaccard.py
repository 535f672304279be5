"""N-gram Jaccard join in metric space: exact links at a similarity threshold.

Jaccard distance obeys the triangle inequality.  Documents are first brought
into regions that no link leaves; small regions are joined exactly where they
are; large ones choose pivots, every member measures its exact distance to
them, and the triangle inequality says which members still have to meet: those
within the threshold of a pivot are linked to it, those within twice the
threshold are boundary documents of the pivot's region and stay together with
it, the others cannot link into it.  What remains forms regions again, under a
new hash, with more pivots.

Regions come from block keys that linked sets must share: similar sets differ
in few elements, so of one block more than that many, cut by hash, at least one
is the same in both (sizes are cut into classes first, as similar sets have
similar sizes).  Shingles that very many documents share are left out of the
blocks (this can only lessen the differences); sets with too many empty blocks
then use blocks over their whole set.  Regions that come out large are formed
anew by prefix keys: in the order of the shingles' exact frequency among the
documents left, rarest first, the first elements of similar sets meet.

Shingles and sets are known by 64-bit hashes: two different sets of one hash
would pass for equal (chance about 3 % for any such pair in 1e9 distinct sets).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltchurn.llm.components import components, saved
from voltchurn.llm.lines import LAST_ID
from voltchurn.llm.vocab import span_hashes
from voltchurn.llm.workers import lean

BATCH_BYTES = 1 << 20
LOCAL_DOCS = 256              # regions up to this size are joined in one task
FIRST_PIVOTS = 256             # per large region; times PIVOT_GROWTH with every level
PIVOT_GROWTH = 8
FREQUENT_SHARE = 0.002        # of a batch's documents, 4 at least, to be counted as frequent
FREQUENT_KEPT = 1 << 17       # the most frequent shingles, left to the end of every order
SETS_REMEMBERED = 1 << 18      # by a task that signs sets
KEYS_REMEMBERED = 1 << 18      # shared keys whose head such a task keeps
KEY_PARTS = 64                 # of a prefix key's documents
PIVOT_BYTES = 32 << 20         # of pivot texts that a lot measures against at once


@dataclass(frozen=True)
class Threshold:
    """Similarity num / den, in whole numbers."""

    num: int = 90
    den: int = 100

    def linked(self, inter, union):
        return (inter > 0) & (self.den * inter >= self.num * union)

    def near(self, inter, union):
        """Within twice the threshold's distance."""
        return (union > 0) & (self.den * inter >= (2 * self.num - self.den) * union)

    def blocks(self, largest: int) -> int:
        """More blocks than two linked sets of this size at most can differ in."""
        return 2 * largest * (self.den - self.num) // (self.den + self.num) + 1

    def prefix(self, sizes):
        """Elements that must be keys of a set of this size, in a common order."""
        return sizes - (self.num * sizes + self.den - 1) // self.den + 1

    def largest_partner(self, size: int) -> int:
        return size * self.den // self.num


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slices(texts: list[bytes]):
    """Runs of texts of about BATCH_BYTES; a longer text is a run of its own."""
    lo = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BATCH_BYTES:
            yield texts[lo:i]
            lo, size = i, 0
        size += len(text)
    if lo < len(texts):
        yield texts[lo:]


def _offsets(texts: list[bytes]):
    """The slices of ``texts`` with the place of their first text."""
    at = 0
    for part in _slices(texts):
        yield at, part
        at += len(part)


def shingle_sets(texts: list[bytes], words: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): each text's distinct shingles as ascending 64-bit hashes.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased; a
    text of fewer words than a shingle has its whole sequence as one.
    """
    hashes, sizes = [], []
    for part in _slices(texts):
        h, n = _shingle_batch(part, words)
        hashes.append(h)
        sizes.append(n)
    if not sizes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(sizes)


def _shingle_batch(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    buf = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    gap = (buf == 0x20) | ((buf >= 0x09) & (buf <= 0x0D))
    word = ~gap
    starts = np.nonzero(word & np.concatenate([[True], gap[:-1]]))[0]
    ends = np.nonzero(word[:-1] & gap[1:])[0] + 1
    lens = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    owner = np.searchsorted(np.cumsum(lens), starts, side="right")
    h = span_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n_words = np.bincount(owner, minlength=len(texts))
    full = np.zeros(0, np.int64)
    out, out_owner = [], []
    if len(h) >= k:
        full = np.nonzero(owner[: len(h) - k + 1] == owner[k - 1:])[0]
        acc = np.zeros(len(full), np.uint64)
        for j in range(k):
            acc = _mix(acc, 0) + _mix(h[full + j], j + 1)
        out.append(_mix(acc, 101))
        out_owner.append(owner[full])
    first_word = np.cumsum(n_words) - n_words
    few = np.nonzero((n_words > 0) & (n_words < k))[0]
    if len(few):
        acc = n_words[few].astype(np.uint64)
        for j in range(k - 1):
            has = n_words[few] > j
            nxt = _mix(acc, 7) + _mix(h[np.where(has, first_word[few] + j, 0)], j + 50)
            acc = np.where(has, nxt, acc)
        out.append(_mix(acc, 202))
        out_owner.append(few)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    out, out_owner = np.concatenate(out), np.concatenate(out_owner)
    order = np.lexsort((out, out_owner))
    out, out_owner = out[order], out_owner[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (out_owner[1:] != out_owner[:-1])
    return out[new], np.bincount(out_owner[new], minlength=len(texts))


@lru_cache(maxsize=64)
def _class_limits(upto: int) -> np.ndarray:
    """First sizes of the size classes; each reaches to 10/7 of its first size."""
    out = [1]
    while out[-1] <= upto:
        out.append(out[-1] * 10 // 7 + 1)
    return np.array(out, dtype=np.int64)


@lru_cache(maxsize=256)
def _scheme(t: Threshold, smallest: int, largest: int) -> tuple[int, int]:
    """(blocks, spare ones) for sets of these sizes; none where only equal sets link.

    Spare blocks: about as many as a set of the smallest size leaves empty by
    chance, three deviations more, and two.
    """
    needed = t.blocks(largest)
    if needed == 1:
        return 0, 0
    spare = 2
    while True:
        expected = (needed + spare) * math.exp(-smallest / (needed + spare))
        wanted = math.ceil(expected + 3 * math.sqrt(expected)) + 2
        if wanted <= spare or spare >= needed:
            return needed + spare, spare
        spare += 1


def block_keys(hashes: np.ndarray, sizes: np.ndarray, frequent: np.ndarray, t: Threshold) -> list[np.ndarray]:
    """Signature keys of every set; linked sets that differ share one at least.

    A set takes part in the scheme of its size class, and in the next ones that
    a partner can be in.  Every scheme has some blocks to spare, which may be
    empty in both of a pair.  Keys of a scheme: one per block over the set
    without ``frequent``; sets with more empty blocks than are spare also have
    one per block over the whole set (and over its empty blocks, if those are
    too many again).
    """
    keys: list[list[np.ndarray]] = [[] for _ in sizes]
    if not len(hashes):
        return [np.zeros(0, np.int64) for _ in sizes]
    limits = _class_limits(1 << int(t.largest_partner(int(sizes.max()))).bit_length())
    own = np.searchsorted(limits, np.maximum(sizes, 1), side="right") - 1
    upper = np.searchsorted(limits, np.maximum(t.largest_partner(sizes), 1), side="right") - 1
    place = _mix(hashes, 1000) >> np.uint64(32)
    low = (_mix(hashes, 2000) & np.uint64(0xFFFFFFFF)).astype(np.float64)
    high = (_mix(hashes, 3000) & np.uint64(0xFFFFFFFF)).astype(np.float64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rare = frequent[at] != hashes
    else:
        rare = np.ones(len(hashes), dtype=bool)
    first = np.cumsum(sizes) - sizes
    for part in range(int((upper - own).max()) + 1):
        scheme = own + part
        docs = np.nonzero((sizes > 0) & (scheme <= upper))[0]
        sizing = [_scheme(t, int(limits[c]), int(limits[c + 1] - 1)) for c in scheme[docs]]
        m, spare = np.array(sizing, dtype=np.int64).reshape(-1, 2).T
        docs, m, spare = docs[m > 0], m[m > 0], spare[m > 0]
        if not len(docs):
            continue
        n = sizes[docs]
        total = int(n.sum())
        elem = np.repeat(first[docs] - (np.cumsum(n) - n), n) + np.arange(total)
        base = np.cumsum(m) - m
        block = np.repeat(base, n) + ((place[elem] * np.repeat(m, n).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        size = int(m.sum())
        doc_of = np.repeat(np.arange(len(docs)), m)
        number = np.arange(size) - base[doc_of]
        marks = (scheme[docs][doc_of].astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64)

        def signatures(elements: np.ndarray, where: np.ndarray, kind: int):
            count = np.bincount(where, minlength=size)
            a = np.bincount(where, weights=low[elements], minlength=size).astype(np.uint64)
            b = np.bincount(where, weights=high[elements], minlength=size).astype(np.uint64)
            return count, _mix(_mix(_mix(a, 11) + b, 12) + marks, 13 + kind)

        keep = rare[elem]
        count, sig = signatures(elem[keep], block[keep], 0)
        empty = np.bincount(doc_of, weights=count == 0, minlength=len(docs))
        use = [(count > 0, sig)]
        sparse = empty > spare
        if sparse.any():
            whole_count, whole = signatures(elem, block, 1)
            bare = np.bincount(doc_of, weights=whole_count == 0, minlength=len(docs)) > spare
            use.append((sparse[doc_of] & ((whole_count > 0) | bare[doc_of]), whole))
        for mask, s in use:
            picked = s[mask].view(np.int64)
            per = np.bincount(doc_of[mask], minlength=len(docs))
            ends = np.cumsum(per)
            for d, e, c in zip(docs.tolist(), ends.tolist(), per.tolist()):
                if c:
                    keys[d].append(picked[e - c:e])
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in keys]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]


def _set_ids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set."""
    ends = np.cumsum(sizes)
    acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes, 5), dtype=np.uint64)])
    return _mix(acc[ends] - acc[ends - sizes] + sizes.astype(np.uint64), 6).view(np.int64)


def frequent_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """The shingles most documents share (ascending), counted over all of them.

    Every batch counts its own documents' shingles and reports those in at
    least FREQUENT_SHARE of them; sums of the reports rank them.  At most
    FREQUENT_KEPT reach the driver.  Which shingles these are bears on cost
    alone, not on results.
    """
    def count(batches):
        for batch in batches:
            hashes, sizes = shingle_sets(_texts(batch), words)
            h, n = np.unique(hashes, return_counts=True)
            often = n >= max(4, FREQUENT_SHARE * len(sizes))
            yield pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64), pa.int64()), pa.array(n[often], pa.int64())], ["h", "n"])

    rows = (docs.select("text").mapInArrow(lean(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "h").limit(FREQUENT_KEPT).select("h").toPandas())
    return np.sort(rows["h"].to_numpy(dtype=np.int64).view(np.uint64))


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, text_hash, n, s1) of every document (id, text): size and name of its set."""
    def run(batches):
        for batch in batches:
            for at, texts in _offsets(_texts(batch)):
                hashes, sizes = shingle_sets(texts, words)
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(_set_ids(hashes, sizes), pa.int64())],
                    ["id", "text_hash", "n", "s1"])

    return docs.select("id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(lean(run), "id long, text_hash long, n long, s1 long")


class _Heads:
    """The keys of a task's sets, folded slice by slice.

    Sets that share keys within a slice are linked to the smallest of their
    component (its head), which alone goes on with the component's keys.  A key
    folded once keeps its head for the task, so a key that a third of all sets
    share leaves a task about once, and a family of near copies leaves as one
    node.  What is remembered is bounded.
    """

    def __init__(self):
        self.heads: dict[int, int] = {}

    def fold(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(key, node) that go on and (node, head) linked here."""
        if not len(keys):
            none = np.zeros(0, np.int64)
            return none, none, none, none
        order = np.argsort(keys, kind="stable")
        names, node = np.unique(nodes[order], return_inverse=True)
        key = keys[order]
        at = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        size = np.diff(np.append(at, len(key)))
        label = np.arange(len(names))                  # of the slice's nodes, in ascending order
        while True:
            near = label.copy()
            np.minimum.at(near, node, np.repeat(np.minimum.reduceat(label[node], at), size))
            near = near[near]
            if (near == label).all():
                break
            label = near
        head = names[label[node[at]]]
        goes_on = np.ones(len(at), dtype=bool)
        pairs = [np.stack([names, names[label]], axis=1)[label != np.arange(len(names))]]
        known = []
        for g in np.nonzero(size > 1)[0].tolist():
            first = self.heads.setdefault(int(key[at[g]]), int(head[g]))
            if first != head[g]:
                known.append((int(head[g]), first))
                goes_on[g] = False
        if known:
            pairs.append(np.unique(np.array(known, dtype=np.int64), axis=0))
        if len(self.heads) > KEYS_REMEMBERED:
            self.heads.clear()
        linked = np.concatenate(pairs)
        return key[at[goes_on]], head[goes_on], linked[:, 0], linked[:, 1]


def _key_heads(docs: DataFrame, frequent: np.ndarray, t: Threshold, words: int) -> DataFrame:
    """(node, head): sets (by s1) that share a block key, each linked to a set that has it too.

    Of equal sets that a task remembers one has keys.  Keys are folded in the
    task that makes them (``_Heads``); the rest meet by a window over the key,
    which so holds about one row of a key per task.
    """
    def run(batches):
        seen: set[int] = set()
        folded = _Heads()
        for batch in batches:
            for _, texts in _offsets(_texts(batch)):
                hashes, sizes = shingle_sets(texts, words)
                s1 = _set_ids(hashes, sizes)
                new = []
                for i, s in enumerate(s1.tolist()):
                    if s not in seen:
                        seen.add(s)
                        new.append(i)
                if len(seen) > SETS_REMEMBERED:
                    seen.clear()
                of = np.zeros(len(sizes), dtype=bool)
                of[new] = True
                keys = block_keys(hashes[np.repeat(of, sizes)], sizes[of], frequent, t)
                nodes = np.repeat(s1[of], [len(k) for k in keys])
                keys, nodes, linked, heads = folded.fold(nodes, np.concatenate(keys) if keys else np.zeros(0, np.int64))
                none = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes), none], ["key", "node", "head"])
                yield pa.RecordBatch.from_arrays([pa.array(linked), pa.array(linked), pa.array(heads)], ["key", "node", "head"])

    found = docs.select("text").mapInArrow(lean(run), "key long, node long, head long")
    meeting = Window.partitionBy("key", F.col("head").isNull())          # rows with a head stand apart, by node
    return found.withColumn("head", F.coalesce("head", F.min("node").over(meeting))).select("node", "head")


def _salted_heads(postings: DataFrame) -> DataFrame:
    """(node, head) of postings (key, node): in every part of a key the nodes are
    linked to the part's smallest, and those to the smallest of all parts.  The
    others stand alone in the second window, so neither window holds a hot key."""
    part = Window.partitionBy("key", F.pmod(F.xxhash64("node"), F.lit(KEY_PARTS)))
    parts = postings.withColumn("near", F.min("node").over(part))
    alone = F.when(F.col("node") != F.col("near"), F.col("node"))
    top = F.min("node").over(Window.partitionBy("key", alone))
    return parts.select("node", F.when(alone.isNotNull(), F.col("near")).otherwise(top).alias("head"))


def _regions(heads: DataFrame, name: str) -> DataFrame:
    """(node, region, members) of the nodes linked to another one by (node, head).

    Before the components are sought, every node's heads are linked to the
    smallest of them instead of to the node, which leaves one edge per node and
    few between heads.
    """
    edges = heads.where("node <> head").distinct()
    least = edges.withColumn("least", F.min("head").over(Window.partitionBy("node")))
    both = F.explode(F.array("node", "head")).alias("a")
    labels = components(least.select(both, F.col("least").alias("b")), name)
    sizes = labels.groupBy("label").agg(F.count("*").alias("members"))
    return labels.join(sizes, "label").select("node", F.col("label").alias("region"), "members")


def _regions_by_frequency(open_docs: DataFrame, t: Threshold, words: int) -> DataFrame:
    """Regions of open documents by prefix keys, rarest shingle among them first.

    Shingles of one document alone come first in every order and meet nothing;
    only the others are ranked, behind as many places.
    """
    def run(batches):
        for batch in batches:
            for at, texts in _offsets(_texts(batch)):
                hashes, sizes = shingle_sets(texts, words)
                ids = np.repeat(batch.column("id").to_numpy()[at:at + len(texts)], sizes)
                last = np.repeat(t.prefix(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(last, pa.int64()), pa.array(hashes.view(np.int64), pa.int64())], ["node", "last", "key"])

    found = open_docs.select("id", "text").mapInArrow(lean(run), "node long, last long, key long")
    frequency = found.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("df")).where("lo < hi")
    mine = Window.partitionBy("node")
    shared = found.join(frequency.select("key", "df"), "key") \
        .withColumn("place", F.dense_rank().over(mine.orderBy("df", "key"))).withColumn("shared", F.max("place").over(mine))
    # place among all = place + (size - shared), to be at most the prefix
    postings = shared.where(F.col("place") - F.col("shared") <= F.col("last")).select("node", "key").distinct()
    return _regions(_salted_heads(postings), "jaccard-regions")


class _Sets:
    """Sets of a group of documents, one after the other in one array."""

    def __init__(self, texts: list[bytes], words: int):
        self.hashes, self.sizes = shingle_sets(texts, words)
        self.ends = np.cumsum(self.sizes)
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.ends[i] - self.sizes[i]:self.ends[i]]

    def overlaps(self, pivot: np.ndarray) -> np.ndarray:
        """Intersection size of every set with ``pivot`` (ascending)."""
        if not len(pivot) or not len(self.hashes):
            return np.zeros(len(self.sizes), np.int64)
        at = np.minimum(np.searchsorted(pivot, self.hashes), len(pivot) - 1)
        return np.bincount(self.owner[pivot[at] == self.hashes], minlength=len(self.sizes))


def local_links(texts: list[bytes], t: Threshold, words: int) -> list[tuple[int, int]]:
    """Links that connect a region's documents, exactly as all links would.

    Pivots in turn measure all open documents.  A document linked to a pivot
    closes once no boundary document of that pivot is outside its component.
    """
    sets = _Sets(texts, words)
    label = np.arange(len(texts))
    is_open = np.ones(len(texts), dtype=bool)
    links = []
    while is_open.any() and len(np.unique(label[is_open])) > 1:
        p = int(np.nonzero(is_open)[0][0])
        inter = sets.overlaps(sets.of(p))
        union = sets.sizes + sets.sizes[p] - inter
        linked = is_open & t.linked(inter, union)
        linked[p] = False
        for q in np.nonzero(linked)[0].tolist():
            if label[q] != label[p]:
                links.append((q, p))
                label[label == max(label[q], label[p])] = min(label[q], label[p])
        is_open[p] = False
        boundary = is_open & t.near(inter, union) & (label != label[p])
        if not boundary.any():
            is_open &= ~linked
    return links


def _local_join(members: DataFrame, t: Threshold, words: int) -> DataFrame:
    """Links (a, b) inside small regions; a task holds one region at a time."""
    def links_of(rows: dict) -> list[tuple[int, int]]:
        ids = list(rows)
        return [(ids[a], ids[b]) for a, b in local_links([rows[i] for i in ids], t, words)]

    def run(batches):
        region, rows = None, {}
        for batch in batches:
            out = []
            for r, i, text in zip(batch.column("region").to_pylist(), batch.column("id").to_pylist(), _texts(batch)):
                if r != region:
                    out += links_of(rows)
                    region, rows = r, {}
                rows[i] = text
            yield _edge_batch(out)
        yield _edge_batch(links_of(rows))

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.select("region", "id", "text").repartition(n, "region").sortWithinPartitions("region", "id") \
        .mapInArrow(lean(run), "a long, b long")


def _edge_batch(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in (0, 1)], ["a", "b"])


def _measure(members: DataFrame, pivots: DataFrame, t: Threshold, words: int) -> DataFrame:
    """(id, pivot, linked) for members within twice the threshold of a pivot.

    Of the pivots a member is linked to, it names the first as linked; the
    others are named as linked to that one, and with null by the member.
    Boundary documents that share the pivot's label already are not named.
    Members of a region are dealt into lots of about LOCAL_DOCS, and its pivots
    into blocks of about PIVOT_BYTES; every lot meets every block in a group of
    its own, so no task holds a region or all its pivots.  The first pivot is
    the first of a block: links of several blocks meet in the member.
    """
    lots = F.ceil(F.col("members") / LOCAL_DOCS).cast("int")
    sized = pivots.groupBy("region").agg(F.ceil((F.sum(F.octet_length("text")) + 1) / PIVOT_BYTES).cast("int").alias("blocks"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = members.join(sized, "region").select("region", F.pmod(F.xxhash64("id"), lots).cast("int").alias("lot"), upto(F.col("blocks")).alias("block"),
                                                 F.lit(1).alias("role"), "id", "label", "text")
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int")
    copies = pivots.join(sized, "region").select("region", upto(lots).alias("lot"), block.alias("block"), F.lit(0).alias("role"), "id", "label", "text")

    def run(batches):
        group, pivots_of = None, []                    # the group's pivots, as (ids, labels, sets) by batch
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("region", "lot", "block", "role", "id", "label")]
            rows = list(zip(*cols, _texts(batch)))
            at = 0
            while at < len(rows):
                if rows[at][:3] != group:
                    group, pivots_of = rows[at][:3], []
                end = at
                while end < len(rows) and rows[end][:4] == rows[at][:4]:
                    end += 1
                ids, labels, texts = ([r[k] for r in rows[at:end]] for k in (4, 5, 6))
                sets = _Sets(texts, words)
                if rows[at][3] == 0:
                    pivots_of.append((ids, labels, sets))
                elif pivots_of:
                    yield _measured(ids, labels, sets, pivots_of, t)
                at = end

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.unionByName(copies).repartition(n, "region", "lot", "block").sortWithinPartitions("region", "lot", "block", "role", "id") \
        .mapInArrow(lean(run), "id long, pivot long, linked boolean")


def _measured(ids: list[int], labels: list[int], sets: _Sets, pivots_of: list, t: Threshold) -> pa.RecordBatch:
    """(id, pivot, linked) of some members against their group's pivots."""
    out, first = [], {}
    for pivot_ids, pivot_labels, pivot_sets in pivots_of:
        for k, p in enumerate(pivot_ids):
            inter = sets.overlaps(pivot_sets.of(k))
            union = sets.sizes + pivot_sets.sizes[k] - inter
            linked = t.linked(inter, union)
            for j in np.nonzero(t.near(inter, union))[0].tolist():
                if ids[j] == p:
                    continue
                if not linked[j]:
                    if labels[j] != pivot_labels[k]:
                        out.append((ids[j], p, False))
                elif j not in first:
                    first[j] = p
                    out.append((ids[j], p, True))
                else:
                    out.append((p, first[j], True))
                    out.append((ids[j], p, None))
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.bool_()))], ["id", "pivot", "linked"])


def jaccard_links(docs: DataFrame, t: Threshold, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, representatives, links) of documents (id, text).

    sets: id, text_hash, n and s1 of every document; representatives: s1 and
    the smallest id (rep) of every distinct set; links: pairs (a, b) of sets
    (by s1) at the threshold or above, enough of them to connect what all such
    links connect.
    """
    sets = saved(_sets(docs, words), "jaccard-sets")
    reps = sets.where("n > 0").groupBy("s1").agg(F.min("id").alias("rep"))
    regions = _regions(_key_heads(docs, frequent_shingles(docs, words), t, words), "jaccard-regions")
    chosen = regions.join(reps, F.col("node") == F.col("s1")).select("region", "members", F.col("rep").alias("id"), "s1")
    members = saved(_one_text_each(docs.join(chosen, "id"), words), "jaccard-members")
    links = _local_join(members.where(F.col("members") <= LOCAL_DOCS), t, words)
    # large regions: formed anew by frequency, then levels of pivots; what their links connect is
    # kept as labels, apart from the small regions' links
    open_docs, labels, level = members.where(F.col("members") > LOCAL_DOCS), None, 0
    while largest := open_docs.agg(F.max("members")).first()[0]:
        pivots = FIRST_PIVOTS * PIVOT_GROWTH**level
        if level % 3 == 0:
            regions = _regions_by_frequency(open_docs, t, words).withColumnRenamed("node", "id")
            members = saved(open_docs.drop("region", "members").join(regions, "id").select("region", "members", "id", "text"), "jaccard-members")
            links = links.unionByName(_local_join(members.where(F.col("members") <= LOCAL_DOCS), t, words))
            open_docs = members.where(F.col("members") > LOCAL_DOCS)
            largest = open_docs.agg(F.max("members")).first()[0]
            if not largest:
                break
        if largest <= pivots:                          # every document can be a pivot: all links at once
            links = links.unionByName(_measure_all(open_docs, t, words))
            break
        labels, open_docs = _pivot_level(open_docs, labels, pivots, t, words)
        level += 1
    if labels is not None:
        links = links.unionByName(labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    return sets, reps, links


def _one_text_each(members: DataFrame, words: int) -> DataFrame:
    """Rows whose text has the set s1 looked for (repeated ids may not), named by s1."""
    def run(batches):
        for batch in batches:
            same = _set_ids(*shingle_sets(_texts(batch), words)) == batch.column("s1").to_numpy()
            rows = pa.RecordBatch.from_arrays([batch.column(c) for c in ("region", "members", "s1", "text")], ["region", "members", "id", "text"])
            yield rows.filter(pa.array(same))

    return members.mapInArrow(lean(run), "region long, members long, id long, text string")


def _measure_all(members: DataFrame, t: Threshold, words: int) -> DataFrame:
    """Links (a, b) that connect regions whose documents can all be pivots."""
    rows = members.withColumn("label", F.lit(0).cast("long"))        # one label: boundaries need no naming
    return _measure(rows, rows, t, words).where("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()


def _pivot_level(members: DataFrame, labels: DataFrame | None, pivots: int, t: Threshold, words: int) -> tuple[DataFrame, DataFrame]:
    """One level over large regions: (labels, documents still open).

    ``labels`` (node, label) say what the links found so far connect; those
    returned add this level's.  A region's pivots are ``pivots`` documents in no
    component yet and a quarter as many of the others.
    """
    if labels is None:
        known = members.withColumn("found", F.lit(None).cast("long"))
    else:
        known = members.join(labels.select(F.col("node").alias("id"), F.col("label").alias("found")), "id", "left")
    known = known.withColumn("label", F.coalesce("found", "id"))
    order = Window.partitionBy("region", F.col("found").isNull()).orderBy(F.xxhash64("id"), "id")
    chosen = known.select("region", "id", "found").distinct().withColumn("turn", F.row_number().over(order)) \
        .where(F.col("turn") <= F.when(F.col("found").isNull(), pivots).otherwise(pivots // 4)).select("id")
    chosen = saved(chosen, "jaccard-pivots")
    near = saved(_measure(known, known.join(chosen, "id").dropDuplicates(["id"]), t, words).distinct(), "jaccard-near")
    found = near.where("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    if labels is not None:
        found = found.unionByName(labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    labels = components(found, "jaccard-labels")
    label_of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"))
    # pivots with a boundary document outside their component keep their region open
    tagged = near.where("not linked").join(label_of("id"), "id", "left").join(label_of("pivot"), "pivot", "left")
    outside = tagged.where(F.coalesce("id_label", "id") != F.coalesce("pivot_label", "pivot")).select("pivot").distinct()
    closed = near.where("linked is null or linked").join(outside, "pivot", "left_anti").select("id").unionByName(chosen).distinct()
    left = members.join(closed, "id", "left_anti")
    # a region whose open documents are all in one component has nothing to find
    now = left.select("region", "id").join(label_of("id"), "id", "left").withColumn("label", F.coalesce("id_label", "id"))
    apart = now.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("region")
    return labels, saved(left.join(apart, "region", "left_semi"), "jaccard-open")


def _grouped(docs: DataFrame, num: int, den: int, words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, component) of every row of ``docs``."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets, reps, links = jaccard_links(src, Threshold(num, den), words)
    labels = components(links, "jaccard-final")
    linked = reps.join(labels, F.col("s1") == F.col("node"), "left").select("s1", "rep", F.coalesce("label", "s1").alias("label"))
    named = linked.join(linked.groupBy("label").agg(F.min("rep").alias("component")), "label").select("s1", "component")
    return sets.join(named, "s1", "left") \
        .select("id", "text_hash", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def jaccard_components(docs: DataFrame, num: int = 90, den: int = 100, words: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Two documents link when den * |intersection| >= num * |union| of their
    sets of distinct ``words``-word shingles.  component_id is the smallest
    doc_id reachable by links, the document's own included.  Texts without
    words (null, empty, white space) link with nothing.  Rows that repeat an id
    are documents of their own; a null id comes after all others and shows as
    null.  Equal sets are one representative throughout, so copies are never
    paired with each other.
    """
    out = _grouped(docs, num, den, words, id_col, text_col)
    shown = lambda c: F.when(c != LAST_ID, c)
    return out.select(shown(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), shown(F.col("component")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, num: int = 80, den: int = 100, words: int = 5,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of linked documents: that of the
    smallest id (of rows that share it, the one of the least text hash).

    Groups are those of ``jaccard_components``.  Texts without words all stay,
    but for rows that repeat id and text.  All columns stay as they are.
    """
    has_words = F.col("n") > 0
    apart = F.when(has_words, F.lit(0)).otherwise(F.col("text_hash"))     # texts without words group by id and text
    chosen = _grouped(docs, num, den, words, id_col, text_col) \
        .groupBy(has_words.alias("has_words"), "component", apart.alias("apart")).agg(F.min(F.struct("id", "text_hash")).alias("first")) \
        .select(F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    return rows.join(chosen, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"]).select("row.*")
