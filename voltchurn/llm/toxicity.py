"""Toxicity by multiple-instance learning: sentence scores under a noisy-or.

Only documents carry labels.  A sentence's chance p of being toxic is a
logistic function of its words; a document's is 1 - prod(1 - p) over its
sentences.  The weights are fitted to document labels through that formula, so
that scoring also tells which sentences are to blame.

What no sentence explains is one leak term of the document, whatever its
length, and a sentence enters by its words' excess over the bias alone, which
is nothing for one without weighted words.  Weak evidence also occurs in clean
text, so only what exceeds that of clean text of as many sentences counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.llm.components import saved
from voltchurn.llm.vocab import LETTER, char_classes, span_hashes
from voltchurn.llm.workers import lean

#: characters that end a sentence
ENDINGS = ".!?\n"
#: code points scored at once (some 100 bytes of arrays each); a single longer text is a batch of its own
SCORE_CHARS = 1 << 18
HELD_OUT_PART = 2
PREFIXES = (4, 5, 6)
PREFIX_MARK = np.uint64(0x5851F42D4C957F2D)
#: sentences of this chance or more count whole; weaker ones beyond clean text's
#: mean for the length plus CLEAN_DEVIATIONS standard deviations
STRONG, CLEAN_DEVIATIONS = 0.3, 3.0


@dataclass(frozen=True)
class ToxicityModel:
    """Feature weights by hash (ascending), the bias of every sentence, and the
    leak (logit) of every document.

    ``clean_rate`` and ``clean_var`` are the mean and the variance, per sentence,
    of weak evidence in clean documents.  Without a leak the bias is the whole
    background: every sentence enters the noisy-or with it.
    """

    words: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float | None = None
    clean_rate: float = 0.0
    clean_var: float = 0.0

    def sentence_logits(self, hashes: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """Logit of each of n sentences; a word counts once in a sentence."""
        size = len(self.words)
        if not size:
            return np.full(n, self.bias)
        at = np.minimum(np.searchsorted(self.words, hashes), size - 1)
        known = self.words[at] == hashes
        pair = np.unique(sentence[known] * size + at[known])
        return self.bias + np.bincount(pair // size, weights=self.weights[pair % size], minlength=n)

    def evidence(self, logits: np.ndarray) -> np.ndarray:
        """-log(1 - chance) that each sentence adds."""
        if self.leak is None:
            return _softplus(logits)
        return np.maximum(_softplus(logits) - _softplus(self.bias), 0.0)

    def document_scores(self, evidence: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Chance of each document, whose sentences start at ``first`` (and end at the next)."""
        if self.leak is None:
            return -np.expm1(-np.add.reduceat(evidence, first[:-1]))
        n = np.diff(first)
        strong, weak = _strong_and_weak(evidence, first)
        allowed = self.clean_rate * n + CLEAN_DEVIATIONS * np.sqrt(self.clean_var * n)
        return -np.expm1(-(_softplus(self.leak) + strong + np.maximum(weak - allowed, 0.0)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_PART, F.lit(False))


def split_words(texts: list[str]):
    """Words and sentences of texts: (hash of each feature, its sentence,
    first sentence of each text and one past the last, sentence start offsets,
    lengths of the texts).

    A word is a run of letters, lower-cased; its features are the word and its
    beginnings of PREFIXES letters, which inflected forms share.  Every text has one sentence at
    least; sentence starts are offsets into the joined lower-cased texts.
    """
    low = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    blob = "".join(low)
    lens = np.array([len(t) for t in low], dtype=np.int64)
    text_start = np.cumsum(lens) - lens
    points = np.frombuffer(blob.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(points)
    ends_here = np.zeros(n, dtype=bool)
    for c in ENDINGS:
        ends_here |= points == ord(c)
    cut = np.nonzero(ends_here)[0] + 1
    # sentences start at every text's start and after every ending inside it
    key = np.concatenate([text_start, cut])
    kind = np.concatenate([np.arange(len(texts)), np.searchsorted(text_start, cut - 1, side="right") - 1])
    inside = np.concatenate([np.ones(len(texts), dtype=bool), cut < (text_start + lens)[kind[len(texts):]]])
    key, kind = key[inside], kind[inside]
    order = np.lexsort((key, kind))
    sentence_start, sentence_text = key[order], kind[order]
    first = np.searchsorted(sentence_text, np.arange(len(texts) + 1))
    letter = np.zeros(n + 2, dtype=bool)
    letter[1:-1] = char_classes()[points] == LETTER
    begins = letter[1:-1] & ~letter[:-2]
    begins[text_start[lens > 0]] = letter[1:-1][text_start[lens > 0]]   # never across texts
    starts = np.nonzero(begins)[0]
    stops = letter[1:-1] & ~letter[2:]
    last = (text_start + lens)[lens > 0] - 1
    stops[last] = letter[1:-1][last]
    ends = np.nonzero(stops)[0] + 1
    # an empty text shares its start with the next one: words belong to the last that starts there
    sentence = np.searchsorted(sentence_start, starts, side="right") - 1
    hashes, owners = [span_hashes(points, starts, ends) if n else np.zeros(0, np.uint64)], [sentence]
    for k in PREFIXES:
        longer = ends - starts > k
        hashes.append(span_hashes(points, starts[longer], starts[longer] + k) ^ PREFIX_MARK if n else hashes[0])
        owners.append(sentence[longer])
    return np.concatenate(hashes), np.concatenate(owners), first, sentence_start, lens


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _strong_and_weak(evidence: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Evidence of each document's sentences of STRONG chance or more, and of the others."""
    strong = np.where(evidence >= -np.log1p(-STRONG), evidence, 0.0)
    return np.add.reduceat(strong, first[:-1]), np.add.reduceat(evidence - strong, first[:-1])


def base_model(n_docs: int, n_toxic: int, n_sentences: int) -> ToxicityModel:
    """No words: a leak that gives every document the share of toxic ones, and
    the bias that would give it to the mean document's sentences."""
    base = n_toxic / n_docs if n_docs else 0.0
    per_doc = n_sentences / n_docs if n_docs else 1.0
    needed = min(max(-float(np.log1p(-min(base, 1 - 1e-9))), 1e-12), 20.0) / max(per_doc, 1.0)
    chance = min(max(base, 1e-12), 1 - 1e-9)
    return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(np.expm1(needed))), float(np.log(chance / (1 - chance))))


def fit(vocab: np.ndarray, features: list[np.ndarray], sentences: list[np.ndarray], n_sentences: list[int],
        toxic: list[int], l1: float = 2e-4, rounds: int = 300, rate: float = 0.05) -> ToxicityModel:
    """Fits feature weights to document labels by full-batch proximal Adam steps.

    ``features[i]`` and ``sentences[i]`` are places in ``vocab`` (ascending
    hashes) found in document i, and the number of the sentence each is in.
    ``l1`` sets weights to zero that do not earn their cost.  The bias is that
    of ``base_model``; weights and leak are fitted, then the evidence that clean
    documents hold is measured.  With labels of one kind only, or none, the
    model is ``base_model``.
    """
    y = np.array(toxic, dtype=np.float64)
    n_sent = np.array(n_sentences, dtype=np.int64)
    start = base_model(len(y), int(y.sum()), int(n_sent.sum()))
    if not len(vocab) or not 0 < y.sum() < len(y):
        return start
    first = np.concatenate([[0], np.cumsum(n_sent)])
    # a feature counts once in a sentence; sentences without any add nothing
    pair = np.unique(np.concatenate([(s + f) * len(vocab) + w for w, s, f in zip(features, sentences, first)]))
    sent, feature = pair // len(vocab), pair % len(vocab)
    rows, sent = np.unique(sent, return_inverse=True)
    doc_of = np.searchsorted(first, rows, side="right") - 1
    total = len(rows)
    w, b, c = np.zeros(len(vocab)), start.bias, start.leak
    m, v, mc, vc = np.zeros(len(vocab)), np.zeros(len(vocab)), 0.0, 0.0
    for t in range(1, rounds + 1):
        extra = np.bincount(sent, weights=w[feature], minlength=total)
        a = np.bincount(doc_of, weights=start.evidence(b + extra), minlength=len(y))
        a = np.maximum(_softplus(c) + a, 1e-12)
        pull = np.where(y > 0, -1.0 / np.expm1(np.minimum(a, 50)), 1.0) / len(y)
        g = np.where(extra >= 0, pull[doc_of] / (1 + np.exp(-(b + extra))), 0.0)
        gw = np.bincount(feature, weights=g[sent], minlength=len(vocab))
        gc = float(pull.sum() / (1 + np.exp(-c)))
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mc, vc = 0.9 * mc + 0.1 * gc, 0.999 * vc + 0.001 * gc * gc
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        step = rate / (np.sqrt(v / c2) + 1e-8)
        w = w - step * (m / c1)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0.0)
        c = c - rate * (mc / c1) / (np.sqrt(vc / c2) + 1e-8)
    found = np.zeros(int(n_sent.sum()))
    found[rows] = start.evidence(b + np.bincount(sent, weights=w[feature], minlength=total))
    weak, clean = _strong_and_weak(found, first)[1], y == 0
    return ToxicityModel(vocab[w != 0], w[w != 0], b, c, float(weak[clean].sum() / n_sent[clean].sum()),
                         float((weak[clean] ** 2).sum() / n_sent[clean].sum()))


def _batch_texts(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def choose_features(sample: DataFrame, base: float, min_docs: int, max_features: int) -> np.ndarray:
    """Ascending hashes of the features worth fitting.

    Of those in ``min_docs`` documents or more, the ``max_features`` whose
    documents' labels differ most from the base rate (score statistic), counted
    over the whole sample.
    """
    def count(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_numpy().astype(np.int64)
            per = [np.unique(split_words([t])[0]) for t in _batch_texts(batch)]
            if not per:
                continue
            h, inverse = np.unique(np.concatenate(per), return_inverse=True)
            bad = np.bincount(inverse, weights=np.repeat(toxic, [len(p) for p in per]), minlength=len(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64), pa.int64()), pa.array(np.bincount(inverse, minlength=len(h)), pa.int64()),
                 pa.array(bad.astype(np.int64), pa.int64())], ["h", "n", "bad"])

    found = sample.select("text", "toxic").mapInArrow(lean(count), "h long, n long, bad long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    statistic = F.abs(F.col("bad") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    best = found.where(F.col("n") >= min_docs).orderBy(statistic.desc(), "h").limit(max_features).select("h").toPandas()
    return np.sort(best["h"].to_numpy(dtype=np.int64).view(np.uint64))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, min_docs: int = 5, max_features: int = 4096,
          **options) -> ToxicityModel:
    """A model from at most ``max_rows`` labelled, not held-out documents.

    ``labels``: doc_id and toxic (0/1); rows with nulls are left out, repeated
    ids count as toxic if any row says so.  The sample is the first
    ``max_rows`` ids by hash; of repeated documents one text is taken.  What
    reaches the driver is bounded by ``max_rows`` and ``max_features``: the
    sample's ids, the chosen features, and where in the sample they occur.
    """
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    picked = docs.sparkSession.createDataFrame(ids.toPandas(), "doc_id long, toxic int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(picked), "doc_id")
    sample = saved(rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")), "toxicity-sample")
    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    if not 0 < totals["bad"] < totals["n"]:
        return base_model(totals["n"], totals["bad"], totals["n"])
    vocab = choose_features(sample, totals["bad"] / totals["n"], min_docs, max_features)

    def places(batches):
        for batch in batches:
            features, sents, counts = [], [], []
            for t in _batch_texts(batch):
                h, s, first, _, _ = split_words([t])
                at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1) if len(vocab) else np.zeros(0, np.int64)
                known = vocab[at] == h if len(vocab) else np.zeros(0, bool)
                features.append(at[known].astype(np.int32).tobytes())
                sents.append(s[: len(known)][known].astype(np.int32).tobytes())
                counts.append(int(first[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(features, pa.binary()), pa.array(sents, pa.binary()),
                 pa.array(counts, pa.int32())], ["doc_id", "toxic", "features", "sentences", "n"])

    found = sample.mapInArrow(lean(places), "doc_id long, toxic int, features binary, sentences binary, n int").orderBy("doc_id").toArrow()
    whole = lambda name: [np.frombuffer(x, np.int32).astype(np.int64) for x in found.column(name).to_pylist()]
    return fit(vocab, whole("features"), whole("sentences"), found.column("n").to_pylist(), found.column("toxic").to_pylist(), **options)


def score_texts(model: ToxicityModel, texts: list[str], limit: float):
    """(score, offending) of each text; offending: (start, end, score) of the
    sentences whose own score reaches ``limit``."""
    scores, offending = [], []
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SCORE_CHARS):
            size += len(texts[hi])
            hi += 1
        hashes, sentence, first, starts, lens = split_words(texts[lo:hi])
        z = model.sentence_logits(hashes, sentence, len(starts))
        evidence = model.evidence(z)
        score = model.document_scores(evidence, first) if len(z) else np.zeros(0)
        p = -np.expm1(-evidence)
        bad = np.nonzero(p >= limit)[0]
        spans: list[list] = [[] for _ in range(hi - lo)]
        text_start = np.cumsum(lens) - lens
        for s in bad.tolist():
            t = int(np.searchsorted(first, s, side="right") - 1)
            end = starts[s + 1] if s + 1 < first[t + 1] else text_start[t] + lens[t]
            spans[t].append({"start": int(starts[s] - text_start[t]), "end": int(end - text_start[t]), "score": float(p[s])})
        scores.extend(np.clip(score, 0.0, 1.0).tolist())
        offending.extend(spans)
        lo = hi
    return scores, offending


def score_toxicity(docs: DataFrame, model: ToxicityModel, limit: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` with toxic_score, toxic (score >= limit) and offending
    (array<struct<start,end,score>> of sentences, code points).

    Every whole text is scored on its words alone, and plain sentences add
    nothing, however many; a null or empty text is one empty sentence.  Repeated rows get equal scores.  Columns of these three
    names are replaced.  Rows stay where they are: no shuffle.
    """
    new = ("toxic_score", "toxic", "offending")
    keep = [c for c in docs.columns if c not in new]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("row").field(text_col).to_pylist()]
            score, bad = score_texts(model, texts, limit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(score, pa.float64()), pa.array(bad, spans)], ["row", "toxic_score", "offending"])

    kind = src.schema["row"].dataType.simpleString()
    out = src.mapInArrow(lean(run), f"row {kind}, toxic_score double, offending array<struct<start:int,end:int,score:double>>")
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "toxic_score",
                      (F.col("toxic_score") >= limit).alias("toxic"), "offending")
