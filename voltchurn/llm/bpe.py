"""BPE encoding and decoding: speculate greedily, verify pairs, merge the rest.

Encoding a word: greedy longest match over the vocabulary proposes tokens.  A
proposal is the exact BPE result if and only if every pair of neighbours is
compatible, that is, if merging the two tokens' bytes from scratch gives those
two tokens again.  All distinct pairs of a batch are tested at once with array
operations; words with an incompatible pair go through exact merging.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.llm.vocab import NO_RANK, Encoder, Vocab, load_vocab
from voltchurn.llm.workers import worker_table

_GAP = "Ā"  # in no token: bytes map to code points below 256


def compatible_pairs(vocab: Vocab, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether exact merging of a's bytes followed by b's gives [a, b].

    Undo the later of the two merges that built the touching edges, again and
    again, until both edges are single bytes.  At any point where the touching
    parts would merge with each other before the merge just undone, the pair
    breaks.  Works on all pairs in step.
    """
    left, right = a.astype(np.int64), b.astype(np.int64)
    ok = np.ones(len(left), dtype=bool)
    limit = np.full(len(left), np.iinfo(np.int64).max)
    live = np.arange(len(left))
    while len(live):
        x, y, lim = left[live], right[live], limit[live]
        rank = vocab.pair_rank(x, y)
        made = np.where(rank == NO_RANK, np.iinfo(np.int64).max, rank.astype(np.int64) + 256)
        bad = made < lim
        ok[live[bad]] = False
        live, x, y = live[~bad], x[~bad], y[~bad]
        undo_left = x > y                      # the left edge was built later
        can_left, can_right = vocab.split_right[x] != x, vocab.split_left[y] != y
        go_left = np.where(undo_left, can_left, can_left & ~can_right)
        go_right = ~go_left & can_right
        # a merge on the left beats an equal or later one across the edge;
        # across the edge beats one on the right only if strictly earlier
        limit[live] = np.where(go_left, x, np.where(go_right, y + 1, 0))
        left[live] = np.where(go_left, vocab.split_right[x], x)
        right[live] = np.where(go_right, vocab.split_left[y], y)
        live = live[go_left | go_right]
    return ok


class Speculator:
    """Encodes distinct words: greedy proposal, pair check, exact merging."""

    def __init__(self, vocab: Vocab):
        import ahocorasick

        self.vocab = vocab
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.id_of.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.merged = self.proposed = 0

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match: (flat ids, word of each id)."""
        joined = _GAP.join(w.decode("latin-1") for w in words)
        found = np.array([x for pair in self.automaton.iter_long(joined) for x in pair], dtype=np.int64).reshape(-1, 2)
        ends, ids = found[:, 0], found[:, 1]
        lens = np.array([len(w) for w in words], dtype=np.int64)
        bounds = np.cumsum(lens + 1)
        return ids, np.searchsorted(bounds, ends, side="right")

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        v = self.vocab
        lens = np.array([len(w) for w in words], dtype=np.int64)
        ids, owner = self.propose(words)
        good = np.bincount(owner, weights=v.token_len[ids], minlength=len(words)) == lens
        same = owner[1:] == owner[:-1]
        key = (ids[:-1][same] << 32) | ids[1:][same]
        pairs, inverse = np.unique(key, return_inverse=True)
        fits = compatible_pairs(v, pairs >> 32, pairs & 0xFFFFFFFF)
        good[owner[1:][same][~fits[inverse]]] = False
        rest = np.nonzero(~good)[0]
        self.proposed += len(words)
        self.merged += len(rest)
        exact, n_exact = v.merge_words([words[i] for i in rest])
        keep = good[owner]
        all_ids = np.concatenate([ids[keep].astype(np.int32), exact])
        all_owner = np.concatenate([owner[keep], np.repeat(rest, n_exact)])
        counts = np.bincount(all_owner, minlength=len(words))
        return all_ids[np.argsort(all_owner, kind="stable")], counts


@worker_table
@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    vocab = load_vocab(path)
    return Encoder(vocab, Speculator(vocab))


def decode_ids(vocab: Vocab, ids: np.ndarray) -> str:
    """The text of ids: their bytes joined, read as UTF-8 (bad bytes replaced)."""
    n = vocab.token_len[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(vocab.byte_start[ids] - (ends - n), n) + np.arange(total)
    return vocab.flat_bytes[at].tobytes().decode("utf-8", "replace")


def text_batches(batch: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text.

    A null text counts as empty and gives no ids.  Rows are independent: equal
    rows give equal rows, null ids stay, other columns of ``docs`` are ignored.
    """
    def run(batches):
        enc = encoder(vocab_path)
        for batch in batches:
            ids = list(enc.encode(text_batches(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([decode_ids(enc.vocab, x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of the decoded text.

    As ``encode_documents``, but the ids leave the worker only as digests.
    """
    def run(batches):
        enc = encoder(vocab_path)
        names = np.array([str(i) for i in range(enc.vocab.size)], dtype=object)
        for batch in batches:
            n, sha_ids, sha_text = [], [], []
            for ids in enc.encode(text_batches(batch)):
                n.append(len(ids))
                sha_ids.append(hashlib.sha256(",".join(names[ids]).encode()).hexdigest())
                sha_text.append(hashlib.sha256(decode_ids(enc.vocab, ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha_ids, pa.string()),
                 pa.array(sha_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
