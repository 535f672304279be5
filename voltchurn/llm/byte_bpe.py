"""Byte-level BPE over a rank file: longest matches, backtracking, pair memory.

The vocabulary is a list of byte strings with ranks (ids).  Two neighbouring
parts merge when their bytes joined are in it, lowest rank first, then leftmost.
Such an encoding never merges across the edge of two neighbouring tokens, so it
is the one sequence of tokens in which every token is what its own bytes give
and every two neighbours are what their joined bytes give.

To find it, bytes are read as Latin-1 characters and one automaton names the
longest token at every place.  From the left the longest token that fits the
token before it is taken, else the next shorter one that starts there; when
none fits, the place is marked dead and the token before it is taken back.  A
place is marked at most once, so the steps grow with the text's length.
Whether two tokens fit is merged out once and remembered.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltchurn.llm.bpe import id_text, text_batches
from voltchurn.llm.vocab import Encoder

GAP = "Ā"                     # in no token: bytes map to code points below 256
JOINED_BYTES = 1 << 17        # words matched in one run; a longer word is a run of its own
PAIRS_KEPT = 500_000          # remembered pairs before a worker starts afresh


class RankVocab:
    """Byte strings and ranks of a file of lines ``base64 rank``."""

    specials: dict[str, int] = {}

    def __init__(self, path: str):
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(token): int(r) for token, r in rows}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"vocabulary without the single bytes {missing}")
        self.size = max(self.rank.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, r in self.rank.items():
            self.bytes_of[r] = token
        self.token_len = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.flat_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.byte_start = np.cumsum(self.token_len) - self.token_len

    def merged(self, word: bytes) -> list[int]:
        """Exact merging from single bytes: lowest rank first, then leftmost."""
        rank, n = self.rank, len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))      # of the part that starts at each place
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1" * n)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue                                                  # one of the two parts has merged since
            alive[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := rank.get(word[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := rank.get(word[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [rank[word[i:end[i]]] for i in range(n) if alive[i]]


class Backtracker:
    """Encodes distinct words by longest matches and remembered pairs."""

    def __init__(self, vocab: RankVocab):
        import ahocorasick

        self.vocab = vocab
        self.length = vocab.token_len.tolist()
        self.automaton = ahocorasick.Automaton()
        # a string that merging its own bytes does not give is no token of any longer word
        own = {token: r for token, r in vocab.rank.items() if len(token) == 1 or vocab.merged(token) == [r]}
        for token, r in own.items():
            self.automaton.add_word(token.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.shorter = [-1] * vocab.size                  # the longest token that is a shorter beginning
        for token, r in own.items():
            self.shorter[r] = next((own[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in own), -1)
        self.fitting: dict[tuple[int, int], bool] = {}
        self.steps = 0

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b gives the two again."""
        known = self.fitting.get((a, b))
        if known is None:
            if len(self.fitting) >= PAIRS_KEPT:
                self.fitting.clear()
            known = self.vocab.merged(self.vocab.bytes_of[a] + self.vocab.bytes_of[b]) == [a, b]
            self.fitting[a, b] = known
        return known

    def longest(self, joined: str) -> list[int]:
        """The longest token that starts at each place."""
        found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), dtype=np.int64).reshape(-1, 2)
        best = np.full(len(joined), -1, dtype=np.int64)
        best[found[:, 0] + 1 - self.vocab.token_len[found[:, 1]]] = found[:, 1]     # by ascending end: the last is the longest
        return best.tolist()

    def backtrack(self, best: list[int], lo: int, hi: int) -> list[int]:
        """The tokens of the word at lo..hi of the matched string."""
        out: list[int] = []
        dead = bytearray(hi - lo + 1)
        pos, following = lo, best[lo]
        while pos < hi:
            self.steps += 1
            token, last = following, out[-1] if out else -1
            while token >= 0 and (dead[pos + self.length[token] - lo] or (last >= 0 and not self.fits(last, token))):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                pos += self.length[token]
                following = best[pos] if pos < hi else -1
            else:
                dead[pos - lo] = 1
                following = out.pop()
                pos -= self.length[following]
        return out

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each word)."""
        ids: list[int] = []
        counts = np.zeros(len(words), dtype=np.int64)
        lo = 0
        while lo < len(words):
            hi, size = lo, 0
            while hi < len(words) and (hi == lo or size + len(words[hi]) <= JOINED_BYTES):
                size += len(words[hi])
                hi += 1
            best = self.longest(GAP.join(w.decode("latin-1") for w in words[lo:hi]))
            at = 0
            for k in range(lo, hi):
                whole = self.vocab.rank.get(words[k])
                found = [whole] if whole is not None else self.backtrack(best, at, at + len(words[k])) if words[k] else []
                ids += found
                counts[k] = len(found)
                at += len(words[k]) + 1
            lo = hi
        return np.array(ids, dtype=np.int32), counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    vocab = RankVocab(path)
    return Encoder(vocab, Backtracker(vocab))


def decoded(vocab: RankVocab, ids: np.ndarray) -> bytes:
    """The bytes of ids, joined."""
    n = vocab.token_len[ids]
    ends = np.cumsum(n)
    at = np.repeat(vocab.byte_start[ids] - (ends - n), n) + np.arange(int(n.sum()))
    return vocab.flat_bytes[at].tobytes()


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every whole text.

    A null text counts as empty and gives no ids.  Rows are independent: equal
    rows give equal rows, null ids stay, other columns of ``docs`` are ignored.
    No shuffle; a worker holds one Arrow batch and its bounded memories.
    """
    def run(batches):
        enc = encoder(vocab_path)
        for batch in batches:
            ids = list(enc.encode(text_batches(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([decoded(enc.vocab, x) for x in ids], pa.binary())], ["doc_id", "ids", "decoded"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids (little-endian unsigned 32-bit
    integers) and of the decoded bytes.

    As ``encode_documents``, but ids leave the worker as digests only.
    """
    def run(batches):
        enc = encoder(vocab_path)
        for batch in batches:
            n, sha_ids, sha_bytes = [], [], []
            for ids in enc.encode(text_batches(batch)):
                n.append(len(ids))
                sha_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                sha_bytes.append(hashlib.sha256(decoded(enc.vocab, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha_ids, pa.string()), pa.array(sha_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
