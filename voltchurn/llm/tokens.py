"""Token counts by whole-token shortcut.

Offline, once per vocabulary: merge every vocabulary string from its bytes and
keep those that come out as one id.  A pre-token equal to such a string counts
one token straight away; only the rest is merged exactly.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltchurn.llm.bpe import id_text, text_batches
from voltchurn.llm.vocab import Encoder, Vocab, load_vocab


def prove_whole_tokens(vocab: Vocab) -> dict[bytes, int]:
    """Vocabulary strings whose exact encoding is that one token."""
    strings = list(vocab.id_of)
    ids, counts = vocab.merge_words(strings)
    first = np.cumsum(counts) - counts
    return {s: vocab.id_of[s] for s, n, at in zip(strings, counts, first)
            if n == 1 and ids[at] == vocab.id_of[s]}


class WholeTokens:
    """Encodes distinct words: proven whole tokens directly, merging the rest."""

    def __init__(self, vocab: Vocab):
        self.vocab, self.whole = vocab, prove_whole_tokens(vocab)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        direct = np.array([self.whole.get(w, -1) for w in words], dtype=np.int32)
        rest = np.nonzero(direct < 0)[0]
        ids, n = self.vocab.merge_words([words[i] for i in rest])
        counts = np.ones(len(words), dtype=np.int64)
        counts[rest] = n
        out = np.empty(int(counts.sum()), dtype=np.int32)
        ends = np.cumsum(counts)
        hit = direct >= 0
        out[ends[hit] - 1] = direct[hit]
        at = np.repeat(ends[rest] - n, n) + np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
        out[at] = ids
        return out, counts


@lru_cache(maxsize=2)
def counter(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    vocab = load_vocab(path)
    return Encoder(vocab, WholeTokens(vocab))


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) per row.

    Special strings inside a text count as their one special token.  A null or
    empty text has 0 bytes and 0 tokens.  Repeated rows give repeated rows;
    other columns are ignored.  No shuffle: rows are independent.
    """
    def run(batches):
        enc = counter(vocab_path)
        for batch in batches:
            texts = text_batches(batch)
            n = enc.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_text(docs, id_col, text_col) \
        .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
