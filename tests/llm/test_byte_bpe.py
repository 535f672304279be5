"""Byte-level BPE by backtracking against the library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest

from voltchurn.llm import byte_bpe
from voltchurn.llm.queries import QUERIES, vocab_path

from test_bpe_tokens_packing import random_texts

PATH = vocab_path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(library):
    every_point = ["".join(map(chr, range(a, a + 64))) for a in [*range(0, 0xD800, 64), *range(0xE000, 0x20000, 64)]]
    texts = random_texts(2000) + every_point
    enc = byte_bpe.encoder(PATH)
    got = list(enc.encode(texts))
    assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in texts]
    assert [byte_bpe.decoded(enc.vocab, x) for x in got] == [t.encode() for t in texts]


def small_vocab(tmp_path, tokens):
    path = tmp_path / "ranks.tiktoken"
    rows = [bytes([b]) for b in range(256)] + tokens
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(rows)))
    return byte_bpe.Backtracker(byte_bpe.RankVocab(str(path)))


def test_any_vocabulary_gives_what_merging_gives(tmp_path):
    """Also vocabularies with strings that merging never reaches."""
    rng = random.Random(5)
    for _ in range(60):
        tokens = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(12)})
        rng.shuffle(tokens)
        coder = small_vocab(tmp_path, tokens)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            ids, counts = coder([word])
            whole = coder.vocab.rank.get(word)
            assert ids.tolist() == ([whole] if whole is not None else coder.vocab.merged(word))
            assert counts.tolist() == [len(ids)]


def test_merging_is_lowest_rank_first_then_leftmost(tmp_path):
    vocab = small_vocab(tmp_path, [b"ab", b"bc", b"aa", b"abc"]).vocab
    assert vocab.merged(b"abcbc") == [vocab.rank[b"abc"], vocab.rank[b"bc"]]
    assert vocab.merged(b"aaa") == [vocab.rank[b"aa"], ord("a")]
    assert vocab.merged(b"") == []


def test_steps_grow_with_the_length():
    coder = byte_bpe.encoder(PATH).encode_words
    rng = random.Random(2)
    per_byte = []
    for n in (2_000, 40_000):
        before = coder.steps
        coder([bytes(rng.choice(b"abcdefghij") for _ in range(n))])
        per_byte.append((coder.steps - before) / n)
    assert per_byte[1] < 1.5 * per_byte[0] and per_byte[1] < 3


def test_pair_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "PAIRS_KEPT", 10)
    coder = byte_bpe.Backtracker(byte_bpe.RankVocab(PATH))
    ids, _ = coder([b" anthropomorphically speaking of irreproducibilities" * 3])
    assert len(coder.fitting) <= 10 and ids.tolist() == coder.vocab.merged(b" anthropomorphically speaking of irreproducibilities" * 3)


def test_a_vocabulary_needs_every_byte(tmp_path):
    path = tmp_path / "few"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        byte_bpe.RankVocab(str(path))


def test_documents_with_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, "one two  three\n", "x"), (1, "one two  three\n", "x"), (None, "zwölf", "y"), (3, None, None), (4, "", "z"), (5, "é" * 30_000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = byte_bpe.encode_documents(docs, PATH).collect()
    assert sorted((r["doc_id"] or -1, list(r["ids"]), bytes(r["decoded"])) for r in got) == \
        sorted((i or -1, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert byte_bpe.encode_digests(docs.limit(0), PATH).count() == 0


def test_the_query_against_the_library(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
