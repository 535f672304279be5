"""Token operators against the tokenizers library, and exact round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voltchurn.llm import bpe, packing, tokens
from voltchurn.llm.queries import vocab_path
from voltchurn.llm.vocab import load_vocab

PARTS = ["'s", "'t", "'re", "'ve", "'ll", "'", " ", "  ", "\n", "\t", "abc", "hello", "The", "é", "日本", "12", "²", "½", "!!", "..",
         "<|endoftext|>", "<|endoftext", "\x85", "\x1c", "\r\n", "_", "😀", "é", "\x00", "ß", "aaaaaaaaaaaaaaa", "=====", "x" * 60]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randrange(0x20, 0x7F), rng.randrange(0, 0x3000), rng.randrange(0xE000, 0x20000)]))
                    for _ in range(15)) for _ in range(n // 5)]
    return out + ["", "a" * 5000, " " * 3000, "=-" * 2000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocab_path())


def test_encoding_equals_the_library(library):
    texts = random_texts(3000)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    enc = bpe.encoder(vocab_path())
    got = [x.tolist() for x in enc.encode(texts)]
    assert got == expected
    assert [bpe.decode_ids(enc.vocab, np.array(x, dtype=np.int32)) for x in got] == library.decode_batch(expected, skip_special_tokens=False)
    assert tokens.counter(vocab_path()).counts(texts).tolist() == [len(x) for x in expected]


def test_pair_check_agrees_with_exact_merging():
    vocab = load_vocab(vocab_path())
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 50256, 4000), rng.integers(0, 2000, 4000)
    ids, n = vocab.merge_words([vocab.bytes_of[x] + vocab.bytes_of[y] for x, y in zip(a, b)])
    ends = np.cumsum(n)
    same = [ids[e - k:e].tolist() == [x, y] for e, k, x, y in zip(ends, n, a, b)]
    assert bpe.compatible_pairs(vocab, a, b).tolist() == same


def test_long_word_merging_agrees_with_the_batch_form():
    vocab = load_vocab(vocab_path())
    words = [b"internationalization", b"thhthe", b"  ", b"zzzzzzzzzzzz"]
    ids, n = vocab.merge_words(words)
    ends = np.cumsum(n)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [vocab.merge_one(w) for w in words]


def test_whole_tokens_are_single_ids(library):
    whole = tokens.prove_whole_tokens(load_vocab(vocab_path()))
    assert len(whole) > 40_000
    for s in [b" the", b"hello", b"ing"]:
        assert library.encode(s.decode(), add_special_tokens=False).ids == [whole[s]]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")


def test_edge_rows_of_encoding_and_counts(spark, library):
    rows = [(1, None, 7, "x"), (2, "", None, None), (None, "no id", 1, "y"), (3, "same", 1, "z"), (3, "same", 1, "z"),
            (2**60 + 1, "a<|endoftext|>b", 1, "w")]
    docs = frame(spark, rows)
    got = sorted(map(tuple, bpe.encode_documents(docs, vocab_path()).collect()), key=str)
    want = sorted([(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _, _ in rows], key=str)
    assert [(a, list(b), c) for a, b, c in got] == want
    digests = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_digests(docs, vocab_path()).collect()}
    assert digests == {(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                       for i, x, t in want}
    counts = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(docs, vocab_path(), limit=2).collect()), key=str)
    assert counts == sorted([(i, len(t.encode()), len(x), len(x) > 2) for i, x, t in want], key=str)
    for out in (bpe.encode_documents(docs.limit(0), vocab_path()), tokens.count_tokens(docs.limit(0), vocab_path())):
        assert out.count() == 0


# ------------------------------------------------------------------ packing

def check_packing(rows, docs, library, window):
    """Every id in one piece; sequences gapless; only powers of two are short."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = np.array(ids[at:at + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)


def test_packing_covers_every_id_without_padding(spark, library):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "x"]) for _ in range(rng.choice([0, 1, 5, 40, 90, 300])))) for i in range(200)]
    docs += [(1000, None), (1001, "")]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), vocab_path(), window=64).collect()
    check_packing(rows, docs, library, 64)


def test_packing_edge_rows(spark):
    schema = "doc_id long, text string, sequence_id string, offset int"
    rows = [(None, "no id", "s", 1), (5, "twice", "s", 1), (5, "twice", "s", 1)]
    got = packing.pack_documents(spark.createDataFrame(rows, schema).coalesce(1), vocab_path(), window=16).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 5) == 2 * [r["doc_tokens"] for r in got if r["doc_id"] == 5][0]
    assert any(r["doc_id"] is None for r in got)
    assert packing.pack_documents(spark.createDataFrame([], schema), vocab_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(spark.createDataFrame([], schema), vocab_path(), window=100)


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(3)
    window = 20
    levels = packing.LevelArray(window)
    for _ in range(300):
        size = rng.randint(1, window - 1)
        before = levels.count.copy()
        options = {}
        for h in range(window - size + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            if h:
                after[h] -= 1
            if h + size < window:
                after[h + size] += 1
            options[h] = int((after[1:window] ** 2).sum())
        chosen = levels.choose(size)
        assert options[chosen] == min(options.values())
        assert chosen == max(h for h, v in options.items() if v == options[chosen])
        if chosen:
            levels.take(chosen)
        if chosen + size < window:
            levels.put(chosen + size, 0)
