"""Byte-level BPE over batches of words: loading, pre-tokens, exact merging.

Texts are cut into pre-tokens (words) with array arithmetic over code points;
each distinct word is encoded once per batch.  What encodes a word is a
parameter, so the operators on token counts, packing and encoding share the
cutting and differ in how a word becomes ids.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from voltchurn.llm.workers import worker_table

# The contractions of the pre-token pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
CONTRACTIONS_1 = ("s", "t", "m", "d")
CONTRACTIONS_2 = ("re", "ve", "ll")

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: code points handled at once; a single longer text is a batch of its own
BATCH_CHARS = 1 << 20
#: words kept from earlier batches by one worker before it starts afresh
CACHE_WORDS = 1_500_000
CACHE_SLOT_BITS = 21
NO_RANK = np.int32(2**31 - 1)
LONG_WORD = 48


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    import regex

    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):
        chars = "".join(map(chr, range(lo, hi)))
        for pattern, cls in ((r"\p{White_Space}+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
            for m in regex.finditer(pattern, chars):
                table[lo + m.start():lo + m.end()] = cls
    return table


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    out.update({chr(256 + k): b for k, b in enumerate(rest)})
    return out


class Vocab:
    """Ids, byte strings and merge ranks of a byte-level BPE vocabulary file.

    Requires that ids grow with merge rank (checked), as in the public files
    this library is used with: id = n_bytes + rank.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            if token not in self.specials:
                self.bytes_of[i] = bytes(alphabet[ch] for ch in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.id_of = {self.bytes_of[i]: i for t, i in vocab.items() if t not in self.specials}
        self.byte_id = np.array([self.id_of[bytes([b])] for b in range(256)], dtype=np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        if len(made) and not (made == 256 + np.arange(len(made))).all():
            raise ValueError("vocabulary ids must follow merge ranks")
        self.split_left = np.arange(self.size, dtype=np.int64)
        self.split_right = np.arange(self.size, dtype=np.int64)
        self.split_left[made], self.split_right[made] = left, right
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int32)
        self._pairs = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right))}
        self.token_len = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.flat_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.byte_start = np.concatenate([[0], np.cumsum(self.token_len)[:-1]])

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids; NO_RANK where they do not merge."""
        keys = (a.astype(np.int64) << 32) | b
        at = np.searchsorted(self._keys, keys)
        at[at == len(self._keys)] = 0
        return np.where(self._keys[at] == keys, self._ranks[at], NO_RANK)

    # ------------------------------------------------------- exact merging
    def merge_one(self, word: bytes) -> list[int]:
        """Exact merging of one (long) word: lowest rank first, then leftmost."""
        import heapq

        ids = [int(self.byte_id[b]) for b in word]
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := self._pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i] = 256 + r
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for p, q in ((prv[i], i), (i, nxt[i])):
                if p >= 0 and q < n and (s := self._pairs.get((ids[p], ids[q]))) is not None:
                    heapq.heappush(heap, (s, p, ids[p], ids[q]))
        return [t for t, keep in zip(ids, alive) if keep]

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words: (flat ids, number of ids per word).

        Words of similar length advance in step, one merge per round each;
        words over LONG_WORD bytes are merged one at a time.
        """
        lens = np.array([len(w) for w in words], dtype=np.int64)
        counts = np.zeros(len(words), dtype=np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []
        for i in np.nonzero(lens > LONG_WORD)[0]:
            ids = np.array(self.merge_one(words[i]), dtype=np.int32)
            counts[i] = len(ids)
            pieces.append((np.full(len(ids), i), ids))
        short = np.nonzero((lens > 0) & (lens <= LONG_WORD))[0]
        short = short[np.argsort(lens[short], kind="stable")]
        for part in np.split(short, range(16384, len(short), 16384)):
            if not len(part):
                continue
            width = int(lens[part[-1]])
            raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in part), dtype=np.uint8)
            m = self.byte_id[raw].reshape(len(part), width).astype(np.int32)
            size = lens[part].copy()
            m = self._merge_matrix(m, size)
            counts[part] = size
            keep = np.arange(m.shape[1])[None, :] < size[:, None]
            pieces.append((np.repeat(part, size), m[keep]))
        if not pieces:
            return np.zeros(0, np.int32), counts
        owner = np.concatenate([p[0] for p in pieces])
        ids = np.concatenate([p[1] for p in pieces])
        return ids[np.argsort(owner, kind="stable")], counts

    def _merge_matrix(self, m: np.ndarray, size: np.ndarray) -> np.ndarray:
        n, width = m.shape
        if width == 1:
            return m
        col = np.arange(width - 1)[None, :]
        rank = np.where(col < (size - 1)[:, None], self.pair_rank(m[:, :-1], m[:, 1:]), NO_RANK)
        live = np.arange(n)
        pad = np.full((n, 1), NO_RANK, dtype=rank.dtype)
        while len(live):
            r = rank[live]
            j = r.argmin(axis=1)
            best = r[np.arange(len(live)), j]
            go = best != NO_RANK
            live, j, best, r = live[go], j[go], best[go], r[go]
            if not len(live):
                break
            t = m[live]
            shifted = np.concatenate([t[:, 1:], t[:, -1:]], axis=1)
            t = np.where(np.arange(width)[None, :] > j[:, None], shifted, t)
            rows = np.arange(len(live))
            t[rows, j] = 256 + best
            m[live] = t
            size[live] -= 1
            moved = np.concatenate([r[:, 1:], pad[: len(live)]], axis=1)
            r = np.where(col > j[:, None], moved, r)
            has_right = j < size[live] - 1
            k = np.minimum(j + 1, width - 1)
            right = np.where(has_right, self.pair_rank(t[rows, j], t[rows, k]), NO_RANK)
            jj = np.minimum(j, width - 2)
            r[rows, jj] = np.where(j <= width - 2, right, r[rows, jj])
            has_left = j > 0
            i = np.maximum(j - 1, 0)
            left = self.pair_rank(t[rows, i], t[rows, j])
            r[rows, i] = np.where(has_left, left, r[rows, i])
            rank[live] = r
        return m


@worker_table
@lru_cache(maxsize=4)
def load_vocab(path: str) -> Vocab:
    return Vocab(path)


# ------------------------------------------------------------- pre-tokens

@lru_cache(maxsize=1)
def _base() -> tuple[np.uint64, np.uint64]:
    b = 0x9E3779B97F4A7C15
    return np.uint64(b), np.uint64(pow(b, -1, 1 << 64))


class _Powers:
    """Growing tables of the hash base's powers and inverse powers."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            b, inv = _base()
            size = max(n, BATCH_CHARS + 1)
            for name, x in (("up", b), ("down", inv)):
                t = np.full(size, x, np.uint64)
                t[0] = 1
                setattr(self, name, np.cumprod(t, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points (equal spans, equal hashes)."""
    up, down = _powers.get(len(points) + 1)
    acc = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_mix(points) * up[:-1], out=acc[1:])
    h = (acc[ends] - acc[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def word_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Sorted positions at which pre-tokens start, over concatenated texts.

    ``text_starts`` holds the start of every non-empty text.
    """
    n = len(points)
    cls = char_classes()[points]
    first = np.zeros(n + 1, dtype=bool)          # first character of its text; n ends the last
    first[text_starts] = True
    first[n] = True
    run = np.empty(n, dtype=bool)                # first character of a run of one class
    run[0] = True
    np.not_equal(cls[1:], cls[:-1], out=run[1:])
    run |= first[:-1]
    space = cls == SPACE
    start = run.copy()
    # the last white-space character before a word starts a pre-token of its
    # own; if it is a plain blank, the word that follows joins it
    after = np.zeros(n, dtype=bool)              # a word follows in the same text
    after[:-1] = space[:-1] & ~space[1:] & ~first[1:-1]
    start |= after
    blank = after & (points == 0x20)
    joined = np.zeros(n, dtype=bool)             # starts a run but belongs to the blank before it
    joined[1:] = blank[:-1]
    start &= ~joined
    # contractions: an apostrophe that starts a pre-token, with its letters
    quote = np.nonzero(start[:-1] & (points[:-1] == 0x27))[0]
    if len(quote):
        ends = np.concatenate([np.asarray(text_starts)[1:], [n]])
        end = ends[np.searchsorted(np.asarray(text_starts), quote, side="right") - 1]
        one = np.where(quote + 1 < end, points[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < end, points[np.minimum(quote + 2, n - 1)], 0)
        size = np.zeros(len(quote), dtype=np.int64)
        for s in CONTRACTIONS_1:
            size[one == ord(s)] = 2
        for s in CONTRACTIONS_2:
            size[(one == ord(s[0])) & (two == ord(s[1]))] = 3
        quote, size, end = quote[size > 0], size[size > 0], end[size > 0]
        start[quote + 1] = False
        rest = quote + size
        start[rest[rest < end]] = True
    return np.nonzero(start)[0]


class WordCache:
    """Ids of words seen by this worker, found by hash; memory is bounded."""

    def __init__(self):
        self.reset()

    def reset(self):
        self.key = np.zeros(1 << CACHE_SLOT_BITS, np.uint64)
        self.row = np.full(1 << CACHE_SLOT_BITS, -1, np.int64)
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.int32)
        self.rows = self.used = 0

    def slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - CACHE_SLOT_BITS)).astype(np.int64)

    def add(self, h: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        n, used = self.rows + len(h), self.used + len(ids)
        if n > len(self.start):
            grow = max(n, 2 * len(self.start))
            self.start = np.resize(self.start, grow)
            self.count = np.resize(self.count, grow)
        if used > len(self.ids):
            self.ids = np.resize(self.ids, max(used, 2 * len(self.ids)))
        rows = np.arange(self.rows, n)
        self.count[rows] = counts
        self.start[rows] = self.used + np.cumsum(counts) - counts
        self.ids[self.used:used] = ids
        slot = self.slots(h)
        self.key[slot], self.row[slot] = h, rows
        self.rows, self.used = n, used
        return rows


class Encoder:
    """Texts -> ids, by a function that encodes a list of distinct words."""

    def __init__(self, vocab: Vocab, encode_words):
        self.vocab, self.encode_words, self.cache = vocab, encode_words, WordCache()

    def _segments(self, texts):
        """Texts cut at special strings: (pieces, text of each, specials to insert)."""
        import re

        if not self.vocab.specials:
            return list(texts), np.arange(len(texts)), [], []
        pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.vocab.specials, key=len, reverse=True))) + ")")
        pieces, owner, at, special = [], [], [], []
        for i, t in enumerate(texts):
            if any(s in t for s in self.vocab.specials):
                for k, piece in enumerate(pattern.split(t)):
                    if k % 2:
                        at.append(len(pieces))      # before the next piece
                        special.append(self.vocab.specials[piece])
                    else:
                        pieces.append(piece)
                        owner.append(i)
            else:
                pieces.append(t)
                owner.append(i)
        return pieces, np.array(owner, dtype=np.int64), at, special

    def _rows(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cache row of each word, number of words of each piece)."""
        blob = "".join(pieces)
        lens = np.array([len(p) for p in pieces], dtype=np.int64)
        if not blob:
            return np.zeros(0, np.int64), np.zeros(len(pieces), np.int64)
        points = np.frombuffer(blob.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        offs = np.cumsum(lens) - lens
        starts = word_starts(points, offs[lens > 0])
        ends = np.append(starts[1:], len(points))
        h = span_hashes(points, starts, ends)
        cache = self.cache
        if cache.rows > CACHE_WORDS:
            cache.reset()
        slot = cache.slots(h)
        rows = cache.row[slot]
        miss = np.nonzero((cache.key[slot] != h) | (rows < 0))[0]
        if len(miss):
            new, at, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            pick = miss[at]
            words = [blob[a:b].encode("utf-8", "replace") for a, b in zip(starts[pick].tolist(), ends[pick].tolist())]
            ids, counts = self.encode_words(words)
            rows[miss] = cache.add(new, ids, counts)[inverse]
        per = np.diff(np.append(np.searchsorted(starts, offs), len(starts)))
        return rows, per

    def _batches(self, pieces: list[str]):
        lo = size = 0
        for i, p in enumerate(pieces):
            if size and size + len(p) > BATCH_CHARS:
                yield lo, i
                lo, size = i, 0
            size += len(p)
        if lo < len(pieces):
            yield lo, len(pieces)

    def counts(self, texts) -> np.ndarray:
        """Number of ids of each text."""
        pieces, owner, _, _ = self._segments(texts)
        out = np.zeros(len(texts), dtype=np.int64)
        for lo, hi in self._batches(pieces):
            rows, per = self._rows(pieces[lo:hi])
            acc = np.concatenate([[0], np.cumsum(self.cache.count[rows])])
            ends = np.cumsum(per)
            np.add.at(out, owner[lo:hi], acc[ends] - acc[ends - per])
        if len(pieces) > len(texts):               # one special between two pieces of a text
            out += np.bincount(owner, minlength=len(texts)) - 1
        return out

    def encode(self, texts):
        """Yields the ids (int32 array) of each text in turn."""
        pieces, owner, at, special = self._segments(texts)
        before = dict(zip(at, special))
        done, part = 0, []
        for lo, hi in self._batches(pieces):
            rows, per = self._rows(pieces[lo:hi])
            counts = self.cache.count[rows]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            flat = self.cache.ids[np.repeat(self.cache.start[rows] - (ends - counts), counts) + np.arange(total)]
            acc = np.concatenate([[0], ends])
            words = np.cumsum(per)
            for k in range(lo, hi):
                if owner[k] != done:
                    yield part[0] if len(part) == 1 else np.concatenate(part)
                    done, part = owner[k], []
                if k in before:
                    part.append(np.array([before[k]], dtype=np.int32))
                w = words[k - lo]
                part.append(flat[acc[w - per[k - lo]]:acc[w]])
        if part:
            yield part[0] if len(part) == 1 else np.concatenate(part)
