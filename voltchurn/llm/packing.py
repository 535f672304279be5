"""Sum-of-squares online packing of documents into fixed token windows.

A level array counts the partially filled windows at each fill level.  Each
document (its last piece, if it is longer than a window) goes to the level
that minimises the sum of the squared counts afterwards.  Every input
partition packs its own rows as they arrive; its open windows are the only
state.  At its end the open windows are closed by cutting: the emptiest ones
are dealt out to fill the fullest, and the last one is cut into windows whose
sizes are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from voltchurn.llm.bpe import encoder, id_text, text_batches
from voltchurn.llm.workers import lean

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, window long")
SHARD_BITS = 40


class LevelArray:
    """Partially filled windows by fill level, and the sum-of-squares choice."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def choose(self, size: int) -> int:
        """Level (0: a new window) whose filling by ``size`` leaves the least
        sum of squared counts; ties go to the fullest level."""
        c = self.count
        top = self.window - size
        after = 2 * c[size:] + 1                       # a window arrives at level + size ...
        after[-1] = 0                                  # ... unless that fills it
        change = after - 2 * c[: top + 1] + 1          # and leaves its level
        change[0] = after[0]                           # a new window leaves none
        usable = c[: top + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return int(top - np.argmin(change[::-1]))

    def take(self, level: int) -> int:
        self.count[level] -= 1
        return self.open[level].pop()

    def put(self, level: int, window_id: int) -> None:
        self.count[level] += 1
        self.open[level].append(window_id)


class Packer:
    """Packs documents one by one; yields finished pieces."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id = window, first_id
        self.levels = LevelArray(window)
        self.content: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _rows(self, sequence: int, pieces, size: int):
        offset = 0
        for doc, start, total, ids in pieces:
            yield (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, size)
            offset += len(ids)

    def add(self, doc: int, ids: np.ndarray):
        total, start = len(ids), 0
        while total - start >= self.window:
            yield from self._rows(self._new(), [(doc, start, total, ids[start:start + self.window])], self.window)
            start += self.window
        size = total - start
        if not size:
            return
        level = self.levels.choose(size)
        sequence = self.levels.take(level) if level else self._new()
        pieces = self.content.setdefault(sequence, [])
        pieces.append((doc, start, total, ids[start:].copy()))
        if level + size == self.window:
            yield from self._rows(sequence, self.content.pop(sequence), self.window)
        else:
            self.levels.put(level + size, sequence)

    def close(self):
        """Empties the open windows: cuts the emptiest to fill the fullest."""
        left = sorted(self.content.values(), key=lambda ps: (-sum(len(p[3]) for p in ps), ps[0][0] is None, ps[0][0] or 0, ps[0][1]))
        self.content.clear()
        queue = [p for pieces in left for p in pieces]
        remaining = sum(len(p[3]) for p in queue)
        while remaining:
            size = self.window if remaining >= self.window else 1 << (remaining.bit_length() - 1)
            pieces, room = [], size
            while room:
                doc, start, total, ids = queue[0]
                pieces.append((doc, start, total, ids[:room]))
                if len(ids) > room:
                    queue[0] = (doc, start + room, total, ids[room:])
                    room = 0
                else:
                    room -= len(ids)
                    queue.pop(0)
            yield from self._rows(self._new(), pieces, size)
            remaining -= size


def pack_documents(docs: DataFrame, vocab_path: str, window: int = 2048, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where each run of a document's ids lies.

    doc_id, start (ids of the document before the piece), length, ids_crc32
    (of the little-endian 32-bit ids), doc_tokens, sequence_id, offset and
    window (size of the sequence: ``window``, or a power of two at the end of
    a partition).  A document's ids are its tokens followed by ``end_id``; a
    null or empty text is that one id.  Repeated rows are packed each on their
    own.  Needs no shuffle; sequence ids hold the partition number in their
    high bits, so a recomputed partition yields the same ids.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches):
        enc = encoder(vocab_path)
        packer = Packer(window, TaskContext.get().partitionId() << SHARD_BITS)
        names = [c.split()[0] for c in PIECES.split(", ")]
        tail = np.array([end_id], dtype=np.int32)

        def frame(rows):
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(text_batches(batch))):
                rows.extend(packer.add(doc, np.concatenate([ids, tail])))
            yield frame(rows)
        yield frame(list(packer.close()))

    return id_text(docs, id_col, text_col).mapInArrow(lean(run, tables=True), PIECES)
