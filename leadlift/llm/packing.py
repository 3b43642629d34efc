"""Packing by the online sum-of-squares rule, with a level array per task.

A document's tokens are cut into whole windows; what is left over, shorter than a
window, goes into the fill level for which the sum over levels of squared counts of
partially filled windows stays least. The counts stand in one array with an entry
for each level. A task packs the rows of its own partition, so nothing is shuffled and
a task that runs again replaces its own sequences only. Sequence ids hold the
partition's number above 32 bits of a counter.

Windows that are still open at the end of a partition, or once they hold
``max_open_tokens`` tokens, are closed: the fullest are topped up with pieces cut from
the emptiest. A partition pads one sequence at most.

Defined cases: a NULL or empty text is its end token alone; repeated rows are packed
each; a NULL doc_id stays NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import fields, query, slices, table, tokenizer_folder

PIECES = fields(
    doc_id="long", start="long", length="long", ids_crc32="long", doc_tokens="long",
    sequence_id="long", offset="long", sequence_tokens="long",
)


class Encoder:
    """Token ids, as 32-bit numbers of a little-endian machine, of what stands between blanks and line ends.

    The tokenizer joins nothing over white space, nor letters with the signs behind
    them, so each lower-cased word is encoded once and kept; the store starts anew when
    it holds ``most`` entries.
    """

    SIGNS = ".,;:!?#$%&*|"

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.known, self.tokenizer, self.most = {}, Tokenizer.from_file(path), most
        # The byte-level alphabet: printable bytes stand for themselves, the others follow on 255.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def ask(self, chunk: str) -> bytes:
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def ask_word(self, word: str) -> bytes:
        """Of lower-case letters alone, which nothing but the merges changes."""
        if not word.isascii():
            word = "".join(map(self.alphabet.__getitem__, word.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def learn(self, chunk: str) -> bytes:
        word = chunk.rstrip(self.SIGNS)
        if word.isalpha() and max(word) < "\u0130":
            low, signs = word.lower(), chunk[len(word) :]
            if low not in self.known:
                self.known[low] = self.ask_word(low)
            if signs not in self.known:
                self.known[signs] = self.ask(signs)
            ids = self.known[low] + self.known[signs]
        else:
            ids = self.ask(chunk)
        self.known[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self.known) > self.most:
            self.known = {}
        chunks = text.replace("\n", " ").replace("\t", " ").split(" ")
        found = list(map(self.known.get, chunks))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    found[at] = self.known.get(chunks[at]) or self.learn(chunks[at])
        return b"".join(found)


def encoder_of(path: str) -> Encoder:
    """The worker's encoder; what one of its tasks has encoded the next need not."""
    store = sys.modules.setdefault("_leadlift_encoders", types.ModuleType("_leadlift_encoders"))
    if path not in vars(store):
        setattr(store, path, Encoder(path))
    return getattr(store, path)


class Packer:
    """Sequences of at most ``window`` tokens from pieces (document, start, ids, total)."""

    def __init__(self, window: int, first_id: int, max_open_tokens: int):
        self.window, self.next_id, self.most = window, first_id, max_open_tokens
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list] = [[] for _ in range(window)]
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, step = len(ids) // 4, self.window
        whole = total - total % step
        for at in range(0, whole, step):
            self.close([(doc_id, at, ids[4 * at : 4 * (at + step)], total)])
        if whole < total:
            self.place((doc_id, whole, ids[4 * whole :], total))
            if self.held > self.most:
                self.settle(last=False)

    def place(self, piece: tuple) -> None:
        size, counts = len(piece[2]) // 4, self.counts
        levels = np.flatnonzero(counts[: self.window - size + 1])
        # Squared counts change by 1 - 2 N at the level left and by 2 N + 1 at the one entered.
        cost = 1 - 2 * counts[levels] + np.where(levels + size < self.window, 2 * counts[levels + size] + 1, 0)
        fresh = 2 * counts[size] + 1
        pieces, level = [], 0
        if len(levels):
            best = len(cost) - 1 - int(np.argmin(cost[::-1]))
            if cost[best] <= fresh:
                level = int(levels[best])
                pieces = self.open[level].pop()
                counts[level] -= 1
                self.held -= level
        pieces.append(piece)
        level += size
        if level == self.window:
            self.close(pieces)
        else:
            self.open[level].append(pieces)
            counts[level] += 1
            self.held += level

    def settle(self, last: bool) -> None:
        """Top up the fullest windows from the emptiest; one stays partial at most."""
        queue = [w for level in self.open for w in level]  # emptiest first
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.held = 0
        low = 0
        while len(queue) - low > 1:
            pieces = queue.pop()
            room = self.window - sum(len(p[2]) for p in pieces) // 4
            while room and low < len(queue):
                doc_id, start, ids, total = queue[low].pop()
                take = min(room, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * take], total))
                if 4 * take < len(ids):
                    queue[low].append((doc_id, start + take, ids[4 * take :], total))
                room -= take
                if not queue[low]:
                    low += 1
            if room:
                queue.append(pieces)
            else:
                self.close(pieces)
        for pieces in queue[low:]:
            level = sum(len(p[2]) for p in pieces) // 4
            if last:
                self.close(pieces)
            else:
                self.open[level].append(pieces)
                self.counts[level] += 1
                self.held += level

    def close(self, pieces: list[tuple]) -> None:
        tokens = sum(len(p[2]) for p in pieces) // 4
        at = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, at, tokens))
            at += len(ids) // 4
        self.next_id += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in PIECES]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECES.names)


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    window: int = 4096,
    max_open_tokens: int = 1 << 22,
) -> DataFrame:
    """One row per piece: whose, from which token, where it lies and in which sequence.

    ``sequence_tokens`` is the sequence's length without padding. ``tokenizer`` is the
    path of the vocabulary, the same on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer or os.path.join(tokenizer_folder(), "word_bpe_49k.json"))
        end = np.array([end_id], dtype="<u4").tobytes()
        packer = Packer(window, TaskContext.get().partitionId() << 32, max_open_tokens)
        for batch in slices(batches, 1 << 22):
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packer.add(key, encoder.encode(value or "") + end)
            yield packer.take()
        packer.settle(last=True)
        yield packer.take()

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, PIECES)


@query()
def op2_sum_of_squares_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
