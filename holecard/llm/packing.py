"""Packing token sequences with balanced cost.

Method: pieces of documents are assigned in descending length; each goes to the
sequence of the lowest cost, linear plus quadratic in its pieces' lengths,
among those with room for it.  What fits nowhere whole is cut to fill the room
that is left, so every sequence is full.  A task packs the documents of its own
partition in batches, without a shuffle; the last tokens of a partition fill
sequences of a power of two, which need no padding.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holecard.llm import columnar as C

CAPACITY = 4096
END_ID = 2
#: Cost of a piece of n tokens: LINEAR n + QUADRATIC n^2.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Tokens that are packed together.
BATCH_TOKENS = 1 << 20
#: Words whose ids a task remembers.
CACHE_WORDS = 2 << 20
#: It begins anew when these words have more ids than this.
CACHE_IDS = 16 << 20
#: A word of its own in the tokenizer, put between the words of a call.
DIVIDER = "|"

_OUT = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


class WordIds:
    """Token ids of words, for tokenizers that drop white space.

    The ids of a text are then those of its words one after another, so each
    different word is tokenized once.  Words are known by a 64-bit hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.divider = self._encode(DIVIDER)
        if self._encode("a b") != self._encode("a") + self._encode(" b "):
            raise ValueError("the tokenizer doesn't drop white space")
        self.kind = np.uint16 if max(self.tokenizer.get_vocab().values()) < 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.ids = np.zeros(0, self.kind)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids one after another, and how many each word has; words
        are joined by the divider, whose id in the answer tells them apart."""
        flat, counts = [], []
        for lo in range(0, len(words), 512):
            own = words[lo:lo + 512]
            joined = f" {DIVIDER} ".join(own)
            if len(self.divider) == 1 and joined.count(DIVIDER) == len(own) - 1:
                ids = np.array(self._encode(joined), np.uint32)
                is_divider = ids == self.divider[0]
                ends = np.append(np.flatnonzero(is_divider), len(ids))
                if len(ends) == len(own):
                    counts.append(np.diff(ends, prepend=-1) - 1)
                    flat.append(ids[~is_divider])
                    continue
            each = [self._encode(w) for w in own]
            counts.append(np.fromiter(map(len, each), np.int64, len(each)))
            flat.append(np.array([x for w in each for x in w], np.uint32))
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(counts)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.known) + len(hashes) > CACHE_WORDS:
            self.clear()
        flat, count = self._encode_words(words)
        start = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, flat.astype(self.kind)])
        at = np.searchsorted(self.known, hashes)  # both ascend
        self.start = np.insert(self.start, at, start)
        self.count = np.insert(self.count, at, count)
        self.known = np.insert(self.known, at, hashes)

    def encode(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end_id`` after it, and their offsets."""
        sp = C.spans(buf, offs)
        h = C.span_hashes(buf, sp)
        unique, first, which = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, unique), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != unique) if len(self.known) else np.arange(len(unique))
        if len(self.known) + len(new) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            new = np.arange(len(unique))
            self.clear()
        if len(new):
            raw = buf.tobytes()
            self.learn(unique[new], [raw[sp.starts[i]:sp.ends[i]].decode("utf-8", "replace") for i in first[new]])
            at = np.searchsorted(self.known, unique)
        at = at[which]
        count = self.count[at].astype(np.int64)
        ids = self.ids[C.gather(self.start[at].astype(np.int64), count)]
        before = np.concatenate([[0], np.cumsum(count)])[sp.first]  # ids ahead of each text
        bounds = before + np.arange(len(before))
        out = np.full(bounds[-1], end_id, np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[bounds[1:] - 1] = True
        out[~is_end] = ids
        return out, bounds


def assign(lengths: list[int], rooms: list[int], linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> tuple[list, list]:
    """Pieces ``(item, start, length, sequence, offset)`` and what found no
    room, as ``(item, start, length)``; items come in descending length."""
    room = np.array(rooms, np.int64)
    free, cost = room.copy(), np.zeros(len(room))
    placed, left = [], []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, rest = 0, lengths[item]
        while rest:
            fits = np.flatnonzero(free >= rest)
            if len(fits):
                to, n = int(fits[np.argmin(cost[fits])]), rest
            else:
                to = int(np.argmax(free)) if len(free) else 0
                n = int(free[to]) if len(free) else 0
                if not n:
                    left.append((item, start, rest))
                    break
            placed.append((item, start, n, to, int(room[to] - free[to])))
            free[to] -= n
            cost[to] += linear * n + quadratic * n * n
            start, rest = start + n, rest - n
    return placed, left


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own word ids of a tokenizer.

    Tasks name this function by its module, so all tasks of a worker find the
    words that earlier ones learned; a dictionary that a task's function itself
    refers to is copied, empty, into every task.
    """
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Pieces of all documents: ``(doc_id, start, length, doc_tokens,
    sequence_id, offset, ids)``.

    A document ``(doc_id, text)`` is its token ids and ``end_id``; a null text
    is empty.  ``start`` is the piece's place in its document, ``offset`` that
    in its sequence, ``ids`` its ids as little-endian unsigned 32-bit numbers.
    Sequences hold at most ``capacity`` tokens (a power of two); all are full
    or of a power of two, so none needs padding.  Repeated rows are documents
    of their own; an empty table gives no rows.  ``tokenizer`` is the path of a
    tokenizers file whose vocabulary drops white space.  sequence_id is unique
    over the table, and the same again for the same partitions.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity is a power of two")

    def work(batches):
        words = word_ids(tokenizer)
        made = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        pending: list[tuple] = []  # doc_id, tokens of the document, start, ids
        have = 0

        def flush(final: bool):
            nonlocal made, pending, have
            total, lengths, rows = 0, [], []
            for doc_id, n, start, ids in pending:
                whole = len(ids) // capacity
                for w in range(whole):  # full windows are sequences of their own
                    rows.append((doc_id, start + w * capacity, capacity, n, made, 0,
                                 ids[w * capacity:(w + 1) * capacity]))
                    made += 1
                lengths.append(len(ids) - whole * capacity)
                total += lengths[-1]
            rooms = [capacity] * (total // capacity) + (powers_of_two(total % capacity) if final else [])
            placed, left = assign(lengths, rooms)
            for item, start, n, to, offset in placed:
                doc_id, size, first, ids = pending[item]
                base = len(ids) - lengths[item] + start
                rows.append((doc_id, first + base, n, size, made + to, offset, ids[base:base + n]))
            made += len(rooms)
            rest = []
            for item, start, n in left:
                doc_id, size, first, ids = pending[item]
                base = len(ids) - lengths[item] + start
                rest.append((doc_id, size, first + base, ids[base:base + n]))
            pending, have = rest, sum(len(x[3]) for x in rest)
            cols = list(zip(*rows)) if rows else [[]] * 7
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in cols[6]])]).astype(np.int64) * 4
            data = np.concatenate(cols[6]).astype("<u4") if rows else np.zeros(0, "<u4")
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows),
                                                   [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[c], pa.int64()) for c in range(6)] + [ids.cast(pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, buf, offs in C.text_slices(batch.column(1)):
                ids, bounds = words.encode(buf, offs, end_id)
                for k in range(j - i):
                    own = ids[bounds[k]:bounds[k + 1]]
                    pending.append((doc_ids[i + k], len(own), 0, own))
                    have += len(own)
                    if have >= batch_tokens:
                        yield flush(final=False)
        if pending:
            yield flush(final=True)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda batches: C.releasing(work(batches)), _OUT)
