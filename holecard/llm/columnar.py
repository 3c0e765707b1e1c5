"""Whole texts as flat numpy arrays.

A string column of an Arrow batch is one byte buffer and a list of offsets.
The helpers here find words, lines and n-grams of all texts of a buffer with
array operations, so tasks spend no time in per-word Python.  They work on
slices of a few megabytes; a single longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that one array operation covers.
SLICE_BYTES = 2 << 20
#: Bytes that are hashed at a time; every byte takes a few 64-bit numbers meanwhile.
HASH_BYTES = 1 << 18
#: The separators of words: U+0020 and U+0009 to U+000D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: Longer spans are hashed one by one.
_LONGEST = 1 << 12


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


IS_SPACE = byte_table(SPACES)
IS_NEWLINE = byte_table(b"\n")
#: First bytes of the code points that are no separators.
IN_WORD = ~IS_SPACE & ((np.arange(256) & 0xC0) != 0x80)
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32

_POWERS = np.multiply.accumulate(np.full(_LONGEST, _BASE, _U))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def flat_text(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) \
            if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or
                                  pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together, or of one text."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_slices(column, most: int = SLICE_BYTES):
    """``(first row, end row, bytes, offsets)`` of every slice of a column."""
    buf, offs = flat_text(column)
    for i, j in slices(offs, most):
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]


class Spans(NamedTuple):
    """Runs of bytes between separators; ``first[d]`` is text d's first span."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of every span."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = IS_SPACE) -> Spans:
    """Maximal runs of other bytes; a run never leaves its text."""
    inside = ~separators[buf]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Spans(starts, ends, np.searchsorted(starts, offs))


def span_hashes(buf: np.ndarray, sp: Spans) -> np.ndarray:
    """A 64-bit hash of the bytes of every span."""
    starts, ends, _ = sp
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + HASH_BYTES, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        if hi - lo > 2 * HASH_BYTES:  # one long span among them
            hi = int(min(hi, lo + 2 * HASH_BYTES))
        short = (e - s <= _LONGEST) & (e <= hi - lo)
        place = np.arange(hi - lo) - np.repeat(s, np.diff(np.append(np.minimum(s, hi - lo), hi - lo)))
        np.minimum(place, _LONGEST - 1, out=place)
        total = np.zeros(hi - lo + 1, _U)
        np.cumsum((buf[lo:hi].astype(_U) + _U(1)) * _POWERS[place], out=total[1:])
        e = np.minimum(e, hi - lo)
        out[i:j] = mix(total[e] - total[s])
        for k in np.flatnonzero(~short):
            out[i + k] = xxhash.xxh3_64_intdigest(buf[starts[i + k]:ends[i + k]].tobytes(), 1)
        i = j
    return out


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values, whichever text they are in."""
    if len(h) < n:
        return np.zeros(0, _U)
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out *= _U(_BASE)
        out += h[k:len(h) - n + 1 + k]
    return mix(out)


def whole_windows(owner: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n spans lie in one text."""
    return owner[:max(0, len(owner) - n + 1)] == owner[n - 1:]


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many entries are set in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the runs ``starts[i] : starts[i] + lengths[i]``, one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def joined_words(buf: np.ndarray, sp: Spans, keep: np.ndarray) -> pa.Array:
    """Per text its kept words joined by one space."""
    kept = np.flatnonzero(keep)
    bounds = np.searchsorted(kept, sp.first)
    size = sp.ends[kept] - sp.starts[kept]
    last = np.zeros(len(kept), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    room = size + ~last
    src = gather(sp.starts[kept], room)
    out = buf[np.minimum(src, max(len(buf) - 1, 0))] if len(buf) else np.zeros(0, np.uint8)
    ends = np.cumsum(room)
    out[ends[~last] - 1] = 32
    offs = np.concatenate([[0], ends])[bounds]
    return pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out)))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a newline before, between and after them;
    offsets of the texts' first code points, and one past the last newline."""
    joined = "\n" + "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return codes, np.concatenate([[1], 1 + np.cumsum(sizes + 1)])


def text_lists(column, most: int = SLICE_BYTES):
    """``(first row, end row, list of str)`` of every slice of a string column."""
    _, offs = flat_text(column)
    for i, j in slices(offs, most):
        yield i, j, [t or "" for t in column.slice(i, j - i).to_pylist()]


def release(result=None):
    """``result``, after the worker gave the memory it no longer needs back.

    A worker lives on for later tasks, and both allocators keep what arrays
    leave free; so its peak of every stage would stay beside the next one's.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)
    return result


def releasing(rows: Iterator) -> Iterator:
    """The rows of a task, with :func:`release` at its end."""
    yield from rows
    release()
