"""Exchanges of packed arrays.

Where a step sends a few bytes for every word of the corpus, rows would cost
more than the work.  Tasks sort such entries by bucket and send one row of
binary columns per bucket; the receiving task handles a bucket at a time.  The
number of buckets follows the bytes of text, so a bucket stays bounded, and
equal entries of a task are merged before they are sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for which one bucket is made, and the least number of buckets.
BUCKET_BYTES = 32 << 20
LEAST_BUCKETS = 128


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one aggregate over the column."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def bucket_count(n_bytes: int) -> int:
    return max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES))


def blobs(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Binary array of ``values[bounds[i]:bounds[i + 1]]``."""
    values = np.ascontiguousarray(values)
    offs = (bounds * values.dtype.itemsize).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offs), pa.py_buffer(values)]).cast(pa.binary())


def unblob(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row holds."""
    from holecard.llm.columnar import flat_text
    buf, offs = flat_text(column)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(buf.tobytes(), dtype), np.diff(offs) // size


def runs(values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal neighbours: first indices and the length."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
