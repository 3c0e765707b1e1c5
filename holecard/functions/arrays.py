"""Linear work on long arrays inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that one step of a running sum adds up; sums of these parts are added first.
_CHUNK = 32


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once.

    A column that a lambda refers to may be inlined by the optimizer and
    computed for every element; a lambda's own variable never is.
    """
    return F.transform(F.array(value), body)[0]


def running_sums(sizes: Column) -> Column:
    """Sum of the sizes (longs) before each place; null for a null array.

    Appending to an array copies it, so places are summed in parts of
    ``_CHUNK``, and the parts' totals likewise.
    """
    none = F.array().cast("array<long>")

    def sums(values: Column, start: Column) -> Column:
        out = F.aggregate(values, F.array(start.cast("long")),
                          lambda a, v: F.concat(a, F.array(F.element_at(a, F.lit(-1)) + v)))
        return F.slice(out, F.lit(1), F.size(values))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)

    def in_chunks(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int"))
        chunks = F.transform(starts, lambda i: F.slice(values, i * _CHUNK + 1, _CHUNK))
        return let(chunks, lambda cs: F.flatten(F.zip_with(cs, sums(F.transform(cs, total), F.lit(0)), sums)))

    return let(sizes, lambda v: F.when(v.isNull(), F.lit(None)).when(F.size(v) == 0, none)
               .when(F.size(v) <= _CHUNK, sums(v, F.lit(0))).otherwise(in_chunks(v)))
