"""Exact top-k inner products of a query set against all vectors.

Method: norm-sorted search.  Vectors are range-sorted by descending length over
the whole table and packed into blocks, rotated by the singular vectors of a
sample.  All queries first meet the block of the longest vectors; their k-th
scores there bound what can follow: a query goes on only to ranges whose longest
vector c has |q| |c| at or above its k-th score, in blocks of queries of like
bounds, by an equi-join on the range.  Inside a block the scan ends where |q| |c|
falls below the k-th score, and a vector whose first rotated coordinates plus
the Cauchy-Schwarz bound of the rest stay below it is passed over.  The scores
themselves are exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holecard.session import write_table

TOP = 5
SCALE = 256
#: Vectors and queries of a block.
BLOCK = 8192
LEAST_BLOCKS = 64
QUERY_BLOCK = 1024
#: Bound of the sample that the rotation is fitted on; it only affects speed.
SAMPLE = 5000
#: Longer vectors are not rotated.
LARGEST_ROTATION = 1024
#: Vectors of one step of a scan.
STEP = 512
#: Most ranges of lengths that queries are sent to.  The driver knows the longest
#: of each, and samples a few hundred rows for each to find their bounds.
RANGES = 256
#: The range of the longest block, which all queries meet first.
LONGEST = -1


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale x) of every component; null if the vector takes no part."""
    inf = float("inf")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == inf))
    return F.when(~F.coalesce(bad, F.lit(True)),
                  F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))



def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the fewest bytes that hold them all."""
    ends = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    return values.astype(next(k for k in (np.int8, np.int16, np.int32, np.int64)
                              if np.iinfo(k).min <= ends[0] and ends[1] <= np.iinfo(k).max))


def widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` values whose bytes :func:`narrow` made, as 64-bit numbers."""
    return np.frombuffer(data, f"i{len(data) // n if n else 8}").astype(np.int64)


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond 64 bits they stop at the ends of a long."""
    most = (float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0))
            * q.shape[1])
    if most < 2 ** 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 2 ** 62:
        return q @ c.T
    out = q.astype(object) @ c.astype(object).T
    ends = np.iinfo(np.int64)
    return np.clip(out, ends.min, ends.max).astype(np.int64)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search_block(q_rows, q, c_rows, c_ids, c, rotation, k: int, kth=None):
    """The k best candidates of one block for each query: query, id, score.

    ``q_rows`` and ``c_rows`` number the table's rows: a query's own row is no
    candidate.  Only scores of at least ``kth`` are looked for.
    """
    turn = rotation if rotation is not None and rotation.shape[0] == q.shape[1] else np.eye(q.shape[1])
    order = np.argsort(-np.linalg.norm(c.astype(np.float64), axis=1), kind="stable")
    c, c_ids, c_rows = c[order], c_ids[order], c_rows[order]
    qr, cr = q.astype(np.float64) @ turn, c.astype(np.float64) @ turn
    head = max(1, q.shape[1] // 4)
    qn, cn = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_rest, c_rest = np.linalg.norm(qr[:, head:], axis=1), np.linalg.norm(cr[:, head:], axis=1)
    kth = np.full(len(q), -np.inf) if kth is None else kth.copy()
    found_id = [np.zeros(0, np.int64)] * len(q)
    found = [np.zeros(0, np.int64)] * len(q)
    for lo in range(0, len(c), STEP):
        hi = min(lo + STEP, len(c))
        slack = 1e-9 * qn * cn[lo] + 1e-6  # rounding of the bounds
        live = np.flatnonzero(qn * cn[lo] + slack >= kth)
        if not len(live):  # and every later vector is shorter
            break
        bound = qr[live, :head] @ cr[lo:hi, :head].T + q_rest[live, None] * c_rest[None, lo:hi]
        open_ = bound + slack[live, None] >= kth[live, None]
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            continue
        scores = exact_scores(q[live[rows]], c[lo:hi])
        for r, s in zip(rows, scores):
            i = live[r]
            at = np.flatnonzero(open_[r] & (c_rows[lo:hi] != q_rows[i]) & (s >= kth[i]))
            if not len(at):
                continue
            ids = np.concatenate([found_id[i], c_ids[lo:hi][at]])
            own = np.concatenate([found[i], s[at]])
            best = best_of(ids, own, k)
            found_id[i], found[i] = ids[best], own[best]
            if len(best) == k:
                kth[i] = found[i][-1]
    row = np.repeat(np.arange(len(q)), [len(x) for x in found])
    return row, np.concatenate(found_id) if len(q) else row, np.concatenate(found) if len(q) else row


def _rotation(vectors: DataFrame, total: int, sample: int) -> np.ndarray | None:
    """Right singular vectors of a hashed sample of the commonest dimension."""
    share = min(1.0, sample / max(total, 1))
    rows = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) \
        .where(F.size("comps") <= LARGEST_ROTATION).select("comps").limit(2 * sample).collect()
    sizes = [len(r[0]) for r in rows if len(r[0])]
    if not sizes:
        return None
    width = max(set(sizes), key=sizes.count)
    data = np.array([r[0] for r in rows if len(r[0]) == width], np.float64)
    return np.linalg.svd(data.T @ data)[0]


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE,
          block: int = BLOCK, query_block: int = QUERY_BLOCK, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest scores.

    ``vectors (vec_id, embedding)``; ``is_query`` is a condition on vec_id.
    Components become floor(scale x); a score is an integer inner product.
    Every row but the query's own is a candidate, also others with its vec_id
    or its vector; every row of a repeated query id is a query.  Ties go to
    the smaller vec_id; with fewer than k candidates all are returned.  Vectors
    that are null, or hold null or non-finite components, and rows without a
    vec_id take no part.  Only vectors of the same dimension are compared.  An
    empty table gives no rows.
    """
    comps = scaled(F.col("embedding"), scale)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), comps.alias("comps")) \
        .where("vec_id IS NOT NULL AND comps IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    length = F.sqrt(F.aggregate("comps", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    own = write_table(own.withColumn("length", length), "vectors")
    total = own.count()
    rotation = own.sparkSession.sparkContext.broadcast(_rotation(own, total, sample))
    n_ranges = min(RANGES, max(LEAST_BLOCKS, -(-total // block)))

    def packer(most: int, limits: bool):
        """Rows in their order as blocks of one dimension each; a partition's
        number is that of its range, but for the first rows of the first."""
        def one(rows: pa.Table, to: int) -> pa.RecordBatch:
            sizes = np.asarray(rows["comps"].combine_chunks().value_lengths())
            out = []
            for width in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == width))
                mine = rows.take(at)
                flat = np.asarray(mine["comps"].combine_chunks().flatten(), np.int64)
                limit = np.asarray(mine["kth"].cast(pa.float64()).fill_null(-np.inf)) if limits else np.zeros(0)
                out.append((to, float(np.asarray(mine["length"]).max()), int(width),
                            np.asarray(mine["row"]).tobytes(), np.asarray(mine["vec_id"]).tobytes(), narrow(flat).tobytes(),
                            limit.tobytes(), float(np.min(np.asarray(mine["ratio"]))) if limits else 0.0))
            cols = list(zip(*out))
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        names = ["range", "top", "width", "rows", "ids", "data", "limits", "ratio"]
        kinds = [pa.int32(), pa.float64(), pa.int32(), *[pa.binary()] * 4, pa.float64()]

        def work(batches):
            part = TaskContext.get().partitionId()
            to = part or LONGEST
            held, n = [], 0
            for batch in batches:
                while n + batch.num_rows >= most:
                    held.append(batch.slice(0, most - n))
                    batch = batch.slice(most - n)
                    yield one(pa.Table.from_batches(held), to)
                    held, n, to = [], 0, part
                if batch.num_rows:
                    held.append(batch)
                    n += batch.num_rows
            if n:
                yield one(pa.Table.from_batches(held), to)
        return work

    packed = "range int, top double, width int, rows binary, ids binary, data binary, limits binary, ratio double"
    by_length = [F.desc("length"), F.asc("row")]
    blocks = own.repartitionByRange(n_ranges, *by_length).sortWithinPartitions(*by_length) \
        .mapInArrow(packer(block, False), packed)
    blocks = write_table(blocks.drop("limits", "ratio"), "blocks")
    tops = blocks.groupBy("range").agg(F.max("top").alias("top")).orderBy("range").collect()
    lead = tops[0]["range"] if tops else 0

    def searched(asked: DataFrame) -> DataFrame:
        asked = asked.select(F.col("to"), F.col("width").alias("q_width"), F.col("rows").alias("q_rows"),
                             F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), "limits")
        pairs = blocks.join(asked, (F.col("range") == F.col("to")) & (F.col("width") == F.col("q_width"))) \
            .select("width", "rows", "ids", "data", "q_rows", "q_ids", "q_data", "limits")

        def search(batches):
            for batch in batches:
                for x in range(batch.num_rows):
                    width, *data = (batch.column(c)[x].as_py() for c in range(8))
                    c_rows, c_ids, q_rows, q_ids = (np.frombuffer(data[i], np.int64) for i in (0, 1, 3, 4))
                    c, q = widened(data[2], len(c_rows) * width), widened(data[5], len(q_rows) * width)
                    limit = np.frombuffer(data[6], np.float64) if data[6] else None
                    row, best, score = search_block(q_rows, q.reshape(len(q_rows), width), c_rows, c_ids,
                                                    c.reshape(len(c_rows), width), rotation.value, k, limit)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_rows[row]), pa.array(q_ids[row]), pa.array(best), pa.array(score)],
                        names=["q_row", "query_id", "vec_id", "score"])

        return pairs.mapInArrow(search, "q_row long, query_id long, vec_id long, score long")

    ranked = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    queries = own.where(is_query)
    n_queries = max(1, -(-queries.count() // query_block))
    first = queries.repartition(n_queries, "row").mapInArrow(packer(query_block, False), packed)
    first = write_table(searched(first.withColumn("to", F.lit(lead))).withColumn("rank", F.row_number().over(ranked))
                        .where(F.col("rank") <= k), "first")
    known = first.where(F.col("rank") == k).select(F.col("q_row").alias("row"), F.col("score").alias("kth"))
    ratio = F.when(F.col("length") > 0, F.col("kth") / F.col("length"))
    rest = queries.join(known, "row", "left").withColumn("ratio", F.coalesce(ratio, F.lit(float("-inf"))))
    rest = rest.repartitionByRange(n_queries, "ratio", "row").sortWithinPartitions("ratio", "row") \
        .mapInArrow(packer(query_block, True), packed)
    longest = F.array(*[F.struct(F.lit(t["range"]).alias("range"), F.lit(t["top"]).alias("top")) for t in tops[1:]]) \
        .cast("array<struct<range: int, top: double>>")
    rest = rest.withColumn("to", F.explode(F.transform(F.filter(longest, lambda t: reaches(t["top"], F.col("ratio"))),
                                                       lambda t: t["range"])))
    found = first.drop("rank").unionByName(searched(rest))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def reaches(top: Column, ratio: Column) -> Column:
    """Whether a range whose longest vector has length ``top`` can hold a score
    that is at least ``ratio`` times the query's length."""
    return top * (1 + 1e-9) + 1e-6 >= ratio
