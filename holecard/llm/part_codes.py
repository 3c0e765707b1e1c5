"""Vector codes by parts, learned over anchors-hierarchy metric trees.

Vectors are scaled to whole numbers and cut into equal parts; a part position's
codebook is refined by rounds of nearest-entry assignment and floored means.
Tasks pack the vectors into blocks of bounded size.  Over the parts of a block
at one position stands a metric tree, built middle-out: the square root of the
points become anchors, each new one the point farthest from its anchor and
taking the points that are nearer to it; anchors are merged upwards by the
smallest ball around two of them and divided downwards in the same way.  Every
ball keeps the count and the sum of its points.

An assignment passes a list of candidate entries from a ball to its children;
an entry leaves the list when another one is nearer to every point of the ball.
A ball with one candidate left is owned as a whole: its sum and count are
added at once.  Points of the lowest balls compare the entries left, in whole
numbers.  Blocks are written once with their trees; a round is a map over them
and a combinable sum, of which entries times components rows reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holecard.session import write_table
from holecard.sources.tables import spread

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows and bytes of a block, and points of a ball that isn't divided.
BLOCK_ROWS, BLOCK_BYTES, LEAF_POINTS = 4096, 16 << 20, 12
#: Larger components are kept as Python's whole numbers, which have no bound.
_WIDE = 1 << 24
#: Bits of a partial sum's digit: sums of any size travel as a few longs.
_DIGIT = 32


class Codes(NamedTuple):
    """``rows``: for every vector that takes part its other columns, ``code``
    and ``error``; ``books``: per part the entries, lists of whole numbers."""

    rows: DataFrame
    books: list[list[list[int]]]

    def digest(self) -> str:
        """Hex sha256 of all entries' components by part, entry and place."""
        flat = (str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def complete(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, exactly; ``scale`` is a power of two."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    if scaled.size and not np.abs(scaled).max() < _WIDE:
        out = np.empty(vectors.shape, object)
        out.ravel()[:] = [math.floor(x.as_integer_ratio()[0] * scale / x.as_integer_ratio()[1])
                          if abs(x) < 1 else (x.as_integer_ratio()[0] * scale) // x.as_integer_ratio()[1]
                          for x in map(float, vectors.ravel())]
        return out
    return scaled.astype(np.int64)


def cut(whole: np.ndarray, parts: int) -> np.ndarray:
    """``[row, part, place]``; short vectors are filled up with zeros."""
    rows, size = whole.shape
    width = -(-size // parts)
    out = np.zeros((rows, parts * width), whole.dtype)
    out[:, :size] = whole
    return out.reshape(rows, parts, width)


class Tree(NamedTuple):
    """Balls in an order where parents come first; ``order`` are the points, of
    which ball b holds ``first[b]:last[b]``."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    parent: np.ndarray
    leaf: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _anchors(points: np.ndarray) -> list[np.ndarray]:
    """Divide points among the square root of their number of anchors.

    An anchor's points are sorted by falling distance, so those nearer to it
    than half of the way to a new anchor are passed over unseen.
    """
    want = max(2, math.isqrt(len(points)))

    def distances(of: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.sqrt(((points[of] - at) ** 2).sum(1))

    every = np.arange(len(points))
    away = distances(every, points[0])
    order = np.argsort(-away, kind="stable")
    owned, far, at = [every[order]], [away[order]], [points[0]]
    while len(owned) < want:
        widest = max(range(len(owned)), key=lambda k: far[k][0] if len(far[k]) else -1.0)
        if not len(far[widest]) or far[widest][0] == 0.0:
            break
        new = points[owned[widest][0]]
        taken, taken_far = [], []
        for k in range(len(owned)):
            half = float(np.sqrt(((at[k] - new) ** 2).sum())) / 2
            seen = int(np.searchsorted(-far[k], -half, side="left"))
            if not seen:
                continue
            near = distances(owned[k][:seen], new)
            moves = near < far[k][:seen]
            if not moves.any():
                continue
            taken.append(owned[k][:seen][moves])
            taken_far.append(near[moves])
            keep = np.ones(len(owned[k]), bool)
            keep[:seen] = ~moves
            owned[k], far[k] = owned[k][keep], far[k][keep]
        if not taken:
            break
        members, away = np.concatenate(taken), np.concatenate(taken_far)
        order = np.argsort(-away, kind="stable")
        owned.append(members[order])
        far.append(away[order])
        at.append(new)
    return [members for members in owned if len(members)]


def _merge(groups: list[tuple]) -> tuple:
    """Merge (centre, radius, count, subtree) balls two by two into one, always
    the two of the smallest ball around both."""
    centre = np.array([g[0] for g in groups])
    radius, count = np.array([g[1] for g in groups]), np.array([float(g[2]) for g in groups])
    trees = [g[3] for g in groups]

    def around(k: int) -> np.ndarray:
        gap = np.sqrt(((centre - centre[k]) ** 2).sum(1))
        out = (gap + radius + radius[k]) / 2
        out[~alive] = np.inf
        out[k] = np.inf
        return out

    alive = np.ones(len(groups), bool)
    cost = np.array([around(k) for k in range(len(groups))])
    for _ in range(len(groups) - 1):
        a, b = divmod(int(cost.argmin()), len(groups))
        total = count[a] + count[b]
        middle = (centre[a] * count[a] + centre[b] * count[b]) / total
        radius[a] = max(np.sqrt(((centre[a] - middle) ** 2).sum()) + radius[a],
                        np.sqrt(((centre[b] - middle) ** 2).sum()) + radius[b])
        centre[a], count[a], trees[a] = middle, total, (trees[a], trees[b])
        alive[b] = False
        cost[b, :] = cost[:, b] = np.inf
        cost[a, :] = cost[:, a] = around(a)
    return trees[int(np.flatnonzero(alive)[0])]


def _shape(points: np.ndarray, members: np.ndarray):
    """The nested pairs of member arrays over ``members``."""
    if len(members) <= LEAF_POINTS:
        return members
    groups = [members[g] for g in _anchors(points[members])]
    if len(groups) < 2:
        return members
    balls = []
    for g in groups:
        centre = points[g].mean(0)
        balls.append((centre, float(np.sqrt(((points[g] - centre) ** 2).sum(1)).max()), len(g), _shape(points, g)))
    return _merge(balls)


def build_tree(whole: np.ndarray) -> Tree:
    """The anchors hierarchy over ``[point, place]``."""
    points = whole.astype(np.float64)
    order, first, last, parent, leaf = [], [], [], [], []
    at = 0
    stack = [(_shape(points, np.arange(len(points))), -1)]
    while stack:
        node, up = stack.pop()
        if isinstance(node, int):  # the ball's points end here
            last[node] = at
            continue
        k = len(first)
        first.append(at)
        last.append(at)
        parent.append(up)
        leaf.append(not isinstance(node, tuple))
        if leaf[-1]:
            order.append(node)
            at += len(node)
            last[k] = at
        else:
            stack += [(k, -1), (node[1], k), (node[0], k)]
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    first, last = np.array(first, np.int64), np.array(last, np.int64)
    total = np.concatenate([np.zeros((1, whole.shape[1]), whole.dtype), np.cumsum(whole[order], axis=0)])
    sums = total[last] - total[first]
    centre = sums.astype(np.float64) / np.maximum(last - first, 1)[:, None]
    radius = np.array([np.sqrt(((points[order[a:b]] - c) ** 2).sum(1)).max() if b > a else 0.0
                       for a, b, c in zip(first, last, centre)])
    return Tree(order, first, last, np.array(parent), np.array(leaf), centre, radius * (1 + 1e-9), sums)


def assign(whole: np.ndarray, tree: Tree, book: np.ndarray):
    """``(entry of every point, sums and counts of every entry, balls owned as
    a whole)``; ties go to the lower entry."""
    k = len(book)
    entry = np.zeros(len(whole), np.int64)
    sums, counts = np.zeros((k, whole.shape[1]), whole.dtype if whole.dtype == object else np.int64), [0] * k
    if book.dtype == object and sums.dtype != object:
        sums = sums.astype(object)
    centres = book.astype(np.float64)
    away = ((tree.centre[:, None, :] - centres[None]) ** 2).sum(2)
    apart = np.sqrt(((centres[:, None, :] - centres[None]) ** 2).sum(2))
    # of equal entries only the first can win
    every = np.array([e for e in range(k) if not (book[:e] == book[e]).all(1).any()], np.int64)
    owned, loose = 0, []
    lists: dict[int, np.ndarray] = {}
    done = np.zeros(len(tree.first), bool)
    for b in range(len(tree.first)):
        up = tree.parent[b]
        if up >= 0 and done[up]:
            done[b] = True
            continue
        left = lists[up] if up >= 0 else every
        if len(left) > 1:
            # the most that the nearest entry's squared distance can exceed another's in the ball
            best = left[away[b, left].argmin()]
            slack = away[b, best] - away[b, left] + 2 * tree.radius[b] * apart[best, left]
            room = 1e-6 + 1e-9 * (away[b, left] + away[b, best])
            left = left[(slack >= -room) | (left == best)]
        lists[b] = left
        if len(left) == 1:
            done[b] = True
            owned += 1
            entry[tree.order[tree.first[b]:tree.last[b]]] = left[0]
            sums[left[0]] += tree.sums[b]
            counts[left[0]] += int(tree.last[b] - tree.first[b])
        elif tree.leaf[b]:
            loose.append(b)
    for b in loose:
        points = tree.order[tree.first[b]:tree.last[b]]
        left = lists[b]
        gaps = ((whole[points][:, None, :] - book[left][None]) ** 2).sum(2)
        entry[points] = left[np.asarray(gaps.argmin(1), np.int64)]
        for e in np.unique(entry[points]):
            mine = points[entry[points] == e]
            sums[e] += whole[mine].sum(0)
            counts[e] += len(mine)
    return entry, sums, counts, owned


def _digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) whose sum of digit * 2^(32 place) is ``value``."""
    out, place, sign = [], 0, -1 if value < 0 else 1
    value = abs(value)
    while value:
        out.append((place, sign * (value & ((1 << _DIGIT) - 1))))
        value >>= _DIGIT
        place += 1
    return out


def _stored(whole: np.ndarray, trees: list[Tree]) -> bytes:
    if whole.dtype != object:
        whole = whole.astype(np.int16 if not whole.size or np.abs(whole).max() < 1 << 15 else np.int32)
    return pickle.dumps((whole, trees))


def _restored(data: bytes) -> tuple[np.ndarray, list[Tree]]:
    whole, trees = pickle.loads(data)
    return whole if whole.dtype == object else whole.astype(np.int64), trees


def _blocks(vectors: DataFrame, vector: str, size: int, parts: int, scale: int) -> DataFrame:
    """Blocks of rows: the scaled vectors with their trees, and the other columns."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 8 * size)))

    def pack(rows: pa.Table) -> pa.RecordBatch:
        values = np.asarray(rows["vector"].combine_chunks().flatten().cast(pa.float64()))
        whole = cut(whole_numbers(values.reshape(len(rows), size), scale), parts)
        trees = [build_tree(whole[:, p]) for p in range(parts)]
        kept = rows["row"].combine_chunks()
        if isinstance(kept, pa.ChunkedArray):
            kept = kept.chunk(0)
        lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), kept)
        return pa.record_batch([pa.array([_stored(whole, trees)], pa.binary()), lists], ["block", "rows"])

    def work(batches):
        held, n = [], 0
        for batch in batches:
            while n + batch.num_rows >= most:
                held.append(batch.slice(0, most - n))
                batch = batch.slice(most - n)
                yield pack(pa.Table.from_batches(held))
                held, n = [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if n:
            yield pack(pa.Table.from_batches(held))

    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector]
    rows = vectors.select(F.col(f"`{vector}`").alias("vector"), F.struct(*others).alias("row"))
    schema = T.StructType().add("block", T.BinaryType()).add("rows", T.ArrayType(rows.schema["row"].dataType))
    return rows.mapInArrow(work, schema)


def learn(blocks: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """The codebooks after ``rounds`` of assigning all blocks."""
    for _ in range(rounds):
        now = books

        def work(batches, now=now):
            for batch in batches:
                for data in batch["block"].to_pylist():
                    whole, trees = _restored(data)
                    out = {"part": [], "entry": [], "place": [], "digit": [], "value": []}

                    def put(part, entry, place, value):
                        for digit, v in _digits(int(value)):
                            for name, x in zip(out, (part, entry, place, digit, v)):
                                out[name].append(x)

                    for p, tree in enumerate(trees):
                        _, sums, counts, _ = assign(whole[:, p], tree, now[p])
                        for e, n in enumerate(counts):
                            if n:
                                put(p, e, -1, n)
                                for place, x in enumerate(sums[e]):
                                    put(p, e, place, x)
                    yield pa.RecordBatch.from_pydict({
                        n: pa.array(v, pa.int64() if n == "value" else pa.int32()) for n, v in out.items()})

        found = blocks.select("block").mapInArrow(work, "part int, entry int, place int, digit int, value long") \
            .groupBy("part", "entry", "place", "digit").agg(F.sum("value").alias("value"))
        total: dict[tuple, int] = {}
        for r in found.collect():  # entries times components, whatever the number of vectors
            key = (r["part"], r["entry"], r["place"])
            total[key] = total.get(key, 0) + (r["value"] << (_DIGIT * r["digit"]) if r["value"] >= 0
                                              else -(-r["value"] << (_DIGIT * r["digit"])))
        books = [_narrow([[total.get((p, e, i), 0) // total[p, e, -1] for i in range(len(old))]
                          if (p, e, -1) in total else [int(x) for x in old]
                          for e, old in enumerate(book)], book.shape[1]) for p, book in enumerate(now)]
    return books


def _narrow(entries: list[list[int]], width: int) -> np.ndarray:
    wide = any(abs(x) >= _WIDE for e in entries for x in e)
    out = np.zeros((len(entries), width), object if wide else np.int64)
    for i, e in enumerate(entries):
        out[i, :] = e
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Learn the codebooks and code every vector that takes part.

    A codebook starts as its part of the first ``entries`` vectors by id
    (nulls last, then the vector; fewer if there are fewer).  Vectors that are
    null or hold a null or a value that isn't finite take no part, nor do
    those whose length isn't that of the first vector.  A length that the
    parts don't divide is filled up with zeros.  Repeated rows are coded
    alike.  ``error`` is the sum of squared distances, null if beyond a long;
    ``code`` two hex digits a part.  Input columns of these two names are
    replaced; all others but the vector are kept.  An empty table gives no rows and empty books.
    """
    if entries > 256:
        raise ValueError("an entry is two hex digits")
    kept = vectors.where(complete(F.col(f"`{vector}`")))
    start = kept.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").alias("v")) \
        .orderBy(F.col("id").asc_nulls_last(), "v")
    lead = start.limit(1).collect()
    size = len(lead[0]["v"]) if lead else 0
    kept = kept.where(F.size(F.col(f"`{vector}`")) == size)
    seeds = start.where(F.size("v") == size).limit(entries).collect()
    shaped = cut(whole_numbers(np.array([r["v"] for r in seeds], np.float64).reshape(len(seeds), size), scale), parts)
    books = [shaped[:, p] for p in range(parts)]
    blocks = write_table(_blocks(spread(kept), vector, size, parts, scale), "blocks")
    books = learn(blocks, books, rounds if seeds and size else 0)
    rows = _code(blocks, books)
    names = [c for c in vectors.columns if c not in (vector, "code", "error")]
    return Codes(rows.select(*[F.col("row")[c].alias(c) for c in names], "code", "error"),
                 [[[int(x) for x in e] for e in book] for book in books])


def _code(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    def work(batches):
        for batch in batches:
            for data, rows in zip(batch["block"].to_pylist(), batch["rows"]):
                whole, trees = _restored(data)
                error = np.zeros(len(whole), object if any(b.dtype == object for b in books) else whole.dtype)
                codes = np.zeros((len(whole), len(trees)), np.uint8)
                for p, tree in enumerate(trees):
                    entry, _, _, _ = assign(whole[:, p], tree, books[p])
                    codes[:, p] = entry
                    if whole.shape[2]:
                        error = error + ((whole[:, p] - books[p][entry]) ** 2).sum(1)
                texts = [c.tobytes().hex() for c in codes]
                fits = [int(e) if e < 1 << 63 else None for e in error]
                yield pa.record_batch([rows.values, pa.array(texts, pa.string()), pa.array(fits, pa.int64())],
                                      ["row", "code", "error"])

    schema = T.StructType().add("row", blocks.schema["rows"].dataType.elementType) \
        .add("code", T.StringType()).add("error", T.LongType())
    return blocks.mapInArrow(work, schema)


def with_group_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``: the errors of its label's rows summed,
    nulls together; null if a row's error is, or if beyond a long.

    The coded rows are read twice and written for it; the sums combine before
    they are shuffled."""
    coded = write_table(coded, "coded")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = (F.count("error") == F.count(F.lit(1))) & (total < F.lit(str(1 << 63)).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col(f"`{label}`").alias("_hc_label")).agg(
        F.when(whole, total).cast("long").alias("label_error"))
    kept = coded.drop("label_error")
    return kept.join(sums, kept[f"`{label}`"].eqNullSafe(sums["_hc_label"])).drop("_hc_label")
