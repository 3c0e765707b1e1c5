"""Exact Jaccard self-join over word shingles.

Method: token-combination prefixes.  The tokens (shingles) of a document are
put into one global order, rare ones first; the class of a token follows from
the corpus frequency of its rarest word, which bounds the token's own.

* A rare token (some word of it occurs less than RARE_BELOW allows) is indexed
  alone, if it is among the first ``n - ceil(t n) + 1`` tokens.  Two sets with
  Jaccard >= t share a token of these prefixes.
* A document with fewer rare tokens than that may share frequent tokens only.
  Its prefix is extended to ``2 D + 2`` frequent tokens, ``D = floor(n (1 - t)
  / t)``, and each pair of neighbours in the order is indexed.  Two such sets
  differ in at most D tokens, so of the first D + 1 gaps between shared tokens
  one has no other token in it, in neither set, and lies in that prefix.

Documents with equal sets are one class from the start.  Entries of a posting
list that pass the bounds on size and on bucketed counts are candidates; lists
give candidate clusters, and within a cluster the full sets are verified.  Of
large clusters first those sets go that share too few tokens with the others of
like size, whichever these are, to be similar to any: long sets meet by chance,
and their clusters grow with the corpus.  What stays is split into bands of
sizes, so wide that similar sets are in one or in neighbouring bands, bands into
blocks of bounded size, and blocks that may hold similar sets are paired.  Texts are hashed once; what travels to the pairs
are shingle hashes.  So no pair of a group is ever a row, and a verified link is
never lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holecard.llm import columnar as C
from holecard.llm.components import components, forest
from holecard.llm.packed import BUCKET_BYTES, LEAST_BUCKETS, blobs, bucket_count, runs, text_bytes, unblob
from holecard.session import shuffles_freed, write_table

SHINGLE = 3
THRESHOLD = 90
#: Bound of the table of word counts that is broadcast (16 bytes a word), and
#: the least count that it holds where the bound leaves room.
COUNTED_WORDS = 1 << 20
LEAST_COUNT = 8
#: Bytes of text for each occurrence that a rare token's word may have.
RARE_BELOW = 1 << 21
#: Counters of a posting's sketch: |x - y| of them never exceeds the sets' difference.
SKETCH = 16
#: Posting lists up to this length are filtered pair by pair inside their task.
LIST_PAIRS = 4096
#: Sets of a verification block, and bytes of their hashes.  A set travels once
#: for every block that it may meet, so blocks are as large as a task can hold.
BLOCK = 1024
BLOCK_BYTES = 4 << 20
#: Sets (to the left; 4 times as many to the right) and hashes of one matrix.
PART, PART_HASHES = 96, 1 << 18
#: Values of a verification matrix.
MATRIX = 1 << 22
#: 64-bit words of the bitmap that tells which texts may be needed again, the
#: bound of its broadcast (16 bytes a word).
BITMAP_WORDS = 1 << 19
FLUSH = 4 << 20

_U = np.uint64
_NONE = np.iinfo(np.int64).max


class _Sets:
    """Shingle sets of a slice of texts: ``hashes[at[d]:at[d + 1]]``, sorted."""

    def __init__(self, buf, offs, size: int, words: np.ndarray | None = None, counts=None):
        low = C.LOWER_ASCII[buf]
        sp = C.spans(low, offs)
        h = C.span_hashes(low, sp)
        n = np.diff(sp.first)
        grams = C.ngram_hashes(h, size)
        rarest = None
        if words is not None:
            at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
            freq = np.where(words[at] == h, counts[at], 0) if len(words) else np.zeros(len(h), np.int64)
            rarest = freq[:len(grams)].copy()
            for k in range(1, size):
                np.minimum(rarest, freq[k:k + len(grams)], out=rarest)
        self.hashes, self.rarest = [], []
        for d in range(len(n)):
            lo, hi = sp.first[d], sp.first[d + 1] - size + 1
            if n[d] >= size:
                if rarest is None:
                    self.hashes.append(np.unique(grams[lo:hi]))
                else:
                    s, one = np.unique(grams[lo:hi], return_index=True)
                    self.hashes.append(s)
                    self.rarest.append(rarest[lo:hi][one])
            else:  # the whole sequence is the only shingle
                whole = h[lo:lo + n[d]]
                self.hashes.append(C.mix(C.ngram_hashes(whole, n[d]) + _U(n[d])) if n[d] else whole)
                self.rarest.append(np.zeros(min(n[d], 1), np.int64))

    def nodes(self) -> list[int]:
        """An id of each set, as a signed 64-bit hash of its members and size."""
        return [xxhash.xxh3_64_intdigest(s.tobytes(), len(s)) - (1 << 63) for s in self.hashes]


def set_rows(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, node, hash)``; documents with equal sets have one
    node, and ``hash`` is that of the text."""
    def work(batches):
        for batch in batches:
            for i, j, buf, offs in C.text_slices(batch.column(1)):
                sets = _Sets(buf, offs, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.array([len(s) for s in sets.hashes], pa.int64()),
                     pa.array(sets.nodes(), pa.int64()), batch.column(2).slice(i, j - i)],
                    names=["doc_id", "n_shingles", "node", "hash"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash")) \
        .mapInArrow(lambda batches: C.releasing(work(batches)), "doc_id long, n_shingles long, node long, hash long")


def word_counts(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest words of the corpus (as hashes, sorted) with their counts.

    The least count is the smallest from LEAST_COUNT on, doubling, that at most
    COUNTED_WORDS words reach; each bucket reports how many do.
    """
    def count(batches):
        found, have = [], 0

        def merge():
            w, n = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(w)
            w, n = w[order], n[order]
            cut = runs(w)
            return w[cut[:-1]], np.add.reduceat(n, cut[:-1])

        for batch in batches:
            for _, _, buf, offs in C.text_slices(batch.column(0)):
                low = C.LOWER_ASCII[buf]
                w, n = np.unique(C.span_hashes(low, C.spans(low, offs)), return_counts=True)
                if len(w):
                    found.append((w, n))
                    have += len(w)
                if have > FLUSH:
                    found = [merge()]
                    have = len(found[0][0])
                    if have > FLUSH // 2:
                        yield from send(*found[0])
                        found, have = [], 0
        if found:
            yield from send(*merge())

    def send(w, n):
        bucket = (w % _U(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        w, n, bucket = w[order], np.minimum(n[order], 0xFFFFFFFF).astype(np.uint32), bucket[order]
        cut = runs(bucket)
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), blobs(cut, w), blobs(cut, n)],
                                         names=["bucket", "words", "counts"])

    def total(table):
        w, _ = unblob(table["words"], _U)
        n, _ = unblob(table["counts"], np.uint32)
        order = np.argsort(w)
        w, n = w[order], n[order].astype(np.int64)
        cut = runs(w)
        w, n = w[cut[:-1]], np.add.reduceat(n, cut[:-1]) if len(w) else n
        w, n = w[n >= LEAST_COUNT], n[n >= LEAST_COUNT]
        level = np.floor(np.log2(n / LEAST_COUNT)).astype(np.int64)
        order = np.argsort(level, kind="stable")
        cut = runs(level[order])
        return pa.table({"level": pa.array(level[order][cut[:-1]], pa.int64()),
                         "n": pa.array(np.diff(cut), pa.int64()),
                         "words": blobs(cut, w[order]), "counts": blobs(cut, n[order])})

    found = write_table(
        docs.select("text").mapInArrow(
            lambda batches: C.releasing(count(batches)), "bucket int, words binary, counts binary")
        .groupBy("bucket").applyInArrow(
            lambda table: C.release(total(table)), "level long, n long, words binary, counts binary"), "words")
    levels = sorted(((r.level, r.n) for r in found.groupBy("level").agg(F.sum("n").alias("n")).collect()), reverse=True)
    least, room = (levels[0][0] + 1 if levels else 0), COUNTED_WORDS
    for level, n in levels:
        if n > room:
            break
        least, room = level, room - n
    rows = found.where(F.col("level") >= least).select("words", "counts").collect()
    w = np.frombuffer(b"".join(r.words for r in rows), _U)
    n = np.frombuffer(b"".join(r.counts for r in rows), np.int64)
    order = np.argsort(w)
    return w[order], n[order]


def _sketch(hashes: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((hashes & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH),
                      255).astype(np.uint8)


def _keys(s: np.ndarray, rarest: np.ndarray, t: int, rare_below: int) -> np.ndarray:
    """What a set is indexed under: tokens ``s`` in the order of their rarest
    word's count, then of their hash; ``rare_below`` divides the classes."""
    n = len(s)
    slack = n * (100 - t) // t
    if not slack:  # a different set cannot be similar enough
        return s[:0]
    prefix = n - -(-t * n // 100) + 1
    order = np.lexsort((s, rarest))
    n_rare = int((rarest < rare_below).sum())
    if n_rare >= prefix:
        return s[order[:prefix]]
    rare, often = s[order[:n_rare]], s[order[n_rare:n_rare + 2 * slack + 2]]
    return np.concatenate([rare, C.mix(often[:-1] * _U(0x9E3779B97F4A7C15) + often[1:])])


def _near(size: np.ndarray, sketch: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a posting list that the sizes and sketches allow to be similar."""
    found = []
    m = len(size)
    step = max(1, (1 << 20) // max(m, 1))
    for i in range(0, m, step):
        a, b = size[i:i + step, None], size[None, :]
        ok = (100 * np.minimum(a, b) >= t * np.maximum(a, b)) \
            & (np.arange(m)[None, :] > np.arange(i, min(i + step, m))[:, None])
        x, y = np.nonzero(ok)
        x += i
        apart = np.abs(sketch[x] - sketch[y]).sum(axis=1)
        # the sets differ in at most the union's 100 - t hundredths; the union is at most min / t
        ok = t * apart <= (100 - t) * np.minimum(size[x], size[y])
        found.append((x[ok], y[ok]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2


def candidate_edges(docs: DataFrame, buckets: int, words, counts, rare_below: int, size: int,
                    t: int) -> DataFrame:
    """Edges ``(a, b)`` between nodes; similar sets are connected by them."""
    table = docs.sparkSession.sparkContext.broadcast((words, counts))

    def index(batches):
        words, counts = table.value
        seen: set[int] = set()
        parts, have = [], 0

        def flush():
            key, node, n, sketch = (np.concatenate(x) for x in zip(*parts))
            bucket = (C.mix(key) % _U(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cut = runs(bucket[order])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[order][cut[:-1]]), blobs(cut, key[order]), blobs(cut, node[order]),
                 blobs(cut, n[order]), blobs(cut * SKETCH, sketch[order].ravel())],
                names=["bucket", "keys", "nodes", "sizes", "sketches"])

        for batch in batches:
            for _, _, buf, offs in C.text_slices(batch.column(0)):
                sets = _Sets(buf, offs, size, words, counts)
                for s, rarest, node in zip(sets.hashes, sets.rarest, sets.nodes()):
                    if node in seen:  # an equal set of this task is in the index
                        continue
                    keys = _keys(s, rarest, t, rare_below)
                    if not len(keys):
                        continue
                    seen.add(node)
                    parts.append((keys, np.full(len(keys), node, np.int64),
                                  np.full(len(keys), len(s), np.uint32),
                                  np.broadcast_to(_sketch(s), (len(keys), SKETCH))))
                    have += len(keys)
                if have > FLUSH // 4:
                    yield flush()
                    parts, have = [], 0
        if have:
            yield flush()

    def link(tab):
        key, _ = unblob(tab["keys"], _U)
        node, _ = unblob(tab["nodes"], np.int64)
        n, _ = unblob(tab["sizes"], np.uint32)
        sketch = unblob(tab["sketches"], np.uint8)[0].reshape(-1, SKETCH)
        order = np.lexsort((node, key))
        cut = runs(key[order])
        cut = np.stack([cut[:-1], cut[1:]])[:, np.diff(cut) > 1]
        a, b = [], []
        for lo, hi in cut.T:
            at = order[lo:hi]
            at = at[runs(node[at])[:-1]]
            if len(at) < 2:
                continue
            if len(at) > LIST_PAIRS:  # a chain by size, cut where sizes are too far apart
                at = at[np.argsort(n[at], kind="stable")]
                small, large = n[at[:-1]].astype(np.int64), n[at[1:]].astype(np.int64)
                ok = 100 * small >= t * large
                a.append(node[at[:-1]][ok])
                b.append(node[at[1:]][ok])
                continue
            x, y = _near(n[at].astype(np.int64), sketch[at].astype(np.int16), t)
            if len(x) > 4 * len(at):
                roots = forest(x.tolist(), y.tolist())
                x, y = np.array(list(roots)), np.array(list(roots.values()))
            a.append(node[at[x]])
            b.append(node[at[y]])
        if not a:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        roots = forest(np.concatenate(a).tolist(), np.concatenate(b).tolist())
        moved = [(x, y) for x, y in roots.items() if x != y]
        return pa.table({"a": pa.array([x for x, _ in moved], pa.int64()),
                         "b": pa.array([y for _, y in moved], pa.int64())})

    return docs.select("text").mapInArrow(
        lambda batches: C.releasing(index(batches)),
        "bucket int, keys binary, nodes binary, sizes binary, sketches binary") \
        .groupBy("bucket").applyInArrow(lambda table: C.release(link(table)), "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from 0/1 matrices over slices of the tokens."""
    both = left + right
    _, token = np.unique(np.concatenate(both), return_inverse=True)
    row = np.repeat(np.arange(len(both)), [len(s) for s in both])
    times = np.bincount(token)
    new = np.cumsum(times > 1) - 1  # tokens of one set never count
    keep = times[token] > 1
    token, row = new[token[keep]], row[keep]
    out = np.zeros((len(left), len(right)))
    width = max(1, MATRIX // len(both))
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    for lo in range(0, int(times[times > 1].size), width):
        x, y = np.searchsorted(token, [lo, lo + width])
        m = np.zeros((len(both), width), np.float32)
        m[row[x:y], token[x:y] - lo] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def band_width(t: int) -> float:
    """Logarithm of the largest ratio of sizes of a link, and a little more, so
    that rounding never puts two linked sets further than one band apart."""
    return math.log(100 / t) * 1.001 if t < 100 else 1.0


def _large():
    """Whether a cluster of ``m`` sets with ``hashes`` members is more than one block."""
    return (F.col("m") > BLOCK) | (F.col("hashes") * 8 > BLOCK_BYTES)


def block_places(members: DataFrame, t: int) -> DataFrame:
    """``members (cluster, node, n, ...)`` with ``mine``, a set's block, and
    ``others``, the blocks that it is paired with, its own included.

    A cluster of up to BLOCK sets and BLOCK_BYTES is one block.  In others a band
    of sizes has blocks of at most that, as a mean, and pairs are made inside a band and with the
    bands beside it.  The bands of a cluster are few, as the logarithm of sizes is.
    """
    band = F.floor(F.log(F.col("n")) / F.lit(band_width(t)))
    members = members.withColumn("band", band)
    bands = members.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("hashes")) \
        .withColumn("blocks", F.ceil(F.greatest(F.col("m") / F.lit(BLOCK), F.col("hashes") * 8 / F.lit(BLOCK_BYTES)))) \
        .groupBy(F.col("cluster").alias("of")).agg(
            F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("bands"),
            F.sum("m").alias("m"), F.sum("hashes").alias("hashes"))
    blocks = lambda b: F.coalesce(F.col("bands")[b], F.lit(0)).cast("long")
    block = lambda b, i: F.shiftleft(b, 32) + i
    one = ~_large()
    own = F.pmod(F.xxhash64("node"), F.greatest(blocks(F.col("band")), F.lit(1)))
    out = members.join(bands, members["cluster"] == bands["of"]) \
        .withColumn("mine", F.when(one, F.lit(0).cast("long")).otherwise(block(F.col("band"), own)))

    def all_of(b):
        found = F.transform(F.sequence(F.lit(0).cast("long"), blocks(b) - 1), lambda i: block(b, i))
        return F.when(blocks(b) > 0, found).otherwise(F.array().cast("array<bigint>"))

    near = F.concat(*(all_of(F.col("band") + k) for k in (-1, 0, 1)))
    return out.withColumn("others", F.when(one, F.array(F.lit(0).cast("long"))).otherwise(near)) \
        .drop("of", "bands", "m", "hashes", "band")


def maybe_needed(rows: DataFrame, needed: DataFrame, on: tuple, by: tuple) -> DataFrame:
    """``rows`` without most of those whose columns ``on`` are not ``by`` of some
    row of ``needed``, before a join shuffles them; none that is needed goes.

    A bitmap of the keys' hashes, at most BITMAP_WORDS words whatever the size
    of ``needed``, is joined by broadcast; the fuller it is the less it drops.
    """
    word = lambda cols: F.pmod(F.shiftright(F.xxhash64(*cols), 6), F.lit(BITMAP_WORDS))
    bit = lambda cols: F.expr(
        f"shiftleft(1L, CAST(xxhash64({', '.join(f'`{c}`' for c in cols)}) & 63 AS INT))")
    bitmap = needed.groupBy(word(by).alias("_hc_word")).agg(F.bit_or(bit(by)).alias("_hc_bits"))
    return rows.withColumn("_hc_word", word(on)).join(F.broadcast(bitmap), "_hc_word") \
        .where(F.col("_hc_bits").bitwiseAND(bit(on)) != 0).drop("_hc_word", "_hc_bits")


def _texts(docs: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """``(text, node, *columns)`` of ``members (rep, hash, node, ...)``: a text with that hash of a row
    with that doc_id."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("doc_id"), "text",
                        F.xxhash64("text").alias("text_hash"))
    texts = maybe_needed(texts, members, ("doc_id", "text_hash"), ("rep", "hash"))
    # of repeated rows one
    return texts.join(members, (texts["doc_id"] == members["rep"]) & (texts["text_hash"] == members["hash"])) \
        .groupBy("rep", "hash", "node").agg(*(F.first(c).alias(c) for c in ("text", *columns))) \
        .select("text", "node", *columns)


def _own_sets(batch, size: int):
    """The rows of a batch ``(text, node, ...)`` whose texts have that node, with their sets; slice by slice."""
    nodes = np.asarray(batch.column(1))
    for i, j, buf, offs in C.text_slices(batch.column(0)):
        found = _Sets(buf, offs, size)
        # not another text with this hash
        own = [k for k, this in enumerate(found.nodes()) if this == nodes[i + k]]
        if own:
            yield batch.take(pa.array([i + k for k in own])), [found.hashes[k] for k in own]


def linkable(docs: DataFrame, members: DataFrame, size: int, t: int) -> DataFrame:
    """``members`` without sets of large clusters that are similar to no other.

    A set that is similar to another shares ``t`` hundredths of its members, at
    least, with it, and so with all sets of like sizes of its cluster together.
    Those are counted by one exchange of the hashes, dealt by cluster and hash.
    """
    large = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("hashes")) \
        .where(_large()).select(F.col("cluster").alias("of"))
    asked = write_table(members.join(large, members["cluster"] == large["of"], "left_semi"), "asked")
    sent = asked.agg(F.sum(F.col("n") * 20)).first()[0]
    if not sent:
        return members
    shards = max(LEAST_BUCKETS, -(-sent // (BUCKET_BYTES // 2)))

    def deal(batches):
        parts, have = [], 0

        def flush():
            key, node, n = (np.concatenate(x) for x in zip(*parts))
            shard = (C.mix(key) % _U(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cut = runs(shard[order])
            return pa.RecordBatch.from_arrays(
                [pa.array(shard[order][cut[:-1]]), blobs(cut, key[order]), blobs(cut, node[order]), blobs(cut, n[order])],
                names=["shard", "keys", "nodes", "sizes"])

        for batch in batches:
            for rows, sets in _own_sets(batch, size):
                cluster = C.mix(np.asarray(rows.column(2)).astype(_U))
                for s, node, of in zip(sets, np.asarray(rows.column(1)), cluster):
                    parts.append((C.mix(s + of), np.full(len(s), node, np.int64), np.full(len(s), len(s), np.uint32)))
                    have += len(s)
                if have > FLUSH // 4:
                    yield flush()
                    parts, have = [], 0
        if have:
            yield flush()

    def count(tab):
        key, _ = unblob(tab["keys"], _U)
        node, _ = unblob(tab["nodes"], np.int64)
        n = unblob(tab["sizes"], np.uint32)[0].astype(np.int64)
        order = np.lexsort((n, key))
        key, node, n = key[order], node[order], n[order]
        # of the sets with a token those of the nearest sizes
        meet = (key[1:] == key[:-1]) & (100 * n[:-1] >= t * n[1:])
        shared = np.zeros(len(key), bool)
        shared[1:] |= meet
        shared[:-1] |= meet
        node, times = np.unique(node[shared], return_counts=True)
        return pa.table({"of": pa.array(node, pa.int64()), "shared": pa.array(times, pa.int64())})

    shared = _texts(docs, asked, "cluster").mapInArrow(
        lambda batches: C.releasing(deal(batches)), "shard int, keys binary, nodes binary, sizes binary") \
        .groupBy("shard").applyInArrow(lambda table: C.release(count(table)), "of long, shared long") \
        .groupBy("of").agg(F.sum("shared").alias("shared"))
    alone = asked.join(shared, asked["node"] == shared["of"], "left") \
        .where(100 * F.coalesce("shared", F.lit(0)) < t * F.col("n")).select(F.col("node").alias("_hc_of"))
    alone = write_table(alone, "alone")
    return members.join(alone, members["node"] == alone["_hc_of"], "left_anti")


def verified_edges(docs: DataFrame, members: DataFrame, least_shards: int, size: int, t: int) -> DataFrame:
    """Links ``(a, b)`` between nodes, a spanning forest per task.

    ``members (rep, hash, node, n, cluster)``: the sets of a cluster, their
    sizes, and the doc_id and the text's hash of a row that has the set; a
    doc_id alone may be null or repeated.  Every text is hashed once; its
    shingle hashes go to each pair of blocks that its own block is in, at least
    ``least_shards`` shards and one for every two BLOCK_BYTES that they come to.
    """
    placed = write_table(block_places(members, t), "places")
    sent = placed.agg(F.sum(F.col("n") * 8 * F.size("others"))).first()[0] or 0
    shards = max(least_shards, -(-sent // (2 * BLOCK_BYTES)))

    def tokens(batches):
        for batch in batches:
            for rows, sets in _own_sets(batch, size):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "cluster", "mine", "others", "tokens"])

    sets = _texts(docs, placed, "cluster", "mine", "others").mapInArrow(
        lambda batches: C.releasing(tokens(batches)),
        "node long, cluster long, mine long, others array<bigint>, tokens binary")
    sets = sets.select("node", "cluster", "mine", "tokens", F.explode("others").alias("other"))
    sets = sets.select("node", "cluster", "mine", "tokens",
                       F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")) \
        .withColumn("shard", F.pmod(F.xxhash64("cluster", "x", "y"), F.lit(shards)).cast("long"))

    def verify(tab):
        cluster, x, y, mine, node = (np.asarray(tab[c]) for c in ("cluster", "x", "y", "mine", "node"))
        flat, n = unblob(tab["tokens"], _U)
        ends = np.cumsum(n)
        order = np.lexsort((node, y, x, cluster))
        cut = runs(C.mix(cluster[order].astype(_U)) + C.mix(x[order].astype(_U)) * _U(3) + y[order].astype(_U))
        a, b = [], []
        for lo, hi in zip(cut[:-1], cut[1:]):
            at = order[lo:hi]
            same = x[at[0]] == y[at[0]]
            side = np.ones(len(at), bool) if same else mine[at] == x[at[0]]
            left, right = at[side], at if same else at[~side]
            if not len(left) or not len(right):
                continue
            sets = {k: flat[ends[k] - n[k]:ends[k]] for k in at}
            step = max(1, min(PART, PART_HASHES // int(n[at].max())))
            for lo_l in range(0, len(left), step):
                own = left[lo_l:lo_l + step]
                for lo_r in range(lo_l if same else 0, len(right), 4 * step):
                    part = right[lo_r:lo_r + 4 * step]
                    both = _overlaps([sets[k] for k in own], [sets[k] for k in part])
                    union = n[own][:, None] + n[part][None, :] - both
                    i, j = np.nonzero(100 * both >= t * union)
                    differs = node[own[i]] != node[part[j]]
                    a.append(node[own[i]][differs])
                    b.append(node[part[j]][differs])
        roots = forest(np.concatenate(a).tolist(), np.concatenate(b).tolist()) if a else {}
        moved = [(p, q) for p, q in roots.items() if p != q]
        return pa.table({"a": pa.array([p for p, _ in moved], pa.int64()),
                         "b": pa.array([q for _, q in moved], pa.int64())})

    return sets.groupBy("shard").applyInArrow(lambda table: C.release(verify(table)), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Words are runs of bytes other than U+0020 and U+0009 to U+000D, with A-Z
    lower-cased.  A document's set are its distinct shingles of ``shingle``
    words; with fewer words the whole sequence is its only shingle; without
    text or words the set is empty and linked with nothing.  Two documents
    link when ``100 |x & y| >= threshold |x | y|``; ``component_id`` is the
    smallest doc_id reachable by links, the document itself included.

    A null doc_id counts as larger than all others, and is a component_id only
    where no other id is reachable.  Repeated rows each get a row.  Shingles
    and sets are compared by 64-bit hashes.  ``threshold`` is 75 to
    100: below, small sets could lose links, as neighbours in the order need not be shared.
    """
    if not 75 <= threshold <= 100:
        raise ValueError(f"threshold {threshold} is not in 75 to 100")
    with shuffles_freed(docs.sparkSession):
        sets, reached = _reached(docs, shingle, threshold)
    out = sets.join(reached, (sets["node"] == reached["of"]) & (sets["n_shingles"] > 0), "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    known = lambda c: F.when(F.col(c) != F.lit(_NONE), F.col(c)).alias(c)
    return out.select(known("doc_id"), "n_shingles", known("component_id"))


def _reached(docs: DataFrame, shingle: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Tables of the sets of all rows, and of the ids that linked and repeated sets reach."""
    n_bytes = text_bytes(docs)
    buckets = bucket_count(n_bytes)
    sets = write_table(set_rows(docs, shingle)
                       .withColumn("doc_id", F.coalesce("doc_id", F.lit(_NONE))), "sets")
    classes = write_table(sets.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "hash")).alias("least"), F.min("n_shingles").alias("n"),
        F.count(F.lit(1)).alias("copies"))
        .select("node", F.col("least.doc_id").alias("rep"), F.col("least.hash").alias("hash"), "n", "copies"),
        "classes")
    words, counts = word_counts(docs, buckets)
    # as the table may begin above it, at least the table's least count
    rare_below = max(LEAST_COUNT, n_bytes // RARE_BELOW, int(counts.min(initial=0)))
    clusters = components(candidate_edges(docs, buckets, words, counts, rare_below, shingle, threshold))
    members = clusters.withColumnRenamed("id", "node").join(classes, "node") \
        .select("rep", "hash", "node", "n", F.col("component").alias("cluster"))
    members = linkable(docs, write_table(members, "members"), shingle, threshold)
    links = components(verified_edges(docs, members, 4 * buckets, shingle, threshold))
    # ids come in last: sets without an id, or with the same one, are no link
    linked = classes.join(links, classes["node"] == links["id"], "left") \
        .select("node", "rep", "copies", F.coalesce("component", "node").alias("root"),
                F.col("component").isNotNull().alias("linked"))
    # only classes of copies and linked ones differ from their own id
    linked = write_table(linked.where("copies > 1 OR linked"), "linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("component"))
    reached = write_table(linked.join(least, "root").select(F.col("node").alias("of"), "component"), "reached")
    return sets, reached
