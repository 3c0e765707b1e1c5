"""Removal of long passages that an earlier document already holds.

Method: suffix automata of reference shards; documents are streamed through
them for matching statistics, and maximal spans of at least ``window`` words
are removed.  The corpus is its own reference here, so the reference grows with
the input and has no size bound to broadcast under.  Its shards therefore
travel to the tasks by a shuffle instead, and hold only text that can match:

1. Every window of 13 words has a seed, the smallest hash of its 6-word runs.
   Two documents that share a window share its seed.  Seeds are counted per
   document group, merged in the task before they are sent.
2. A group sends the pieces of its documents around seeds that occur more than
   once, each different piece once.  All pieces of a seed meet in one shard; a
   seed of many documents is dealt by single window instead, so that no shard
   receives a hot passage with all its surroundings.
3. A shard streams its pieces in document order through a suffix automaton of
   the pieces of smaller documents.  Where the matched length reaches 13 words
   the window is marked.
4. The groups cut the marked windows out of their documents.

Nothing is capped or sampled: equal pieces are merged, never dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holecard.llm import columnar as C
from holecard.llm.packed import blobs, bucket_count, runs, text_bytes, unblob
from holecard.session import checkpoint_stage

WINDOW = 13
SEED_WORDS = 6
#: Most windows of one piece, one bit each in the shard's answer.
PIECE_WINDOWS = 8
#: A seed of so many documents is dealt by window.
HOT_DOCUMENTS = 256
#: Entries that a task gathers before it sends them.
FLUSH = 4 << 20
#: The place of documents without an id: after all others.
NO_ID = np.iinfo(np.int64).max

_U = np.uint64
_GROUP, _ID = "_hc_group", "_hc_id"


class SuffixAutomaton:
    """Suffix automaton over word sequences, grown passage by passage."""

    def __init__(self) -> None:
        self._next: list[dict[int, int]] = [{}]
        self._link = [-1]
        self._length = [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self._next.append(moves)
        self._link.append(link)
        self._length.append(length)
        return len(self._next) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state that ``at`` reaches by ``word`` with just one word more."""
        longer = self._length[at] + 1
        if self._length[target] == longer:
            return target
        copy = self._state(longer, dict(self._next[target]), self._link[target])
        self._link[target] = copy
        while at >= 0 and self._next[at].get(word) == target:
            self._next[at][word] = copy
            at = self._link[at]
        return copy

    def add(self, words: list[int]) -> None:
        """Take in a passage; no match runs over its edges."""
        last = 0
        for word in words:
            known = self._next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state(self._length[last] + 1, {}, 0)
            at = last
            while at >= 0 and word not in self._next[at]:
                self._next[at][word] = new
                at = self._link[at]
            if at >= 0:
                self._link[new] = self._split(at, word, self._next[at][word])
            last = new

    def matches(self, words: list[int]) -> list[int]:
        """Matching statistics: the longest match that ends at each word."""
        nxt, link, length = self._next, self._link, self._length
        at, size, out = 0, 0, []
        for word in words:
            while at and word not in nxt[at]:
                at = link[at]
                size = length[at]
            if word in nxt[at]:
                at = nxt[at][word]
                size += 1
            else:
                size = 0
            out.append(size)
        return out


class _Text:
    """Words, window seeds and word codes of a slice of texts."""

    def __init__(self, buf, offs, window: int, seed: int):
        self.spans = C.spans(buf, offs)
        h = C.span_hashes(buf, self.spans)
        self.owner = self.spans.owner()
        self.codes = h >> _U(24)  # 40 bits of every word travel
        self.valid = C.whole_windows(self.owner, window)
        low = C.ngram_hashes(h, seed)
        left = window - seed + 1
        while left > 1:  # the smallest of `window - seed + 1` neighbours
            step = max(1, left // 2)
            low = np.minimum(low[:len(low) - step], low[step:]) if len(low) > step else low[:0]
            left -= step
        self.seeds = low

    def seed_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of each run with one seed."""
        v, s = self.valid, self.seeds
        new = v.copy()
        new[1:] &= ~(v[:-1] & (s[1:] == s[:-1]))
        cut = np.append(np.flatnonzero(new | ~v), len(v))
        first = np.flatnonzero(new)
        return first, cut[np.searchsorted(cut, first) + 1] - first


def _identity(seeds: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of a seed."""
    return ((seeds & _U(0xFFFFFFFF)) % _U(buckets)) << _U(32) | seeds >> _U(32)


def _piece_hash(codes: np.ndarray, starts: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Hash of the words of pieces: of their first and last windows, which
    together cover them."""
    w = C.ngram_hashes(codes, window)
    return C.mix(w[starts] * _U(3) + w[starts + n - 1] * _U(5) + n.astype(_U))


def _pieces(text: _Text, ids: np.ndarray, hot: np.ndarray, buckets: int, window: int):
    """Start, windows and bucket of the pieces around shared seeds."""
    first, n = text.seed_runs()
    seeds = text.seeds[first]
    ident = _identity(seeds, buckets)
    at = np.minimum(np.searchsorted(ids, ident), max(len(ids) - 1, 0))
    shared = ids[at] == ident if len(ids) else np.zeros(len(first), bool)
    first, n, seeds, at = first[shared], n[shared], seeds[shared], at[shared]
    most = np.where(hot[at], 1, PIECE_WINDOWS) if len(ids) else n
    parts = -(-n // most)
    run = np.repeat(np.arange(len(n)), parts)
    k = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = first[run] + k * most[run]
    size = np.minimum(most[run], n[run] - k * most[run])
    alone = hot[at][run] if len(ids) else np.zeros(0, bool)
    windows = C.ngram_hashes(text.codes, window)
    key = np.where(alone, windows[start], C.mix(seeds[run])) if len(start) else np.zeros(0, _U)
    return start, size, (key % _U(buckets)).astype(np.int64)


def _rows(bounds, columns: dict, **fixed) -> pa.RecordBatch:
    """A row per run: the fixed values of its first entry and its entries as blobs."""
    at = bounds[:-1]
    arrays = {k: pa.array(v[at]) for k, v in fixed.items()}
    arrays |= {k: blobs(bounds, v) for k, v in columns.items()}
    return pa.RecordBatch.from_pydict(arrays)


def _id_array(column) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID) if column.null_count else column).astype(np.int64)


def dedup_spans(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS,
                hot_documents: int = HOT_DOCUMENTS, buckets: int | None = None) -> DataFrame:
    """``docs`` with each word removed that lies in a window of ``window``
    consecutive words which also starts in a document with a smaller doc_id.

    Returns the columns of ``docs`` with ``text`` as the kept words joined by
    one space, ``n_words`` before and ``n_removed`` (long).  Columns of these
    two names in the input are replaced.  Windows are judged on the input.

    Words are runs of bytes other than U+0020 and U+0009 to U+000D, unchanged.
    A null text has no words and becomes an empty text.  A null doc_id counts
    as larger than all others.  Rows that repeat a doc_id never judge each
    other.  Texts of fewer words than a window stay.  Words are compared by 40
    bits of a 64-bit hash, 13 in a row.
    """
    docs = docs.drop("n_words", "n_removed")
    buckets = buckets or bucket_count(text_bytes(docs))
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int")
    docs = docs.withColumn(_GROUP, number)

    def count_seeds(batches):
        """Seeds of a task's documents with the groups that hold them."""
        seeds, groups, have = [], [], 0

        def flush():
            ident = _identity(np.concatenate(seeds), buckets)
            where = np.concatenate(groups)
            order = np.lexsort((where, ident))
            ident, where = ident[order], where[order]
            cut = runs(ident * _U(1 << 20) + where.astype(_U))
            n = np.minimum(np.diff(cut), 255).astype(np.uint8)
            ident, where = ident[cut[:-1]], where[cut[:-1]]
            bucket = (ident >> _U(32)).astype(np.int32)
            return _rows(runs(bucket), {"seeds": ident.astype(np.uint32), "groups": where.astype(np.uint32),
                                        "counts": n}, bucket=bucket)

        for batch in batches:
            group = np.asarray(batch.column(1))
            for i, j, buf, offs in C.text_slices(batch.column(0)):
                text = _Text(buf, offs, window, seed_words)
                first, _ = text.seed_runs()
                seeds.append(text.seeds[first])
                groups.append(group[i:j][text.owner[first]])
                have += len(first)
                if have > FLUSH:
                    yield flush()
                    seeds, groups, have = [], [], 0
        if have:
            yield flush()

    def shared_seeds(table):
        """The seeds of a bucket that occur more than once, for each group that holds them."""
        seed, per = unblob(table["seeds"], np.uint32)
        group, _ = unblob(table["groups"], np.uint32)
        n, _ = unblob(table["counts"], np.uint8)
        bucket = table["bucket"][0].as_py()
        order = np.argsort(seed, kind="stable")
        seed, group, n = seed[order], group[order], n[order]
        cut = runs(seed)
        total = np.add.reduceat(n.astype(np.int64), cut[:-1])
        total = np.repeat(total, np.diff(cut))
        keep = total >= 2
        seed, group, hot = seed[keep], group[keep], (total[keep] >= hot_documents).astype(np.uint8)
        order = np.lexsort((seed, group))
        seed, group, hot = seed[order], group[order], hot[order]
        one = runs(group.astype(_U) << _U(32) | seed.astype(_U))[:-1]
        seed, group, hot = seed[one], group[one], hot[one]
        out = _rows(runs(group), {"a": seed, "b": hot}, **{_GROUP: group.astype(np.int32)})
        return pa.Table.from_batches([out]).append_column("bucket", pa.array([bucket] * len(out), pa.int32())) \
            .append_column("kind", pa.array([0] * len(out), pa.int32())).append_column(
                "c", pa.array([b""] * len(out), pa.binary())).select(answer_names)

    def known_seeds(answers):
        """Identities of the shared seeds of a group, sorted, and which are hot."""
        answers = answers.filter(pa.compute.equal(answers["kind"], 0))
        low, per = unblob(answers["a"], np.uint32)
        hot, _ = unblob(answers["b"], np.uint8)
        ident = np.repeat(np.asarray(answers["bucket"]).astype(_U), per) << _U(32) | low.astype(_U)
        order = np.argsort(ident)
        return ident[order], hot[order].astype(bool)

    def send_pieces(key, table, answers):
        """Each different piece of a group's documents once, with the smallest document that holds it."""
        ids, hot = known_seeds(answers)
        doc_ids = _id_array(table["doc_id"].combine_chunks())
        found = []
        for i, j, buf, offs in C.text_slices(table["text"]):
            text = _Text(buf, offs, window, seed_words)
            start, n, bucket = _pieces(text, ids, hot, buckets, window)
            if len(start):
                words = text.codes[C.gather(start, n + window - 1)]
                found.append((_piece_hash(text.codes, start, n, window), n, bucket,
                              doc_ids[i:j][text.owner[start]], words))
        if not found:
            return empty_pieces
        h, n, bucket, doc, words = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((doc, h))
        cut = runs(h[order])
        one, last = order[cut[:-1]], order[cut[1:] - 1]
        several = doc[one] != doc[last]
        keep = np.argsort(bucket[one], kind="stable")
        one, several = one[keep], several[keep]
        size = n + window - 1
        first = np.cumsum(size) - size
        words = words[C.gather(first[one], size[one])]
        to = bucket[one].astype(np.int32)
        bounds = runs(to)
        in_words = np.concatenate([[0], np.cumsum(size[one])])[bounds]
        batch = _rows(bounds, {"n": n[one].astype(np.uint8), "docs": doc[one], "several": several}, bucket=to)
        out = pa.Table.from_batches([batch])
        out = out.append_column("low", blobs(in_words, words.astype(np.uint32)))
        out = out.append_column("high", blobs(in_words, (words >> _U(32)).astype(np.uint8)))
        return out.append_column(_GROUP, pa.array([key[0].as_py()] * len(out), pa.int32())).select(piece_names)

    def judge(table):
        """One shard: which windows of the pieces lie in smaller documents."""
        n, per = unblob(table["n"], np.uint8)
        n = n.astype(np.int64)
        doc, _ = unblob(table["docs"], np.int64)
        several, _ = unblob(table["several"], np.uint8)
        low, _ = unblob(table["low"], np.uint32)
        high, _ = unblob(table["high"], np.uint8)
        codes = low.astype(_U) | high.astype(_U) << _U(32)
        group = np.repeat(np.asarray(table[_GROUP]), per)
        size = n + window - 1
        first = np.cumsum(size) - size
        h = _piece_hash(codes, first, n, window)
        order = np.lexsort((doc, h))
        cut = runs(h[order])
        one, last = order[cut[:-1]], order[cut[1:] - 1]
        shared = (doc[one] != doc[last]) | np.bitwise_or.reduceat(several[order], cut[:-1]).astype(bool)
        mask = np.zeros(len(one), np.uint8)
        # a piece can only match another that has one of its windows
        windows = C.ngram_hashes(codes, window)[C.gather(first[one], n[one])]
        _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
        edge = np.concatenate([[0], np.cumsum(n[one])[:-1]])
        meets = np.flatnonzero(np.maximum.reduceat(times[where], edge) > 1)
        meets = meets[np.argsort(doc[one[meets]], kind="stable")]
        automaton = SuffixAutomaton()
        same = runs(doc[one[meets]])
        for x, y in zip(same[:-1], same[1:]):
            texts = [codes[first[one[k]]:first[one[k]] + size[one[k]]].tolist() for k in meets[x:y]]
            for k, words in zip(meets[x:y], texts):
                for i, longest in enumerate(automaton.matches(words)[window - 1:]):
                    if longest >= window:
                        mask[k] |= 1 << i
            for words in texts:
                automaton.add(words)
        told = shared | (mask > 0)
        piece = np.repeat(np.arange(len(one)), np.diff(cut))
        tell = told[piece]
        piece, group = piece[tell], group[order][tell]
        by = np.lexsort((piece, group))
        piece, group = piece[by], group[by]
        keep = runs(group.astype(_U) << _U(40) | piece.astype(_U))[:-1] if len(piece) else piece
        piece, group = piece[keep], group[keep]
        out = _rows(runs(group), {"a": h[one[piece]], "b": mask[piece], "c": doc[one[piece]]},
                    **{_GROUP: group.astype(np.int32)})
        return pa.Table.from_batches([out]).append_column("bucket", pa.array([0] * len(out), pa.int32())) \
            .append_column("kind", pa.array([1] * len(out), pa.int32())).select(answer_names)

    def cut_out(table, answers):
        """The group's documents without the marked windows."""
        ids, hot = known_seeds(answers)
        told = answers.filter(pa.compute.equal(answers["kind"], 1))
        known, _ = unblob(told["a"], _U)
        marks, _ = unblob(told["b"], np.uint8)
        owners, _ = unblob(told["c"], np.int64)
        order = np.argsort(known)
        known, marks, owners = known[order], marks[order], owners[order]
        doc_ids = _id_array(table["doc_id"].combine_chunks())
        kept, words, removed = [], [], []
        for i, j, buf, offs in C.text_slices(table["text"]):
            text = _Text(buf, offs, window, seed_words)
            gone = np.zeros(len(text.owner) + 1, np.int64)
            start, n, _ = _pieces(text, ids, hot, buckets, window)
            if len(start) and len(known):
                h = _piece_hash(text.codes, start, n, window)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                doc = doc_ids[i:j][text.owner[start]]
                hit = known[at] == h
                full = np.where(hit & (doc > owners[at]), 255, 0)
                part = np.where(hit & (doc == owners[at]), marks[at], 0)
                bits = full | part
                for k in range(PIECE_WINDOWS):
                    w = start[(k < n) & (bits >> k & 1 > 0)] + k
                    np.add.at(gone, w, 1)
                    np.add.at(gone, w + window, -1)
            stays = np.cumsum(gone[:-1]) == 0
            kept.append(C.joined_words(buf, text.spans, stays))
            words.append(np.diff(text.spans.first))
            removed.append(C.per_text(~stays, text.spans.first))
        out = table.drop_columns([_GROUP])
        at = out.schema.get_field_index("text")
        new = pa.chunked_array(kept, pa.large_string()).cast(pa.string()) if kept else pa.array([], pa.string())
        out = out.set_column(at, "text", new)
        whole = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
        return out.append_column("n_words", whole(words)).append_column("n_removed", whole(removed))

    answer_names = [_GROUP, "kind", "bucket", "a", "b", "c"]
    answer = f"{_GROUP} int, kind int, bucket int, a binary, b binary, c binary"
    piece_names = ["bucket", _GROUP, "n", "docs", "several", "low", "high"]
    piece = f"bucket int, {_GROUP} int, n binary, docs binary, several binary, low binary, high binary"
    empty_pieces = pa.table({k: pa.array([], pa.int32() if k in ("bucket", _GROUP) else pa.binary())
                             for k in piece_names})
    seeds = docs.select("text", _GROUP).mapInArrow(
        lambda batches: C.releasing(count_seeds(batches)), "bucket int, seeds binary, groups binary, counts binary")
    seeds = checkpoint_stage(seeds.groupBy("bucket").applyInArrow(lambda table: C.release(shared_seeds(table)), answer))
    pieces = docs.groupBy(_GROUP).cogroup(seeds.groupBy(_GROUP)).applyInArrow(
        lambda key, left, right: C.release(send_pieces(key, left, right)), piece)
    marks = pieces.groupBy("bucket").applyInArrow(lambda table: C.release(judge(table)), answer)
    out = T.StructType([f for f in docs.schema.fields if f.name != _GROUP])
    out = out.add("n_words", T.LongType()).add("n_removed", T.LongType())
    return docs.groupBy(_GROUP).cogroup(seeds.unionByName(marks).groupBy(_GROUP)).applyInArrow(
        lambda table, answers: C.release(cut_out(table, answers)), out)
