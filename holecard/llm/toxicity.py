"""Toxicity by a subsequence string kernel.

Method: a support vector machine over the gap-weighted subsequence kernel of
four characters, with Nystroem landmarks.  Two strings are similar in the
four-character subsequences they share, each weighted by DECAY to the length
it spans, so gapped, inserted and changed characters only weaken a match.  The
instances are windows of a sentence's letters that cross its blanks: every run
of neighbouring units (words, or runs of single letters) with room in a row.
A text is held to its worst window, and so is its label.

The decision value is linear in subsequence weights, so the landmarks and the
machine fold into one table of them.  Scoring looks every subsequence of the
letters up once; the values of all windows are differences of running sums.
"""

from __future__ import annotations

import unicodedata

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holecard.llm import columnar as C

DECAY = 0.7
#: Farthest distance between the first and last character of a subsequence.
REACH = 5
#: Longer units are looked at in overlapping windows.
UNIT = 24
LANDMARKS = 128
#: Bounds of the labelled documents the machine is fitted on, and of their bytes.
FIT_TOXIC, FIT_CLEAN, FIT_BYTES = 1500, 3000, 1 << 16
#: Clean units of the first round, hardest ones added in each further round.
CLEAN_UNITS, HARD_UNITS = 8000, 3000
ROUNDS = 3
#: Log-likelihood gain from which a unit is known to belong to toxic texts.
PROOF = 9.0
#: Penalty of a violated margin.
COST = 2000.0
#: Weight of the prior on the score's slope and shift.
PRIOR = 0.1
#: Characters that a filter scores at a time; each takes some 100 bytes meanwhile.
SCORED_TOGETHER = 1 << 19
#: Decision value of a text without a unit.
NOTHING = -3.0

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BODY = UNIT - 2
#: Classes of letters: 1 to 26 and the edge mark, then hashed ones up to 65535.
_EDGE, _OTHER, _ALPHABET = 27, 28, 32
#: Code points from here on are no letters.
_CODES = 0x40000
#: Distances of the further characters of a subsequence from its first.
_STEPS = [(a, b, c) for c in range(3, REACH + 1) for b in range(2, c) for a in range(1, b)]
#: Subsequences of a-z and edges have places of their own, all others share hashed ones.
_PLAIN, _HASHED = _ALPHABET ** 4, 1 << 20
_SIZE = _PLAIN + _HASHED


def _classes() -> np.ndarray:
    """Code points to 1..26 (Latin letters without marks), 28 and more (other
    letters and digits, by a hash of their lower-case NFKC), 0 (no letter or digit)."""
    out = np.zeros(_CODES, np.uint16)
    for c in range(_CODES):
        ch = chr(c)
        if not ch.isalnum():
            continue
        base = unicodedata.normalize("NFKD", ch)[0].lower()
        if "a" <= base <= "z":
            out[c] = ord(base) - 96
        else:
            whole = unicodedata.normalize("NFKC", ch).lower().encode()
            out[c] = _OTHER + xxhash.xxh3_64_intdigest(whole) % ((1 << 16) - _OTHER)
    return out


_CLASSES = None


def units(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Character classes of all letters, and the units in them: first letter,
    number of letters, text and sentence.

    A unit is what a word has of letters and digits, so marks inside it are
    jumped over; neighbouring words of one letter make one unit.  Sentences end
    at ``.``, ``!``, ``?`` or a line's end.
    """
    global _CLASSES
    if _CLASSES is None:
        _CLASSES = _classes()
    codes, offs = C.code_points(texts)
    kind = _CLASSES[np.minimum(codes, _CODES - 1)]
    blank = (codes <= 32) & np.isin(codes, np.array([9, 10, 11, 12, 13, 32], np.uint32))
    at = np.flatnonzero(kind)
    word = np.cumsum(blank)[at]  # words have blanks between them
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(at) else at
    size = np.diff(np.append(first, len(at)))
    text = np.searchsorted(offs, at[first], side="right") - 1
    single = size == 1
    joins = np.zeros(len(first), bool)  # to the unit before it
    if len(first):
        near = word[first][1:] == word[first][:-1] + 1
        joins[1:] = single[1:] & single[:-1] & near & (text[1:] == text[:-1])
    first, text = first[~joins], text[~joins]
    size = np.diff(np.append(first, len(at)))
    ends = np.cumsum((codes == 46) | (codes == 33) | (codes == 63) | (codes == 10))
    sentence = ends[at[first]] if len(first) else first
    return kind[at], first, size, text, sentence


def rows_of(letters: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of units or windows, and whose they are.  Rows begin and end with an
    edge mark; a unit too long for a row has several."""
    body, step = _BODY, _BODY // 2
    parts = np.where(size > body, -(-(size - body) // step) + 1, 1)
    unit = np.repeat(np.arange(len(first)), parts)
    k = np.arange(len(unit)) - np.repeat(np.cumsum(parts) - parts, parts)
    lo, n = first[unit] + k * step, np.minimum(body, size[unit] - k * step)
    rows = np.zeros((len(unit), UNIT), np.uint16)
    inside = np.arange(body)[None, :] < n[:, None]
    rows[:, 1:-1][inside] = letters[C.gather(lo, n)] if len(unit) else 0
    opens, closes = k == 0, k == parts[unit] - 1
    rows[opens, 0] = _EDGE
    ended = np.flatnonzero(closes)
    rows[ended, n[ended] + 1] = _EDGE
    return rows, unit


def unit_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all units with their text and sentence."""
    letters, first, size, text, sentence = units(texts)
    rows, unit = rows_of(letters, first, size)
    return rows, text[unit], sentence[unit]


def windows(size: np.ndarray, text: np.ndarray, sentence: np.ndarray):
    """``(first unit, last unit, letters)`` of all runs of two units and more of
    a sentence that have room in a row, by their number of units."""
    i, n, k = np.arange(len(size)), size, 1
    while True:
        keep = i + k < len(size)
        i, n = i[keep], n[keep]
        j = i + k
        n = n + size[j]
        keep = (n <= _BODY) & (text[i] == text[j]) & (sentence[i] == sentence[j])
        i, n = i[keep], n[keep]
        if not len(i):
            return
        yield i, i + k, n
        k += 1


def _window_hashes(letters: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of the letters of every window."""
    base, back = (np.full(len(letters), b, _U) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(C.mix(letters.astype(_U)) * np.multiply.accumulate(base))])
    return C.mix((sums[lo + n] - sums[lo]) * np.multiply.accumulate(back)[lo] + n.astype(_U))


def _weights(rows: np.ndarray) -> np.ndarray:
    """Length of a row's feature vector, from its number of characters: repeated
    subsequences are counted apart."""
    return _lengths()[(rows > 0).sum(axis=1)]


def _lengths() -> np.ndarray:
    total = np.zeros(UNIT + 1)
    for _, _, c in _STEPS:
        total[c + 1:] += DECAY ** (2 * c) * np.arange(1, UNIT - c + 1)
    return np.sqrt(np.maximum(total, 1e-9))


def _places(w, x, y, z) -> np.ndarray:
    """Where the table has subsequences of four classes."""
    four = [np.minimum(k, _OTHER).astype(np.int32) for k in (w, x, y, z)]
    key = ((four[0] * _ALPHABET + four[1]) * _ALPHABET + four[2]) * _ALPHABET + four[3]
    if any(k.max(initial=0) >= _OTHER for k in four):
        other = np.nonzero((four[0] >= _OTHER) | (four[1] >= _OTHER) | (four[2] >= _OTHER) | (four[3] >= _OTHER))
        w, x, y, z = (np.broadcast_to(k, key.shape)[other].astype(_U) for k in (w, x, y, z))
        key[other] = _PLAIN + (C.mix(w << _U(48) | x << _U(32) | y << _U(16) | z) % _U(_HASHED)).astype(np.int32)
    return key


def features(rows: np.ndarray):
    """``(subsequence, weight)`` arrays of rows, one pair of columns after another."""
    for a, b, c in _STEPS:  # a row has no gaps, so the last character tells that all are there
        n = UNIT - c
        w, x, y, z = rows[:, :n], rows[:, a:n + a], rows[:, b:n + b], rows[:, c:]
        key = _places(w, x, y, z)
        yield np.where((w > 0) & (z > 0), key, 0), DECAY ** c


def decide(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The kernel machine's value of every row, without its bias."""
    out = np.zeros(len(rows))
    for key, weight in features(rows):
        out += weight * table[key].sum(axis=1)
    return out / _weights(rows)


def window_values(letters, first, size, text, sentence, table: np.ndarray):
    """``(first unit, last unit, letters, value)`` of all units and windows that
    have room in a row, as decide() has them; single units come first."""
    pad = np.zeros(REACH + 1, letters.dtype)
    own = np.concatenate([pad, letters, pad])  # letters[p] is own[p + len(pad)]
    lo, hi, edge = first + len(pad), first + size + len(pad), np.array(_EDGE, letters.dtype)
    sums = {c: np.zeros(len(own) + 1) for c in range(3, REACH + 1)}
    opens, closes = np.zeros((len(first), REACH + 1)), np.zeros((len(first), REACH + 1))
    for a, b, c in _STEPS:
        m = len(own) - c
        sums[c][1:m + 1] += DECAY ** c * table[_places(own[:m], own[a:m + a], own[b:m + b], own[c:])]
        opens[:, c] += DECAY ** c * table[_places(edge, own[lo + a - 1], own[lo + b - 1], own[lo + c - 1])]
        closes[:, c] += DECAY ** c * table[_places(own[hi - c], own[hi - c + a], own[hi - c + b], edge)]
    for c in sums:
        np.cumsum(sums[c], out=sums[c])
    np.cumsum(opens, axis=1, out=opens)
    np.cumsum(closes, axis=1, out=closes)
    lengths = _lengths()
    single = np.flatnonzero(size <= _BODY)

    def value(i, j, n):
        start, end, most = lo[i], hi[j], np.minimum(n, REACH)
        out = opens[i, most] + closes[j, most]
        for c, total in sums.items():
            out += total[np.maximum(end - c, start)] - total[start]
        short = np.flatnonzero(n < REACH)
        for a, b, c in _STEPS:
            at = short[n[short] == c - 1]
            if len(at):
                p = start[at]
                out[at] += DECAY ** c * table[_places(edge, own[p + a - 1], own[p + b - 1], edge)]
        return out / lengths[n + 2]

    yield single, single, size[single], value(single, single, size[single])
    for i, j, n in windows(size, text, sentence):
        yield i, j, n, value(i, j, n)


def _vector(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of one row and their normalised weights."""
    keys, weights = zip(*((key[0], np.full(key.shape[1], weight)) for key, weight in features(row[None, :])))
    keys, which = np.unique(np.concatenate(keys), return_inverse=True)
    weights = np.bincount(which, np.concatenate(weights)) / _weights(row[None, :])[0]
    return keys[keys > 0], weights[keys > 0]


class _Landmarks:
    """Feature vectors of landmarks over the subsequences that they hold."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.keys = np.unique(np.concatenate([k for k, _ in vectors]))
        self.place = np.zeros(_SIZE, np.int32)
        self.place[self.keys] = np.arange(1, len(self.keys) + 1)
        self.weights = np.zeros((len(self.keys) + 1, len(vectors)))
        for i, (k, w) in enumerate(vectors):
            self.weights[self.place[k], i] = w

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Kernel values of rows against the landmarks."""
        out = np.zeros((len(rows), self.weights.shape[1]))
        for lo in range(0, len(rows), 2048):
            for key, weight in features(rows[lo:lo + 2048]):
                at = self.place[key]
                for c in range(at.shape[1]):
                    out[lo:lo + 2048] += weight * self.weights[at[:, c]]
        return out / _weights(rows)[:, None]

    def fold(self, coefficients: np.ndarray) -> np.ndarray:
        """The weight of every subsequence in a combination of landmarks."""
        out = np.zeros(_SIZE)
        out[self.keys] = (self.weights @ coefficients)[1:]
        return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    keep = np.eye(a.shape[1])
    keep[-1, -1] = 1e-3  # next to no penalty on the bias
    for _ in range(30):
        gap = 1 - y * (a @ w)
        on = gap > 0
        own = a[on] * (cost * weight[on])[:, None]
        new = np.linalg.solve(keep + own.T @ a[on], own.T @ y[on])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the score, by Newton steps with a mild prior."""
    a = np.stack([x, np.ones(len(x))], axis=1)
    goal = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - goal) + PRIOR * w
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + PRIOR * np.eye(2), grad)
    return float(w[0]), float(w[1])


def _best(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Highest value of every owner's entries."""
    out = np.full(n, NOTHING)
    if len(values):
        top = np.full(n, -np.inf)
        np.maximum.at(top, owner, values)
        out = np.where(np.isfinite(top), np.maximum(top, NOTHING), NOTHING)
    return out


class Model:
    """Subsequence weights, bias, and slope and shift of the score."""

    def __init__(self, table: np.ndarray, bias: float, slope: float, shift: float):
        self.table, self.bias, self.slope, self.shift = table, bias, slope, shift

    def plain(self) -> tuple:
        return self.table.astype(np.float32), self.bias, self.slope, self.shift


def _worst(unit: np.ndarray, of: np.ndarray, value: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The unit of the highest value of each toxic text, -1 where there is none."""
    out = np.full(len(toxic), -1)
    value = value if len(value) == len(unit) else value[unit]
    best = np.lexsort((unit, -value, of))
    lead = best[np.concatenate([[True], of[best][1:] != of[best][:-1]])] if len(best) else best
    lead = lead[toxic[of[lead]]]
    out[of[lead]] = unit[lead]
    return out


def _proof(bad: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Log-likelihood gain of units in ``bad`` toxic and ``good`` clean texts, if
    they are well above the share of toxic texts."""
    with np.errstate(divide="ignore", invalid="ignore"):
        proof = np.nan_to_num(bad * np.log(bad / (share * (bad + good)))) \
            + np.nan_to_num(good * np.log(good / ((1 - share) * (bad + good))))
    proof[bad <= 2 * share / (1 - share) * good] = 0
    return proof


def _common_windows(parts, known, toxic: np.ndarray, least: int):
    """Windows of several units that at least ``least`` toxic texts hold: rows,
    numbers of toxic and of clean texts, and pairs of window and toxic text.
    Windows with a unit that is telling by itself (``known``) are left out."""
    def seen(bad: bool):
        for (letters, first, size, text, sentence), told in zip(parts, known):
            for i, j, n in windows(size, text, sentence):
                mine = (toxic[text[i]] == bad) & (told[j + 1] == told[i])
                i, n = i[mine], n[mine]
                h = _window_hashes(letters, first[i], n)
                one = np.unique(C.mix(h + C.mix(text[i].astype(_U))), return_index=True)[1]
                yield letters, first[i][one], n[one], text[i][one], h[one]

    hashes, times = np.unique(np.concatenate([np.zeros(0, _U), *(x[4] for x in seen(True))]), return_counts=True)
    hashes = hashes[times >= max(least, 2)]
    rows, bad, good = np.zeros((len(hashes), UNIT), np.uint16), *np.zeros((2, len(hashes)), np.int64)
    which, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for sign in (True, False) if len(hashes) else ():
        for letters, first, n, text, h in seen(sign):
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == h)
            np.add.at(bad if sign else good, at[hit], 1)
            if sign:
                rows[at[hit]] = rows_of(letters, first[hit], n[hit])[0]
                which.append(at[hit])
                of.append(text[hit])
    return rows, bad, good, (np.concatenate(which), np.concatenate(of))


def _high_windows(parts, known, toxic: np.ndarray, table: np.ndarray):
    """Rows, texts and values: of every toxic text without a telling unit the
    window of several units with the highest value, of the clean ones HARD_UNITS
    of the highest values."""
    out = []
    for (letters, first, size, text, sentence), told in zip(parts, known):
        sure = np.zeros(len(toxic), bool)
        sure[text[np.diff(told) > 0]] = True
        runs = [x for x in window_values(letters, first, size, text, sentence, table)][1:]
        if not runs:
            continue
        i, n, v = (np.concatenate([x[k] for x in runs]) for k in (0, 2, 3))
        order = np.lexsort((-v, text[i]))
        lead = order[np.concatenate([[True], text[i][order][1:] != text[i][order][:-1]])]
        lead = lead[(toxic & ~sure)[text[i[lead]]]]
        rest = np.flatnonzero(~toxic[text[i]])
        rest = rest[np.argsort(-v[rest], kind="stable")[:HARD_UNITS]]
        pick = np.concatenate([lead, rest])
        out.append((rows_of(letters, first[i[pick]], n[pick])[0], text[i[pick]], v[pick]))
    if not out:
        return np.zeros((0, UNIT), np.uint16), np.zeros(0, np.int64), np.zeros(0)
    rows, whose, v = (np.concatenate(x) for x in zip(*out))
    bad, rest = np.flatnonzero(toxic[whose]), np.flatnonzero(~toxic[whose])
    rest = rest[np.argsort(-v[rest], kind="stable")]
    rest = rest[np.sort(_distinct(rows[rest])[0])][:HARD_UNITS]
    pick = np.concatenate([bad, rest])
    return rows[pick], whose[pick], v[pick]


def train(texts: list[str], toxic: np.ndarray, landmarks: int = LANDMARKS, cost: float = COST) -> Model:
    """Fit on whole texts: every sentence has its text's label, and a toxic text
    is held to its worst unit or window, found anew in each round."""
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():  # one class: its prior
        sure = 4.0 if toxic.any() else -4.0
        return Model(np.zeros(_SIZE), 0.0, 0.0, sure)
    # a quarter is kept for the slope of the score
    apart = C.mix(np.arange(len(texts), dtype=np.uint64)) % np.uint64(4) == 0
    if not (toxic & apart).any() or not (toxic & ~apart).any() or not (~toxic & ~apart).any():
        apart[:] = False
    rest, known = [t for t, x in zip(texts, apart) if x], toxic[apart]
    texts, toxic = [t for t, x in zip(texts, apart) if not x], toxic[~apart]
    parts = []
    for lo in range(0, len(texts), 200):
        letters, at, size, of, sentence = units(texts[lo:lo + 200])
        parts.append((letters, *(x.astype(np.int32) for x in (at, size, of + lo, sentence))))
    flat, which, text, owner, n = [], [], [], [], 0
    for p in parts:  # equal rows of a part meet first, so all rows never lie side by side
        rows, unit = rows_of(*p[:3])
        first, own = _distinct(rows)
        flat.append(rows[first])
        which.append((own + n).astype(np.int32))
        text.append(p[3][unit].astype(np.int32))
        owner.append(unit.astype(np.int32))
        n += len(first)
    flat, text = np.concatenate(flat), np.concatenate(text)
    first, own = _distinct(flat)
    flat, which = flat[first], own.astype(np.int32)[np.concatenate(which)]
    del rows, unit, first, own
    # how many toxic and clean texts hold a unit, or a window that may be telling
    pair = np.unique(which.astype(np.int64) * len(texts) + text)
    unit, of = pair // len(texts), pair % len(texts)
    bad = np.bincount(unit[toxic[of]], minlength=len(flat))
    good = np.bincount(unit[~toxic[of]], minlength=len(flat))
    share = toxic.mean()
    proof = _proof(bad, good, share)
    marked, lo = [], 0  # running numbers of the telling units of each part
    for p, u in zip(parts, owner):
        told = np.zeros(len(p[1]), np.int64)
        np.maximum.at(told, u, proof[which[lo:lo + len(u)]] > PROOF)
        marked.append(np.concatenate([[0], np.cumsum(told)]))
        lo += len(u)
    del which, text, owner, pair
    C.release()
    extra, n_bad, n_good, pairs = _common_windows(parts, marked, toxic, int(np.ceil(PROOF / -np.log(share))))
    unit, of = np.concatenate([unit, pairs[0] + len(flat)]), np.concatenate([of, pairs[1]])
    flat, bad, good = np.concatenate([flat, extra]), np.concatenate([bad, n_bad]), np.concatenate([good, n_good])
    proof = np.concatenate([proof, _proof(n_bad, n_good, share)])
    telling = proof > PROOF
    order = np.argsort(-proof, kind="stable")
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.arange(len(flat))
    worst = _worst(unit, of, -rank, toxic)
    clean = np.flatnonzero(good > 0)
    spread = C.mix(clean.astype(np.uint64))
    negatives = clean[np.argsort(spread)[:CLEAN_UNITS]]
    often = np.union1d(worst[worst >= 0], np.flatnonzero(telling))
    times = bad[often]
    # landmarks: the commonest worst units that differ, and clean units
    vectors, scratch = [], np.zeros(_SIZE)
    for u in often[np.lexsort((often, -times))]:
        if len(vectors) >= landmarks * 2 // 3:
            break
        keys, weights = _vector(flat[u])
        scratch[keys] = weights
        if len(keys) and all(scratch[k] @ w < 0.8 for k, w in vectors):
            vectors.append((keys, weights))
        scratch[keys] = 0
    vectors += [_vector(flat[u]) for u in negatives[:landmarks - len(vectors)]]
    marks = _Landmarks(vectors)
    values, basis = np.linalg.eigh(marks.weights.T @ marks.weights)
    root = basis @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ basis.T
    table, bias = np.zeros(_SIZE), 0.0
    seen: dict[int, np.ndarray] = {}  # landmark features of units, kept over the rounds
    for _ in range(ROUNDS):
        positives = np.union1d(worst[worst >= 0], np.flatnonzero(telling))
        picked = np.concatenate([positives, negatives])
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        new = np.array([u for u in picked.tolist() if u not in seen], np.int64)
        seen.update(zip(new.tolist(), marks.kernel(flat[new]) @ root))
        x = np.array([seen[u] for u in picked.tolist()])
        n_of = np.where(telling[positives], np.sqrt(bad[positives]), 0.3)
        weight = np.concatenate([n_of / n_of.sum() * len(negatives), np.ones(len(negatives))]) / len(negatives) * 1000
        w, bias = _svm(x, y, weight, cost / 1000)
        table = marks.fold(root @ w)
        every = np.concatenate([decide(flat[lo:lo + 20000], table) for lo in range(0, len(flat), 20000)]) + bias
        # windows of the highest values: one of each toxic text, the hardest of clean ones
        extra, whose, values = _high_windows(parts, marked, toxic, table)
        n_new = np.arange(len(flat), len(flat) + len(extra))
        flat, every = np.concatenate([flat, extra]), np.concatenate([every, values + bias])
        bad, good = np.concatenate([bad, toxic[whose]]), np.concatenate([good, ~toxic[whose]])
        telling = np.concatenate([telling, np.zeros(len(extra), bool)])
        unit, of = np.concatenate([unit, n_new]), np.concatenate([of, whose])
        clean = np.flatnonzero(good > 0)
        hard = clean[np.argsort(-every[clean], kind="stable")[:HARD_UNITS]]
        negatives = np.union1d(negatives, hard)
        worst = _worst(unit, of, every[unit], toxic) if telling.any() else worst
    del parts, marked, flat, seen, x, unit, of, every, scratch
    C.release()
    if rest:
        texts, toxic = rest, known
    value = np.concatenate([decide_texts(texts[lo:lo + 500], table, bias) for lo in range(0, len(texts), 500)])
    return Model(table, bias, *_logistic(value, toxic))


def fit(docs: DataFrame, labels: DataFrame, toxic: int = FIT_TOXIC, clean: int = FIT_CLEAN) -> Model:
    """From ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    At most about ``toxic`` and ``clean`` labelled documents of up to FIT_BYTES
    bytes, chosen by a hash of doc_id, meet in one task, which trains; only the
    folded weights come to the driver.  Rows without an id,
    label or text don't count; without any label nothing is toxic.
    """
    labels = labels.select(F.col("doc_id").alias("_hc_of"), F.col("toxic").cast("int").alias("_hc_toxic")) \
        .where("_hc_of IS NOT NULL AND _hc_toxic IS NOT NULL")
    n = {r[0]: r[1] for r in labels.groupBy("_hc_toxic").count().collect()}
    share = lambda k, most: int(min(1.0, most / max(n.get(k, 0), 1)) * (1 << 20))
    limit = F.when(F.col("_hc_toxic") == 1, F.lit(share(1, toxic))).otherwise(F.lit(share(0, clean)))
    labels = labels.where(F.pmod(F.xxhash64("_hc_of", F.lit(9)), F.lit(1 << 20)) < limit)
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_BYTES) \
        .join(F.broadcast(labels), F.col("doc_id") == F.col("_hc_of")).select("doc_id", "text", "_hc_toxic")

    def learn(sample: pa.Table) -> pa.Table:
        found = sample.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("_hc_toxic", "ascending")])
        model = train(found["text"].to_pylist(), np.asarray(found["_hc_toxic"]) == 1)
        at = np.flatnonzero(model.table)
        plain = (at.astype(np.int32), model.table[at].astype(np.float32), model.bias, model.slope, model.shift)
        return pa.table({"model": pa.array([pickle.dumps(plain)], pa.binary())})

    made = rows.withColumn("_hc_all", F.lit(0)).groupBy("_hc_all").applyInArrow(
        lambda sample: C.release(learn(sample)), "model binary").collect()
    if not made:
        return train([], np.zeros(0, bool))
    at, weights, *rest = pickle.loads(made[0][0])
    table = np.zeros(_SIZE, np.float32)
    table[at] = weights
    return Model(table, *rest)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of each different row, and which of them every row is."""
    words = np.ascontiguousarray(rows).view(np.uint64)
    key = words[:, 0]
    for k in range(1, words.shape[1]):
        key = words[:, k] + C.mix(key)
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    return first, which.ravel()


def decide_texts(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The decision value of every text: that of its worst unit or window."""
    letters, first, size, text, sentence = units(texts)
    best = np.full(len(first), -np.inf)
    for i, _, _, value in window_values(letters, first, size, text, sentence, table):
        best[i] = np.maximum(best[i], value)
    long = np.flatnonzero(size > _BODY)
    rows, unit = rows_of(letters, first[long], size[long])
    np.maximum.at(best, long[unit], decide(rows, table))
    return _best(best + bias, text, len(texts))


def score_texts(texts: list[str], table: np.ndarray, bias: float, slope: float, shift: float) -> np.ndarray:
    value = decide_texts(texts, table, bias)
    return 1 / (1 + np.exp(-np.clip(slope * value + shift, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row: the score is in 0..1, and
    ``predicted`` 1 where it is at least 0.5.  A text that is null, empty or
    without letters and digits has the score of the lowest decision value."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def work(batches):
        for batch in batches:
            for i, j, texts in C.text_lists(batch.column(1)):
                s = score_texts(texts, *shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])
            C.release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, score double, predicted int")


def clean_texts(texts: pd.Series, plain: tuple) -> np.ndarray:
    """Which texts have a score below 0.5 by a model's plain values."""
    out, offs = [], np.concatenate([[0], np.cumsum([len(t or "") for t in texts])])
    for i, j in C.slices(offs, SCORED_TOGETHER):
        out.append(score_texts([t or "" for t in texts.iloc[i:j]], *plain) < 0.5)
    return np.concatenate(out) if out else np.zeros(0, bool)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, unchanged, scored in place."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return C.release(pd.Series(clean_texts(texts, shared.value), dtype="bool"))

    return docs.where(clean(F.col("text")))
