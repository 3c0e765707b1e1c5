"""Language identification as multilingual mixture inference.

Method: each language is a distribution over hashed letter trigrams.  A
document is a mixture of languages; expectation-maximisation estimates its
proportions from the trigrams' likelihoods, and languages are added to its set
while the likelihood grows by more than a penalty per language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holecard.llm import columnar as C

#: Bound of the labelled rows the model is fitted on, chosen by a hash of their id.
FIT_ROWS = 20_000
#: Trigrams are hashed to so many values.
VALUES = 1 << 16
#: Added to every count.
SMOOTHING = 0.5
#: Log-likelihood a further language must gain, as a multiple of log(trigrams).
PENALTY = 3.0
#: Languages that the mixture of one document starts from, by single likelihood.
START_LANGUAGES = 8
STEPS = 10
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Lower-cased letter of every code point of the first plane, 0 for others."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_LETTERS = None


def _trigrams(codes: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around every letter; a word's edge counts as a blank.
    Also the first trigram of every text."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letters()
    low = _LETTERS[np.minimum(codes, 0xFFFF)]
    for i in np.flatnonzero(codes > 0xFFFF):
        low[i] = codes[i] if chr(codes[i]).isalpha() else 0
    at = np.flatnonzero(low[1:-1])
    u = np.uint32
    h = low[at] * u(0x9E3779B1) + low[at + 1] * u(0x85EBCA77) + low[at + 2] * u(0xC2B2AE3D)
    h ^= h >> u(15)
    h *= u(0x2C1B3C6D)
    return (h >> u(16)).astype(np.uint16), np.searchsorted(at + 1, offs)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % n


class Model:
    """Languages in order, and the log-probability of every trigram in each."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p

    @classmethod
    def fit(cls, docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
        """From the non-null texts and langs of ``docs (doc_id, text, lang)``.

        At most about ``fit_rows`` rows are used, those with the smallest
        hashes of doc_id; what comes to the driver are counts, VALUES for each
        language at most.
        """
        docs = docs.where("text IS NOT NULL AND lang IS NOT NULL")
        n = docs.select("lang").count()
        if n > fit_rows:
            docs = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(fit_rows / n * (1 << 20)))

        def count(batches):
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                langs = batch.column(1).to_pylist()
                for i, j, texts in C.text_lists(batch.column(0)):
                    ids, first = _trigrams(*C.code_points(texts))
                    for k in range(j - i):
                        own = total.setdefault(langs[i + k], np.zeros(VALUES, np.int64))
                        own += np.bincount(ids[first[k]:first[k + 1]], minlength=VALUES)
            for lang, n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                    names=["lang", "id", "n"])

        rows = docs.select("text", "lang").mapInArrow(count, "lang string, id int, n long") \
            .groupBy("lang", "id").agg(F.sum("n").alias("n")).toArrow()
        names, which = np.unique(np.array(rows["lang"].to_pylist(), object), return_inverse=True) \
            if len(rows) else (np.zeros(0, object), np.zeros(0, int))
        counts = np.full((len(names), VALUES), SMOOTHING)
        np.add.at(counts, (which, np.asarray(rows["id"])), np.asarray(rows["n"]))
        return cls([str(x) for x in names],
                   np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy())


def infer(ids: np.ndarray, log_p: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Languages of one document, the largest first, and their proportions."""
    ids, n = np.unique(ids, return_counts=True)
    n = n.astype(np.float64)
    lp = log_p[ids].astype(np.float64)
    single = n @ lp
    start = np.argsort(-single, kind="stable")[:START_LANGUAGES]
    lp = lp[:, start]
    top = lp.max(axis=1)
    p, base, size = np.exp(lp - top[:, None]), float(n @ top), n.sum()
    best, chosen, share = float(single[start[0]]), np.array([0]), np.ones(1)

    def em(p, share):
        for _ in range(STEPS):
            share = share * ((n / (p @ share)) @ p) / size
        return share

    first = em(p, np.full(len(start), 1 / len(start)))
    order = np.argsort(-first, kind="stable")
    for k in range(2, len(start) + 1):
        pick = order[:k]
        if first[pick[-1]] < 0.01:
            break
        own = em(p[:, pick], first[pick] / first[pick].sum())
        fit = base + float(n @ np.log(p[:, pick] @ own)) - penalty * (k - 1) * np.log(size)
        if fit <= best:
            break
        best, chosen, share = fit, pick, own
    order = np.argsort(-share, kind="stable")
    return start[chosen[order]], share[order]


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``(doc_id, lang_pred, score, langs, shares)`` for every row.

    ``langs`` are the languages of the document with their ``shares``, the
    largest first; ``lang_pred`` and ``score`` are the first of them.  A null
    text, one without letters, or a model without languages gives ``und``, 0
    and empty lists.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p))

    def work(batches):
        names, log_p = shared.value
        for batch in batches:
            langs, shares = [], []
            for i, j, texts in C.text_lists(batch.column(1)):
                ids, first = _trigrams(*C.code_points(texts))
                for k in range(j - i):
                    own = ids[first[k]:first[k + 1]]
                    if not len(own) or not names:
                        langs.append([])
                        shares.append([])
                        continue
                    which, share = infer(own, log_p, penalty)
                    langs.append([names[x] for x in which])
                    shares.append([float(min(max(x, 0.0), 1.0)) for x in share])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] if x else UNKNOWN for x in langs], pa.string()),
                 pa.array([x[0] if x else 0.0 for x in shares], pa.float64()),
                 pa.array(langs, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
                names=["doc_id", "lang_pred", "score", "langs", "shares"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>")
