"""Language mixture and string kernel against plain loops; registered queries on small tables."""

from __future__ import annotations

import itertools
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from holecard.llm import columnar as C
from holecard.llm import language_id, packing, queries, toxicity


def plain_em(n, p, share):
    for _ in range(language_id.STEPS):
        new = [0.0] * len(share)
        for count, row in zip(n, p):
            total = sum(s * x for s, x in zip(share, row))
            for k, x in enumerate(row):
                new[k] += count * share[k] * x / total
        share = [x / sum(n) for x in new]
    return share


def plain_infer(ids, log_p, penalty):
    """Proportions by loops over trigrams and languages; sets grow by the share of all."""
    found = sorted(Counter(ids.tolist()).items())
    n = [c for _, c in found]
    p = [[math.exp(x) for x in log_p[i]] for i, _ in found]
    fit = lambda pick, share: sum(
        c * math.log(sum(s * row[k] for s, k in zip(share, pick))) for c, row in zip(n, p))
    languages = range(log_p.shape[1])
    top = max(languages, key=lambda k: fit([k], [1.0]))
    best, chosen, own = fit([top], [1.0]), [top], [1.0]
    first = plain_em(n, p, [1 / len(languages)] * len(languages))
    order = sorted(languages, key=lambda k: -first[k])
    for k in range(2, len(languages) + 1):
        pick = order[:k]
        if first[pick[-1]] < 0.01:
            break
        start = [first[x] / sum(first[y] for y in pick) for x in pick]
        share = plain_em(n, [[row[x] for x in pick] for row in p], start)
        value = fit(pick, share) - penalty * (k - 1) * math.log(sum(n))
        if value <= best:
            break
        best, chosen, own = value, pick, share
    return dict(zip(chosen, own))


@pytest.mark.parametrize("seed", range(6))
def test_mixture_equals_plain_em(seed):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.full(60, 0.2), 4).T + 1e-4
    log_p = np.log(p / p.sum(axis=0)).astype(np.float64)
    share = rng.dirichlet(np.full(4, 0.4))
    mixed = np.exp(log_p) @ share
    ids = rng.choice(60, 400, p=mixed / mixed.sum()).astype(np.uint16)
    which, got = language_id.infer(ids, log_p, 3.0)
    want = plain_infer(ids, log_p, 3.0)
    assert set(which.tolist()) == set(want)
    assert all(x == pytest.approx(want[k], rel=1e-6) for k, x in zip(which.tolist(), got))
    assert list(got) == sorted(got, reverse=True)


def plain_features(letters):
    """Weights of all subsequences of four letters that span at most REACH."""
    out = Counter()
    for at in itertools.combinations(range(len(letters)), 4):
        if at[3] - at[0] <= toxicity.REACH:
            out[tuple(letters[i] for i in at)] += toxicity.DECAY ** (at[3] - at[0])
    return out


def plain_length(letters):
    return math.sqrt(sum(toxicity.DECAY ** (2 * (at[3] - at[0])) for at in itertools.combinations(range(len(letters)), 4)
                         if at[3] - at[0] <= toxicity.REACH))


def test_kernel_equals_gap_weighted_subsequences():
    texts = ["idiot id.i-ot", "aaaa abababab", "the quick brown foxes jumped", "xy", "abc", "i d i o t"]
    rows, _, _ = toxicity.unit_rows(texts)
    letters = [[int(x) for x in row if x] for row in rows]
    marks = toxicity._Landmarks([toxicity._vector(row) for row in rows])
    got = marks.kernel(rows)
    for i, x in enumerate(letters):
        for j, y in enumerate(letters):
            if len(x) < 4 or len(y) < 4:
                continue
            f, g = plain_features(x), plain_features(y)
            want = sum(f[u] * g[u] for u in f) / (plain_length(x) * plain_length(y))
            assert got[i, j] == pytest.approx(want, rel=1e-9)
    # folded into one table, the machine is the same sum over landmarks
    coefficients = np.random.default_rng(3).normal(size=len(rows))
    assert toxicity.decide(rows, marks.fold(coefficients)) == pytest.approx(got @ coefficients)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small documents and labels: null and repeated ids, null and empty texts."""
    path = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(11)
    stems = {"aa": ["thand", "ering", "whion"], "bb": ["lich", "schung", "keit"]}
    rows = []
    for i in range(120):
        lang = "aa" if i % 2 else "bb"
        w = ["".join(rng.choice(stems[lang], 2)) + str(rng.integers(100)) for _ in range(40 + i % 30)]
        if i % 5 == 0:
            w[3] = "idiot"
        rows.append((i, " ".join(w), lang))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 !?", None), (None, rows[1][1], "aa"), (203, "one two", None),
             (7, rows[7][1], "aa"), (204, "x y z " * 40, "aa")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(120)] + [(None, 1, 1), (201, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def held(doc_id, folds, remainder):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == remainder


def test_registered_language(spark, folder):
    path, rows = folder
    out = queries.QUERIES["op1_language_mixture"](spark, path).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in out)
    known = {i: lang for i, _, lang in rows if i is not None and i < 120}
    assert all(r.lang_pred == known[r.doc_id] for r in out if r.doc_id in known)
    assert all(r.lang_pred == "und" for r in out if r.doc_id in (200, 201, 202))


def test_registered_quality(spark, folder):
    path, rows = folder
    out = queries.QUERIES["op8_quality_rules"](spark, path).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in out}
    assert by_id[204].n_repeat_words == 120 and by_id[204].base_failed and by_id[200].n_words == 0


def test_registered_toxicity(spark, folder):
    path, rows = folder
    out = queries.QUERIES["op9_toxicity"](spark, path).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _, _ in rows)
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) for r in out)
    right = [r.predicted == int(r.doc_id % 5 == 0) for r in out if r.doc_id is not None and r.doc_id < 120]
    assert np.mean(right) > 0.95


def test_workers_give_memory_back_after_a_task():
    def held() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def task(batches):
        for _ in batches:
            arrays = [np.ones(12_000) for _ in range(2000)]  # 190 MB in pieces that malloc keeps
            yield arrays[-1]  # the last one stays

    peak = []
    last = list((peak.append(held()), a)[1] for a in C.releasing(task([0])))
    assert len(last) == 1 and peak[0] - held() > 100 << 20
    assert C.release(5) == 5


def peak_bytes(work) -> int:
    """The most that one call holds at once beyond what was there before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_hashing_words_takes_little_memory_and_no_other_hashes(monkeypatch):
    r = np.random.default_rng(5)
    words = [bytes(r.integers(97, 123, n).astype(np.uint8)) for n in r.integers(1, 12, 250_000)]
    words[70_000:70_000] = [b"x" * n for n in (4096, 4097, 300_000, 700_000)]
    buf = np.frombuffer(b" ".join(words), np.uint8)
    sp = C.spans(buf, np.array([0, len(buf)]))
    assert len(sp.starts) == len(words)
    assert peak_bytes(lambda: C.span_hashes(buf, sp)) < 40 << 20  # 59 MB when 2 MB are hashed at a time
    found = C.span_hashes(buf, sp)
    monkeypatch.setattr(C, "HASH_BYTES", 2 << 20)
    assert (C.span_hashes(buf, sp) == found).all()


def test_remembered_words_are_small_and_bounded(monkeypatch):
    words = packing.WordIds(queries.tokenizer_path())
    texts = [" ".join(f"w{i * 7919 % 100_003}q{i}" for i in range(lo, lo + 3000)) for lo in range(0, 12_000, 3000)]
    whole = [words._encode(t) + [2] for t in texts]

    def encode(text):
        buf = np.frombuffer(text.encode(), np.uint8)
        return words.encode(buf, np.array([0, len(buf)]), 2)[0].tolist()

    assert [encode(t) for t in texts + texts] == whole + whole
    held = sum(a.nbytes for a in (words.known, words.start, words.count, words.ids))
    assert len(words.known) == 12_000 and held <= 16 * 12_000 + 2 * len(words.ids)
    monkeypatch.setattr(packing, "CACHE_IDS", 1000)
    assert [encode(t) for t in texts] == whole and len(words.known) == 3000


def test_a_filter_scores_texts_in_small_parts():
    r = np.random.default_rng(6)
    texts = pd.Series(["".join(map(chr, r.integers(97, 123, 1000))) + " vile grumbok" * (k % 3 == 0) for k in range(90)])
    plain = toxicity.train(texts.tolist(), np.arange(90) % 3 == 0).plain()
    many = pd.concat([texts] * 20 + [pd.Series([None, ""])], ignore_index=True)
    found = []
    assert peak_bytes(lambda: found.append(toxicity.clean_texts(many, plain))) < 60 << 20  # 114 MB in parts of 2 MB
    assert (found[0] == (toxicity.score_texts([t or "" for t in many], *plain) < 0.5)).all()
    assert len(toxicity.clean_texts(many[:0], plain)) == 0
