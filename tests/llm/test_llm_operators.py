"""Training-data operators against brute force and on odd rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holecard.llm import (chat_format, columnar, language_id, mixing, ngram_join, packing, quality_rules,
                          substring_dedup, topk_search, toxicity, url_filter)
from holecard.llm.components import components, forest
from holecard.llm.queries import URL_RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, size string, score double"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def random_words(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    return [f"w{x}é" if x % 7 == 0 else f"w{x}" for x in rng.integers(0, vocabulary, n)]


@pytest.fixture(scope="module")
def corpus():
    """Documents with copies, near copies, shared passages and odd texts."""
    passage = random_words(1, 60)
    base = random_words(2, 200)
    rows = [(10 + i, " ".join(random_words(100 + i, 40) + passage + random_words(200 + i, 30 + i))) for i in range(8)]
    for i in range(12):  # near copies with growing edits
        w = list(base)
        for k in range(i):
            w[(k * 37) % 200] = f"edit{i}_{k}"
        rows.append((40 + i, " ".join(w)))
    rows += [(70, " ".join(base)), (5, " ".join(base).upper()), (71, " ".join(base[:100])),
             (80, None), (81, ""), (82, " \t\n\x0b\x0c\r "), (83, "one two"), (84, "ONE two"), (85, "x"),
             (86, "no\u00a0break \u2003 space\x85here"), (87, "the " * 300), (88, "a\nb\na\nb\n\n \na b c a b c"),
             (None, " ".join(base)), (None, None), (90, "same row"), (90, "same row"), (91, "w" * 70_000 + " end"),
             (92, " ".join(random_words(9, 30_000, 5000)))]
    langs = ["en", "de", None]
    return [(i, t, langs[k % 3], ["b", "a", None, "é"][k % 4], "clash", 1.5) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words_and_lines_match_the_regex():
    texts = ["a  b\n", "", "\u00a0x y", "é" * 5000 + " z", "last"]
    import pyarrow as pa
    buf, offs = columnar.flat_text(pa.array(texts + [None]))
    sp = columnar.spans(buf, offs)
    found = [bytes(buf[s:e]).decode() for s, e in zip(sp.starts, sp.ends)]
    assert found == [w for t in texts for w in words(t)]
    assert np.diff(sp.first).tolist() == [len(words(t)) for t in texts] + [0]
    keep = np.ones(len(found), bool)
    assert columnar.joined_words(buf, sp, keep).to_pylist() == [" ".join(words(t)) for t in texts] + [""]


def test_components_are_the_smallest_reachable_id(spark):
    pairs = [(1, 2), (2, 3), (9, 3), (20, 21), (21, 20), (30, 30), (None, 4), (50, 51), (52, 51), (52, 53), (54, 53)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 50: 50, 51: 50, 52: 50, 53: 50, 54: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_by_steps_equal_one_union_find(spark, monkeypatch):
    rng = np.random.default_rng(4)
    path = [(int(a), int(b)) for a, b in zip(rng.permutation(120), rng.permutation(120))]
    pairs = path + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] * 2
    want = forest([a for a, _ in pairs], [b for _, b in pairs])
    links = spark.createDataFrame(pairs, "a long, b long").repartition(8)
    monkeypatch.setattr("holecard.llm.components.CHUNK", 1)  # chunks of a batch
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = components(links).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.id: r.component for r in rows} == {x: r for x, r in want.items() if x in linked}
    assert len(rows) == len(linked)


def brute_spans(rows, window=13):
    first = {}
    big = 1 << 70
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, big), big - 1 if i is None else i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < (big - 1 if i is None else i):
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return Counter(out)


@pytest.mark.parametrize("hot", [2, 256])
def test_substring_dedup(docs, corpus, hot):
    out = substring_dedup.dedup_spans(docs, hot_documents=hot)
    assert out.columns == [*docs.columns, "n_words", "n_removed"]
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in out.collect())
    assert got == brute_spans([(r[0], r[1]) for r in corpus])


def test_substring_dedup_empty(spark):
    assert substring_dedup.dedup_spans(empty(spark)).count() == 0


def test_suffix_automaton_matching_statistics():
    rng = np.random.default_rng(3)
    passages = [rng.integers(0, 4, 30).tolist() for _ in range(6)]
    automaton = substring_dedup.SuffixAutomaton()
    for p in passages:
        automaton.add(p)
    held = {tuple(p[i:j]) for p in passages for i in range(30) for j in range(i, 31)}
    text = rng.integers(0, 5, 200).tolist()
    for end, got in enumerate(automaton.matches(text), 1):
        assert got == max(n for n in range(end + 1) if tuple(text[end - n:end]) in held or not n)


def brute_groups(rows):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(root(a), []).append(rows[a][0])
    low = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return Counter((rows[a][0], len(sets[a]), low[root(a)] if sets[a] else rows[a][0]) for a in range(len(rows)))


def test_near_duplicates(docs, corpus):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute_groups([(r[0], r[1]) for r in corpus])


def test_near_duplicates_in_blocks_and_short_lists(docs, corpus, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute_groups([(r[0], r[1]) for r in corpus])


def test_near_duplicates_of_common_tokens(docs, corpus, monkeypatch):
    """Posting lists beyond LIST_PAIRS are chains by size and lose no link."""
    monkeypatch.setattr(ngram_join, "LIST_PAIRS", 2)
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
    assert got == brute_groups([(r[0], r[1]) for r in corpus])


@pytest.mark.parametrize("threshold", [75, 90, 100])
def test_blocks_meet_for_all_sizes_of_links(spark, monkeypatch, threshold):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rows = [(1, 1000 + n * 3 + k, n) for n in range(1, 160) for k in range(3)] + [(2, n, n) for n in range(1, 8)]
    df = spark.createDataFrame(rows, "cluster long, node long, n long")
    places = ngram_join.block_places(df, threshold).collect()
    assert len(places) == len(rows)
    assert {(r.mine, tuple(r.others)) for r in places if r.cluster == 2} == {(0, (0,))}
    places = [r for r in places if r.cluster == 1]
    for p in places:
        assert p.mine in p.others and len(set(p.others)) == len(p.others)
        for q in places:
            assert (q.mine in p.others) == (p.mine in q.others)
            if 100 * min(p.n, q.n) >= threshold * max(p.n, q.n):
                assert q.mine in p.others
    paired = sum(q.mine in p.others for p in places for q in places)
    assert paired < 0.8 * len(places) ** 2


def test_blocks_hold_as_much_as_a_task_can(spark):
    """What a set costs to send grows with the bytes of its cluster, not with its number of sets."""
    rows = [(1, k, 100 + k % 5) for k in range(4000)] + [(2, 10_000 + k, 60_000) for k in range(40)]
    places = ngram_join.block_places(spark.createDataFrame(rows, "cluster long, node long, n long"), 80).collect()
    assert max(len(r.others) for r in places if r.cluster == 1) <= 4
    assert 4 <= max(len(r.others) for r in places if r.cluster == 2) <= 5


def chance_cluster(spark):
    """Documents that share a passage, and a near copy of every tenth; all members of one cluster."""
    passage = random_words(60, 40, 10_000)
    rows = [(k, " ".join(passage + random_words(100 + k, 160 + k, 10_000))) for k in range(40)]
    rows += [(1000 + k, f"{t} end") for k, t in rows[::10]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members = ngram_join.set_rows(df).selectExpr("doc_id AS rep", "hash", "node", "n_shingles AS n", "5L AS cluster")
    return rows, df, members


def test_sets_that_meet_by_chance_leave_large_clusters(spark, monkeypatch):
    rows, df, members = chance_cluster(spark)
    assert ngram_join.linkable(df, members, 3, 90).count() == len(rows)  # one block
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    left = {r.rep for r in ngram_join.linkable(df, members, 3, 90).collect()}
    assert left == {0, 10, 20, 30, 1000, 1010, 1020, 1030}


@pytest.mark.parametrize("part", [1, 3, 96])
def test_near_duplicates_in_large_clusters(spark, docs, corpus, monkeypatch, part):
    rows, df, _ = chance_cluster(spark)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(ngram_join, "LIST_PAIRS", 2)
    monkeypatch.setattr(ngram_join, "PART", part)
    for table, found in ((df, rows), (docs, [(r[0], r[1]) for r in corpus])):
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table).collect())
        assert got == brute_groups(found)


@pytest.mark.parametrize("room", [1, 4096])
def test_bitmap_drops_no_needed_row(spark, monkeypatch, room):
    monkeypatch.setattr(ngram_join, "BITMAP_WORDS", room)
    rows = spark.range(4000).selectExpr("id AS a", "id * 7 AS b", "id AS c")
    needed = spark.range(0, 4000, 40).selectExpr("id AS x", "id * 7 AS y")
    kept = {r.a for r in ngram_join.maybe_needed(rows, needed, ("a", "b"), ("x", "y")).collect()}
    assert kept >= set(range(0, 4000, 40))
    assert len(kept) < 150 or room == 1
    assert ngram_join.maybe_needed(rows, needed.limit(0), ("a", "b"), ("x", "y")).count() == 0


def test_pairs_of_blocks_carry_no_text(spark, docs):
    members = spark.createDataFrame([], "rep long, hash long, node long, n long, cluster long")
    plan = ngram_join.verified_edges(docs, members, 4, 3, 90)._jdf.queryExecution().optimizedPlan().toString()
    exploded = plan[:plan.index("Generate explode")]
    assert "tokens" in exploded and "text" not in exploded.replace("text_hash", "")


def test_shuffle_files_of_near_duplicates_go_with_each_step(spark, docs, monkeypatch):
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    write, before = ngram_join.write_table, spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "write_table", lambda *a: seen.append(spark.conf.get(key)) or write(*a))
    ngram_join.near_duplicates(docs)
    assert len(seen) >= 6 and set(seen) == {"true"} and spark.conf.get(key) == before


def test_near_duplicates_empty(spark):
    assert ngram_join.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("threshold", [66, 74, 101])
def test_near_duplicates_bounds_of_the_threshold(spark, threshold):
    with pytest.raises(ValueError):
        ngram_join.near_duplicates(empty(spark), 3, threshold)


def test_near_duplicates_without_ids_link_nothing_else(spark):
    one, two = random_words(41, 100, 10_000), random_words(42, 100, 10_000)
    rows = [(1, " ".join(one)), (2, " ".join(two)), (None, " ".join([*one, "end"])), (None, " ".join([*two, "end"])),
            (None, " ".join([*two, "end"])), (7, " ".join([*one, "last"])), (7, " ".join([*two, "last"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(df).collect())
    assert got == Counter([(1, 1), (2, 2), (None, 1), (None, 2), (None, 2), (7, 1), (7, 2)])


def test_index_keys_meet_for_every_similar_pair():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(9, 200))
        x = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.05], rng.integers(0, 1 << 40, 4).astype(np.uint64)]))
        counts = lambda s: ((s * np.uint64(2654435761)) >> np.uint64(20)) % np.uint64(12)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 90 * (len(x) + len(y) - both):
            for below in (0, 1, 2, 6, 20):
                keys = [ngram_join._keys(s, counts(s).astype(np.int64), 90, below) for s in (x, y)]
                if len(x) != both or len(y) != both:
                    assert len(np.intersect1d(*keys)), (n, below)


def test_mixing_targets_and_reruns(spark, docs, corpus):
    out = mixing.schedule(docs)
    rows = out.collect()
    assert out.columns[:len(docs.columns) - 1] == [c for c in docs.columns if c != "size"]
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= 2 * sizes[s]]
        for s in full or list(free):
            target[s] = 2 * sizes[s] if full else level * weight[s]
            left -= target[s]
            free.discard(s)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) < 1.001
    again = mixing.schedule(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, r.text or "")
    assert sorted(map(key, rows)) == sorted(map(key, again))
    clash = docs.drop("size").withColumn("queue", F.lit("q")).withColumn("servings", F.lit(1))
    assert Counter(r.queue for r in mixing.mix(clash).collect()).keys() == {"q"}
    for r in rows:  # a serving begins where the source's queue stands, and what is left of the cut is taken
        assert r.taken == sum(s.words for s in r.servings) and [s.turn for s in r.servings] == list(range(len(r.servings)))
        for s in r.servings:
            assert s.start <= s.finish and s.start <= 1 + 1e-9
            assert s.words == r.size if s.finish <= 1 - 1e-9 else 0 < s.words <= r.size
    for source in order:  # servings of a source follow one another up to virtual time 1
        own = sorted((s.start, s.finish, s.words) for r in rows if r.source == source for s in r.servings if s.words)
        at = 0
        for begin, end, n in own:
            assert begin * target[source] == pytest.approx(at, abs=1e-6)
            at += n
        assert abs(at - target[source]) < 1.001
    mixed = mixing.mix(docs.drop("size"))
    assert mixed.columns == docs.drop("size").columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(taken.values())
    assert mixing.schedule(empty(spark)).count() == 0 and mixing.mix(empty(spark).drop("size")).count() == 0


def test_packing_round_trip(spark, docs, corpus):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    extra = [(200, "<|endoftext|> it's a|b 'S e\u0301 ﬁ ΣΑΣ I\u0307 中文 😀x"), (201, "||| |")]
    more = docs.unionByName(spark.createDataFrame([(*r, None, None, None, None) for r in extra], DOCS))
    rows = packing.pack(more, tokenizer_path(), capacity=512, batch_tokens=3000).collect()
    want = Counter()
    for r in [*corpus, *extra]:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want[(r[0], len(ids), np.array(ids, "<u4").tobytes())] += 1
    pieces = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length > 0
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for (doc, n, ids), times in want.items():
        own = sorted(pieces[(doc, n)])
        assert sum(len(p) for _, p in own) >= times * len(ids)
        if times == 1 and sum(k[0] == doc and k[1] == n for k in want) == 1:
            assert b"".join(p for _, p in own) == ids
            assert [s for s, _ in own] == list(np.cumsum([0] + [len(p) // 4 for _, p in own])[:-1])
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        own.sort()
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])
        assert total <= 512 and total & (total - 1) == 0
    assert sum(r.length for r in rows) == sum(n * k for (_, n, _), k in want.items())
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_packing_balances_cost():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 4000, 400).tolist()
    total = sum(lengths)
    placed, left = packing.assign(lengths, [4096] * (total // 4096))
    cost = Counter()
    for _, _, n, to, _ in placed:
        cost[to] += n * n
    assert sum(n for *_, n in left) == total % 4096
    assert max(cost.values()) < 2.2 * np.mean(list(cost.values()))


def test_url_rules(spark):
    urls = ["https://A.Example.org/es/1?x", "http://example.org/en/157/2", "http://example.org/en/2", "ftp://org/", "x://org",
            "http://b.com/fr/", "http://b.com/fr", "http://com/de/#a", "http://b.net/es/", "no url", None, "", "a://b://org/",
            "http://org?x/", "http://notorg/", "http://example.org:80/es/", "HTTP://X.COM/de/\n?"]
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule int")

    def expect(u):
        host, path = url_filter.split_url(u)
        best = max(((len(h.split(".")), len(p), h + p, v) for h, p, v in URL_RULES
                    if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        return (host, path, *(best[2:] if best else (None, "allow")))

    want = [expect(u) for u in urls]
    assert want[0][2:] == ("example.org/es/", "block") and want[1][2:] == ("example.org/en/1", "block")
    for limit in (100, 0):  # by the trie, and by the join
        rows = url_filter.judge_urls(pages, URL_RULES, max_trie_rules=limit).orderBy("page_id").collect()
        assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == want
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0
    clash = pages.withColumn("best", F.lit(1)).withColumn("u", F.lit(2)).withColumn("rule", F.lit("old"))
    for limit in (100, 0):
        again = url_filter.judge_urls(clash, URL_RULES, max_trie_rules=limit).orderBy("page_id")
        assert [(r.host, r.path, r.rule, r.verdict, r.best, r.u) for r in again.collect()] == [(*w, 1, 2) for w in want]
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, [("a", "/", "maybe")])


def test_narrow_numbers_are_the_same_numbers():
    for most in (0, 127, 128, 32767, 32768, 2 ** 31, 2 ** 62):
        values = np.array([most, -most, 1, -1, -most - 1])
        assert topk_search.widened(topk_search.narrow(values).tobytes(), 5).tolist() == values.tolist()
    assert len(topk_search.widened(b"", 0)) == 0
    assert topk_search.narrow(np.array([-128, 127])).itemsize == 1


def test_top_k_in_ranges_of_several_blocks(spark, monkeypatch):
    """The driver knows of a bounded number of ranges, however many blocks there are."""
    rng = np.random.default_rng(61)
    vecs = {k: (rng.normal(size=6) * (1 + k % 3)).astype(np.float32).tolist() for k in range(400)}
    df = spark.createDataFrame(list(vecs.items()), "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk_search, "RANGES", 4)
    kept, write = {}, topk_search.write_table
    monkeypatch.setattr(topk_search, "write_table", lambda table, name: kept.setdefault(name, write(table, name)))
    found = topk_search.top_k(df, F.col("vec_id") % 50 == 0, block=16, query_block=3)
    assert Counter(map(tuple, found.collect())) == brute_top_k(list(vecs.items()))
    blocks = [(r["range"], len(r["rows"]) // 8) for r in kept["blocks"].collect()]
    assert len(blocks) >= 25 and sum(n for _, n in blocks) == 400
    assert {k for k, _ in blocks} == {topk_search.LONGEST, 0, 1, 2, 3} and [k for k, _ in blocks].count(-1) == 1


def brute_top_k(vecs, k=5):
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in vecs
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for at, (q, own) in enumerate(ok):
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(own, v)), i) for j, (i, v) in enumerate(ok)
                       if j != at and len(v) == len(own))
            want.update((q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k]))
    return want


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vecs = [(int(i), [float(x) for x in rng.normal(size=8) * (1 + i % 5)]) for i in range(300)]
    vecs += [(400, vecs[0][1]), (401, vecs[0][1]), (450, None), (500, [1.0, None] * 4), (550, [float("nan")] * 8),
             (600, [float("inf")] * 8), (None, vecs[0][1]), (650, [1.0, 2.0]), (651, [2.0, 1.0]), (50, vecs[50][1]),
             (700, []), (7, [9.0] * 8), (7, [-9.0] * 8), (100, [5.0] * 8), (100, [-5.0] * 8), (750, [0.0] * 8)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    is_query = F.col("vec_id") % 50 == 0
    want = brute_top_k(vecs)
    assert Counter(map(tuple, topk_search.top_k(df, is_query).collect())) == want
    assert Counter(map(tuple, topk_search.top_k(df.repartition(5), is_query, block=4, query_block=3).collect())) == want
    assert topk_search.top_k(df.limit(0), is_query).count() == 0
    big = np.full((1, 4), 1 << 40, np.int64)
    assert topk_search.exact_scores(big, -big)[0, 0] == np.iinfo(np.int64).min


def test_top_k_repeated_ids_equal_the_sql(spark):
    import duckdb
    from holecard.llm.oracle import TOP_K
    vecs = [(0, [1.0, 0.0]), (7, [2.0, 1.0]), (7, [9.0, 9.0]), (8, [0.5, 0.5]), (50, [1.0, 1.0]), (50, [3.0, -1.0])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", vecs)
    got = Counter(map(tuple, topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == Counter(con.execute(TOP_K).fetchall()) == brute_top_k(vecs)


def test_top_k_leaves_out_ranges_of_short_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vecs = [(int(i), [float(x) for x in rng.normal(size=6) * (100 if i < 40 else 0.01)]) for i in range(400)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>").repartition(4)
    sent = []
    plain = topk_search.reaches
    monkeypatch.setattr(topk_search, "reaches", lambda top, ratio: sent.append(1) or plain(top, ratio))
    # queries are long, and so is all that can be among their best
    found = topk_search.top_k(df, (F.col("vec_id") % 50 == 0) & (F.col("vec_id") < 40))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert sent and "filter" in plan
    got = Counter(map(tuple, found.collect()))
    assert got == Counter({r: n for r, n in brute_top_k(vecs).items() if r[0] < 40})
    tops = spark.createDataFrame([(500.0,), (0.05,)], "top double")
    kept = tops.where(plain(F.col("top"), F.lit(100.0))).collect()
    assert [r.top for r in kept] == [500.0]


def test_chats(spark):
    part = lambda kind, text=None, uri=None, w=None, h=None, s=None, p=None: (kind, text, uri, w, h, s, p)
    rows = [(1, 1, "assistant", [part("text", "a < b & c </turn>\n"), part("image", None, "i.png", 28, 29), None]),
            (1, 0, "user", [part("text", "&lt;<turn>"), part("audio", None, "s.wav", None, None, 2.0)]),
            (1, 2, "assistant", [part(None, "x"), part("document", uri="d.pdf", p=2), part("image", uri="j.png")]),
            (2, None, None, None), (2, 1, "assistant", []), (2, 1, "assistant", []), (None, 1, "user", [part("text")])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content {chat_format.PARTS}")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    one = out[1]
    assert one.formatted == ("<turn>user<says>&amp;lt;&lt;turn><audio:1></turn>\n"
                             "<turn>assistant<says>a &lt; b &amp; c &lt;/turn>\n<image:2></turn>\n"
                             "<turn>assistant<says>x<document:3><image:4></turn>\n")
    assert [tuple(a) for a in one.attachments] == [(1, "audio", "s.wav", 50), (2, "image", "i.png", 6),
                                                   (3, "document", "d.pdf", 1120), (4, "image", "j.png", 0)]
    assert one.expanded_tokens == 1 + 50 + 6 + 6 + 1 + 1120
    for t in one.turns:
        own = one.formatted[t.offset:t.offset + t.chars]
        assert own.startswith("<turn>") and own.endswith("</turn>\n")
    loss = [one.formatted[t.offset + t.loss_start:t.offset + t.loss_end] for t in one.turns]
    assert loss == ["", "a &lt; b &amp; c &lt;/turn>\n<image:2>", "x<document:3><image:4>"]
    assert out[2].n_turns == 3 and out[None].n_turns == 1
    read = spark.createDataFrame([(one.formatted,)], "f string").select(chat_format.read_turns(F.col("f")).alias("p"))
    got = read.select(F.transform("p", chat_format.read_text).alias("t"), F.transform("p", chat_format.read_role).alias("r")).first()
    assert got.r == ["user", "assistant", "assistant"] and got.t[0].startswith("&lt;<turn>")
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_language_mixture(spark):
    rng = np.random.default_rng(4)
    stems = {"aa": ["thand", "ering", "whion", "the"], "bb": ["lichü", "schung", "keit", "der"], "cc": ["ción", "mente", "oso", "la"]}
    text = lambda lang, n: " ".join("".join(rng.choice(stems[lang], 2)) for _ in range(n))
    rows = [(i, text(lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.Model.fit(df.where("doc_id < 60"))
    odd = [(200, None), (201, ""), (202, "12 !? 😀"), (203, text("aa", 60) + ". " + text("bb", 30)), (None, "x"), (204, "𝒳")]
    out = language_id.predict(df.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")), model)
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (200, 201, 202))
    assert got[204].lang_pred != "und" and got[None].lang_pred != "und"
    both = got[203]
    assert set(both.langs) == {"aa", "bb"} and both.lang_pred == "aa" and both.score == pytest.approx(2 / 3, abs=0.08)
    none = language_id.Model.fit(df.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0
    assert df.select(language_id.remainder(F.col("doc_id"), 4).alias("x")).where("doc_id = 7").first().x == zlib.crc32(b"7") % 4


def test_quality_statistics_and_rules(spark, docs, corpus):
    got = Counter(tuple(r)[:6] for r in quality_rules.statistics(docs).collect())
    want = Counter()
    for i, t, *_ in corpus:
        w = words(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)),
              len(covered))] += 1
    assert got == want
    rows = [(i, " ".join(random_words(i, 80)) + (" ###" * 20 if i % 4 == 0 else " #" if i % 4 == 1 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(None, 0), (700, None)], "doc_id long, quality int")
    known = spark.createDataFrame(rows, "doc_id long, text string")
    rules = quality_rules.fit(known, labels)
    verdict = {r.doc_id: r.good for r in quality_rules.judge(quality_rules.statistics(known), rules).collect()}
    assert rules and np.mean([verdict[i] == (i % 4 != 0) for i in range(600)]) > 0.99
    assert quality_rules.fit(known, labels.limit(0)) == [] and quality_rules.fit(known.limit(0), labels) == []
    assert quality_rules.statistics(empty(spark)).count() == 0


def test_toxicity(spark):
    rng = np.random.default_rng(7)
    syllables = ["than", "er", "ing", "wh", "ou", "re", "ti", "on", "es", "ly"]
    insults = ["idiot", "moron", "clown"]
    rows, labels = [], []
    for i in range(400):
        w = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            w[int(rng.integers(60))] = str(rng.choice(insults))
        rows.append((i, " ".join(w) + "."))
        labels.append((i, int(bad)))
    odd = [(900, None), (901, ""), (902, "?! 12"), (903, "id.i-ot"), (904, "i d i o t"), (905, "mor_on!"), (906, "than er whing")]
    df = spark.createDataFrame(rows + odd + [(None, "idiot")], "doc_id long, text string")
    table = spark.createDataFrame(labels + [(None, 1), (901, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, table.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in range(0, 400, 3)]) > 0.97
    assert all(got[i].predicted == 1 for i in (903, 904, 905)) and got[None].predicted == 1
    assert all(got[i].predicted == 0 for i in (900, 901, 902, 906))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    kept = {r.doc_id for r in toxicity.keep_clean(df, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}
    nothing = toxicity.fit(df, table.limit(0))
    assert {r.predicted for r in toxicity.score(df, nothing).collect()} == {0}
    assert toxicity.score(df.limit(0), model).count() == 0


def test_toxicity_of_insults_across_blanks():
    rng = np.random.default_rng(9)
    syllables = ["than", "er", "ing", "wh", "ou", "re", "ti", "on", "es", "ly"]
    texts = [["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)] for _ in range(400)]
    for k, i in enumerate(range(0, 400, 4)):
        texts[i][int(rng.integers(60))] = ["idiot", "moron", "big dumb cow"][k % 3]
        texts[i + 1][5:10:2] = texts[i + 2][7:50:20] = ["big", "dumb", "cow"]  # ordinary words
    texts = [" ".join(t) for t in texts]
    toxic = np.arange(400) % 4 == 0
    model = toxicity.train(texts[:300], toxic[:300])
    assert np.mean((toxicity.score_texts(texts[300:], *model.plain()) >= 0.5) == toxic[300:]) > 0.97
    odd = ["than id iot er", "wh mor on ly", "er i d iot", "than big dumb cow er"]
    assert (toxicity.score_texts(odd, *model.plain()) >= 0.5).all()
    assert not (toxicity.score_texts(["than er big. dumb ou cow", "er on"], *model.plain()) >= 0.5).any()
    # running sums have the values of rows
    letters, first, size, text, sentence = toxicity.units([*texts[:4], "a b. cd é7 ю" + "ь" * 40])
    for i, j, n, value in toxicity.window_values(letters, first, size, text, sentence, model.table):
        assert np.allclose(value, toxicity.decide(toxicity.rows_of(letters, first[i], n)[0], model.table))


def test_toxicity_in_other_letters():
    rng = np.random.default_rng(8)
    letters, insults = list("абвгдежзиклмнопрстуфхцчшщыьэюя"), ["идиотка", "дурачина", "мерзавец"]
    texts = [["".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(40)] for _ in range(400)]
    for i in range(0, 400, 4):
        texts[i][int(rng.integers(40))] = insults[i // 4 % 3]
    texts = [" ".join(t) for t in texts]
    toxic = np.arange(400) % 4 == 0
    model = toxicity.train(texts[:300], toxic[:300])
    assert np.mean((toxicity.score_texts(texts[300:], *model.plain()) >= 0.5) == toxic[300:]) > 0.97
    # NFKD holds for letters above U+FFFF too, and digits are told apart
    bold = "".join(chr(0x1D41A + ord(c) - 97) for c in "idiot")
    rows = toxicity.unit_rows([bold, "idiot", "12", "56", "\U00020000\U00020001"])[0]
    assert (rows[0] == rows[1]).all() and (rows[2] != rows[3]).any() and (rows[4] > 0).sum() == 4


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp
    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_join", "substring_dedup", "source_mix", "packing"]
    base = [random_words(300 + i, 120, 3000) for i in range(12)]
    rows = [(i, " ".join(w), "en", f"s{i % 3}", 5) for i, w in enumerate(base)]
    rows += [(20, rows[0][1], "en", "s0", 5), (21, rows[1][1] + " tail", "en", "s1", 5), (22, None, None, None, None),
             (23, " ".join(base[2][:50] + random_words(77, 100, 3000)), "en", "s2", 5)]
    rows += [(100 + i, " ".join(random_words(400 + i, 60, 3000) + ["scumbag"]), "en", "s1", 5) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(12)] + [(100 + i, 1, 1) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.dtypes == df.dtypes, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.collect())
    assert {r.doc_id for r in seen[0]} == {r[0] for r in rows if r[0] < 100}
    assert {r.doc_id for r in seen[1]} == {r[0] for r in rows if r[0] < 100} - {20, 21}
    cut = {r.doc_id: r for r in seen[2]}
    assert len(words(cut[23].text)) == 100 and cut[23].n_chars == len(cut[23].text)
    assert cut[3].text == rows[3][1] and cut[3].n_chars == 5
    total = sum(len(words(r.text)) for r in seen[2])
    assert abs(sum(len(words(r.text)) for r in seen[3]) - 1.5 * total) < 4
    assert sum(r.length for r in seen[4]) > 0



def test_pipeline_drops_edited_copies(spark):
    import corpus_pipeline as cp
    base = random_words(31, 1000, 100_000)
    near, far = list(base), list(base)
    near[25::50] = [f"near{k}" for k in range(20)]  # 20 of 1000 words: 0.89 by three words, 0.82 by five
    far[12::25] = [f"far{k}" for k in range(40)]
    shingles = lambda w, n: {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    alike = lambda x, y, n: len(shingles(x, n) & shingles(y, n)) / len(shingles(x, n) | shingles(y, n))
    assert 0.8 < alike(base, near, 5) < alike(base, near, 3) < 0.9 and alike(base, far, 5) < 0.8
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id for r in cp.one_of_each_group(spark, df, "").collect()} == {1, 3}


def test_chats_with_tied_turns_equal_the_sql(spark):
    import duckdb
    from holecard.llm import oracle, queries
    rows = [(1, 0, "user", "a b"), (1, 0, "user", "a"), (1, 0, "user", None), (1, 0, "user", "a"), (2, 1, "assistant", "z,"),
            (2, 1, "assistant", "z"), (2, None, "user", "{"), (3, 0, None, "x"), (3, 0, "user", "null"), (3, 0, "user", None),
            (4, 0, "user", "long " * 60_000), (4, 0, "user", "long")]
    import tempfile
    folder = tempfile.mkdtemp()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{folder}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    res = con.execute(oracle.CHATS)
    columns = [c[0] for c in res.description]
    got = Counter(map(tuple, queries.chats(spark, folder).select(*columns).collect()))
    assert got == Counter(res.fetchall())


def test_tasks_of_a_worker_share_its_word_ids():
    import pickle
    from pyspark import cloudpickle

    def task(path):
        return packing.word_ids(path)

    first, second = (pickle.loads(cloudpickle.dumps(task)) for _ in range(2))
    assert first(tokenizer_path()) is second(tokenizer_path()) is packing.word_ids(tokenizer_path())
    words = packing.WordIds(tokenizer_path())
    listed = ["a", "|", "x|y", "", "längeres", "a"] * 300
    flat, counts = words._encode_words(listed)
    each = [words._encode(w) for w in listed]
    assert counts.tolist() == [len(e) for e in each] and flat.tolist() == [x for e in each for x in e]
