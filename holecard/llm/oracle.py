"""DuckDB SQL of the training-data queries that SQL can express.

The other queries are tested against brute force in tests/llm: 1, 8 and 9 learn
a model, 5 shuffles by a Spark hash, and 7 needs a tokenizer.
"""

from __future__ import annotations

from holecard.llm import part_codes, secret_scan

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

URL = r"""
WITH parts AS (
  SELECT page_id, regexp_extract(url, '(?s)^.*?://(.*)$', 1) AS rest, url FROM pages),
split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '(?s)^([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts),
found AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM found
"""

SUBSTRING = f"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win FROM starts),
first AS (SELECT win, min(doc_id) AS owner FROM windows GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN first USING (win) WHERE owner < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

TOP_K = """
WITH vecs AS (
  SELECT row_number() OVER () AS id, vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.id, q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
  FROM vecs q JOIN vecs v ON q.id <> v.id AND len(q.c) = len(v.c) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

CHATS = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, len('<turn>' || '<says>' || '</turn>' || chr(10))
            + len(replace(replace(role, '&', '&amp;'), '<', '&lt;'))
            + len(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS chars FROM every),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(chars)::BIGINT AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, len(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM chats
"""

NEAR = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                               "'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE [array_to_string(list_slice(w, i, i + 2), ' ') for i in range(1, len(w) - 1)] END) AS s FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same_n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * same_n >= 90 * (x.n + y.n - same_n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS low FROM docs
  UNION SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.id),
best AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM docs JOIN best ON best.id = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
"""

CRC_TABLE = """(SELECT list(v ORDER BY i) FROM (
  WITH RECURSIVE step AS (
    SELECT i, i AS v, 0 AS k FROM range(256) r(i)
    UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8)
  SELECT i, v FROM step WHERE k = 8))"""

MANIFEST = r"""
WITH RECURSIVE crc AS (SELECT {crc} AS t),
digits AS (
  SELECT DISTINCT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, [ord(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) AS c
  FROM documents, crc WHERE doc_id IS NOT NULL),
seen AS (
  SELECT d.doc_id, source, lang, n_chars, text,
         CASE WHEN xor(c, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown
  FROM documents d LEFT JOIN digits USING (doc_id)),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS shown
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM seen)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM hashed),
levels AS (
  SELECT tree, 0 AS k, list(leaf ORDER BY r) AS d FROM leaves GROUP BY tree
  UNION ALL
  SELECT tree, k + 1, [sha256(array_to_string(d[3 * i + 1:3 * i + 3], '')) for i in range((len(d) + 2) // 3)]
  FROM levels WHERE len(d) > 1),
tops AS (
  SELECT 0 AS k, list(d[1] ORDER BY tree) AS d FROM levels WHERE len(d) = 1
  UNION ALL
  SELECT k + 1, [sha256(array_to_string(d[3 * i + 1:3 * i + 3], '')) for i in range((len(d) + 2) // 3)]
  FROM tops WHERE len(d) > 1),
steps AS (
  SELECT l.tree, r, v.k, d, (r // (3 ** v.k)::BIGINT)::BIGINT AS i
  FROM leaves l JOIN levels v ON v.tree = l.tree AND len(v.d) > 1
  UNION ALL
  SELECT l.tree, r, 100 + t.k, d, (l.tree // (3 ** t.k)::BIGINT)::BIGINT AS i
  FROM leaves l JOIN tops t ON len(t.d) > 1),
paths AS (
  SELECT tree, r, list(struct_pack(
           a := array_to_string(d[i - i % 3 + 1:i], ''),
           b := array_to_string(d[i + 2:i - i % 3 + 3], '')) ORDER BY k) AS p
  FROM steps GROUP BY tree, r),
proven AS (
  SELECT doc_id, leaf, s.d[1] AS subroot, z.d[1] AS root,
         sha256(coalesce(array_to_string([x.a || x.b for x in p], ''), '')) AS proof_sha256,
         coalesce(list_reduce(list_prepend(struct_pack(a := '', b := shown), p),
                              lambda c, x: struct_pack(a := '', b := sha256(x.a || c.b || x.b))).b, shown) AS folded_root
  FROM leaves l JOIN levels s ON s.tree = l.tree AND len(s.d) = 1 JOIN tops z ON len(z.d) = 1
  LEFT JOIN paths q ON q.tree = l.tree AND q.r = l.r)
SELECT *, folded_root = root AS verified FROM proven
""".replace("{crc}", CRC_TABLE)


def _secret_sql() -> str:
    """Base spans by gaps between matches; every window of every candidate by itself."""
    kinds, labels = [], secret_scan.names()
    for i, kind in enumerate(secret_scan.KINDS):
        pattern = {"hex": "[0-9a-f]{24,}"}.get(kind.name, kind.pattern.replace('\\"', '"').replace("'", "''"))
        kinds.append(f"""SELECT id, {i} AS kind, {kind.least} AS least, regexp_extract_all(text, '{pattern}', 0) AS m,
          regexp_extract_all(text, '{pattern}', {kind.group}) AS g, string_split_regex(text, '{pattern}') AS gaps
          FROM docs""")
    rules = []
    for i, kind in enumerate(secret_scan.CLASSES, len(kinds)):
        symbols = kind.symbols.replace("-", "") + ("-" if "-" in kind.symbols else "")
        pattern = f"[{symbols}]{{{kind.window},}}"
        kinds.append(f"""SELECT id, {i} AS kind, 0 AS least, regexp_extract_all(text, '{pattern}', 0) AS m,
          m AS g, string_split_regex(text, '{pattern}') AS gaps FROM docs""")
        rules.append(f"({i}, {kind.window}, {kind.marks()}, {secret_scan.scaled(kind.window)})")
    allowed = " OR ".join(f"regexp_full_match(m, '{pattern}')" for pattern in secret_scan.ALLOW)
    names = "[" + ", ".join(f"'{n}'" for n in labels) + "]"
    counts = ", ".join(f"count(kind) FILTER (kind = {i}) AS n_{k.name}" for i, k in enumerate(secret_scan.KINDS))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
every AS ({" UNION ALL ".join(kinds)}),
places AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM every WHERE len(m) > 0),
found AS (
  SELECT id, kind, m[i] AS m, (list_sum([len(x) for x in gaps[1:i]])
         + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0))::BIGINT AS since
  FROM places WHERE len(g[i]) >= least),
rules AS (SELECT * FROM (VALUES {", ".join(rules)}) r(kind, w, most, f)),
ends AS (
  SELECT id, kind, since, w, most, f, m, unnest(range(w, len(m) + 1)) AS e
  FROM found JOIN rules USING (kind) WHERE NOT ({allowed})),
windows AS (SELECT *, substring(m, e - w + 1, w) AS x FROM ends),
high AS (
  SELECT id, kind, since, w, e FROM windows
  WHERE list_sum([f[w - len(replace(x, c, '')) + 1] for c in list_distinct(string_split(x, ''))]) <= most
    AND len(regexp_replace(x, '[0-9]', '', 'g')) BETWEEN 1 AND w - 1),
marked AS (
  SELECT *, CASE WHEN lag(e) OVER (PARTITION BY id, kind, since ORDER BY e) >= e - w THEN 0 ELSE 1 END AS opens
  FROM high),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY id, kind, since ORDER BY e) AS island FROM marked),
spans AS (
  SELECT id, kind, since, since + len(m) AS until FROM found WHERE kind < {len(secret_scan.KINDS)}
  UNION ALL
  SELECT id, kind, since + min(e) - any_value(w), since + max(e) FROM islands GROUP BY id, kind, since, island),
texts AS (SELECT *, concat_ws(':', ({names})[kind + 1], since::BIGINT, until::BIGINT) AS t FROM spans)
SELECT any_value(doc_id) AS doc_id, {counts},
       sha256(coalesce(string_agg(t, ',' ORDER BY since, kind) FILTER (kind < {len(secret_scan.KINDS)}), ''))
         AS base_sha256,
       coalesce(string_agg(t, ',' ORDER BY since, kind), '') AS spans
FROM docs LEFT JOIN texts USING (id) GROUP BY id
"""



def _codes_sql() -> str:
    """The rounds as common table expressions, with every distance computed."""
    steps = []
    for i in range(part_codes.ROUNDS + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT id, part, any_value(pv) AS v, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
    SELECT p.id, p.part, p.v AS pv, b.entry,
           list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts p JOIN book{i} b ON b.part = p.part) GROUP BY id, part)""")
        if i < part_codes.ROUNDS:
            steps.append(f"""mean{i} AS (
  SELECT part, entry, list(m ORDER BY place) AS v FROM (
    SELECT part, entry, place, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m FROM (
      SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{i})
    GROUP BY part, entry, place) GROUP BY part, entry),
book{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{i} b
  LEFT JOIN mean{i} m ON m.part = b.part AND m.entry = b.entry)""")
    last = part_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
         [floor({part_codes.SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
numbered AS (SELECT *, unnest(range({part_codes.PARTS})) AS part FROM kept),
parts AS MATERIALIZED (
  SELECT id, part, c[part * len(c) // {part_codes.PARTS} + 1:(part + 1) * len(c) // {part_codes.PARTS}] AS v
  FROM numbered),
book0 AS (SELECT part, id AS entry, v FROM parts WHERE id < {part_codes.ENTRIES}),
{", ".join(steps)},
digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last}),
coded AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM near{last} GROUP BY id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id), digest
"""


ORACLE_SQL = {
    "op2_url_trie": URL,
    "op3_substring_dedup": SUBSTRING,
    "op4_exact_topk": TOP_K,
    "op6_chat_format": CHATS,
    "op10_ngram_jaccard": NEAR,
    "op11_part_codes": _codes_sql(),
    "op12_secret_scan": _secret_sql(),
    "op13_merkle_manifest": MANIFEST,
}
