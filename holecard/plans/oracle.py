"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement recomputes its query from the raw views the driver registers
(``documents``, ``labels``, ...), repeating the stand-in rules of
``plans/standins.py`` in SQL.  Where the Spark side uses array functions the
SQL side mostly uses UNNEST + window functions, so the two are independent
derivations of the same result.
"""

from __future__ import annotations

from holecard.functions.lexer import TOKEN_PATTERN
from holecard.plans.standins import TYPED_LINES


def lit(s: str) -> str:
    """SQL string literal (DuckDB does not process backslash escapes)."""
    return "'" + s.replace("'", "''") + "'"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


WS = r"[\t\n\x0B\f\r ]"

# --- fixed values: stand-in corpus rendering, as in plans/standins.py ---
FILES_CTE = r"""
docs_raw AS (
  SELECT doc_id, lang, source, text AS raw,
         regexp_replace(text, '\r\n?', chr(10), 'g') AS t,
         regexp_extract(text, '^[^A-Za-z]*([A-Za-z]*)', 1) AS word
  FROM documents
),
named AS (
  SELECT *, (CASE WHEN word = '' THEN 'Doc' ELSE word END)
            || (CASE WHEN regexp_matches(raw, '[Tt][Ee][Ss][Tt]') THEN 'Test' ELSE '' END) AS cls
  FROM docs_raw
),
files AS (
  SELECT source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '/' || cls || '.java' AS path,
         source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '/' || cls || '.java' AS origin,
         cls || '.java' AS file_name,
         source AS module,
         'package ' || source || ';' || chr(10) || chr(10) || 'import java.util.' || lang || ';'
           || chr(10) || chr(10) || '/*' || chr(10) || ' * ' || cls || chr(10) || ' */' || chr(10)
           || 'public class ' || cls || ' {' || chr(10)
           || (CASE WHEN doc_id % 2 = 0 THEN """ + lit(TYPED_LINES) + r""" ELSE '' END)
           || regexp_replace(t, '([^\n]+)',
                '    void m() {' || chr(10) || '        // line' || chr(10) || '        \1'
                || chr(10) || '    }', 'g')
           || chr(10)
           || (CASE WHEN contains(raw, '|') THEN '    abstract void pending();' || chr(10) ELSE '' END)
           || '}' || chr(10) AS text
  FROM named
)"""

LINE_RE = r"[^\n]*\n|[^\n]+\z"

LINES_CTE = rf"""
file_lines AS (
  SELECT path, origin, regexp_extract_all(text, '{LINE_RE}', 0) AS ls FROM files
),
lines AS (
  SELECT path, unnest(ls) AS line, unnest(range(len(ls))) AS line_idx FROM file_lines
)"""


def line_candidates_cte(n: int, above: int = 1, below: int = 1) -> str:
    return rf"""
survivors AS (
  SELECT path, line_idx,
         regexp_matches(line, '^{WS}*/\*') AS opens,
         regexp_matches(line, '\*/{WS}*$') AS closes
  FROM lines
  WHERE NOT regexp_matches(line, '^{WS}*$')
    AND NOT regexp_matches(line, '^{WS}*(//|#|import|package)')
),
flagged AS (
  SELECT path, line_idx,
         coalesce(max(CASE WHEN opens THEN line_idx END) OVER (PARTITION BY path ORDER BY line_idx
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1)
         > coalesce(max(CASE WHEN closes THEN line_idx END) OVER (PARTITION BY path ORDER BY line_idx
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS in_comment
  FROM survivors
),
ranked_lines AS (
  SELECT path, line_idx,
         row_number() OVER (PARTITION BY path ORDER BY line_idx) - 1 AS r,
         count(*) OVER (PARTITION BY path) AS cnt
  FROM flagged WHERE NOT in_comment
),
line_cands AS (
  SELECT path, line_idx FROM ranked_lines WHERE r >= {above + 1} AND r < cnt - {n + below}
)"""


def line_prompts_sql(k: int, n: int, infill: bool, seed: int = 0, files_cte: str = FILES_CTE) -> str:
    label = (f"array_to_string(list_slice(ls, line_idx + 1, line_idx + {n}), '')" if infill
             else "array_to_string(list_slice(ls, line_idx + 1, len(ls)), '')")
    prefix = "array_to_string(list_slice(ls, line_idx - least(line_idx, 50) + 1, line_idx), '')"
    suffix = f"array_to_string(list_slice(ls, line_idx + {n} + 1, line_idx + {n} + 50), '')"
    prompt = (f"'<PRE> ' || {prefix} || ' <SUF>' || {suffix} || ' <MID>'" if infill else prefix)
    return with_(files_cte, LINES_CTE, line_candidates_cte(n), rf"""
chosen AS (
  SELECT path, line_idx FROM line_cands
  ORDER BY md5(concat_ws('|', '{seed}', 'lines', path, CAST(line_idx AS VARCHAR))), path, line_idx
  LIMIT {k}
)""") + rf"""
SELECT 'lines:' || c.path || ':' || CAST(c.line_idx AS VARCHAR) AS prompt_id,
       c.path, f.origin AS path_in_code_repo,
       {prompt} AS prompt, {label} AS label,
       CAST(c.line_idx + 1 AS INTEGER) AS start_line, CAST(c.line_idx + {n} AS INTEGER) AS end_line
FROM chosen c JOIN file_lines f ON f.path = c.path
"""


TOKENS_CTE = rf"""
lexed AS (
  SELECT path, text, regexp_extract_all(text, {lit(TOKEN_PATTERN)}, 0) AS all_t FROM files
),
tok AS (
  SELECT path, unnest(all_t) AS tok, unnest(range(len(all_t))) AS pos FROM lexed
),
bad AS (
  SELECT DISTINCT path FROM (
    SELECT path, tok, lead(tok) OVER (PARTITION BY path ORDER BY pos) AS nxt FROM tok) x
  WHERE tok = chr(34) OR tok = chr(39) OR (tok IN ('`', '#', chr(92)) OR tok = '/' AND starts_with(nxt, '*'))
),
code AS (
  SELECT path, tok, pos, row_number() OVER (PARTITION BY path ORDER BY pos) - 1 AS token_idx
  FROM tok
  WHERE NOT regexp_matches(tok, '^[ \t\r\n\f]+$') AND NOT regexp_matches(tok, '^(//|/\*)')
    AND path NOT IN (SELECT path FROM bad)
)"""


def token_cands_cte(n: int, before: int = 1, after: int = 1) -> str:
    return f"""
kept AS (
  SELECT path, token_idx, tok,
         row_number() OVER (PARTITION BY path ORDER BY token_idx) - 1 AS r,
         count(*) OVER (PARTITION BY path) AS cnt
  FROM code WHERE tok NOT IN ('import', 'package')
),
token_cands AS (
  SELECT path, token_idx, tok AS token FROM kept WHERE r >= {before} AND r < cnt - {n + after}
)"""


def token_prompts_sql(k: int, n: int, seed: int = 0, above: int = 50, below: int = 50,
                      files_cte: str = FILES_CTE) -> str:
    return with_(files_cte, TOKENS_CTE, token_cands_cte(n), rf"""
chosen AS (
  SELECT path, token_idx FROM token_cands
  ORDER BY md5(concat_ws('|', '{seed}', 'tokens', path, CAST(token_idx AS VARCHAR))), path, token_idx
  LIMIT {k}
),
cpos AS (
  SELECT c.path, c.token_idx, f.pos AS p_first, l.pos AS p_last, l.tok AS last_tok
  FROM chosen c
  JOIN code f ON f.path = c.path AND f.token_idx = c.token_idx
  JOIN code l ON l.path = c.path AND l.token_idx = c.token_idx + {n - 1}
),
offs AS (
  SELECT cp.path, cp.token_idx, cp.last_tok,
         CAST(coalesce(sum(length(t.tok)) FILTER (WHERE t.pos < cp.p_first), 0) AS BIGINT) AS s,
         CAST(coalesce(sum(length(t.tok)) FILTER (WHERE t.pos <= cp.p_last), 0) AS BIGINT) AS e
  FROM cpos cp JOIN tok t ON t.path = cp.path
  GROUP BY cp.path, cp.token_idx, cp.last_tok
),
geo AS (
  SELECT o.path, o.token_idx, o.s, o.e, f.text, f.origin,
         regexp_extract_all(f.text, '{LINE_RE}', 0) AS ls,
         substr(f.text, 1, o.s) AS before,
         substr(f.text, 1, o.e - length(o.last_tok)) AS before_last
  FROM offs o JOIN files f ON f.path = o.path
),
geo2 AS (
  SELECT *, 1 + length(before) - length(replace(before, chr(10), '')) AS first_ln,
         1 + length(before_last) - length(replace(before_last, chr(10), '')) AS last_ln,
         regexp_extract(before, '[^\n]*\z', 0) AS partial_pre,
         regexp_extract(substr(text, e + 1), '^[^\n]*\n?', 0) AS partial_suf
  FROM geo
)""") + f"""
SELECT 'tokens:' || path || ':' || CAST(token_idx AS VARCHAR) AS prompt_id,
       path, origin AS path_in_code_repo,
       '<PRE> ' || array_to_string(list_slice(ls, greatest(1, first_ln - {above - 1}), first_ln - 1), '')
         || partial_pre || ' <SUF>' || partial_suf
         || array_to_string(list_slice(ls, last_ln + 1, last_ln + {below - 1}), '')
         || ' <MID>' AS prompt,
       substr(text, s + 1, e - s) AS label,
       CAST(first_ln AS INTEGER) AS start_line, CAST(last_ln AS INTEGER) AS end_line
FROM geo2
"""


SPLIT_CTE = """
ranked_files AS (
  SELECT path, file_name,
         row_number() OVER (ORDER BY md5(concat_ws('|', '0', path)), path) AS rnk,
         CAST(floor(CAST(0.8 AS DOUBLE) * count(*) OVER ()) AS BIGINT) AS cut
  FROM files
),
split_files AS (
  SELECT path, file_name,
         CASE WHEN rnk <= cut THEN 'train' ELSE 'test' END AS split,
         CAST(CASE WHEN rnk <= cut THEN rnk ELSE rnk - cut END AS BIGINT) AS split_id
  FROM ranked_files
)"""


def oracle_sql() -> dict[str, str]:
    from holecard.plans import queries as q
    sql = {
        "corpus_scan_filter": with_(FILES_CTE) + """
SELECT path, file_name,
       CASE WHEN contains(lower(file_name), 'test') THEN 'test' ELSE 'app' END AS role,
       CAST(length(text) AS BIGINT) AS n_chars
FROM files WHERE suffix(file_name, '.java')""",
        "module_extract": with_(FILES_CTE) + """
SELECT CASE WHEN strpos(path, '/') > 0 THEN split_part(path, '/', 1) ELSE '' END AS module,
       count(*) AS n_files
FROM files GROUP BY 1""",
        "line_candidates": with_(FILES_CTE, LINES_CTE, line_candidates_cte(q.NUM_LABEL_LINES)) + """
SELECT path, CAST(line_idx AS INTEGER) AS line_idx FROM line_cands""",
        "line_prompts": line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, True, q.SEED),
        "span_prompts": line_prompts_sql(q.LINES_K, q.SPAN_LINES, True, q.SEED),
        "token_positions": with_(FILES_CTE, TOKENS_CTE) + r""",
ends AS (
  SELECT path, pos, tok, coalesce(sum(length(tok)) OVER w, 0)::BIGINT AS o,
         coalesce(sum(length(tok) - length(replace(tok, chr(10), ''))) OVER w, 0) AS breaks
  FROM tok WINDOW w AS (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
starts AS (
  SELECT *, coalesce(max(CASE WHEN contains(tok, chr(10)) THEN o + length(tok) - length(regexp_extract(tok, '[^\n]*\z', 0))
                     END) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM ends)
SELECT c.path, CAST(token_idx AS INTEGER) AS token_idx, c.tok AS token, CAST(breaks + 1 AS INTEGER) AS line,
       CAST(o - b + 1 AS INTEGER) AS "column", o AS "offset"
FROM code c JOIN starts s ON s.path = c.path AND s.pos = c.pos""",
        "tokens_without_imports": with_(FILES_CTE, TOKENS_CTE, """
parts AS (
  SELECT *, count(*) FILTER (WHERE tok = ';') OVER (PARTITION BY path ORDER BY token_idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS part FROM code),
told AS (
  SELECT *, max(tok IN ('import', 'package')) OVER (PARTITION BY path, part ORDER BY token_idx) AS imports FROM parts)""",
            token_cands_cte(q.NUM_LABEL_TOKENS).replace("FROM code WHERE tok NOT IN ('import', 'package')",
                                                        "FROM told WHERE NOT imports")) + """
SELECT path, CAST(token_idx AS INTEGER) AS token_idx, token FROM token_cands""",
        "prefix_only_prompts": line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, False, q.SEED),
        "one_candidate_per_file": with_(FILES_CTE, LINES_CTE, line_candidates_cte(q.NUM_LABEL_LINES)) + f"""
SELECT path, CAST(arg_min(line_idx, md5(concat_ws('|', '{q.SEED}', 'line', path, CAST(line_idx AS VARCHAR))))
                  AS INTEGER) AS line_idx
FROM line_cands GROUP BY path""",
        "token_candidates": with_(FILES_CTE, TOKENS_CTE, token_cands_cte(q.NUM_LABEL_TOKENS)) + """
SELECT path, CAST(token_idx AS INTEGER) AS token_idx, token FROM token_cands""",
        "token_prompts": token_prompts_sql(q.TOKENS_K, q.NUM_LABEL_TOKENS, q.SEED),
        "lex_failures": with_(FILES_CTE, TOKENS_CTE) + """
SELECT path, 'these_relevant_token_indices' AS reason FROM bad""",
        "split_random_exact": with_(FILES_CTE, SPLIT_CTE) + """
SELECT path, split, split_id FROM split_files""",
        "split_holdout_per_module": with_(FILES_CTE) + """,
chosen AS (
  SELECT module, arg_min(path, md5(concat_ws('|', '0', 'holdout', path))) AS path
  FROM files GROUP BY module
)
SELECT f.path, f.module, CASE WHEN c.path IS NULL THEN 'train' ELSE 'test' END AS split
FROM files f LEFT JOIN chosen c ON c.path = f.path""",
        "file_mapping": with_(FILES_CTE, SPLIT_CTE) + f"""
SELECT path AS old_path,
       '{q.OUT_DIR}/' || split || '/' || CAST(split_id AS VARCHAR) || '_' || file_name AS new_path,
       split
FROM split_files""",
    }
    sql.update(completion_sql(q))
    sql.update(outcome_sql(q))
    sql.update(method_sql(q))
    sql.update(graph_match_sql(q))
    sql.update(scorecard_sql(q))
    none = "CAST(NULL AS DOUBLE) AS average_code_bleu"
    sql["summary_with_baseline"] = f"""
SELECT * FROM ({sql["rates_with_moe"]}) UNION ALL BY NAME
SELECT * REPLACE ({none}, {none}_moe, {none}_se) FROM ({sql["baseline_summary_row"]})"""
    sql["summary_from_files"] = sql["summary_by_kind"].replace("'standin_' || p.kind || '_df_output'",
                                                               "'20240101-000000_' || p.kind || '_df_standin_output'")
    sql["prompt_outcomes"] = f"""
WITH prompts AS ({sql["line_prompts"]}),
builds AS ({with_(OUTCOMES_CTE)} SELECT CAST(doc_id AS VARCHAR) AS doc, built, failure_count FROM outc2)
SELECT prompt_id, split_part(path_in_code_repo, '/', 1) AS module, built, CAST(failure_count AS BIGINT) AS failure_count
FROM prompts p LEFT JOIN builds b ON b.doc = split_part(path_in_code_repo, '/', 3)"""
    sql["split_by_module"] = with_(FILES_CTE) + f""",
held AS (
  SELECT path, file_name, CASE WHEN path IN (
    SELECT arg_min(path, md5(concat_ws('|', '0', 'holdout', path))) FROM files GROUP BY module)
    THEN 'test' ELSE 'train' END AS split FROM files),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5(concat_ws('|', '0', path)), path) AS id FROM held)
SELECT path AS old_path, '{q.OUT_DIR}/' || split || '/' || CAST(id AS VARCHAR) || '_' || file_name AS new_path, split
FROM numbered"""
    return sql


# --- stand-in label/completion pairs, as in plans/standins.completion_pairs ---
PAIRS_CTE = r"""
doc_split AS (
  SELECT doc_id, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS ls
  FROM documents
),
doc_pairs AS (
  SELECT 'line:' || CAST(doc_id AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR) AS prompt_id,
         'lines' AS kind, ls[i] AS label, ls[i + 1] AS completion
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls))) AS i FROM doc_split)
),
turn_pairs AS (
  SELECT 'turn:' || CAST(u.conv_id AS VARCHAR) || ':' || CAST(u.turn AS VARCHAR) AS prompt_id,
         'turns' AS kind, u.text AS label, a.text AS completion
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
),
pairs AS (SELECT * FROM doc_pairs UNION ALL SELECT * FROM turn_pairs)"""


def score_ctes(whole_reference: bool = False) -> str:
    found = _score_ctes()
    if whole_reference:
        found = found.replace("CASE WHEN h1 > 2 THEN 1.0 WHEN h1 = 0 THEN 0.0 ELSE exp(1 - 2.0 / h1) END",
                              "CASE WHEN h1 > r1 THEN 1.0 WHEN h1 = 0 THEN 0.0 ELSE exp(1 - r1 / h1) END")
    return found


def _score_ctes() -> str:
    from holecard.functions.lexer import JAVA_KEYWORDS
    kw = "[" + ", ".join(lit(k) for k in JAVA_KEYWORDS) + "]"
    return rf"""
sides AS (
  SELECT prompt_id, 'h' AS side, replace(completion, chr(10) || ' <EOT>', '') AS s FROM pairs
  UNION ALL SELECT prompt_id, 'r' AS side, label AS s FROM pairs
),
side_toks AS (
  SELECT prompt_id, side,
         regexp_extract_all(regexp_replace(coalesce(s, ''), '^{WS}+|{WS}+$', '', 'g'),
                            {lit(TOKEN_PATTERN)}, 0) AS all_t
  FROM sides
),
side_tok AS (
  SELECT prompt_id, side, unnest(all_t) AS tok, unnest(range(len(all_t))) AS pos FROM side_toks
),
side_bad AS (
  SELECT DISTINCT prompt_id FROM (
    SELECT prompt_id, tok, lead(tok) OVER (PARTITION BY prompt_id, side ORDER BY pos) AS nxt
    FROM side_tok) x
  WHERE tok = chr(34) OR tok = chr(39) OR (tok IN ('`', '#', chr(92)) OR tok = '/' AND starts_with(nxt, '*'))
),
side_code AS (
  SELECT prompt_id, side, row_number() OVER (PARTITION BY prompt_id, side ORDER BY pos) AS k, tok
  FROM side_tok
  WHERE NOT regexp_matches(tok, '^[ \t\r\n\f]+$') AND NOT regexp_matches(tok, '^(//|/\*)')
),
side_lists AS (
  SELECT prompt_id, side, list(tok ORDER BY k) AS ct FROM side_code GROUP BY prompt_id, side
),
grams AS (
  SELECT prompt_id, side, n, list_slice(ct, i, i + n - 1) AS g
  FROM (SELECT prompt_id, side, ct, n, unnest(range(1, len(ct) - n + 2)) AS i
        FROM side_lists, (VALUES (1), (2), (3), (4)) v(n))
),
gram_counts AS (
  SELECT prompt_id, n, g, count(*) FILTER (WHERE side = 'h') AS h,
         count(*) FILTER (WHERE side = 'r') AS r,
         CASE WHEN list_contains({kw}, g[1]) THEN 1.0 ELSE 0.2 END AS w
  FROM grams GROUP BY prompt_id, n, g
),
per_pair AS (
  SELECT p.prompt_id, p.kind,
         coalesce(sum(least(h, r)) FILTER (WHERE n = 1), 0) AS m1,
         coalesce(sum(least(h, r)) FILTER (WHERE n = 2), 0) AS m2,
         coalesce(sum(least(h, r)) FILTER (WHERE n = 3), 0) AS m3,
         coalesce(sum(least(h, r)) FILTER (WHERE n = 4), 0) AS m4,
         coalesce(sum(h) FILTER (WHERE n = 1), 0) AS h1, coalesce(sum(h) FILTER (WHERE n = 2), 0) AS h2,
         coalesce(sum(h) FILTER (WHERE n = 3), 0) AS h3, coalesce(sum(h) FILTER (WHERE n = 4), 0) AS h4,
         coalesce(sum(r) FILTER (WHERE n = 1), 0) AS r1, coalesce(sum(r) FILTER (WHERE n = 2), 0) AS r2,
         coalesce(sum(r) FILTER (WHERE n = 3), 0) AS r3, coalesce(sum(r) FILTER (WHERE n = 4), 0) AS r4,
         coalesce(sum(least(h, r) * w) FILTER (WHERE n = 1), 0) AS wm1,
         coalesce(sum(r * w) FILTER (WHERE n = 1), 0) AS wr1,
         p.prompt_id NOT IN (SELECT prompt_id FROM side_bad) AS ok
  FROM pairs p LEFT JOIN gram_counts c ON c.prompt_id = p.prompt_id
  GROUP BY p.prompt_id, p.kind
),
scored AS (
  SELECT prompt_id, kind, ok,
    CASE WHEN NOT ok THEN NULL WHEN m1 = 0 THEN 0.0 ELSE
      (CASE WHEN h1 > r1 THEN 1.0 WHEN h1 = 0 THEN 0.0 ELSE exp(1 - r1 / h1) END) *
      exp(0.25 * ln((CASE WHEN m1 = 0 THEN 0.1 ELSE m1 END) / greatest(h1, 1))
        + 0.25 * ln((CASE WHEN m2 = 0 THEN 0.1 ELSE m2 END) / greatest(h2, 1))
        + 0.25 * ln((CASE WHEN m3 = 0 THEN 0.1 ELSE m3 END) / greatest(h3, 1))
        + 0.25 * ln((CASE WHEN m4 = 0 THEN 0.1 ELSE m4 END) / greatest(h4, 1))) END
      AS ngram_match_score,
    CASE WHEN NOT ok THEN NULL WHEN wm1 = 0 THEN 0.0 ELSE
      (CASE WHEN h1 > 2 THEN 1.0 WHEN h1 = 0 THEN 0.0 ELSE exp(1 - 2.0 / h1) END) *
      exp(0.25 * ln((CASE WHEN wm1 = 0 THEN 0.1 ELSE wm1 END) / greatest(wr1, 1))
        + 0.25 * ln((CASE WHEN m2 = 0 THEN 0.1 ELSE m2 END) / greatest(r2, 1))
        + 0.25 * ln((CASE WHEN m3 = 0 THEN 0.1 ELSE m3 END) / greatest(r3, 1))
        + 0.25 * ln((CASE WHEN m4 = 0 THEN 0.1 ELSE m4 END) / greatest(r4, 1))) END
      AS weighted_ngram_match_score
  FROM per_pair
),
scored5 AS (
  SELECT *, 0.25 * ngram_match_score + 0.25 * weighted_ngram_match_score + 0.25 * syntax_match_score
              + 0.25 * (CASE WHEN dataflow_match_score = 0 THEN 1.0 ELSE dataflow_match_score END) AS codebleu
  FROM (
    SELECT s.prompt_id, s.kind, ngram_match_score, weighted_ngram_match_score,
           CASE WHEN ok THEN CAST(length(p.label) % 11 AS DOUBLE) / 10 END AS syntax_match_score,
           CASE WHEN ok THEN CAST(length(p.label) % 7 AS DOUBLE) / 6 END AS dataflow_match_score
    FROM scored s JOIN pairs p ON p.prompt_id = s.prompt_id)
)"""


def _score_sql(select: str) -> str:
    return with_(PAIRS_CTE, score_ctes()) + select


SPLIT_RE = r"[, _\-=.+*]"


def _count_sql(c: str) -> str:
    return f"CAST(len(regexp_split_to_array(replace(coalesce({c}, 'nan'), '<EOT>', ''), '{SPLIT_RE}')) AS BIGINT)"


def completion_sql(q) -> dict[str, str]:
    lp = line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, True, q.SEED)
    return {
        "ngram_match": _score_sql("""
SELECT prompt_id, round(ngram_match_score, 6) AS ngram_match_score FROM scored"""),
        "weighted_ngram": _score_sql("""
SELECT prompt_id, round(weighted_ngram_match_score, 6) AS weighted_ngram_match_score FROM scored"""),
        "weighted_ngram_whole": with_(PAIRS_CTE, score_ctes(True)) + """
SELECT prompt_id, round(weighted_ngram_match_score, 6) AS weighted_ngram_match_score FROM scored""",
        "composite_score": _score_sql("""
SELECT prompt_id, kind, round(ngram_match_score, 6) AS ngram_match_score,
       round(weighted_ngram_match_score, 6) AS weighted_ngram_match_score,
       round(syntax_match_score, 6) AS syntax_match_score,
       round(dataflow_match_score, 6) AS dataflow_match_score, round(codebleu, 6) AS codebleu
FROM scored5"""),
        "token_counts": with_(PAIRS_CTE, rf"""
lab AS (
  SELECT prompt_id, regexp_extract_all(replace(coalesce(label, 'nan'), '<EOT>', ''),
                                       {lit(TOKEN_PATTERN)}, 0) AS all_t FROM pairs
),
lab_tok AS (SELECT prompt_id, unnest(all_t) AS tok, unnest(range(len(all_t))) AS pos FROM lab),
lab_bad AS (
  SELECT DISTINCT prompt_id FROM (
    SELECT prompt_id, tok, lead(tok) OVER (PARTITION BY prompt_id ORDER BY pos) AS nxt FROM lab_tok) x
  WHERE tok = chr(34) OR tok = chr(39) OR (tok IN ('`', '#', chr(92)) OR tok = '/' AND starts_with(nxt, '*'))
),
lab_n AS (
  SELECT prompt_id, count(*) AS n FROM lab_tok
  WHERE NOT regexp_matches(tok, '^[ \t\r\n\f]+$') AND NOT regexp_matches(tok, '^(//|/\*)')
  GROUP BY prompt_id
)""") + f"""
SELECT p.prompt_id, {_count_sql('p.label')} AS label_token_count,
       {_count_sql('p.completion')} AS completion_token_count,
       CASE WHEN p.prompt_id IN (SELECT prompt_id FROM lab_bad) THEN NULL
            ELSE CAST(coalesce(n.n, 0) AS BIGINT) END AS label_code_tokens
FROM pairs p LEFT JOIN lab_n n ON n.prompt_id = p.prompt_id""",
        "perplexity": """
WITH p AS (SELECT user_id, ts, event_id, ln(1.0 / (1.0 + value)) AS lp FROM events)
SELECT user_id, count(*) AS n_tokens,
       round(exp(-(sum(lp) - arg_min(lp, (ts, event_id))) / count(*)), 6) AS perplexity
FROM p GROUP BY user_id""",
        "strip_eot": with_(PAIRS_CTE) + """
SELECT prompt_id, replace(completion || chr(10) || ' <EOT>', chr(10) || ' <EOT>', '') AS completion
FROM pairs""",
        "stop_cut": with_(PAIRS_CTE) + """
SELECT prompt_id,
       split_part(completion || chr(10) || chr(10) || chr(10) || label, chr(10) || chr(10) || chr(10), 1)
         AS completion
FROM pairs""",
        "samples_expand": f"""
WITH lp AS ({lp})
SELECT prompt_id, CAST(s AS INTEGER) AS sample_idx FROM lp, range(3) t(s)""",
        "batch_completion": f"""
WITH lp AS ({lp})
SELECT prompt_id,
       split_part(regexp_extract(substr(split_part(prompt, ' <SUF>', 1), 7), '[^\\n]*\\n?\\z', 0),
                  chr(10) || chr(10) || chr(10), 1) AS completion,
       'codellama/7b' AS model
FROM lp""",
    }


LOGS_CTE = r"""
logs AS (
  SELECT user_id AS build_id, event_id AS line_no,
    CASE WHEN event_type = 'signup' THEN '[ERROR] Failures: '
         WHEN event_type = 'error' THEN '[ERROR]   Test' || CAST(event_id AS VARCHAR) || '.check:'
              || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' expected'
         WHEN event_type = 'purchase' THEN '[ERROR] Tests run: ' || CAST(event_id AS VARCHAR)
              || ', Failures: ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
              || ', Errors: ' || CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR)
         ELSE '[INFO] ' || event_type || ' ' || props END AS line
  FROM events
),
flagged_logs AS (
  SELECT build_id, line_no, line,
    max(CASE WHEN line IN ('[ERROR] Failures: ', '[ERROR] Errors: ') THEN line_no END)
      OVER (PARTITION BY build_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
    max(CASE WHEN contains(line, '[ERROR] Tests run:') THEN line_no END)
      OVER (PARTITION BY build_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lc
  FROM logs
),
log_hits AS (
  SELECT build_id, line_no, line, contains(line, '[ERROR] Tests run:') AS is_counts
  FROM flagged_logs
  WHERE coalesce(lo, -1) > coalesce(lc, -1)
    AND (contains(line, '[ERROR] Tests run:') OR contains(line, '[ERROR]   '))
),
parsed AS (
  SELECT build_id,
    CAST(arg_max(TRY_CAST(regexp_extract(line, 'Failures: (\d+)', 1) AS INTEGER), line_no)
         FILTER (WHERE is_counts) AS BIGINT) AS failure_count,
    CAST(arg_max(TRY_CAST(regexp_extract(line, 'Errors: (\d+)', 1) AS INTEGER), line_no)
         FILTER (WHERE is_counts) AS BIGINT) AS error_count,
    count(*) FILTER (WHERE NOT is_counts) AS n_tests,
    arg_min(string_split(line, ' ')[4], line_no) FILTER (WHERE NOT is_counts) AS first_test
  FROM log_hits GROUP BY build_id
),
builds AS (
  SELECT user_id AS build_id,
         CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS exit_code
  FROM events GROUP BY user_id
)"""

OUTCOMES_CTE = r"""
outc AS (
  SELECT l.doc_id, d.source AS module, d.lang, l.quality = 1 AS built,
         CAST(l.toxic AS INTEGER) AS error_count,
         list_sort(list_distinct(regexp_extract_all(d.text, '[A-Za-z]*[Tt][Ee][Ss][Tt][A-Za-z]*', 0))) AS tests
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
),
outc2 AS (SELECT *, CAST(len(tests) AS INTEGER) AS failure_count FROM outc),
base AS (
  SELECT module, arg_min(built, doc_id) AS base_built, arg_min(error_count, doc_id) AS base_err,
         arg_min(failure_count, doc_id) AS base_fail, arg_min(tests, doc_id) AS base_tests
  FROM outc2 GROUP BY module
)"""

Z95 = repr(1.959963984540054)


def _pass_k_sql(k: int) -> str:
    # the share of k-subsets without a passing sample, by binomial coefficients
    comb = (f"exp(lgamma(n - c + 1) - lgamma(n - c - {k} + 1) - lgamma(n + 1) + lgamma(n - {k} + 1))")
    return (f"round(CASE WHEN n < {k} THEN NULL WHEN n - c < {k} THEN 1.0 WHEN c = 0 THEN 0.0 "
            f"ELSE 1 - {comb} END, 6) AS pass_at_{k}")


def _summary_select(name: str, n: str, avgs: dict, rates: dict | None, bleu: tuple | None,
                    ptype: str) -> str:
    cols = [f"{name} AS result_name"]
    for c in ("ngram_match_score", "weighted_ngram_match_score", "syntax_match_score",
              "dataflow_match_score", "label_token_count", "completion_token_count"):
        cols.append(f"round({avgs.get(c, 'CAST(NULL AS DOUBLE)')}, 6) AS average_{c}")
    for r in ("successful_build_rate", "no_error_rate", "pass_at_1_rate"):
        if rates:
            p = rates[r]
            cols.append(f"round({p}, 6) AS {r}")
            cols.append(f"round({Z95} * sqrt(({p}) * (1 - ({p})) / {n}), 6) AS {r}_moe")
        else:
            cols += [f"CAST(NULL AS DOUBLE) AS {r}", f"CAST(NULL AS DOUBLE) AS {r}_moe"]
    b, bm = bleu if bleu else ("CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)")
    se = f"{bm} / sqrt(nullif(count(codebleu), 0))" if "stddev" in bm else bm
    cols += [f"round({b}, 6) AS average_code_bleu", f"round({bm}, 6) AS average_code_bleu_moe",
             f"round({se}, 6) AS average_code_bleu_se",
             f"{ptype} AS prompt_type"]
    return "SELECT " + ",\n       ".join(cols)


def _ptype(name: str) -> str:
    return (f"CASE WHEN contains({name}, 'lines') THEN 'lines' WHEN contains({name}, 'tokens') "
            f"THEN 'tokens' WHEN contains({name}, 'methods') THEN 'methods' END")


_RATES = {"successful_build_rate": "avg(CAST(built AS DOUBLE))",
          "no_error_rate": "avg(CAST(built AND error_count = 0 AS DOUBLE))",
          "pass_at_1_rate": "avg(CAST(built AND failure_count = 0 AS DOUBLE))"}


def outcome_sql(q) -> dict[str, str]:
    count_expr = "CAST(len(regexp_split_to_array(replace(coalesce({c}, 'nan'), '<EOT>', ''), '" + SPLIT_RE + "')) AS DOUBLE)"
    return {
        "build_log_parse": with_(LOGS_CTE) + """
SELECT build_id, failure_count, error_count, CAST(n_tests AS BIGINT) AS n_failed_tests,
       first_test AS first_failed_test
FROM parsed""",
        "failed_tests": with_(LOGS_CTE) + """
SELECT build_id, line_no, string_split(line, ' ')[4] AS test FROM log_hits WHERE NOT is_counts""",
        "build_outcomes": with_(LOGS_CTE) + """
SELECT b.build_id, b.exit_code = 0 AS built, CAST(coalesce(p.failure_count, 0) AS BIGINT) AS failure_count,
       CAST(coalesce(p.error_count, 0) AS BIGINT) AS error_count,
       CAST(coalesce(p.n_tests, 0) AS BIGINT) AS n_failed_tests
FROM builds b LEFT JOIN parsed p ON p.build_id = b.build_id""",
        "module_catalogue": """
WITH items AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1),
                                     '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS its
  FROM pages
)
SELECT page_id, CAST(unnest(range(len(its))) AS INTEGER) AS module_idx, unnest(its) AS module FROM items""",
        "build_file_modules": r"""
WITH poms AS (
  SELECT doc_id AS project, '<project>' || chr(10) || '<modules>' || chr(10)
    || regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '([^\n]+)', '  <module>\1</module>', 'g') || chr(10)
    || '  <!-- <module>old</module> -->' || chr(10) || '</modules>' || chr(10) || '<modules>' || chr(10)
    || '  <module>other</module>' || chr(10) || '</modules>' AS t FROM documents),
items AS (
  SELECT project, regexp_extract_all(regexp_extract(t, '(?s)<modules>(.*?)</modules>', 1),
    '(?m)^[ \t]*<module>([^<]+)</module>[ \t\r]*$', 1) AS its FROM poms)
SELECT project, CAST(unnest(range(len(its))) AS INTEGER) AS module_idx, unnest(its) AS module FROM items""",
        "baselines_extended": with_(OUTCOMES_CTE) + """
SELECT v AS code_version, d.module, 1::BIGINT AS n_rows, coalesce(b.base_built, false) AS built,
       CAST(b.base_fail AS BIGINT) AS failure_count
FROM (SELECT DISTINCT source AS module FROM documents) d CROSS JOIN (VALUES ('v1'), ('v2')) t(v)
LEFT JOIN base b ON b.module = d.module""",
        "pass_at_many": with_(OUTCOMES_CTE) + f""",
g AS (SELECT lang, count(*) AS n, sum(CAST(built AS INTEGER)) AS c FROM outc2 GROUP BY lang)
SELECT lang, n AS n_samples, CAST(c AS BIGINT) AS n_passed, {_pass_k_sql(10)}, {_pass_k_sql(100)} FROM g""",
        "run_history": with_(OUTCOMES_CTE) + f""",
runs AS (
  SELECT *, 'r1_' || lang || '_df_{q.SCORECARD_MODEL.replace("/", "-")}_output' AS rn FROM outc2
  UNION ALL
  SELECT *, 'r2_' || lang || '_df_{q.SCORECARD_MODEL.replace("/", "-")}_output' FROM outc2 WHERE error_count = 0)
""" + _summary_select("rn", "count(*)", {}, _RATES, None, _ptype("rn")) + "\nFROM runs GROUP BY rn",
        "baseline_delta": with_(OUTCOMES_CTE) + """
SELECT o.doc_id, o.module,
       CAST(o.failure_count - coalesce(b.base_fail, 0) AS BIGINT) AS additional_failure_count,
       CAST(o.error_count - coalesce(b.base_err, 0) AS BIGINT) AS additional_error_count,
       array_to_string(list_filter(o.tests, lambda t: NOT list_contains(coalesce(b.base_tests, []), t)), ',')
         AS additional_failed_tests,
       o.built AND coalesce(b.base_built, true) AS additional_pass
FROM outc2 o LEFT JOIN base b ON b.module = o.module""",
        "missing_baselines": with_(OUTCOMES_CTE) + """
SELECT DISTINCT source AS module FROM documents
WHERE source NOT IN (SELECT module FROM base WHERE base_fail + base_err = 0)""",
        "catalogue_baselines": with_(OUTCOMES_CTE) + """
SELECT d.module, coalesce(b.base_built, false) AS built, CAST(b.base_fail AS BIGINT) AS failure_count,
       CAST(b.base_err AS BIGINT) AS error_count
FROM (SELECT DISTINCT source AS module FROM documents) d
LEFT JOIN (SELECT * FROM base WHERE base_built) b ON b.module = d.module""",
        "pass_at_k": with_(OUTCOMES_CTE) + f""",
g AS (SELECT module, lang, count(*) AS n, sum(CAST(built AS INTEGER)) AS c FROM outc2 GROUP BY module, lang)
SELECT module, lang, n AS n_samples, CAST(c AS BIGINT) AS n_passed, {_pass_k_sql(1)}, {_pass_k_sql(5)}
FROM g""",
        "summary_by_kind": with_(PAIRS_CTE, score_ctes()) + ",\n" + """
ev AS (
  SELECT 'standin_' || p.kind || '_df_output' AS rn, s.*, p.label,
         replace(p.completion, chr(10) || ' <EOT>', '') AS completion
  FROM scored5 s JOIN pairs p ON p.prompt_id = s.prompt_id
)
""" + _summary_select(
            "rn", "count(*)",
            {"ngram_match_score": "avg(ngram_match_score)",
             "weighted_ngram_match_score": "avg(weighted_ngram_match_score)",
             "syntax_match_score": "avg(syntax_match_score)",
             "dataflow_match_score": "avg(dataflow_match_score)",
             "label_token_count": "avg(" + count_expr.format(c="label") + ")",
             "completion_token_count": "avg(" + count_expr.format(c="completion") + ")"},
            None, ("avg(codebleu)", "stddev_samp(codebleu)"), _ptype("rn")) + "\nFROM ev GROUP BY rn",
        "rates_with_moe": with_(OUTCOMES_CTE) + "\n" + _summary_select(
            "lang", "count(*)", {}, _RATES, None, _ptype("lang")) + "\nFROM outc2 GROUP BY lang",
        "baseline_summary_row": with_(OUTCOMES_CTE) + ",\n" + """
bm AS (SELECT base_built AS built, base_err AS error_count, base_fail AS failure_count FROM base)
""" + _summary_select("'base_modules'", "count(*)", {}, _RATES, ("1.0", "0.0"),
                      "CAST(NULL AS VARCHAR)") + "\nFROM bm",
    }


def method_ctes(src: str = "files", constructors: bool = False) -> str:
    from holecard.functions.lexer import JAVA_KEYWORDS
    kw = "[" + ", ".join(lit(k) for k in JAVA_KEYWORDS) + "]"
    ident = "'^[A-Za-z_$][A-Za-z0-9_$]*$'"
    flat = "words"  # balanced parentheses, innermost first
    for _ in range(12):
        flat = rf"regexp_replace({flat}, '\([^()]*\)', '#', 'g')"
    return rf"""
mlex AS (SELECT path, regexp_extract_all(text, {lit(TOKEN_PATTERN)}, 0) AS all_t FROM {src}),
mtok AS (SELECT path, unnest(all_t) AS tok, unnest(range(len(all_t))) AS pos FROM mlex),
mbad AS (
  SELECT DISTINCT path FROM (
    SELECT path, tok, lead(tok) OVER (PARTITION BY path ORDER BY pos) AS nxt FROM mtok) x
  WHERE tok = chr(34) OR tok = chr(39) OR (tok IN ('`', '#', chr(92)) OR tok = '/' AND starts_with(nxt, '*'))
),
mlined AS (
  SELECT path, pos, tok,
         coalesce(sum(length(tok) - length(replace(tok, chr(10), ''))) OVER (PARTITION BY path ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line0
  FROM mtok WHERE path NOT IN (SELECT path FROM mbad)
),
mcode AS (
  SELECT * FROM mlined
  WHERE NOT regexp_matches(tok, '^[ \t\r\n\f]+$') AND NOT regexp_matches(tok, '^(//|/\*)')
),
mnbr AS (
  SELECT path, pos, tok, line0,
         lag(tok) OVER (PARTITION BY path ORDER BY pos) AS prev,
         lead(tok) OVER (PARTITION BY path ORDER BY pos) AS nxt
  FROM mcode
),
mheads AS (
  SELECT path, pos, tok AS method, typed FROM (
    SELECT *, (regexp_matches(prev, {ident}) AND NOT list_contains({kw}, prev))
         OR prev IN ('void', 'boolean', 'byte', 'char', 'short', 'int', 'long', 'float', 'double', '>', ']') AS typed
    FROM mnbr WHERE regexp_matches(tok, {ident}) AND NOT list_contains({kw}, tok) AND nxt = '(')
  WHERE typed OR ({constructors} AND prev NOT IN ('new', '.'))
),
mparts AS (
  SELECT *,
    coalesce(sum(CASE WHEN tok IN ('{{', '}}', ';') THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part,
    coalesce(sum(CASE WHEN tok = '{{' THEN 1 WHEN tok = '}}' THEN -1 ELSE 0 END)
             OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS outside
  FROM mcode
),
mstatements AS (
  SELECT path, ' ' || coalesce(string_agg(CASE WHEN starts_with(tok, chr(34)) OR starts_with(tok, chr(39)) THEN 'str'
                                ELSE tok END, ' ' ORDER BY pos) FILTER (WHERE tok NOT IN ('{{', '}}', ';')), '') || ' '
           AS words,
         max(pos) AS pos, arg_max(tok, pos) AS tok, max(line0) AS line0, arg_max(outside, pos) AS outside
  FROM mparts GROUP BY path, part
),
mflat AS (SELECT *, {flat} AS flat FROM mstatements WHERE tok IN ('{{', '}}', ';')),
mends AS (
  SELECT path, pos, tok, line0, CASE WHEN tok = '}}' THEN outside - 1 ELSE outside END AS level,
         tok = '{{' AND (regexp_matches(words, '(^|[^.]) (class|interface|enum) ')
                        OR regexp_matches(flat, ' new [^()]*# $')) AS opens_type,
         regexp_extract(words, '(?:^|[^.]) (?:class|interface|enum) ([A-Za-z_$][A-Za-z0-9_$]*) ', 1) AS type_name,
         regexp_matches(flat, ' = [^()]*$') AS assigns
  FROM mflat
),
minside AS (
  SELECT h.path, h.pos, any_value(h.method) AS method
  FROM mheads h JOIN mparts p ON p.path = h.path AND p.pos = h.pos
  JOIN mends e ON e.path = h.path AND e.tok = '{{' AND e.level = p.outside - 1 AND e.pos < h.pos
  GROUP BY h.path, h.pos
  HAVING arg_max(e.opens_type, e.pos) AND (any_value(h.typed) OR arg_max(e.type_name, e.pos) = any_value(h.method))
),
mclosed AS (
  SELECT path, pos, lead(tok) OVER w AS next_tok, lead(line0) OVER w AS close_line
  FROM mends WHERE tok <> ';' WINDOW w AS (PARTITION BY path, level ORDER BY pos)
),
mspans AS (
  SELECT *, coalesce(lag(pos) OVER (PARTITION BY path ORDER BY pos), -1) AS since
  FROM mends WHERE tok <> '}}'
),
mowned AS (
  SELECT s.path, s.pos, any_value(s.tok) AS tok, any_value(s.line0) AS line0, max(h.pos) AS owner_pos,
         arg_max(h.method, h.pos) AS owner_method
  FROM mspans s JOIN minside h ON h.path = s.path AND h.pos > s.since AND h.pos < s.pos
  WHERE NOT s.assigns GROUP BY s.path, s.pos
),
mpaired AS (
  SELECT o.*, o.tok = '{{' AND coalesce(c.next_tok = '}}', false) AS has_body, c.close_line
  FROM mowned o LEFT JOIN mclosed c ON c.path = o.path AND c.pos = o.pos
),
mbodies AS (
  SELECT path, owner_method AS method, owner_pos AS pos, CAST(line0 + 1 AS INTEGER) AS body_start_line,
         CAST(close_line - line0 - 1 AS INTEGER) AS body_line_count
  FROM mpaired WHERE has_body AND close_line - line0 - 1 >= 1
),
mskipped AS (
  SELECT path, 'all_relevant_method_bodies' AS reason FROM mbad
  UNION ALL
  SELECT DISTINCT path, 'all_relevant_method_bodies' AS reason FROM mpaired WHERE NOT has_body
)""".replace("{{", "{").replace("}}", "}")


def method_prompts_sql(k: int, seed: int = 0, files_cte: str = FILES_CTE) -> str:
    return with_(files_cte, method_ctes()) + f""",
chosen AS (
  SELECT * FROM mbodies
  ORDER BY md5(concat_ws('|', '{seed}', 'methods', path, CAST(pos AS VARCHAR))), path, pos
  LIMIT {k}
),
fl AS (SELECT path, origin, regexp_extract_all(text, '{LINE_RE}', 0) AS ls FROM files)
SELECT 'methods:' || c.path || ':' || CAST(c.pos AS VARCHAR) AS prompt_id,
       c.path, f.origin AS path_in_code_repo, c.method,
       '<PRE> ' || array_to_string(list_slice(ls, body_start_line - least(body_start_line, 50) + 1,
                                              body_start_line), '')
         || ' <SUF>' || array_to_string(list_slice(ls, body_start_line + body_line_count + 1,
                                                   body_start_line + body_line_count + 50), '')
         || ' <MID>' AS prompt,
       array_to_string(list_slice(ls, body_start_line + 1, body_start_line + body_line_count), '') AS label,
       CAST(body_start_line + 1 AS INTEGER) AS start_line,
       CAST(body_start_line + body_line_count AS INTEGER) AS end_line
FROM chosen c JOIN fl f ON f.path = c.path"""


def test_files_cte(out_dir: str) -> str:
    """Test split of the stand-in corpus under its original paths."""
    all_files = FILES_CTE.replace("\nfiles AS (", "\nall_files AS (")
    split = SPLIT_CTE.replace("FROM files", "FROM all_files")
    return all_files + "," + split + f""",
test_map AS (
  SELECT path AS old_path,
         '{out_dir}/' || split || '/' || CAST(split_id AS VARCHAR) || '_' || file_name AS new_path
  FROM split_files WHERE split = 'test'
),
files AS (
  SELECT f.path, f.path AS origin, f.file_name, f.module, f.text
  FROM all_files f JOIN test_map m ON m.old_path = f.path
)"""


def method_sql(q) -> dict[str, str]:
    k = q.METHODS_K
    test_files = """
mapping AS (
  SELECT path AS old_path,
         '""" + q.OUT_DIR + """/' || split || '/' || CAST(split_id AS VARCHAR) || '_' || file_name AS new_path
  FROM split_files WHERE split = 'test'
),
test_files AS (
  SELECT m.new_path AS path, f.text FROM files f JOIN mapping m ON m.old_path = f.path
)"""
    tf = test_files_cte(q.OUT_DIR)
    sampled = f"""
lp AS ({line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, True, q.SEED, tf)}),
tp AS ({token_prompts_sql(q.TOKENS_K, q.NUM_LABEL_TOKENS, q.SEED, files_cte=tf)}),
mp AS ({method_prompts_sql(q.METHODS_K, q.SEED, tf)}),
sampled AS (
  SELECT 'lines' AS kind, prompt_id, path, prompt, label FROM lp
  UNION ALL SELECT 'tokens', prompt_id, path, prompt, label FROM tp
  UNION ALL SELECT 'methods', prompt_id, path, prompt, label FROM mp
)"""
    lost = f"regexp_matches(path, '{q.UNMAPPED}')"
    skipped = with_(FILES_CTE, SPLIT_CTE, test_files, method_ctes("test_files"), TOKENS_CTE.replace(
        "FROM files\n)", "FROM test_files\n)", 1), sampled) + f""",
skipped AS (
  SELECT m.old_path, s.reason FROM (
    SELECT path, 'these_relevant_token_indices' AS reason FROM bad
    UNION ALL SELECT path, reason FROM mskipped) s
  JOIN mapping m ON m.new_path = s.path
  UNION ALL
  SELECT path, rtrim(kind, 's') || '_removal_prompts' FROM sampled WHERE {lost}
)"""
    return {
        "placed_prompts": with_(FILES_CTE, SPLIT_CTE, test_files, sampled) + f"""
SELECT kind || ':' || new_path || regexp_extract(prompt_id, ':[0-9]+$') AS prompt_id, kind, new_path AS path,
       path AS path_in_code_repo, md5(prompt) AS prompt_md5, label
FROM sampled JOIN mapping ON old_path = path WHERE NOT {lost}""",
        "constructor_bodies": with_(FILES_CTE, method_ctes(constructors=True)) + """
SELECT path, method, CAST(pos AS INTEGER) AS name_pos, body_start_line + 1 AS start_line,
       body_start_line + body_line_count AS end_line
FROM mbodies""",
        "method_bodies": with_(FILES_CTE, method_ctes()) + """
SELECT path, method, CAST(pos AS INTEGER) AS name_pos, body_start_line + 1 AS start_line,
       body_start_line + body_line_count AS end_line
FROM mbodies""",
        "method_prompts": method_prompts_sql(k),
        "skipped_union": skipped + "\nSELECT old_path, reason FROM skipped",
        "skip_counts": skipped + "\nSELECT reason, count(*) AS n_skipped FROM skipped GROUP BY reason",
    }


GRAPH_CTE = """
gnodes AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id, 'part' AS kind, CAST(p_size AS INTEGER) AS size FROM part
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR) AS id, 'supplier' AS kind, CAST(s_nationkey AS INTEGER) AS size
  FROM supplier
),
gedges AS (
  SELECT 's' || CAST(l_suppkey AS VARCHAR) AS src, 'p' || CAST(l_partkey AS VARCHAR) AS dst,
         count(*) AS n_lines
  FROM lineitem GROUP BY l_suppkey, l_partkey
),
gsym AS (SELECT src AS a, dst AS b FROM gedges UNION SELECT dst AS a, src AS b FROM gedges)"""


def graph_match_sql(q) -> dict[str, str]:
    sel = q.GRAPH_SELECTED
    names = with_(FILES_CTE) + r""",
apps AS (SELECT DISTINCT file_name AS app FROM files WHERE NOT contains(lower(file_name), 'test')),
tests AS (
  SELECT DISTINCT file_name AS test, regexp_replace(file_name, 'test|Test|TEST', '', 'g') AS key
  FROM files WHERE contains(lower(file_name), 'test')
)"""
    lp = line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, True, q.SEED)
    return {
        "test_match_pairs": names + "\nSELECT DISTINCT a.app, t.test FROM tests t JOIN apps a ON a.app = t.key",
        "apps_without_tests": names + "\nSELECT app FROM apps WHERE app NOT IN (SELECT key FROM tests)",
        "tests_without_apps": names + "\nSELECT DISTINCT test FROM tests WHERE key NOT IN (SELECT app FROM apps)",
        "neighbourhood_tiers": with_(GRAPH_CTE) + f""",
h1 AS (SELECT DISTINCT b AS id FROM gsym WHERE a = '{sel}'),
h2 AS (SELECT DISTINCT s.b AS id FROM h1 JOIN gsym s ON s.a = h1.id),
reached AS (
  SELECT id, min(hop) AS hop FROM (
    SELECT id, 0 AS hop FROM gnodes WHERE id = '{sel}'
    UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) x
  GROUP BY id
)
SELECT n.id, CAST(r.hop AS INTEGER) AS hop,
       CASE r.hop WHEN 0 THEN 'self' WHEN 1 THEN '1-hop' WHEN 2 THEN '2-hop' ELSE 'rest' END AS tier
FROM gnodes n LEFT JOIN reached r ON r.id = n.id""",
        "node_property_filter": with_(GRAPH_CTE) + """
SELECT id FROM gnodes WHERE size IS NOT NULL AND size <> 0 AND CAST(size AS VARCHAR) IN ('0', '5', '10', '20')""",
        "edge_property_filter": with_(GRAPH_CTE) + """
SELECT DISTINCT id FROM (
  SELECT src AS id FROM gedges WHERE n_lines <> 0 AND CAST(n_lines AS VARCHAR) IN ('2', '3')
  UNION ALL SELECT dst FROM gedges WHERE n_lines <> 0 AND CAST(n_lines AS VARCHAR) IN ('2', '3')) x""",
        "visible_flag": with_(GRAPH_CTE) + """,
sel AS (
  SELECT src AS id FROM gedges WHERE n_lines <> 0 AND CAST(n_lines AS VARCHAR) = '4'
  UNION SELECT dst FROM gedges WHERE n_lines <> 0 AND CAST(n_lines AS VARCHAR) = '4'
)
SELECT n.id, (n.id IN (SELECT id FROM sel)) OR (SELECT count(*) FROM sel) = 0 AS visible FROM gnodes n""",
        "edited_builds": f"""
WITH lp AS ({lp}),
{FILES_CTE.strip()},
fl AS (SELECT path, text, regexp_extract_all(text, '{LINE_RE}', 0) AS ls FROM files),
done AS (
  SELECT lp.prompt_id, lp.path, lp.label, lp.start_line, s AS sample_idx, CASE WHEN s = 2 THEN lp.label ELSE
         split_part(regexp_extract(substr(split_part(prompt, ' <SUF>', 1), 7), '[^\\n]*\\n?\\z', 0),
                    chr(10) || chr(10) || chr(10), 1) END AS completion
  FROM lp CROSS JOIN (VALUES (0), (1), (2)) v(s)
),
ed AS (
  SELECT d.*, substr(f.text, 1, off) || d.completion || substr(f.text, off + length(d.label) + 1) AS edited
  FROM (SELECT d.*, f.text, length(array_to_string(list_slice(f.ls, 1, d.start_line - 1), '')) AS off
        FROM done d JOIN fl f ON f.path = d.path) d JOIN fl f ON f.path = d.path
),
keyed AS (SELECT *, sha256(path || chr(10) || edited) AS build_key FROM ed)
SELECT prompt_id, CAST(sample_idx AS INTEGER) AS sample_idx, split_part(path, '/', 1) AS module, build_key,
       substr(build_key, 1, 1) < '8' AS built, CAST(length(edited) AS BIGINT) AS edited_chars FROM keyed""",
        "splice_completion": f"""
WITH lp AS ({lp}),
{FILES_CTE.strip()},
fl AS (SELECT path, text, regexp_extract_all(text, '{LINE_RE}', 0) AS ls FROM files),
done AS (
  SELECT lp.prompt_id, lp.path, lp.label, lp.start_line,
         split_part(regexp_extract(substr(split_part(prompt, ' <SUF>', 1), 7), '[^\\n]*\\n?\\z', 0),
                    chr(10) || chr(10) || chr(10), 1) AS completion
  FROM lp
),
ed AS (
  SELECT d.prompt_id, f.text, d.label, d.completion,
         length(array_to_string(list_slice(f.ls, 1, d.start_line - 1), '')) AS off
  FROM done d JOIN fl f ON f.path = d.path
)
SELECT prompt_id,
       md5(substr(text, 1, off) || completion || substr(text, off + length(label) + 1)) AS edited_md5,
       CAST(length(substr(text, 1, off) || completion || substr(text, off + length(label) + 1)) AS BIGINT)
         AS edited_chars,
       md5(replace(text, label, completion)) AS legacy_md5
FROM ed""",
    }


COMPLETER_SQL = (r"split_part(regexp_extract(substr(split_part(prompt, ' <SUF>', 1), 7), '[^\n]*\n?\z', 0),"
                 " chr(10) || chr(10) || chr(10), 1)")


def scorecard_sql(q) -> dict[str, str]:
    tf = test_files_cte(q.OUT_DIR)
    lp = line_prompts_sql(q.LINES_K, q.NUM_LABEL_LINES, True, q.SEED, tf)
    tp = token_prompts_sql(q.TOKENS_K, q.NUM_LABEL_TOKENS, q.SEED, files_cte=tf)
    mp = method_prompts_sql(q.METHODS_K, q.SEED, tf)
    count_expr = ("CAST(len(regexp_split_to_array(replace(coalesce({c}, 'nan'), '<EOT>', ''), '"
                  + SPLIT_RE + "')) AS DOUBLE)")
    pairs = f"""
lp AS ({lp}),
tp AS ({tp}),
mp AS ({mp}),
prompts AS (
  SELECT prompt_id, 'lines' AS kind, prompt, label FROM lp
  UNION ALL SELECT prompt_id, 'tokens' AS kind, prompt, label FROM tp
  UNION ALL SELECT prompt_id, 'methods' AS kind, prompt, label FROM mp
),
pairs AS (SELECT prompt_id, kind, label, {COMPLETER_SQL} AS completion FROM prompts)"""
    model = q.SCORECARD_MODEL.replace("/", "-")
    return {
        "scorecard_summary": with_(pairs, score_ctes()) + f""",
ev AS (
  SELECT '{q.SCORECARD_RUN}_' || p.kind || '_df_{model}_output' AS rn, s.*, p.label,
         replace(p.completion, chr(10) || ' <EOT>', '') AS completion
  FROM scored5 s JOIN pairs p ON p.prompt_id = s.prompt_id
)
""" + _summary_select(
            "rn", "count(*)",
            {"ngram_match_score": "avg(ngram_match_score)",
             "weighted_ngram_match_score": "avg(weighted_ngram_match_score)",
             "syntax_match_score": "avg(syntax_match_score)",
             "dataflow_match_score": "avg(dataflow_match_score)",
             "label_token_count": "avg(" + count_expr.format(c="label") + ")",
             "completion_token_count": "avg(" + count_expr.format(c="completion") + ")"},
            None, ("avg(codebleu)", "stddev_samp(codebleu)"), _ptype("rn")) + "\nFROM ev GROUP BY rn",
    }
