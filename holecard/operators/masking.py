"""Masking: a span of a file -> (prompt, label) (M1-M7).

All functions add columns to rows that carry the file ``text`` next to the
chosen position; they are row-local array and string expressions (no shuffle).
Line numbers in the output are 1-based and inclusive, as in the reference
tables (``start_line``/``end_line``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holecard.functions.lexer import all_tokens, indices_where, is_code_token
from holecard.functions.text import col, count_char, join_slice, normalize_newlines, split_lines

# --- fixed values: fill-in-the-middle prompt markers ---
PRE, SUF, MID = "<PRE> ", " <SUF>", " <MID>"


def fim_prompt(prefix: Column, suffix: Column, infill: bool = True) -> Column:
    """M1 template: ``<PRE> {prefix} <SUF>{suffix} <MID>``, or the prefix only."""
    if infill:
        return F.concat(F.lit(PRE), prefix, F.lit(SUF), suffix, F.lit(MID))
    return prefix


def line_mask(lines, idx, n, infill: bool = True, max_lines_above: int = 50,
              max_lines_below: int = 50) -> dict[str, Column]:
    """M2: mask ``n`` lines from 0-based ``idx`` of the ``lines`` array.

    The prompt keeps at most ``max_lines_above`` lines before and
    ``max_lines_below`` lines after the label.  Without infill the label is
    the whole rest of the file (reference behaviour).
    """
    lines, idx = col(lines), col(idx)
    n = F.lit(n) if isinstance(n, int) else col(n)
    pre_len = F.least(idx, F.lit(max_lines_above))
    prefix = join_slice(lines, idx - pre_len + 1, pre_len)
    suffix = join_slice(lines, idx + n + 1, F.lit(max_lines_below))
    if infill:
        label = join_slice(lines, idx + 1, n)
    else:
        label = join_slice(lines, idx + 1, F.size(lines) - idx)
    return {
        "prompt": fim_prompt(prefix, suffix, infill),
        "label": label,
        "start_line": (idx + 1).cast("int"),
        "end_line": (idx + n).cast("int"),
    }


def mask_lines(df: DataFrame, idx: str = "line_idx", n=1, infill: bool = True,
               max_lines_above: int = 50, max_lines_below: int = 50,
               text: str = "text") -> DataFrame:
    """M2/M4/M5 on a DataFrame with ``text`` and a 0-based line index column."""
    with_lines = df.withColumn("_lines", split_lines(text))
    cols = line_mask("_lines", idx, n, infill, max_lines_above, max_lines_below)
    return with_lines.select("*", *[c.alias(k) for k, c in cols.items()]).drop("_lines")


def mask_span(df: DataFrame, start: str, end: str, infill: bool = True,
              max_lines_above: int = 50, max_lines_below: int = 50, text: str = "text") -> DataFrame:
    """M5: mask the lines ``[start, end)`` (0-based) given explicitly, e.g. a
    method declaration span."""
    return mask_lines(df.withColumn("_n", F.col(end) - F.col(start)), start, "_n", infill,
                      max_lines_above, max_lines_below, text).drop("_n")


def mask_tokens(df: DataFrame, idx: str = "token_idx", num_label_tokens: int = 1,
                infill: bool = True, max_lines_above: int = 50, max_lines_below: int = 50,
                text: str = "text") -> DataFrame:
    """M3: mask ``num_label_tokens`` code tokens starting at code token ``idx``.

    The label runs from the first character of the first token to the last
    character of the last one, whitespace and comments between included.  The
    partial line before (after) the label counts as one context line.
    """
    n = num_label_tokens
    df = df.withColumn(text, normalize_newlines(text))  # offsets and lines of one text
    t = F.col(text)
    toks = F.col("_all")
    code_pos = indices_where(toks, is_code_token)
    p_first = F.element_at(F.col("_code_pos"), F.col(idx) + 1)
    p_last = F.element_at(F.col("_code_pos"), F.col(idx) + n)
    start_off = F.length(F.array_join(F.slice(toks, 1, p_first - 1), ""))
    end_off = F.length(F.array_join(F.slice(toks, 1, p_last), ""))
    last_start = end_off - F.length(F.element_at(toks, p_last))

    staged = df.withColumn("_all", all_tokens(text)) \
        .withColumn("_code_pos", code_pos) \
        .withColumn("_s", start_off).withColumn("_e", end_off).withColumn("_ls", last_start)
    before = F.substring(t, 1, F.col("_s"))
    first_line = count_char(before, "\n") + 1
    last_line = count_char(F.substring(t, 1, F.col("_ls")), "\n") + 1
    partial_pre = F.regexp_extract(before, r"[^\n]*\z", 0)
    partial_suf = F.regexp_extract(F.substring(t, F.col("_e") + 1, F.length(t)), r"^[^\n]*\n?", 0)
    lines = F.col("_lines")
    L, E = F.col("start_line"), F.col("end_line")
    full_from = F.greatest(F.lit(1), L - max_lines_above + 1)
    prefix = F.concat(join_slice(lines, full_from, L - full_from), partial_pre)
    suffix = F.concat(partial_suf, join_slice(lines, E + 1, F.lit(max_lines_below - 1)))
    if infill:
        label = F.substring(t, F.col("_s") + 1, F.col("_e") - F.col("_s"))
    else:
        label = F.substring(t, F.col("_s") + 1, F.length(t))
    return staged.withColumn("_lines", split_lines(text)) \
        .withColumn("start_line", first_line.cast("int")) \
        .withColumn("end_line", last_line.cast("int")) \
        .withColumn("prompt", fim_prompt(prefix, suffix, infill)) \
        .withColumn("label", label) \
        .drop("_all", "_code_pos", "_s", "_e", "_ls", "_lines")


def splice(text, label, completion, offset=None) -> Column:
    """M7: put ``completion`` where ``label`` was.

    With a 0-based character ``offset`` the replacement is positional (only
    that span changes).  Without one, every occurrence of the label is
    replaced, as the reference's text replace does (legacy mode).  Text and
    label are taken with ``\\n`` line ends, which offsets count.
    """
    text, label, completion = normalize_newlines(text), normalize_newlines(label), col(completion)
    if offset is None:
        return F.replace(text, label, completion)
    offset = col(offset)
    return F.concat(F.substring(text, 1, offset), completion,
                    F.substring(text, offset + F.length(label) + 1, F.length(text)))
