"""Text -> candidate positions (T1-T6): which lines, tokens and method bodies may be masked.

Input everywhere is a files table with at least ``path`` and ``text``.
Candidates carry only ``(path, position)``; text is joined back after sampling.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from holecard.functions.lexer import ILLEGAL_TOKENS, JAVA_KEYWORDS, code_places, lex_ok, scan_all, scan_tokens
from holecard.functions.text import WS, normalize_newlines, split_lines


def _exploded(array: str) -> Column:
    """A row per element.  The optimizer puts a filter on the size of an array
    column that is exploded as it is below the projections that compute it, so
    that they run again for the filter; an expression is left alone."""
    return F.explode(F.transform(array, lambda x: x))


# --- fixed values: one character per surviving line, and the comment runs ---
# O opens a block comment, C closes one, B does both, N neither.  A run that
# starts with O lasts until the first C or B (inclusive); a lone B is a
# one-line comment; every other line is code.
COMMENT_RUNS = r"O[NO]*[CB]?|B|[NC]"


def line_candidates(files: DataFrame, num_label_lines: int = 1, min_lines_above: int = 1,
                    min_lines_below: int = 1) -> DataFrame:
    """Maskable line indices per file -> ``(path, line_idx)``.

    (a) drop blank lines and lines whose stripped text starts with ``//``,
    ``#``, ``import`` or ``package``; (b) among the survivors, drop lines inside
    a block comment (a line starting ``/*`` opens, a line ending ``*/`` closes
    after itself); (c) keep survivors ranked in
    ``[min_lines_above + 1, count - (num_label_lines + min_lines_below))``.

    Row-local, no shuffle: the comment state over the survivors is a regular
    language, so each survivor is written as one character (see
    ``COMMENT_RUNS``), the string is cut into runs by one regex, and the runs
    are expanded back to one in-comment flag per survivor.
    """
    found = _line_indices(files.select("path", split_lines("text").alias("_lines")), ["path"], num_label_lines,
                          min_lines_above, min_lines_below)
    return found.select("path", _exploded("_line_idx").alias("line_idx"))


def _line_indices(files: DataFrame, keep_cols: list[str], num_label_lines: int, min_lines_above: int,
                  min_lines_below: int) -> DataFrame:
    """``keep_cols`` and ``_line_idx``, the maskable indices of the array ``_lines``."""
    if num_label_lines + min_lines_below <= 0:
        raise ValueError("num_label_lines + min_lines_below must be positive")

    def kind(l):
        opens = l.rlike(rf"^{WS}*/\*")
        closes = l.rlike(rf"\*/{WS}*$")
        return F.when(opens & closes, "B").when(opens, "O").when(closes, "C").otherwise("N")

    keep = lambda l: ~l.rlike(rf"^{WS}*$") & ~l.rlike(rf"^{WS}*(//|#|import|package)")
    survivors = F.filter(F.transform("_lines", lambda l, i: F.when(
        keep(l), F.struct(i.alias("i"), kind(l).alias("k")))), lambda s: s.isNotNull())
    staged = files.select(*keep_cols, survivors.alias("_s"))
    runs = F.regexp_extract_all(F.array_join(F.transform("_s", lambda s: s["k"]), ""),
                                F.lit(COMMENT_RUNS), 0)
    in_comment = F.flatten(F.transform(runs, lambda r: F.array_repeat(r.rlike("^[OB]"), F.length(r))))
    flagged = staged.select(*keep_cols, "_s", in_comment.alias("_c"))
    relevant = F.filter(F.zip_with("_s", "_c", lambda s, c: F.when(~c, s["i"])), lambda i: i.isNotNull())
    ranked = flagged.select(*keep_cols, relevant.alias("_r"))
    length = F.greatest(F.size("_r") - (min_lines_above + 1) - (num_label_lines + min_lines_below),
                        F.lit(0))
    return ranked.select(*keep_cols, F.slice("_r", min_lines_above + 2, length).alias("_line_idx"))


# --- fixed values: words that begin an import or package statement ---
IMPORT_WORDS = ("import", "package")


def token_candidates(files: DataFrame, num_label_tokens: int = 1, min_tokens_before: int = 1,
                     min_tokens_after: int = 1, skip_import_lines: bool = False) -> DataFrame:
    """Maskable token indices -> ``(path, token_idx, token)``.

    ``token_idx`` counts code tokens (no whitespace, no comments) from 0, as the
    Java lexer numbers them.  The words ``import`` and ``package`` are not
    maskable; with ``skip_import_lines`` no token of their statements is, up to
    the ``;`` (Q6).  The rest is trimmed by rank like T2.  Files that fail to
    lex give no candidates (see :func:`token_lex_failures`).  Row-local: no
    shuffle.
    """
    _check_margins(num_label_tokens, min_tokens_after)

    def read(text: str):
        toks, ok = scan_tokens(text)
        kept = _maskable(toks, num_label_tokens, min_tokens_before, min_tokens_after, skip_import_lines) if ok else []
        return kept, [toks[i] for i in kept]

    return _rows_of_texts(files.select("path", "text"), read, "token_idx int, token string")


def _check_margins(num_label_tokens: int, min_tokens_after: int) -> None:
    if num_label_tokens + min_tokens_after <= 0:
        raise ValueError("num_label_tokens + min_tokens_after must be positive")


def _maskable(toks: list[str], num_label_tokens: int, min_tokens_before: int, min_tokens_after: int,
              skip_import_lines: bool) -> list[int]:
    """Maskable indices of the code tokens of a text that lexes."""
    kept, inside = [], False
    for i, t in enumerate(toks):
        if t in IMPORT_WORDS:
            inside = skip_import_lines
        elif not inside:
            kept.append(i)
        elif t == ";":
            inside = False
    length = max(len(kept) - min_tokens_before - (num_label_tokens + min_tokens_after), 0)
    return kept[min_tokens_before:min_tokens_before + length]


#: Rows that a task gathers into one Arrow batch.
BATCH_ROWS = 1 << 15


def _rows_of_texts(files: DataFrame, read: Callable, columns: str) -> DataFrame:
    """``(path, *columns)``: the rows that ``read`` makes of each text, as one
    list or array per column; the first two columns of ``files`` are path and
    text, any others go to ``read`` as well.  Files without text have no rows.

    Row-local over Arrow batches, linear in the text; a row carries its path
    and its own values, never the arrays of its file.
    """
    schema = files.sparkSession.createDataFrame([], columns).schema
    arrow = to_arrow_schema(T.StructType([T.StructField("path", T.StringType()), *schema]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, *rest = batch.columns
            owners, found, size = [], [], 0
            for k, row in enumerate(zip(*(c.to_pylist() for c in rest))):
                if row[0] is not None:
                    cols = read(*row)
                    owners.append(np.full(len(cols[0]), k))
                    found.append(cols)
                    size += len(cols[0])
                if found and (size > BATCH_ROWS or k == batch.num_rows - 1):
                    out = [paths.take(pa.array(np.concatenate(owners)))]
                    for f, parts in zip(list(arrow)[1:], zip(*found)):
                        out.append(pa.chunked_array([pa.array(p, f.type) for p in parts], f.type).combine_chunks())
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out, arrow)], schema=arrow)
                    owners, found, size = [], [], 0

    return files.mapInArrow(work, f"path string, {columns}")


def token_places(files: DataFrame) -> DataFrame:
    """``(path, token_idx, token, line, column, offset)`` of every code
    token of the files that lex; lines and columns from 1, offsets from 0, in
    the text with ``\\n`` line ends.  Row-local."""
    def read(text: str):
        toks, ok = scan_all(text)
        at = code_places(toks) if ok else []
        sizes = np.fromiter(map(len, toks), np.int64, len(toks))
        offsets = (np.cumsum(sizes) - sizes)[at]
        starts = np.array([0, *(m.end() for m in re.finditer("\n", text))])
        line = np.searchsorted(starts, offsets, side="right")
        return (np.arange(len(at), dtype=np.int32), [toks[i] for i in at], line.astype(np.int32),
                (offsets - starts[line - 1] + 1).astype(np.int32), offsets)

    return _rows_of_texts(files.select("path", normalize_newlines("text").alias("text")), read,
                          "token_idx int, token string, line int, column int, offset long")


# --- fixed values: reasons of skipped files ---
NO_TOKENS, NO_METHODS = "these_relevant_token_indices", "all_relevant_method_bodies"


def token_lex_failures(files: DataFrame) -> DataFrame:
    """T5 (token part): files the lexer rejects -> ``(path, reason)``.

    Rows are dropped by exploding an empty array, not by a Filter, which
    Catalyst would push into the scan stage with the tokeniser inlined.
    """
    return files.select("path", F.explode(F.when(~lex_ok("text"), F.array(F.lit(NO_TOKENS)))).alias("reason"))


# --- fixed values: Java primitive type names (a method name may follow them) ---
PRIMITIVE_TYPES = "void boolean byte char short int long float double".split()
# --- fixed values: words that declare a type ---
TYPE_WORDS = ("class", "interface", "enum")


def method_bodies(files: DataFrame, include_constructors: bool = False) -> tuple[DataFrame, DataFrame]:
    """T4: method bodies -> ``(path, method, pos, body_start_line, body_line_count)``
    and the skipped table ``(path, reason)``.

    A method header is a name token that is followed by ``(`` and preceded by
    a type (an identifier, a primitive type, ``>`` or ``]``), directly inside
    a type body.  So, as in the reference (Q5), constructors are not methods;
    with ``include_constructors`` a name before ``(`` that equals the name of
    the type whose body it lies in is one, too.  A type body is opened by the ``{`` of a class, interface or enum
    (its keyword stands since the last ``{``, ``}`` or ``;``) or of an
    anonymous class (a ``new`` stands there under the same number of open
    parentheses, and ``)`` just before).  Enum constants have no type body here.

    The body is opened by the first ``{`` after the name unless a ``;`` comes
    first (abstract or interface method: no body, the file is reported as
    skipped, Q13).  A ``{`` or ``;`` belongs to the last header before it with
    no other in between, and to none if an ``=`` stands before it (since the
    last ``{``, ``}`` or ``;``, under the same number of open parentheses):
    that is an initialiser.  The matching ``}`` is found without a per-method
    scan: at one brace depth of a file the braces alternate, so the next brace
    at the same depth closes, and the last ``{`` one level up encloses a
    header.  The body is the lines strictly between the two braces; 0-based
    ``body_start_line``.  One-line bodies (count < 1, Q14) are dropped.  Files
    that fail to lex are skipped.  ``pos`` is the name's position in the
    file's token list.

    Row-local first: headers come from each code token's neighbours, and the
    other marks from one pass that writes down what stands between them:
    newlines, parentheses, and ``-`` for anything else.  Only marks, with the
    counts of newlines and parentheses before each, reach the per-file windows
    and their one shuffle.
    """
    # a missing text is one that does not lex
    read = files.select("path", F.coalesce(normalize_newlines("text"), F.lit(ILLEGAL_TOKENS[0])).alias("text"))
    return bodies_of_marks(_rows_of_texts(read, lambda text: _marks(*scan_all(text), include_constructors),
                                          "mark string, method string"))


#: The mark of a file that does not lex.
LEX_FAILED = "\u0001-1!"


_KEYWORDS = frozenset(JAVA_KEYWORDS)
_NAME_STARTS = frozenset(string.ascii_letters + "_$")


def _is_name(t: str) -> bool:
    return t[0] in _NAME_STARTS and t not in _KEYWORDS


def _marks(toks: list[str], ok: bool, include_constructors: bool) -> tuple[list, list]:
    """Marks of a text's tokens and the names of those that are headers.

    A mark is what stands since the one before it, U+0001, position and kind.
    """
    if not ok:
        return [LEX_FAILED], [None]
    marks, names, gap = [], [], []
    code = code_places(toks)
    is_code = set(code)
    for p, t in enumerate(toks):
        if p not in is_code:
            gap.append("\n" * t.count("\n"))
            continue
        kind = t if t in _BRACES else "K" if t in TYPE_WORDS else "N" if t == "new" else None
        if kind:
            marks.append(f"{''.join(gap)}\u0001{p}{kind}")
            gap = []
        elif t in _KEPT:
            gap.append(t)
        elif not gap or gap[-1] != "-":
            gap.append("-")
    names = [None] * len(marks)
    before = None
    for k, at in enumerate(code):
        t, kind = toks[at], None
        if before is not None and _is_name(t):
            if k + 1 < len(code) and toks[code[k + 1]] == "(":
                # H: a method's header; C: a constructor's, if the type has its name
                if _is_name(before) or before in _TYPE_ENDS:
                    kind = "H"
                elif include_constructors and before not in ("new", "."):
                    kind = "C"
            elif include_constructors and before in TYPE_WORDS:
                kind = "T"
        if kind:
            marks.append(f"\u0001{at}{kind}")
            names.append(t)
        before = t
    return marks, names


_BRACES, _KEPT = frozenset("{};="), frozenset("().")
_TYPE_ENDS = frozenset((*PRIMITIVE_TYPES, ">", "]"))

#: Partitions of the marks per core.  Left alone, the shuffle is coalesced by its
#: compressed size, and a task's four sorts hold many times that in memory.
MARK_PARTITIONS = 16


def bodies_of_marks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The windows of :func:`method_bodies` over its rows ``(path, mark, method)``."""
    rows = rows.select("path", "method", F.substring_index("mark", "\u0001", 1).alias("_gap"),
                       F.substring_index("mark", "\u0001", -1).alias("_at"))
    count = lambda c: F.length("_gap") - F.length(F.replace(F.col("_gap"), F.lit(c), F.lit("")))
    rows = rows.select(
        "path", F.expr("left(_at, length(_at) - 1)").cast("int").alias("pos"), F.right("_at", F.lit(1)).alias("tok"),
        "method", count("\n").alias("_newlines"), (count("(") - count(")")).alias("_open"),
        F.right(F.rtrim("_gap", F.lit("\n")), F.lit(1)).alias("_left"))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(MARK_PARTITIONS * cores, "path")
    bad = rows.where(F.col("tok") == "!").select("path", F.lit(NO_METHODS).alias("reason"))

    w = Window.partitionBy("path").orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos_of = lambda cond: F.max(F.when(cond, F.col("pos"))).over(before)
    delta = F.when(F.col("tok") == "{", 1).when(F.col("tok") == "}", -1).otherwise(0)
    is_term = F.col("tok").isin("{", ";")
    # one pass in file order: line, brace depth and open parentheses
    scanned = rows.where(F.col("tok") != "!").select(
        "*",
        F.sum("_newlines").over(so_far).cast("int").alias("line0"),
        F.sum(delta).over(so_far).alias("depth"),
        F.sum("_open").over(so_far).alias("_parens"),
        pos_of(is_term).alias("_last_term"),
        F.coalesce(pos_of(F.col("tok").isin("{", "}", ";")), F.lit(-1)).alias("_from"),
        # Foo.class is no declaration
        pos_of((F.col("tok") == "K") & (F.col("_left") != ".")).alias("_type"),
        F.max(F.when(F.col("tok") == "T", F.struct("pos", "method"))).over(before).alias("_named"))
    # under the same number of open parentheses
    beside = Window.partitionBy("path", "_parens").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    beside_pos = lambda kind: F.max(F.when(F.col("tok") == kind, F.col("pos"))).over(beside)
    opens_type = (F.col("_type") > F.col("_from")) \
        | ((beside_pos("N") > F.col("_from")) & (F.col("_left") == ")"))
    # the name of the type follows its keyword
    type_name = F.when(F.col("_named")["pos"] > F.col("_type"), F.when(
        F.col("_type") > F.col("_from"), F.col("_named")["method"]))
    scanned = scanned.withColumn("_opens_type", F.struct(
        F.coalesce(opens_type, F.lit(False)).alias("type"), type_name.alias("name"))) \
        .withColumn("_assigns", F.coalesce(beside_pos("=") > F.col("_from"), F.lit(False)))
    # at one depth of a file braces alternate "{", "}": the next one closes an
    # opening one; a header lies one level below the brace that encloses it
    level = F.when(F.col("tok").isin("{", "H", "C"), F.col("depth") - 1).when(F.col("tok") == "}", F.col("depth"))
    brace = F.when(F.col("tok").isin("{", "}"), F.struct("tok", "line0"))
    wl = Window.partitionBy("path", "level").orderBy("pos")
    placed = scanned.withColumn("level", level).withColumn("_brace", brace).select(
        "*",
        F.last(F.when(F.col("tok") == "{", F.col("_opens_type")), ignorenulls=True)
        .over(wl.rowsBetween(Window.unboundedPreceding, -1)).alias("_within"),
        F.expr("lead(_brace) IGNORE NULLS OVER (PARTITION BY path, level ORDER BY pos)").alias("_close"))
    # the header that a terminator closes
    is_head = (F.col("tok") == "H") | ((F.col("tok") == "C") & (F.col("_within")["name"] == F.col("method")))
    head = F.last(F.when(is_head & F.col("_within")["type"], F.struct("pos", "method")), ignorenulls=True).over(before)
    owned = placed.withColumn("_head", head).where(is_term)
    owner = F.when(~F.col("_assigns") & (F.col("_head")["pos"] > F.coalesce("_last_term", F.lit(-1))),
                   F.col("_head"))
    ended = owned.select("path", "tok", "line0", "_close", owner.alias("_owner")) \
        .where(F.col("_owner").isNotNull())
    has_body = (F.col("tok") == "{") & F.coalesce(F.col("_close")["tok"] == "}", F.lit(False))
    bodies = ended.where(has_body).select(
        "path", F.col("_owner")["method"].alias("method"), F.col("_owner")["pos"].alias("pos"),
        (F.col("line0") + 1).cast("int").alias("body_start_line"),
        (F.col("_close")["line0"] - F.col("line0") - 1).cast("int").alias("body_line_count"),
    ).where(F.col("body_line_count") >= 1)
    # a file with a header that opens no body (abstract or interface method)
    no_body = ended.groupBy("path").agg(F.max(~has_body).alias("_missing")).where("_missing").select(
        "path", F.lit(NO_METHODS).alias("reason"))
    return bodies, bad.unionByName(no_body)


def prompt_candidates(files: DataFrame, num_label_lines: int = 1, num_label_tokens: int = 1,
                      include_constructors: bool = False, skip_import_lines: bool = False) -> DataFrame:
    """T1-T5 of all kinds from one lexing: ``(path, kind, idx, mark, method)``.

    ``lines`` and ``tokens`` rows hold a maskable index, ``marks`` rows what
    :func:`bodies_of_marks` reads, and ``skipped`` rows the reason in ``mark``
    of a file whose tokens cannot be told.  One generator emits a file's rows;
    write them once (by ``kind``) and read each kind from there.
    """
    _check_margins(num_label_tokens, 1)
    staged = files.select("path", normalize_newlines("text").alias("_t")) \
        .select("path", "_t", split_lines("_t").alias("_lines"))
    staged = _line_indices(staged, ["path", "_t"], num_label_lines, 1, 1)

    def read(text: str, lines: list[int]):
        toks, ok = scan_all(text)
        code = [toks[i] for i in code_places(toks)]
        tokens = _maskable(code, num_label_tokens, 1, 1, skip_import_lines) if ok else []
        marks, names = _marks(toks, ok, include_constructors)
        skipped = [] if ok else [NO_TOKENS]
        no_idx, none = [None] * (len(marks) + len(skipped)), [None] * (len(lines) + len(tokens))
        kinds = ["lines"] * len(lines) + ["tokens"] * len(tokens) + ["marks"] * len(marks) + ["skipped"] * len(skipped)
        return kinds, [*lines, *tokens, *no_idx], [*none, *marks, *skipped], [*none, *names, *[None] * len(skipped)]

    return _rows_of_texts(staged, read, "kind string, idx int, mark string, method string")
