"""Java-like lexical tokens as a Spark column.

The tokeniser is one *total-cover* regular expression: every character of the
input belongs to exactly one match, so the concatenation of the tokens gives
the text back and character offsets are running sums of token lengths.  Java's
regex engine and RE2 (used by the SQL oracle) agree on it: no look-around, no
back-references, alternation is leftmost-first in both.

A text "fails to lex" when it holds an unterminated string or character
literal (a lone quote token), an unterminated block comment (a ``/`` token
directly followed by ``*``) or a character no Java token begins with.  Scores of such rows are null, as in the
reference, where the lexer raised.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from holecard.functions.arrays import let, running_sums
from holecard.functions.text import col, count_char, split_lines

# --- fixed values: token pattern (must stay as written to match results) ---
# String and character literals are written in "unrolled" form: plain
# characters run in a single character-class loop and only an escape starts a
# new group iteration.  ``"(?:\\.|[^"\\])*"`` matches the same language, but
# Java's regex engine recurses once per group iteration, so a literal a few
# thousand characters long would overflow the task's stack.
TOKEN_PATTERN = (
    r"//[^\n]*|/\*[\s\S]*?\*/"
    r'|"[^"\\\n]*(?:\\[\s\S][^"\\\n]*)*"'
    r"|'[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*'"
    r"|0[xX][0-9a-fA-F_]+[lL]?|0[bB][01_]+[lL]?"
    r"|[0-9][0-9_]*(?:\.[0-9][0-9_]*)?(?:[eE][+-]?[0-9]+)?[fFlLdD]?"
    r"|\.[0-9][0-9_]*(?:[eE][+-]?[0-9]+)?[fFdD]?"
    r"|[A-Za-z_$][A-Za-z0-9_$]*"
    r"|>>>=|<<=|>>=|\.\.\.|->|::|\+\+|--|&&|\|\||==|!=|<=|>=|\+=|-=|\*=|/="
    r"|<<|%=|\^=|\|=|&="
    r"|[ \t\r\n\f]+"
    r"|[\s\S]"
)

# The same language for Java's engine: a possessive group is a plain loop there,
# so the escapes of a literal need no stack, whatever its length.
SPARK_TOKEN_PATTERN = TOKEN_PATTERN \
    .replace(r'"[^"\\\n]*(?:\\[\s\S][^"\\\n]*)*"', r'"[^"\\\n]*+(?:\\[\s\S][^"\\\n]*+)*+"') \
    .replace(r"'[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*'", r"'[^'\\\n]*+(?:\\[\s\S][^'\\\n]*+)*+'")

# The same language for a scan in Python: names and white space begin with
# characters that begin no other token, so they can be tried first.
_SCAN = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*|[ \t\r\n\f]+|" + SPARK_TOKEN_PATTERN)

# --- fixed values: characters that begin no token ---
ILLEGAL_TOKENS = ("`", "#", "\\")

# --- fixed values: Java reserved words (weight 1 in the weighted n-gram match) ---
JAVA_KEYWORDS = (
    "abstract assert boolean break byte case catch char class const continue "
    "default do double else enum extends final finally float for goto if "
    "implements import instanceof int interface long native new package "
    "private protected public return short static strictfp super switch "
    "synchronized this throw throws transient try void volatile while"
).split()

KEYWORD_WEIGHT = 1.0
OTHER_WEIGHT = 0.2

SPACES = " \t\r\n\f"


def all_tokens(text) -> Column:
    """Every token of the text, whitespace and comments included."""
    return F.regexp_extract_all(col(text), F.lit(SPARK_TOKEN_PATTERN), 0)


def is_code_token(t: Column) -> Column:
    """A token the Java lexer would emit (not whitespace, not a comment).

    A token's first characters tell: only white space begins with white space,
    and only a comment with ``//`` or ``/*``.
    """
    return ~((F.instr(F.lit(SPACES), F.left(t, F.lit(1))) > 0) | t.startswith("//") | t.startswith("/*"))


def code_tokens(text) -> Column:
    """Tokens without whitespace and comments, in text order."""
    return code_tokens_of(all_tokens(text))


def code_tokens_of(toks: Column) -> Column:
    return F.filter(toks, is_code_token)


def lex_ok(text) -> Column:
    """False when the text holds an unterminated literal or block comment, or
    an illegal character."""
    return lex_ok_of(all_tokens(text))


def lex_ok_of(toks: Column) -> Column:
    """:func:`lex_ok` on an already computed token array.

    A closed comment is one token; an unclosed ``/*`` falls apart into a
    ``/`` token directly followed by a token that starts with ``*``.  That is
    found by one substring search on the tokens joined with U+0001: the
    separator can only sit next to ``/`` on both sides when ``/`` is a token
    of its own (no multi-character token ends with U+0001 or starts with
    ``/`` followed by it).
    """
    lone_quote = F.arrays_overlap(toks, F.array(*[F.lit(t) for t in ('"', "'", *ILLEGAL_TOKENS)]))
    joined = F.concat(F.lit("\u0001"), F.array_join(toks, "\u0001"))
    open_comment = joined.contains("\u0001/\u0001*")
    return ~(lone_quote | open_comment)


_BAD_TOKENS = frozenset(('"', "'", *ILLEGAL_TOKENS))


_COMMENTS = ("//", "/*")


def scan_all(text: str) -> tuple[list[str], bool]:
    """:func:`all_tokens` and :func:`lex_ok` of one Python string."""
    toks = _SCAN.findall(text)
    open_comment = "/*" in text and any(a == "/" and b[0] == "*" for a, b in zip(toks, toks[1:]))
    return toks, not open_comment and _BAD_TOKENS.isdisjoint(toks)


def code_places(toks: list[str]) -> list[int]:
    """Places of the code tokens among all tokens of a text, from 0."""
    return [i for i, t in enumerate(toks) if t[0] not in SPACES and (t[0] != "/" or t[:2] not in _COMMENTS)]


def scan_tokens(text: str) -> tuple[list[str], bool]:
    """:func:`code_tokens` and :func:`lex_ok` of one Python string."""
    toks, ok = scan_all(text)
    return [toks[i] for i in code_places(toks)], ok


def token_positions_of(toks: Column, lines: Column) -> Column:
    """Code tokens with their places: array of (token, offset, line, column).

    ``toks`` are all tokens of a text with ``\\n`` line ends and ``lines`` its
    lines.  Offsets count characters from 0, lines and columns from 1.  All
    three come from running sums: of token lengths, of the newlines in tokens,
    and of line lengths.  Row-local and linear in the text.
    """
    sizes = lambda arr: F.transform(arr, lambda t: F.length(t).cast("long"))
    newlines = F.transform(toks, lambda t: count_char(t, "\n").cast("long"))
    placed = F.zip_with(F.arrays_zip(toks.alias("t"), running_sums(sizes(toks)).alias("o")), running_sums(newlines),
                        lambda to, n: F.struct(to["t"].alias("t"), to["o"].alias("o"), n.alias("n")))
    code = F.filter(placed, lambda p: is_code_token(p["t"]))
    known = F.struct(running_sums(sizes(lines)).alias("starts"), code.alias("code"))
    return let(known, lambda k: F.transform(k["code"], lambda p: F.struct(
        p["t"].alias("token"), p["o"].alias("offset"), (p["n"] + 1).cast("int").alias("line"),
        (p["o"] - F.element_at(k["starts"], (p["n"] + 1).cast("int")) + 1).cast("int").alias("column"))))


def token_positions(text) -> Column:
    """:func:`token_positions_of` of a text with ``\\n`` line ends."""
    return token_positions_of(all_tokens(text), split_lines(text))


def indices_where(arr: Column, pred) -> Column:
    """1-based positions of the elements of ``arr`` that satisfy ``pred``."""
    return F.filter(F.transform(arr, lambda t, i: F.when(pred(t), i + 1)),
                    lambda p: p.isNotNull())
