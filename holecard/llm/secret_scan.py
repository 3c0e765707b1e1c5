"""Secrets in texts, with DataFrame functions only.

Three patterns find assigned values, access keys and long hex strings.  Beyond
them, every run of a character class (a candidate string) is read through a
sliding window: the counts of the window's characters change by the one that
enters and the one that leaves, and with them the sum of c log2 c from which
the Shannon entropy follows.  Windows of an entropy above the class's threshold
are joined into spans.  Candidates on the allow-list are suppressed.

Everything stays in the text's own row: no shuffle and no Python worker.  A
text is as long as it is; the work grows with its length.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Kind(NamedTuple):
    """A pattern; matches whose ``group`` has under ``least`` characters are dropped.

    A match holds one of the strings ``needs``, if any; texts without them
    aren't searched.
    """

    name: str
    pattern: str
    group: int
    least: int
    needs: tuple[str, ...] = ()


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_key")).replace("_", "_?")
KINDS = (
    Kind("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, (":", "=")),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", 0, 24),  # whole runs, the short ones left out at once
)


class CharClass(NamedTuple):
    """Candidates are the longest runs of ``symbols``; ``bits`` of entropy in a
    window of ``window`` characters mark it, if it holds a digit and a letter.
    The symbols begin with the ten digits."""

    name: str
    symbols: str
    window: int
    bits: float

    def pattern(self) -> str:
        one = "[" + "".join("\\" + c if c in "-+/" else c for c in self.symbols) + "]"
        return f"(?<!{one}){one}{{{self.window},}}+"

    def marks(self) -> int:
        """The largest sum of scaled c log2 c whose entropy is above ``bits``."""
        return math.floor((math.log2(self.window) - self.bits) * self.window * SCALE)


#: Fixed values of the method: classes, their windows and thresholds.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdefABCDEF", 20, 3.0),
    CharClass("entropy_upper", DIGITS + UPPER, 20, 3.7),
    CharClass("entropy_base64", DIGITS + UPPER + LOWER + "+/_=-", 24, 4.0),
)
#: Candidates that match one of these as a whole, or hold such a string, are no secrets.
ALLOW = (
    r"(?s).*EXAMPLE.*",
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?s).*0123456789[aA][bB][cC][dD][eE][fF].*",
    r"(?s).*[aA][bB][cC][dD][eE][fF][gG][hH][iI][jJ][kK][lL][mM].*",
)
#: Entropy sums are whole numbers: c log2 c, times this, rounded.
SCALE = 1 << 20
#: Spans that one step of a running sum adds up; sums of these parts are added first.
_CHUNK = 256


def scaled(window: int) -> list[int]:
    """c log2 c of the counts 0 to ``window``, as whole numbers."""
    return [0] + [round(c * math.log2(c) * SCALE) for c in range(1, window + 1)]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _running(sizes: Column) -> Column:
    """Sum of the sizes before each place; the work is linear in all but name:
    parts of ``_CHUNK`` are added up, then the places in each part."""
    none = F.array().cast("array<long>")

    def sums(values: Column, start: Column) -> Column:
        state = F.struct(start.cast("long").alias("at"), none.alias("out"))
        return F.aggregate(values, state, lambda a, v: F.struct(
            (a["at"] + v).cast("long").alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"])

    def in_chunks(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int"))
        chunks = F.transform(starts, lambda i: F.slice(values, i * _CHUNK + 1, _CHUNK))
        totals = lambda cs: sums(F.transform(cs, lambda c: F.aggregate(
            c, F.lit(0).cast("long"), lambda a, v: a + v)), F.lit(0))
        return _let(chunks, lambda cs: F.flatten(F.zip_with(cs, totals(cs), sums)))

    return _let(sizes, lambda v: F.when(F.size(v) == 0, none).when(F.size(v) <= _CHUNK, sums(v, F.lit(0)))
                .otherwise(in_chunks(v)))


def matches(text: Column, pattern: str, group: int = 0, needs: tuple[str, ...] = ()) -> Column:
    """Array of (start, match, part) of a pattern's matches, leftmost and not
    overlapping; starts count code points, ``part`` is the pattern's group.

    The text between the matches tells where they lie.
    """
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    if needs:
        held = reduce(or_, [F.contains(text, F.lit(n)) for n in needs])
        whole = F.when(held, whole).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start: long, match: string, part: string>>")

    def placed(found: Column) -> Column:
        part = F.regexp_extract_all(text, regex, F.lit(group)) if group else found
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
        # a gap and the match after it are one step; the last gap has no match
        steps = F.zip_with(gaps, found, lambda g, m: g + F.coalesce(F.length(m), F.lit(0)))
        starts = F.zip_with(_running(steps), gaps, lambda before, g: before + g)
        return F.filter(F.zip_with(F.arrays_zip(found.alias("match"), part.alias("part")), starts, lambda m, s: F.struct(
            s.alias("start"), m["match"].alias("match"), m["part"].alias("part"))), lambda m: m["match"].isNotNull())

    return _let(whole, lambda found: F.when(F.size(found) == 0, none).otherwise(placed(found)))


def _entropy_spans(candidate: Column, kind: CharClass) -> Column:
    """Array of (start, end) in a candidate: the joined windows of high entropy."""
    n = kind.window
    # a window that one character fills gets one more of it before the oldest leaves
    f = F.array(*[F.lit(v).cast("long") for v in scaled(n + 1)])
    size = len(kind.symbols)
    codes = F.transform(F.split(candidate, "(?<=.)(?=.)"), lambda c: F.instr(F.lit(kind.symbols), c))

    def step(a: Column, pair: Column) -> Column:
        enters, leaves = pair["enters"], pair["leaves"]
        into = F.element_at(a["counts"], enters)
        out_of = F.when(leaves > 0, F.element_at(a["counts"], F.greatest(leaves, F.lit(1)))).otherwise(0)
        out_of = out_of + F.when(enters == leaves, 1).otherwise(0)
        total = a["total"] + a["f"][into + 1] - a["f"][into] - F.when(
            leaves > 0, a["f"][out_of] - a["f"][F.greatest(out_of - 1, F.lit(0))]).otherwise(0)
        counts = F.transform(a["counts"], lambda c, i: c + F.when(i + 1 == enters, 1).otherwise(0)
                             - F.when(i + 1 == leaves, 1).otherwise(0))
        digits = a["digits"] + F.when(enters <= 10, 1).otherwise(0) \
            - F.when((leaves > 0) & (leaves <= 10), 1).otherwise(0)
        read = a["read"] + 1
        high = (read >= n) & (total <= kind.marks()) & (digits > 0) & (digits < n)
        joins = a["until"] >= read - n
        return F.struct(
            a["f"].alias("f"), counts.alias("counts"), total.alias("total"), digits.alias("digits"),
            read.alias("read"),
            F.when(high & ~joins, read - n).otherwise(a["since"]).alias("since"),
            F.when(high, read).otherwise(a["until"]).alias("until"),
            F.when(high & ~joins & (a["until"] >= 0), F.concat(a["done"], F.array(
                F.struct(a["since"].alias("start"), a["until"].alias("end"))))).otherwise(a["done"]).alias("done"))

    zero = F.lit(0).cast("int")
    start = F.struct(
        f.alias("f"), F.array_repeat(zero, size).alias("counts"), F.lit(0).cast("long").alias("total"),
        zero.alias("digits"), zero.alias("read"), F.lit(-1).alias("since"), F.lit(-1).alias("until"),
        F.array().cast("array<struct<start: int, end: int>>").alias("done"))

    def finish(a: Column) -> Column:
        return F.when(a["until"] < 0, a["done"]).otherwise(F.concat(a["done"], F.array(
            F.struct(a["since"].alias("start"), a["until"].alias("end")))))

    def scan(cs: Column) -> Column:
        gone = F.slice(F.concat(F.array_repeat(zero, n), cs), 1, F.size(cs))
        pairs = F.zip_with(cs, gone, lambda i, o: F.struct(i.alias("enters"), o.alias("leaves")))
        return F.aggregate(pairs, start, step, finish)

    return _let(codes, scan)


_SPANS = "array<struct<start: long, kind: int, end: long>>"


def scan(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS,
         classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, kind, end),
    in that order, where ``kind`` numbers ``kinds`` and then ``classes``; starts
    and ends count code points, ends are exclusive.

    Base spans are never suppressed.  A null or empty text has none.  Columns
    of these two names are replaced, and those that begin with ``_hc_`` are the
    operator's own.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("base_spans", "spans")]
    base = [_base_spans(body, i, kind) for i, kind in enumerate(kinds)]
    added = [_added_spans(body, i, kind, allow) for i, kind in enumerate(classes, len(kinds))]
    out = docs.select(*kept, F.array_sort(F.concat(*base)).cast(_SPANS).alias("base_spans"),
                      F.concat(*added).cast(_SPANS).alias("_hc_added"))
    return out.select(*kept, "base_spans", F.array_sort(F.concat("base_spans", "_hc_added")).alias("spans"))


def _base_spans(text: Column, number: int, kind: Kind) -> Column:
    found = F.filter(matches(text, kind.pattern, kind.group, kind.needs), lambda m: F.length(m["part"]) >= kind.least)
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(number).alias("kind"), (m["start"] + F.length(m["match"])).alias("end")))


def _added_spans(text: Column, number: int, kind: CharClass, allow: tuple[str, ...]) -> Column:
    def within(m: Column) -> Column:
        return F.transform(_entropy_spans(m["match"], kind), lambda s: F.struct(
            (m["start"] + s["start"]).alias("start"), F.lit(number).alias("kind"), (m["start"] + s["end"]).alias("end")))

    found = F.filter(matches(text, kind.pattern()), lambda m: ~_allowed(m["match"], allow))
    return F.flatten(F.transform(found, within))


def _allowed(candidate: Column, allow: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in allow:
        found = found | candidate.rlike(f"^(?:{pattern})$")
    return found


def names(kinds: tuple[Kind, ...] = KINDS, classes: tuple[CharClass, ...] = CLASSES) -> list[str]:
    return [k.name for k in kinds] + [c.name for c in classes]


def of_kind(spans: Column, number: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == number)


def printed(spans: Column, labels: list[str]) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    named = F.array(*map(F.lit, labels))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(named, s["kind"] + 1), s["start"], s["end"])), ",")
