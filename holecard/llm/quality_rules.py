"""Quality rules learned as a decision list.

Method: sequential covering.  Statistics of labelled texts are split into a
part to grow on and a part to prune on.  A rule for low quality grows
threshold conditions by information gain until it covers next to no good text,
is pruned from its end, and is kept while it is precise on the pruning part;
what it covers is taken out, and the next rule is grown.  The list becomes one
ordered Spark conditional expression.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holecard.llm import columnar as C

#: Bound of the labelled rows the rules are learned from, chosen by a hash of their id.
FIT_ROWS = 20_000
SYMBOLS = b"#*$%&|<>"
MOST_RULES, MOST_CONDITIONS = 16, 4
#: Cut points tried of each statistic.
CUTS = 48
#: Least share of low quality among what a rule covers, on both parts.
PRECISION = 0.9
#: Least low-quality rows that a rule covers on the growing part.
LEAST_COVER = 5

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "n_lines", "n_upper", "n_digits", "n_marks"]
#: Statistics that rules are made of, as numerator and denominator.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"), "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "n_words"),
    "word_length": ("word_chars", "n_words"), "line_words": ("n_words", "n_lines"),
}
FEATURES = [*RATIOS, "n_words"]

_SYMBOL = C.byte_table(SYMBOLS)
_UPPER = C.byte_table(bytes(range(65, 91)))
_DIGIT = C.byte_table(b"0123456789")
_MARK = C.byte_table(b"!?")


class Condition(NamedTuple):
    feature: str
    above: bool  # value > cut, else value <= cut
    cut: float


class Rule(NamedTuple):
    conditions: tuple[Condition, ...]

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.cut:.6g}" for c in self.conditions)


def statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_upper, n_digits, n_marks)`` of every text, all long.

    Words are runs of bytes other than U+0020 and U+0009 to U+000D; word_chars
    are their code points; n_symbols counts ``#*$%&|<>``; n_lines are the
    ``\\n``-split lines with a word, n_dup_lines those equal to an earlier one;
    n_repeat_words are the words in 3-word windows found twice or more in the
    text, first ones included; n_upper, n_digits and n_marks count A-Z, 0-9 and
    ``!?``.  A null or empty text has 0 everywhere.  Lines and windows are
    compared by 64-bit hashes.
    """
    def work(batches):
        for batch in batches:
            for i, j, buf, offs in C.text_slices(batch.column(1)):
                sp = C.spans(buf, offs)
                h = C.span_hashes(buf, sp)
                owner = sp.owner()
                # equal 3-word windows of one text are neighbours in this order
                valid = np.flatnonzero(C.whole_windows(owner, 3))
                key = C.ngram_hashes(h, 3)[valid] + C.mix(owner[valid].astype(np.uint64))
                covered = np.zeros(len(h), bool)
                again = valid[_repeated(key)[0]]
                for k in range(3):
                    covered[again + k] = True
                lines = C.spans(buf, offs, C.IS_NEWLINE)
                has_word = np.searchsorted(sp.starts, lines.starts) < np.searchsorted(sp.starts, lines.ends)
                own = lines.owner()
                at = np.flatnonzero(has_word)
                line_key = C.span_hashes(buf, lines)[at] + C.mix(own[at].astype(np.uint64))
                later = np.zeros(len(own), bool)
                later[at[_repeated(line_key)[1]]] = True
                counts = [np.diff(sp.first), C.per_text(C.IN_WORD[buf], offs), C.per_text(_SYMBOL[buf], offs),
                          C.per_text(later, lines.first), C.per_text(covered, sp.first),
                          C.per_text(has_word, lines.first), C.per_text(_UPPER[buf], offs),
                          C.per_text(_DIGIT[buf], offs), C.per_text(_MARK[buf], offs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i)] + [pa.array(c.astype(np.int64)) for c in counts],
                    names=["doc_id", *_COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS))


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose key occurs twice or more, and those with an equal one before them."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1] if len(s) else np.zeros(0, bool)
    any_, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    any_[1:] |= same
    any_[:-1] |= same
    later[1:] = same
    return order[any_], order[later]


def _feature(name: str) -> Column:
    if name not in RATIOS:
        return F.col(name).cast("double")
    top, below = RATIOS[name]
    return F.col(top) / F.greatest(F.col(below), F.lit(1))


def _covers(rule: tuple[Condition, ...], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= x[c.feature] > c.cut if c.above else x[c.feature] <= c.cut
    return out


def _grow(x: dict[str, np.ndarray], low: np.ndarray) -> tuple[Condition, ...]:
    """Conditions by FOIL's information gain, until no good text is covered."""
    rule: tuple[Condition, ...] = ()
    inside = np.ones(len(low), bool)
    while len(rule) < MOST_CONDITIONS:
        p, n = int((inside & low).sum()), int((inside & ~low).sum())
        if not p or not n:
            break
        best, now = (0.0, None), np.log2(p / (p + n))
        for name, v in x.items():
            own = v[inside]
            cuts = np.unique(np.quantile(own, np.linspace(0, 1, CUTS + 2)[1:-1]))
            order = np.argsort(own)
            s, hits = own[order], np.cumsum(low[inside][order])
            upto = np.searchsorted(s, cuts, side="right")
            p_below = np.where(upto > 0, hits[upto - 1], 0)
            for above, p1, all1 in ((False, p_below, upto), (True, hits[-1] - p_below, len(s) - upto)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p1 >= LEAST_COVER, p1 * (np.log2(p1 / all1) - now), -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), Condition(name, above, float(cuts[k])))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= _covers((best[1],), x, len(low))
    return rule


def _with_margin(rule: tuple[Condition, ...], low: dict[str, np.ndarray]) -> tuple[Condition, ...]:
    """Cuts moved half-way to the nearest low-quality value that is covered."""
    return tuple(c._replace(cut=float(c.cut + (low[c.feature].min() if c.above else low[c.feature].max())) / 2)
                 for c in rule)


def learn_rules(x: dict[str, np.ndarray], low: np.ndarray, part: np.ndarray) -> list[Rule]:
    """Rules for low quality, in order.  ``part`` is true for rows to prune on."""
    grow_x, grow_y = {k: v[~part] for k, v in x.items()}, low[~part]
    prune_x, prune_y = {k: v[part] for k, v in x.items()}, low[part]
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and grow_y.sum() >= LEAST_COVER:
        rule = _grow(grow_x, grow_y)
        if not rule:
            break

        def worth(r):
            hit = _covers(r, prune_x, len(prune_y))
            p, n = int((hit & prune_y).sum()), int((hit & ~prune_y).sum())
            return (p - n) / (p + n) if p + n else -1.0

        keep = max(range(len(rule), 0, -1), key=lambda k: (worth(rule[:k]), -k))
        rule = rule[:keep]
        hit, seen = _covers(rule, grow_x, len(grow_y)), _covers(rule, prune_x, len(prune_y))
        p, n = int((hit & grow_y).sum()), int((hit & ~grow_y).sum())
        q, m = int((seen & prune_y).sum()), int((seen & ~prune_y).sum())
        if p < LEAST_COVER or p < PRECISION * (p + n) or (q + m and q < PRECISION * (q + m)):
            break
        rules.append(Rule(_with_margin(rule, {k: v[hit & grow_y] for k, v in grow_x.items()})))
        grow_x, grow_y = {k: v[~hit] for k, v in grow_x.items()}, grow_y[~hit]
        prune_x, prune_y = {k: v[~seen] for k, v in prune_x.items()}, prune_y[~seen]
    return rules


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``.

    At most about ``fit_rows`` labelled rows are used, chosen by a hash of
    doc_id; their ids (16 bytes each) are broadcast and only their statistics
    come to the driver.  Rows without a label or text don't count.
    """
    labels = labels.select(F.col("doc_id").alias("_hc_of"), "quality").where("_hc_of IS NOT NULL AND quality IS NOT NULL")
    n = labels.count()
    if n > fit_rows:
        labels = labels.where(F.pmod(F.xxhash64("_hc_of", F.lit(3)), F.lit(1 << 20)) < int(fit_rows / n * (1 << 20)))
    known = docs.where("text IS NOT NULL").select("doc_id", "text")
    known = known.join(F.broadcast(labels.select("_hc_of").distinct()), F.col("doc_id") == F.col("_hc_of"), "left_semi")
    rows = statistics(known).join(F.broadcast(labels), F.col("doc_id") == F.col("_hc_of")) \
        .select("doc_id", "quality", *[_feature(f).alias(f) for f in FEATURES]).toArrow()
    x = {f: np.asarray(rows[f], np.float64) for f in FEATURES}
    low = np.asarray(rows["quality"]) == 0
    part = C.mix(np.asarray(rows["doc_id"]).astype(np.uint64)) % np.uint64(3) == 0
    return learn_rules(x, low, part) if len(low) else []


def rule_column(rules: list[Rule]) -> Column:
    """The first rule that holds, as text; null where none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        holds = F.lit(True)
        for c in rule.conditions:
            holds &= _feature(c.feature) > c.cut if c.above else _feature(c.feature) <= c.cut
        out = F.when(holds, F.lit(str(rule))).otherwise(out)
    return out


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``rule`` (the first that holds, else null) and ``good``
    (no rule holds); the result of `statistics` or of a table like it."""
    return stats.withColumn("rule", rule_column(rules)).withColumn("good", F.col("rule").isNull())
