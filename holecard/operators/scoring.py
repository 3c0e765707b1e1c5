"""Scoring of completions against labels.

n-gram match (BLEU-4 with add-0.1 smoothing of empty orders), keyword-weighted
n-gram match (recall form, brevity against length 2), the composite score, the
null-on-failure rule, perplexity and token counts.

Clipped n-gram counts are a multiset intersection.  They are counted inside
each row by one small helper over Arrow batches (linear in the two texts, no
shuffle, no per-gram rows); the scores are column expressions over its counts.
A long text is the largest unit of work; no key can be hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holecard.functions.lexer import (JAVA_KEYWORDS, KEYWORD_WEIGHT, OTHER_WEIGHT,
                                      all_tokens, code_tokens_of, lex_ok_of, scan_tokens)
from holecard.functions.text import WS, WS_CHARS, col

MAX_N = 4
EPSILON = 0.1            # smoothing numerator of an n-gram order with no match
WEIGHTED_REF_LEN = 2     # reference length the weighted brevity penalty sees (Q10)
# --- fixed values: default weights of the composite score ---
COMPOSITE_WEIGHTS = (0.25, 0.25, 0.25, 0.25)
_KEYWORDS = frozenset(JAVA_KEYWORDS)
EOT_SUFFIX = "\n <EOT>"  # removed from completions before scoring (G4)


def strip_eot(c) -> Column:
    """Literal removal of ``\\n <EOT>`` (a bare `` <EOT>`` stays)."""
    return F.replace(col(c), F.lit(EOT_SUFFIX), F.lit(""))


def _strip(c) -> Column:
    return F.regexp_replace(col(c), rf"^{WS}+|{WS}+$", "")


def score_tokens(c) -> tuple[Column, Column]:
    """(code tokens, lexes ok) of a stripped text, as the scorer sees it."""
    toks = all_tokens(_strip(F.coalesce(col(c), F.lit(""))))
    return code_tokens_of(toks), lex_ok_of(toks)


def _shared(h: Iterable, r: Iterable) -> Counter:
    """Multiset intersection: every n-gram with the smaller of its two counts."""
    return Counter(h) & Counter(r)


def _weight_of(counts: Counter) -> float:
    """Weights of counted tokens, a keyword's and any other's, added up."""
    keywords = sum(counts[t] for t in counts.keys() & _KEYWORDS)
    return keywords * KEYWORD_WEIGHT + (counts.total() - keywords) * OTHER_WEIGHT


def pair_counts(label: str | None, completion: str | None) -> tuple:
    """The values of ``_COUNTS`` for one pair of texts.

    Linear in the texts.  An order without matches has none in longer n-grams,
    so counting ends there.
    """
    r, r_ok = scan_tokens((label or "").strip(WS_CHARS))
    h, h_ok = scan_tokens((completion or "").strip(WS_CHARS))
    if not (r_ok and h_ok):
        return (False, len(h), len(r), *[0] * MAX_N, 0.0, 0.0)
    unigrams = _shared(h, r)
    matches = [unigrams.total()]
    while matches[-1] and len(matches) < MAX_N:
        n = len(matches) + 1
        grams = lambda toks: zip(*[toks[k:] for k in range(n)])  # noqa: B023, E731
        matches.append(_shared(grams(h), grams(r)).total())
    matches += [0] * (MAX_N - len(matches))
    return (True, len(h), len(r), *matches, _weight_of(unigrams), _weight_of(Counter(r)))


_COUNTS = T.StructType([T.StructField("ok", T.BooleanType())] + [
    T.StructField(name, T.IntegerType()) for name in ("hl", "rl", *[f"m{n}" for n in range(1, MAX_N + 1)])] + [
    T.StructField(name, T.DoubleType()) for name in ("wm1", "wr1")])


@F.pandas_udf(_COUNTS)
def _pair_counts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """:func:`pair_counts` of every row: lexes ok, lengths of both texts in
    tokens, clipped matches per order, and the weights of the matched unigrams
    and of the whole label."""
    for labels, completions in batches:
        yield pd.DataFrame([pair_counts(*pair) for pair in zip(labels, completions)], columns=_COUNTS.names)


def ngram_match_scores(pairs: DataFrame, label: str = "label", completion: str = "completion",
                       whole_reference: bool = False) -> DataFrame:
    """C1 + C2 (+ C4 null rule): ``pairs`` with ``ngram_match_score``,
    ``weighted_ngram_match_score`` and ``lex_ok`` added; row-local.

    The published weighted score takes its brevity penalty against a reference
    of length 2 (Q10); with ``whole_reference`` it is that of the first score.
    """
    key = pairs.columns
    counted = pairs.select(*key, _pair_counts(F.col(label), F.col(completion)).alias("_c")).select(
        *key, F.col("_c.ok").alias("lex_ok"), F.col("_c.hl").alias("_hl"), F.col("_c.rl").alias("_rl"),
        *[F.col(f"_c.m{n}").alias(f"_m{n}") for n in range(1, MAX_N + 1)],
        F.col("_c.wm1").alias("_wm1"), F.col("_c.wr1").alias("_wr1"))
    hl, rl = F.col("_hl").cast("double"), F.col("_rl").cast("double")

    def order_total(length: Column, n: int) -> Column:
        return F.greatest(length - (n - 1), F.lit(0.0))

    def log_p(num: Column, den: Column) -> Column:
        num = num.cast("double")
        return F.log(F.when(num == 0, F.lit(EPSILON)).otherwise(num) / F.greatest(den, F.lit(1.0)))

    m = {n: F.col(f"_m{n}") for n in range(1, MAX_N + 1)}
    bp = F.when(hl > rl, 1.0).when(hl == 0, 0.0).otherwise(F.exp(1 - rl / hl))
    bleu = F.when(m[1] == 0, F.lit(0.0)).otherwise(
        bp * F.exp(sum(0.25 * log_p(m[n], order_total(hl, n)) for n in range(1, MAX_N + 1))))
    wbp = F.when(hl > WEIGHTED_REF_LEN, 1.0).when(hl == 0, 0.0) \
        .otherwise(F.exp(1 - WEIGHTED_REF_LEN / hl))
    if whole_reference:
        wbp = bp
    wm1 = F.col("_wm1")
    wlogs = [0.25 * log_p(wm1, F.col("_wr1"))] + \
        [0.25 * log_p(m[n], order_total(rl, n)) for n in range(2, MAX_N + 1)]
    weighted = F.when(wm1 == 0, F.lit(0.0)).otherwise(wbp * F.exp(sum(wlogs)))
    return counted.select(
        *key,
        F.when(F.col("lex_ok"), bleu).alias("ngram_match_score"),
        F.when(F.col("lex_ok"), weighted).alias("weighted_ngram_match_score"),
        "lex_ok")


def composite_score(ngram, weighted, syntax, dataflow,
                    weights: tuple = COMPOSITE_WEIGHTS) -> Column:
    """Weighted sum; a dataflow score of 0 (or missing) counts as 1 (Q8).

    Null when any of the first three parts is null (C4).
    """
    a, b, c, d = weights
    df_part = F.when(F.coalesce(col(dataflow), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(col(dataflow))
    return a * col(ngram) + b * col(weighted) + c * col(syntax) + d * df_part


def code_bleu(pairs: DataFrame, label: str = "label", completion: str = "completion",
              syntax=None, dataflow=None) -> DataFrame:
    """C1-C4 on a pairs table: all columns of ``pairs`` + the five scores.

    Syntax and data-flow matches are inputs (column names): the AST and
    data-flow matchers are per-row parsers and are not rebuilt.  Without one of
    them its score and the composite are null.
    """
    out = ngram_match_scores(pairs, label, completion)
    syn = F.col(syntax) if syntax else F.lit(None)
    dfl = F.col(dataflow) if dataflow else F.lit(None)
    ok = F.col("lex_ok")
    return out.withColumn("syntax_match_score", F.when(ok, syn.cast("double"))) \
        .withColumn("dataflow_match_score", F.when(ok, dfl.cast("double"))) \
        .withColumn("codebleu", composite_score("ngram_match_score", "weighted_ngram_match_score",
                                                "syntax_match_score", "dataflow_match_score"))


def _ln(p: Column) -> Column:
    """Natural logarithm, minus infinity at 0 (Spark's is null there)."""
    return F.when(p == 0, F.lit(float("-inf"))).otherwise(F.log(p))


def perplexity(probs, legacy_exponent: bool = True) -> Column:
    """``(prod 1/p[2:]) ^ (1/n)`` on an ``ARRAY<DOUBLE>`` of token probabilities.

    The first probability is skipped; with ``legacy_exponent`` the root is
    taken over all ``n`` (reference behaviour, Q7), else over ``n - 1``.
    Computed in log space: ``exp(-sum(ln p[2:]) / n)``; infinite if one of them is 0.
    """
    p = col(probs)
    tail = F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0)))
    log_sum = F.aggregate(tail, F.lit(0.0), lambda acc, x: acc + _ln(x))
    n = F.size(p) if legacy_exponent else F.greatest(F.size(p) - 1, F.lit(1))
    return F.when(F.size(p) > 0, F.exp(-log_sum / n))


def perplexity_by_group(df: DataFrame, group: str, order: str, p: str,
                        legacy_exponent: bool = True) -> DataFrame:
    """C5 in long form: one probability per row, ``order`` sorts the rows of a
    group.  ``exp(-(sum(ln p) - ln p_first) / n)`` with plain aggregates; a
    zero among the others makes it infinite."""
    logp = _ln(F.col(p))
    n = F.count(F.lit(1))
    zero = F.col(p) == 0
    finite = F.when(~zero, logp)
    agg = df.groupBy(group).agg(n.alias("n_tokens"), F.sum(finite).alias("_s"),
                                F.min_by(F.col(p), F.col(order)).alias("_p"),
                                F.sum(zero.cast("int")).alias("_zeros"))
    first = F.when(F.col("_p") == 0, F.lit(0.0)).otherwise(_ln(F.col("_p")))
    denom = F.col("n_tokens") if legacy_exponent else F.greatest(F.col("n_tokens") - 1, F.lit(1))
    later = F.col("_zeros") - (F.col("_p") == 0).cast("int")
    return agg.select(group, "n_tokens", F.when(later > 0, F.lit(float("inf"))).otherwise(
        F.exp(-(F.coalesce("_s", F.lit(0.0)) - first) / denom)).alias("perplexity"))


def token_count(c) -> Column:
    """C6 (as published): pieces of a split on any of ``, _-=.+*``.

    The text is the string form of the value (null -> ``nan``) with ``<EOT>``
    removed.  This is the reference's fallback path, which its published
    summary numbers were produced with (Q9).
    """
    s = F.replace(F.coalesce(col(c).cast("string"), F.lit("nan")), F.lit("<EOT>"), F.lit(""))
    return F.size(F.split(s, r"[, _\-=.+*]", -1))


def token_count_lexed(c) -> Column:
    """C6 (intended): number of code tokens; null when the text does not lex."""
    s = F.replace(F.coalesce(col(c).cast("string"), F.lit("nan")), F.lit("<EOT>"), F.lit(""))
    toks = all_tokens(s)
    return F.when(lex_ok_of(toks), F.size(code_tokens_of(toks)))


def normal_quantile(p: float) -> float:
    """Inverse standard normal CDF (driver-side constant for A6)."""
    from statistics import NormalDist
    return NormalDist().inv_cdf(p)


def z_value(confidence_level: float = 0.95, legacy: bool = False) -> float:
    """z of a two-sided interval; ``legacy`` repeats the reference's
    ``ppf(1 - conf/2)`` (= 0.0627 at 95 %, Q3)."""
    if legacy:
        return normal_quantile(1 - confidence_level / 2)
    return normal_quantile(1 - (1 - confidence_level) / 2)


def margin_of_error(p_hat, n, z: float) -> Column:
    """``z * sqrt(p (1 - p) / n)``."""
    return F.lit(z) * F.sqrt(col(p_hat) * (1 - col(p_hat)) / col(n))


assert math.isclose(z_value(), 1.959963984540054)
