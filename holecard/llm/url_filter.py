"""Allow and block lists over URLs.

Method: a trie over reversed host labels, and below each host over path
segments, holds all entries; the deepest host with the longest fitting path
wins.  The trie is broadcast while the list is within ``MAX_TRIE_RULES``; a
longer list is joined by host suffix and folder instead.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the broadcast trie: entries, and characters of one entry.
MAX_TRIE_RULES = 100_000
MAX_RULE_CHARS = 2_000

_VERDICTS = {"allow", "block"}
_PARTS = "host string, path string, rule string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for c in "?#":
        rest = rest.partition(c)[0]
    host, slash, path = rest.partition("/")
    return host.translate(str.maketrans(_UPPER, _LOWER)), slash + path


class Trie:
    """``add`` entries, then ``find`` the one that wins for a host and path.

    A node is ``[children, paths]``; ``paths`` is a node of the path trie or
    None: ``[children, {last segment, or its beginning: (rule, verdict)}]``.
    """

    def __init__(self) -> None:
        self.root: list = [{}, None]

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self.root
        for label in reversed(host.split(".")):
            node = node[0].setdefault(label, [{}, None])
        if node[1] is None:
            node[1] = [{}, {}]
        at = node[1]
        *folders, last = path.split("/")
        for folder in folders:
            at = at[0].setdefault(folder, [{}, {}])
        # of two entries with one rule the blocking one holds
        if last not in at[1] or verdict == "block":
            at[1][last] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                hosts.append(node[1])
        segments = path.split("/")
        for at in reversed(hosts):  # the most labels first
            best = None
            for segment in segments:
                for k in range(len(segment), -1, -1):
                    if segment[:k] in at[1]:
                        best = at[1][segment[:k]]
                        break
                at = at[0].get(segment)
                if at is None:
                    break
            if best:
                return best
        return None


def _checked(rules) -> list[tuple[str, str, str]]:
    """Rules with lower-cased hosts; the list is the caller's, on the driver."""
    out = []
    for host, path, verdict in rules:
        if verdict not in _VERDICTS:
            raise ValueError(f"verdict {verdict!r} is neither allow nor block")
        if len(host) + len(path) > MAX_RULE_CHARS:
            raise ValueError(f"an entry has more than {MAX_RULE_CHARS} characters")
        out.append((host.translate(str.maketrans(_UPPER, _LOWER)), path, verdict))
    return out


def judge_urls(pages: DataFrame, rules, default: str = "allow", url: str = "url",
               max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are ``(host, path, verdict)``.  An entry fits its host and all
    subdomains, if the url's path starts with the entry's path; the entry with
    the most host labels wins, then the longest path, then block over allow.
    ``rule`` is ``host + path``, or null where no entry fits; the verdict is
    then ``default``.  The host is what follows the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, with A-Z lower-cased; the path goes on from there
    up to ``?``, ``#`` or the end.  A null url, or one without ``://``, has
    both empty.  Input columns of the four names are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = _checked(rules)
    if len(rules) > max_trie_rules:
        return _judge_by_join(pages, rules, default, url)
    trie = Trie()
    for rule in rules:
        trie.add(*rule)
    shared = pages.sparkSession.sparkContext.broadcast(trie.root)

    @F.pandas_udf(_PARTS)
    def judge(urls: pd.Series) -> pd.DataFrame:
        own = Trie()
        own.root = shared.value
        rows = []
        for u in urls:
            host, path = split_url(u)
            rows.append((host, path, *(own.find(host, path) or (None, default))))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    at = "_hc_judged"
    return pages.withColumn(at, judge(F.col(url))).select(
        *[F.col(f"`{c}`") for c in pages.columns], f"{at}.host", f"{at}.path", f"{at}.rule", f"{at}.verdict")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _judge_by_join(pages: DataFrame, rules, default: str, url: str) -> DataFrame:
    """The same verdicts from a join on (host suffix, folder of the path)."""
    spark = pages.sparkSession
    listed = spark.createDataFrame(rules, "r_host string, r_path string, r_verdict string") \
        .withColumn("folder", F.regexp_extract("r_path", r"(?s)^(.*/)?", 0))
    seen = pages.select(F.col(url).alias("u")).distinct().select(
        "u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    keys = seen.withColumn("n", F.explode(F.sequence(F.lit(1), F.size(labels)))) \
        .withColumn("suffix", F.array_join(F.slice(labels, F.size(labels) - F.col("n") + 1, F.col("n")), ".")) \
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.size(parts) - 1))) \
        .withColumn("f", F.when(F.col("k") == 0, "").otherwise(
            F.concat(F.array_join(F.slice(parts, 1, F.col("k")), "/"), F.lit("/"))))
    fits = keys.join(listed, (F.col("suffix") == F.col("r_host")) & (F.col("f") == F.col("folder"))) \
        .where(F.expr("startswith(path, r_path)"))
    best = fits.groupBy(F.col("u").alias("_hc_url")).agg(F.max(F.struct(
        "n", F.length("r_path").alias("len"), F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"))).alias("_hc_best"))
    out = pages.join(best, pages[url] == best["_hc_url"], "left")
    return out.select(*[pages[c] for c in pages.columns], host_of(pages[url]).alias("host"),
                      path_of(pages[url]).alias("path"), F.col("_hc_best.rule").alias("rule"),
                      F.coalesce("_hc_best.verdict", F.lit(default)).alias("verdict"))
