"""Allow and block rules for URLs, found by a trie over reversed host labels and then path segments.

A rule is a host, a path prefix that starts with ``/`` or is empty, and a verdict. It fits a URL if the URL's host is
the rule's host or below it and the URL's path starts with the rule's path. The rule with the most host labels wins,
then the one with the longest path; of equal rules with different verdicts, ``block`` wins.

The trie is broadcast if the rule table has no more than ``broadcast_rules`` rows (checked by a count). Beyond that,
every URL's host suffixes and whole path segments are joined with the rule table instead; results are the same.

Defined cases: host = after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path = from there up
to ``?``, ``#`` or the end; a null URL or one without ``://`` has both empty and fits no rule; a URL that fits no rule
gets the default verdict. Rules without a host or with another verdict than allow and block are left out. Repeated rows
stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(_host(url), UPPER, LOWER)


def _host(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")


def url_path(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


class UrlTrie:
    """Rules as nested dicts: reversed host labels, then, under ``/``, whole path segments, and under their ``/`` the tails
    of last segments, which need only be a prefix."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in sorted(rules, key=lambda r: r[2] == "block"):  # the last one set wins
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})  # a label holds no slash
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault("/", {})[tail] = (host + path, verdict)  # nor does a segment

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that wins, as (host and path, verdict)."""
        if not host:
            return None
        node, found = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            below = node.get("/")
            if below is not None:
                found = self._path(below, path) or found  # more labels win
        return found

    @staticmethod
    def _path(node: dict, path: str) -> tuple[str, str] | None:
        found, segments = None, path.split("/")
        for i, segment in enumerate(segments):
            tails = node.get("/")
            if tails:
                fits = [t for t in tails if segment.startswith(t)] if len(tails) < len(segment) else [t for n in range(len(segment) + 1) if (t := segment[:n]) in tails]
                if fits:
                    found = tails[max(fits, key=len)]
            if i < len(segments) - 1:
                node = node.get(segment)
                if node is None:
                    break
        return found


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = (), default: str = "allow", broadcast_rules: int = 200_000) -> DataFrame:
    """(``keep`` columns, host, path, rule, verdict) per row. ``rules`` has columns host, path, verdict."""
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).where("host <> '' and verdict in ('allow', 'block')").distinct()
    named = pages.select(*keep, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    few = rules.limit(broadcast_rules + 1).collect()  # bounded: it reads one row more than may be broadcast
    if len(few) <= broadcast_rules:
        return _by_trie(named, [tuple(r) for r in few], keep, default)
    return _by_join(named, rules, keep, default)


def _by_trie(named: DataFrame, rules: list[tuple[str, str, str]], keep, default: str) -> DataFrame:
    spark = named.sparkSession
    held = spark.sparkContext.broadcast(rules)

    @F.pandas_udf("struct<rule string, verdict string>")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = UrlTrie(held.value)
        for hosts, paths in parts:
            found = [trie.find(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return named.withColumn("_j", judge("host", "path")).select(*keep, "host", "path", "_j.rule", "_j.verdict")


def _by_join(named: DataFrame, rules: DataFrame, keep, default: str) -> DataFrame:
    """Distinct (host, path) pairs meet the rules by host suffix and whole path segments; the tail is compared after."""
    named = named.withColumn("_at", F.struct("host", "path"))
    pairs = named.select("_at").distinct()
    labels, segments = F.split("_at.host", r"\."), F.split("_at.path", "/")
    tries = pairs.select(
        "_at", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.struct(n.alias("n"), F.concat_ws(".", F.slice(labels, -n, n)).alias("host")))).alias("h")
    ).select("_at", "h", F.explode(F.transform(F.sequence(F.lit(0), F.size(segments) - 1), lambda k: F.concat_ws("/", F.slice(segments, F.lit(1), k)))).alias("stem"))
    keyed = rules.select(
        F.col("host").alias("_host"), F.array_join(F.slice(F.split("path", "/"), F.lit(1), F.size(F.split("path", "/")) - 1), "/").alias("_stem"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")
    )
    best = (
        tries.join(keyed, (F.col("h.host") == F.col("_host")) & (F.col("stem") == F.col("_stem")))
        .where(F.startswith(F.col("_at.path"), F.col("_path")))
        .groupBy("_at")
        .agg(F.max(F.struct(F.col("h.n").alias("n"), F.char_length("_path").alias("len"), F.col("_verdict").alias("verdict"), F.concat("_host", "_path").alias("rule"))).alias("b"))
    )
    return named.join(best, "_at", "left").select(*keep, "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
