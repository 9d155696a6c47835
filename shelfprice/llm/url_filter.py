"""URL filters: a trie over reversed host labels, with a path trie at each host, broadcast.

A rule names a host and a path; it fits that host and all its subdomains where the url's path
starts with the rule's path (the last path segment of a rule may be a part of one).  Of all
rules that fit, the longest (host and path together) wins; of equally long ones the one with
more host labels, then the blocking one.  A url that no rule fits gets ``default``.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no
rule; repeated rows are judged alike; an empty table gives an empty result.  The rules are an
argument of the driver and are refused beyond MAX_RULE_BYTES, so the broadcast is bounded.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import lower_ascii, table

MAX_RULE_BYTES = 64 << 20
AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: (verdict, host, path) of the contract
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nested dicts: host labels from the right; under None the path trie of that host, whose
    edges are whole segments; under None there (last segment, verdict, rule) of rules ending."""
    root: dict = {}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        *whole, last = path.split("/")
        node = node.setdefault(None, {})
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(None, []).append((last, verdict, host + path))
    return root


def best_rule(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest fit, walking labels from the right and segments from the left."""
    best = None
    node, segments = trie, path.split("/")
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node.get(label)
        if node is None:
            break
        here = node.get(None)
        for segment in segments:
            if here is None:
                break
            for last, verdict, rule in here.get(None, ()):
                if segment.startswith(last):
                    rank = (len(rule), depth, verdict == "block", rule, verdict)
                    if best is None or rank > best:
                        best = rank
            here = here.get(segment)
    return best and best[3:]


def judge(spark: SparkSession, pages: DataFrame, rules=RULES, id_col="page_id", url_col="url",
          default="allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row."""
    rules = [(v, h.lower(), p) for v, h, p in rules]
    if sum(len(h) + len(p) for _, h, p in rules) > MAX_RULE_BYTES:
        raise ValueError("the rules are too large to broadcast")
    trie = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def fits(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [best_rule(trie.value, h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = pages.select(F.col(id_col).alias("id"),
                         lower_ascii(F.regexp_extract(url, AUTHORITY, 1)).alias("host"),
                         F.regexp_extract(url, AUTHORITY, 2).alias("path"))
    return (parts.withColumn("fit", fits("host", "path"))
            .select("id", "host", "path", "fit.rule", "fit.verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


ORACLE = """
with u as (select page_id, coalesce(url, '') as url from pages),
p as (select page_id,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path from u),
r(verdict, h, q) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f as (select page_id, host, path, arg_max(h || q, length(h || q)) as rule, arg_max(verdict, length(h || q)) as verdict
    from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, q) group by all)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from f"""
