"""URL rules by a sort-merge range join.

A rule names a host and a path prefix and fits the host, its subdomains, and every path that starts with
the prefix. A key is the host with its labels reversed, a slash, and the path, so a rule's key is a prefix
of the keys it fits, and its matches are one interval of the sorted keys. A url has one key per suffix of
its host (``a.b.org`` has ``org``, ``org.b``, ``org.b.a``), as a path rule of a domain also holds below it.
Intervals of prefixes nest, so one sweep over sorted rules and keys with a stack of the open rules
finds the innermost rule of every key; the longest over a url's keys is its rule.

Distinct (host, path) pairs are judged once. Keys are cut into ranges at quantiles of a bounded sample,
on the key and a salt, so that a key which most hosts share spreads over ranges; a rule is
copied to each range that its interval meets, which adds at most its nesting depth per range.

Defined cases: a null url, or one without ``://``, has empty host and path; null or repeated ids pass
through row by row; of rules with one host and path ``block`` wins; a null path of a rule is empty; rules
without host or action are ignored; empty tables give no rows or no rule; columns other than id
and url are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radiolith.llm.common import LOWER, UPPER, cut, width

#: Keys sampled for each range; more give more even ranges.
SAMPLE_PER_RANGE = 40


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def host_keys(host: Column, path: Column) -> Column:
    """The keys of a url, one for each suffix of its host."""
    labels = _reversed(host)
    levels = F.sequence(F.lit(1), F.size(labels))
    return F.transform(levels, lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit("/"), path))


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by range, key and kind (rules first); yields the innermost open rule of each key."""
    at, stack = None, []
    for frame in frames:
        found = []
        for part, key, host, path, rule, action in zip(
            frame["part"], frame["key"], frame["host"], frame["path"], frame["rule"], frame["action"], strict=True
        ):
            if part != at:
                at, stack = part, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, action))
            elif stack:
                found.append((host, path, stack[-1][1], stack[-1][2]))
        yield pd.DataFrame(found, columns=["host", "path", "rule", "action"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Per row of ``pages``: id, ``host``, ``path``, ``rule`` (host and path of the longest fitting rule) and
    ``verdict`` (the rule's action, else ``default``). ``rules`` has ``action, host, path``."""
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    points = cut(urls.select("host", "path").distinct()).select(
        F.explode(host_keys(F.col("host"), F.col("path"))).alias("key"),
        F.hex(F.xxhash64("host", "path")).alias("salt"),
        "host",
        "path",
    )
    parts = width(spark)
    sample = points.select("key", "salt").orderBy("salt", "key").limit(parts * SAMPLE_PER_RANGE).collect()
    drawn = sorted((r["key"], r["salt"]) for r in sample)
    splits = sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)}) if drawn else []

    @F.pandas_udf("int")
    def range_of(key: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(splits, pair) for pair in zip(key, salt, strict=True)], dtype="int32")

    empty = F.lit("")
    host, path = F.translate(F.coalesce("host", empty), UPPER, LOWER), F.coalesce("path", empty)
    named = rules.where("action is not null and host <> ''")
    distinct = named.select("action", host.alias("host"), path.alias("path")).groupBy("host", "path").agg(F.max("action").alias("action"))
    opened = distinct.select(
        F.concat(F.array_join(_reversed(F.col("host")), "."), F.lit("/"), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"),
        "action",
    )
    last = F.concat("key", F.lit("\U0010ffff"))
    opened = opened.select(
        F.explode(F.sequence(range_of("key", empty), range_of(last, empty))).alias("part"),
        "key",
        F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "rule",
        "action",
    )
    asked = points.select(
        range_of("key", "salt").alias("part"),
        "key",
        F.lit(1).alias("kind"),
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("action"),
    )
    swept = (
        opened.unionByName(asked)
        .repartition(parts, "part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInPandas(_sweep, "host string, path string, rule string, action string")
    )
    best = swept.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
