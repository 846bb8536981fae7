"""URL filter: a broadcast trie over reversed host labels and path segments.

The trie walks a host from its last label to its first. Each node that ends a rule's host holds a second
trie over the rule's path, cut at ``/``. All segments of a rule's path but the last must equal the URL's,
and the last one must begin the URL's segment at its place: together that is "the URL's path starts with
the rule's". A path that ends in ``/`` thus ends in an empty last segment.

Defined results: a null URL, or one without ``://``, has an empty host and path, and no rule fits it. The
longest rule (host and path, in characters) wins, then the longer host, then ``block`` over ``allow``. A
rule with an empty host fits every URL that has a host. Ports and user names are part of the host, as
written. Repeated rows are judged alike; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower, ship

#: Rules in one broadcast trie (some 100 MB). More rules are judged trie after trie, and the longest match of all wins.
MAX_TRIE_RULES = 200_000
VERDICT = "chars int, host_chars int, blocks int, rule string"


class Rule(NamedTuple):
    action: str
    host: str
    path: str = ""


class UrlTrie:
    """Rules by reversed host labels, then by path segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            if rule.action not in ("allow", "block"):
                raise ValueError(f"unknown action in {rule}")
            host = rule.host.translate({c: c + 32 for c in range(65, 91)})
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})  # no label holds a slash, so this key is the way to the paths
            *segments, last = rule.path.split("/")
            for segment in segments:
                node = node.setdefault(segment, {})
            rank = (len(host) + len(rule.path), len(host), int(rule.action == "block"), host + rule.path)
            ends = node.setdefault("/", {})  # nor does a segment
            ends[last] = max(rank, ends.get(last, rank))

    def longest(self, host: str, path: str) -> tuple | None:
        """(characters, host's characters, 1 if it blocks, rule) of the longest rule that fits."""
        if not host:
            return None
        best, segments, node = None, path.split("/"), self.root
        for label in (None, *reversed(host.split("."))):
            if label is not None:
                node = node.get(label)
                if node is None:
                    break
            below = node.get("/")
            for segment in segments if below else ():
                for begin, rank in below.get("/", {}).items():
                    if segment.startswith(begin) and (best is None or rank > best):
                        best = rank
                below = below.get(segment)
                if below is None:
                    break
        return best


def host_and_path(url):
    """Columns ``host`` and ``path`` of a URL column."""
    part = lambda group: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", group), F.lit(""))
    return ascii_lower(part(1)), part(2)


def judge_urls(pages: DataFrame, rules: Iterable[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` and ``verdict`` of every row; ``default`` where no rule fits."""
    spark = pages.sparkSession
    ship(spark)
    rules = list(rules)
    host, path = host_and_path(F.col(url_col))
    found = [F.lit(None).cast(f"struct<{VERDICT.replace(' int', ':int').replace(' string', ':string')}>")] * 2
    for start in range(0, len(rules), MAX_TRIE_RULES):
        found.append(_judge(spark.sparkContext.broadcast(UrlTrie(rules[start : start + MAX_TRIE_RULES])))("host", "path"))
    return (
        pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
        .withColumn("_best", F.greatest(*found))
        .select(
            F.col(id_col), "host", "path", F.col("_best.rule").alias("rule"),
            F.when(F.col("_best.blocks") == 1, "block").when(F.col("_best.blocks") == 0, "allow").otherwise(F.lit(default)).alias("verdict"),
        )
    )


def _judge(trie):
    @F.pandas_udf(VERDICT)
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        longest = trie.value.longest
        for hosts, paths in parts:
            best = [longest(h, p) or (None,) * 4 for h, p in zip(hosts, paths, strict=True)]
            frame = pd.DataFrame(best, columns=["chars", "host_chars", "blocks", "rule"])
            yield frame.astype({"chars": "Int32", "host_chars": "Int32", "blocks": "Int32", "rule": object})

    return judge
