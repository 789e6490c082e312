"""URL filter: a trie over reversed host labels and path segments.

A rule is a host, a path prefix and a verdict. It fits its host and every subdomain if the url's path
starts with the rule's path; of the rules that fit, the longest wins (host and path together; between
an allow and a block of one length, the block). Urls that no rule fits get the default verdict.

A null url, or one without `://`, has an empty host and path and so fits no rule. Repeated rules count
once, repeated rows are judged each, and columns other than the url are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, small_batches

#: Rules are held by every worker; a longer list must be split.
MAX_RULES = 2_000_000


@dataclass
class _Node:
    below: dict[str, _Node] = field(default_factory=dict)
    #: From the host trie's nodes, the root of the path trie of the rules that end there.
    paths: _Node | None = None
    #: In path tries: what must start the next segment, the length of rule, the rule and its verdict.
    ends: list[tuple[str, int, str, str]] = field(default_factory=list)


class UrlTrie:
    def __init__(self, rules: Iterable[tuple[str, str]], default: str = "allow"):
        """rules: (verdict, host followed by path), as in ("block", "example.com/en/")."""
        self.default, self.root = default, _Node()
        found = sorted(set(rules))
        if len(found) > MAX_RULES:
            raise ValueError(f"{len(found)} rules; at most {MAX_RULES} are broadcast")
        for verdict, rule in found:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            host, slash, path = rule.partition("/")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.below.setdefault(label, _Node())
            node.paths = node = node.paths or _Node()
            *whole, part = (slash + path).split("/")
            for segment in whole:
                node = node.below.setdefault(segment, _Node())
            node.ends.append((part, len(rule), rule, verdict))

    def judge(self, host: str, path: str) -> tuple[str | None, str]:
        best: tuple[int, bool, str | None, str] = (-1, False, None, self.default)
        node = self.root
        segments = path.split("/")
        for label in reversed(host.split(".")):
            if (node := node.below.get(label)) is None:
                break
            walk = node.paths
            for i, segment in enumerate(segments):
                if walk is None:
                    break
                for part, size, rule, verdict in walk.ends:
                    if segment.startswith(part):
                        best = max(best, (size, verdict == "block", rule, verdict), key=lambda x: x[:2])
                walk = walk.below.get(segment) if i + 1 < len(segments) else None
        return best[2], best[3]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lowered. Path: from there up to `?`, `#` or the end."""
    url = F.coalesce(url, F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(url, shape, 1)), F.regexp_extract(url, shape, 2)


def filter_urls(rows: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """rows with host, path, rule (null: none fits) and verdict. Columns of rows with these names are replaced."""
    small_batches(rows.sparkSession)
    trie = rows.sparkSession.sparkContext.broadcast(UrlTrie(rules, default))

    @F.pandas_udf("rule string, verdict string")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        judge = trie.value.judge
        return pd.DataFrame([judge(h, p) for h, p in zip(hosts, paths, strict=True)], columns=["rule", "verdict"], dtype=object)

    host, path = host_and_path(F.col(url))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("host", "path", "rule", "verdict")]
    out = rows.select(*kept, host.alias("host"), path.alias("path"))
    found = free_name(out, "_judged")
    return out.withColumn(found, judged("host", "path")).select(*kept, "host", "path", f"{found}.rule", f"{found}.verdict")
