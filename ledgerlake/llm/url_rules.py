"""URL filter: a trie over reversed host labels and path segments, longest match between allow and block rules.

A rule is (action, host, path).  It fits a url when the url's host is the rule's
host or a subdomain of it and the url's path starts with the rule's path.  Of the
fitting rules the one with most host labels wins, then the longest path; the same
host and path given as both allow and block is a block.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule; an url that fits no rule gets ``default``; repeated rows are judged
each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, worker_cache

MAX_RULES = 1_000_000      # the trie is broadcast: more entries are refused, not cut

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_REST = re.compile(r"([^/?#]*)([^?#]*)")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of an url; both empty without ``://``."""
    if not url or "://" not in url:
        return "", ""
    m = _REST.match(url, url.index("://") + 3)
    return m.group(1).translate(_LOWER), m.group(2)


class RuleTrie:
    """Node: child labels, and below each host its path nodes; a path node keeps what may start the next segment."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.hosts: dict = {"next": {}, "paths": None}
        for n, (action, host, path) in enumerate(rules):
            if n >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules: split the list into several filters")
            if action not in ("allow", "block"):
                raise ValueError(f"unknown action {action!r}")
            host = host.translate(_LOWER)
            node = self.hosts
            for label in reversed(host.split(".")):
                node = node["next"].setdefault(label, {"next": {}, "paths": None})
            node["paths"] = node["paths"] or {"next": {}, "starts": {}}
            *whole, start = path.split("/")
            at = node["paths"]
            for segment in whole:
                at = at["next"].setdefault(segment, {"next": {}, "starts": {}})
            if at["starts"].get(start, ("",))[0] != "block":
                at["starts"][start] = (action, host + path)

    def _path(self, node: dict | None, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if node is None:
                break
            starts = [s for s in node["starts"] if segment.startswith(s)]
            if starts:
                best = node["starts"][max(starts, key=len)]
            node = node["next"].get(segment)
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(action, rule) of the longest fitting rule."""
        best, node, segments = None, self.hosts, path.split("/")
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node["next"].get(label)
            if node is None:
                break
            best = self._path(node["paths"], segments) or best
        return best


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict."""
    rules = list(rules)
    RuleTrie(rules)                                   # refuses bad or too many rules before any task runs
    shared, key = pages.sparkSession.sparkContext.broadcast(rules), f"trie:{uuid.uuid4().hex}"

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        t = worker_cache(key, lambda: RuleTrie(shared.value))
        rows = []
        for url in urls:
            host, path = split_url(url)
            action, rule = t.find(host, path) or (default, None)
            rows.append((host, path, rule, action))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return pick(pages, id=id_col, url=url_col).withColumn("j", judge("url")).select(F.col("id").alias(id_col), "j.*")
