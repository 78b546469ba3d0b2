"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule (host, path, verdict) fits its host and all subdomains if the url's path
starts with the rule's path.  Of all fitting rules, allow and block alike, the
longest wins: most host labels first, then the longest path; the same rule
given with both verdicts blocks.  Urls that no rule fits get ``default``.

The trie walks the host's labels from the right and, at each host node, the
path's segments, so a url costs its own length whatever the number of rules.
It is broadcast only while the rules' text is at most ``max_broadcast_bytes``
(checked); larger rule tables take the same longest match by an equality join
on (host suffix, path directory), with no broadcast.

Defined cases: a null url, or one without "://", has empty host and path, so
no rule fits; an empty rule list gives every url the default; rules with a
null host or path are ignored; repeated rows give repeated results; an empty
table gives an empty result; other columns pass through (the judgement is one
struct column).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MAX_BROADCAST_BYTES = 8 << 20


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?``, ``#`` or the end)."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Host nodes by reversed label; each may hold a trie of path segments (plain dicts, so it broadcasts).

    A rule's last path segment matches as a prefix of the url's segment there
    (``/en/`` ends in an empty one, ``/en`` also fits ``/english``).
    """
    root: dict = {"next": {}, "paths": None}
    for host, path, verdict in rules:
        if host is None or path is None:
            continue
        node = root
        for label in reversed(host.lower().split(".")):
            node = node["next"].setdefault(label, {"next": {}, "paths": None})
        if node["paths"] is None:
            node["paths"] = {"next": {}, "ends": {}}
        *whole, last = path.split("/")
        at = node["paths"]
        for segment in whole:
            at = at["next"].setdefault(segment, {"next": {}, "ends": {}})
        if at["ends"].get(last, ("", ""))[1] != "block":
            at["ends"][last] = (host + path, verdict)
    return root


def find(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits, or None."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node["next"].get(label)
        if node is None:
            break
        if node["paths"] is not None:
            best = _find_path(node["paths"], path) or best
    return best


def _find_path(at: dict, path: str) -> tuple[str, str] | None:
    best = None
    for segment in path.split("/"):
        for n in range(len(segment), -1, -1) if at["ends"] else ():
            if segment[:n] in at["ends"]:
                best = at["ends"][segment[:n]]
                break
        at = at["next"].get(segment)
        if at is None:
            break
    return best


_RESULT = "host string, path string, rule string, verdict string"


def judge(pages: DataFrame, rules, url_col: str = "url", default: str = "allow",
          max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``pages`` as one struct column ``page`` plus the struct ``url_rule`` (host, path, rule, verdict).

    ``rules``: a list of (host, path, verdict), or a DataFrame with these columns.
    """
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"))
    host, path = host_path(F.col(f"page.`{url_col}`"))
    packed = packed.withColumn("h", host).withColumn("p", path)
    if isinstance(rules, DataFrame):
        size = rules.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 16), F.lit(0))).first()[0]
        if size > max_broadcast_bytes:
            return _judge_by_join(packed, rules, default)
        rules = [tuple(r) for r in rules.select("host", "path", "verdict").toLocalIterator()]
    elif sum(len((h or "") + (p or "")) + 16 for h, p, _ in rules) > max_broadcast_bytes:
        return _judge_by_join(packed, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"),
                              default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf(_RESULT.replace("host string, path string, ", ""))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        t = trie.value
        for hosts, paths in batches:
            found = [find(t, h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype="object")

    r = packed.withColumn("r", run("h", "p"))
    return r.select("page", F.struct(F.col("h").alias("host"), F.col("p").alias("path"),
                                     "r.rule", "r.verdict").alias("url_rule"))


def _judge_by_join(packed: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same match without a broadcast: each distinct (host, path) meets the rules of its own
    host suffixes and path directories by equality; the rule's last segment is checked after."""
    def directory(p):
        return F.regexp_extract(p, r"(?s)^(.*)/[^/]*$", 1)

    keyed = (rules.where("host is not null and path is not null")
             .select(F.lower("host").alias("rh"), F.col("path").alias("rp"), F.concat("host", "path").alias("rule"), "verdict")
             .withColumn("rd", F.when(F.contains("rp", F.lit("/")), F.concat(directory(F.col("rp")), F.lit("/"))).otherwise("")))
    urls = packed.select("h", "p").distinct()
    labels, parts = F.split("h", r"\."), F.split("p", "/")
    spread = (urls
              .withColumn("rh", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(
                  ".", F.slice(labels, i, F.size(labels) - i + 1)))))
              .withColumn("rd", F.explode(F.concat(F.array(F.lit("")), F.when(F.size(parts) > 1, F.transform(
                  F.sequence(F.lit(1), F.size(parts) - 1),
                  lambda i: F.concat(F.concat_ws("/", F.slice(parts, F.lit(1), i)), F.lit("/")))).otherwise(
                      F.array().cast("array<string>"))))))
    hits = (spread.join(keyed, ["rh", "rd"]).where(F.startswith("p", F.col("rp")))
            .groupBy("h", "p").agg(F.max(F.struct(
                F.size(F.split("rh", r"\.")).alias("n"), F.length("rp").alias("m"),
                F.col("verdict"), F.col("rule"))).alias("x")))  # "block" sorts after "allow"
    return packed.join(hits, ["h", "p"], "left").select("page", F.struct(
        F.col("h").alias("host"), F.col("p").alias("path"), F.col("x.rule").alias("rule"),
        F.coalesce("x.verdict", F.lit(default)).alias("verdict")).alias("url_rule"))


def allowed(pages: DataFrame, rules, **kw) -> DataFrame:
    """The rows of ``pages`` whose verdict is not ``block``, same columns."""
    return judge(pages, rules, **kw).where("url_rule.verdict <> 'block'").select("page.*")
