"""URL filter: host and path rules, indexed by their rarest literal token."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import lower_ascii

TOKEN = "[A-Za-z0-9]+"
#: Up to so many rules the index is part of the expression; a larger index is a table that URL tokens are joined with.
INLINE_RULES = 5_000
ENTRY = "token string, size int, host_size int, block boolean, rule string, verdict string, regex string"


class UrlRule(NamedTuple):
    verdict: str  # allow or block
    host: str  # this host and all its subdomains
    path: str  # what the path starts with


def _tokens(rule: UrlRule) -> list[str]:
    """Tokens that every fitting URL has as whole tokens: those of the host, and of the path but for a cut last one."""
    path = re.findall(TOKEN, rule.path)
    if path and re.search(f"{TOKEN}$", rule.path):
        path.pop()
    return re.findall(TOKEN, rule.host.lower()) + path


def build_index(rules: Sequence[UrlRule]) -> list[dict]:
    """One entry per rule, under the token that the fewest rules have; ties go to the longest, then the first token."""
    own = [_tokens(r) for r in rules]
    shared = Counter(t for tokens in own for t in set(tokens))
    entries = []
    for rule, tokens in zip(rules, own):
        if not tokens:
            raise ValueError(f"rule without a letter or digit in its host: {rule}")
        host = rule.host.lower()
        entries.append({
            "token": min(tokens, key=lambda t: (shared[t], -len(t), t)), "size": len(host + rule.path),
            "host_size": len(host), "block": rule.verdict == "block", "rule": host + rule.path, "verdict": rule.verdict,
            "regex": r"(?s)\A(?:[^/]*\.)?" + re.escape(host + rule.path) + ("" if rule.path else r"(?=/|\z)"),
        })
    return entries


def _host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _url_tokens() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.concat("host", F.lit("/"), "path"), F.lit(TOKEN), F.lit(0)))


def _fits(entry: Column) -> Column:
    return F.rlike(F.concat("host", "path"), entry["regex"])


def _rank(entry: Column) -> Column:
    """Longest rule first, then the longer host, then block before allow."""
    return F.struct(entry["size"].alias("size"), entry["host_size"].alias("host_size"), entry["block"].alias("block"),
                    entry["rule"].alias("rule"), entry["verdict"].alias("verdict"))


def _inline(parts: DataFrame, index: list[dict]) -> DataFrame:
    """Buckets of the index by the token's crc32; a row looks at the buckets of its own tokens only."""
    count = max(1, 2 * len(index))
    buckets: list[list[dict]] = [[] for _ in range(count)]
    for entry in index:
        buckets[zlib.crc32(entry["token"].encode()) % count].append(entry)
    lookup = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>>")

    def candidates(token: Column) -> Column:
        return F.filter(F.get(lookup, (F.crc32(token.cast("binary")) % count).cast("int")), lambda e: e["token"] == token)

    found = F.filter(F.flatten(F.transform(_url_tokens(), candidates)), _fits)
    return parts.withColumn("best", F.array_max(F.transform(found, _rank)))


def _joined(parts: DataFrame, index: list[dict]) -> DataFrame:
    """The same by joins: distinct hosts and paths, their tokens, the rules of these tokens."""
    rules = parts.sparkSession.createDataFrame([tuple(e[f.split()[0]] for f in ENTRY.split(", ")) for e in index], ENTRY)
    fitting = (
        parts.select("host", "path").distinct().withColumn("token", F.explode(_url_tokens()))
        .join(rules.select("token", F.struct(*rules.columns).alias("entry")), "token").filter(_fits(F.col("entry")))
    )
    best = fitting.groupBy("host", "path").agg(F.max(_rank(F.col("entry"))).alias("best"))
    return parts.join(best, ["host", "path"], "left")


def url_filter(pages: DataFrame, rules: Sequence[UrlRule], default: str = "allow",
               inline_rules: int = INLINE_RULES) -> DataFrame:
    """Judge every page's url.

    A rule is stored under its rarest literal token. A URL's tokens fetch the candidate rules, and only those run
    their regular expression. Of fitting rules the longest wins. Without one, ``rule`` is null and the verdict is
    ``default``. One row out for each row in: page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path. Repeated rows stay; other columns are not read.
    An empty table gives no rows, an empty list of rules gives the default throughout. Up to ``inline_rules`` rules
    nothing is shuffled; more are joined as a table.
    """
    index = build_index(rules)
    parts = pages.select("page_id", _host(F.col("url")).alias("host"), _path(F.col("url")).alias("path"))
    judged = (_inline if len(index) <= inline_rules else _joined)(parts, index)
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
