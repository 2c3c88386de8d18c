"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that any URL it matches must have. It is filed under
the one of them that is rarest in the URLs at hand, or under each of several where a match holds only one of
them; a URL's tokens fetch the rules filed under them, and only those run. A rule without tokens always runs. Host and path
rules with a verdict go before patterns; they are filed under their host, and fetched by a host and its parents. The index is
an array of buckets by the key's crc32, so what a URL costs depends on its tokens, not on the number of rules. Built-in
expressions only.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import set_aside, unused

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """Blocks what ``pattern`` finds in the URL. Each of ``tokens`` (with ``any_of``: one at least) is a whole token of any such URL, in lower case."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    any_of: bool = False


HOST_RULES = (HostRule("net", "/", "block"), HostRule("example.net", "/en/", "allow"), HostRule("example.com", "/de/", "block"), HostRule("org", "/fr/", "allow"))

PATTERN_RULES = (
    PatternRule("advert", r"(?i)://[^/?#]*/(?:[^?#]*/)?ads/", ("ads",)),
    PatternRule("banner", r"(?i)/banner[^/?#]*\.(?:gif|png|jpe?g)(?:[?#]|$)", ("gif", "png", "jpg", "jpeg"), any_of=True),
    PatternRule("casino", r"(?i)[/.-]casino[/.-]", ("casino",)),
    PatternRule("login", r"(?i)/login(?:[/?#.]|$)", ("login",)),
    PatternRule("cart", r"(?i)/cart(?:[/?#.]|$)", ("cart",)),
    PatternRule("site search", r"(?i)/search\?(?:[^#]*&)?q=", ("search", "q")),
    PatternRule("feed tracker", r"(?i)[?&]utm_source=feed(?:[&#]|$)", ("utm", "source", "feed")),
    PatternRule("print page", r"(?i)[?&]print=1(?:[&#]|$)", ("print", "1")),
    PatternRule("program file", r"(?i)\.exe(?:[?#]|$)", ("exe",)),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ://; empty without one."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(rest: Column) -> Column:
    return F.translate(F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1), _UPPER, _LOWER)


def path_of(rest: Column) -> Column:
    tail = F.substring(rest, F.length(host_of(rest)) + 1, F.length(rest))
    return F.substring_index(F.substring_index(tail, "?", 1), "#", 1)


def tokens_of(url: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-cased URL, each once."""
    return F.array_distinct(F.split(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER), "[^a-z0-9]+"))


def rarest_tokens(pages: DataFrame, rules: tuple[PatternRule, ...], url_col: str = "url") -> list[tuple[str, ...]]:
    """For each rule the tokens it is filed under: all with ``any_of``, else the one that occurs in the fewest URLs (ties: the longest, then the first in order)."""
    wanted = sorted({t for r in rules if not r.any_of for t in r.tokens})
    hits = pages.select(F.explode(F.array_intersect(tokens_of(F.col(url_col)), F.lit(wanted).cast("array<string>"))).alias("t"))
    counts = {r["t"]: r["n"] for r in hits.groupBy("t").agg(F.count("*").alias("n")).toLocalIterator()}  # no more rows than tokens in the rules
    return [r.tokens if r.any_of or not r.tokens else (min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)),) for r in rules]


#: A rule as it lies in a bucket.
_FILED = "array<array<struct<key:string,rank:int,name:string,path:string,pattern:string,verdict:string>>>"


def filed(entries: list[dict]) -> tuple[Column, int]:
    """The index of some rules (dicts with a key): its buckets as a constant, and how many they are."""
    n = 1 << max(0, (2 * len(entries) - 1).bit_length())
    buckets: list[list[dict]] = [[] for _ in range(n)]
    for e in entries:
        buckets[zlib.crc32(e["key"].encode()) % n].append(e)
    return F.from_json(F.lit(json.dumps(buckets)), _FILED), n


def fetched(index: tuple[Column, int], keys: Column) -> Column:
    """The rules filed under any of ``keys``."""
    buckets, n = index
    of_key = lambda t: F.filter(F.get(buckets, (F.crc32(t.cast("binary")) % n).cast("int")), lambda r: r["key"] == t)
    return F.flatten(F.transform(keys, of_key))


def hosts_above(host: Column) -> Column:
    """A host and its parents: a.b.c, b.c, c."""
    labels = F.split(host, "\\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def filter_urls(pages: DataFrame, *, url_col: str = "url", host_rules: tuple[HostRule, ...] = HOST_RULES, pattern_rules: tuple[PatternRule, ...] = PATTERN_RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and pattern (the name of the pattern rule that blocked it).

    The longest host rule that fits decides (of equally long ones the first by name); without one the first matching pattern blocks and anything else is
    allowed. A null URL or one without :// has empty host and path, fits no host rule, and may only match
    patterns. A column of pages with a result's name is kept with ``_in`` after its name; rows that repeat are judged alike; no pages give no rows.
    Rules are constants of the plan, of any number that the driver can hold.
    """
    pages, (url_col,) = set_aside(pages, ("host", "path", "rule", "pattern", "verdict"), url_col)
    name = unused(*pages.columns)
    rest, fit, keys = name("_rest"), name("_fit"), name("_keys")
    url = F.col(url_col)
    out = pages.withColumn(rest, after_scheme(url))
    out = out.withColumns({"host": host_of(F.col(rest)), "path": path_of(F.col(rest))}).drop(rest)
    ranked = sorted(host_rules, key=lambda r: (-len(r.name), r.name))
    hosts = filed([{"key": r.host, "rank": i, "name": r.name, "path": r.path, "verdict": r.verdict} for i, r in enumerate(ranked)])
    fits = F.filter(fetched(hosts, hosts_above(F.col("host"))), lambda r: F.startswith(F.col("path"), r["path"]))
    out = out.withColumn(fit, F.when(F.col("host") != "", F.array_min(F.transform(fits, lambda r: F.struct(r["rank"].alias("rank"), r["name"].alias("name"), r["verdict"].alias("verdict"))))))
    out = out.withColumn("rule", F.col(fit)["name"])

    places = rarest_tokens(pages, pattern_rules, url_col) if pattern_rules else []
    entries = [{"key": t, "rank": i, "name": r.name, "pattern": r.pattern} for i, (r, tokens) in enumerate(zip(pattern_rules, places, strict=True)) for t in tokens or ("",)]
    # A rule without tokens is filed under the empty key, which every URL has.
    out = out.withColumn(keys, F.when(F.col("rule").isNull() & url.isNotNull(), F.array_union(tokens_of(url), F.array(F.lit("")))))
    hits = F.filter(fetched(filed(entries), F.col(keys)), lambda r: F.rlike(url, r["pattern"]))
    first = F.array_min(F.transform(hits, lambda r: F.struct(r["rank"].alias("rank"), r["name"].alias("name"))))["name"]
    out = out.withColumn("pattern", first if entries else F.lit(None).cast("string"))
    verdict = F.coalesce(F.col(fit)["verdict"], F.when(F.col("pattern").isNotNull(), "block").otherwise("allow"))
    return out.withColumn("verdict", verdict).drop(fit, keys)
