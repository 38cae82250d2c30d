"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host and a path prefix. It becomes an anchored regular expression over `host || path`, and is filed under one
of its literal tokens: the one that the judged URLs hold least often. A URL's own tokens fetch candidate rules from that
index, and only candidates run their regular expression. A list of at most LITERAL_RULES rules is a literal of the plan: no
join, no shuffle of URLs. A longer list, or a table of rules of any length, is joined with the distinct URLs by token.

Defined cases: a null URL, or one without `://`, has an empty host and path, matches no rule and takes the default
verdict. Repeated rows are judged alike, an empty table gives an empty result, and an input column of an output's name stays
as `<name>_input`. Of rules with the same host and path the one that blocks counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, let, set_aside, unused

LITERAL_RULES = 2000
OUTPUTS = ("host", "path", "rule", "verdict")
VERDICTS = ("allow", "block")
_TOKEN = re.compile("[A-Za-z0-9]+")
#: Same tokens in a URL: runs of ASCII letters and digits.
_SPLIT = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """`host` fits itself and its subdomains; `path` (with its leading slash) is a prefix of the URL's path."""

    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        quoted = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else "\\" + c for c in self.name)
        return r"\A(?:[^/]*\.)?" + quoted + ("" if self.path else r"(?:/|\z)")

    def tokens(self) -> set[str]:
        """Literal tokens that every URL fitting the rule holds whole: all but a last one that a longer token may continue."""
        whole = self.name if not self.path else self.name[: max(i for i in range(len(self.name) + 1) if i == 0 or not self.name[i - 1].isalnum())]
        return set(_TOKEN.findall(whole))


def parse_rule(text: str) -> UrlRule:
    """`block net/de/` or `allow example.com/en/7`: a verdict, a host and a path prefix."""
    verdict, _, rest = text.strip().partition(" ")
    host, slash, path = rest.strip().partition("/")
    if verdict not in VERDICTS or not host:
        raise ValueError(f"not a URL rule: {text!r}")
    return UrlRule(verdict, host.lower(), slash + path)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rarest(pages: DataFrame, rules: list[UrlRule], url: str) -> dict[UrlRule, str | None]:
    """Each rule's rarest token among all judged URLs; ties go to the longer token. The result has a row per rule token."""
    known = sorted(set().union(*(r.tokens() for r in rules)))
    if not known:
        return dict.fromkeys(rules)
    # A token that a rule takes from its host is seen lower-cased there, so both spellings of a URL count.
    counts = pages.select(F.explode(F.array_intersect(_tokens(host_of(F.col(url)), path_of(F.col(url))), F.lit(known))).alias("t")).groupBy("t").count()
    seen = {r["t"]: r["count"] for r in counts.collect()}
    return {r: min(r.tokens(), key=lambda t: (seen.get(t, 0), -len(t), t), default=None) for r in rules}


def _tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(F.concat(host, path), _SPLIT))


def filter_urls(pages: DataFrame, rules: list[UrlRule] | DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Append host, path, rule (name of the longest fitting rule or null) and verdict to every row.

    A table of rules has the string columns verdict, host and path.
    """
    pages = set_aside(pages, *OUTPUTS)
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if isinstance(rules, list) and len(rules) > LITERAL_RULES:
        rules = pages.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    if isinstance(rules, DataFrame):
        return _by_table(pages, rules, default)
    if not rules:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    index: dict[str, list[UrlRule]] = {}
    loose = []
    for rule, token in _rarest(pages.select(url), rules, url).items():
        index.setdefault(token, []).append(rule) if token else loose.append(rule)

    def entry(rule: UrlRule) -> Column:
        return F.struct(F.lit(len(rule.name)).alias("size"), F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"), F.lit(rule.pattern).alias("pattern"))

    filed = F.create_map(*(x for t in sorted(index) for x in (F.lit(t), F.array(*map(entry, index[t]))))) if index else None
    subject = F.concat(F.col("host"), F.col("path"))
    found = F.flatten(F.transform(F.array_intersect(_tokens(F.col("host"), F.col("path")), F.lit(sorted(index))), lambda t: filed[t])) if index else F.array().cast("array<struct<size:int,name:string,verdict:string,pattern:string>>")
    if loose:
        found = F.concat(found, F.array(*map(entry, loose)))
    fits = let(subject, lambda s: F.array_max(F.filter(found, lambda r: F.regexp_like(s, r["pattern"]))))
    best = unused("_fit", pages)
    return pages.withColumn(best, fits).withColumns({"rule": F.col(f"{best}.name"), "verdict": F.coalesce(F.col(f"{best}.verdict"), F.lit(default))}).drop(best)


def _by_table(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same with rules as a table: URLs meet the rules filed under one of their tokens by a join.

    Distinct URLs are judged once. Both sides of each join are dealt by a shuffle of their own, so that adaptive execution
    splits a token or URL that very many rows hold.
    """
    rules = rules.select(F.lower("host").alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict").groupBy("h", "p").agg(F.max("verdict").alias("v"))
    name = F.concat("h", "p")
    # Tokens that every fitting URL holds whole, as in UrlRule.tokens.
    whole = F.when(F.col("p") == "", name).otherwise(F.regexp_replace(name, r"[\p{L}\p{N}]+\z", ""))
    quoted = F.concat(F.lit(r"\A(?:[^/]*\.)?\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"), F.when(F.col("p") == "", r"(?:/|\z)").otherwise(""))
    tokens = F.filter(F.array_distinct(F.split(whole, _SPLIT)), lambda t: t != "")
    rules = rules.select(name.alias("name"), "v", quoted.alias("pattern"), F.explode(F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit("")))).alias("token"))
    subjects = pages.select("host", "path").distinct()
    # The empty token stands for rules without any; every URL looks it up.
    held = subjects.select("host", "path", F.explode(F.array_union(_tokens(F.col("host"), F.col("path")), F.array(F.lit("")))).alias("token"))
    counts = held.groupBy("token").count()
    rarity = F.struct(F.coalesce("count", F.lit(0)), -F.length("token"), "token")
    filed = rules.join(counts, "token", "left").groupBy("name", "v", "pattern").agg(F.min_by("token", rarity).alias("token"))
    met = held.repartition("token").join(filed.repartition("token"), "token").filter(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
    best = met.groupBy("host", "path").agg(F.max(F.struct(F.length("name").alias("size"), "name", "v")).alias("fit")).select("host", "path", F.col("fit.name").alias("rule"), F.col("fit.v").alias("verdict"))
    found = pages.repartition("host", "path").join(best.repartition("host", "path"), ["host", "path"], "left")
    return found.select(*pages.columns, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


#: The production rule list.
RULES = [parse_rule(x) for x in ("block com/en/", "allow example.com/en/7", "allow net/de/", "block example.net/de/8", "block org/es/")]

SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(rule, rhost, rpath, v) AS (VALUES ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'),
  ('net/de/', 'net', '/de/', 'allow'), ('example.net/de/8', 'example.net', '/de/8', 'block'), ('org/es/', 'org', '/es/', 'block')),
j AS (
  SELECT u.*, (SELECT max(struct_pack(n := length(rule), rule := rule, v := v)) FROM r
    WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)) AS fit
  FROM u)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.v, 'allow') AS verdict FROM j
"""


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
