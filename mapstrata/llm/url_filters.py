"""URL filter with redirect equivalence, in DataFrame functions only.

Rules judge single urls; connected components over redirect and canonical-link edges carry block
decisions to the aliases of a blocked url. Of the rules that fit a url the longest counts, of equally long ones an allow rule,
then the one that sorts last. Precedence: the url's own rule; else allow if any alias has an
allow rule; else block if any alias has a block rule; else allow.

Null or broken urls have empty host and path, no rule and no alias, so they are allowed. Equal urls get
equal verdicts; every input row returns once; an empty table returns no row. Columns of ``pages`` other
than the id, url and html are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.llm.components import connected_components
from mapstrata.operators.joins import bytes_of, joined_with_few
from mapstrata.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """action, host, path of listed rules: one literal of the plan, however many they are."""
    text = json.dumps([{"action": r.action, "host": r.host, "path": r.path} for r in rules])
    kind = "array<struct<action:string,host:string,path:string>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def longest_rules(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, ``own`` (size, allow and text of the longest rule that fits) of the rows of ``sites`` (host, path) that a rule
    fits. ``rules``: action, host, path.

    The host's suffixes meet the hosts of rules, and the path's beginnings, of the lengths that a host's rules have, meet the rules, so
    the work of a url grows with its labels and not with the rules. Rules are broadcast when few, else salted; each
    distinct site is matched once.
    """
    text = F.concat("host", "path")
    known = cut_lineage(
        rules.select(
            F.col("host").alias("suffix"), F.col("path").alias("prefix"),
            F.struct(F.length(text).alias("size"), (F.col("action") == "allow").alias("allow"), text.alias("text")).alias("rule"),
        )
        .groupBy("suffix", "prefix")
        .agg(F.max("rule").alias("rule"))
    )
    size = bytes_of(known)
    hosts = known.groupBy("suffix").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    most = known.agg(F.max(F.size(F.split("suffix", "\\.")))).first()[0] or 0
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max(most, 1)), F.size(labels))), lambda k: F.array_join(F.slice(labels, -k, k), ".")
    )
    tried = sites.select("host", "path").distinct().select("host", "path", F.explode(suffixes).alias("suffix"))
    spread = [F.col("host"), F.col("path")]
    begun = joined_with_few(tried, hosts, ["suffix"], spread, size=size)
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    cut = begun.select("host", "path", "suffix", F.explode(fitting).alias("n"))
    cut = cut.select("host", "path", "suffix", F.expr("left(path, n)").alias("prefix"))
    found = joined_with_few(cut, known, ["suffix", "prefix"], spread, size=size)
    return found.groupBy("host", "path").agg(F.max("rule").alias("own"))


def url_key(url: Column) -> Column:
    """Name of a resource: host, path and query; scheme and fragment do not tell resources apart, and an empty path is
    the path ``/``."""
    rest = F.regexp_extract(after_scheme(url), "^[^/?#]*([^#]*)", 1)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), rest))


def resolved(link: Column, base: Column) -> Column:
    """Absolute url of ``link`` on a page at ``base``."""
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, "^(.*?://)", 1)
    site = F.regexp_extract(base, "^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(F.length(link) == 0, None)
        .when(F.instr(link, "://") > 0, link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.substring(link, 3, 1 << 30)))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .otherwise(F.concat(folder, link))
    )


# canonical as any of the words of rel
CANONICAL_TAG = (
    r"(?i)(<link\s[^>]*\brel\s*=\s*"
    r"""(?:"(?:[^">]*\s)?canonical[\s"]|'(?:[^'>]*\s)?canonical[\s']|canonical(?=[\s/>]))[^>]*>)"""
)
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]*)"
REFRESH_TAG = r"(?i)(<meta\s[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'>\s]*)"


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(from_url, to_url) of the canonical link and the refresh redirect of every page that has one."""
    lower = F.lower(html)
    tagged = pages.where((F.instr(lower, "canonical") > 0) | (F.instr(lower, "refresh") > 0)).select(
        F.col(url).alias("from_url"),
        F.array(
            F.regexp_extract(F.regexp_extract(html, CANONICAL_TAG, 1), HREF, 1),
            F.regexp_extract(F.regexp_extract(html, REFRESH_TAG, 1), REFRESH_URL, 1),
        ).alias("links"),
    )
    links = tagged.select("from_url", F.explode("links").alias("link"))
    return links.select("from_url", resolved(F.col("link"), F.col("from_url")).alias("to_url")).where(
        F.col("to_url").isNotNull()
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule] | DataFrame, redirects: DataFrame | None = None, page_id: str = "page_id"
) -> DataFrame:
    """(id, host, path, rule, verdict, propagated) for every row of ``pages``. ``rules``: a list, or a table of action, host and
    path of any size. ``redirects``: further (from_url, to_url) pairs, such as a crawler's redirect log; both ends are judged
    by the rules. Without canonical links and redirects the verdicts are those of the rules alone."""
    listed = rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)
    links = link_edges(pages)
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url"))
    ends = links.select(
        url_key(F.col("from_url")).alias("a"), url_key(F.col("to_url")).alias("b"), "from_url", "to_url"
    ).where("a <> b")
    ends = cut_lineage(ends)
    groups = connected_components(ends)

    named = ends.select(F.col("a").alias("node"), F.col("from_url").alias("u")).union(ends.select("b", "to_url"))
    named = named.select("node", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path")).distinct()
    judged = pages.select(
        page_id, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), url_key(F.col("url")).alias("key")
    )
    own = longest_rules(judged.select("host", "path").union(named.select("host", "path")), listed)
    own = cut_lineage(own)
    ruled = named.join(own, ["host", "path"]).select("node", F.col("own.allow").alias("allow"))
    decided = ruled.join(groups, "node").groupBy("component").agg(F.bool_or("allow").alias("alias_allow"))
    propagated = groups.join(decided, "component").select(F.col("node").alias("key"), "alias_allow")

    # urls without a key have no alias: a name of their own each keeps them from meeting in one task
    lone = F.concat(F.lit("\0"), F.xxhash64(F.col(page_id), F.rand(0)).cast("string"))
    placed = judged.withColumn("key", F.coalesce("key", lone))
    placed = placed.join(own, ["host", "path"], "left").join(propagated, "key", "left")
    allow = F.coalesce(F.col("own.allow"), F.col("alias_allow"), F.lit(True))
    return placed.select(
        page_id,
        "host",
        "path",
        F.col("own.text").alias("rule"),
        F.when(allow, "allow").otherwise("block").alias("verdict"),
        (F.col("own").isNull() & F.col("alias_allow").isNotNull()).alias("propagated"),
    )
