"""URL block and allow rules, carried to aliases over redirect and canonical-link edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch, components

#: (verdict, host, path)
Rule = tuple[str, str, str]
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*['\"]?\s*([^\"'\s>]+)"


def part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, k), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return part(url, 2)


def match_rules(df: DataFrame, rules: Sequence[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` (host and path, or null) and ``rule_verdict``: the longest rule that fits, allow before block if equally long.

    Rules are driver-side configuration. A conditional expression for each, longest first, needs neither join nor shuffle.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def resolve(base: Column, link: Column) -> Column:
    """An absolute URL from a link and the URL of the page that has it."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?://)", 1)
    site = F.concat(scheme, part(base, 1))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) from canonical links and immediate or delayed meta refreshes."""
    html, url = F.col(html_col), F.col(url_col)
    found = pages.select(
        url.alias("url"),
        F.explode(F.array(
            F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
            F.regexp_extract(F.regexp_extract(html, REFRESH, 0), REFRESH_URL, 1),
        )).alias("link"),
    )
    return found.where(F.col("url").contains("://") & (F.col("link") != "")).select("url", resolve(F.col("url"), F.col("link")).alias("target"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, default: str = "allow", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A verdict for each page: its own rule's; else block if an alias is blocked by a rule; else ``default``.

    Aliases are the connected components over canonical links and meta refreshes in the pages, and
    over ``redirects`` (url, target) if given. URLs are one node if host (any case), path and query are equal. An explicit
    allow rule of a page itself stands against a block of its aliases; targets need not be pages.
    Of several canonical links of a page, or refreshes, the first counts. Other columns, whatever their names, are ignored; very long html is whole.
    Null or relative URLs: empty host and path, no aliases, ``default``. Null html: no links. Repeated pages: a row
    each. An empty table gives no rows.
    Returns page_id, host, path, rule, verdict, component (null without aliases), alias_blocked.
    """
    scratch = Scratch(pages.sparkSession)
    node = lambda u: F.concat(host_of(u), path_of(u), part(u, 3))
    links = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        links = links.union(redirects.select("url", "target").where("url like '%://%' and target like '%://%'"))
    links = scratch.keep(links, "links")
    seen = match_rules(
        pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                     F.when(F.col(url_col).contains("://"), node(F.col(url_col))).alias("node")), rules
    )
    if links.isEmpty():
        return seen.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
                           F.lit(None).cast("string").alias("component"), F.lit(False).alias("alias_blocked"))
    edges = links.select(node(F.col("url")).alias("a"), node(F.col("target")).alias("b"))
    groups = scratch.keep(components(edges, scratch, "aliases"), "groups")
    ends = links.select(F.explode(F.array("url", "target")).alias("u")).distinct()
    said = match_rules(ends.select(host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), node(F.col("u")).alias("node")), rules)
    blocked = (
        said.join(groups, "node").groupBy("component").agg(F.max(F.col("rule_verdict") == "block").alias("alias_blocked"))
    )
    aliases = groups.join(blocked, "component").select("node", "component", "alias_blocked")
    return seen.join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("alias_blocked"), "block"), F.lit(default)).alias("verdict"),
        "component", F.coalesce("alias_blocked", F.lit(False)).alias("alias_blocked"),
    )
