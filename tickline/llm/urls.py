"""URL filtering with redirect equivalence.

URLs that redirect to each other or name each other as canonical are one page
under several addresses. Connected components over these edges tell which; a
block that a rule gives to any address of a component also reaches the addresses
that no rule decides. A rule that allows an address outright always wins there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.components import components
from tickline.llm.shared import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TAG = r"(?is)<{0}\b(?=[^>]*?\b{1}\s*=\s*[\"']?\s*{2}\b)[^>]*>"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to `?` or `#`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does; of equally long ones a block."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def node_of(url: Column) -> Column:
    """The address that a URL stands for: host, path and query, without scheme and fragment."""
    host, _ = host_and_path(url)
    rest = F.regexp_extract(url, r"(?s)://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.when(rest == "", "/").otherwise(rest)))


def _absolute(url: Column, base: Column) -> Column:
    """A link as a URL, relative to the page's own; null if it can't be one."""
    scheme = F.regexp_extract(base, r"(?s)^([^/?#]*?)://", 1)
    origin = F.regexp_extract(base, r"(?s)^[^/?#]*?://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"(?s)^([^/?#]*?://[^/?#]*/(?:[^?#]*/)?)", 1)
    link = F.trim(F.replace(url, F.lit("&amp;"), F.lit("&")))
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(origin == "", None)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("#"), None)
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"(?s)^[^?#]*", 0), link))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), link))
    )


def page_links(html: Column, url: Column) -> Column:
    """URLs that the page names as canonical or redirects to, as an array."""
    canonical = F.regexp_extract_all(html, F.lit(_TAG.format("link", "rel", "canonical")), F.lit(0))
    refresh = F.regexp_extract_all(html, F.lit(_TAG.format("meta", "http-equiv", "refresh")), F.lit(0))
    href = F.transform(canonical, lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]*)", 1))
    moved = F.transform(refresh, lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'>\s]*)", 1))
    links = F.transform(F.concat(href, moved), lambda u: _absolute(u, url))
    return F.filter(links, lambda u: u.isNotNull())


def filter_urls(pages: DataFrame, *, redirects: DataFrame | None = None, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: id, host, path, rule, verdict and component (the smallest address of its aliases).

    Edges come from the pages' canonical links and refresh redirects and, if
    given, from the table `redirects` (from_url, to_url). Aliases outside `pages`
    count too, with the rule that fits them. A page that no rule decides is
    blocked if a rule blocks any of its aliases, and else allowed. Null URLs, and
    those without `://`, have no host, path, aliases or rule, and are allowed.
    Equal URLs are one address.
    """
    url, html = F.col(url_col), F.col(html_col)
    host, path = host_and_path(url)
    edges = pages.where(html.rlike("(?i)canonical|refresh")).select(url.alias("from_url"), F.explode(page_links(html, url)).alias("to_url"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select("from_url", "to_url"))
    edges = cut(edges.where(node_of(F.col("from_url")).isNotNull() & node_of(F.col("to_url")).isNotNull()))
    roots = components(edges.select(node_of(F.col("from_url")).alias("u"), node_of(F.col("to_url")).alias("v")))
    ends = edges.select(F.col("from_url").alias("url")).unionByName(edges.select(F.col("to_url").alias("url"))).distinct()
    name, verdict = rule_of(*host_and_path(F.col("url")), rules)
    blocked = ends.where(verdict == "block").select(node_of(F.col("url")).alias("node")).distinct()
    blocked = roots.join(blocked, "node", "left_semi").select("root").distinct().withColumn("blocked", F.lit(True))
    alias = roots.join(blocked, "root", "left").withColumnRenamed("node", "address")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), node_of(url).alias("address")).withColumns({"rule": name, "own": verdict})
    out = judged.join(alias, "address", "left")
    verdict = F.coalesce("own", F.when(F.col("blocked"), "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), F.coalesce("root", "address").alias("component"))
