"""URL filters: host and path rules, whose block decisions reach redirect and canonical aliases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import LOWER, UPPER, ascii_lower, connected_components, with_computed


SITE = r"(?s)^([^:/?#]+://[^/?#]*)"


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` (allow or block) for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError("a rule allows or blocks")

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def _fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def decide(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null. Rules are few, given by the caller."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The shortest comes first, so that longer ones override it.
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        chosen = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(_fits(rule, host, path), chosen).otherwise(found)
    return found


def url_node(url: Column) -> Column:
    """The url without its fragment, scheme and host lower-cased: what names a resource."""
    plain = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    start = F.regexp_extract(plain, r"(?s)^([^:/?#]+://[^/?#]*)", 1)
    return F.concat(F.translate(start, UPPER, LOWER), F.substr(plain, F.length(start) + 1))


def without_dots(url: Column) -> Column:
    """The url with ``.`` and ``..`` taken out of its path."""
    site = F.regexp_extract(url, SITE, 1)
    path = F.regexp_extract(url, r"(?s)^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    parts = F.split(path, "/")
    folded = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array(F.lit("")),
        lambda done, x: F.when(x == ".", done)
        .when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.array_append(done, x)),
    )
    closed = F.when(path.rlike(r"/\.\.?$"), F.array_append(folded, F.lit(""))).otherwise(folded)
    tail = F.substr(url, F.length(site) + F.length(path) + 1)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(site, F.array_join(closed, "/"), tail)).otherwise(url)


def joined(base: Column, target: Column) -> Column:
    """``target`` as seen from ``base``, dot segments not yet taken out; null if it names no other page."""
    site = F.regexp_extract(base, SITE, 1)
    plain = F.regexp_extract(base, r"(?s)^([^?#]*)", 1)
    folder = F.regexp_extract(plain, r"(?s)^[^:/?#]+://[^/]*(/.*/|/)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$") | (site == ""), F.lit(None))
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^([^:/?#]+:)//", 1), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(plain, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) from each page's url to the targets of its canonical links and refreshes.

    Relative targets are joined with the page's ``base`` element, else with its url; a page whose url has
    no ``://`` has absolute targets only. Targets of other schemes and bare fragments are no edges.
    """
    own_base = F.regexp_extract(html, r"""(?is)<base\b[^>]*?[\s"']href\s*=\s*["']?([^"'\s>]+)""", 1)
    tag = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv")).select(
        F.col(url).alias("u"),
        own_base.alias("own_base"),
        F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"),
    )
    canonical = F.col("tag").rlike(
        r"""(?is)^<link\b.*[\s"']rel\s*=\s*(?:"(?:[^"]*\s)?canonical[\s"]|'(?:[^']*\s)?canonical[\s']|canonical[\s/>])"""
    )
    refresh = F.col("tag").rlike(r"""(?is)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b""")
    href = F.regexp_extract("tag", r"""(?is)[\s"']href\s*=\s*["']?([^"'\s>]+)""", 1)
    moved = F.regexp_extract("tag", r"""(?is)\burl\s*=\s*["']?([^"'\s>;]+)""", 1)
    raw = with_computed(tag, t=F.when(canonical, href).when(refresh, moved).otherwise("")).where("t != ''")
    plain = lambda c: F.regexp_replace(c, "(?i)&amp;", "&")
    based = with_computed(raw, base=F.coalesce(joined(F.col("u"), plain("own_base")), F.col("u")))
    found = with_computed(based, dotted=joined(F.col("base"), plain("t")))
    found = with_computed(found, target=without_dots(F.col("dotted")))
    return with_computed(found, a=url_node(F.col("u")), b=url_node(F.col("target"))).select("a", "b").dropna()


def filter_urls(
    pages: DataFrame, rules: list[UrlRule], redirects: DataFrame | None = None, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per page: key, host, path, rule, verdict, and the ``component`` of its aliases.

    A page whose url fits a rule gets that rule's verdict: an explicit allow is never overridden.
    Any other page is blocked if one of its aliases (urls connected with it by redirects or
    canonical links, crawled or not) is blocked by a rule, else allowed. ``redirects`` adds edges
    (a, b) of urls to those found in the pages. Null urls fit no rule and have no alias; repeated
    rows are judged one by one; null html has no link; other columns are not touched.
    """
    host, path = url_parts(F.col("u"))
    parts = with_computed(pages.select(F.col(key).alias("k"), F.col(url).alias("u")), host=host, path=path, node=url_node(F.col("u")))
    judged = parts.drop("u").withColumn("own", decide(F.col("host"), F.col("path"), rules))
    edges = page_links(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(url_node(F.col("a")).alias("a"), url_node(F.col("b")).alias("b")).dropna())
    groups = connected_components(edges)
    if groups is None:
        own = F.coalesce("own.verdict", F.lit("allow"))
        return judged.select(F.col("k").alias(key), "host", "path", F.col("own.rule").alias("rule"), own.alias("verdict"), F.lit(None).cast("string").alias("component"))
    node_host, node_path = url_parts(F.col("node"))
    verdicts = with_computed(groups, host=node_host, path=node_path).withColumn("own", decide(F.col("host"), F.col("path"), rules))
    blocked = verdicts.groupBy("component").agg(F.max(F.coalesce(F.col("own.verdict") == "block", F.lit(False))).alias("blocked"))
    aliases = verdicts.select("node", "component").join(blocked, "component")
    linked = judged.join(aliases, "node", "left")
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    return linked.select(
        F.col("k").alias(key),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", method).alias("verdict"),
        "component",
    )
