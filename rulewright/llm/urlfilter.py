"""URL filters whose decisions reach the aliases of a page.

Rules block or allow a host, its subdomains and a path prefix; the longest
rule that fits a url decides it.  Pages that redirect to one another (meta
refresh, or a table of redirects) or name one another as canonical are
aliases; a url without a rule of its own gets what its aliases' rules say.
Allow comes first: a url that a rule allows stays allowed whatever its
aliases are, and among aliases one allowed url outweighs blocked ones.

Everything is column expressions; aliases are the connected components of the
edges, and only urls that have an edge take part in joins.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, graph

BLOCK, ALLOW = "block", "allow"


class Rule(NamedTuple):
    action: str
    host: str
    path: str


def rule(action: str, pattern: str) -> Rule:
    """``rule("block", "example.com/de/")``: all up to the first slash is the host, the rest, slash included, the path."""
    host, slash, path = pattern.partition("/")
    return Rule(action, host, slash + path)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def identity(url: Column) -> Column:
    """What makes two urls the same node: scheme and host in lower case, path and query; no fragment."""
    scheme = F.translate(F.substring_index(url, "://", 1), _UPPER, _LOWER)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host(url), path(url), query))


def decide(rules: list[Rule], at_host: Column, at_path: Column) -> Column:
    """struct(rule, action) of the longest rule that fits, else null; of equally long ones, allow before block, then by name."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.action == ALLOW, r.host + r.path)):
        fits = ((at_host == r.host) | F.endswith(at_host, F.lit("." + r.host))) & F.startswith(at_path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def resolve(base: Column, link: Column) -> Column:
    """An absolute url of a link found at `base`; null without one."""
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    scheme, site = F.substring_index(base, "://", 1), F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_extract(path(base), r"^.*/", 0)
    absolute = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("?"), F.concat(site, path(base), link))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )
    return F.when((F.instr(base, "://") > 0) & (link != "") & ~link.startswith("#"), absolute)


def aliases(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(a, b): urls that pages declare equal, as nodes; `redirects` (from_url, to_url) adds more."""
    html = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)
    tag = F.col("tag")

    def attribute(name: str) -> Column:
        value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return F.regexp_replace(value, r"""^["']|["']$""", "")

    canonical = F.when(F.lower(attribute("rel")).rlike(r"(^|\s)canonical(\s|$)"), attribute("href"))
    refresh = F.when(F.lower(attribute("http-equiv")) == "refresh", F.regexp_extract(attribute("content"), r"""(?is)url\s*=\s*["']?([^"']*)""", 1))
    found = pages.where(F.col("url").isNotNull() & F.col("html").rlike(r"(?i)canonical|http-equiv")).select("url", F.explode(tags).alias("tag"))
    links = found.select("url", _once(F.coalesce(canonical, refresh)).alias("link")).where("link <> ''")
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("from_url").alias("url"), F.col("to_url").alias("link")))
    links = links.select("url", _once(resolve(F.col("url"), F.col("link"))).alias("target")).where("target is not null")
    return links.select(_once(identity(F.col("url"))).alias("a"), "target").select("a", _once(identity(F.col("target"))).alias("b")).where("a <> b")


def _once(value: Column) -> Column:
    """`value` as a column that later expressions refer to; without the generator Spark writes it out in each of them."""
    return F.explode(F.array(value))


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and reason (rule, alias or default) of every row of `pages` (page_id, url, html).

    A null url, or one without ``://``, has an empty host and path, no rule
    unless one fits those, no aliases, and is allowed.  A null html declares
    nothing.  Repeated rows each get a row, an empty table gives none, other
    columns are ignored.
    """
    edges = common.settle(aliases(pages, redirects), "aliases")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"))
    rows = rows.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), identity(F.col("url")).alias("node"))
    rows = rows.withColumn("own", decide(rules, F.col("host"), F.col("path")))
    if edges.isEmpty():
        said = F.lit(None).cast("string")
    else:
        nodes = graph.components(edges).withColumn("own", decide(rules, host(F.col("node")), path(F.col("node")))["action"])
        spoken = nodes.groupBy("root").agg(F.min("own").alias("said"))  # "allow" sorts before "block"
        nodes = nodes.join(spoken.where("said is not null"), "root").select("node", "said")
        # Urls that are no node would all meet in one task; they get keys that no node has.
        apart = F.concat(F.lit("#"), F.pmod(F.xxhash64("page_id"), F.lit(4096)).cast("string"))
        rows = rows.withColumn("node", F.coalesce("node", apart)).join(nodes, "node", "left")
        said = F.col("said")
    verdict = F.coalesce(F.col("own.action"), said, F.lit(ALLOW))
    reason = F.when(F.col("own").isNotNull(), "rule").when(said.isNotNull(), "alias").otherwise("default")
    return rows.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), reason.alias("reason"))
