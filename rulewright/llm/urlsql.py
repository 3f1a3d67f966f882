"""The URL filter in the SQL of DuckDB, for comparison."""

from __future__ import annotations

from .urlfilter import ALLOW, Rule


def _rest(u: str) -> str:
    return f"(CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END)"


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _host(u: str) -> str:
    return _lower(f"regexp_extract({_rest(u)}, '^[^/?#]*')")


def _path(u: str) -> str:
    return f"regexp_extract({_rest(u)}, '^[^/?#]*([^?#]*)', 1)"


def _node(u: str) -> str:
    query = f"regexp_extract({_rest(u)}, '^[^?#]*(\\?[^#]*)?', 1)"
    return f"(CASE WHEN strpos({u}, '://') > 0 THEN {_lower(f'split_part({u}, {chr(39)}://{chr(39)}, 1)')} || '://' || {_host(u)} || {_path(u)} || {query} END)"


def _decided(rules: list[Rule], host: str, path: str, what: str) -> str:
    ordered = sorted(rules, key=lambda r: (len(r.host + r.path), r.action == ALLOW, r.host + r.path), reverse=True)
    fits = lambda r: f"({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}')"
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.host + r.path if what == 'rule' else r.action}'" for r in ordered) + " END"


def _attribute(name: str) -> str:
    return f"""regexp_replace(regexp_extract(tag, '(?is)\\s{name}\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s"''>]+)', 1), '^["'']|["'']$', '', 'g')"""


def oracle(rules: list[Rule]) -> str:
    """The rows that `urlfilter.judge` gives for `pages` without a table of redirects."""
    clean = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g')"
    folder = f"regexp_extract({_path('url')}, '(?s)^.*/')"
    site = "regexp_extract(url, '^[^:/?#]+://[^/?#]*')"
    target = rf"""CASE WHEN strpos(url, '://') = 0 OR link = '' OR starts_with(link, '#') THEN NULL WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN split_part(url, '://', 1) || ':' || link
      WHEN starts_with(link, '/') THEN {site} || link WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(link, '?') THEN {site} || {_path("url")} || link ELSE {site} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || link END"""
    return rf"""WITH RECURSIVE tags AS (SELECT url, unnest(regexp_extract_all({clean}, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|http-equiv')),
    links AS (SELECT url, replace(trim(coalesce(CASE WHEN regexp_matches(lower({_attribute("rel")}), '(^|\s)canonical(\s|$)') THEN {_attribute("href")} END,
      CASE WHEN lower({_attribute("http-equiv")}) = 'refresh' THEN regexp_extract({_attribute("content")}, '(?is)url\s*=\s*["'']?([^"'']*)', 1) END), ' '), '&amp;', '&') AS link FROM tags),
    targets AS (SELECT url, {target} AS target FROM links WHERE link <> ''),
    e AS (SELECT {_node("url")} AS a, {_node("target")} AS b FROM targets WHERE target IS NOT NULL), s AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
    r AS (SELECT a AS node, a AS other FROM s UNION SELECT r.node, s.b FROM r JOIN s ON r.other = s.a),
    said AS (SELECT node, min({_decided(rules, _host("other"), _path("other"), "action")}) AS said FROM r GROUP BY node),
    p AS (SELECT page_id, {_host("coalesce(url, '')")} AS host, {_path("coalesce(url, '')")} AS path, {_node("url")} AS node FROM pages),
    d AS (SELECT *, {_decided(rules, "host", "path", "rule")} AS rule, {_decided(rules, "host", "path", "action")} AS own FROM p)
    SELECT page_id, host, path, rule, coalesce(own, said, '{ALLOW}') AS verdict, CASE WHEN rule IS NOT NULL THEN 'rule' WHEN said IS NOT NULL THEN 'alias' ELSE 'default' END AS reason FROM d LEFT JOIN said USING (node)"""
