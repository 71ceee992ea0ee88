"""URL allow / block rules whose block decisions spread over redirect aliases.

A rule names a host and a path start; it fits that host and all its subdomains.
The longest fitting rule decides. A URL without a fitting rule takes part in
redirect equivalence: canonical links and meta refreshes of the landed pages are
edges between URLs, connected components are found with shuffles only, and a
component that holds a blocked URL blocks its members, unless it also holds an
explicitly allowed URL. Everything else is allowed.

Null URLs and URLs without ``://`` have empty host and path, fit no rule and
have no aliases; null html has no edges, null page ids are returned as they are, long
urls and pages are read whole. Of rules that fit equally long the later in
code point order decides, block before allow. Repeated rows are judged alike, an
empty table gives an empty result, other columns are ignored. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from appraise.llm.components import components

# Rules of the query: (host, path start, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
INLINE_RULES = 200          # up to here rules are a literal; longer lists are joined by host

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COMMENT = r"(?s)<!--.*?-->"
LINK_TAG = r"(?is)<link\s[^>]*>"
META_TAG = r"(?is)<meta\s[^>]*>"
IS_CANONICAL = r"(?is)\srel\s*=\s*[\"']?canonical[\"'\s/>]"
IS_REFRESH = r"(?is)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"
HREF = r"(?is)\shref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)url\s*=\s*[\"']?([^\"'\s>]+)"


SCHEME = r"(?s)^(.*?)://"
AUTHORITY = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
AFTER_HOST = r"(?s)^.*?://[^/?#]*([^#]*)"


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, AUTHORITY), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, PATH)


def node_of(url: Column) -> Column:
    """The URL as a graph node: scheme and host lower-cased, no fragment; null without host."""
    return F.when(url.rlike(r"(?s)^.*?://[^/?#]"), F.concat(
        F.lower(_part(url, SCHEME)), F.lit("://"), host_of(url), _part(url, AFTER_HOST)))


def host_suffixes(host: Column) -> Column:
    """The host and every parent domain: a.b.c -> [a.b.c, b.c, c]."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (size, rule, verdict) of the longest fitting rule, null if none (literal rules)."""
    table = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p"), F.lit(v).alias("v"))
                      for h, p, v in rules])
    fits = F.filter(table, lambda r: ((host == r["h"]) | host.endswith(F.concat(F.lit("."), r["h"])))
                    & path.startswith(r["p"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["h"]) + F.length(r["p"])).alias("size"), F.concat(r["h"], r["p"]).alias("rule"),
        r["v"].alias("verdict"))))


def with_rule(df: DataFrame, rules: list[tuple[str, str, str]], host: str = "host",
              path: str = "path") -> DataFrame:
    """Add struct ``_rule``. Long rule lists are equi-joined on every parent domain."""
    if not rules:
        return df.withColumn("_rule", F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))
    if len(rules) <= INLINE_RULES:
        return df.withColumn("_rule", fitting_rule(F.col(host), F.col(path), rules))
    table = df.sparkSession.createDataFrame(rules, "_h string, _p string, _v string")
    best = (df.select(host, path).distinct()
            .withColumn("_h", F.explode(host_suffixes(F.col(host))))
            .join(table, "_h").where(F.col(path).startswith(F.col("_p")))
            .groupBy(host, path).agg(F.max(F.struct(
                (F.length("_h") + F.length("_p")).alias("size"),
                F.concat("_h", "_p").alias("rule"), F.col("_v").alias("verdict"))).alias("_rule")))
    return df.join(best, [host, path], "left")


def resolved(target: Column, scheme: Column, host: Column, path: Column) -> Column:
    """``target`` as an absolute URL, seen from a page with these parts."""
    site = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (F.when(F.instr(target, "://") > 0, target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target)))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) nodes joined by a canonical link or a meta refresh of a page."""
    hinted = pages.select(F.col(f"`{url_col}`").alias("_u"), F.col(f"`{html_col}`").alias("_h")).where(
        F.col("_h").rlike(r"(?i)canonical|http-equiv") & (F.instr("_u", "://") > 0))
    clean = hinted.select("_u", F.regexp_replace("_h", COMMENT, "").alias("_h"))
    tags = clean.select("_u", F.concat(
        F.transform(F.filter(F.regexp_extract_all("_h", F.lit(LINK_TAG), 0), lambda t: t.rlike(IS_CANONICAL)),
                    lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(F.filter(F.regexp_extract_all("_h", F.lit(META_TAG), 0), lambda t: t.rlike(IS_REFRESH)),
                    lambda t: F.regexp_extract(t, REFRESH_URL, 1))).alias("_t"))
    ends = tags.select("_u", F.explode("_t").alias("_t")).where("_t != ''")
    u = F.col("_u")
    parts = ends.select(node_of(u).alias("a"), _part(u, SCHEME).alias("_s"), host_of(u).alias("_hs"),
                        path_of(u).alias("_p"), F.replace("_t", F.lit("&amp;"), F.lit("&")).alias("_t"))
    links = parts.select("a", resolved(*map(F.col, ("_t", "_s", "_hs", "_p"))).alias("_x"))
    return links.select("a", node_of(F.col("_x")).alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL AND a != b")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, alias_group for every page."""
    groups = components(alias_edges(pages, url_col, html_col))
    node = F.col("vertex")
    ruled = with_rule(groups.select("vertex", "component", host_of(node).alias("host"),
                                    path_of(node).alias("path")), rules)
    spread = ruled.groupBy("component").agg(
        F.max(F.coalesce(F.col("_rule.verdict") == "block", F.lit(False))).alias("_blocked"),
        F.max(F.coalesce(F.col("_rule.verdict") == "allow", F.lit(False))).alias("_allowed"))
    of_node = groups.join(spread, "component").select(
        F.col("vertex").alias("_node"), F.col("component").alias("alias_group"),
        (F.col("_blocked") & ~F.col("_allowed")).alias("_spread_block"))
    url = F.col(f"`{url_col}`")
    base = with_rule(pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"),
                                  path_of(url).alias("path"), node_of(url).alias("_node")), rules)
    own = F.col("_rule.verdict")
    return base.join(of_node, "_node", "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.when(own.isNotNull(), own).when(F.col("_spread_block"), F.lit("block"))
        .otherwise(F.lit("allow")).alias("verdict"), "alias_group")


def op9_redirect_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and alias-propagated blocks over every page."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES).drop("alias_group")


OP9_SQL = r"""
WITH RECURSIVE rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages),
u AS (
  SELECT page_id, url, html, r,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN regexp_matches(r, '^[^/?#]*/') THEN substr(regexp_extract(r, '^[^?#]*'),
              instr(regexp_extract(r, '^[^?#]*'), '/')) ELSE '' END AS path,
         regexp_extract(r, '^[^#]*') AS nofrag
  FROM parts),
nodes AS (
  SELECT *, CASE WHEN host <> '' THEN lower(split_part(url, '://', 1)) || '://' || host || substr(nofrag, length(host) + 1) END AS node
  FROM u),
clean AS (SELECT url, node, host, path, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS h FROM nodes
          WHERE regexp_matches(html, '(?i)canonical|http-equiv') AND node IS NOT NULL),
tags AS (
  SELECT url, node, host, path, regexp_extract(t, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1) AS t
  FROM (SELECT *, unnest(regexp_extract_all(h, '(?is)<link\s[^>]*>')) AS t FROM clean)
  WHERE regexp_matches(t, '(?is)\srel\s*=\s*["'']?canonical["''\s/>]')
  UNION ALL
  SELECT url, node, host, path, regexp_extract(t, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) AS t
  FROM (SELECT *, unnest(regexp_extract_all(h, '(?is)<meta\s[^>]*>')) AS t FROM clean)
  WHERE regexp_matches(t, '(?is)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]')),
ends AS (
  SELECT node AS a, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN split_part(url, '://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN split_part(url, '://', 1) || '://' || host || t
    ELSE split_part(url, '://', 1) || '://' || host ||
         CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || t END AS x
  FROM (SELECT url, node, host, path, replace(t, '&amp;', '&') AS t FROM tags WHERE t <> '')),
far AS (SELECT a, x, substr(x, instr(x, '://') + 3) AS r FROM ends),
links AS (
  SELECT a, lower(split_part(x, '://', 1)) || '://' ||
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ||
    substr(regexp_extract(r, '^[^#]*'), length(regexp_extract(r, '^[^/?#]*')) + 1) AS b
  FROM far WHERE regexp_extract(r, '^[^/?#]*') <> ''),
both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
heads AS (SELECT DISTINCT b AS node, split_part(b, '://', 2) AS r FROM reach),
head_parts AS (
  SELECT node, regexp_extract(r, '^[^/?#]*') AS host,
         CASE WHEN regexp_matches(r, '^[^/?#]*/') THEN substr(regexp_extract(r, '^[^?#]*'),
              instr(regexp_extract(r, '^[^?#]*'), '/')) ELSE '' END AS path FROM heads),
head_rule AS (
  SELECT node, max_by(v, length(h) + length(p)) AS v FROM head_parts, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY node),
spread AS (SELECT a AS node FROM reach JOIN head_rule ON b = node GROUP BY a
           HAVING bool_or(v = 'block') AND NOT bool_or(v = 'allow')),
own AS (
  SELECT host AS oh, path AS op, max_by(h || p, length(h) + length(p)) AS rule, max_by(v, length(h) + length(p)) AS v
  FROM (SELECT DISTINCT host, path FROM nodes), rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN spread.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes LEFT JOIN own ON host = oh AND path = op LEFT JOIN spread ON spread.node = nodes.node
"""
