"""URL filters: allow and block rules, and block decisions that reach a page's aliases. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.llm.common import checkpoint, let, table
from mosaica.operators.components import connected_components

# Fixed rules: verdict, host and path in one string.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def address(url: Column) -> Column:
    """The url as a node: scheme and host in lower case, path without dot segments, query; no fragment. Null without a host."""
    scheme = F.translate(F.regexp_extract(url, r"(?s)^(.*?)://", 1), _UPPER, _LOWER)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), _without_dots(path_of(url)), query))


def _without_dots(path: Column) -> Column:
    """Empty paths become /, and . and .. segments are carried out."""
    steps = F.slice(F.split(path, "/"), 2, 1 << 30)
    folder = F.when(F.element_at(F.split(path, "/"), -1).isin(".", ".."), "/").otherwise("")
    walked = F.aggregate(
        steps, F.expr("cast(array() as array<string>)"),
        lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, 1, F.greatest(F.lit(0), F.size(a) - 1))).otherwise(F.concat(a, F.array(x))),
    )
    clean = F.concat(F.lit("/"), F.array_join(walked, "/"), F.when(F.size(walked) > 0, folder).otherwise(""))
    return F.when(path == "", "/").when(path.rlike(r"/\.\.?(/|$)"), clean).otherwise(path)


def resolve(target: Column, base: Column) -> Column:
    """The target of a link as an address, read against the base url; null for other schemes and for links into the page itself."""
    t = F.regexp_replace(F.btrim(target), "&amp;|&#38;|&#x26;", "&")
    scheme, origin = F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1), F.lit("")), F.lit("/"))
    whole = (
        F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (t == "") | t.startswith("#"), None)
        .when(t.startswith("//"), F.concat(scheme, F.lit(":"), t))
        .when(t.startswith("/"), F.concat(origin, t))
        .when(t.startswith("?"), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), t))
        .otherwise(F.concat(origin, folder, t))
    )
    return address(whole)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, in quotes of either kind or bare; empty where there is none."""
    found = [F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*{form}", 1) for form in ('"([^"]*)"', "'([^']*)'", r"""([^\s"'>]+)""")]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found], F.lit(""))


def links_of(html: Column, url: Column) -> Column:
    """Addresses of all canonical links and refresh targets of a page, relative ones read against its base element or url."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)(<(?:link|meta|base)\b[^>]*>)"), F.lit(1))
    base = F.array_max(F.transform(F.slice(F.filter(tags, lambda t: t.rlike(r"(?is)^<base\b")), 1, 1), lambda t: resolve(_attribute(t, "href"), url)))
    canonical = F.transform(F.filter(tags, lambda t: t.rlike(r"(?is)^<link\b") & F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")), lambda t: _attribute(t, "href"))
    refresh = F.transform(F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\b") & (F.lower(_attribute(t, "http-equiv")) == "refresh")), lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)\burl\s*=\s*["']?([^"'\s]+)""", 1))
    return let(F.coalesce(base, url), lambda at: F.filter(F.transform(F.concat(canonical, refresh), lambda x: resolve(x, at)), lambda x: x.isNotNull()))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(id_col, host, path, rule, verdict, decided_by), one row per page.

    The longest fitting rule decides; its string is `rule`. Other pages are blocked if redirect or canonical-link edges
    connect them to a page or address that a rule blocks, else allowed. A page that a rule allows stays allowed whatever its
    aliases are, and an address with an allow rule passes no block on by itself. Edges: from a page to each of its canonical links and refresh targets,
    and the rows of redirects (from_url, to_url), where a crawl keeps them. decided_by is rule, alias or default. Null urls have empty host and path and no
    alias; null html has no edges; repeated rows give repeated rows; an empty table gives an empty result.
    """
    url, html = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    best = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")

    def judge(df: DataFrame) -> DataFrame:
        df = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        rule, say = best, verdict
        for what, text in sorted(rules, key=lambda r: len(r[1])):  # longer ones later, so that they win
            fits = _fits(text, F.col("host"), F.col("path"))
            rule, say = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(say)
        return df.withColumn("rule", rule).withColumn("said", say)

    judged = judge(pages.select(F.col(id_col).alias("id"), url.alias("url"), F.when(html.rlike("(?i)canonical|refresh"), html).alias("html")))
    edges = judged.where("html is not null").select(address(F.col("url")).alias("a"), F.explode(links_of(F.col("html"), F.col("url"))).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("from_url")).alias("a"), resolve(F.col("to_url"), F.col("from_url")).alias("b")))
    edges = checkpoint(edges.where("a is not null and b is not null and a <> b").distinct())
    roots = checkpoint(connected_components(edges, "a", "b"))
    hit = judge(roots.select("node", "root", F.col("node").alias("url"))).where("said = 'block'").select("root").distinct()
    reached = roots.join(hit, "root", "left_semi").select("node", F.lit(True).alias("hit"))
    node = F.when(F.col("rule").isNull(), address(F.col("url")))  # nothing to look up where a rule decides
    return judged.drop("html").withColumn("node", node).join(reached, "node", "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), F.col("said")).when(F.col("hit"), "block").otherwise("allow").alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").when(F.col("hit"), "alias").otherwise("default").alias("decided_by"),
    )


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


QUERIES = {"op9_url_filter": op9_url_filter}
# The tables hold no redirect or canonical links (tests cover those), so no page has an alias there.
ORACLE = {
    "op9_url_filter": r"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(what, rule, h, p) AS (VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'),
  ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
b AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(what, length(rule)) AS what FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(what, 'allow') AS verdict, CASE WHEN rule IS NOT NULL THEN 'rule' ELSE 'default' END AS decided_by FROM u LEFT JOIN b USING (page_id)
"""
}
