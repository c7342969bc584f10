"""URL filters with redirect equivalence, in DataFrame and SQL functions only.

Every url is split into host and path and judged by the longest rule that fits
its host (or a parent domain) and the start of its path.  Pages also say which
other urls they are: canonical links and refresh redirects in their html are
edges between url keys (scheme, fragment and tracking parameters dropped), and
urls of one key are one node, with edges or without.  Distributed connected components over the edges
give classes of aliases.  A url without a rule of its own takes its class's
decision: allow where any member is explicitly allowed, else block where any
member is blocked, else allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import connected_components
from gleaner.session import materialize

# (verdict, host, path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|mc_cid|mc_eid)="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://, null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):     # the longest is tried first
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def key_of(url: Column) -> Column:
    """The node of a url: host without default port, path, query without
    tracking parameters; null without a host."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return F.when(host != "", F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&")))
                                       .otherwise(F.lit(""))))


def _attribute(tag: Column, name: str) -> Column:
    raw = F.regexp_extract(tag, rf"""(?i)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.regexp_replace(F.trim(F.regexp_replace(raw, r"""^["']|["']$""", "")), "&amp;", "&")


def named_urls(html: Column) -> Column:
    """Targets of canonical links and refresh redirects, as written."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0))
    canonical = F.transform(F.filter(tags, lambda t: t.rlike(r"""(?i)[\s"']rel\s*=\s*["']?canonical["'\s/>]""")),
                            lambda t: _attribute(t, "href"))
    refresh = F.transform(F.filter(tags, lambda t: t.rlike(r"""(?i)http-equiv\s*=\s*["']?refresh""")),
                          lambda t: F.trim(F.regexp_extract(_attribute(t, "content"), r"""(?i)url\s*=\s*["']?([^"']*)""", 1)))
    return F.filter(F.concat(canonical, refresh), lambda u: u != "")


def plain_path(path: Column) -> Column:
    """``path`` (from its first /) without dot segments, as RFC 3986 removes them."""
    parts = F.split(path, "/", -1)
    dots = lambda p: (p == ".") | (p == "..")

    def step(kept, p):
        # the first part is the empty one in front of the path
        up = F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return F.when(p == "..", up).when(p == ".", kept).otherwise(F.array_append(kept, p))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step)
    # a dot segment at the end leaves its folder
    kept = F.when(dots(F.element_at(parts, -1)), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(F.exists(parts, dots), F.array_join(kept, "/")).otherwise(path)


def resolve(target: Column, url: Column) -> Column:
    """A target as an absolute url without dot segments."""
    scheme = F.regexp_extract(url, r"^([^:/?#]+)://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    full = (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
            .when(F.startswith(target, F.lit("/")), F.concat(site, target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))          # mailto: and the like
            .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target)))
    path = path_of(full)
    front = F.regexp_extract(full, r"^([^:]*://[^/?#]*)", 1)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(front, plain_path(path), F.substring(
        full, F.length(front) + F.length(path) + 1, F.length(full)))).otherwise(full)


def _decisions() -> list[Column]:
    return [F.max((F.col("verdict") == v).cast("int")).alias(n) for v, n in (("allow", "allowed"), ("block", "blocked"))]


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict.

    Null urls and urls without :// have an empty host and path, no rule and
    no aliases: allow.  Null html names no other url.  Repeated rows are
    judged each."""
    page = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    judged = (page.select("page_id", host_of(page["url"]).alias("host"), path_of(page["url"]).alias("path"),
                          key_of(page["url"]).alias("key"))
              .withColumn("own", rule_of(F.col("host"), F.col("path"), rules)))

    named = page.where("url is not null").select("url", F.explode(named_urls(F.col("html"))).alias("target"))
    named = named.select("url", resolve(F.col("target"), F.col("url")).alias("target")).where("target is not null")
    edges = materialize(named.select(key_of(F.col("url")).alias("u"), key_of(F.col("target")).alias("v"),
                                     rule_of(host_of(F.col("target")), path_of(F.col("target")), rules)["verdict"].alias("verdict"))
                        .where("u is not null and v is not null").distinct(), "url-edges")
    classes = materialize(connected_components(edges.select("u", "v")), "url-classes")
    # decisions of members: pages by their own rule, and urls that are only named; a key without edges is its own class
    known = (judged.where("own is not null and key is not null").select(F.col("key").alias("node"), F.col("own.verdict").alias("verdict"))
             .unionAll(edges.where("verdict is not null").select(F.col("v").alias("node"), "verdict"))
             .groupBy("node").agg(*_decisions()))
    decided = materialize(known.join(classes, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
                          .agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
                          .where("allowed = 0 and blocked = 1").select("component"), "url-blocked")
    # the keys of a blocked class: its root without edges, or all that have it as their component
    passed = (decided.select(F.col("component").alias("key")).unionAll(
        classes.join(decided, "component").select(F.col("node").alias("key"))).distinct().withColumn("passed", F.lit("block")))
    return (judged.join(passed, "key", "left")
            .select("page_id", "host", "path", F.col("own.rule").alias("rule"),
                    F.coalesce(F.col("own.verdict"), F.col("passed"), F.lit("allow")).alias("verdict")))
