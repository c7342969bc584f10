"""Listing pages: containers, links, URL resolution, the URL set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.html import anchor_hrefs
from gleaner.functions.listing import container_links
from gleaner.functions.urls import resolve_url

# The marker of product links.
PRODUCT_MARKER = "/p/"


def extract_listing_links(pages: DataFrame, container_class: str, tag: str = "div") -> DataFrame:
    """PRJ-12: per product container (exact, order-sensitive class list) the
    first link with an href; ``href`` is null for a container without one.
    One row per container, so the container count is a plain count.

    A page that holds neither a class token as written nor an ampersand (a
    token may be written with entities) cannot hold a container: a JVM
    substring filter drops it before any row reaches Python."""
    plain = [t for t in container_class.split() if t.replace("-", "").isalnum()]
    if plain:
        pages = pages.where((F.instr("html", max(plain, key=len)) > 0) | (F.instr("html", "&") > 0))
    return (pages.select("page_id", F.explode(container_links("html", container_class, tag)).alias("c"))
            .select("page_id", F.col("c.container_no").alias("container_no"), F.col("c.href").alias("href")))


def extract_page_links(pages: DataFrame) -> DataFrame:
    """PRJ-13: every ``<a href="...">`` of a page, in order (native regex)."""
    return (pages.select("page_id", F.posexplode(anchor_hrefs("html")).alias("link_no", "href")))


def product_links(links: DataFrame, marker: str = PRODUCT_MARKER) -> DataFrame:
    """FLT-3: keep hrefs containing the product marker."""
    return links.where(F.col("href").contains(marker))


def resolve_urls(links: DataFrame, root: str, href: str = "href", out: str = "url") -> DataFrame:
    """PRJ-14: absolute URLs, resolved against the site root."""
    return links.withColumn(out, resolve_url(href, root))


def distinct_product_urls(links: DataFrame, col: str = "url") -> DataFrame:
    """SET-2: the URL set (partial distinct map-side, then one shuffle)."""
    return links.select(col).dropDuplicates([col])


def distinct_url_count(urls: DataFrame, col: str = "url") -> DataFrame:
    """AGG-4: number of unique URLs (exact)."""
    return urls.agg(F.count_distinct(col).alias("distinct_urls"))


def containers_per_page(pages: DataFrame, containers: DataFrame) -> DataFrame:
    """AGG-5: containers found per listing page; pages with none show 0."""
    counts = containers.groupBy("page_id").agg(F.count(F.lit(1)).alias("containers"))
    return (pages.select("page_id").join(counts, "page_id", "left")
            .select("page_id", F.coalesce("containers", F.lit(0)).cast("long").alias("containers")))


def page_cap(pages: DataFrame, max_pages: int | None = None, page_col: str = "page_id") -> DataFrame:
    """LIM-1: the first ``max_pages`` listing pages (None = all)."""
    if max_pages is None:
        return pages
    if max_pages <= 0:
        raise ValueError("max_pages must be positive or None")
    return pages.where(F.col(page_col) <= max_pages)


def preview(urls: DataFrame, n: int = 5, col: str = "url") -> DataFrame:
    """LIM-2: the first ``n`` URLs by url (a top-k, not a full sort)."""
    return urls.orderBy(col).limit(n)


def listing_frontier(page_counts: DataFrame, key: str | None = "crawl_id", page_col: str = "page_no",
                     ok: str = "ok", n: str = "n_containers") -> DataFrame:
    """FLT-7: keep the pages before the first page that loaded fine with zero
    containers (the end of the listing); a page that failed to load does not
    end it, one whose state is not known (null) counts as loaded.  The end page per crawl is an aggregate; joining it back is an
    equi-join on the crawl key."""
    page_counts = page_counts.withColumn(ok, F.coalesce(F.col(ok), F.lit(True)))
    if key is None:   # one crawl: the end page is a scalar subquery, no join
        end = page_counts.where(F.col(ok) & (F.col(n) == 0)).agg(F.min(page_col)).scalar()
        # one reference to the subquery: no end page means no bound
        return page_counts.where(F.col(page_col) < F.coalesce(end, F.lit(2 ** 62)))
    ends = (page_counts.where(F.col(ok) & (F.col(n) == 0))
            .groupBy(key).agg(F.min(page_col).alias("_end")))
    return (page_counts.join(ends, key, "left")
            .where(F.col("_end").isNull() | (F.col(page_col) < F.col("_end"))).drop("_end"))
