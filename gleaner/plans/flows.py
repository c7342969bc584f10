"""Composed jobs: the reference's entry points as single Spark plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.operators import catalog, crawl, links, periods, threads
from gleaner.session import materialize
from gleaner.sinks import writers
from gleaner.sources import archive, readers

# The daily job's communities, period and limit.
DAILY_COMMUNITIES = ("AsianBeauty", "SkincareAddiction", "30PlusSkinCare")
DAILY_PERIOD = "day"
DAILY_LIMIT = 100
BACKFILL_LIMIT = 500
BACKFILL_YEARS = 5


def _comments_of(threads_df: DataFrame, selected: DataFrame) -> DataFrame:
    """Comments of the selected posts, at most the limit for each community:
    their ids go to the threads, so no comment is shuffled."""
    keep = tuple(c for c in ("community",) if c in threads_df.columns)
    ids = F.broadcast(selected.select("id").distinct())
    return threads.flatten_comments(threads_df.join(ids, "id", "left_semi"), keep=keep)


def collect_communities(threads_df: DataFrame, communities: list[str] | None, period: str = "day",
                        limit: int = 100, as_of=None, stage_selection: bool = False) -> tuple[DataFrame, DataFrame]:
    """PIP-2: period filter + top-k per community + flatten, for many
    communities in one partitioned plan.  Malformed archive rows are left
    out (``threads.split_malformed`` gives them with their reason), the rest
    continues: a bad source never fails the run."""
    t, _ = threads.split_malformed(threads_df)
    if communities is not None:
        t = t.where(F.col("community").isin(list(communities)))
    if as_of is not None:   # post-time bounds on the stored epoch column: pushed to the scan
        t = periods.epoch_range(t, "created_epoch", periods.period_start(period, as_of), as_of,
                                lo_inclusive=False)
    posts = threads.project_posts(t, keep=("community",))
    if as_of is not None:
        posts = periods.listing_period(posts, "created_utc", period, as_of)
    top = threads.top_posts(posts, by="community", limit=limit)
    if stage_selection:
        # At most `limit` rows per community: written once to the shared
        # folder, then read by both outputs instead of ranking twice.
        top = materialize(top, "selected-posts")
    return top, _comments_of(t, top)


def collect_threads(threads_df: DataFrame, community: str, period: str = "day", limit: int = 100,
                    as_of=None) -> tuple[DataFrame, DataFrame]:
    """PIP-1: one community."""
    return collect_communities(threads_df, [community], period, limit, as_of)


def collect_sources(spark: SparkSession, root: str, communities: list[str] | None, period: str = "day", limit: int = 100,
                    as_of=None, expected: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PIP-2 over an archive folder: posts, comments and quarantine.  A file
    that is broken or missing, and a line that is malformed, is named in the
    quarantine (file, id, community, reason, raw) and leaves the rest intact."""
    found, broken = archive.read_threads_isolated(spark, root, expected)
    posts, comments = collect_communities(found, communities, period, limit, as_of)
    files = broken.select("file", *[F.lit(None).cast("string").alias(c) for c in ("id", "community")], "reason",
                          F.lit(None).cast("string").alias("raw"))
    lines = quarantine_rows(found).select(F.lit(None).cast("string").alias("file"), "id", "community", "reason", "raw")
    return posts, comments, files.unionByName(lines)


def daily_snapshot(spark: SparkSession, threads_df: DataFrame, root: str, as_of: dt.datetime,
                   communities=DAILY_COMMUNITIES, period: str = DAILY_PERIOD,
                   limit: int = DAILY_LIMIT) -> DataFrame:
    """PIP-3: the daily job.  Writes ``posts``, ``comments`` and
    ``quarantine`` (malformed archive rows with their reason) under
    ``run_date=<as_of date>`` (a rerun of the day replaces them, empty
    results included) and returns the row counts of what was written."""
    posts, comments = collect_communities(threads_df, communities, period, limit, as_of, stage_selection=True)
    run_date = as_of.strftime("%Y-%m-%d")
    writers.write_daily({"posts": posts, "comments": comments, "quarantine": quarantine_rows(threads_df)}, root, run_date)
    written = [spark.read.parquet(f"{root}/{k}/run_date={run_date}").select(F.lit(k).alias("kind"))
               for k in ("posts", "comments")]
    return (written[0].unionByName(written[1]).groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("run_date", F.lit(run_date)))


def quarantine_rows(threads_df: DataFrame) -> DataFrame:
    """(id, community, reason, raw) of the archive rows that are no posts."""
    _, bad = threads.split_malformed(threads_df)
    raw = F.col("_corrupt_record") if "_corrupt_record" in bad.columns else F.lit(None).cast("string")
    community = F.col("community") if "community" in bad.columns else F.lit(None).cast("string")
    return bad.select("id", community.alias("community"), "reason", raw.alias("raw"))


def backfill_by_month(spark: SparkSession, threads_df: DataFrame, root: str, start, end,
                      communities: list[str] | None = None, limit: int = BACKFILL_LIMIT,
                      bounds: str = "calendar") -> DataFrame:
    """PIP-4: month-by-month backfill as one job.

    Posts: the top ``limit`` per (community, month).  Comments: those of any
    selected post, each in the month of its **own** time, whatever the
    post's month (D15).  Months that the manifest shows complete are not
    done again: only posts of pending months are scanned and ranked, and the
    selections of finished months are the ids already written.  Comments of
    pending months on posts of finished months are found through those ids.
    Posts and comments are staged under a new version, read back and checked,
    then published by one new manifest; until then readers see the months as
    they were.  The summary is read from what is published."""
    root = root.rstrip("/")
    start_ts = start if isinstance(start, dt.datetime) else dt.datetime.fromisoformat(str(start))
    end_ts = end if isinstance(end, dt.datetime) else dt.datetime.fromisoformat(str(end))
    months = periods.plan_months(spark, start_ts, end_ts)
    manifest = writers.read_manifest(spark, f"{root}/_manifest")
    pending = materialize(periods.pending_months(months, manifest), "pending-months")
    todo = sorted((r["scrape_month"], r["month_start"]) for r in pending.collect())     # months of the range
    if todo:
        _fill_months(spark, threads_df, root, todo, pending, start_ts, end_ts, communities, limit, bounds)
    in_range = months.select("scrape_month")
    return threads.backfill_summary(
        _months(spark, root, "posts").join(in_range, "scrape_month", "left_semi"),
        _months(spark, root, "comments").join(in_range, "scrape_month", "left_semi"))


def pending_posts(threads_df: DataFrame, todo: list[tuple[str, dt.datetime]], pending: DataFrame, start_ts, end_ts,
                  communities: list[str] | None, limit: int, bounds: str) -> DataFrame:
    """The selection of the pending months: the scan is bounded to them on
    the stored epoch column, and only their posts are ranked."""
    t, _ = threads.split_malformed(threads_df)
    if communities is not None:
        t = t.where(F.col("community").isin(list(communities)))
    last = (todo[-1][1] + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(seconds=1)
    t = periods.epoch_range(t, "created_epoch", todo[0][1], min(last, end_ts))
    posts = periods.assign_month(threads.project_posts(t, keep=("community",)), "created_utc", start_ts, end_ts, bounds,
                                 months=pending)
    return threads.top_posts(posts, by=["community", "scrape_month"], limit=limit)


def _fill_months(spark, threads_df, root, todo, pending, start_ts, end_ts, communities, limit, bounds) -> None:
    selected = materialize(pending_posts(threads_df, todo, pending, start_ts, end_ts, communities, limit, bounds),
                           "selected-posts")
    names = [m for m, _ in todo]
    finished = _months(spark, root, "posts").where(~F.col("scrape_month").isin(names)).select("id")
    ids = selected.select("id").unionByName(finished).distinct()
    t, _ = threads.split_malformed(threads_df)
    if communities is not None:
        t = t.where(F.col("community").isin(list(communities)))
    t = periods.epoch_range(t, "created_epoch", None, end_ts)
    # comments outside the pending months are dropped before they are exploded
    lo = F.unix_seconds(F.lit(todo[0][1]).cast("timestamp"))
    t = t.join(ids, "id", "left_semi").withColumn("comments", F.filter("comments", lambda c: c["created_epoch"] >= lo))
    comments = periods.assign_month(threads.flatten_comments(t, keep=("community",)), "created_utc", start_ts, end_ts, bounds,
                                    months=pending)

    version = writers.new_version()
    for kind, rows in (("posts", selected), ("comments", comments)):
        writers.stage_months(rows, root, kind, version)
    staged = {kind: writers.read_staged(spark, root, kind, version, rows.schema) for kind, rows in (("posts", selected), ("comments", comments))}
    chosen = selected.groupBy("scrape_month").agg(F.count(F.lit(1)).alias("rows"))
    counts = (writers.audit_months(staged["posts"], "posts", pending, "id", "created_utc", chosen)
              .unionByName(writers.audit_months(staged["comments"], "comments", pending, "post_id", "created_utc")))
    done_through = F.lit(end_ts).cast("timestamp")
    entries = (pending.select("scrape_month", "month_end",
                              F.explode(F.array(F.lit("posts"), F.lit("comments"))).alias("kind"))
               .join(counts, ["scrape_month", "kind"], "left")
               .select("scrape_month", "kind", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
                       F.when(F.col("month_end") <= done_through, "complete").otherwise("open").alias("status"),
                       F.least(F.col("month_end"), done_through).alias("last_date"), F.lit(version).alias("version")))
    writers.write_checkpoint(entries, f"{root}/_manifest")


# What a backfill writes of each kind.
_KINDS = {"posts": T.StructType([*schemas.POSTS.fields, T.StructField("community", T.StringType())]),
          "comments": T.StructType([*schemas.COMMENTS.fields, T.StructField("community", T.StringType())])}


def _months(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return writers.read_months(spark, root.rstrip("/"), kind, _KINDS[kind])


def read_backfill(spark: SparkSession, root: str) -> DataFrame:
    """The published posts and comments, one table with a ``kind``."""
    posts, comments = (_months(spark, root, kind).withColumn("kind", F.lit(kind)) for kind in _KINDS)
    return posts.unionByName(comments, allowMissingColumns=True)


def backfill_last_years(spark: SparkSession, threads_df: DataFrame, root: str, as_of: dt.datetime,
                        years: int = BACKFILL_YEARS, **kw) -> DataFrame:
    """PIP-4 over the ``years`` times 365 days before ``as_of``."""
    return backfill_by_month(spark, threads_df, root, periods.years_back(as_of, years), as_of, **kw)


def resume_backfill(spark: SparkSession, threads_df: DataFrame, root: str, start, end, **kw) -> DataFrame:
    """STR-5: a restart continues after the complete months (the manifest
    is the checkpoint); open or missing months are recomputed."""
    return backfill_by_month(spark, threads_df, root, start, end, **kw)


def collect_product_urls(pages: DataFrame, container_class: str, root: str,
                         max_pages: int | None = None, page_col: str = "page_id", max_errors: int = 5) -> DataFrame:
    """PIP-5: listing pages -> cap -> containers -> stop rules -> first links
    -> product links -> absolute URLs -> distinct.

    The walk ends after ``max_errors`` failed pages in a row (FLT-8; a page
    with containers resets the count) and before the first page that loaded
    without containers (FLT-7).  A page that is there without a status
    counts as loaded; a failed page gives no links."""
    capped = links.page_cap(pages, max_pages, page_col)
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(True)) if "status" in capped.columns else F.lit(True)
    # One row per container (far smaller than the pages): parsed once, then
    # the counts, the end of the listing and the URLs all read it.
    found = materialize(links.extract_listing_links(capped.where(ok), container_class), "listing-links")
    counts = links.containers_per_page(capped, found)
    page_counts = (counts.join(capped.select(page_col, ok.alias("ok")), page_col)
                   .select(F.col(page_col).alias("page_no"), "ok",
                           F.col("containers").alias("n_containers")))
    flags = page_counts.withColumns({"is_error": ~F.col("ok"), "resets": F.col("ok") & (F.col("n_containers") > 0)})
    walked = crawl.error_cutoff(flags, key=None, order=("page_no",), n=max_errors)
    live = links.listing_frontier(walked, key=None).select(F.col("page_no").alias(page_col))
    found = found.join(live, page_col, "left_semi")
    return links.distinct_product_urls(links.resolve_urls(links.product_links(found), root))


def collect_reviews(spark: SparkSession, list_root: str, pages: DataFrame,
                    prefix: str = "product_urls_") -> DataFrame:
    """PIP-6: newest URL list -> archived pages -> payload -> reviews.  The
    payload is taken out before pages are matched, so page text is never
    shuffled."""
    urls = readers.url_lines(readers.read_latest_snapshot(spark, list_root, prefix))
    found, _ = catalog.lookup_pages(urls, catalog.extract_structured_data(pages))
    return catalog.explode_reviews(catalog.parse_product_json(found))


def collect_products(urls: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PIP-7: URL list -> products and (7-column) reviews; a product with no
    reviews is still a product."""
    found, _ = catalog.lookup_pages(urls, catalog.extract_structured_data(pages))
    parsed = catalog.parse_product_json(found)
    return catalog.project_products(parsed), catalog.explode_reviews_narrow(parsed)
