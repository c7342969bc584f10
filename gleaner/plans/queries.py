"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the given tables (or views Spark
derives from them).  Output timestamps are returned as TIMESTAMP_NTZ in
UTC so they compare with DuckDB's TIMESTAMP regardless of client zone."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.keys import review_key
from gleaner.functions.ranking import row_number_within
from gleaner.operators import catalog, crawl, forest, links, periods, split, threads
from gleaner.plans import flows
from gleaner.session import configure, scratch_dir
from gleaner.sinks import writers
from gleaner.sources import archive, readers
from gleaner.sources import fixtures as fx
from gleaner.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return to_ntz(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def to_ntz(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


# ---------------------------------------------------------------- helpers

def posts_of(spark, sf_dir) -> DataFrame:
    return threads.project_posts(fx.thread_archive(spark, sf_dir))


def comments_of(spark, sf_dir) -> DataFrame:
    return threads.flatten_comments(fx.thread_archive(spark, sf_dir))


def _max_post_time(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("timestamp")).scalar()


# ---------------------------------------------------------------- threads

@register("project_posts")
def q_project_posts(spark, sf_dir):
    return posts_of(spark, sf_dir)


@register("flatten_comments")
def q_flatten_comments(spark, sf_dir):
    return comments_of(spark, sf_dir)


@register("tag_source")
def q_tag_source(spark, sf_dir):
    posts = threads.project_posts(fx.thread_archive(spark, sf_dir), keep=())
    return threads.tag_source(posts, "archive")


@register("tag_month")
def q_tag_month(spark, sf_dir):
    return threads.tag_month(posts_of(spark, sf_dir))


@register("top_posts")
def q_top_posts(spark, sf_dir):
    return threads.top_posts(posts_of(spark, sf_dir), by="community", limit=100)


@register("union_communities")
def q_union_communities(spark, sf_dir):
    posts = posts_of(spark, sf_dir)
    hot = ["1-URGENT", "2-HIGH"]
    first = posts.where(F.col("community").isin(hot)).drop("body")
    rest = posts.where(~F.col("community").isin(hot))
    return threads.union_communities([first, rest])


@register("output_counts")
def q_output_counts(spark, sf_dir):
    return threads.output_counts(posts_of(spark, sf_dir), comments_of(spark, sf_dir))


@register("community_counts")
def q_community_counts(spark, sf_dir):
    return threads.community_counts(posts_of(spark, sf_dir), comments_of(spark, sf_dir))


@register("backfill_summary")
def q_backfill_summary(spark, sf_dir):
    posts = threads.tag_month(posts_of(spark, sf_dir))
    comments = threads.tag_month(comments_of(spark, sf_dir))
    return threads.backfill_summary(posts, comments)


# ---------------------------------------------------------------- periods

def _listing_period(period: str):
    @register("listing_period" if period == "year" else f"listing_period_{period}")
    def q(spark, sf_dir):
        return periods.listing_period(posts_of(spark, sf_dir), "created_utc", period, _max_post_time(spark, sf_dir))
    q.__name__ = f"q_listing_period_{period}"
    return q


for _period in ("day", "week", "month", "year", "all"):
    _listing_period(_period)


@register("month_window")
def q_month_window(spark, sf_dir):
    return periods.month_window(comments_of(spark, sf_dir), "created_utc", "1997-03-01 06:00:00")


@register("month_window_inclusive_last_day")
def q_month_window_compat(spark, sf_dir):
    return periods.month_window(comments_of(spark, sf_dir), "created_utc", "1997-03-01 06:00:00",
                                bounds="inclusive_last_day")


@register("assign_month")
def q_assign_month(spark, sf_dir):
    return periods.assign_month(comments_of(spark, sf_dir), "created_utc", "1996-01-01", "1997-12-31 23:59:59")


@register("assign_month_inclusive_last_day")
def q_assign_month_compat(spark, sf_dir):
    return periods.assign_month(comments_of(spark, sf_dir), "created_utc", "1996-01-01 06:00:00",
                                "1997-12-31 23:59:59", bounds="inclusive_last_day")


@register("plan_months")
def q_plan_months(spark, sf_dir):
    return periods.plan_months_for(fx.table(spark, sf_dir, "orders"), "o_orderdate")


def manifest_of(spark, sf_dir, complete_through: str = "1998-12") -> DataFrame:
    """A backfill manifest derived from the archive: months up to
    `complete_through` are complete for the kinds that have rows."""
    posts = threads.tag_month(posts_of(spark, sf_dir)).groupBy("scrape_month").count() \
        .select("scrape_month", F.lit("posts").alias("kind"), F.col("count").alias("rows"))
    comments = threads.tag_month(comments_of(spark, sf_dir)).groupBy("scrape_month").count() \
        .select("scrape_month", F.lit("comments").alias("kind"), F.col("count").alias("rows"))
    m = posts.unionByName(comments)
    return m.withColumn("status", F.when(F.col("scrape_month") <= complete_through, "complete")
                        .otherwise("open"))


@register("pending_months")
def q_pending_months(spark, sf_dir):
    months = periods.plan_months_for(fx.table(spark, sf_dir, "lineitem"), "l_shipdate")
    ckpt = spark.range(1).select(F.lit("1996-06-15 00:00:00").cast("timestamp").alias("last_date"))
    return periods.pending_months(months, manifest_of(spark, sf_dir), ckpt)


# ---------------------------------------------------------------- catalogue


def parsed_pages(spark, sf_dir) -> DataFrame:
    return catalog.parse_product_json(catalog.extract_structured_data(fx.product_pages(spark, sf_dir)))


@register("read_pages")
def q_read_pages(spark, sf_dir):
    pages = readers.read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("long").alias("html_chars"))


@register("extract_structured_data")
def q_extract_structured_data(spark, sf_dir):
    df = catalog.extract_structured_data(fx.product_pages(spark, sf_dir))
    return df.select("url", "payload")


@register("pages_with_payload")
def q_pages_with_payload(spark, sf_dir):
    return catalog.pages_with_payload(catalog.extract_structured_data(fx.product_pages(spark, sf_dir))) \
        .select("url")


@register("parse_product_json")
def q_parse_product_json(spark, sf_dir):
    df = catalog.pages_with_payload(parsed_pages(spark, sf_dir))
    return df.select("url", "parse_ok", F.col("product.sku").alias("sku"), F.col("product.brand").alias("brand"),
                     F.array_join("product.image_urls", " ").alias("images"),
                     F.array_join(F.transform("product.review", lambda r: r["reviewBody"]), "|").alias("review_bodies"))


@register("project_products")
def q_project_products(spark, sf_dir):
    return catalog.project_products(parsed_pages(spark, sf_dir))


@register("explode_reviews")
def q_explode_reviews(spark, sf_dir):
    return catalog.explode_reviews(parsed_pages(spark, sf_dir))


@register("review_ids")
def q_review_ids(spark, sf_dir):
    reviews = catalog.with_review_ids(catalog.explode_reviews(parsed_pages(spark, sf_dir)))
    return reviews.select("product_sku", "title", "rating_num", "review_uid")


@register("explode_reviews_narrow")
def q_explode_reviews_narrow(spark, sf_dir):
    return catalog.explode_reviews_narrow(parsed_pages(spark, sf_dir))


@register("review_key")
def q_review_key(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", review_key("text").alias("review_key"))


@register("reviews_per_product")
def q_reviews_per_product(spark, sf_dir):
    return catalog.reviews_per_product(catalog.explode_reviews(parsed_pages(spark, sf_dir)))


def url_list(spark, sf_dir) -> DataFrame:
    return readers.url_lines(fx.url_list_rows(spark, sf_dir))


@register("lookup_pages")
def q_lookup_pages(spark, sf_dir):
    found, _ = catalog.lookup_pages(url_list(spark, sf_dir), fx.product_pages(spark, sf_dir))
    return found.select("url", "page_id")


@register("lookup_pages_missing")
def q_lookup_pages_missing(spark, sf_dir):
    _, missing = catalog.lookup_pages(url_list(spark, sf_dir), fx.product_pages(spark, sf_dir))
    return missing.select("url")


@register("quarantine")
def q_quarantine(spark, sf_dir):
    _, bad = catalog.quarantine(parsed_pages(spark, sf_dir))
    return bad.select("url", "reason")


# ---------------------------------------------------------------- links

def listing_links(spark, sf_dir) -> DataFrame:
    return links.extract_listing_links(fx.listing_pages(spark, sf_dir), fx.CONTAINER_CLASS)


def listing_urls(spark, sf_dir) -> DataFrame:
    prod = links.product_links(listing_links(spark, sf_dir))
    return links.distinct_product_urls(links.resolve_urls(prod, fx.SITE_ROOT))


@register("extract_listing_links")
def q_extract_listing_links(spark, sf_dir):
    return listing_links(spark, sf_dir)


@register("containers_per_page")
def q_containers_per_page(spark, sf_dir):
    return links.containers_per_page(fx.listing_pages(spark, sf_dir), listing_links(spark, sf_dir))


@register("extract_page_links")
def q_extract_page_links(spark, sf_dir):
    return links.extract_page_links(fx.table(spark, sf_dir, "pages"))


@register("product_links")
def q_product_links(spark, sf_dir):
    return links.product_links(links.extract_page_links(fx.table(spark, sf_dir, "pages")), marker="/th")


@register("resolve_url")
def q_resolve_url(spark, sf_dir):
    return links.resolve_urls(links.extract_page_links(fx.table(spark, sf_dir, "pages")), fx.SITE_ROOT) \
        .select("page_id", "link_no", "url")


@register("distinct_product_urls")
def q_distinct_product_urls(spark, sf_dir):
    return listing_urls(spark, sf_dir)


@register("distinct_url_count")
def q_distinct_url_count(spark, sf_dir):
    return links.distinct_url_count(listing_urls(spark, sf_dir))


@register("preview")
def q_preview(spark, sf_dir):
    return links.preview(listing_urls(spark, sf_dir), 5)


@register("page_cap")
def q_page_cap(spark, sf_dir):
    return links.page_cap(fx.listing_pages(spark, sf_dir), 5).select("page_id", "url")


@register("plan_listing_pages")
def q_plan_listing_pages(spark, sf_dir):
    return readers.plan_listing_pages(spark, fx.SITE_ROOT + fx.LISTING_PATH, None,
                                      archive=fx.listing_pages(spark, sf_dir))


# ---------------------------------------------------------------- crawl log

def crawl_log(spark, sf_dir) -> DataFrame:
    return fx.crawl_log(spark, sf_dir)


@register("classify_fetch")
def q_classify_fetch(spark, sf_dir):
    return crawl.classify_fetch(crawl_log(spark, sf_dir)).select("crawl_id", "attempt_seq", "status", "fetch_class")


@register("fetch_outcome")
def q_fetch_outcome(spark, sf_dir):
    return crawl.fetch_outcome(crawl_log(spark, sf_dir))


@register("fetch_outcome_narrow")
def q_fetch_outcome_narrow(spark, sf_dir):
    return crawl.fetch_outcome(crawl_log(spark, sf_dir), retry_all_errors=False)


def _flagged_log(spark, sf_dir) -> DataFrame:
    return crawl.attempt_flags(crawl_log(spark, sf_dir))


@register("error_cutoff")
def q_error_cutoff(spark, sf_dir):
    return crawl.error_cutoff(_flagged_log(spark, sf_dir), n=5).select("crawl_id", "attempt_seq", "status")


def page_counts(spark, sf_dir) -> DataFrame:
    """Listing fetches per crawl numbered in attempt order (skew-safe numbering)."""
    log = crawl_log(spark, sf_dir).select("crawl_id", "attempt_ts", "attempt_seq", "status", "n_results")
    numbered = row_number_within(log, ["crawl_id"], ["attempt_ts", "attempt_seq"], out="page_no")
    return numbered.select("crawl_id", F.col("page_no").cast("long").alias("page_no"),
                           (F.col("status") == 200).alias("ok"), F.col("n_results").alias("n_containers"))


@register("listing_frontier")
def q_listing_frontier(spark, sf_dir):
    return links.listing_frontier(page_counts(spark, sf_dir)).select("crawl_id", "page_no")


def _products_in_order(spark, sf_dir) -> DataFrame:
    """(product_no, n_reviews): the place in list order, reviews of the page."""
    per_page = parsed_pages(spark, sf_dir).select(
        "page_id", F.when(F.col("parse_ok"), F.size("product.review")).otherwise(0).cast("long").alias("n_reviews"))
    return row_number_within(per_page, [], ["page_id"], out="product_no").select("product_no", "n_reviews")


@register("interim_snapshots")
def q_interim_snapshots(spark, sf_dir):
    return crawl.interim_snapshots(_products_in_order(spark, sf_dir))


# ---------------------------------------------------------------- forest, split

@register("expand_comment_forest")
def q_expand_comment_forest(spark, sf_dir):
    return forest.expand_comment_forest(fx.comment_forest(spark, sf_dir))


@register("expand_comment_forest_orphans")
def q_expand_comment_forest_orphans(spark, sf_dir):
    """Turns that answer a removed turn start trees of their own."""
    return forest.expand_comment_forest(fx.broken_forest(spark, sf_dir))


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    return split.train_test_split(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


# ---------------------------------------------------------------- sources over written data


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _write_threads_json(spark, sf_dir, path) -> str:
    fx.thread_archive(spark, sf_dir).write.mode("overwrite").json(path)
    return path


def _write_snapshots(spark, sf_dir, root) -> str:
    """Three timestamped URL lists and one unrelated file (newest = all)."""
    part = fx.table(spark, sf_dir, "part")
    url = fx.product_url()
    older = part.where(F.col("p_partkey") % 3 == 0).select(
        F.lit("product_urls_20240101_000000.txt").alias("snapshot"), url.alias("value"))
    middle = part.where(F.col("p_partkey") % 2 == 0).select(
        F.lit("product_urls_20240201_000000.txt").alias("snapshot"), url.alias("value"))
    newest = fx.url_list_rows(spark, sf_dir).select(
        F.lit("product_urls_20240301_000000.txt").alias("snapshot"), "value")
    other = part.select(F.lit("reviews_20250101_000000.csv").alias("snapshot"), url.alias("value"))
    (older.unionByName(middle).unionByName(newest).unionByName(other)
     .write.mode("overwrite").partitionBy("snapshot").text(root))
    return root


def _max_order_date(spark, sf_dir) -> _dt.datetime:
    return fx.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("m")).first()["m"]


def _order_date_range(spark, sf_dir) -> tuple[_dt.datetime, _dt.datetime]:
    row = fx.table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e")) \
        .first()
    return row["s"], row["e"]


@register("read_threads")
def q_read_threads(spark, sf_dir):
    path = _write_threads_json(spark, sf_dir, scratch_dir(spark, "threads-json"))
    return threads.project_posts(readers.read_threads(spark, path))


def _with_bad_lines(spark, sf_dir, path) -> str:
    """The archive as JSON lines; every 17th order's line is cut in half and
    every 19th lacks its id."""
    archive = fx.thread_archive(spark, sf_dir)
    line = F.to_json(F.struct(*[F.when(F.col("id").cast("long") % 19 == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
                                if c == "id" else F.col(c) for c in archive.columns]))
    key = F.col("id").cast("long")
    archive.select(F.when(key % 17 == 0, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).otherwise(line)
                   .alias("value")).write.mode("overwrite").text(path)
    return path


@register("quarantine_threads")
def q_quarantine_threads(spark, sf_dir):
    path = _with_bad_lines(spark, sf_dir, scratch_dir(spark, "threads-bad"))
    _, bad = threads.split_malformed(readers.read_threads(spark, path))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register("read_threads_good")
def q_read_threads_good(spark, sf_dir):
    """The posts that are left when malformed lines are set aside."""
    path = _with_bad_lines(spark, sf_dir, scratch_dir(spark, "threads-bad"))
    good, _ = threads.split_malformed(readers.read_threads(spark, path))
    return threads.project_posts(good)


@register("read_url_list")
def q_read_url_list(spark, sf_dir):
    path = scratch_dir(spark, "url-list")
    fx.url_list_rows(spark, sf_dir).write.mode("overwrite").text(path)
    return readers.read_url_list(spark, path)


@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    root = _write_snapshots(spark, sf_dir, scratch_dir(spark, "snapshots"))
    return readers.url_lines(readers.read_latest_snapshot(spark, root, "product_urls_")).select("url")


@register("latest_snapshot_table")
def q_latest_snapshot_table(spark, sf_dir):
    """The scalar-subquery form over a table with a snapshot column."""
    root = _write_snapshots(spark, sf_dir, scratch_dir(spark, "snapshots"))
    newest = readers.latest_snapshot(spark.read.text(root), "product_urls_")
    return readers.url_lines(newest).select("url")


@register("read_checkpoint")
def q_read_checkpoint(spark, sf_dir):
    root = scratch_dir(spark, "checkpoint")
    orders = fx.table(spark, sf_dir, "orders")
    orders.agg(F.to_json(F.struct(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss")
                                  .alias("last_date"))).alias("value")) \
        .write.mode("overwrite").text(f"{root}/good")
    spark.range(1).select(F.lit('{"last_date": "not a date"').alias("value")) \
        .write.mode("overwrite").text(f"{root}/broken")
    return readers.read_checkpoint(spark, root)


# ---------------------------------------------------------------- sinks (write, read back)

@register("write_csv_compat")
def q_write_csv_compat(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    docs = fx.table(spark, sf_dir, "documents")
    writers.write_csv_compat(docs, path)
    return readers_csv(spark, path, docs)


def readers_csv(spark, path, like) -> DataFrame:
    return writers.read_csv_compat(spark, path, like.schema)


def _written(spark, root: str) -> DataFrame:
    """Posts and comments as written, one table with a ``kind``."""
    read = lambda kind: spark.read.parquet(f"{root}/{kind}").withColumn("kind", F.lit(kind))
    return read("posts").unionByName(read("comments"), allowMissingColumns=True)


@register("write_run_snapshot")
def q_write_run_snapshot(spark, sf_dir):
    root = scratch_dir(spark, "run")
    writers.write_run_snapshot({"posts": posts_of(spark, sf_dir), "comments": comments_of(spark, sf_dir)},
                               root, "20240101_000000")
    return _written(spark, root).withColumn("run", F.col("run").cast("string"))


@register("write_daily")
def q_write_daily(spark, sf_dir):
    root = scratch_dir(spark, "daily")
    tables = {"posts": posts_of(spark, sf_dir), "comments": comments_of(spark, sf_dir)}
    writers.write_daily(tables, root, "2024-01-01")
    writers.write_daily(tables, root, "2024-01-01")      # same-day rerun replaces
    return _written(spark, root).withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


@register("write_monthly")
def q_write_monthly(spark, sf_dir):
    """Every month is published with the rows whose score is even, then again
    whole; readers see the second version only."""
    root = scratch_dir(spark, "monthly")
    tables = {"posts": threads.tag_month(posts_of(spark, sf_dir)), "comments": threads.tag_month(comments_of(spark, sf_dir))}
    keys = {"posts": "id", "comments": "comment_id"}
    writers.write_monthly({k: df.where(F.col("score") % 2 == 0) for k, df in tables.items()}, root, keys, status="open")
    writers.write_monthly(tables, root, keys)
    posts, comments = (writers.read_months(spark, root, k, df.schema).withColumn("kind", F.lit(k)) for k, df in tables.items())
    return posts.unionByName(comments, allowMissingColumns=True)


@register("write_url_list")
def q_write_url_list(spark, sf_dir):
    path = scratch_dir(spark, "urls")
    writers.write_url_list(listing_urls(spark, sf_dir), path)
    return readers.read_url_list(spark, path)


@register("write_checkpoint")
def q_write_checkpoint(spark, sf_dir):
    path = scratch_dir(spark, "manifest")
    month = F.to_timestamp(F.concat("scrape_month", F.lit("-01")))
    writers.write_checkpoint(manifest_of(spark, sf_dir).withColumn("last_date", F.add_months(month.cast("date"), 1).cast("timestamp")),
                             path)
    return writers.read_manifest(spark, path).select("scrape_month", "kind", "rows", "status", "last_date")


@register("checkpoint_iso_text")
def q_checkpoint_iso_text(spark, sf_dir):
    """The saved date as ISO text, written and read back as written."""
    path = scratch_dir(spark, "iso")
    orders = fx.table(spark, sf_dir, "orders")
    writers.write_last_date(orders.agg(F.max("o_orderdate").alias("last_date")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---------------------------------------------------------------- streaming

@register("ingest_threads_stream")
def q_ingest_threads_stream(spark, sf_dir):
    base = scratch_dir(spark, "ingest")
    _write_threads_json(spark, sf_dir, f"{base}/in")
    q = jobs.ingest_threads_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=3)
    q.awaitTermination()
    return _written(spark, f"{base}/out").drop("query", "batch_id")


@register("distinct_urls_stream")
def q_distinct_urls_stream(spark, sf_dir):
    base = scratch_dir(spark, "urlstream")
    prod = links.resolve_urls(links.product_links(listing_links(spark, sf_dir)), fx.SITE_ROOT)
    prod.select("page_id", "url").write.mode("overwrite").parquet(f"{base}/in")
    stream = spark.readStream.schema("page_id long, url string").option("maxFilesPerTrigger", 2) \
        .parquet(f"{base}/in")
    q = (jobs.distinct_urls_stream(stream).select("url").writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def _run_interim(spark, sf_dir) -> str:
    """Product pages arrive in list order, in four runs; a run's files, as many
    as tasks write them, are one batch."""
    base = scratch_dir(spark, "interim")
    pages = fx.product_pages(spark, sf_dir)
    top = pages.agg(F.max("page_id")).first()[0] + 1
    for k in range(4):
        (pages.where((F.col("page_id") >= k * top // 4) & (F.col("page_id") < (k + 1) * top // 4))
         .write.mode("append").parquet(f"{base}/in"))
        q = jobs.interim_reviews_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", every=5, files_per_batch=None)
        q.awaitTermination()
    return base


@register("interim_reviews_stream")
def q_interim_reviews_stream(spark, sf_dir):
    base = _run_interim(spark, sf_dir)
    return spark.read.parquet(f"{base}/out/reviews").drop("query", "batch_id")


@register("write_interim")
def q_write_interim(spark, sf_dir):
    base = _run_interim(spark, sf_dir)
    return jobs.interim_progress(spark, f"{base}/out")


@register("error_streak_stream")
def q_error_streak_stream(spark, sf_dir):
    """The log arrives in three runs (days 1-10, 11-20, 21-30), in no order;
    every third attempt of a run's last day comes one run late, which the
    watermark waits for.  A heartbeat after the end lets the last ones be counted."""
    base = scratch_dir(spark, "streak")
    log = _flagged_log(spark, sf_dir)
    day = F.dayofmonth("attempt_ts")
    late = F.col("attempt_seq") % 3 == 0
    run = F.least(F.floor((day - 1) / 10), F.lit(2))
    log = log.withColumn("_run", F.when(day.isin(10, 20) & late, run + 1).otherwise(run))
    schema = log.drop("_run").schema
    for run in range(4):
        if run < 3:
            rows = log.where(F.col("_run") == run).drop("_run").repartition(4, "attempt_seq")
        else:
            rows = (log.agg((F.max("attempt_ts") + F.expr("INTERVAL 10 DAYS")).alias("attempt_ts"))
                    .select(*[F.col("attempt_ts") if f.name == "attempt_ts" else F.lit(-1).cast(f.dataType).alias(f.name)
                              if f.name in ("crawl_id", "attempt_seq") else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]))
        rows.write.mode("overwrite").parquet(f"{base}/in/run={run}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{base}/in/run=*")
        q = (jobs.error_streak_stream(stream, n=5, delay="2 days").writeStream.format("parquet")
             .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("crawl_id", "attempt_seq")


# ---------------------------------------------------------------- composed flows

@register("collect_threads")
def q_collect_threads(spark, sf_dir):
    posts, _ = flows.collect_threads(fx.thread_archive(spark, sf_dir), "1-URGENT", "year", 100,
                                     _max_order_date(spark, sf_dir))
    return posts


@register("collect_threads_comments")
def q_collect_threads_comments(spark, sf_dir):
    _, comments = flows.collect_threads(fx.thread_archive(spark, sf_dir), "1-URGENT", "year", 100,
                                        _max_order_date(spark, sf_dir))
    return comments


@register("collect_communities")
def q_collect_communities(spark, sf_dir):
    posts, _ = flows.collect_communities(fx.thread_archive(spark, sf_dir), ["1-URGENT", "3-MEDIUM", "5-LOW"],
                                         "year", 100, _max_order_date(spark, sf_dir))
    return posts


@register("collect_communities_comments")
def q_collect_communities_comments(spark, sf_dir):
    _, comments = flows.collect_communities(fx.thread_archive(spark, sf_dir), ["1-URGENT", "3-MEDIUM", "5-LOW"],
                                            "year", 100, _max_order_date(spark, sf_dir))
    return comments


def _collect_sources(spark, sf_dir):
    root, expected = fx.broken_archive(spark, sf_dir)
    return flows.collect_sources(spark, root, ["1-URGENT", "3-MEDIUM", "5-LOW"], "year", 100, _max_order_date(spark, sf_dir), expected)


@register("collect_sources")
def q_collect_sources(spark, sf_dir):
    """Posts and comments of an archive with a truncated, a corrupt and a missing file."""
    posts, comments, _ = _collect_sources(spark, sf_dir)
    return posts.withColumn("kind", F.lit("posts")).unionByName(comments.withColumn("kind", F.lit("comments")), allowMissingColumns=True)


@register("quarantine_files")
def q_quarantine_files(spark, sf_dir):
    """The broken files; a missing one is known by its name, which holds no part."""
    _, _, bad = _collect_sources(spark, sf_dir)
    part = F.when(F.col("reason") != "missing", F.regexp_extract("file", "part=([0-9]+)/", 1).cast("int"))
    return bad.select(part.alias("part"), "reason")


@register("read_threads_isolated")
def q_read_threads_isolated(spark, sf_dir):
    """Every post of the files that are whole."""
    root, expected = fx.broken_archive(spark, sf_dir)
    found, _ = archive.read_threads_isolated(spark, root, expected)
    return threads.project_posts(threads.split_malformed(found)[0])


@register("daily_snapshot")
def q_daily_snapshot(spark, sf_dir):
    root = scratch_dir(spark, "daily-job")
    flows.daily_snapshot(spark, fx.thread_archive(spark, sf_dir), root, _max_order_date(spark, sf_dir),
                         communities=PRIORITIES)
    return _written(spark, root).withColumn("run_date", F.date_format("run_date", "yyyy-MM-dd"))


def _backfill(spark, sf_dir, limit: int) -> DataFrame:
    start, end = _order_date_range(spark, sf_dir)
    root = scratch_dir(spark, "backfill")
    flows.backfill_by_month(spark, fx.thread_archive(spark, sf_dir), root, start, end, limit=limit)
    return flows.read_backfill(spark, root)


@register("backfill_by_month")
def q_backfill_by_month(spark, sf_dir):
    return _backfill(spark, sf_dir, flows.BACKFILL_LIMIT)


@register("backfill_by_month_top20")
def q_backfill_by_month_top20(spark, sf_dir):
    return _backfill(spark, sf_dir, 20)


@register("backfill_last_years")
def q_backfill_last_years(spark, sf_dir):
    root = scratch_dir(spark, "backfill-years")
    flows.backfill_last_years(spark, fx.thread_archive(spark, sf_dir), root, _max_order_date(spark, sf_dir))
    return flows.read_backfill(spark, root)


@register("resume_backfill")
def q_resume_backfill(spark, sf_dir):
    """First run stops mid-range; the second run over the whole range only
    does the months the manifest does not show complete."""
    start, end = _order_date_range(spark, sf_dir)
    root = scratch_dir(spark, "resume")
    archive = fx.thread_archive(spark, sf_dir)
    flows.backfill_by_month(spark, archive, root, start, _dt.datetime(1998, 6, 15, 12, 0))
    flows.resume_backfill(spark, archive, root, start, end)
    return flows.read_backfill(spark, root)


@register("collect_product_urls")
def q_collect_product_urls(spark, sf_dir):
    return flows.collect_product_urls(fx.listing_pages(spark, sf_dir), fx.CONTAINER_CLASS, fx.SITE_ROOT)


@register("collect_product_urls_failures")
def q_collect_product_urls_failures(spark, sf_dir):
    """The same listing with failed pages: every 9th fails, one has no known
    status, and five in a row fail three quarters of the way, which ends it."""
    return flows.collect_product_urls(fx.failing_listing_pages(spark, sf_dir), fx.CONTAINER_CLASS, fx.SITE_ROOT)


@register("last_n_months")
def q_last_n_months(spark, sf_dir):
    return periods.last_n_months(spark, _max_order_date(spark, sf_dir), 6)


@register("lookup_pages_refetched")
def q_lookup_pages_refetched(spark, sf_dir):
    """Every third page was fetched three times; the newest version counts."""
    found, _ = catalog.lookup_pages(url_list(spark, sf_dir), fx.refetched_pages(spark, sf_dir))
    return found.select("url", "page_id", "fetched_at", F.startswith("html", F.lit("<!-- old")).alias("is_old"))


@register("collect_reviews")
def q_collect_reviews(spark, sf_dir):
    root = _write_snapshots(spark, sf_dir, scratch_dir(spark, "review-lists"))
    return flows.collect_reviews(spark, root, fx.product_pages(spark, sf_dir))


@register("collect_products")
def q_collect_products(spark, sf_dir):
    products, _ = flows.collect_products(url_list(spark, sf_dir), fx.product_pages(spark, sf_dir))
    return products


@register("collect_products_reviews")
def q_collect_products_reviews(spark, sf_dir):
    _, reviews = flows.collect_products(url_list(spark, sf_dir), fx.product_pages(spark, sf_dir))
    return reviews


@register("append_reviews")
def q_append_reviews(spark, sf_dir):
    """Reviews of two collection runs (even and odd products) in one table."""
    parsed = parsed_pages(spark, sf_dir)
    runs = [catalog.explode_reviews(parsed.where(F.col("page_id") % 2 == r)) for r in (0, 1)]
    return threads.append_reviews(runs)


# ---------------------------------------------------------------- second modes of two-mode operators

@register("classify_fetch_narrow")
def q_classify_fetch_narrow(spark, sf_dir):
    return crawl.classify_fetch(crawl_log(spark, sf_dir), retry_codes=crawl.RETRY_CODES_NARROW) \
        .select("crawl_id", "attempt_seq", "status", "fetch_class")


@register("read_url_list_keep_blank")
def q_read_url_list_keep_blank(spark, sf_dir):
    path = scratch_dir(spark, "url-list")
    fx.url_list_rows(spark, sf_dir).write.mode("overwrite").text(path)
    return readers.read_url_list(spark, path, keep_blank=True)


@register("flatten_comments_compat")
def q_flatten_comments_compat(spark, sf_dir):
    return threads.flatten_comments(fx.thread_archive(spark, sf_dir), compat_author=True)


@register("error_cutoff_first_error")
def q_error_cutoff_first_error(spark, sf_dir):
    """The older listing collector stops at the first error (n = 1)."""
    return crawl.error_cutoff(_flagged_log(spark, sf_dir), n=1).select("crawl_id", "attempt_seq", "status")
