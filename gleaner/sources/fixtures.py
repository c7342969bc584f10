"""Reference-shaped inputs derived from the driver's test tables.

Every view here is a plain Spark plan over the given parquet tables, so its
size grows with them.  The mapping rules (which key becomes which field,
which rows get which decoy) are documented in FIXTURES.md; the DuckDB
oracles in ``__spark_entry__`` restate the same rules in SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.session import scratch_dir, sorted_aggregates

# Threads whose comment count exceeds this are split over several rows
# (comment pages) so no single row or aggregation group grows with the data.
COMMENTS_PER_PAGE = 1000

SITE_ROOT = "https://shop.example.com"
LISTING_PATH = "/c/skin-care.html"
# The product container class string of the listing pages.
CONTAINER_CLASS = "relative rounded-md border-[1px] border-[#e1dfdf]"
PRODUCTS_PER_LISTING_PAGE = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Derived views are staged once per application: built by Spark from the
# tables, written to the shared checkpoint folder, then read like any table.
_STAGED: dict[tuple, str] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    path = _STAGED.get(key)
    if path is not None:
        try:
            return spark.read.parquet(path)
        except AnalysisException:    # staged files were removed: build again
            _STAGED.pop(key, None)
    path = scratch_dir(spark, f"staged-{name}")
    with sorted_aggregates(spark):
        build().write.mode("overwrite").parquet(path)
    _STAGED[key] = path
    return spark.read.parquet(path)


# ---------------------------------------------------------------- threads

# What a line carries until its comment is built: far narrower than the comment.
_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate"]


def _comment_id(post_key: F.Column, line: Callable[[str], F.Column]) -> F.Column:
    return F.concat_ws("-", post_key, line("l_linenumber"), line("l_partkey"), line("l_suppkey"))


def _comment(post_key: F.Column, line: Callable[[str], F.Column]) -> F.Column:
    return F.struct(
        _comment_id(post_key, line).alias("id"),
        F.concat(F.lit("line "), line("l_linenumber").cast("string"), F.lit(" "),
                 line("l_returnflag"), line("l_linestatus")).alias("body"),
        F.round(line("l_quantity")).cast("long").alias("score"),
        F.unix_seconds(line("l_shipdate").cast("timestamp")).alias("created_epoch"),
        F.when(line("l_partkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Supplier#"), F.lpad(line("l_suppkey").cast("string"), 9, "0")))
         .alias("author"),
    )


def thread_archive(spark: SparkSession, sf_dir: str,
                   comments_per_page: int = COMMENTS_PER_PAGE) -> DataFrame:
    """`fx_threads`, staged (see ``build_thread_archive``)."""
    if comments_per_page != COMMENTS_PER_PAGE:
        return build_thread_archive(spark, sf_dir, comments_per_page)
    return staged(spark, sf_dir, "threads", lambda: build_thread_archive(spark, sf_dir))


def build_thread_archive(spark: SparkSession, sf_dir: str,
                         comments_per_page: int = COMMENTS_PER_PAGE) -> DataFrame:
    """`fx_threads`: one row per post (per comment page), comments nested.

    Nesting is the data model of a thread archive.  To keep every row
    bounded, a thread with more than `comments_per_page` comments is split
    by a hash of the comment id into pages 1..n, and page 0 is a header
    row with no comments.  Only the threads that are split (fewer than one
    for every `comments_per_page` comments) meet the rows by a broadcast, so a
    hot thread is spread by page; any other thread is one group and counts
    itself there.  Lines are shuffled once, sorted once and grouped as they are
    in the table; they become comments when the rows are written.
    """
    orders = table(spark, sf_dir, "orders")
    lines = (table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull())
             .select(F.col("l_orderkey").alias("post_key"), *_LINE))
    large = F.broadcast(lines.groupBy("post_key").agg(F.count(F.lit(1)).alias("large"))
                        .where(F.col("large") > comments_per_page))
    last_page = F.ceil(F.col("large") / F.lit(comments_per_page))

    paged = lines.join(large, "post_key", "left").withColumn(
        "comment_page",
        F.when(F.col("large").isNull(), F.lit(0))
         .otherwise(F.lit(1) + F.pmod(F.xxhash64(_comment_id(F.col("post_key"), F.col)), last_page))
         .cast("int"),
    )
    pages = paged.repartition("post_key", "comment_page").groupBy("post_key", "comment_page").agg(
        F.count(F.lit(1)).alias("n"),
        # Order inside a thread is not part of the data model (every reader
        # explodes or counts), so no per-group sort.
        F.collect_list(F.struct(*_LINE)).alias("lines"),
    )

    posts = orders.select(
        F.col("o_orderkey").alias("post_key"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("community"),
        F.concat(F.lit("status "), F.col("o_orderstatus")).alias("title"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("body"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("score"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("created_epoch"),
    )
    posts = posts.join(large, "post_key", "left").withColumn(
        "comment_page", F.explode(F.sequence(F.lit(0), F.coalesce(last_page, F.lit(0)).cast("int"))))
    comments = F.transform("lines", lambda line: _comment(F.col("post_key"), lambda c: line[c]))
    return (posts.join(pages, ["post_key", "comment_page"], "left")
            .where((F.col("comment_page") == 0) | F.col("n").isNotNull())        # a page that got no comment is none
            .select("id", "community", "title", "body", "score", "created_epoch",
                    F.coalesce("large", "n", F.lit(0)).cast("long").alias("num_comments"), "comment_page",
                    F.coalesce(comments, F.array().cast(T.ArrayType(schemas.COMMENT))).alias("comments")))


def comment_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_forest`: reply edges; turn t answers turn floor((t-1)/2)."""
    conv = table(spark, sf_dir, "conversations")
    node = lambda turn: F.concat_ws("-", F.col("conv_id"), turn)
    return conv.select(
        node(F.col("turn")).alias("id"),
        F.when(F.col("turn") == 0, F.lit(None).cast("string"))
         .otherwise(node(F.expr("(turn - 1) div 2"))).alias("parent_id"),
        F.col("turn").alias("sibling_key"),
        F.col("role"),
    )


ARCHIVE_FILES = 64


def broken_archive(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """(folder, expected names): the thread archive as 64 gzipped JSON files,
    thread ``id`` in file ``id % 64``.  File 3 is cut in half, file 5 has lost
    its first bytes, file 7 is gone."""
    root = scratch_dir(spark, "archive-files")
    part = (F.col("id").cast("long") % ARCHIVE_FILES).cast("int")
    rows = thread_archive(spark, sf_dir).withColumn("part", part)
    rows.repartition(ARCHIVE_FILES, "part").write.partitionBy("part").option("compression", "gzip").json(f"{root}/in")
    listed = spark.read.format("binaryFile").load(f"{root}/in").select("path", "length", "part", F.col("_metadata.file_name").alias("name"))
    files = listed.collect()                                     # one a part
    jvm = spark.sparkContext._jvm                                # two files are cut, one is deleted
    for file in files:
        if file["part"] not in (3, 5, 7):
            continue
        path, cut = (jvm.org.apache.hadoop.fs.Path(p) for p in (file["path"], f"{root}/cut-{file['part']}"))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if file["part"] != 7:
            start, end = (0, file["length"] // 2) if file["part"] == 3 else (5, file["length"])
            source, target = fs.open(path), fs.create(cut)
            jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, start, end - start)
            source.close()
            target.close()
        fs.delete(path, False)
        if file["part"] != 7:
            fs.rename(cut, path)
    expected = [(f"part={f['part']}/{f['name']}",) for f in files]
    return f"{root}/in", spark.createDataFrame(expected, "name string")


# ---------------------------------------------------------------- catalogue

def _slug() -> F.Column:
    return F.concat(F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("/"),
                    F.regexp_replace("p_name", " ", "-"), F.lit("-"),
                    F.col("p_partkey").cast("string"))


def product_url() -> F.Column:
    return F.concat(F.lit(SITE_ROOT + "/p/"), _slug(), F.lit(".html"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_product_pages`, staged (see ``build_product_pages``)."""
    return staged(spark, sf_dir, "product-pages", lambda: build_product_pages(spark, sf_dir))


def build_product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_product_pages`: one archived product page per part.

    Reviews are the documents with ``doc_id div 5 = p_partkey`` (at most
    five per product).  Variants by key: brand missing (mod 7), image as
    string / list / absent (mod 3), review key absent (mod 11), no payload
    script (mod 13), truncated JSON (mod 17).  Every page carries a decoy
    script with a longer id and a commented-out copy of the element.
    """
    part = table(spark, sf_dir, "part")
    docs = table(spark, sf_dir, "documents")
    review = F.struct(
        F.concat(F.col("lang"), F.lit(" review "), F.col("doc_id").cast("string")).alias("name"),
        F.col("text").alias("reviewBody"),
        F.format_string("2024-%02d-%02d", F.col("doc_id") % 12 + 1, F.col("doc_id") % 28 + 1)
         .alias("datePublished"),
        F.when(F.col("doc_id") % 9 == 0, F.lit(None))
         .otherwise(F.struct(F.concat(F.lit("user"), (F.col("doc_id") % 97).cast("string")).alias("name")))
         .alias("author"),
        F.struct((F.col("doc_id") % 5 + 1).cast("string").alias("ratingValue")).alias("reviewRating"),
    )
    reviews = (docs.select(F.expr("doc_id div 5").alias("p_partkey"), "doc_id", review.alias("r"))
               .groupBy("p_partkey")
               .agg(F.array_sort(F.collect_list(F.struct("doc_id", "r"))).alias("rs"))
               .select("p_partkey", F.transform("rs", lambda x: x["r"]).alias("reviews")))

    key = F.col("p_partkey")
    img = F.concat(F.lit(SITE_ROOT + "/img/"), key.cast("string"))
    return _assemble_product_pages(part, reviews, key, img)


def _assemble_product_pages(part: DataFrame, reviews: DataFrame, key: F.Column, img: F.Column) -> DataFrame:
    df = part.join(reviews, "p_partkey", "left")
    base = F.to_json(F.struct(
        F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_type", "p_name").alias("description"),
        F.concat(F.col("p_size").cast("string"), F.lit("ml")).alias("size"),
        F.concat(F.lit("aqua, "), F.col("p_brand")).alias("material"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.struct(F.col("p_brand").alias("name"))).alias("brand"),
        # Products without documents still carry an (empty) review list.
        F.when(key % 11 == 0, F.lit(None))
         .otherwise(F.coalesce(F.col("reviews"), F.array().cast(reviews.schema["reviews"].dataType)))
         .alias("review"),
    ))
    base = F.when(key % 2 == 0, F.regexp_replace(base, '"ratingValue":"([0-9])"', '"ratingValue":$1')) \
            .otherwise(base)
    image_json = (F.when(key % 3 == 0, F.concat(F.lit('"'), img, F.lit('.jpg"')))
                  .when(key % 3 == 1, F.concat(F.lit('["'), img, F.lit('a.jpg","'), img, F.lit('b.jpg"]'))))
    with_image = F.concat(F.expr("left(base_json, length(base_json) - 1)"), F.lit(',"image":'),
                          image_json, F.lit("}"))
    df = df.withColumn("base_json", base).withColumn(
        "payload", F.when(image_json.isNull(), F.col("base_json")).otherwise(with_image))
    # A script body must not contain "</"; JSON allows the escaped form.
    df = df.withColumn("payload", F.replace(F.col("payload"), F.lit("</"), F.lit("<\\/")))
    df = df.withColumn("payload", F.when(key % 17 == 0, F.expr("left(payload, length(payload) div 2)"))
                       .otherwise(F.col("payload")))
    id_attr = (F.when(key % 4 == 1, F.lit("id='product_structured_data'"))
               .when(key % 4 == 2, F.lit("id=product_structured_data"))
               .otherwise(F.lit('id="product_structured_data"')))
    script = F.concat(F.lit('<script type="application/ld+json" '), id_attr, F.lit(">"),
                      F.col("payload"), F.lit("</script>"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), F.col("p_name"), F.lit("</title>"),
        F.lit('<script id="product_structured_data_2" type="application/ld+json">{"sku":"decoy"}</script>'),
        F.lit('<!-- <script id="product_structured_data">{"sku":"commented"}</script> -->'),
        F.when(key % 13 == 0, F.lit("")).otherwise(script),
        F.lit("</head><body><h1>"), F.col("p_name"), F.lit("</h1><p>Size "),
        F.col("p_size").cast("string"), F.lit("</p></body></html>"),
    )
    return df.select(
        key.alias("page_id"),
        product_url().alias("url"),
        html.alias("html"),
        F.lit(200).alias("status"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=key)).alias("fetched_at"),
    )


def url_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a product URL list: every product URL, some padded with
    blanks, blank lines, and URLs of discontinued products (mod 19) that
    have no archived page."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    url = product_url()
    lines = F.array(
        F.when(key % 3 == 0, F.concat(F.lit("  "), url, F.lit(" "))).otherwise(url),
        F.when(key % 10 == 0, F.lit("")).when(key % 10 == 1, F.lit("   ")),
        F.when(key % 19 == 0, F.concat(F.lit(SITE_ROOT + "/p/discontinued-"), key.cast("string"),
                                       F.lit(".html"))),
    )
    return part.select(F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("value"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_listing_pages`, staged (see ``build_listing_pages``)."""
    return staged(spark, sf_dir, "listing-pages", lambda: build_listing_pages(spark, sf_dir))


def build_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_listing_pages`: 24 parts per listing page, in product containers.

    Container variants by ``p_partkey % 24``: 5 classes in another order (not
    a container), 7 container without a link, 11 first link is a category
    link, 13 commented out, 17 href with an ``&amp;`` entity, 19 an anchor
    without href before the product link, 23 irregular class whitespace.
    Hrefs by ``p_partkey % 4``: absolute path, ``./`` relative, absolute
    URL, path with a ``..`` segment.  One empty page follows the last.
    """
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    v = key % 24
    slug = _slug()
    href = (F.when(key % 4 == 0, F.concat(F.lit("/p/"), slug, F.lit(".html")))
            .when(key % 4 == 1, F.concat(F.lit("./p/"), slug, F.lit(".html")))
            .when(key % 4 == 2, F.concat(F.lit(SITE_ROOT + "/p/"), slug, F.lit(".html")))
            .otherwise(F.concat(F.lit("/c/../p/"), slug, F.lit(".html"))))
    href = F.when(v == 17, F.concat(href, F.lit("?src=list&amp;pos=17"))).otherwise(href)
    cls = F.lit(f'<div class="{CONTAINER_CLASS}">')
    link = F.concat(F.lit('<div class="img"><a href="'), href, F.lit('"><img src="/img/'),
                    key.cast("string"), F.lit('.jpg"></a></div>'))
    name = F.concat(F.lit("<span>"), F.col("p_name"), F.lit("</span>"))
    container = (
        F.when(v == 5, F.concat(F.lit('<div class="rounded-md relative border-[1px] border-[#e1dfdf]">'),
                                link, name, F.lit("</div>")))
        .when(v == 7, F.concat(cls, name, F.lit("</div>")))
        .when(v == 11, F.concat(cls, F.lit('<a href="/c/skin-care.html">more</a>'), link, name, F.lit("</div>")))
        .when(v == 13, F.concat(F.lit("<!-- "), cls, link, F.lit("</div> -->")))
        .when(v == 19, F.concat(cls, F.lit('<a name="top">top</a>'), link, name, F.lit("</div>")))
        .when(v == 23, F.concat(F.lit('<div class=" relative  rounded-md border-[1px]\tborder-[#e1dfdf] ">'),
                                link, name, F.lit("</div>")))
        .otherwise(F.concat(cls, link, name, F.lit("</div>")))
    )
    page_no = (key.cast("long") / PRODUCTS_PER_LISTING_PAGE).cast("long") + 1
    per_page = (part.select(page_no.alias("page_id"), key.alias("k"), container.alias("c"))
                .groupBy("page_id")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))),
                                              lambda x: x["c"]), "").alias("body")))
    last = part.agg(((F.max(key).cast("long") / PRODUCTS_PER_LISTING_PAGE).cast("long") + 2).alias("page_id"))
    empty = last.select("page_id", F.lit("").alias("body"))
    pages = per_page.unionByName(empty)
    html = F.concat(
        F.lit('<html><body><nav><a href="/c/skin-care.html">Skin care</a></nav><div class="grid">'),
        F.col("body"),
        F.lit('</div><footer><a href="/about">About</a></footer></body></html>'),
    )
    return pages.select(
        "page_id",
        F.concat(F.lit(SITE_ROOT + LISTING_PATH + "?p="), F.col("page_id").cast("string")).alias("url"),
        html.alias("html"),
        F.lit(200).alias("status"),
    )


def failing_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of a walk with failures: pages with ``page_id % 9 = 4``
    failed, page 2 has no known status, and five pages in a row failed from
    page 3/4 of the last one on (the walk ends there)."""
    pages = listing_pages(spark, sf_dir)
    last = pages.agg(F.max("page_id")).scalar()
    stop = F.floor(last * 3 / 4).cast("long")
    page = F.col("page_id")
    failed = (page % 9 == 4) | page.between(stop, stop + 4)
    return pages.withColumn("status", F.when(page == 2, F.lit(None)).when(failed, F.lit(503)).otherwise(F.lit(200)).cast("int"))


def refetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product pages where every third was fetched three times: an older
    version, the page itself, and a second copy of the same fetch."""
    pages = product_pages(spark, sf_dir)
    again = pages.where(F.col("page_id") % 3 == 0)
    older = again.withColumn("html", F.concat(F.lit("<!-- old -->"), F.col("html"))).withColumn(
        "fetched_at", F.col("fetched_at") - F.expr("INTERVAL 1 DAY"))
    return pages.unionByName(older).unionByName(again)


def broken_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reply forest without the turns whose number is 1, and a cycle of
    two nodes for every 50th conversation."""
    edges = comment_forest(spark, sf_dir).drop("role")
    conv = table(spark, sf_dir, "conversations").where((F.col("turn") == 0) & (F.col("conv_id") % 50 == 0))
    name = lambda x: F.concat(F.lit(x), F.col("conv_id").cast("string"))
    loop = conv.select(name("a").alias("id"), name("b").alias("parent_id"), F.lit(0).cast("long").alias("sibling_key")).unionAll(
        conv.select(name("b"), name("a"), F.lit(1).cast("long")))
    return edges.where(F.col("sibling_key") != 1).unionByName(loop)


# ---------------------------------------------------------------- crawl log

def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`fx_crawl_log`: one fetch attempt per event.

    crawl_id / url come from user_id, attempt order is (ts, event_id).
    Events of type 'error' failed with 503, 429 or 500 (by ``k % 3``); the
    rest loaded with status 200 and ``k % 25`` results.
    """
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    err = F.col("event_type") == "error"
    return ev.select(
        F.col("user_id").alias("crawl_id"),
        F.concat(F.lit(SITE_ROOT + "/p/item-"), F.col("user_id").cast("string"), F.lit(".html")).alias("url"),
        F.col("ts").cast("timestamp").alias("attempt_ts"),
        F.col("event_id").alias("attempt_seq"),
        F.when(err, F.when(k % 3 == 0, 503).when(k % 3 == 1, 429).otherwise(500))
         .otherwise(200).cast("int").alias("status"),
        F.when(err, F.lit(0)).otherwise(k % 25).cast("long").alias("n_results"),
    )
