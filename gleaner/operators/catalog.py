"""Product catalogue: payload extraction, parsing, products and reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.functions.html import script_by_id
from gleaner.functions.keys import review_key, review_uid

# Id of the script element holding the product payload.
PAYLOAD_ELEMENT_ID = "product_structured_data"

_PAYLOAD_SCHEMA = T.StructType(schemas.PRODUCT_PAYLOAD.fields + [T.StructField("_corrupt_record", T.StringType())])


def extract_structured_data(pages: DataFrame, element_id: str = PAYLOAD_ELEMENT_ID,
                            html: str = "html") -> DataFrame:
    """PRJ-6: raw text of the payload script ('' when the page has none);
    the html column is dropped so later stages do not carry it."""
    return pages.withColumn("payload", script_by_id(html, element_id)).drop(html)


def pages_with_payload(df: DataFrame) -> DataFrame:
    """FLT-4: pages without the payload element yield nothing."""
    return df.where(F.col("payload") != "")


def _image_list(image: Column) -> Column:
    """`image` arrives as raw JSON text of a string or a list."""
    trimmed = F.ltrim(image)
    return (F.when(image.isNull(), F.array().cast("array<string>"))
            .when(F.startswith(trimmed, F.lit("[")), F.from_json(image, T.ArrayType(T.StringType())))
            .otherwise(F.array(image)))


def parse_product_json(df: DataFrame, payload: str = "payload") -> DataFrame:
    """PRJ-7: payload text to a typed ``product`` struct.  Absent keys are
    null, ``review`` defaults to an empty list and ``image`` to an empty
    array; a payload that is not valid JSON gives ``parse_ok = false`` and a
    null product (it goes to quarantine, the run continues)."""
    parsed = F.from_json(F.col(payload), _PAYLOAD_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    df = df.withColumn("_p", parsed)
    ok = (F.col(payload) != "") & F.col("_p").isNotNull() & F.col("_p._corrupt_record").isNull()
    p = F.col("_p")
    product = F.struct(
        p["sku"].alias("sku"), p["name"].alias("name"), p["description"].alias("description"),
        p["size"].alias("size"), p["material"].alias("material"), p["brand"]["name"].alias("brand"),
        _image_list(p["image"]).alias("image_urls"),
        F.coalesce(p["review"], F.array().cast(schemas.PRODUCT_PAYLOAD["review"].dataType)).alias("review"),
    )
    return (df.withColumn("parse_ok", ok)
            .withColumn("product", F.when(ok, product))
            .drop("_p"))


def project_products(parsed: DataFrame, scraped_at: Column | str | None = None) -> DataFrame:
    """PRJ-8: the 9-column product table of parsed pages.  ``scraped_at`` is
    the page's fetch time (or a job literal), so reruns agree (D16)."""
    when = F.col("fetched_at") if scraped_at is None else (
        F.col(scraped_at) if isinstance(scraped_at, str) else scraped_at)
    return parsed.where("parse_ok").select(
        "url", F.col("product.sku").alias("sku"), F.col("product.name").alias("name"),
        F.col("product.brand").alias("brand"), F.col("product.description").alias("description"),
        F.col("product.size").alias("size"), F.col("product.material").alias("ingredients"),
        F.col("product.image_urls").alias("image_urls"), when.cast("timestamp").alias("scraped_at"),
    )


def _reviews(parsed: DataFrame) -> DataFrame:
    return parsed.where("parse_ok").select(
        F.col("product.sku").alias("product_sku"), F.col("product.name").alias("product_name"),
        F.col("product.brand").alias("brand"), F.explode("product.review").alias("r"))


def explode_reviews(parsed: DataFrame) -> DataFrame:
    """PRJ-9: one row per review with its product's sku, name and brand."""
    return _reviews(parsed).select(
        review_key(F.col("r.reviewBody")).alias("review_id"), "product_sku", "product_name", "brand",
        F.col("r.author.name").alias("author"), F.col("r.name").alias("title"),
        F.col("r.reviewBody").alias("body"), F.col("r.reviewRating.ratingValue").alias("rating"),
        F.col("r.datePublished").alias("date_published"),
    )


def with_review_ids(reviews: DataFrame) -> DataFrame:
    """Reviews with ``rating_num`` (null where the rating is no number) and
    ``review_uid``, an id that equal bodies of different products, authors or
    dates do not share (D3)."""
    return reviews.withColumns({
        "rating_num": F.col("rating").try_cast("double"),
        "review_uid": review_uid("product_sku", "author", "date_published", "body")})


def explode_reviews_narrow(parsed: DataFrame) -> DataFrame:
    """PRJ-10: the 7-column variant (no product name, no brand)."""
    return explode_reviews(parsed).drop("product_name", "brand")


def reviews_per_product(reviews: DataFrame) -> DataFrame:
    """AGG-6: review rows per product (partial aggregation before the shuffle)."""
    return reviews.groupBy("product_sku").agg(F.count(F.lit(1)).alias("reviews"))


def newest_pages(pages: DataFrame) -> DataFrame:
    """One page per url: the newest fetch (ties: highest page_id, then by
    content).  The newest version is found on narrow columns (a partial
    aggregate) and joined back, so page text moves once and is never sorted
    into an aggregate; the last step keeps one of wholly equal rows."""
    time = F.col("fetched_at").cast("timestamp") if "fetched_at" in pages.columns else F.lit(None).cast("timestamp")
    version = F.struct(F.coalesce(time, F.lit("1970-01-01").cast("timestamp")).alias("t"), F.col("page_id").alias("p"),
                       F.xxhash64(*pages.columns).alias("h"))
    dated = pages.withColumn("_version", version)
    newest = dated.groupBy("url").agg(F.max("_version").alias("_newest"))
    one = Window.partitionBy("url").orderBy("url")
    return (dated.join(newest, "url").where(F.col("_version") == F.col("_newest"))
            .withColumn("_n", F.row_number().over(one)).where("_n = 1").select(*pages.columns))


def lookup_pages(urls: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN-3: the URL list matched to the page archive (instead of one
    request per URL).  Returns (found, missing); every list line is kept,
    duplicates included, as the list is processed line by line."""
    wanted = urls.select("url").distinct()
    candidates = pages.join(wanted, "url", "left_semi")
    found = urls.join(newest_pages(candidates), "url")
    missing = urls.join(pages.select("url"), "url", "left_anti")
    return found, missing


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-5: (good, bad).  A bad page never fails the run; it carries the
    reason it was set aside."""
    reason = (F.when(F.col("payload") == "", F.lit("no_payload"))
              .when(~F.col("parse_ok"), F.lit("malformed_json")))
    tagged = parsed.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())
