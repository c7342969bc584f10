"""Declared schemas: empty inputs keep every column."""

from pyspark.sql import types as T

COMMENT = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_epoch", T.LongType()),
    T.StructField("author", T.StringType()),
])

# One archived thread: the post, and its comments nested.  Very large
# threads arrive split over several rows ("comment pages"); page 0 always
# exists and is the row that carries the post.
THREAD = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("community", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_epoch", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("comment_page", T.IntegerType()),
    T.StructField("comments", T.ArrayType(COMMENT)),
])

# What is collected of a thread.
POSTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.TimestampType()),
    T.StructField("num_comments", T.LongType()),
])

COMMENTS = T.StructType([
    T.StructField("comment_id", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.TimestampType()),
    T.StructField("author", T.StringType()),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampType()),
])

_REVIEW = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("reviewBody", T.StringType()),
    T.StructField("datePublished", T.StringType()),
    T.StructField("author", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("reviewRating", T.StructType([T.StructField("ratingValue", T.StringType())])),
])

# The structured-data payload of a product page.  `image` is a string or a
# list in the wild; it is read as raw text and normalised afterwards.
PRODUCT_PAYLOAD = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("material", T.StringType()),
    T.StructField("brand", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("image", T.StringType()),
    T.StructField("review", T.ArrayType(_REVIEW)),
])

CHECKPOINT = T.StructType([
    T.StructField("last_date", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

MANIFEST = T.StructType([
    T.StructField("scrape_month", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_date", T.TimestampType()),
])

# A manifest row as published: with the folder that holds the month's rows.
PUBLISHED = T.StructType([*MANIFEST.fields, T.StructField("version", T.StringType())])

