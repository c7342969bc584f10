"""Thread archive operators: project, flatten, tag, rank, union, count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POST_COLUMNS = ["id", "title", "body", "score", "created_utc", "num_comments"]
COMMENT_COLUMNS = ["comment_id", "post_id", "body", "score", "created_utc", "author"]


def _tags(df: DataFrame, extra: list[str]) -> list[str]:
    return [c for c in extra if c in df.columns]


def split_malformed(threads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-5 for threads: (good, bad).  A line that is no JSON of the schema,
    or a thread without an id, never fails the run and is no post: it is set
    aside with a ``reason``."""
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in threads.columns else F.lit(False)
    reason = F.when(corrupt, F.lit("malformed_json")).when(F.col("id").isNull(), F.lit("no_id"))
    tagged = threads.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason", "_corrupt_record"), tagged.where(F.col("reason").isNotNull())


def project_posts(threads: DataFrame, keep: tuple[str, ...] = ("community", "scrape_month")) -> DataFrame:
    """PRJ-1: the post columns; epoch seconds become a timestamp and the
    nested comments are dropped (only the page-0 row of a thread carries
    the post; a row without an id is none)."""
    df = threads.where(F.col("id").isNotNull())
    if "comment_page" in df.columns:
        df = df.where(F.coalesce(F.col("comment_page"), F.lit(0)) == 0)
    return df.select(
        "id", "title", "body", "score",
        F.timestamp_seconds("created_epoch").alias("created_utc"),
        "num_comments", *_tags(threads, list(keep)),
    )


def flatten_comments(threads: DataFrame, keep: tuple[str, ...] = ("community", "scrape_month"),
                     compat_author: bool = False) -> DataFrame:
    """PRJ-2: one row per comment with its post id; threads without
    comments give no row.  ``compat_author`` writes a missing author as the
    text 'None' (deviation D4)."""
    exploded = threads.where(F.col("id").isNotNull()).select(F.col("id").alias("post_id"), *_tags(threads, list(keep)),
                              F.explode("comments").alias("c"))
    author = F.col("c.author")
    if compat_author:
        author = F.coalesce(author, F.lit("None"))
    return exploded.select(
        F.col("c.id").alias("comment_id"), "post_id", F.col("c.body").alias("body"),
        F.col("c.score").alias("score"), F.timestamp_seconds("c.created_epoch").alias("created_utc"),
        author.alias("author"), *_tags(threads, list(keep)),
    )


def tag_source(df: DataFrame, name: str, col: str = "community") -> DataFrame:
    """PRJ-4: add the literal source (community) name."""
    return df.withColumn(col, F.lit(name))


def tag_month(df: DataFrame, ts: str = "created_utc", col: str = "scrape_month") -> DataFrame:
    """PRJ-5: ``YYYY-MM`` of the row's time."""
    return df.withColumn(col, F.date_format(ts, "yyyy-MM"))


def top_posts(posts: DataFrame, by: list[str] | str = "community", limit: int = 100,
              score: str = "score", tie: str = "id") -> DataFrame:
    """WIN-1: per group the `limit` highest-scoring posts (ties by id).

    ``row_number() <= limit`` plans a WindowGroupLimit below the shuffle,
    so each map task ships at most `limit` rows per group: a hot group does
    not move its whole volume."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return posts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit).drop("_rank")


def union_communities(dfs: list[DataFrame]) -> DataFrame:
    """SET-1: concatenate per-source results by column name; columns a
    source lacks are null.  Empty inputs with declared schemas are fine."""
    if not dfs:
        raise ValueError("union_communities needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def append_reviews(dfs: list[DataFrame]) -> DataFrame:
    """SET-3: reviews of several runs in one table, no de-duplication."""
    return union_communities(dfs)


def output_counts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """AGG-1: row count per output kind."""
    return (posts.select(F.lit("posts").alias("kind"))
            .unionByName(comments.select(F.lit("comments").alias("kind")))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("rows")))


def community_counts(posts: DataFrame, comments: DataFrame, col: str = "community") -> DataFrame:
    """AGG-2: rows per community and kind (one aggregation, map-side combined)."""
    return (posts.select(col, F.lit("posts").alias("kind"))
            .unionByName(comments.select(col, F.lit("comments").alias("kind")))
            .groupBy(col, "kind").agg(F.count(F.lit(1)).alias("rows")))


def backfill_summary(posts: DataFrame, comments: DataFrame, month: str = "scrape_month") -> DataFrame:
    """AGG-3: posts and comments per month plus the grand total (real row
    counts, deviation D9).  The total row has ``is_total`` and a null month."""
    both = (posts.select(month, F.lit(1).alias("p"), F.lit(0).alias("c"))
            .unionByName(comments.select(month, F.lit(0).alias("p"), F.lit(1).alias("c"))))
    return (both.rollup(month)
            .agg(F.sum("p").cast("long").alias("posts"), F.sum("c").cast("long").alias("comments"),
                 (F.grouping_id() == 1).alias("is_total")))
