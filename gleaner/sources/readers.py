"""Scans: thread archives, page archives, URL lists, snapshots, checkpoints."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas


def read_threads(spark: SparkSession, path: str | list[str], fmt: str = "json") -> DataFrame:
    """SRC-1: archived threads (one row per post, comments nested) with the
    declared schema; malformed JSON lines land in ``_corrupt_record`` (see
    ``threads.split_malformed``)."""
    if fmt == "json":
        schema = T.StructType(schemas.THREAD.fields + [T.StructField("_corrupt_record", T.StringType())])
        return (spark.read.schema(schema).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return spark.read.schema(schemas.THREAD).format(fmt).load(path)


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-2: archived pages; ``status`` / ``fetched_at`` are optional in the
    files and null when absent."""
    df = spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
    for field in schemas.PAGES.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PAGES.fields],
                     *[c for c in df.columns if c not in schemas.PAGES.fieldNames()])


# What counts as white space at the ends of a list line.
LINE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def url_lines(df: DataFrame, col: str = "value", keep_blank: bool = False) -> DataFrame:
    """Lines to URLs: white space at the ends off, blank lines dropped unless ``keep_blank``."""
    out = df.withColumn("url", F.btrim(F.col(col), F.lit(LINE_SPACE))).drop(col)
    return out if keep_blank else out.where(F.col("url") != "")


def read_url_list(spark: SparkSession, path: str | list[str], keep_blank: bool = False) -> DataFrame:
    """SRC-3: text file(s) of URLs, one per line."""
    return url_lines(spark.read.text(path), keep_blank=keep_blank)


def latest_snapshot(df: DataFrame, prefix: str, name_col: str = "snapshot") -> DataFrame:
    """SRC-4: of the snapshots whose name starts with ``prefix``, keep the
    lexicographically last one (timestamped names sort by time).  The max
    is a scalar subquery; on a partition column it prunes files."""
    mine = df.where(F.startswith(F.col(name_col), F.lit(prefix)))
    newest = mine.agg(F.max(name_col)).scalar()
    return mine.where(F.col(name_col) == newest)


def read_latest_snapshot(spark: SparkSession, root: str, prefix: str, name_col: str = "snapshot",
                         fmt: str = "text") -> DataFrame:
    """SRC-4 over a folder of snapshots (``<name_col>=<name>`` folders or
    plain files).  The newest name is a scalar subquery over one row a file
    (their bytes are not read), and a filter on the partition or on the
    file's name, so only that snapshot's files are opened."""
    files = spark.read.format("binaryFile").load(root)
    folders = name_col in files.columns
    name = F.col(name_col) if folders else F.col("_metadata.file_name")
    newest = files.where(F.startswith(name.cast("string"), F.lit(prefix))).agg(F.max(name.cast("string"))).scalar()
    rows = spark.read.format(fmt).load(root).where(name == newest)
    return rows if folders else rows.withColumn(name_col, newest)


def plan_listing_pages(spark: SparkSession, base: str, max_pages: int | None = None,
                       archive: DataFrame | None = None, page_col: str = "page_id") -> DataFrame:
    """SRC-5: listing URLs ``base?p=1..max_pages``.  ``None`` means
    unbounded: the pages present in ``archive`` decide how far it goes.
    ``max_pages = 0`` is rejected (it meant 'unbounded' by accident, D18)."""
    if max_pages is not None and max_pages <= 0:
        raise ValueError("max_pages must be positive or None")
    if max_pages is None:
        if archive is None:
            raise ValueError("an unbounded plan needs the archive of listing pages")
        last = archive.agg(F.max(page_col)).scalar()
        pages = spark.range(1).select(F.explode(F.sequence(F.lit(1).cast("long"), last.cast("long")))
                                      .alias("page_no"))
    else:
        pages = spark.range(1, max_pages + 1).select(F.col("id").alias("page_no"))
    return pages.select("page_no", F.concat(F.lit(base + "?p="), F.col("page_no").cast("string")).alias("url"))


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: the last completed date; a missing or malformed file means
    none (one row, null)."""
    none = spark.range(1).select(F.lit(None).cast("timestamp").alias("last_date"))
    try:
        raw = (spark.read.schema(schemas.CHECKPOINT).option("mode", "PERMISSIVE")
               .option("recursiveFileLookup", "true")
               .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return none
        raise
    parsed = raw.select(F.try_to_timestamp(F.col("last_date")).alias("last_date"))
    return parsed.agg(F.max("last_date").alias("last_date"))
