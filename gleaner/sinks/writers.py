"""Sinks: compatible CSV, run snapshots, daily and monthly partitions, URL
lists, the backfill manifest.  Every write is an overwrite of exactly the
slice it owns, or a new version that is published when it is whole, so a
rerun after a lost executor or a failed job converges to the same result."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.session import materialize

CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _csv_ready(df: DataFrame) -> DataFrame:
    """Arrays and structs have no CSV form: they are written as JSON text (D14)."""
    cols = [F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType,
                                                                               T.MapType))
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def write_csv_compat(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-1: header, no index, quotes only where needed (doubled inside),
    embedded newlines kept.  Null and empty both read back as null (CSV
    cannot tell them apart); Parquet is the lossless sink."""
    _csv_ready(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv_compat(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_run_snapshot(tables: dict[str, DataFrame], root: str, run_ts: str,
                       require: str | None = "posts", fmt: str = "parquet") -> bool:
    """SNK-2: all tables under one run timestamp (``<root>/<table>/run=<ts>``).
    Nothing is written when the ``require`` table is empty.  Returns
    whether the snapshot was written."""
    if require is not None and tables[require].isEmpty():
        return False
    for name, df in tables.items():
        target = f"{root.rstrip('/')}/{name}/run={run_ts}"
        if fmt == "csv":
            write_csv_compat(df, target)
        else:
            df.write.mode("overwrite").format(fmt).save(target)
    return True


def write_daily(tables: dict[str, DataFrame], root: str, run_date: str) -> None:
    """SNK-3: one ``run_date=<date>`` folder per table; a same-day rerun
    replaces it, and an empty result is still written (with its schema)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/run_date={run_date}")


# ---------------------------------------------------------------- months: write, audit, publish
#
#   <root>/<kind>/version=<v>/scrape_month=<YYYY-MM>/   rows of one run; never changed once written
#   <root>/_manifest/snapshot=<n>-<id>/                 one file: the version of every month and kind
#
# Readers take the newest snapshot and see exactly the versions it names, so
# a run that stops anywhere before its snapshot is there changes nothing.

class AuditError(RuntimeError):
    """What was written is not what should be published."""


def new_version() -> str:
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def stage_months(rows: DataFrame, root: str, kind: str, version: str, month: str = "scrape_month") -> None:
    """Write ``rows`` by month under their version, which no reader follows
    yet.  REBALANCE lets adaptive execution split a hot month into several
    files and merge small ones, instead of one task per month."""
    rows.hint("rebalance", month).write.mode("overwrite").partitionBy(month).parquet(f"{root}/{kind}/version={version}")


def audit_months(staged: DataFrame, kind: str, months: DataFrame, key: str, ts: str | None = None,
                 expected: DataFrame | None = None) -> DataFrame:
    """(scrape_month, kind, rows) of a staged version, read back.

    Raises ``AuditError`` where a row has no ``key``, lies in a month that is
    not among ``months`` or not in the month of its own time ``ts``, or where
    the rows of a month are not as many as ``expected`` (scrape_month, rows)."""
    own = F.lit(False) if ts is None else F.date_format(ts, "yyyy-MM") != F.col("scrape_month")
    counts = staged.groupBy("scrape_month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("no_key"), F.count_if(own).alias("misplaced"))
    planned = months.select("scrape_month", F.lit(True).alias("planned")).distinct()
    seen = counts.join(planned, "scrape_month", "full")
    if expected is not None:
        seen = seen.join(expected.select("scrape_month", F.col("rows").alias("expected")), "scrape_month", "full")
    else:
        seen = seen.withColumn("expected", F.col("rows"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    wrong = (F.col("planned").isNull() | (zero("no_key") > 0) | (zero("misplaced") > 0) | (zero("rows") != zero("expected")))
    seen = materialize(seen.withColumn("wrong", wrong), "audit")       # one row a month
    bad = seen.where("wrong").limit(5).collect()
    if bad:
        raise AuditError(f"{kind}: {'; '.join(str(r.asDict()) for r in bad)}")
    return seen.select("scrape_month", F.lit(kind).alias("kind"), zero("rows").cast("long").alias("rows"))


def read_staged(spark: SparkSession, root: str, kind: str, version: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(_with_text(schema, "scrape_month")).parquet(f"{root}/{kind}/version={version}")


def _with_text(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names] + [T.StructField(n, T.StringType()) for n in names])


def read_months(spark: SparkSession, root: str, kind: str, schema: T.StructType) -> DataFrame:
    """The published rows of a kind (``schema`` and scrape_month): only the
    version folders that the newest manifest names are read."""
    live = read_manifest(spark, f"{root}/_manifest").where(F.col("kind") == kind).select("scrape_month", "version")
    try:
        every = spark.read.schema(_with_text(schema, "scrape_month", "version")).parquet(f"{root}/{kind}")
    except AnalysisException as exc:   # nothing written yet
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], _with_text(schema, "scrape_month"))
    return every.join(live, ["scrape_month", "version"], "left_semi").select(*_with_text(schema, "scrape_month").names)


def write_monthly(tables: dict[str, DataFrame], root: str, keys: dict[str, str], status: str = "complete") -> DataFrame:
    """SNK-4: the months present in ``tables`` (kind to rows with a
    ``scrape_month``) replace those published before, all at once: staged,
    read back and checked, then named by a new manifest.  ``keys`` names the
    column of each kind that must not be null.  Returns the rows per month and kind."""
    root, version = root.rstrip("/"), new_version()
    for kind, rows in tables.items():
        stage_months(rows, root, kind, version)
    counts = None
    for kind, rows in tables.items():
        staged = read_staged(rows.sparkSession, root, kind, version, rows.schema)
        found = audit_months(staged, kind, staged, keys[kind])
        counts = found if counts is None else counts.unionByName(found)
    entries = counts.withColumns({"status": F.lit(status), "last_date": F.lit(None).cast("timestamp"), "version": F.lit(version)})
    write_checkpoint(entries, f"{root}/_manifest")
    return counts


def write_url_list(urls: DataFrame, path: str, col: str = "url") -> None:
    """SNK-5: one URL per line."""
    urls.select(F.col(col).alias("value")).write.mode("overwrite").text(path)


def write_checkpoint(manifest: DataFrame, path: str) -> None:
    """SNK-7: publish manifest rows (scrape_month, kind, rows, status,
    last_date, version) by one new snapshot: the rows given replace those of
    their month and kind, all others stay.  A snapshot is one file that a
    rename puts in place, so readers see the old one or the new one.  One
    job publishes to a path at a time."""
    spark = manifest.sparkSession
    if "version" not in manifest.columns:
        manifest = manifest.withColumn("version", F.lit(None))
    new = manifest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PUBLISHED.fields])
    last = _snapshots(spark, path).agg(F.max("snapshot")).first()[0]
    kept = read_manifest(spark, path).join(new.select("scrape_month", "kind"), ["scrape_month", "kind"], "left_anti")
    number = int(last.split("-")[0]) + 1 if last else 1
    (kept.select(*new.columns).unionByName(new).coalesce(1)      # one row a month and kind
     .write.parquet(f"{path}/snapshot={number:08d}-{uuid.uuid4().hex[:8]}"))


def _snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every manifest row with its snapshot (a path that is not there has none)."""
    schema = T.StructType(schemas.PUBLISHED.fields + [T.StructField("snapshot", T.StringType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:  # a first run has no manifest yet
        if "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot's rows; its name is a scalar subquery, so only its file is read."""
    every = _snapshots(spark, path)
    return every.where(F.col("snapshot") == every.agg(F.max("snapshot")).scalar()).drop("snapshot")


def write_last_date(last: DataFrame, path: str, col: str = "last_date") -> None:
    """SNK-7, single-date form: one JSON line with the date as ISO text (no
    fraction where there is none), the form ``read_checkpoint`` reads."""
    ts = F.col(col).cast("timestamp")
    iso = F.when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    (last.select(F.to_json(F.struct(iso.alias("last_date"))).alias("value")).coalesce(1)
     .write.mode("overwrite").text(path))
