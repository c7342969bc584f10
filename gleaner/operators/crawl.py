"""Fetch attempts as a table: classify, outcome per URL, error cut-off,
progress snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.scan import blocked_running_sum

# HTTP statuses the review collector retries.
RETRY_CODES = (403, 429, 503)
# The older notebook collector retries 403 only.
RETRY_CODES_NARROW = (403,)


def classify_fetch(attempts: DataFrame, retry_codes=RETRY_CODES, status: str = "status") -> DataFrame:
    """FLT-6: ``ok`` (2xx), ``retryable`` (one of ``retry_codes``) or ``error``."""
    s = F.col(status)
    return attempts.withColumn(
        "fetch_class",
        F.when(s.between(200, 299), "ok").when(s.isin(*retry_codes), "retryable").otherwise("error"))


def attempt_flags(attempts: DataFrame, status: str = "status", found: str = "n_results") -> DataFrame:
    """``is_error`` and ``resets`` of each attempt, as FLT-8 takes them: an
    attempt that did not load, timeouts without a status included, is an
    error; one that loaded and found something resets the count."""
    ok = F.coalesce(F.col(status).between(200, 299), F.lit(False))
    return attempts.withColumns({"is_error": ~ok, "resets": ok & F.coalesce(F.col(found) > 0, F.lit(False))})


def fetch_outcome(attempts: DataFrame, key: str = "url", order=("attempt_ts", "attempt_seq"),
                  max_attempts: int = 3, retry_all_errors: bool = True,
                  retry_codes=RETRY_CODES_NARROW) -> DataFrame:
    """WIN-2: per URL the first success within ``max_attempts`` attempts.

    Main collector: every failed attempt is retried.  Notebook collector
    (``retry_all_errors=False``): only ``retry_codes`` are retried, any
    other error ends the URL.  Only the first ``max_attempts`` attempts of a
    URL matter, so a top-k (planned as a partial WindowGroupLimit before
    the shuffle) keeps a hot URL from moving all its attempts."""
    w = Window.partitionBy(key).orderBy(*order)
    first = (attempts.withColumn("_n", F.row_number().over(w))
             .where(F.col("_n") <= max_attempts))
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(False))     # no status: a failed attempt
    fatal = F.lit(False) if retry_all_errors else (~ok & ~F.coalesce(F.col("status").isin(*retry_codes), F.lit(False)))
    agg = first.groupBy(key).agg(
        F.min(F.when(ok, F.col("_n"))).alias("_ok"),
        F.min(F.when(fatal, F.col("_n"))).alias("_fatal"),
        F.count(F.lit(1)).alias("_tried"),
    )
    success = F.col("_ok").isNotNull() & (F.col("_fatal").isNull() | (F.col("_ok") < F.col("_fatal")))
    return agg.select(
        key,
        F.when(success, "ok").otherwise("failed").alias("outcome"),
        F.coalesce(F.least("_ok", "_fatal"), F.col("_tried")).cast("long").alias("attempts_used"),
    )


def error_cutoff(log: DataFrame, key: str | None = "crawl_id", order=("attempt_ts", "attempt_seq"), n: int = 5,
                 is_error: str = "is_error", resets: str = "resets", block: int = 100_000) -> DataFrame:
    """FLT-8: keep a crawl's attempts up to and including its ``n``-th
    consecutive error.  Errors count up; an attempt that found results
    resets the count; other attempts leave it unchanged.  A null flag is
    false (set the flags so that an attempt without a status is an error).

    A segmented scan: the flags are range-partitioned and sorted by crawl and
    order, and every run of at most ``block`` attempts of one crawl becomes
    one record (see ``streak_records``).  Records merge: a window over them,
    in order, gives the errors that each inherits, and with those a record
    tells where the ``n``-th error lies.  The log itself is shuffled at most
    once more, to meet its crawl's cut-off.  No task holds a whole crawl.
    Without a ``key`` the log is one crawl, whose cut-off is a scalar subquery."""
    order = list(order)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    flags = log.select((F.lit(1) if key is None else F.col(key)).alias("_key"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                       flag(is_error).alias("_error"), flag(resets).alias("_resets"))
    places = [f"_o{i}" for i in range(len(order))]
    parts = max(int(log.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = flags.repartitionByRange(parts, "_key", *places).sortWithinPartitions("_key", *places)
    place = T.StructType([flags.schema[c] for c in places])
    schema = T.StructType([flags.schema["_key"], T.StructField("first", place), T.StructField("head", T.ArrayType(place)),
                           T.StructField("errors", T.LongType()), T.StructField("reset", T.BooleanType()),
                           T.StructField("tail", T.LongType()), T.StructField("hit", place)])
    records = ranged.mapInArrow(streak_records(n, block, places), schema)

    earlier = Window.partitionBy("_key").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("_key").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(F.when(F.col("reset"), F.col(c)), ignorenulls=True).over(earlier)
    before = F.coalesce(F.sum("errors").over(earlier), F.lit(0))
    carry = F.coalesce(last("tail") + before - last("sum"), before)
    at = F.lit(n) - F.col("carry")
    hit = F.when((at >= 1) & (at <= F.size("head")), F.get("head", (at - 1).cast("int"))).otherwise(F.col("hit"))
    cuts = (records.withColumn("sum", F.sum("errors").over(up_to)).withColumn("carry", carry)
            .groupBy("_key").agg(F.min(hit).alias("_cut")).where(F.col("_cut").isNotNull()))
    here = F.struct(*[F.col(o).alias(p) for o, p in zip(order, places)])
    if key is None:   # no cut-off: the comparison is null
        return log.where(F.coalesce(here <= cuts.agg(F.min("_cut")).scalar(), F.lit(True)))
    return (log.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
            .where(F.col("_cut").isNull() | (here <= F.col("_cut"))).select(*log.columns))


def streak_records(n: int, block: int, places: list[str]):
    """One record for each run of at most ``block`` rows of a key, in order:
    the run's first place, the places of its first ``n`` errors before any
    reset, all errors before any reset, whether there is a reset, the errors
    after the last one, and where ``n`` errors follow one another after a reset."""
    def of(rows: pa.RecordBatch) -> pa.RecordBatch:
        key = rows.column(0)
        size = rows.num_rows
        codes = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        error, reset = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_error", "_resets"))
        at = pa.StructArray.from_arrays([rows.column(p) for p in places], fields=[rows.schema.field(p) for p in places])
        starts = np.concatenate([[0], np.nonzero(codes[1:] != codes[:-1])[0] + 1])
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, size)))
        total = np.cumsum(error)
        since = np.maximum.accumulate(np.where((reset == 1) | np.isin(np.arange(size), starts), np.arange(size), 0))
        streak = total - total[since] + error[since]              # errors since the run's start or last reset
        resets = np.cumsum(reset)
        headed = resets - (resets[starts] - reset[starts])[run] == 0   # before any reset of the run
        ends = np.append(starts[1:], size) - 1
        in_head = np.nonzero((error == 1) & headed & (streak <= n))[0]
        inner = np.nonzero((error == 1) & ~headed & (streak == n))[0]
        runs, first_inner = np.unique(run[inner], return_index=True)
        hit = np.full(len(starts), -1)
        hit[runs] = inner[first_inner]
        reset_any = ~headed[ends]
        errors = np.bincount(run[headed], weights=error[headed], minlength=len(starts)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(run[in_head], minlength=len(starts)))])
        return pa.RecordBatch.from_arrays([
            key.take(pa.array(starts)), at.take(pa.array(starts)),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), at.take(pa.array(in_head))), pa.array(errors), pa.array(reset_any),
            pa.array(streak[ends]), at.take(pa.array(hit, mask=hit < 0))],
            names=["_key", "first", "head", "errors", "reset", "tail", "hit"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a in range(0, rows.num_rows, block):
                yield of(rows.slice(a, block))
    return records


def interim_snapshots(per_product: DataFrame, order: str = "product_no", n: str = "n_reviews",
                      every: int = 5, by: tuple = ()) -> DataFrame:
    """WIN-3: after every ``every``-th product that has reviews, the
    cumulative review rows so far (a product without reviews at a multiple
    of ``every`` skips that save, D19).  ``order`` is the 1-based product
    position; the running sum is blocked so no task holds a whole crawl."""
    run = blocked_running_sum(per_product, n, order, by=list(by), out="rows_so_far")
    return (run.where((F.col(order) % every == 0) & (F.col(n) > 0))
            .select(*by, (F.col(order) / every).cast("long").alias("snapshot_no"),
                    F.col(order).alias("product_no"), F.col("rows_so_far").cast("long").alias("rows_so_far")))
