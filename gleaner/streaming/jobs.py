"""Structured Streaming versions of the incremental behaviour: new thread
files, a growing URL set, periodic progress, a live error streak.

All file-source queries run with ``availableNow`` (process what is there,
then stop) and a checkpoint location, so a scheduler can call them as a
batch job and a restart continues where the last one committed.
"""

from __future__ import annotations

import datetime as dt
import struct
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleaner import schemas
from gleaner.functions.ranking import row_number_within
from gleaner.functions.scan import blocked_running_sum
from gleaner.operators import catalog, threads


def _batch_folder(batch: DataFrame, batch_id: int) -> str:
    """``query=<id>/batch_id=<n>``: the query's id is kept in its checkpoint,
    so a restart writes on, a replayed batch replaces its own files, and a
    query with a fresh checkpoint never overwrites another's output."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"query={query}/batch_id={batch_id}"


def ingest_threads_stream(spark: SparkSession, in_dir: str, out_root: str, ckpt: str,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """STR-1: thread files not seen yet -> posts, comments and quarantine
    (malformed lines with their reason), each batch read once and written
    under its own folder with overwrite (exactly-once files)."""
    reader = spark.readStream.schema(T.StructType(schemas.THREAD.fields + [T.StructField("_corrupt_record", T.StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(in_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = _batch_folder(batch, batch_id)
        batch.persist()
        try:
            good, bad = threads.split_malformed(batch)
            for kind, rows in (("posts", threads.project_posts(good)), ("comments", threads.flatten_comments(good)),
                               ("quarantine", bad.select("id", "reason", F.col("_corrupt_record").alias("raw")))):
                rows.write.mode("overwrite").parquet(f"{out_root}/{kind}/{folder}")
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def distinct_urls_stream(links: DataFrame, col: str = "url", watermark: tuple[str, str] | None = None) -> DataFrame:
    """STR-2: the URL set as it grows.  Without a watermark the seen-set
    lives in state forever; with ``(event_time_col, delay)`` duplicates are
    only removed within the delay and state stays bounded."""
    if watermark is None:
        return links.dropDuplicates([col])
    ts, delay = watermark
    return links.withWatermark(ts, delay).dropDuplicatesWithinWatermark([col])


def interim_reviews_stream(spark: SparkSession, pages_dir: str, out_root: str, ckpt: str, every: int = 5,
                           files_per_batch: int | None = 4, schema: T.StructType = schemas.PAGES) -> StreamingQuery:
    """STR-3 / SNK-6: product pages in micro-batches of ``files_per_batch``
    files (None: all that are new); each batch appends its reviews, an interim row after every
    ``every``-th product of the whole run (in list order; a product without
    reviews skips its save, D19), and its totals, which the next batch goes
    on from.  The cumulative table is the reviews folder read at any time."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(pages_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = _batch_folder(batch, batch_id)
        query = folder.split("/")[0]
        parsed = catalog.parse_product_json(catalog.extract_structured_data(batch)).persist()
        try:
            catalog.explode_reviews(parsed).write.mode("overwrite").parquet(f"{out_root}/reviews/{folder}")
            products, rows = _previous_totals(spark, out_root, query, batch_id)
            narrow = parsed.select("page_id", F.when(F.col("parse_ok"), F.size("product.review")).otherwise(0).cast("long").alias("n"))
            placed = row_number_within(narrow, [], ["page_id"], out="at").withColumn("product_no", F.col("at") + products)
            run = blocked_running_sum(placed, "n", "at", out="rows")
            (run.where((F.col("product_no") % every == 0) & (F.col("n") > 0))
             .select((F.col("product_no") / every).cast("long").alias("snapshot_no"), "product_no",
                     (F.col("rows") + rows).cast("long").alias("rows_so_far"))
             .write.mode("overwrite").parquet(f"{out_root}/interim/{folder}"))
            (narrow.agg((F.count(F.lit(1)) + products).alias("products_so_far"),
                        (F.coalesce(F.sum("n"), F.lit(0)) + rows).alias("rows_so_far"))
             .write.mode("overwrite").parquet(f"{out_root}/progress/{folder}"))
        finally:
            parsed.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def _previous_totals(spark: SparkSession, out_root: str, query: str, batch_id: int) -> tuple[int, int]:
    """Products and review rows after the previous batch (batch ids are
    consecutive; a replayed batch reads the same row, so it writes the same)."""
    if batch_id == 0:
        return 0, 0
    row = (spark.read.schema("products_so_far long, rows_so_far long")
           .parquet(f"{out_root}/progress/{query}/batch_id={batch_id - 1}").first())
    return (row["products_so_far"], row["rows_so_far"]) if row else (0, 0)


def interim_progress(spark: SparkSession, out_root: str) -> DataFrame:
    """The interim saves so far: snapshot_no, product_no, rows_so_far."""
    return spark.read.parquet(f"{out_root}/interim").select("snapshot_no", "product_no", "rows_so_far")


STREAK_OUT = T.StructType([
    T.StructField("crawl_id", T.LongType()),
    T.StructField("attempt_seq", T.LongType()),
    T.StructField("attempt_ts", T.TimestampType()),
    T.StructField("streak", T.LongType()),
])
# What waits for the watermark: attempts packed as place (microseconds, number) and flags, many to one element.
_ATTEMPT = struct.Struct("<qqB")
_ERROR, _RESET = 2, 1
_WAITING = T.StructType([T.StructField("attempts", T.BinaryType())])
_PACKED = 10_000         # attempts of one element
_COUNTED = T.StructType([T.StructField("streak", T.LongType()), T.StructField("stopped", T.BooleanType()),
                         T.StructField("at", T.LongType()), T.StructField("seq", T.LongType())])
_NO_TIME = -1 << 63      # the place of an attempt without a time: before all others
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class ErrorStreak(StatefulProcessor):
    """One crawl's attempts in order of their place, however they arrive: they
    wait in a list until the watermark has passed them, a timer then counts
    what is due.  A crawl without attempts for ``idle_ms`` of event time
    leaves no state.

    Each call to the state costs a round trip, whatever it carries, so a
    crawl's attempts of a batch go as one packed element and nothing is asked
    for twice; rows come and go as rows, with no frame built for each crawl.
    Of a task's crawls only the keys with a timer in the batch are kept."""

    def __init__(self, n: int, idle_ms: int):
        self.n, self.idle_ms = n, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.counted = handle.getValueState("counted", _COUNTED)
        self.looked = set()      # crawls of this task whose timer has run in this batch

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, attempts = None, (tuple(r[2:]) for r in rows)      # at, attempt_seq, flags
        while some := list(islice(attempts, _PACKED)):
            self.waiting.appendValue((b"".join(_ATTEMPT.pack(*a) for a in some),))
            first = min(some)[0] if first is None else min(first, min(some)[0])
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if key in self.looked:      # a second timer of one batch: what is due was counted at the first
            return iter(())
        self.looked.add(key)
        now = timerValues.getCurrentWatermarkInMs()
        rows = sorted(a for (packed,) in self.waiting.get() for a in _ATTEMPT.iter_unpack(packed))
        due = bisect_right(rows, now * 1000, key=lambda a: a[0])
        counted, hit = self.counted.get(), None
        if due:
            counted, hit = self._count(counted, rows[:due])
        if due < len(rows):
            if due:
                self.waiting.put([(b"".join(_ATTEMPT.pack(*a) for a in rows[k:k + _PACKED]),) for k in range(due, len(rows), _PACKED)])
            self.handle.registerTimer(-(-rows[due][0] // 1000))
        elif due:
            self.waiting.clear()
        gone = due == len(rows) and counted is not None and counted[2] // 1000 + self.idle_ms <= now
        if gone:
            self.counted.clear()
        elif due:
            self.counted.update(counted)
            if due == len(rows):
                self.handle.registerTimer(counted[2] // 1000 + self.idle_ms)
        if hit is None:
            return iter(())
        ts = None if hit[0] == _NO_TIME else _EPOCH + dt.timedelta(microseconds=hit[0])
        return iter([Row(crawl_id=key[0], attempt_seq=hit[1], attempt_ts=ts, streak=self.n)])

    def _count(self, counted: tuple | None, due: list[tuple]) -> tuple[tuple, tuple | None]:
        """``counted`` after the attempts ``due``, and the one that reaches n, if any."""
        streak, stopped, *last = counted or (0, False)
        last, hit = tuple(last), None
        for at, seq, flags in due:
            if (at, seq) == last:      # a repeated attempt counts once
                continue
            last = (at, seq)
            if flags & _RESET:
                streak = 0
            if flags & _ERROR and not stopped:
                streak += 1
                if streak == self.n:
                    stopped, hit = True, last
        return (streak, stopped, *last), hit

    def close(self) -> None:
        pass


def error_streak_stream(log: DataFrame, key: str = "crawl_id", n: int = 5, delay: str = "0 seconds",
                        idle: dt.timedelta = dt.timedelta(days=90)) -> DataFrame:
    """STR-4: live consecutive-error counter per crawl; emits the attempt at
    which a crawl reaches ``n`` errors in a row (then stops counting).

    Attempts may come in any order and up to ``delay`` (event time) late: they
    are counted in the order of (attempt_ts, attempt_seq) once the watermark
    has passed them, so the result is that of the batch operator; what comes
    later still is dropped by the watermark.  (No delay: attempts of one
    trigger in any order, none from before the last trigger.)  State is the attempts that wait
    and one small record a crawl, which a timer removes after ``idle`` without
    attempts (a crawl that goes on after that is counted anew).  The last
    ``delay`` of a log is decided when a later attempt of any crawl moves the
    watermark.  Needs the RocksDB state store (set by ``configure``)."""
    flag = lambda c, bit: F.when(F.coalesce(F.col(c), F.lit(False)), bit).otherwise(0)
    at = F.coalesce(F.unix_micros(F.col("attempt_ts")), F.lit(_NO_TIME))
    narrow = log.select(F.col(key).cast("long").alias(key), "attempt_ts", at.alias("at"),
                        F.col("attempt_seq").cast("long").alias("attempt_seq"), (flag("is_error", _ERROR) + flag("resets", _RESET)).alias("flags"))
    return (narrow.withWatermark("attempt_ts", delay).groupBy(key)
            .transformWithState(ErrorStreak(n, int(idle.total_seconds() * 1000)), STREAK_OUT, "Append", "EventTime"))
