"""Calendar and period logic: month plans, windows, month assignment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Trailing windows of the listing periods.
PERIODS = {"day": "1 DAY", "week": "7 DAYS", "month": "1 MONTH", "year": "1 YEAR"}


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp")


def plan_months(spark: SparkSession, start, end) -> DataFrame:
    """SRC-6: every month start from start's month through end, with the
    half-open bounds and the ``YYYY-MM`` tag.  ``start``/``end`` may be
    literals or Columns of a one-row DataFrame built by the caller."""
    return spark.range(1).select(
        F.explode(F.sequence(F.date_trunc("MONTH", _ts(start)), _ts(end),
                             F.expr("INTERVAL 1 MONTH"))).alias("month_start")
    ).select(
        "month_start",
        (F.col("month_start") + F.expr("INTERVAL 1 MONTH")).alias("month_end"),
        F.date_format("month_start", "yyyy-MM").alias("scrape_month"),
    )


def plan_months_for(df: DataFrame, ts: str) -> DataFrame:
    """SRC-6 over the range a table actually covers (min..max of ``ts``):
    one aggregate, then the month sequence."""
    bounds = df.agg(F.min(ts).cast("timestamp").alias("s"), F.max(ts).cast("timestamp").alias("e"))
    return bounds.select(
        F.explode(F.sequence(F.date_trunc("MONTH", "s"), F.col("e"), F.expr("INTERVAL 1 MONTH")))
        .alias("month_start")
    ).select(
        "month_start",
        (F.col("month_start") + F.expr("INTERVAL 1 MONTH")).alias("month_end"),
        F.date_format("month_start", "yyyy-MM").alias("scrape_month"),
    )


def last_n_months(spark: SparkSession, as_of, n: int) -> DataFrame:
    """SRC-6: the ``n`` newest month starts up to ``as_of``, as plan_months."""
    end = _ts(as_of)
    start = F.add_months(F.date_trunc("MONTH", end).cast("date"), 1 - n).cast("timestamp")
    return plan_months(spark, start, end)


def years_back(as_of: dt.datetime, years: int) -> dt.datetime:
    """The start of a backfill: ``years`` times 365 days before ``as_of``."""
    return as_of - dt.timedelta(days=365 * years)


def month_window(df: DataFrame, ts: str, start, end=None, bounds: str = "calendar") -> DataFrame:
    """FLT-1: rows whose time lies in the month of ``start``, capped at ``end``.

    ``calendar``: [first of month 00:00, first of next month), default.
    ``inclusive_last_day``: [1st at start's time of day, last day at that
    time], both ends inclusive (deviation D1 reproduced).
    """
    t = F.col(ts).cast("timestamp")
    s = _ts(start)
    if bounds == "calendar":
        lo = F.date_trunc("MONTH", s)
        cond = (t >= lo) & (t < lo + F.expr("INTERVAL 1 MONTH"))
    elif bounds == "inclusive_last_day":
        tod = s - F.date_trunc("DAY", s)
        lo = F.date_trunc("MONTH", s) + tod
        hi = F.date_trunc("MONTH", s) + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 DAY") + tod
        cond = (t >= lo) & (t <= hi)
    else:
        raise ValueError(f"unknown bounds {bounds!r}")
    if end is not None:
        cond = cond & (t <= _ts(end))
    return df.where(cond)


def epoch_range(df: DataFrame, epoch: str, lo=None, hi=None, lo_inclusive: bool = True) -> DataFrame:
    """The same time bounds as a filter on a stored epoch-seconds column,
    so a Parquet scan can skip row groups (a filter on a derived timestamp
    cannot be pushed down)."""
    cond = F.lit(True)
    if lo is not None:
        lo_s = F.unix_seconds(_ts(lo))
        cond = cond & ((F.col(epoch) >= lo_s) if lo_inclusive else (F.col(epoch) > lo_s))
    if hi is not None:
        cond = cond & (F.col(epoch) <= F.unix_seconds(_ts(hi)))
    return df.where(cond)


def period_start(period: str, as_of) -> Column | None:
    if period == "all":
        return None
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    return _ts(as_of) - F.expr(f"INTERVAL {PERIODS[period]}")


def listing_period(df: DataFrame, ts: str, period: str, as_of) -> DataFrame:
    """FLT-2: the trailing ``day/week/month/year`` window ending at the
    explicit ``as_of`` time (inclusive); ``all`` keeps everything."""
    t = F.col(ts).cast("timestamp")
    a = _ts(as_of)
    if period == "all":
        return df
    if period not in PERIODS:
        raise ValueError(f"unknown period {period!r}")
    return df.where((t > a - F.expr(f"INTERVAL {PERIODS[period]}")) & (t <= a))


def assign_month(df: DataFrame, ts: str, start, end, bounds: str = "calendar",
                 months: DataFrame | None = None, month_col: str = "scrape_month") -> DataFrame:
    """JN-1: every row matched to its month window in one pass.

    Both window modes lie inside one calendar month, so the month is a
    function of the row's own time: no range join, no shuffle.  The row is
    kept when it lies inside its month's window and inside [start, end].
    ``months`` (e.g. the pending months) restricts the result by a left-semi
    join.
    """
    t = F.col(ts).cast("timestamp")
    m = F.date_trunc("MONTH", t)
    s, e = _ts(start), _ts(end)
    if bounds == "calendar":
        inside = (t >= F.date_trunc("MONTH", s)) & (t <= e)
    elif bounds == "inclusive_last_day":
        tod = s - F.date_trunc("DAY", s)
        last = m + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 DAY") + tod
        inside = (t >= m + tod) & (t <= last) & (m >= F.date_trunc("MONTH", s)) & (t <= e)
    else:
        raise ValueError(f"unknown bounds {bounds!r}")
    out = df.where(inside).withColumn(month_col, F.date_format(m, "yyyy-MM"))
    if months is not None:
        out = out.join(months.select(month_col), month_col, "left_semi")
    return out


def pending_months(months: DataFrame, manifest: DataFrame | None = None,
                   checkpoint: DataFrame | None = None) -> DataFrame:
    """JN-2: months still to do.  A month is done when the manifest holds a
    complete entry for **both** kinds; with a checkpoint (``last_date``),
    only months after the checkpoint's month remain."""
    out = months
    if manifest is not None:
        done = (manifest.where(F.col("status") == "complete")
                .groupBy("scrape_month").agg(F.countDistinct("kind").alias("kinds"))
                .where(F.col("kinds") >= 2).select("scrape_month"))
        out = out.join(done, "scrape_month", "left_anti")
    if checkpoint is not None:
        last = checkpoint.agg(F.max("last_date")).scalar()   # scalar subquery, one value
        nxt = F.date_trunc("MONTH", last) + F.expr("INTERVAL 1 MONTH")
        out = out.where(last.isNull() | (F.col("month_start") >= nxt))
    return out
