"""Skew-safe building blocks against plain per-group windows / brute force."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.functions.ranking import row_number_within
from gleaner.functions.scan import blocked_running_sum
from gleaner.operators import crawl


def test_row_number_within_hot_group_spans_partitions(spark):
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot"))                     # 80 % of rows in one group
         .when(F.col("id") % 10 == 8, F.lit(None).cast("string"))
         .otherwise((F.col("id") % 37).cast("string")).alias("g"),
        ((F.col("id") * 7919) % n).alias("o"),
        F.col("id"))
    got = row_number_within(df, ["g"], ["o"], out="pos", partitions=8)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    # the hot group is not one task: its rows lie in several ranges
    spread = df.repartitionByRange(8, "g", "o").where("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread >= 5


def test_row_number_within_groups_cover_whole_partitions(spark):
    df = spark.range(3000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    got = row_number_within(df, ["g"], ["o"], out="pos", partitions=12)
    assert sorted((r["o"], r["pos"]) for r in got.collect()) == [(i, i + 1) for i in range(3000)]


def _brute(rows, n):
    cut = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        streak = 0
        for r in sorted(rs, key=lambda r: (r[1], r[2])):
            if r[4]:
                streak = 0
            if r[3]:
                streak += 1
                if streak == n:
                    cut[k] = r[2]
                    break
    return sorted((r[0], r[2]) for r in rows if r[0] not in cut or r[2] <= cut[r[0]])


def test_error_cutoff_blocked_equals_brute_force(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for k in range(6):
        length = 400 if k == 0 else rnd.randint(0, 60)          # crawl 0 is hot
        p_err = 0.75 if k % 2 else 0.55
        for i in range(length):
            e = rnd.random() < p_err
            r = (not e) and rnd.random() < 0.3
            rows.append((k, t0 + dt.timedelta(seconds=i), i + 1, e, r))
    df = spark.createDataFrame(rows, "crawl_id long, attempt_ts timestamp, attempt_seq long, is_error boolean, "
                                     "resets boolean")
    for n in (2, 5, 9):
        got = sorted((r["crawl_id"], r["attempt_seq"]) for r in crawl.error_cutoff(df, n=n, block=7).collect())
        assert got == _brute(rows, n), n


def test_timeouts_without_a_status_are_errors(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(seconds=i), i, None, 0) for i in range(8)]
    log = spark.createDataFrame(rows, "crawl_id long, attempt_ts timestamp, attempt_seq long, status int, n_results long")
    kept = crawl.error_cutoff(crawl.attempt_flags(log), n=5)
    assert sorted(r["attempt_seq"] for r in kept.collect()) == [0, 1, 2, 3, 4]
    flags = crawl.attempt_flags(log).first()
    assert flags["is_error"] and not flags["resets"]
    out = crawl.fetch_outcome(log.withColumn("url", F.lit("u")), retry_all_errors=False).first()
    assert (out["outcome"], out["attempts_used"]) == ("failed", 1)


def test_running_sum_with_more_keys_than_a_block(spark):
    """Six keys with blocks of three, and a key longer than block ** 2."""
    rows = [(k, i + 1, k + i) for k in range(6) for i in range(40 if k == 0 else 5)]
    df = spark.createDataFrame(rows, "k int, pos long, v long")
    got = {(r["k"], r["pos"]): r["run"] for r in blocked_running_sum(df, "v", "pos", by=["k"], out="run", block=3).collect()}
    for k in range(6):
        total = 0
        for kk, pos, v in rows:
            if kk == k:
                total += v
                assert got[(k, pos)] == total


def test_running_sum_with_very_many_keys(spark):
    df = spark.range(120_000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("pos"), F.col("id").alias("v"))
    run = blocked_running_sum(df, "v", "pos", by=["k"], out="run")
    assert run.where("run != v").count() == 0 and run.count() == 120_000
