"""Thread operators on literal frames: the reference's six collector cases,
made real, plus the period and month logic."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.operators import periods, threads
from gleaner.plans import flows

E0 = 1609459200  # 2021-01-01 00:00:00 UTC


def thread_rows():
    return [
        {"id": "post1", "community": None, "title": "Test Post", "body": "Test body", "score": 100,
         "created_epoch": E0, "num_comments": 2, "comment_page": 0,
         "comments": [
             {"id": "c1", "body": "Comment 1", "score": 10, "created_epoch": E0 + 60, "author": "user1"},
             {"id": "c2", "body": "Comment 2", "score": 5, "created_epoch": E0 + 120, "author": None},
         ]},
    ]


def threads_df(spark, rows=None):
    return spark.createDataFrame(thread_rows() if rows is None else rows, schemas.THREAD)


def test_single_thread_success(spark):
    t = threads_df(spark)
    posts = threads.project_posts(t).collect()
    comments = threads.flatten_comments(t).orderBy("comment_id").collect()
    assert len(posts) == 1 and posts[0]["id"] == "post1" and posts[0]["title"] == "Test Post"
    assert posts[0]["score"] == 100
    assert posts[0]["created_utc"] == dt.datetime(2021, 1, 1)
    assert [c["comment_id"] for c in comments] == ["c1", "c2"]
    assert {c["post_id"] for c in comments} == {"post1"}
    assert comments[0]["body"] == "Comment 1"


def test_empty_listing_keeps_schema(spark):
    t = threads_df(spark, [])
    posts, comments = threads.project_posts(t), threads.flatten_comments(t)
    assert posts.count() == 0 and comments.count() == 0
    assert posts.columns[:6] == threads.POST_COLUMNS
    assert comments.columns[:6] == threads.COMMENT_COLUMNS


def test_thread_without_comments_gives_post_only(spark):
    rows = thread_rows()
    rows[0]["comments"] = []
    rows[0]["num_comments"] = 0
    t = threads_df(spark, rows)
    assert threads.project_posts(t).count() == 1
    assert threads.flatten_comments(t).count() == 0


def test_missing_author_null_or_compat_text(spark):
    t = threads_df(spark)
    plain = {r["comment_id"]: r["author"] for r in threads.flatten_comments(t).collect()}
    compat = {r["comment_id"]: r["author"] for r in threads.flatten_comments(t, compat_author=True).collect()}
    assert plain["c2"] is None and compat["c2"] == "None"   # D4


def test_multi_community_union_tags_and_keeps_order(spark):
    a = spark.createDataFrame([("p1", "Post 1", 1)], "id string, title string, score long")
    b = spark.createDataFrame([("p2", "Post 2", 2)], "id string, title string, score long")
    out = threads.union_communities([threads.tag_source(a, "sub1"), threads.tag_source(b, "sub2")]).collect()
    assert [(r["id"], r["community"]) for r in out] == [("p1", "sub1"), ("p2", "sub2")]


def test_failing_source_is_isolated(spark):
    """A malformed archive line is set aside; the good source's rows remain."""
    import json
    import tempfile
    good = {"id": "p_ok", "community": "sub2", "title": "t", "body": "b", "score": 1, "created_epoch": E0,
            "num_comments": 1, "comment_page": 0,
            "comments": [{"id": "c_ok", "body": "x", "score": 1, "created_epoch": E0, "author": "a"}]}
    d = tempfile.mkdtemp(dir="/tmp")
    with open(f"{d}/part.json", "w") as fh:
        fh.write('{"id": "p_bad", "community": "sub1", "score": \n')
        fh.write(json.dumps(good) + "\n")
    from gleaner.sources.readers import read_threads
    t = read_threads(spark, d)
    posts, comments = flows.collect_communities(t, ["sub1", "sub2"], "all", 100, dt.datetime(2030, 1, 1))
    assert [r["id"] for r in posts.collect()] == ["p_ok"]
    assert [r["comment_id"] for r in comments.collect()] == ["c_ok"]


def test_comment_pages_reassemble(spark):
    """A thread split over comment pages has one post row and all comments."""
    rows = thread_rows()
    extra = dict(rows[0], comment_page=1, comments=[
        {"id": "c3", "body": "Comment 3", "score": 1, "created_epoch": E0 + 180, "author": "u"}])
    t = threads_df(spark, rows + [extra])
    assert threads.project_posts(t).count() == 1
    assert threads.flatten_comments(t).count() == 3


def test_top_posts_per_group_with_ties(spark):
    df = spark.createDataFrame([("a", "x", 5), ("b", "x", 5), ("c", "x", 1), ("d", "y", 9)],
                               "id string, community string, score long")
    out = sorted((r["community"], r["id"]) for r in threads.top_posts(df, "community", 2).collect())
    assert out == [("x", "a"), ("x", "b"), ("y", "d")]


def test_top_posts_plans_partial_group_limit(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("community"),
                                  F.col("id").alias("score"))
    plan = threads.top_posts(df, "community", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def ts_df(spark, values):
    return spark.createDataFrame([(dt.datetime.fromisoformat(v),) for v in values], "t timestamp")


def test_month_window_calendar_vs_inclusive_last_day(spark):
    df = ts_df(spark, ["2024-03-01 00:00:00", "2024-03-01 06:00:00", "2024-03-31 06:00:00",
                       "2024-03-31 07:00:00", "2024-04-01 00:00:00"])
    cal = [r["t"].isoformat(" ") for r in periods.month_window(df, "t", "2024-03-15 06:00:00").collect()]
    compat = [r["t"].isoformat(" ") for r in
              periods.month_window(df, "t", "2024-03-01 06:00:00", bounds="inclusive_last_day").collect()]
    assert cal == ["2024-03-01 00:00:00", "2024-03-01 06:00:00", "2024-03-31 06:00:00", "2024-03-31 07:00:00"]
    # D1: the reference's window starts and ends at the run's time of day.
    assert compat == ["2024-03-01 06:00:00", "2024-03-31 06:00:00"]


def test_month_window_capped_at_end(spark):
    df = ts_df(spark, ["2024-03-02 00:00:00", "2024-03-20 00:00:00"])
    out = periods.month_window(df, "t", "2024-03-01", end="2024-03-10").count()
    assert out == 1


def test_assign_month_has_no_join(spark):
    df = ts_df(spark, ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-05-01 00:00:00"])
    out = periods.assign_month(df, "t", "2024-01-01", "2024-03-31 23:59:59")
    assert [r["scrape_month"] for r in out.orderBy("t").collect()] == ["2024-01", "2024-02"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_listing_period_trailing_window(spark):
    df = ts_df(spark, ["2024-03-09 12:00:00", "2024-03-10 00:00:01", "2024-03-11 00:00:00", "2024-03-11 00:00:01"])
    out = periods.listing_period(df, "t", "day", "2024-03-11 00:00:00").count()
    assert out == 2
    assert periods.listing_period(df, "t", "all", "2024-03-11 00:00:00").count() == 4     # no bound at all
    with pytest.raises(ValueError):
        periods.listing_period(df, "t", "decade", "2024-03-11")


def test_plan_months_inclusive_of_end_month(spark):
    m = [r["scrape_month"] for r in periods.plan_months(spark, "2023-11-15 08:00:00", "2024-02-01").collect()]
    assert m == ["2023-11", "2023-12", "2024-01", "2024-02"]


def test_pending_months_needs_both_kinds_and_respects_checkpoint(spark):
    months = periods.plan_months(spark, "2024-01-01", "2024-04-01")
    manifest = spark.createDataFrame(
        [("2024-01", "posts", 1, "complete", None), ("2024-01", "comments", 1, "complete", None),
         ("2024-02", "posts", 1, "complete", None), ("2024-03", "posts", 1, "open", None),
         ("2024-03", "comments", 1, "open", None)], schemas.MANIFEST)
    pend = [r["scrape_month"] for r in periods.pending_months(months, manifest).orderBy("month_start").collect()]
    assert pend == ["2024-02", "2024-03", "2024-04"]   # D6: an open month is redone
    ck = spark.createDataFrame([(dt.datetime(2024, 2, 10),)], "last_date timestamp")
    pend2 = [r["scrape_month"] for r in periods.pending_months(months, None, ck).orderBy("month_start").collect()]
    assert pend2 == ["2024-03", "2024-04"]


def test_backfill_summary_counts_rows_not_frames(spark):
    p = spark.createDataFrame([("2024-01",), ("2024-01",), ("2024-02",)], "scrape_month string")
    c = spark.createDataFrame([("2024-02",)], "scrape_month string")
    out = {r["scrape_month"]: (r["posts"], r["comments"], r["is_total"])
           for r in threads.backfill_summary(p, c).collect()}
    assert out == {"2024-01": (2, 0, False), "2024-02": (1, 1, False), None: (3, 1, True)}   # D9


def test_period_and_community_filters_reach_the_parquet_scan(spark):
    from gleaner.session import scratch_dir
    from gleaner.sources import fixtures as fx
    from gleaner.sources.readers import read_threads
    path = scratch_dir(spark, "t-archive")
    fx.thread_archive(spark, "/root/testdata/sf0.001").write.parquet(path)
    t = read_threads(spark, path, fmt="parquet")
    posts, comments = flows.collect_communities(t, ["1-URGENT"], "year", 10, dt.datetime(1998, 8, 2))
    for df in (posts, comments):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
        assert pushed and all("created_epoch" in line and "community" in line for line in pushed), plan


def test_entry_registers_without_the_training_data_part(tmp_path):
    """Where that part or what it needs cannot be imported, the rest still is."""
    import os
    import subprocess
    import sys
    (tmp_path / "public_tokenizers.py").write_text("raise ModuleNotFoundError('public_tokenizers')")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(k for k in q if k.startswith('op') or k == 'pipeline'), set(e.oracle_sql()) == set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"},
                         capture_output=True, text=True, check=True).stdout
    assert out.endswith("[] True\n")
