"""Streaming equals batch; reruns converge; the forest expansion."""

import datetime as dt
import glob
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner import schemas
from gleaner.functions.ranking import row_number_within
from gleaner.operators import catalog, crawl, forest, threads
from gleaner.plans import flows, queries
from gleaner.session import scratch_dir, sorted_aggregates
from gleaner.sinks import writers
from gleaner.sources import fixtures as fx
from gleaner.sources import readers
from gleaner.streaming import jobs
from tests.conftest import SF_SMALL


def test_ingest_stream_equals_batch_and_replay_is_idempotent(spark):
    base = scratch_dir(spark, "t-ingest")
    fx.thread_archive(spark, SF_SMALL).repartition(4).write.json(f"{base}/in")
    jobs.ingest_threads_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", 1).awaitTermination()
    # A second run finds nothing new and changes nothing.
    jobs.ingest_threads_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", 1).awaitTermination()
    streamed = spark.read.parquet(f"{base}/out/comments").drop("query", "batch_id")
    batch = threads.flatten_comments(fx.thread_archive(spark, SF_SMALL))
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_error_streak_stream_equals_batch_cutoff(spark):
    base = scratch_dir(spark, "t-streak")
    log = (fx.crawl_log(spark, SF_SMALL).withColumn("is_error", F.col("status") != 200)
           .withColumn("resets", (F.col("status") == 200) & (F.col("n_results") > 0)))
    # n = 3 to get several hits on the small tables; two arrival runs.
    mid = dt.datetime(2024, 1, 15)
    for i, part in enumerate([log.where(F.col("attempt_ts") < mid), log.where(F.col("attempt_ts") >= mid)]):
        part.write.parquet(f"{base}/in/run={i}")
        stream = spark.readStream.schema(log.schema).parquet(f"{base}/in/run=*")
        (jobs.error_streak_stream(stream, n=3).writeStream.format("parquet")
         .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
         .trigger(availableNow=True).start().awaitTermination())
    got = sorted((r["crawl_id"], r["attempt_seq"]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == brute_force_cuts(log.collect(), 3)
    # and the batch operator keeps exactly the attempts up to each cut
    kept = crawl.error_cutoff(log, n=3)
    last = dict((r["crawl_id"], r["s"]) for r in
                kept.groupBy("crawl_id").agg(F.max(F.struct("attempt_ts", "attempt_seq"))["attempt_seq"]
                                             .alias("s")).collect())
    assert all(last[c] == s for c, s in got)


STREAK_LOG = "crawl_id long, attempt_ts timestamp, attempt_seq long, is_error boolean, resets boolean"


def _run_streak(spark, base, runs, **kw):
    """Each run's rows arrive in files of their own; state rows after the last."""
    for i, rows in enumerate(runs):
        spark.createDataFrame(rows, STREAK_LOG).repartition(2).write.parquet(f"{base}/in/run={i}")
        stream = spark.readStream.schema(STREAK_LOG).parquet(f"{base}/in/run=*")
        q = (jobs.error_streak_stream(stream, **kw).writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
             .option("path", f"{base}/out").trigger(availableNow=True).start())
        q.awaitTermination()
    return sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"])


def test_error_streak_stream_waits_for_late_attempts_and_forgets_idle_crawls(spark):
    """Attempts come shuffled, up to two hours late over three restarts, some
    twice; the result is the batch operator's, and nothing stays in state."""
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 3, 1)
    rows = [(c, t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 30)), i, rnd.random() < 0.6, False) for c in range(5) for i in range(120)]
    rows = [(c, t, i, e, not e and rnd.random() < 0.5) for c, t, i, e, _ in rows]
    runs = [[], [], []]
    for r in rows:
        run = min(int((r[1] - t0).total_seconds() // 36000), 2)
        runs[run if rnd.random() < 0.8 or (r[1] - t0).total_seconds() % 36000 < 28800 else min(run + 1, 2)].append(r)
    runs[1] += rnd.sample(runs[1], 20)
    for rs in runs:
        rnd.shuffle(rs)
    beat = lambda days: [(-1, t0 + dt.timedelta(days=days), 0, False, None)]
    base = scratch_dir(spark, "t-late")
    left = _run_streak(spark, base, [*runs, beat(3)], n=4, delay="2 hours", idle=dt.timedelta(days=5))
    batch = spark.createDataFrame(rows, STREAK_LOG)
    got = sorted((r["crawl_id"], r["attempt_seq"]) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == brute_force_cuts(batch.collect(), 4) and len(got) == 5
    last = crawl.error_cutoff(batch, n=4).groupBy("crawl_id").agg(F.max(F.struct("attempt_ts", "attempt_seq"))["attempt_seq"].alias("s"))
    assert sorted(tuple(r) for r in last.collect()) == got
    assert left > 0
    for i, days in enumerate((30, 60, 90)):      # heartbeats move the watermark past every idle time
        spark.createDataFrame(beat(days), STREAK_LOG).write.parquet(f"{base}/in/run=9{i}")
        q = (jobs.error_streak_stream(spark.readStream.schema(STREAK_LOG).parquet(f"{base}/in/run=*"), n=4, delay="2 hours",
                                      idle=dt.timedelta(days=5))
             .writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    names = ("counted", "waiting")
    state = {v: spark.read.format("statestore").option("path", f"{base}/ckpt").option("stateVarName", v).load() for v in names}
    assert {r["k"] for r in state["counted"].select(F.col("key.crawl_id").alias("k")).collect()} <= {-1}
    assert {r["k"] for r in state["waiting"].select(F.col("key.crawl_id").alias("k")).collect()} <= {-1}
    assert sorted((r["crawl_id"], r["attempt_seq"]) for r in spark.read.parquet(f"{base}/out").collect()) == got


def test_error_streak_stream_asks_its_state_once_a_crawl_not_once_an_attempt(spark):
    """A batch's attempts of a crawl wait as one element."""
    t0 = dt.datetime(2024, 3, 1)
    rows = [(c, t0 + dt.timedelta(minutes=i), i, i >= 60 + c, False) for c in range(3) for i in range(100)]
    base = scratch_dir(spark, "t-packed")
    _run_streak(spark, base, [rows], n=5, delay="1 day")
    waiting = spark.read.format("statestore").option("path", f"{base}/ckpt").option("stateVarName", "waiting").load()
    assert sorted(r["k"] for r in waiting.select(F.col("key.crawl_id").alias("k")).collect()) == [0, 1, 2]
    spark.createDataFrame([(-1, t0 + dt.timedelta(days=9), 0, False, None)], STREAK_LOG).write.parquet(f"{base}/in/run=1")
    stream = spark.readStream.schema(STREAK_LOG).parquet(f"{base}/in/run=*")
    (jobs.error_streak_stream(stream, n=5, delay="1 day").writeStream.format("parquet").option("checkpointLocation", f"{base}/ckpt")
     .option("path", f"{base}/out").trigger(availableNow=True).start().awaitTermination())
    got = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == [(c, 64 + c, t0 + dt.timedelta(minutes=64 + c), 5) for c in range(3)]


def brute_force_cuts(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r["crawl_id"], []).append(r)
    cuts = []
    for crawl_id, rs in by.items():
        streak = 0
        for r in sorted(rs, key=lambda r: (r["attempt_ts"], r["attempt_seq"])):
            if r["resets"]:
                streak = 0
            if r["is_error"]:
                streak += 1
                if streak == n:
                    cuts.append((crawl_id, r["attempt_seq"]))
                    break
    return sorted(cuts)


def test_backfill_rerun_converges(spark):
    root = scratch_dir(spark, "t-backfill")
    archive = fx.thread_archive(spark, SF_SMALL)
    a = flows.backfill_by_month(spark, archive, root, dt.datetime(1995, 1, 1), dt.datetime(1996, 12, 31), limit=5)
    first = sorted((repr(tuple(r)) for r in a.collect()))
    manifest = writers.read_manifest(spark, f"{root}/_manifest")
    # the range ends on 1996-12-31 00:00, so December is partial and stays open (D6)
    assert manifest.where("status = 'complete'").count() == 2 * 23
    assert [r["scrape_month"] for r in manifest.where("status = 'open'").select("scrape_month").distinct()
            .collect()] == ["1996-12"]
    b = flows.backfill_by_month(spark, archive, root, dt.datetime(1995, 1, 1), dt.datetime(1996, 12, 31), limit=5)
    assert sorted(repr(tuple(r)) for r in b.collect()) == first


def test_daily_snapshot_rerun_replaces(spark):
    root = scratch_dir(spark, "t-daily")
    archive = fx.thread_archive(spark, SF_SMALL)
    as_of = dt.datetime(1998, 8, 2)
    c1 = sorted(tuple(r) for r in flows.daily_snapshot(spark, archive, root, as_of, communities=["1-URGENT"],
                                                       period="year").collect())
    c2 = sorted(tuple(r) for r in flows.daily_snapshot(spark, archive, root, as_of, communities=["1-URGENT"],
                                                       period="year").collect())
    assert c1 == c2


def test_forest_bfs_order(spark):
    edges = spark.createDataFrame(
        [("r", None, 0), ("a", "r", 2), ("b", "r", 1), ("c", "a", 0), ("d", "b", 5), ("e", "b", 3),
         ("s", None, 0)], "id string, parent_id string, sibling_key int")
    out = {r["id"]: (r["root_id"], r["depth"], r["bfs_no"]) for r in forest.expand_comment_forest(edges).collect()}
    assert out == {"r": ("r", 0, 1), "b": ("r", 1, 2), "a": ("r", 1, 3), "e": ("r", 2, 4), "d": ("r", 2, 5),
                   "c": ("r", 2, 6), "s": ("s", 0, 1)}


def brute_forest(rows):
    ids, below = {r[0] for r in rows}, {}
    for i, parent, sib in rows:
        below.setdefault(parent if parent in ids else None, []).append((sib, i, parent))
    out = {i: (None, None, None, False) for i in ids}
    for _, root, parent in below[None]:
        level, depth, n = [root], 0, 0
        while level:
            for x in level:
                n += 1
                out[x] = (root, depth, n, x == root and parent is not None)
            level = [i for x in level for _, i, _ in sorted(below.get(x, []), key=lambda c: c[:2])]
            depth += 1
    return out


@pytest.mark.parametrize("elements", [2, 4, 32])
def test_deep_forest_equals_brute_force(spark, monkeypatch, elements):
    """Random trees of depth over 60, ties, orphans, cycles and what hangs below them."""
    monkeypatch.setattr(forest, "PATH_ELEMENTS", elements)
    rnd = random.Random(elements)
    rows = [(0, None, 0)] + [(i, max(0, i - rnd.randint(1, 5)), rnd.randint(0, 2)) for i in range(1, 250)]
    rows += [(300, None, 1), (301, 300, 1), (400, 77777, 0), (401, 400, 0), (402, 401, 3), (403, 401, 2)]
    rows += [(1000, 1001, 0), (1001, 1000, 0), (1002, 1001, 0), (1003, 1002, 0), (1004, 1004, 0)]
    edges = spark.createDataFrame(rows, "id long, parent_id long, sibling_key int").repartition(6)
    got = {r["id"]: (r["root_id"], r["depth"], r["bfs_no"], r["is_orphan"]) for r in forest.expand_comment_forest(edges).collect()}
    want = brute_forest(rows)
    assert got == want and max(w[1] or 0 for w in want.values()) > 60


def test_chain_of_20000_takes_few_rounds_and_one_plan(spark, monkeypatch):
    rounds, jump = [], forest._jump

    def counted(nodes):
        rounds.append(len(nodes._jdf.queryExecution().analyzed().toString()))
        return jump(nodes)
    monkeypatch.setattr(forest, "_jump", counted)
    chain = spark.range(20_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"), (F.col("id") % 7).alias("sibling_key"))
    out = forest.expand_comment_forest(chain)
    assert out.where("depth = id and bfs_no = id + 1 and root_id = 0 and not is_orphan").count() == 20_000
    assert len(rounds) <= 20
    assert max(rounds) < 2 * min(rounds)          # the plan does not grow with the depth


def test_forest_without_edges(spark):
    assert forest.expand_comment_forest(spark.createDataFrame([], "id long, parent_id long, sibling_key int")).collect() == []


def test_csv_round_trip_keeps_quotes_and_newlines(spark):
    path = scratch_dir(spark, "t-csv")
    df = spark.createDataFrame([(1, 'say "hi"\nnext line', "  padded  "), (2, "plain", "x,y")],
                               "id long, text string, note string")
    writers.write_csv_compat(df, path)
    back = writers.read_csv_compat(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_thread_archive_pages_large_threads(spark):
    """Force paging (3 comments per page): every post once, every comment once."""
    archive = fx.thread_archive(spark, SF_SMALL, comments_per_page=3)
    posts = threads.project_posts(archive)
    comments = threads.flatten_comments(archive)
    assert posts.count() == fx.table(spark, SF_SMALL, "orders").count()
    assert comments.count() == fx.table(spark, SF_SMALL, "lineitem").count()
    unpaged = threads.flatten_comments(fx.thread_archive(spark, SF_SMALL))
    assert sorted(comments.collect(), key=repr) == sorted(unpaged.collect(), key=repr)
    assert archive.where("comment_page > 0").count() > 0
    assert archive.where("comment_page = 0 AND num_comments > 3 AND size(comments) > 0").count() == 0


def test_run_snapshot_needs_a_post(spark):
    root = scratch_dir(spark, "t-run")
    empty = spark.createDataFrame([], "id string")
    assert not writers.write_run_snapshot({"posts": empty, "comments": empty}, root, "20240101_000000")
    one = spark.createDataFrame([("p",)], "id string")
    assert writers.write_run_snapshot({"posts": one, "comments": empty}, root, "20240101_000000")
    assert spark.read.parquet(f"{root}/comments/run=20240101_000000").count() == 0


def _thread(i, community, created, comments):
    e = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp())
    return {"id": i, "community": community, "title": "t", "body": "b", "score": 5, "created_epoch": e(created),
            "num_comments": len(comments), "comment_page": 0,
            "comments": [{"id": c, "body": "x", "score": 1, "created_epoch": e(t), "author": "a"} for c, t in comments]}


def _months_of(spark, root, kind="comments", key="comment_id"):
    return sorted((r[key], r["scrape_month"]) for r in flows.read_backfill(spark, root).where(F.col("kind") == kind).collect())


def test_backfill_comments_filtered_by_their_own_time(spark):
    """D15: a comment goes to the month of its own time, whatever the month
    of its post."""
    rows = [_thread("p1", "c", "2024-01-20", [("in", "2024-01-25"), ("late", "2024-02-02"), ("after", "2024-03-02")])]
    root = scratch_dir(spark, "t-d15")
    archive = spark.createDataFrame(rows, schemas.THREAD)
    flows.backfill_by_month(spark, archive, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 28), limit=10)
    assert _months_of(spark, root) == [("in", "2024-01"), ("late", "2024-02")]


def test_backfill_resume_leaves_finished_months_alone(spark):
    """The second run ranks posts of pending months only, and still finds a
    late comment on a post of a finished month."""
    rows = [_thread("p1", "c", "2024-01-20", [("in", "2024-01-25"), ("late", "2024-02-20")]),
            _thread("p2", "c", "2024-02-10", [("feb", "2024-02-11")])]
    root = scratch_dir(spark, "t-resume")
    archive = spark.createDataFrame(rows, schemas.THREAD)
    flows.backfill_by_month(spark, archive, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23, 59, 59))
    flows.backfill_by_month(spark, archive, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))     # January is complete now
    # a post that January would select, had January been done again
    more = spark.createDataFrame(rows + [_thread("new", "c", "2024-01-05", [])], schemas.THREAD)
    flows.resume_backfill(spark, more, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 28))
    assert _months_of(spark, root, "posts", "id") == [("p1", "2024-01"), ("p2", "2024-02")]
    assert _months_of(spark, root) == [("feb", "2024-02"), ("in", "2024-01"), ("late", "2024-02")]
    months = spark.createDataFrame([("2024-02", dt.datetime(2024, 2, 1))], "scrape_month string, month_start timestamp")
    plan = flows.pending_posts(more, [("2024-02", dt.datetime(2024, 2, 1))], months, dt.datetime(2024, 1, 1),
                               dt.datetime(2024, 2, 28), None, 10, "calendar")
    assert [r["id"] for r in plan.collect()] == ["p2"]


def test_backfill_scan_is_bounded_to_pending_months(spark):
    path = scratch_dir(spark, "t-scan")
    spark.createDataFrame([_thread("p2", "c", "2024-02-10", [])], schemas.THREAD).write.parquet(path)
    months = spark.createDataFrame([("2024-02", dt.datetime(2024, 2, 1))], "scrape_month string, month_start timestamp")
    plan = flows.pending_posts(spark.read.parquet(path), [("2024-02", dt.datetime(2024, 2, 1))], months, dt.datetime(2023, 1, 1),
                               dt.datetime(2024, 2, 28), None, 10, "calendar")._jdf.queryExecution().executedPlan().toString()
    feb = int(dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc).timestamp())
    assert f"GreaterThanOrEqual(created_epoch,{feb})" in plan


def test_backfill_month_that_became_empty_keeps_no_rows(spark):
    root = scratch_dir(spark, "t-empty")
    first = spark.createDataFrame([_thread("p1", "c", "2024-01-20", [("c1", "2024-01-25")])], schemas.THREAD)
    span = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 28))                       # January stays open
    flows.backfill_by_month(spark, first, root, *span)
    assert _months_of(spark, root) == [("c1", "2024-01")]
    flows.backfill_by_month(spark, spark.createDataFrame([], schemas.THREAD), root, *span)
    assert _months_of(spark, root) == [] and _months_of(spark, root, "posts", "id") == []


@pytest.mark.parametrize("stop", ["posts staged", "comments staged", "audited", "manifest half written"])
def test_stopped_backfill_leaves_the_old_months_whole(spark, monkeypatch, stop):
    root = scratch_dir(spark, "t-stop")
    old = [_thread("p1", "c", "2024-01-20", [("c1", "2024-01-25"), ("c2", "2024-02-02")])]
    span = (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 20))                       # February stays open
    flows.backfill_by_month(spark, spark.createDataFrame(old, schemas.THREAD), root, *span)
    before = (_months_of(spark, root), _months_of(spark, root, "posts", "id"))
    assert before == ([("c1", "2024-01"), ("c2", "2024-02")], [("p1", "2024-01")])
    new = spark.createDataFrame(old + [_thread("p2", "c", "2024-02-10", [("c3", "2024-02-11")])], schemas.THREAD)

    class Stopped(Exception):
        pass
    real = {n: getattr(writers, n) for n in ("stage_months", "audit_months", "write_checkpoint")}

    def stage(rows, root, kind, version):
        real["stage_months"](rows, root, kind, version)
        if stop.startswith(kind):
            raise Stopped

    def checkpoint(entries, path):
        if stop == "audited":
            raise Stopped
        entries.write.parquet(f"{path}/snapshot=00000099-x/_temporary/0/task_0")      # what a job killed before its commit leaves
        raise Stopped
    with monkeypatch.context() as m:
        m.setattr(writers, "stage_months", stage)
        m.setattr(writers, "write_checkpoint", checkpoint)
        with pytest.raises(Stopped):
            flows.resume_backfill(spark, new, root, *span)
    assert (_months_of(spark, root), _months_of(spark, root, "posts", "id")) == before
    flows.resume_backfill(spark, new, root, *span)
    assert _months_of(spark, root) == [("c1", "2024-01"), ("c2", "2024-02"), ("c3", "2024-02")]
    assert _months_of(spark, root, "posts", "id") == [("p1", "2024-01"), ("p2", "2024-02")]


def test_audit_refuses_what_is_not_as_planned(spark):
    months = spark.createDataFrame([("2024-01",)], "scrape_month string")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, created_utc timestamp, scrape_month string")
    good = ("a", dt.datetime(2024, 1, 5), "2024-01")
    expected = lambda n: spark.createDataFrame([("2024-01", n)], "scrape_month string, rows long")
    assert [r["rows"] for r in writers.audit_months(rows(good), "posts", months, "id", "created_utc", expected(1)).collect()] == [1]
    assert [r["rows"] for r in writers.audit_months(rows(), "posts", months, "id", "created_utc").collect()] == [0]
    for bad, n in (((None, dt.datetime(2024, 1, 5), "2024-01"), 2), (("b", dt.datetime(2024, 2, 5), "2024-01"), 2),
                   (("b", dt.datetime(2024, 2, 5), "2024-02"), 1), (good, 3)):
        with pytest.raises(writers.AuditError):
            writers.audit_months(rows(good, bad), "posts", months, "id", "created_utc", expected(n))


def test_readers_follow_the_newest_manifest_and_skip_other_versions(spark):
    root = scratch_dir(spark, "t-versions")
    rows = lambda *r: {"posts": spark.createDataFrame(list(r), "id string, scrape_month string")}
    writers.write_monthly(rows(("a", "2024-01"), ("b", "2024-02")), root, {"posts": "id"})
    writers.write_monthly(rows(("c", "2024-02")), root, {"posts": "id"})
    got = writers.read_months(spark, root, "posts", rows(("", ""))["posts"].schema)
    assert sorted(tuple(r) for r in got.collect()) == [("a", "2024-01"), ("c", "2024-02")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert spark.read.parquet(f"{root}/posts").count() == 3          # the old version is still there, unread


def test_malformed_threads_are_set_aside_with_a_reason(spark):
    base = scratch_dir(spark, "t-bad")
    good = '{"id": "p", "community": "c", "title": "t", "created_epoch": 0, "comments": []}'
    spark.createDataFrame([(good,), ('{"id": "q", "comm',), ('{"community": "c"}',)], "value string").coalesce(1).write.text(f"{base}/in")
    ok, bad = threads.split_malformed(readers.read_threads(spark, f"{base}/in"))
    assert [r["id"] for r in threads.project_posts(ok).collect()] == ["p"]
    assert sorted(r["reason"] for r in bad.select("id", "reason").collect()) == ["malformed_json", "no_id"]
    assert threads.project_posts(readers.read_threads(spark, f"{base}/in")).count() == 1
    jobs.ingest_threads_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt").awaitTermination()
    assert [r["id"] for r in spark.read.parquet(f"{base}/out/posts").collect()] == ["p"]
    assert spark.read.parquet(f"{base}/out/quarantine").count() == 2
    # a fresh checkpoint over the same output does not overwrite what is there
    jobs.ingest_threads_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt2").awaitTermination()
    assert spark.read.parquet(f"{base}/out/posts").count() == 2


def test_streak_ignores_late_attempts(spark):
    """A late attempt with an earlier place must not count twice."""
    base = scratch_dir(spark, "t-late")
    schema = "crawl_id long, attempt_ts timestamp, attempt_seq long, is_error boolean, resets boolean"
    t = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)
    runs = [[(1, t(i), i, True, False) for i in (0, 2, 3)], [(1, t(1), 1, True, False), (1, t(4), 4, True, False)],
            [(1, t(5), 5, True, False)]]
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in/run={k}")
        (jobs.error_streak_stream(spark.readStream.schema(schema).parquet(f"{base}/in/run=*"), n=5).writeStream
         .format("parquet").option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
         .trigger(availableNow=True).start().awaitTermination())
    assert [r["attempt_seq"] for r in spark.read.parquet(f"{base}/out").collect()] == [5]


def test_scratch_needs_a_shared_folder_off_local_mode():
    import types

    import pytest

    from gleaner.session import scratch_dir as scratch
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        scratch(fake)


def test_url_list_keep_blank(spark):
    from gleaner.sources.readers import url_lines
    df = spark.createDataFrame([(" a ",), ("",), ("  ",), ("b",)], "value string")
    assert sorted(r["url"] for r in url_lines(df).collect()) == ["a", "b"]
    assert sorted(r["url"] for r in url_lines(df, keep_blank=True).collect()) == ["", "", "a", "b"]


def test_distinct_urls_stream_with_watermark(spark):
    base = scratch_dir(spark, "t-wm")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("u1", t0), ("u1", t0 + dt.timedelta(minutes=1)), ("u2", t0), ("u1", t0 + dt.timedelta(days=2))]
    spark.createDataFrame(rows, "url string, seen_at timestamp").write.parquet(f"{base}/in")
    stream = spark.readStream.schema("url string, seen_at timestamp").parquet(f"{base}/in")
    (jobs.distinct_urls_stream(stream, watermark=("seen_at", "1 hour")).writeStream.format("parquet")
     .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
     .trigger(availableNow=True).start().awaitTermination())
    got = sorted(r["url"] for r in spark.read.parquet(f"{base}/out").collect())
    # within one batch duplicates are removed regardless of the delay
    assert got == ["u1", "u2"]


def _forest(spark, rows):
    df = spark.createDataFrame(rows, "id string, parent_id string, sibling_key long")
    return {r["id"]: r for r in forest.expand_comment_forest(df).collect()}


def test_forest_keeps_orphans_and_reports_cycles(spark):
    got = _forest(spark, [("r", None, 0), ("a", "r", 1), ("o", "gone", 0), ("p", "o", 0),
                          ("x", "y", 0), ("y", "x", 0), ("z", "y", 5)])
    assert len(got) == 7
    assert got["o"]["is_orphan"] and got["o"]["root_id"] == "o" and got["p"]["root_id"] == "o" and got["p"]["depth"] == 1
    assert not got["p"]["is_orphan"] and not got["r"]["is_orphan"]
    assert all(got[i]["root_id"] is None and got[i]["bfs_no"] is None for i in "xyz")


def test_forest_deep_chain_and_hot_parent(spark):
    depth = 30
    rows = [("c0", None, 0)] + [(f"c{i}", f"c{i - 1}", 0) for i in range(1, depth)]
    rows += [("h", None, 0)] + [(f"h{i}", "h", i) for i in range(3000)]
    got = _forest(spark, rows)
    assert got[f"c{depth - 1}"]["depth"] == depth - 1 and got[f"c{depth - 1}"]["bfs_no"] == depth
    assert all(got[f"h{i}"]["bfs_no"] == i + 2 for i in range(3000))


def test_read_checkpoint_missing_or_malformed(spark):
    from gleaner.sources.readers import read_checkpoint
    base = scratch_dir(spark, "t-ckpt")
    assert read_checkpoint(spark, f"{base}/nothing-here").first()["last_date"] is None
    spark.createDataFrame([('{"last_date": "garbage"}',)], "value string").write.text(f"{base}/bad")
    assert read_checkpoint(spark, f"{base}/bad").first()["last_date"] is None
    spark.createDataFrame([('{"last_date": "2024-03-31T06:00:00"}',)], "value string").write.text(f"{base}/ok")
    assert read_checkpoint(spark, f"{base}/ok").first()["last_date"] == dt.datetime(2024, 3, 31, 6, 0)


def test_csv_writes_arrays_as_json_text(spark):
    path = scratch_dir(spark, "t-csv-arr")
    df = spark.createDataFrame([("u", ["a.jpg", "b.jpg"]), ("v", [])], "url string, image_urls array<string>")
    writers.write_csv_compat(df, path)
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("image_urls", T.StringType())])
    back = writers.read_csv_compat(spark, path, schema)
    assert sorted((r["url"], r["image_urls"]) for r in back.collect()) == [("u", '["a.jpg","b.jpg"]'), ("v", "[]")]


def test_staged_view_rebuilds_when_files_vanish(spark):
    a = fx.product_pages(spark, SF_SMALL).count()
    key = next(k for k in fx._STAGED if k[2] == "product-pages" and k[1].endswith("sf0.001"))
    fx._STAGED[key] = fx._STAGED[key] + "-gone"          # as if the staged files were lost
    assert fx.product_pages(spark, SF_SMALL).count() == a
    assert not fx._STAGED[key].endswith("-gone")


def test_thread_archive_shuffles_lines_and_sorts_them_once(spark):
    """F1, F4, F5, F7, F8: no comment text, and no second sort, before the rows are written."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sorted_aggregates(spark):
            plan = fx.build_thread_archive(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ObjectHashAggregate" not in plan
    assert len(re.findall(r"[- ]Sort \[", plan)) == 2          # posts and lines
    assert len(re.findall(r"Exchange hashpartitioning\(post_key#\d+L, comment_page", plan)) == 2
    lines = plan[plan.index("SortAggregate"):]
    assert "Supplier#" not in lines and "line " not in lines


def test_thread_archive_keeps_odd_keys(spark, tmp_path):
    """Repeated and null keys, and threads of many pages of which some stay empty."""
    orders = [(k, "O", 1.0, dt.datetime(1996, 1, 1), "1-URGENT", 7) for k in (1, 1, 2, 3, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k, n, 5 * n, n, "N", "O", 2.5, dt.datetime(1996, 2, 1)) for k, m in ((1, 7), (2, 2), (None, 2), (9, 4)) for n in range(m)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_returnflag string, "
                          "l_linestatus string, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = fx.build_thread_archive(spark, str(tmp_path), 2).collect()
    of = lambda key: [r for r in rows if r["id"] == key]
    assert {r["num_comments"] for r in of("1")} == {7}
    assert sorted(r["comment_page"] for r in of("1"))[:2] == [0, 0]           # a header for each of the two posts
    assert all((r["comment_page"] == 0) == (r["comments"] == []) for r in of("1"))
    assert sorted(c["id"] for r in of("1") for c in r["comments"]) == sorted(2 * [f"1-{n}-{5 * n}-{n}" for n in range(7)])
    assert [(r["num_comments"], r["comment_page"], len(r["comments"])) for r in of("2")] == [(2, 0, 2)]
    assert [(r["num_comments"], r["comment_page"], r["comments"]) for r in of("3") + of(None)] == 2 * [(0, 0, [])]
    assert {r["id"] for r in rows} == {"1", "2", "3", None}


def test_comments_of_selected_posts_are_not_shuffled(spark):
    """only the ranking moves rows, without their comments."""
    t = fx.thread_archive(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, comments = flows.collect_communities(t, ["1-URGENT", "5-LOW"], "year", 10, dt.datetime(1998, 8, 2))
        plan = comments._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_interim_runs_are_written_by_many_tasks(spark, monkeypatch):
    """a run of product pages is more than one file, and still one batch in list order."""
    pages = fx.build_product_pages(spark, SF_SMALL).repartition(6)
    monkeypatch.setattr(fx, "product_pages", lambda *_: pages)
    base = queries._run_interim(spark, SF_SMALL)
    assert len(glob.glob(f"{base}/in/*.parquet")) > 4
    batches = spark.read.parquet(f"{base}/out/progress")
    assert batches.count() == 4
    parsed = catalog.parse_product_json(catalog.extract_structured_data(pages))
    want = crawl.interim_snapshots(row_number_within(
        parsed.select("page_id", F.when(F.col("parse_ok"), F.size("product.review")).otherwise(0).cast("long").alias("n_reviews")),
        [], ["page_id"], out="product_no").select("product_no", "n_reviews"))
    got = jobs.interim_progress(spark, f"{base}/out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) != []


def test_one_crawl_without_a_key_is_cut_by_a_scalar(spark):
    flags = [(p, p in (3, 4, 6), p == 5) for p in range(1, 9)]
    log = spark.createDataFrame(flags, "page_no long, is_error boolean, resets boolean")
    cut = lambda n: crawl.error_cutoff(log, key=None, order=("page_no",), n=n)
    assert [r["page_no"] for r in cut(2).orderBy("page_no").collect()] == [1, 2, 3, 4]
    assert cut(3).count() == 8                                                # never three in a row: all stay
    assert "Join" not in cut(2)._jdf.queryExecution().executedPlan().toString()
