"""Archives with broken and missing files."""

import gzip

from pyspark.sql import functions as F

from gleaner.plans import flows
from gleaner.session import scratch_dir
from gleaner.sources import archive, readers

LINE = '{{"id": "{0}", "community": "a", "title": "t", "score": {0}, "created_utc": 1700000000, "comments": []}}\n'


def _put(spark, path, data):
    """A file's bytes (a fixture of this test; local session)."""
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(data)


def _archive(spark):
    root = scratch_dir(spark, "t-archive")
    whole = [gzip.compress("".join(LINE.format(10 * i + k) for k in range(10)).encode()) for i in range(5)]
    noise = b"".join(LINE.format(k).encode() for k in range(100, 4000))
    _put(spark, f"{root}/a/0.json.gz", whole[0])
    _put(spark, f"{root}/b/1.json.gz", gzip.compress(noise)[:-200])            # cut off
    _put(spark, f"{root}/b/2.json.gz", whole[2][5:])                           # no header
    _put(spark, f"{root}/c/3.json.gz", whole[3] + whole[4])                    # two members are one file
    _put(spark, f"{root}/c/4.json", LINE.format(77).encode() + b"{broken\n")   # a bad line, not a bad file
    _put(spark, f"{root}/c/5.json", b"")                                       # empty: as good as missing
    names = ["a/0.json.gz", "b/1.json.gz", "b/2.json.gz", "c/3.json.gz", "c/4.json", "c/5.json", "d/6.json.gz"]
    return root, spark.createDataFrame([(n,) for n in names], "name string")


def test_broken_files_are_set_aside_and_the_rest_is_whole(spark):
    root, expected = _archive(spark)
    found, broken = archive.read_threads_isolated(spark, root, expected)
    reasons = {r["file"].rsplit("/", 1)[-1]: r["reason"] for r in broken.collect()}
    assert reasons == {"1.json.gz": "truncated", "2.json.gz": "corrupt", "5.json": "missing", "6.json.gz": "missing"}
    ids = sorted(int(r["id"]) for r in found.where("_corrupt_record is null").collect())
    assert ids == [*range(10), *range(30, 50), 77]
    assert len(found.select("id", "_corrupt_record").where("_corrupt_record is not null").collect()) == 1


def test_without_a_list_nothing_is_missing(spark):
    root, _ = _archive(spark)
    _, broken = archive.read_threads_isolated(spark, root)
    assert broken.where("reason = 'missing'").isEmpty() and broken.count() == 2


def test_collect_sources_names_files_and_lines(spark):
    root, expected = _archive(spark)
    posts, _, bad = flows.collect_sources(spark, root, ["a"], "all", 1000, None, expected)
    assert posts.count() == 31
    assert sorted(r["reason"] for r in bad.where(F.col("file").isNotNull()).collect()) == ["corrupt", "missing", "missing", "truncated"]
    assert bad.where("file is null").count() == 1


def test_latest_snapshot_filters_the_partition_by_subquery(spark):
    root = scratch_dir(spark, "t-snapshots")
    for name in ("urls_1", "urls_3", "urls_2", "zzz"):
        spark.createDataFrame([(name,)], "value string").write.text(f"{root}/snapshot={name}")
    got = readers.read_latest_snapshot(spark, root, "urls_")
    assert [r["value"] for r in got.collect()] == ["urls_3"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ubquery" in plan
    assert readers.read_latest_snapshot(spark, root, "none").count() == 0
