"""Catalogue and listing operators on hand-written HTML."""

from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions.listing import container_links_py
from gleaner.functions.urls import resolve_url
from gleaner.operators import catalog, crawl, links

ROOT = "https://shop.example.com"
CLS = "relative rounded-md border-[1px] border-[#e1dfdf]"


def pages_df(spark, htmls):
    return spark.createDataFrame([(i, f"{ROOT}/p/x{i}.html", h, 200, None) for i, h in enumerate(htmls)],
                                 "page_id long, url string, html string, status int, fetched_at timestamp")


PAYLOAD = ('{"sku":"S1","name":"Cream","brand":{"name":"B"},"image":"a.jpg",'
           '"review":[{"name":"t","reviewBody":"Nice <!-- not a comment --> </p>","datePublished":"2024-01-01",'
           '"author":{"name":"u"},"reviewRating":{"ratingValue":4.5}}]}')


def test_script_extraction_skips_decoys_and_comments(spark):
    html = ('<html><!-- <script id="product_structured_data">{"sku":"commented"}</script> -->'
            '<script id="product_structured_data_2">{"sku":"decoy"}</script>'
            f'<script type="application/ld+json" id=\'product_structured_data\'>{PAYLOAD}</script></html>')
    out = catalog.extract_structured_data(pages_df(spark, [html, "<html>no payload</html>"])) \
        .orderBy("page_id").collect()
    assert out[0]["payload"] == PAYLOAD
    assert out[1]["payload"] == ""


def test_parse_product_json_variants(spark):
    docs = [PAYLOAD,
            '{"sku":"S2","image":["a.jpg","b.jpg"],"brand":null,"review":[{"reviewBody":null,"author":null}]}',
            '{"sku":"S3"}',
            '{"sku":"S4","name":"trunc']
    df = spark.createDataFrame([(i, f"u{i}", p, None) for i, p in enumerate(docs)],
                               "page_id long, url string, payload string, fetched_at timestamp")
    parsed = catalog.parse_product_json(df).orderBy("page_id").collect()
    assert [r["parse_ok"] for r in parsed] == [True, True, True, False]
    assert parsed[0]["product"]["image_urls"] == ["a.jpg"]
    assert parsed[1]["product"]["image_urls"] == ["a.jpg", "b.jpg"]
    assert parsed[2]["product"]["image_urls"] == [] and parsed[2]["product"]["review"] == []
    assert parsed[1]["product"]["brand"] is None          # D13: explicit null keeps the page
    reviews = catalog.explode_reviews(catalog.parse_product_json(df)).orderBy("product_sku").collect()
    assert [r["product_sku"] for r in reviews] == ["S1", "S2"]
    assert reviews[0]["rating"] == "4.5"
    import hashlib
    assert reviews[1]["review_id"] == hashlib.md5(b"").hexdigest()   # D3: missing body hashes as ''
    assert len(reviews[0]) == 9
    assert len(catalog.explode_reviews_narrow(catalog.parse_product_json(df)).columns) == 7
    good, bad = catalog.quarantine(catalog.parse_product_json(df))
    assert good.count() == 3 and [r["reason"] for r in bad.collect()] == ["malformed_json"]


def test_lookup_pages_newest_fetch_and_missing(spark):
    import datetime as dt
    pages = spark.createDataFrame(
        [(1, "u1", "old", 200, dt.datetime(2024, 1, 1)), (2, "u1", "new", 200, dt.datetime(2024, 2, 1)),
         (3, "u2", "only", 200, None)],
        "page_id long, url string, html string, status int, fetched_at timestamp")
    urls = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    found, missing = catalog.lookup_pages(urls, pages)
    assert sorted((r["url"], r["html"]) for r in found.collect()) == [("u1", "new"), ("u2", "only")]
    assert [r["url"] for r in missing.collect()] == ["u3"]


def test_container_links_parser_edge_cases():
    html = (f'<div class="{CLS}"><a name="x">no href</a><a href="/p/a.html?x=1&amp;y=2">A</a></div>'
            f'<div class="rounded-md relative border-[1px] border-[#e1dfdf]"><a href="/p/wrong.html">W</a></div>'
            f'<!-- <div class="{CLS}"><a href="/p/commented.html">C</a></div> -->'
            f'<div class=" relative  rounded-md border-[1px] border-[#e1dfdf]"><span>no link</span></div>'
            f'<div class="{CLS}"><div><b>unclosed<a href="/c/cat.html">cat</a><a href="/p/b.html">B</a></div></div>'
            f'<script>var s = \'<div class="{CLS}"><a href="/p/script.html"></a></div>\';</script>')
    out = container_links_py(html, CLS)
    assert out == [{"container_no": 0, "href": "/p/a.html?x=1&y=2"},
                   {"container_no": 1, "href": None},
                   {"container_no": 2, "href": "/c/cat.html"}]


def test_extract_listing_links_udf_matches_python(spark):
    html = f'<div class="{CLS}"><a href="/p/a.html">A</a></div><div class="{CLS}"></div>'
    rows = links.extract_listing_links(pages_df(spark, [html, ""]), CLS).orderBy("container_no").collect()
    assert [(r["page_id"], r["container_no"], r["href"]) for r in rows] == [(0, 0, "/p/a.html"), (0, 1, None)]


HREFS = ["", "/p/a.html", "p/a.html", "./p/a.html", "../p/a.html", "/c/../p/a.html", "/a/./b/../c",
         "a//b/c", "/a//b", "?q=1", "#frag", "/p/a.html?x=1#f", "//cdn.example.org/x.js",
         "http://other.example/p/", "https://shop.example.com/p/z.html", "mailto:x@y.z", "/a/b/..", "a/.",
         "..", ".", "/", "p/a.html?", "p/a.html#", "/é/ü", "//", "///p/a", "https:p/a", "https:///x",
         "HTTPS://Shop.example.com/A", "//cdn.example.org"]


def _resolve_all(spark, hrefs):
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    return [r["u"] for r in df.select(resolve_url("href", ROOT).alias("u")).collect()]


def test_resolve_url_matches_urljoin(spark):
    assert _resolve_all(spark, HREFS) == [urljoin(ROOT, h) for h in HREFS]


_seg = st.sampled_from(["a", "b", ".", "..", "", "p", "x.html"])


@settings(max_examples=40, deadline=None)
@given(st.lists(_seg, min_size=1, max_size=6), st.booleans(), st.sampled_from(["", "?q=1", "#f", "?a=b#c"]))
def test_resolve_url_property(spark, segs, absolute, tail):
    href = ("/" if absolute else "") + "/".join(segs) + tail
    assert _resolve_all(spark, [href]) == [urljoin(ROOT, href)]


def test_listing_frontier_failed_page_does_not_end(spark):
    df = spark.createDataFrame([(1, 1, True, 24), (1, 2, False, 0), (1, 3, True, 24), (1, 4, True, 0),
                                (1, 5, True, 24), (2, 1, True, 3)],
                               "crawl_id long, page_no long, ok boolean, n_containers long")
    out = sorted((r["crawl_id"], r["page_no"]) for r in links.listing_frontier(df).collect())
    assert out == [(1, 1), (1, 2), (1, 3), (2, 1)]


def test_fetch_outcome_modes(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 1, 503), ("a", t, 2, 429), ("a", t, 3, 200),
            ("b", t, 1, 404), ("b", t, 2, 200),
            ("c", t, 1, 503), ("c", t, 2, 503), ("c", t, 3, 503), ("c", t, 4, 200)]
    df = spark.createDataFrame(rows, "url string, attempt_ts timestamp, attempt_seq long, status int")
    main = {r["url"]: (r["outcome"], r["attempts_used"]) for r in crawl.fetch_outcome(df).collect()}
    assert main == {"a": ("ok", 3), "b": ("ok", 2), "c": ("failed", 3)}
    narrow = {r["url"]: (r["outcome"], r["attempts_used"])
              for r in crawl.fetch_outcome(df, retry_all_errors=False).collect()}
    assert narrow == {"a": ("failed", 1), "b": ("failed", 1), "c": ("failed", 1)}


def test_error_cutoff_reset_and_neutral_rows(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    # E E ok(no results: neutral) E ok(results: reset) E E E E E
    # n=4: streak 1 2 2 3 | 0 1 2 3 4 -> cut at seq 9, seq 10 dropped
    flags = [(1, 0), (1, 0), (0, 0), (1, 0), (0, 1), (1, 0), (1, 0), (1, 0), (1, 0), (1, 0)]
    rows = [(7, t0 + dt.timedelta(minutes=i), i + 1, bool(e), bool(r)) for i, (e, r) in enumerate(flags)]
    df = spark.createDataFrame(rows, "crawl_id long, attempt_ts timestamp, attempt_seq long, is_error boolean, "
                                     "resets boolean")
    kept = [r["attempt_seq"] for r in crawl.error_cutoff(df, n=4).orderBy("attempt_seq").collect()]
    assert kept == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    # neutral rows do not break a streak: n=3 cuts at the third error (seq 4)
    kept3 = [r["attempt_seq"] for r in crawl.error_cutoff(df, n=3).orderBy("attempt_seq").collect()]
    assert kept3 == [1, 2, 3, 4]


def test_interim_snapshots_skip_products_without_reviews(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([1, 2, 0, 1, 3, 2, 2, 2, 2, 0, 1, 1, 1, 1, 4], 1)],
                               "product_no long, n_reviews long")
    out = [(r["product_no"], r["rows_so_far"]) for r in crawl.interim_snapshots(df).orderBy("product_no").collect()]
    assert out == [(5, 7), (15, 23)]                     # D19: product 10 had no reviews, no save


def test_blocked_running_sum_matches_plain_window(spark):
    from pyspark.sql import Window

    from gleaner.functions.scan import blocked_running_sum
    df = spark.range(1, 2001).select((F.col("id") % 3).alias("k"), F.col("id").alias("pos"),
                                     (F.col("id") * 7 % 11).alias("v"))
    df = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("pos")))
    got = blocked_running_sum(df, "v", "pos", by=["k"], out="run", block=37)
    want = df.withColumn("run", F.sum("v").over(Window.partitionBy("k").orderBy("pos")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_train_test_split_is_stable(spark):
    from gleaner.operators.split import train_test_split
    df = spark.range(10000).withColumnRenamed("id", "doc_id")
    a = train_test_split(df, "doc_id")
    b = train_test_split(df.repartition(7), "doc_id")
    assert sorted(a.collect()) == sorted(b.collect())
    share = a.where("is_test").count() / 10000
    assert 0.18 < share < 0.22


def test_blocked_running_sum_recursive_levels(spark):
    from pyspark.sql import Window

    from gleaner.functions.scan import blocked_running_sum
    df = spark.range(1, 1001).select(F.col("id").alias("pos"), (F.col("id") * 13 % 7).alias("v"))
    got = blocked_running_sum(df, "v", "pos", out="run", block=4)     # 250 blocks -> 63 -> 16 -> 4 levels
    want = df.withColumn("run", F.sum("v").over(Window.orderBy("pos")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_latest_snapshot_from_plain_files(spark):
    import os
    import tempfile

    from gleaner.sources.readers import latest_snapshot, read_latest_snapshot
    d = tempfile.mkdtemp(dir="/tmp")
    for name, body in [("product_urls_20240101_000000.txt", "a\n"), ("product_urls_20240301_000000.txt", "b\nc\n"),
                       ("reviews_20250101_000000.csv", "x\n")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    got = read_latest_snapshot(spark, d, "product_urls_")
    assert sorted(r["value"] for r in got.collect()) == ["b", "c"]
    df = spark.createDataFrame([("product_urls_1", "a"), ("product_urls_2", "b"), ("zz", "c")], "snapshot string, v string")
    assert [r["v"] for r in latest_snapshot(df, "product_urls_").collect()] == ["b"]


def test_resolve_url_strips_as_the_standard_library_does(spark):
    from urllib.parse import urljoin

    from gleaner.functions.urls import resolve_url
    root = "https://shop.example.com"
    hrefs = [" /p/a ", "\t/p/a", "/p/a\n", "/p\n/a", "\x00\x1f /p/b", "/a/./b/../c", "a//b", "/a//b", "?q=1", "#f", "/a?", "/a#", "//", "///x",
             "//other.org/x?y#z", "HTTPS:/p/x", "mailto:a@b", "", "/", ".", "..", "/..", "a/", "/a/..", "./p/x.html?src=a&b=./c", "/p/.hidden", "/p/a b"]
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    got = {r["href"]: r["url"] for r in df.select("href", resolve_url("href", root).alias("url")).collect()}
    assert got == {h: urljoin(root, h) for h in hrefs}


def test_resolve_url_plan_stays_small(spark):
    from gleaner.functions.urls import resolve_url
    df = spark.createDataFrame([("/p/a",)], "href string").select(resolve_url("href", "https://shop.example.com").alias("u"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 20


def test_payload_script_id_is_exact(spark):
    from gleaner.functions.html import script_by_id
    html = ('<SCRIPT ID="PRODUCT_STRUCTURED_DATA">{"no":1}</SCRIPT><script id="product_structured_data ">{"no":2}</script>'
            "<Script type=x Id='product_structured_data'>{\"yes\":1}</sCRIPT>")
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(script_by_id("html", "product_structured_data").alias("p")).first()["p"] == '{"yes":1}'


def test_newest_page_is_one_whole_version(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "u", "old", 200, t), (1, "u", "A", 200, t + dt.timedelta(1)), (1, "u", "B", 404, t + dt.timedelta(1)),
            (1, "u", "A", 200, t + dt.timedelta(1)), (2, "v", "x", 200, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, status int, fetched_at timestamp")
    got = catalog.newest_pages(pages)
    out = {r["url"]: (r["html"], r["status"]) for r in got.collect()}
    assert got.count() == 2 and out["v"] == ("x", 200) and out["u"] in (("A", 200), ("B", 404))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("SortAggregate" in line and "html" in line for line in plan.splitlines())


def test_containers_with_entity_written_classes_are_found(spark):
    from gleaner.operators import links
    html = '<div class="relat&#105;ve rounded&#45;md border-[1px] border-[#e1dfdf]"><a href="/p/x">x</a></div>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = links.extract_listing_links(df, "relative rounded-md border-[1px] border-[#e1dfdf]").collect()
    assert [r["href"] for r in got] == ["/p/x"]
