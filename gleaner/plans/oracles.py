"""DuckDB SQL restating each registered query over the raw tables."""

from __future__ import annotations

POSTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'status ' || o_orderstatus AS title,
       'customer ' || CAST(o_custkey AS VARCHAR) AS body,
       CAST(round(o_totalprice * 100) AS BIGINT) AS score, o_orderdate AS created_utc,
       coalesce(nc.n, 0) AS num_comments, o_orderpriority AS community
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) nc
  ON nc.l_orderkey = o_orderkey
"""

COMMENTS = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS comment_id,
       CAST(l_orderkey AS VARCHAR) AS post_id,
       'line ' || CAST(l_linenumber AS VARCHAR) || ' ' || l_returnflag || l_linestatus AS body,
       CAST(round(l_quantity) AS BIGINT) AS score, l_shipdate AS created_utc,
       CASE WHEN l_partkey % 5 = 0 THEN NULL
            ELSE 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS author,
       o_orderpriority AS community
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

ORACLES: dict[str, str] = {}

ORACLES["project_posts"] = POSTS
ORACLES["flatten_comments"] = COMMENTS
ORACLES["tag_source"] = f"SELECT * REPLACE ('archive' AS community) FROM ({POSTS})"
ORACLES["tag_month"] = f"SELECT *, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({POSTS})"
ORACLES["top_posts"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY community ORDER BY score DESC, id) AS rn FROM ({POSTS}))
WHERE rn <= 100"""
ORACLES["union_communities"] = f"""
SELECT * REPLACE (CASE WHEN community IN ('1-URGENT', '2-HIGH') THEN NULL ELSE body END AS body)
FROM ({POSTS})"""
ORACLES["output_counts"] = """
SELECT 'posts' AS kind, count(*) AS rows FROM orders
UNION ALL SELECT 'comments', count(*) FROM lineitem"""
ORACLES["community_counts"] = """
SELECT o_orderpriority AS community, 'posts' AS kind, count(*) AS rows FROM orders GROUP BY 1
UNION ALL
SELECT o_orderpriority, 'comments', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
ORACLES["backfill_summary"] = """
WITH u AS (SELECT strftime(o_orderdate, '%Y-%m') AS m, 1 AS p, 0 AS c FROM orders
           UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 0, 1 FROM lineitem)
SELECT m AS scrape_month, CAST(sum(p) AS BIGINT) AS posts, CAST(sum(c) AS BIGINT) AS comments,
       grouping(m) = 1 AS is_total
FROM u GROUP BY ROLLUP (m)"""

for _p, _interval in (("day", "1 DAY"), ("week", "7 DAY"), ("month", "1 MONTH"), ("year", "1 YEAR")):
    ORACLES["listing_period" if _p == "year" else f"listing_period_{_p}"] = f"""
SELECT * FROM ({POSTS})
WHERE created_utc > (SELECT max(o_orderdate) FROM orders) - INTERVAL {_interval}
  AND created_utc <= (SELECT max(o_orderdate) FROM orders)"""
ORACLES["listing_period_all"] = POSTS
ORACLES["month_window"] = f"""
SELECT * FROM ({COMMENTS})
WHERE created_utc >= TIMESTAMP '1997-03-01' AND created_utc < TIMESTAMP '1997-04-01'"""
ORACLES["month_window_inclusive_last_day"] = f"""
SELECT * FROM ({COMMENTS})
WHERE created_utc >= TIMESTAMP '1997-03-01 06:00:00' AND created_utc <= TIMESTAMP '1997-03-31 06:00:00'"""
ORACLES["assign_month"] = f"""
SELECT *, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({COMMENTS})
WHERE created_utc >= TIMESTAMP '1996-01-01' AND created_utc <= TIMESTAMP '1997-12-31 23:59:59'"""
ORACLES["assign_month_inclusive_last_day"] = f"""
SELECT *, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({COMMENTS})
WHERE created_utc >= TIMESTAMP '1996-01-01 06:00:00' AND created_utc <= TIMESTAMP '1997-12-31 23:59:59'
  AND created_utc >= date_trunc('month', created_utc) + INTERVAL 6 HOUR
  AND created_utc <= date_trunc('month', created_utc) + INTERVAL 1 MONTH - INTERVAL 1 DAY + INTERVAL 6 HOUR"""

_MONTHS = """
SELECT CAST(m AS TIMESTAMP) AS month_start, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS month_end,
       strftime(m, '%Y-%m') AS scrape_month
FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min({c})) AS TIMESTAMP),
                                    CAST(max({c}) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM {t})"""
ORACLES["plan_months"] = _MONTHS.format(c="o_orderdate", t="orders")
ORACLES["pending_months"] = f"""
WITH months AS ({_MONTHS.format(c="l_shipdate", t="lineitem")}),
done AS (
  SELECT m FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders GROUP BY 1
                 INTERSECT SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem GROUP BY 1)
  WHERE m <= '1998-12')
SELECT * FROM months
WHERE scrape_month NOT IN (SELECT m FROM done) AND month_start >= TIMESTAMP '1996-07-01'"""

# ---------------------------------------------------------------- catalogue

SLUG = ("lower(replace(p_brand, '#', '')) || '/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS VARCHAR)")
URL = f"'https://shop.example.com/p/' || {SLUG} || '.html'"
NREV = "(SELECT doc_id // 5 AS k, count(*) AS n FROM documents GROUP BY 1)"

ORACLES["read_pages"] = "SELECT page_id, url, CAST(length(html) AS BIGINT) AS html_chars FROM pages"
_IMG = "'https://shop.example.com/img/' || CAST(p_partkey AS VARCHAR)"
_REVIEW_JSON = """(SELECT k, '[' || string_agg(j, ',' ORDER BY doc_id) || ']' AS js FROM (
  SELECT doc_id // 5 AS k, doc_id, '{"name":' || CAST(to_json(lang || ' review ' || CAST(doc_id AS VARCHAR)) AS VARCHAR)
    || ',"reviewBody":' || replace(CAST(to_json(text) AS VARCHAR), '</', '<\\/') || ',"datePublished":"'
    || printf('2024-%02d-%02d', doc_id % 12 + 1, doc_id % 28 + 1) || '"'
    || CASE WHEN doc_id % 9 = 0 THEN '' ELSE ',"author":{"name":"user' || CAST(doc_id % 97 AS VARCHAR) || '"}' END
    || ',"reviewRating":{"ratingValue":' || CASE WHEN (doc_id // 5) % 2 = 0 THEN CAST(doc_id % 5 + 1 AS VARCHAR)
         ELSE '"' || CAST(doc_id % 5 + 1 AS VARCHAR) || '"' END || '}}' AS j
  FROM documents) GROUP BY k)"""
_PAYLOAD = f"""'{{"sku":"SKU-' || CAST(p_partkey AS VARCHAR) || '","name":' || CAST(to_json(p_name) AS VARCHAR)
  || ',"description":' || CAST(to_json(p_type || ' ' || p_name) AS VARCHAR) || ',"size":"' || CAST(p_size AS VARCHAR)
  || 'ml","material":' || CAST(to_json('aqua, ' || p_brand) AS VARCHAR)
  || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE ',"brand":{{"name":' || CAST(to_json(p_brand) AS VARCHAR) || '}}' END
  || CASE WHEN p_partkey % 11 = 0 THEN '' ELSE ',"review":' || coalesce(r.js, '[]') END
  || CASE p_partkey % 3 WHEN 0 THEN ',"image":"' || {_IMG} || '.jpg"'
       WHEN 1 THEN ',"image":["' || {_IMG} || 'a.jpg","' || {_IMG} || 'b.jpg"]' ELSE '' END || '}}'"""
ORACLES["extract_structured_data"] = f"""
SELECT url, CASE WHEN k % 13 = 0 THEN '' WHEN k % 17 = 0 THEN left(p, length(p) // 2) ELSE p END AS payload
FROM (SELECT {URL} AS url, p_partkey AS k, {_PAYLOAD} AS p FROM part LEFT JOIN {_REVIEW_JSON} r ON r.k = p_partkey)"""
ORACLES["pages_with_payload"] = f"SELECT {URL} AS url FROM part WHERE p_partkey % 13 <> 0"
ORACLES["parse_product_json"] = f"""
SELECT {URL} AS url, p_partkey % 17 <> 0 AS parse_ok,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 'SKU-' || CAST(p_partkey AS VARCHAR) END AS sku,
  CASE WHEN p_partkey % 17 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN {_IMG} || '.jpg'
       WHEN p_partkey % 3 = 1 THEN {_IMG} || 'a.jpg ' || {_IMG} || 'b.jpg' ELSE '' END AS images,
  CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '' ELSE coalesce(r.b, '') END AS review_bodies
FROM part LEFT JOIN (SELECT doc_id // 5 AS k, string_agg(text, '|' ORDER BY doc_id) AS b FROM documents GROUP BY 1) r
  ON r.k = p_partkey WHERE p_partkey % 13 <> 0"""
ORACLES["project_products"] = f"""
SELECT {URL} AS url, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS name,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand, p_type || ' ' || p_name AS description,
  CAST(p_size AS VARCHAR) || 'ml' AS size, 'aqua, ' || p_brand AS ingredients,
  CASE p_partkey % 3
    WHEN 0 THEN ['https://shop.example.com/img/' || CAST(p_partkey AS VARCHAR) || '.jpg']
    WHEN 1 THEN ['https://shop.example.com/img/' || CAST(p_partkey AS VARCHAR) || 'a.jpg',
                 'https://shop.example.com/img/' || CAST(p_partkey AS VARCHAR) || 'b.jpg']
    ELSE CAST([] AS VARCHAR[]) END AS image_urls,
  TIMESTAMP '2024-02-01 00:00:00' + to_seconds(p_partkey) AS scraped_at
FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0"""
REVIEWS = """
SELECT md5(text) AS review_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS product_sku, p_name AS product_name,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS brand,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 'user' || CAST(doc_id % 97 AS VARCHAR) END AS author,
  lang || ' review ' || CAST(doc_id AS VARCHAR) AS title, text AS body,
  CAST(doc_id % 5 + 1 AS VARCHAR) AS rating,
  printf('2024-%02d-%02d', doc_id % 12 + 1, doc_id % 28 + 1) AS date_published
FROM part JOIN documents ON doc_id // 5 = p_partkey
WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 11 <> 0"""
ORACLES["explode_reviews"] = REVIEWS
ORACLES["review_ids"] = f"""
SELECT product_sku, title, CAST(rating AS DOUBLE) AS rating_num,
  md5(concat_ws(chr(1), product_sku, coalesce(author, ''), date_published, body)) AS review_uid
FROM ({REVIEWS})"""
ORACLES["explode_reviews_narrow"] = f"SELECT * EXCLUDE (product_name, brand) FROM ({REVIEWS})"
ORACLES["review_key"] = "SELECT doc_id, md5(text) AS review_key FROM documents"
ORACLES["reviews_per_product"] = f"SELECT product_sku, count(*) AS reviews FROM ({REVIEWS}) GROUP BY 1"
ORACLES["lookup_pages"] = f"SELECT {URL} AS url, p_partkey AS page_id FROM part"
ORACLES["lookup_pages_refetched"] = f"""
SELECT {URL} AS url, p_partkey AS page_id, TIMESTAMP '2024-02-01 00:00:00' + to_seconds(p_partkey) AS fetched_at,
       false AS is_old FROM part"""
ORACLES["lookup_pages_missing"] = """
SELECT 'https://shop.example.com/p/discontinued-' || CAST(p_partkey AS VARCHAR) || '.html' AS url
FROM part WHERE p_partkey % 19 = 0"""
ORACLES["quarantine"] = f"""
SELECT {URL} AS url, CASE WHEN p_partkey % 13 = 0 THEN 'no_payload' ELSE 'malformed_json' END AS reason
FROM part WHERE p_partkey % 13 = 0 OR p_partkey % 17 = 0"""

# ---------------------------------------------------------------- links

HREF = f"""(CASE p_partkey % 4 WHEN 0 THEN '/p/' || {SLUG} || '.html'
  WHEN 1 THEN './p/' || {SLUG} || '.html'
  WHEN 2 THEN 'https://shop.example.com/p/' || {SLUG} || '.html'
  ELSE '/c/../p/' || {SLUG} || '.html' END
  || CASE WHEN p_partkey % 24 = 17 THEN '?src=list&pos=17' ELSE '' END)"""
ORACLES["extract_listing_links"] = f"""
SELECT p_partkey // 24 + 1 AS page_id,
  CAST(row_number() OVER (PARTITION BY p_partkey // 24 ORDER BY p_partkey) - 1 AS INTEGER) AS container_no,
  CASE WHEN p_partkey % 24 = 7 THEN NULL WHEN p_partkey % 24 = 11 THEN '/c/skin-care.html' ELSE {HREF} END AS href
FROM part WHERE p_partkey % 24 NOT IN (5, 13)"""
ORACLES["containers_per_page"] = """
SELECT p_partkey // 24 + 1 AS page_id,
       CAST(count(*) FILTER (WHERE p_partkey % 24 NOT IN (5, 13)) AS BIGINT) AS containers
FROM part GROUP BY 1
UNION ALL SELECT max(p_partkey) // 24 + 2, CAST(0 AS BIGINT) FROM part"""
LISTING_URLS = f"""
SELECT DISTINCT 'https://shop.example.com/p/' || {SLUG} || '.html'
       || CASE WHEN p_partkey % 24 = 17 THEN '?src=list&pos=17' ELSE '' END AS url
FROM part WHERE p_partkey % 24 NOT IN (5, 7, 11, 13)"""
ORACLES["distinct_product_urls"] = LISTING_URLS
ORACLES["distinct_url_count"] = f"SELECT count(*) AS distinct_urls FROM ({LISTING_URLS})"
ORACLES["preview"] = f"SELECT url FROM ({LISTING_URLS}) ORDER BY url LIMIT 5"
ORACLES["page_cap"] = """
SELECT DISTINCT p_partkey // 24 + 1 AS page_id,
       'https://shop.example.com/c/skin-care.html?p=' || CAST(p_partkey // 24 + 1 AS VARCHAR) AS url
FROM part WHERE p_partkey // 24 + 1 <= 5"""
ORACLES["plan_listing_pages"] = """
SELECT page_no, 'https://shop.example.com/c/skin-care.html?p=' || CAST(page_no AS VARCHAR) AS url
FROM (SELECT unnest(range(1, max(p_partkey) // 24 + 3)) AS page_no FROM part)"""
PAGE_LINKS = """
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS link_no, unnest(l) AS href
FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1) AS l FROM pages)"""
ORACLES["extract_page_links"] = PAGE_LINKS
ORACLES["product_links"] = f"SELECT * FROM ({PAGE_LINKS}) WHERE contains(href, '/th')"
ORACLES["resolve_url"] = f"""
SELECT page_id, link_no,
  CASE WHEN href = '' THEN 'https://shop.example.com'
       WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
       WHEN href LIKE '//%' THEN 'https:' || href
       WHEN href LIKE '/%' THEN 'https://shop.example.com' || href
       ELSE 'https://shop.example.com/' || href END AS url
FROM ({PAGE_LINKS})"""

# ---------------------------------------------------------------- crawl log

CRAWL = """
SELECT user_id AS crawl_id, 'https://shop.example.com/p/item-' || CAST(user_id AS VARCHAR) || '.html' AS url,
  ts AS attempt_ts, event_id AS attempt_seq,
  CASE WHEN event_type = 'error' THEN
    CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN 503 WHEN 1 THEN 429 ELSE 500 END
  ELSE 200 END AS status,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) % 25 END AS n_results
FROM events"""
ORACLES["classify_fetch"] = f"""
SELECT crawl_id, attempt_seq, status,
  CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status IN (403, 429, 503) THEN 'retryable' ELSE 'error' END
    AS fetch_class
FROM ({CRAWL})"""
_OUTCOME = """
WITH a AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY attempt_ts, attempt_seq) AS n FROM ({crawl})),
f AS (SELECT url, min(CASE WHEN status BETWEEN 200 AND 299 THEN n END) AS ok_n,
             min(CASE WHEN {fatal} THEN n END) AS fatal_n, count(*) AS tried
      FROM a WHERE n <= 3 GROUP BY url)
SELECT url, CASE WHEN ok_n IS NOT NULL AND (fatal_n IS NULL OR ok_n < fatal_n) THEN 'ok' ELSE 'failed' END AS outcome,
       CAST(coalesce(least(ok_n, fatal_n), tried) AS BIGINT) AS attempts_used
FROM f"""
ORACLES["fetch_outcome"] = _OUTCOME.format(crawl=CRAWL, fatal="false")
ORACLES["fetch_outcome_narrow"] = _OUTCOME.format(
    crawl=CRAWL, fatal="NOT (status BETWEEN 200 AND 299) AND status NOT IN (403)")
ORACLES["error_cutoff"] = f"""
WITH a AS (SELECT *, sum(CASE WHEN status = 200 AND n_results > 0 THEN 1 ELSE 0 END)
             OVER (PARTITION BY crawl_id ORDER BY attempt_ts, attempt_seq ROWS UNBOUNDED PRECEDING) AS isl
           FROM ({CRAWL})),
b AS (SELECT *, sum(CASE WHEN status <> 200 THEN 1 ELSE 0 END)
        OVER (PARTITION BY crawl_id, isl ORDER BY attempt_ts, attempt_seq ROWS UNBOUNDED PRECEDING) AS streak FROM a),
c AS (SELECT crawl_id, min(attempt_ts) AS cut FROM b WHERE streak = 5 GROUP BY 1)
SELECT b.crawl_id, attempt_seq, status FROM b LEFT JOIN c USING (crawl_id)
WHERE c.cut IS NULL OR attempt_ts <= c.cut"""
ORACLES["listing_frontier"] = f"""
WITH p AS (SELECT crawl_id, row_number() OVER (PARTITION BY crawl_id ORDER BY attempt_ts, attempt_seq) AS page_no,
                  status = 200 AS ok, n_results AS n FROM ({CRAWL})),
e AS (SELECT crawl_id, min(page_no) AS stop FROM p WHERE ok AND n = 0 GROUP BY 1)
SELECT p.crawl_id, CAST(page_no AS BIGINT) AS page_no FROM p LEFT JOIN e USING (crawl_id)
WHERE e.stop IS NULL OR page_no < e.stop"""
ORACLES["interim_snapshots"] = f"""
WITH p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS product_no,
             CASE WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 11 = 0 THEN 0
                  ELSE coalesce(r.n, 0) END AS n
           FROM part LEFT JOIN {NREV} r ON r.k = p_partkey),
r AS (SELECT product_no, n, sum(n) OVER (ORDER BY product_no ROWS UNBOUNDED PRECEDING) AS rows_so_far FROM p)
SELECT product_no // 5 AS snapshot_no, product_no, CAST(rows_so_far AS BIGINT) AS rows_so_far
FROM r WHERE product_no % 5 = 0 AND n > 0"""

# ---------------------------------------------------------------- forest, split

_FOREST_EDGES = """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
         CASE WHEN turn = 0 THEN NULL ELSE CAST(conv_id AS VARCHAR) || '-' || CAST((turn - 1) // 2 AS VARCHAR) END
           AS parent_id, turn AS sib
  FROM conversations"""
_LOOPS = """SELECT 'a' || CAST(conv_id AS VARCHAR) AS id, 'b' || CAST(conv_id AS VARCHAR) AS parent_id, 0 AS sib
  FROM conversations WHERE turn = 0 AND conv_id % 50 = 0
  UNION ALL SELECT 'b' || CAST(conv_id AS VARCHAR), 'a' || CAST(conv_id AS VARCHAR), 1
  FROM conversations WHERE turn = 0 AND conv_id % 50 = 0"""
_FOREST = """
WITH RECURSIVE e AS ({edges}),
t AS (SELECT id, parent_id, id AS root_id, 0 AS depth, [sib] AS path, parent_id IS NOT NULL AS is_orphan FROM e
      WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM e)
      UNION ALL
      SELECT e.id, e.parent_id, t.root_id, t.depth + 1, list_append(t.path, e.sib), false
      FROM e JOIN t ON e.parent_id = t.id)
SELECT id, parent_id, root_id, depth, row_number() OVER (PARTITION BY root_id ORDER BY depth, path) AS bfs_no, is_orphan
FROM t
UNION ALL SELECT id, parent_id, NULL, NULL, NULL, false FROM e WHERE id NOT IN (SELECT id FROM t)"""
ORACLES["expand_comment_forest"] = _FOREST.format(edges=_FOREST_EDGES)
ORACLES["expand_comment_forest_orphans"] = _FOREST.format(edges=f"{_FOREST_EDGES} WHERE turn <> 1 UNION ALL {_LOOPS}")
ORACLES["train_test_split"] = """
SELECT doc_id, CAST(('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
FROM documents"""

# ---------------------------------------------------------------- sources over written data

URL_LIST = f"""
SELECT {URL} AS url FROM part
UNION ALL
SELECT 'https://shop.example.com/p/discontinued-' || CAST(p_partkey AS VARCHAR) || '.html' FROM part
WHERE p_partkey % 19 = 0"""
ORACLES["read_threads"] = POSTS
ORACLES["read_threads_good"] = f"SELECT * FROM ({POSTS}) WHERE CAST(id AS BIGINT) % 17 <> 0 AND CAST(id AS BIGINT) % 19 <> 0"
ORACLES["quarantine_threads"] = """
SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'malformed_json' ELSE 'no_id' END AS reason, count(*) AS rows
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 GROUP BY 1"""
ORACLES["read_url_list"] = URL_LIST
ORACLES["latest_snapshot_table"] = URL_LIST
ORACLES["latest_snapshot"] = URL_LIST
ORACLES["read_checkpoint"] = "SELECT max(o_orderdate) AS last_date FROM orders"

# ---------------------------------------------------------------- sinks

# Posts and comments as one table: what one kind lacks is null.
_BOTH = f"""
SELECT *, {{post_tag}} FROM (SELECT *, 'posts' AS kind FROM ({POSTS}))
UNION ALL BY NAME SELECT *, {{comment_tag}} FROM (SELECT *, 'comments' AS kind FROM ({COMMENTS}))"""


def _both(tag: str) -> str:
    return _BOTH.format(post_tag=tag, comment_tag=tag)


ORACLES["write_csv_compat"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ORACLES["write_run_snapshot"] = _both("'20240101_000000' AS run")
ORACLES["write_daily"] = _both("'2024-01-01' AS run_date")
ORACLES["write_monthly"] = _both("strftime(created_utc, '%Y-%m') AS scrape_month")
ORACLES["write_url_list"] = LISTING_URLS
ORACLES["write_checkpoint"] = """
SELECT m AS scrape_month, kind, rows, CASE WHEN m <= '1998-12' THEN 'complete' ELSE 'open' END AS status,
  strptime(m || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH AS last_date
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS m, 'posts' AS kind, count(*) AS rows FROM orders GROUP BY 1
      UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), 'comments', count(*) FROM lineitem GROUP BY 1)"""
ORACLES["checkpoint_iso_text"] = """
SELECT '{"last_date":"' || strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') || '"}' AS line FROM orders"""

# ---------------------------------------------------------------- streaming

ORACLES["ingest_threads_stream"] = f"""
SELECT *, 'posts' AS kind FROM ({POSTS}) UNION ALL BY NAME SELECT *, 'comments' AS kind FROM ({COMMENTS})"""
ORACLES["distinct_urls_stream"] = LISTING_URLS
ORACLES["interim_reviews_stream"] = REVIEWS
ORACLES["write_interim"] = ORACLES["interim_snapshots"]
ORACLES["error_streak_stream"] = f"""
WITH a AS (SELECT *, sum(CASE WHEN status = 200 AND n_results > 0 THEN 1 ELSE 0 END)
             OVER (PARTITION BY crawl_id ORDER BY attempt_ts, attempt_seq ROWS UNBOUNDED PRECEDING) AS isl
           FROM ({CRAWL})),
b AS (SELECT *, sum(CASE WHEN status <> 200 THEN 1 ELSE 0 END)
        OVER (PARTITION BY crawl_id, isl ORDER BY attempt_ts, attempt_seq ROWS UNBOUNDED PRECEDING) AS streak FROM a),
c AS (SELECT crawl_id, min(attempt_ts) AS cut FROM b WHERE streak = 5 GROUP BY 1)
SELECT b.crawl_id, b.attempt_seq FROM b JOIN c ON b.crawl_id = c.crawl_id AND b.attempt_ts = c.cut"""

# ---------------------------------------------------------------- composed flows

_TOP = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY community ORDER BY score DESC, id) AS rn FROM ({posts})
  WHERE community IN ({communities})
    AND created_utc > (SELECT max(o_orderdate) FROM orders) - INTERVAL {period}
    AND created_utc <= (SELECT max(o_orderdate) FROM orders))
WHERE rn <= {limit}"""
_TOP_COMMENTS = "SELECT * FROM ({comments}) WHERE post_id IN (SELECT id FROM ({top}))"
_T1 = _TOP.format(posts=POSTS, communities="'1-URGENT'", period="1 YEAR", limit=100)
_T3 = _TOP.format(posts=POSTS, communities="'1-URGENT', '3-MEDIUM', '5-LOW'", period="1 YEAR", limit=100)
_TD = _TOP.format(posts=POSTS, communities="'1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'",
                  period="1 DAY", limit=100)
ORACLES["collect_threads"] = _T1
ORACLES["collect_threads_comments"] = _TOP_COMMENTS.format(comments=COMMENTS, top=_T1)
ORACLES["collect_communities"] = _T3
ORACLES["collect_communities_comments"] = _TOP_COMMENTS.format(comments=COMMENTS, top=_T3)
# Threads of files 3, 5 and 7 (of 64, by id) are set aside with their file.
_WHOLE = "CAST({id} AS BIGINT) % 64 NOT IN (3, 5, 7)"
_T3W = _TOP.format(posts=f"SELECT * FROM ({POSTS}) WHERE {_WHOLE.format(id='id')}", communities="'1-URGENT', '3-MEDIUM', '5-LOW'",
                   period="1 YEAR", limit=100)
ORACLES["collect_sources"] = f"""
SELECT *, 'posts' AS kind FROM ({_T3W}) UNION ALL BY NAME
SELECT *, 'comments' AS kind FROM ({_TOP_COMMENTS.format(comments=COMMENTS, top=_T3W)})"""
ORACLES["quarantine_files"] = """
SELECT * FROM (VALUES (3, 'truncated'), (5, 'corrupt'), (NULL, 'missing')) AS t(part, reason)"""
ORACLES["read_threads_isolated"] = f"SELECT * FROM ({POSTS}) WHERE {_WHOLE.format(id='id')}"
ORACLES["daily_snapshot"] = f"""
WITH top AS ({_TD}), day AS (SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS run_date FROM orders)
SELECT top.*, 'posts' AS kind, run_date FROM top, day
UNION ALL BY NAME
SELECT c.*, 'comments' AS kind, run_date FROM ({COMMENTS}) c, day WHERE post_id IN (SELECT id FROM top)"""
# From the collector's own rule: posts and comments of a listing are filtered
# by their own time, independently of one another.
_BACKFILL = """
WITH r AS (SELECT date_trunc('month', min(o_orderdate)) AS s, max(o_orderdate) AS e FROM orders),
p AS (SELECT q.*, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({posts}) q, r
      WHERE created_utc >= r.s AND created_utc <= r.e),
top AS (SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY community, scrape_month ORDER BY score DESC, id) AS rn FROM p)
        WHERE rn <= {limit}),
c AS (SELECT q.*, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({comments}) q, r
      WHERE post_id IN (SELECT id FROM top) AND created_utc >= r.s AND created_utc <= r.e)
SELECT *, 'posts' AS kind FROM top UNION ALL BY NAME SELECT *, 'comments' AS kind FROM c"""
ORACLES["backfill_by_month"] = _BACKFILL.format(posts=POSTS, comments=COMMENTS, limit=500)
ORACLES["backfill_by_month_top20"] = _BACKFILL.format(posts=POSTS, comments=COMMENTS, limit=20)
ORACLES["backfill_last_years"] = ORACLES["backfill_by_month"].replace(
    "date_trunc('month', min(o_orderdate))", "date_trunc('month', max(o_orderdate) - INTERVAL 1825 DAY)")
# The first run ends on 1998-06-15: months before June were finished with the
# posts known then (test comments may be older than their post); the second
# run does June and later only.
ORACLES["resume_backfill"] = f"""
WITH r AS (SELECT date_trunc('month', min(o_orderdate)) AS s, max(o_orderdate) AS e FROM orders),
p AS (SELECT q.*, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({POSTS}) q, r
      WHERE created_utc >= r.s AND created_utc <= r.e),
top AS (SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY community, scrape_month ORDER BY score DESC, id) AS rn FROM p)
        WHERE rn <= 500),
early AS (SELECT id FROM (
          SELECT *, row_number() OVER (PARTITION BY community, scrape_month ORDER BY score DESC, id) AS rn FROM p
          WHERE created_utc <= TIMESTAMP '1998-06-15 12:00:00') WHERE rn <= 500),
c AS (SELECT q.*, strftime(created_utc, '%Y-%m') AS scrape_month FROM ({COMMENTS}) q, r
      WHERE created_utc >= r.s AND created_utc <= r.e
        AND CASE WHEN created_utc < TIMESTAMP '1998-06-01' THEN post_id IN (SELECT id FROM early)
                 ELSE post_id IN (SELECT id FROM top) END)
SELECT *, 'posts' AS kind FROM top UNION ALL BY NAME SELECT *, 'comments' AS kind FROM c"""
ORACLES["last_n_months"] = """
SELECT CAST(m AS TIMESTAMP) AS month_start, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS month_end,
       strftime(m, '%Y-%m') AS scrape_month
FROM (SELECT unnest(generate_series(date_trunc('month', max(o_orderdate)) - INTERVAL 5 MONTH,
                                    date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)"""
# The walk, page by page, as the collector does it: a failed page counts up,
# a page with products resets, five failures in a row end it, and so does a
# page that loaded without products.
ORACLES["collect_product_urls_failures"] = f"""
WITH RECURSIVE n AS (SELECT max(p_partkey) // 24 + 2 AS last FROM part),
page AS (SELECT page_no, page_no <> 2 AND (page_no % 9 = 4 OR page_no BETWEEN last * 3 // 4 AND last * 3 // 4 + 4) AS failed,
                page_no < last AS full FROM n, unnest(range(1, last + 1)) AS u(page_no)),
walk AS (SELECT 0 AS page_no, 0 AS errors, true AS go_on, false AS used
         UNION ALL
         SELECT p.page_no, CASE WHEN p.failed THEN w.errors + 1 WHEN p.full THEN 0 ELSE w.errors END,
                (p.failed OR p.full) AND CASE WHEN p.failed THEN w.errors + 1 WHEN p.full THEN 0 ELSE w.errors END < 5,
                NOT p.failed AND p.full
         FROM walk w JOIN page p ON p.page_no = w.page_no + 1 WHERE w.go_on)
SELECT DISTINCT 'https://shop.example.com/p/' || {SLUG} || '.html'
       || CASE WHEN p_partkey % 24 = 17 THEN '?src=list&pos=17' ELSE '' END AS url
FROM part WHERE p_partkey % 24 NOT IN (5, 7, 11, 13)
  AND p_partkey // 24 + 1 IN (SELECT page_no FROM walk WHERE used)"""
ORACLES["collect_product_urls"] = LISTING_URLS
ORACLES["collect_reviews"] = REVIEWS
ORACLES["collect_products"] = ORACLES["project_products"]
ORACLES["collect_products_reviews"] = ORACLES["explode_reviews_narrow"]
ORACLES["append_reviews"] = REVIEWS

# ---------------------------------------------------------------- second modes

ORACLES["classify_fetch_narrow"] = f"""
SELECT crawl_id, attempt_seq, status,
  CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status IN (403) THEN 'retryable' ELSE 'error' END
    AS fetch_class
FROM ({CRAWL})"""
ORACLES["read_url_list_keep_blank"] = f"""
{URL_LIST}
UNION ALL SELECT '' FROM part WHERE p_partkey % 10 IN (0, 1)"""
ORACLES["flatten_comments_compat"] = f"SELECT * REPLACE (coalesce(author, 'None') AS author) FROM ({COMMENTS})"
ORACLES["error_cutoff_first_error"] = ORACLES["error_cutoff"].replace("WHERE streak = 5", "WHERE streak = 1")
