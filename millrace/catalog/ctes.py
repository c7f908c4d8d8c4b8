"""SQL text of the views in ``millrace.sources.views``, for the SQL form of each query."""

LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
WORDS = LINES + """,
words AS (SELECT doc_id, unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
          WHERE rtrim(line, ' ') <> '' OR line = '')"""
WEBLOG = """weblog AS (SELECT event_id, CASE WHEN event_id % 50 = 11 THEN 'broken line' ELSE
  '10.0.0.' || (user_id % 256) || ' - ' || CASE WHEN user_id % 10 = 0 THEN '"-"' ELSE '"u' || user_id || '"' END
  || ' [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' || event_type || ' HTTP/1.1" '
  || CASE WHEN event_type = 'error' THEN '404' ELSE '200' END || ' '
  || CASE WHEN event_id % 50 = 7 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
  || ' "http://ref.example/" "agent/1.0" x' END AS line FROM events)"""
PAGEVIEWS = """pageviews AS (SELECT event_id, ts, 'http://foo.com/' || event_type AS url,
  CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status, 94000 + user_id % 7 AS zip, user_id FROM events)"""
PART_LINKS = "links AS (SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem)"
HIERARCHY = """hierarchy AS (
  SELECT o_orderkey * 8 + 4 AS src, o_custkey * 8 + 2 AS dst FROM orders UNION ALL
  SELECT c_custkey * 8 + 2, CAST(c_nationkey AS BIGINT) * 8 + 1 FROM customer UNION ALL
  SELECT s_suppkey * 8 + 3, CAST(s_nationkey AS BIGINT) * 8 + 1 FROM supplier UNION ALL
  SELECT CAST(n_nationkey AS BIGINT) * 8 + 1, CAST(n_regionkey AS BIGINT) * 8 FROM nation)"""
RATINGS = """ratings AS (SELECT o_custkey AS user, l_partkey AS item, avg(l_quantity) / 10 AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
BASKETS = """baskets AS (SELECT DISTINCT l_orderkey, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"""
PRIORITY_YEARS = """py AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS yr, o_orderpriority AS item FROM orders)"""
LABELLED = """labelled AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50 AS x0,
  l_extendedprice / 100000 AS x1, l_discount * 10 AS x2, l_tax * 10 AS x3,
  CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label FROM lineitem)"""
CELLS = """cells AS (SELECT 'row' || c_custkey AS row, unnest(['name', 'nation', 'segment']) AS qualifier,
  unnest([c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment]) AS value FROM customer)"""
NAIVE_BAYES = LABELLED + """, s AS (SELECT label, count(*) AS n, sum(x0) AS x0, sum(x1) AS x1, sum(x2) AS x2, sum(x3) AS x3 FROM labelled GROUP BY label),
  t AS (SELECT label, ln(n + 1) - ln((SELECT sum(n) FROM s) + (SELECT count(*) FROM s)) AS prior, ln(x0 + 1) - ln(x0 + x1 + x2 + x3 + 4) AS t0,
  ln(x1 + 1) - ln(x0 + x1 + x2 + x3 + 4) AS t1, ln(x2 + 1) - ln(x0 + x1 + x2 + x3 + 4) AS t2, ln(x3 + 1) - ln(x0 + x1 + x2 + x3 + 4) AS t3 FROM s)"""
