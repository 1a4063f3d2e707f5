"""SQL that must return the same rows as the query of the same name."""

from __future__ import annotations

FEEDS = """
WITH marks AS (SELECT o_custkey, max(o_orderdate) AS mark FROM orders GROUP BY o_custkey),
feeds AS (
  SELECT c_name AS table_name, c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'full' WHEN 'MACHINERY' THEN 'Incremental'
      ELSE 'INCREMENTAL' END AS load_type,
    strftime(mark, '%Y-%m-%d %H:%M:%S') AS ingest_column,
    'o_orderdate' AS source_dt_col,
    CASE WHEN c_nationkey % 5 = 0 THEN 'o_orderkey'
      WHEN c_nationkey % 5 = 1
        THEN ' o_custkey |' || chr(9) || ' o_orderkey ' || chr(10) || '| o_custkey'
      WHEN c_nationkey % 5 = 2 THEN ''
      WHEN c_nationkey % 5 = 3 THEN '|o_custkey|| o_orderdate|'
      WHEN c_custkey % 2 = 0 THEN 'None' END AS primary_keys,
    lpad(CAST(c_custkey % 3 AS VARCHAR), 2, '0') AS process_number
  FROM customer LEFT JOIN marks ON c_custkey = o_custkey)
"""

TWO_DAYS_OF_ORDERS = """
WITH t AS (
  SELECT *, TIMESTAMP '2026-01-01 03:00:00' AS _ingestion_time,
    '2026' AS year, '01' AS month, '01' AS day
  FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01 00:00:00'),
s AS (
  SELECT *, TIMESTAMP '2026-01-02 03:00:00' AS _ingestion_time,
    '2026' AS year, '01' AS month, '02' AS day
  FROM orders WHERE o_orderdate > TIMESTAMP '1999-07-01 00:00:00')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
"""

LATEST_LINES = """
  SELECT * FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem l {where}) x
  WHERE rn = 1
"""

ORACLES: dict[str, str] = {
    "control_lookup": FEEDS
    + """
SELECT table_name, upper(load_type) AS load_type, ingest_column, source_dt_col
FROM feeds WHERE table_name = 'Customer#000000001'
""",
    "control_ready": FEEDS
    + "SELECT table_name FROM feeds WHERE process_number = '02'",
    "key_list": FEEDS
    + """
SELECT table_name, pos, key_col FROM (
  SELECT table_name, unnest(ks) AS key_col, CAST(generate_subscripts(ks, 1) AS INTEGER) AS pos
  FROM (
    SELECT table_name, list_filter(
      list_transform(string_split(primary_keys, '|'), lambda k: trim(k, ' ' || chr(9) || chr(10))),
      lambda k: k <> '') AS ks
    FROM feeds WHERE primary_keys <> 'None') a) b
""",
    "status_advance": FEEDS
    + """
SELECT table_name, CASE WHEN table_name = 'Customer#000000001' AND process_number = '01'
  THEN '02' ELSE process_number END AS process_number
FROM feeds
""",
    "status_reset": FEEDS
    + """
SELECT table_name, CASE WHEN upper(load_type) = 'FULL' AND process_number = '02'
  THEN '00' ELSE process_number END AS process_number
FROM feeds
""",
    "extract_full": "SELECT * FROM customer",
    "extract_first_run": "SELECT * FROM lineitem",
    "extract_incremental": """
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'
""",
    "next_watermark": """
SELECT 'orders' AS table_name, max(o_orderdate) AS next_mark
FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'
""",
    "bronze_enrich": """
SELECT event_id, event_type, ts AS _ingestion_time, CAST(year(ts) AS VARCHAR) AS year,
  lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month,
  lpad(CAST(dayofmonth(ts) AS VARCHAR), 2, '0') AS day
FROM events
""",
    "bronze_append": """
SELECT event_id, event_type FROM events WHERE ts <= TIMESTAMP '2024-01-10 00:00:00'
UNION ALL
SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00'
""",
    "bronze_overwrite_day": """
SELECT event_id, CAST(dayofmonth(ts) AS INTEGER) AS d, 'old' AS tag
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15'
UNION ALL
SELECT event_id, CAST(15 AS INTEGER) AS d, 'new' AS tag
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' AND event_type = 'click'
""",
    "bronze_day_slice": """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""",
    "silver_create": """
SELECT event_id, event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
  strftime(ts, '%d') AS day
FROM events
""",
    "silver_create_null_partition": """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done
FROM orders
""",
    "silver_overwrite_partitions": """
SELECT l_orderkey, l_linenumber, l_shipdate, 'old' AS tag
FROM lineitem WHERE year(l_shipdate) < 2000
UNION ALL
SELECT l_orderkey, l_linenumber, l_shipdate, 'new' AS tag
FROM lineitem WHERE year(l_shipdate) >= 2000
""",
    "silver_append": """
SELECT event_id, value, '01' AS day FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL
SELECT event_id, value, '02' AS day FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""",
    "silver_upsert_single": """
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'),
s AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_orderdate
  FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00')
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM s
""",
    "silver_upsert_composite": """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id % 3 <> 0),
s AS (
  SELECT conv_id, turn, 'updated' AS role, text FROM conversations
  WHERE conv_id % 2 = 0 OR conv_id % 3 = 0)
SELECT * FROM t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)
UNION ALL SELECT * FROM s
""",
    "silver_upsert_null_keys": """
WITH t AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k, c_name, 't' AS tag
  FROM customer),
s AS (
  SELECT CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey END AS k, c_name, 's' AS tag
  FROM customer WHERE c_custkey % 4 = 0)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)
UNION ALL SELECT * FROM s
""",
    "silver_merge_null_keys": """
WITH t AS (
  SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k, c_name, c_nationkey,
    't' AS tag
  FROM customer),
s AS (
  SELECT CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey END AS k, c_name, c_nationkey,
    's' AS tag
  FROM customer WHERE c_custkey % 4 = 0)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)
UNION ALL SELECT * FROM s
""",
    "silver_upsert_repeated_target": """
WITH t AS (
  SELECT l_orderkey AS k, l_shipdate AS at, l_linestatus AS status FROM lineitem),
s AS (
  SELECT o_orderkey AS k, o_orderdate AS at, 'U' AS status
  FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00')
SELECT t.k, CASE WHEN s.k IS NULL THEN t.at ELSE s.at END AS at,
  CASE WHEN s.k IS NULL THEN t.status ELSE s.status END AS status
FROM t LEFT JOIN s ON s.k = t.k
UNION ALL
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)
""",
    "merge_duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "dedupe_latest": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM ("
    + LATEST_LINES.format(where="")
    + ") y",
    "ingest_curate_orders": TWO_DAYS_OF_ORDERS,
    "ingest_curate_customer_full": """
SELECT c_custkey, c_name, c_acctbal, '2026' AS year, '01' AS month, '01' AS day
FROM customer
UNION ALL
SELECT c_custkey, c_name, 0.0::DOUBLE AS c_acctbal, '2026' AS year, '01' AS month, '02' AS day
FROM customer WHERE c_acctbal < 0
""",
    "ingest_curate_orders_three_runs": """
SELECT o_orderkey, o_custkey, o_orderdate,
  CASE WHEN o_orderdate > TIMESTAMP '2000-01-01 00:00:00' THEN '3'
    WHEN o_orderdate > TIMESTAMP '1996-01-01 00:00:00' THEN '2' ELSE o_orderstatus
    END AS o_orderstatus,
  CASE WHEN o_orderdate > TIMESTAMP '2000-01-01 00:00:00' THEN '03'
    WHEN o_orderdate > TIMESTAMP '1996-01-01 00:00:00' THEN '02' ELSE '01' END AS day
FROM orders
""",
    "ingest_curate_customer_replace": """
SELECT c_custkey, c_name, c_acctbal, '02' AS day FROM customer
""",
    "ingest_curate_events_no_key": """
SELECT event_id, event_type, '01' AS day FROM events
UNION ALL
SELECT event_id, event_type, '02' AS day
FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""",
    "ingest_curate_lineitem_dedupe": "WITH t AS ("
    + LATEST_LINES.format(where="")
    + "), s AS ("
    + LATEST_LINES.format(where="WHERE l_shipdate > TIMESTAMP '1998-01-01 00:00:00'")
    + """)
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_linestatus, '01' AS day
FROM t WHERE NOT EXISTS (SELECT 1 FROM s
  WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, 'U' AS l_linestatus, '02' AS day
FROM s
""",
    "gold_stage": "SELECT * FROM orders",
    "gold_publish": """
SELECT 'customer' AS table_name, count(*) AS n_rows, '00' AS process_number FROM customer
UNION ALL
SELECT 'orders' AS table_name, count(*) AS n_rows, '00' AS process_number FROM orders
""",
    "gold_publish_twice": TWO_DAYS_OF_ORDERS,
}
