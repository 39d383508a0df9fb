"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL shares no structure with the Spark plans: the log parser's oracle is a
recursive CTE that folds each document line by line, the way the original
loop does, instead of window scans.
"""

from __future__ import annotations

# F-LOG lines from ``events`` (FIXTURES.md section 2), one per event.
F_LOG_LINES = """
flog AS (
  SELECT CAST(user_id AS VARCHAR) AS object_id, ts, event_id,
    CASE WHEN event_type = 'error' AND event_id % 6 = 5 THEN 'garbage line ' || event_id
    ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') || ' :: ' || (CASE
      WHEN event_type = 'signup' THEN 'COLUMN : C' || (event_id % 5) || ' Mask Started'
      WHEN event_type = 'purchase' THEN 'COLUMN : C' || (event_id % 5) || ' Mask Finished'
      WHEN event_type = 'view' AND event_id % 4 IN (0, 2) THEN 'TABLE : T' || (event_id % 3) || ' Mask Started'
      WHEN event_type = 'view' AND event_id % 4 = 1 THEN 'TABLE : T' || (event_id % 3) || ' Mask Ended'
      WHEN event_type = 'view' AND event_id % 4 = 3 THEN 'Post-mask operations'
      WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'CALCULATED the Row Count for table T = ' || (event_id % 1000)
      WHEN event_type = 'click' AND event_id % 4 = 1 THEN 'CALCULATED Distinct Row Count = ' || (event_id % 100)
      WHEN event_type = 'click' AND event_id % 4 = 2 THEN 'CONNECTED to db Schema: S' || (event_id % 2)
      WHEN event_type = 'click' AND event_id % 4 = 3 THEN 'MASKING HAS STARTED'
      WHEN event_type = 'error' AND event_id % 6 = 0 THEN 'ERROR in step ' || event_id
      WHEN event_type = 'error' AND event_id % 6 = 1 THEN 'Could not mask value'
      WHEN event_type = 'error' AND event_id % 6 = 2 THEN 'NO Data found'
      WHEN event_type = 'error' AND event_id % 12 = 3 THEN 'pymysql.err.OperationalError'
      WHEN event_type = 'error' AND event_id % 12 = 9 THEN 'lookup.php NOT FOUND'
      WHEN event_type = 'error' AND event_id % 6 = 4 THEN 'ERROR Could Not Enable trigger'
    END) END AS line
  FROM events
),
numbered AS (
  SELECT object_id, line,
    CAST(row_number() OVER (PARTITION BY object_id ORDER BY ts, event_id) - 1 AS INTEGER) AS line_no
  FROM flog
),
split AS (
  SELECT object_id, line_no,
    CASE WHEN position('::' IN line) > 0 THEN trim(substr(line, 1, position('::' IN line) - 1)) END AS lhs,
    CASE WHEN position('::' IN line) > 0 THEN trim(substr(line, position('::' IN line) + 2)) END AS msg
  FROM numbered
),
valid AS (
  SELECT object_id, line_no, try_strptime(lhs, '%d/%m/%Y %H:%M:%S') AS log_time, msg,
    string_split_regex(msg, '\\s+') AS toks
  FROM split
  WHERE msg IS NOT NULL AND try_strptime(lhs, '%d/%m/%Y %H:%M:%S') IS NOT NULL
)"""

# Rule flags per valid line, then a line-by-line fold per document.
MASK_FOLD = F_LOG_LINES + """,
fl AS (
  SELECT object_id, line_no, log_time AS ts, msg,
    row_number() OVER (PARTITION BY object_id ORDER BY line_no) AS rn,
    contains(msg, 'MASKING') AND contains(msg, 'HAS') AND contains(msg, 'STARTED') AS r1,
    contains(msg, 'CONNECTED') AND contains(msg, 'Schema:') AS r2,
    contains(msg, 'TABLE') AND contains(msg, 'Mask Started') AS r3,
    contains(msg, 'COLUMN') AND contains(msg, 'Mask Started') AS r4,
    contains(msg, 'CALCULATED') AND contains(msg, 'Row') AND contains(msg, 'for') AND contains(msg, '=') AS r5,
    contains(msg, 'NO Data') OR contains(msg, 'No Data') AS r6,
    contains(msg, 'CALCULATED') AND contains(msg, 'Distinct') AND contains(msg, 'Count') AND contains(msg, '=') AS r7,
    (((contains(msg, 'Could') AND contains(msg, 'not'))
       OR (contains(msg, 'Could') AND contains(msg, 'Not') AND contains(msg, 'Mask') AND contains(msg, 'Column')))
      AND NOT contains(msg, 'Could Not Enable'))
    OR (contains(msg, 'ERROR') AND NOT contains(msg, 'Could Not Enable'))
    OR contains(msg, 'pymysql.err')
    OR contains(msg, 'NOT FOUND') OR contains(msg, '.php') OR contains(msg, '.py') AS exc,
    contains(msg, 'COLUMN') AND contains(msg, 'Mask Finished') AS fin,
    (contains(msg, 'TABLE') AND contains(msg, 'Mask') AND contains(msg, 'Ended'))
    OR (contains(msg, 'MASKING') AND contains(msg, 'HAS') AND contains(msg, 'STARTED')) AS endc,
    toks[3] AS t2, toks[5] AS t4, toks[6] AS t5, toks[9] AS t8, len(toks) AS ntok
  FROM valid
),
fold(object_id, rn, cyc, sch, tbl, col, live, st, rws, dst, err, fk, fc, ft, status,
     emit, e_rws, e_dst, e_err, e_line, e_end) AS (
  SELECT object_id, CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(NULL AS VARCHAR), FALSE, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(NULL AS VARCHAR), FALSE, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
    CAST(NULL AS INTEGER), CAST(NULL AS TIMESTAMP)
  FROM (SELECT DISTINCT object_id FROM fl) d
  UNION ALL
  SELECT object_id, rn, c_cyc, c_sch, c_tbl, c_col,
    c_live AND NOT fin AND NOT fired,
    c_st,
    CASE WHEN fin OR fired THEN NULL ELSE c_rws END,
    CASE WHEN fin OR fired THEN NULL ELSE c_dst END,
    CASE WHEN fin OR fired THEN NULL ELSE c_err END,
    CASE WHEN fin THEN NULL ELSE c_fk END,
    CASE WHEN fin THEN NULL ELSE c_fc END,
    CASE WHEN fin THEN NULL ELSE c_ft END,
    CASE WHEN fired THEN 'Failed'
         WHEN fin AND c_fk = 'Exception' THEN
           CASE WHEN c_col IS NOT DISTINCT FROM c_fc AND c_tbl IS NOT DISTINCT FROM c_ft
                THEN 'Exception' ELSE 'Passed' END
         WHEN fin AND c_fk IS NULL AND c_col IS NOT NULL THEN 'Passed'
         ELSE status END,
    fired OR (fin AND (c_fk IS NOT NULL OR c_col IS NOT NULL)),
    c_rws, c_dst, c_err, line_no, ts
  FROM (
    SELECT y.*, (NOT y.fin AND y.c_live AND y.endc) AS fired FROM (
      SELECT s.object_id, f.rn, f.line_no, f.ts, f.fin, f.endc, s.status,
        CASE WHEN f.r1 THEN 1 ELSE s.cyc END AS c_cyc,
        CASE WHEN f.r2 THEN f.t4 ELSE s.sch END AS c_sch,
        CASE WHEN f.r3 THEN f.t2 ELSE s.tbl END AS c_tbl,
        CASE WHEN f.r4 THEN f.t2 ELSE s.col END AS c_col,
        f.r4 OR s.live AS c_live,
        CASE WHEN f.r4 THEN f.ts ELSE s.st END AS c_st,
        CASE WHEN f.r5 THEN f.t8 ELSE s.rws END AS c_rws,
        CASE WHEN f.r7 THEN f.t5 WHEN f.r6 THEN '0' ELSE s.dst END AS c_dst,
        CASE WHEN f.r6 OR f.exc THEN f.msg ELSE s.err END AS c_err,
        CASE WHEN f.exc THEN 'Exception' WHEN f.r6 THEN 'No Data' ELSE s.fk END AS c_fk,
        CASE WHEN f.exc OR f.r6 THEN (CASE WHEN f.r4 THEN f.t2 ELSE s.col END) ELSE s.fc END AS c_fc,
        CASE WHEN f.exc OR f.r6 THEN (CASE WHEN f.r3 THEN f.t2 ELSE s.tbl END) ELSE s.ft END AS c_ft
      FROM fold s JOIN fl f ON f.object_id = s.object_id AND f.rn = s.rn + 1
    ) y
  ) z
),
ops AS (
  SELECT object_id, e_line AS line_no, cyc AS cycle, sch AS schema, tbl AS "table",
    e_rws AS row_count, e_dst AS distinct_row_count, col AS "column", status,
    st AS start_time, e_end AS end_time,
    CASE WHEN st IS NOT NULL THEN CAST(epoch(e_end) - epoch(st) AS DOUBLE) END AS duration_secs,
    e_err AS error
  FROM fold WHERE emit
)"""

LOG_LINES = "WITH " + F_LOG_LINES + """
SELECT object_id, line_no, log_time, msg AS message, CAST(len(toks) AS INTEGER) AS n_tokens FROM valid"""

MASKING_OPS = "WITH RECURSIVE " + MASK_FOLD + """
SELECT object_id, line_no, cycle, schema, "table", row_count, distinct_row_count, "column", status,
  start_time, end_time, duration_secs,
  CASE WHEN duration_secs <> 0 THEN round(duration_secs / 60, 2) END AS duration_mins, error
FROM ops"""

# F10-F12 contract with a fixed processing stamp (see catalog.PROCESSED_TIME).
SILVER_BODY = """
SELECT CAST(coalesce(cycle, 0) AS INTEGER) AS cycle, schema, "table",
  CAST(coalesce(CAST(row_count AS DOUBLE), 0) AS REAL) AS row_count,
  CAST(coalesce(CAST(distinct_row_count AS DOUBLE), 0) AS REAL) AS distinct_row_count,
  "column", status,
  coalesce(strftime(start_time, '%Y-%m-%d %H:%M:%S'), '') AS start_time,
  coalesce(strftime(end_time, '%Y-%m-%d %H:%M:%S'), '') AS end_time,
  CAST(coalesce(duration_secs, 0) AS REAL) AS duration_secs,
  CAST(coalesce(CASE WHEN duration_secs <> 0 THEN round(duration_secs / 60, 2) END, 0) AS REAL) AS duration_mins,
  error, CAST(object_id AS INTEGER) AS object_id,
  '2024-02-01 00:00:00' AS processed_time, 'YourName' AS processed_by
FROM ops"""

MASKING_OPS_CONTRACT = "WITH RECURSIVE " + MASK_FOLD + SILVER_BODY

# F-CFG rows as the flattening must return them (round trip of the fixture).
CFG_ROWS = """
cfg AS (
  SELECT CAST(p_partkey // 13 AS INTEGER) AS object_id,
    'S' || CAST(p_partkey % 2 AS VARCHAR) AS schema, 'T' || CAST(p_partkey % 3 AS VARCHAR) AS "table",
    'C' || CAST(p_partkey % 5 AS VARCHAR) AS column_name, 'VARCHAR' AS data_type,
    CAST(p_size AS VARCHAR) AS data_length, p_brand AS pattern_name, p_type AS result,
    CASE WHEN p_partkey % 4 < 2 THEN p_name ELSE '' END AS lookup,
    CAST(p_partkey AS VARCHAR) AS parameter
  FROM part
)"""

CONFIG_FLATTEN = "WITH " + CFG_ROWS + " SELECT * FROM cfg"
CONFIG_NINE = "WITH " + CFG_ROWS + " SELECT * EXCLUDE (lookup) FROM cfg"
CONFIG_UNION = "WITH " + CFG_ROWS + """
SELECT * EXCLUDE (lookup) FROM cfg
UNION ALL BY NAME SELECT * FROM cfg"""
CONFIG_OBJECTS = "WITH " + CFG_ROWS + " SELECT count(DISTINCT object_id) AS n_objects FROM cfg"

SILVER_AND_CFG = "WITH RECURSIVE " + MASK_FOLD + ", silver AS (" + SILVER_BODY + "), " + CFG_ROWS

OPS_CONFIG_JOIN = SILVER_AND_CFG + """
SELECT s.*, c.schema AS config_schema, c."table" AS config_table, c.column_name, c.data_type,
  c.data_length, c.pattern_name, c.result, c.lookup, c.parameter
FROM silver s JOIN cfg c ON s.object_id = c.object_id"""

OPS_OWN_CONFIG = SILVER_AND_CFG + """
SELECT s.*, c.column_name, c.data_type, c.data_length, c.pattern_name, c.result, c.lookup, c.parameter
FROM silver s LEFT JOIN cfg c
  ON s.object_id = c.object_id AND s.schema = c.schema AND s."table" = c."table" AND s."column" = c.column_name"""

DATE_DIM = """
WITH b AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders),
d AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS "Date" FROM b)
SELECT "Date", CAST(year("Date") AS BIGINT) AS "Year", CAST(month("Date") AS BIGINT) AS "MonthNo",
  strftime("Date", '%B') AS "Month", CAST(quarter("Date") AS BIGINT) AS "QuarterNo",
  'Qtr ' || CAST(quarter("Date") AS VARCHAR) AS "Quarter", CAST(day("Date") AS BIGINT) AS "Day"
FROM d"""

FACT_BY_DATE = """
SELECT CAST(year(o.o_orderdate) AS BIGINT) AS "start_Year", CAST(quarter(o.o_orderdate) AS BIGINT) AS "start_QuarterNo",
  CAST(year(l.l_shipdate) AS BIGINT) AS "end_Year", CAST(quarter(l.l_shipdate) AS BIGINT) AS "end_QuarterNo",
  count(*) AS n_lines, sum(l.l_quantity) AS sum_qty, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY ALL"""

DATE_DRILLDOWN = """
WITH f AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS y, CAST(quarter(o_orderdate) AS BIGINT) AS q,
    CAST(month(o_orderdate) AS BIGINT) AS m, CAST(day(o_orderdate) AS BIGINT) AS d, o_totalprice
  FROM orders)
SELECT y AS "Year", q AS "QuarterNo", CASE WHEN q IS NOT NULL THEN 'Qtr ' || CAST(q AS VARCHAR) END AS "Quarter",
  m AS "MonthNo", CASE WHEN m IS NOT NULL THEN strftime(make_date(2000, CAST(m AS INTEGER), 1), '%B') END AS "Month",
  d AS "Day", CAST(grouping(y, q, m, d) AS INTEGER) AS level,
  count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM f GROUP BY ROLLUP (y, q, m, d)"""

DEFAULT_SUMS_GOLD = "WITH RECURSIVE " + MASK_FOLD + ", silver AS (" + SILVER_BODY + """)
SELECT schema, "table", status, sum(cycle) AS cycle, round(sum(row_count), 2) AS row_count,
  round(sum(distinct_row_count), 2) AS distinct_row_count, round(sum(duration_secs), 2) AS duration_secs,
  round(sum(duration_mins), 2) AS duration_mins, sum(object_id) AS object_id, count(*) AS n_ops
FROM silver GROUP BY ALL"""

DEFAULT_SUMS_V1 = "WITH RECURSIVE " + MASK_FOLD + """
SELECT status, sum(CAST(coalesce(CAST(row_count AS DOUBLE), 0) AS BIGINT)) AS row_count,
  sum(CAST(coalesce(CAST(distinct_row_count AS DOUBLE), 0) AS BIGINT)) AS distinct_row_count,
  sum(CAST(coalesce(duration_secs, 0) AS BIGINT)) AS "duration(s)",
  round(sum(coalesce(CASE WHEN duration_secs <> 0 THEN round(duration_secs / 60, 2) END, 0)), 2) AS "duration(min)",
  sum(CAST(coalesce(cycle, 0) AS BIGINT)) AS cycle, sum(CAST(line_no AS BIGINT)) AS line_number,
  count(*) AS n_ops
FROM ops GROUP BY ALL"""


MANIFEST_DOCUMENTS = """
SELECT CAST(p.page_id AS VARCHAR) AS object_id, p.html AS config, d.text AS masking_log,
  TIMESTAMP '2024-02-01 00:00:00' AS load_date
FROM pages p JOIN documents d ON d.doc_id = p.page_id"""

ACTIVITY_FEED = """
SELECT CAST(e.event_id AS VARCHAR) AS post_id, CAST(NULL AS VARCHAR) AS post_title,
  CAST(NULL AS VARCHAR) AS permalink, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS "time",
  CAST(e.user_id AS VARCHAR) AS user_id, c.c_name AS display_name, CAST(NULL AS VARCHAR) AS ip_address,
  e.event_type AS response_status, CAST(NULL AS VARCHAR) AS referer, printf('%.2f', e.value) AS time_spent,
  c.c_mktsegment AS city, CAST(NULL AS VARCHAR) AS user_email, CAST(NULL AS VARCHAR) AS username,
  CAST(NULL AS VARCHAR) AS post_slug, CAST(NULL AS VARCHAR) AS post_type, CAST(NULL AS VARCHAR) AS user_role
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey"""

# Linked feed pages: walked back from their ends, page by page.
_CHAINS = """
WITH RECURSIVE rec AS (SELECT event_id, event_id % 7 AS f, event_id // 70 AS k FROM events),
numbers AS (SELECT f, k, max(k) OVER (PARTITION BY f) AS last FROM (SELECT DISTINCT f, k FROM rec)),
page AS (
  SELECT f, k, 'https://feed.example/posts?cursor=' || md5(f || '-' || k) AS name,
    'https://feed.example/posts?cursor=' || md5(f || '-' || CASE WHEN k < last THEN k + 1 WHEN f = 6 THEN 0 END) AS next
  FROM numbers WHERE NOT (f = 5 AND k % 40 = 17)
),
walk AS (
  SELECT name, name AS end_page, 0 AS dist, next AS missing FROM page
  WHERE next IS NULL OR next NOT IN (SELECT name FROM page)
  UNION ALL
  SELECT p.name, w.end_page, w.dist + 1, w.missing FROM page p JOIN walk w ON p.next = w.name
),
chains AS (SELECT end_page, max(dist) AS far, arg_max(name, dist) AS chain FROM walk GROUP BY end_page),
ranked AS (
  SELECT w.name, c.chain, c.far - w.dist AS page_rank, w.missing,
    CASE WHEN w.missing IS NULL THEN 'complete' ELSE 'broken' END AS status
  FROM walk w JOIN chains c USING (end_page)
  UNION ALL
  SELECT name, min(name) OVER (PARTITION BY f), NULL, NULL, 'cyclic' FROM page
  WHERE name NOT IN (SELECT name FROM walk)
)"""

FEED_CHAIN_REPORT = _CHAINS + """
SELECT chain, status, missing, count(*) AS pages FROM ranked GROUP BY ALL"""

FEED_PAGE_CHAIN = _CHAINS + ", feed AS (" + ACTIVITY_FEED + """)
SELECT feed.*, r.chain, CAST(r.page_rank AS BIGINT) AS page_rank,
  CAST(row_number() OVER (PARTITION BY p.name ORDER BY rec.event_id) - 1 AS INTEGER) AS position
FROM feed JOIN rec ON feed.post_id = CAST(rec.event_id AS VARCHAR)
JOIN page p ON p.f = rec.f AND p.k = rec.k JOIN ranked r ON r.name = p.name"""

CSV_SELECTED = "WITH RECURSIVE " + MASK_FOLD + """
SELECT CAST(coalesce(cycle, 0) AS BIGINT) AS cycle, coalesce(schema, '') AS schema, coalesce("table", '') AS "table",
  CASE WHEN line_no % 97 = 7 THEN NULL ELSE CAST(coalesce(CAST(row_count AS DOUBLE), 0) AS BIGINT) END AS row_count,
  CAST(coalesce(CAST(distinct_row_count AS DOUBLE), 0) AS BIGINT) AS distinct_row_count,
  coalesce("column", '') AS "column", coalesce(status, '') AS status, start_time, end_time,
  CAST(coalesce(duration_secs, 0) AS BIGINT) AS "duration(s)",
  coalesce(CASE WHEN duration_secs <> 0 THEN round(duration_secs / 60, 2) END, 0) AS "duration(min)",
  coalesce(error, '') AS error, CAST(line_no AS BIGINT) AS line_number
FROM ops WHERE CAST(object_id AS BIGINT) % 2 = 0"""

GOLD_CONFORM = "WITH RECURSIVE " + MASK_FOLD + ", silver AS (" + SILVER_BODY + """)
SELECT cycle, left(schema, 8000) AS schema, left("table", 8000) AS "table", row_count, distinct_row_count,
  left("column", 8000) AS "column", left(status, 8000) AS status, left(start_time, 8000) AS start_time,
  left(end_time, 8000) AS end_time, duration_secs, duration_mins, left(error, 8000) AS error, object_id,
  left(processed_time, 8000) AS processed_time, left(processed_by, 8000) AS processed_by
FROM silver"""

GOLD_CONFIG_CONFORM = "WITH " + CFG_ROWS + """
SELECT object_id, left(schema, 8000) AS schema, left("table", 8000) AS "table", left(column_name, 8000) AS column_name,
  left(data_type, 8000) AS data_type, left(data_length, 8000) AS data_length,
  left(pattern_name, 8000) AS pattern_name, left(result, 8000) AS result, left(lookup, 8000) AS lookup,
  left(parameter, 8000) AS parameter
FROM cfg"""

# Config faults are classified here by DuckDB's own JSON functions (validity,
# value type at each level, required keys), not from the fault design.
CFG_FAULT_REASONS = """
cfg_el AS (
  SELECT p_partkey // 13 AS oid, 'S' || CAST(p_partkey % 2 AS VARCHAR) AS s,
    'T' || CAST(p_partkey % 3 AS VARCHAR) AS t, p_partkey AS k,
    CASE WHEN p_partkey % 4 < 2 THEN json_object('column_name', 'C' || CAST(p_partkey % 5 AS VARCHAR),
        'data_type', 'VARCHAR', 'data_length', CAST(p_size AS VARCHAR), 'pattern_name', p_brand,
        'Result', p_type, 'lookup', p_name, 'parameter', CAST(p_partkey AS VARCHAR))
      ELSE json_object('column_name', 'C' || CAST(p_partkey % 5 AS VARCHAR),
        'data_type', 'VARCHAR', 'data_length', CAST(p_size AS VARCHAR), 'pattern_name', p_brand,
        'Result', p_type, 'parameter', CAST(p_partkey AS VARCHAR)) END AS el
  FROM part
),
cfg_tab AS (SELECT oid, s, t, json_group_array(el) AS arr FROM cfg_el GROUP BY oid, s, t),
cfg_sch AS (SELECT oid, s, json_group_object(t, arr) AS tbls FROM cfg_tab GROUP BY oid, s),
cfg_doc AS (SELECT oid, CAST(json_group_object(s, tbls) AS VARCHAR) AS js FROM cfg_sch GROUP BY oid),
cfg_bad AS (
  SELECT oid, CASE oid % 7
      WHEN 1 THEN substr(js, 1, length(js) - 1)
      WHEN 2 THEN '[' || js || ']'
      WHEN 3 THEN replace(replace(js, '[', '{"x":['), ']', ']}')
      WHEN 4 THEN regexp_replace(js, ',"parameter":"[0-9]+"', '', 'g')
      WHEN 5 THEN js || ' x'
      WHEN 6 THEN NULL
      ELSE js END AS js
  FROM cfg_doc
),
cfg_valid AS (
  -- functions below only ever see valid JSON (DuckDB may evaluate before filtering)
  SELECT oid, js, CASE WHEN coalesce(json_valid(js), FALSE) THEN js ELSE 'null' END AS vjs FROM cfg_bad
),
cfg_top AS (
  SELECT oid, js, CASE WHEN json_type(vjs) = 'OBJECT' THEN vjs ELSE '{}' END AS ojs,
    coalesce(json_valid(js), FALSE) AND json_type(vjs) = 'OBJECT' AS top_ok
  FROM cfg_valid
),
cfg_s AS (
  SELECT oid, json_extract(ojs, '$."' || k1 || '"') AS sv
  FROM cfg_top, unnest(json_keys(ojs)) AS u(k1)
),
cfg_t AS (
  SELECT oid, sv, json_extract(sv, '$."' || k2 || '"') AS tv
  FROM cfg_s, unnest(CASE WHEN json_type(sv) = 'OBJECT' THEN json_keys(sv) ELSE [] END) AS u(k2)
),
cfg_e AS (
  SELECT oid, e FROM cfg_t, unnest(CASE WHEN json_type(tv) = 'ARRAY' THEN json_extract(tv, '$[*]') ELSE [] END) AS u(e)
),
cfg_shape_bad AS (
  SELECT oid FROM cfg_s WHERE json_type(sv) <> 'OBJECT'
  UNION SELECT oid FROM cfg_t WHERE json_type(tv) <> 'ARRAY'
  UNION SELECT oid FROM cfg_e WHERE json_type(e) NOT IN ('OBJECT', 'NULL')
),
cfg_key_bad AS (
  SELECT oid FROM cfg_e
  WHERE json_type(e) = 'NULL' OR NOT list_has_all(json_keys(e),
    ['column_name', 'data_type', 'data_length', 'pattern_name', 'Result', 'parameter'])
),
cfg_reason AS (
  SELECT oid, CASE
      WHEN js IS NULL THEN 'config is null'
      WHEN NOT top_ok OR oid IN (SELECT oid FROM cfg_shape_bad) THEN 'config is not JSON of the expected shape'
      WHEN oid IN (SELECT oid FROM cfg_key_bad) THEN 'config element lacks a required key'
    END AS reason
  FROM cfg_top
)"""

# F-BAD logs: the F-LOG lines with the same appended lines and id changes as
# the Spark fixture; the reasons come from the fold and DuckDB's own tests.
_BAD_FLOG = """
flog AS (
  SELECT CASE WHEN CAST(object_id AS BIGINT) % 10 = 4 THEN 'obj-' || object_id ELSE object_id END AS object_id,
    ts, event_id, line
  FROM flog_events WHERE CAST(object_id AS BIGINT) % 10 <> 3
  UNION ALL
  SELECT CAST(u.user_id AS VARCHAR), TIMESTAMP '2024-02-01 00:00:00' + INTERVAL (x.i) SECOND, 1000000000 + x.i, x.line
  FROM (SELECT DISTINCT user_id FROM events) u,
    (VALUES (1, 0, '01/02/2024 00:00:00 :: CALCULATED Row for = x'),
            (2, 1, '01/02/2024 00:00:01 :: COLUMN : Q Mask Started'),
            (2, 2, '01/02/2024 00:00:02 :: CALCULATED Distinct Row Count = 1,000'),
            (2, 3, '01/02/2024 00:00:03 :: COLUMN : Q Mask Finished')) AS x(fault, i, line)
  WHERE u.user_id % 10 = x.fault
),"""
BAD_MASK_FOLD = MASK_FOLD.replace("\nflog AS (", "\nflog_events AS (", 1).replace(
    "\nnumbered AS (", _BAD_FLOG + "\nnumbered AS (", 1)

QUARANTINE = "WITH RECURSIVE " + BAD_MASK_FOLD + """,
short_docs AS (
  SELECT DISTINCT object_id FROM fl
  WHERE (r2 AND ntok < 5) OR (r3 AND ntok < 3) OR (r4 AND ntok < 3) OR (r5 AND ntok < 9) OR (r7 AND ntok < 6)
),
bad_count_docs AS (
  SELECT DISTINCT object_id FROM ops
  WHERE (row_count IS NOT NULL AND TRY_CAST(row_count AS DOUBLE) IS NULL)
     OR (distinct_row_count IS NOT NULL AND TRY_CAST(distinct_row_count AS DOUBLE) IS NULL)
),
op_docs AS (SELECT DISTINCT object_id FROM ops),
log_reason AS (
  SELECT d.object_id, CASE
      WHEN d.object_id IN (SELECT object_id FROM short_docs) THEN 'line too short for its token'
      WHEN d.object_id IN (SELECT object_id FROM bad_count_docs) THEN 'count is not a number'
      WHEN d.object_id IN (SELECT object_id FROM op_docs) AND TRY_CAST(d.object_id AS INTEGER) IS NULL
        THEN 'object_id is not an integer'
    END AS reason
  FROM (SELECT DISTINCT object_id FROM flog) d
),""" + CFG_FAULT_REASONS + """
SELECT 'log' AS source, object_id, reason FROM log_reason WHERE reason IS NOT NULL
UNION ALL
SELECT 'log' AS source, CAST(user_id AS VARCHAR) AS object_id, 'log is null' AS reason
FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 10 = 3
UNION ALL
SELECT 'config' AS source, CAST(oid AS VARCHAR) AS object_id, reason FROM cfg_reason WHERE reason IS NOT NULL"""

_BAD_DOC_TESTS = """,
short_docs AS (
  SELECT DISTINCT object_id FROM fl
  WHERE (r2 AND ntok < 5) OR (r3 AND ntok < 3) OR (r4 AND ntok < 3) OR (r5 AND ntok < 9) OR (r7 AND ntok < 6)
),
bad_count_docs AS (
  SELECT DISTINCT object_id FROM ops
  WHERE (row_count IS NOT NULL AND TRY_CAST(row_count AS DOUBLE) IS NULL)
     OR (distinct_row_count IS NOT NULL AND TRY_CAST(distinct_row_count AS DOUBLE) IS NULL)
),
good_ops AS (
  SELECT * FROM ops
  WHERE object_id NOT IN (SELECT object_id FROM short_docs)
    AND object_id NOT IN (SELECT object_id FROM bad_count_docs)
    AND TRY_CAST(object_id AS INTEGER) IS NOT NULL
)"""

# the good documents of the faulty input, parsed by the same fold
QUARANTINE_SURVIVORS = ("WITH RECURSIVE " + BAD_MASK_FOLD + _BAD_DOC_TESTS
                        + SILVER_BODY.replace("\nFROM ops", "\nFROM good_ops"))

CONFIG_SURVIVORS = ("WITH " + CFG_ROWS + "," + CFG_FAULT_REASONS
                    + " SELECT * FROM cfg WHERE object_id IN (SELECT oid FROM cfg_reason WHERE reason IS NULL)")

TABLE_LIFECYCLE = MASKING_OPS_CONTRACT + " WHERE CAST(object_id AS BIGINT) IN (SELECT p_partkey // 13 FROM part)"


DEFAULT_SUMS_CONFIG = "WITH " + CFG_ROWS + """
SELECT schema, "table", sum(object_id) AS object_id, count(*) AS n_columns FROM cfg GROUP BY ALL"""

OPS_BY_DATE = "WITH RECURSIVE " + MASK_FOLD + """
SELECT CAST(year(start_time) AS BIGINT) AS "start_Year", CAST(month(start_time) AS BIGINT) AS "start_MonthNo",
  strftime(start_time, '%B') AS "start_Month",
  CAST(year(end_time) AS BIGINT) AS "end_Year", CAST(month(end_time) AS BIGINT) AS "end_MonthNo",
  strftime(end_time, '%B') AS "end_Month",
  count(*) AS n_ops, sum(CAST(coalesce(duration_secs, 0) AS BIGINT)) AS duration_secs
FROM ops GROUP BY ALL"""

ORACLE_SQL = {
    "log_lines": LOG_LINES,
    "masking_ops": MASKING_OPS,
    "masking_ops_contract": MASKING_OPS_CONTRACT,
    "masking_ops_landed_lines": MASKING_OPS_CONTRACT,
    "config_flatten": CONFIG_FLATTEN,
    "config_nine_columns": CONFIG_NINE,
    "config_union": CONFIG_UNION,
    "config_objects": CONFIG_OBJECTS,
    "ops_config_join": OPS_CONFIG_JOIN,
    "ops_own_config": OPS_OWN_CONFIG,
    "date_dim": DATE_DIM,
    "fact_by_date": FACT_BY_DATE,
    "date_drilldown": DATE_DRILLDOWN,
    "default_sums_gold": DEFAULT_SUMS_GOLD,
    "default_sums_v1": DEFAULT_SUMS_V1,
    "default_sums_config": DEFAULT_SUMS_CONFIG,
    "ops_by_date": OPS_BY_DATE,
    "manifest_documents": MANIFEST_DOCUMENTS,
    "activity_feed": ACTIVITY_FEED,
    "feed_page_chain": FEED_PAGE_CHAIN,
    "feed_chain_report": FEED_CHAIN_REPORT,
    "csv_selected": CSV_SELECTED,
    "gold_conform": GOLD_CONFORM,
    "gold_config_conform": GOLD_CONFIG_CONFORM,
    "quarantine": QUARANTINE,
    "quarantine_survivors": QUARANTINE_SURVIVORS,
    "config_survivors": CONFIG_SURVIVORS,
    "table_lifecycle": TABLE_LIFECYCLE,
}

# The lifecycle's other tables, read back after every stage was written.
ORACLE_SQL["lifecycle_join"] = ORACLE_SQL["ops_config_join"]
ORACLE_SQL["lifecycle_feed"] = ORACLE_SQL["feed_page_files"] = ORACLE_SQL["activity_feed"]
ORACLE_SQL["feed_page_arrays"] = ORACLE_SQL["activity_feed"]
ORACLE_SQL["masking_ops_log_files"] = ORACLE_SQL["masking_ops_contract"]
ORACLE_SQL["lifecycle_gold_config"] = (
    f"SELECT * FROM ({ORACLE_SQL['gold_config_conform']}) WHERE object_id IN (SELECT user_id FROM events)")


def _by_every_column(rows: str, grouping: list[str], sums: str) -> str:
    """Sums of ``rows`` by GROUPING SETS of one column each."""
    quoted = [f'"{c}"' for c in grouping]
    name = " ".join(f"WHEN grouping({q}) = 0 THEN '{c}'" for c, q in zip(grouping, quoted))
    value = " ".join(f"WHEN grouping({q}) = 0 THEN CAST({q} AS VARCHAR)" for q in quoted)
    return (f"{rows} SELECT CASE {name} END AS group_column, CASE {value} END AS group_value, {sums}, count(*) AS n_ops FROM facts "
            f"GROUP BY GROUPING SETS ({', '.join(f'({q})' for q in quoted)})")


_GOLD_SUMS = """sum(cycle) AS cycle, round(sum(row_count), 2) AS row_count, round(sum(distinct_row_count), 2) AS distinct_row_count,
  round(sum(duration_secs), 2) AS duration_secs, round(sum(duration_mins), 2) AS duration_mins, sum(object_id) AS object_id"""
ORACLE_SQL["default_sums_by_column"] = _by_every_column(
    "WITH RECURSIVE " + MASK_FOLD + ", facts AS (" + SILVER_BODY + ")",
    ["schema", "table", "column", "status", "start_time", "end_time", "error", "processed_time", "processed_by"], _GOLD_SUMS)
ORACLE_SQL["default_sums_v1_by_column"] = _by_every_column(
    "WITH RECURSIVE " + MASK_FOLD + """, facts AS (SELECT schema, "table", "column", status, start_time, end_time, error,
      CAST(coalesce(CAST(row_count AS DOUBLE), 0) AS BIGINT) AS row_count,
      CAST(coalesce(CAST(distinct_row_count AS DOUBLE), 0) AS BIGINT) AS distinct_row_count,
      CAST(coalesce(duration_secs, 0) AS BIGINT) AS secs,
      coalesce(CASE WHEN duration_secs <> 0 THEN round(duration_secs / 60, 2) END, 0) AS mins,
      CAST(coalesce(cycle, 0) AS BIGINT) AS cycle, CAST(line_no AS BIGINT) AS line_number FROM ops)""",
    ["schema", "table", "column", "status", "start_time", "end_time", "error"],
    """sum(row_count) AS row_count, sum(distinct_row_count) AS distinct_row_count, sum(secs) AS "duration(s)",
  round(sum(mins), 2) AS "duration(min)", sum(cycle) AS cycle, sum(line_number) AS line_number""")

# The materialised join, summed.
_JOINED = "WITH joined AS (" + OPS_CONFIG_JOIN + ") SELECT {by}, " + _GOLD_SUMS + ", count(*) AS n_pairs FROM joined GROUP BY ALL"
ORACLE_SQL["join_sums"] = _JOINED.format(by='schema, "table", status')
ORACLE_SQL["join_sums_by_pattern"] = _JOINED.format(by="status, pattern_name AS config_pattern_name")
ORACLE_SQL["repeatable_batches"] = (
    f"SELECT *, 'load-' || CAST(object_id % 3 AS VARCHAR) AS batch_id FROM ({ORACLE_SQL['table_lifecycle']})")

ORACLE_SQL["own_config_bucketed"] = OPS_OWN_CONFIG
ORACLE_SQL["config_join_bucketed"] = OPS_CONFIG_JOIN
ORACLE_SQL["drilldown_by_loads"] = f'SELECT "Year", "QuarterNo", "MonthNo", "Day", level, n_orders, total_price FROM ({DATE_DRILLDOWN})'
ORACLE_SQL["quarter_drilldown"] = DATE_DRILLDOWN.replace(
    "FROM orders)", "FROM orders WHERE year(o_orderdate) = 1995 AND quarter(o_orderdate) = 1)")
# An object comes in the load of its number, and every third one in the next load again.
ORACLE_SQL["objects_over_loads"] = "WITH " + CFG_ROWS + """,
came AS (
  SELECT object_id, object_id % 4 AS k FROM cfg
  UNION ALL SELECT object_id, (object_id % 4 + 1) % 4 FROM cfg WHERE object_id % 3 = 0
)
SELECT 'load-' || l.k AS load_id, count(DISTINCT c.object_id) AS n_objects
FROM (SELECT unnest(range(4)) AS k) l JOIN came c ON c.k <= l.k GROUP BY l.k"""
ORACLE_SQL["masking_ops_growing"] = MASKING_OPS_CONTRACT
ORACLE_SQL["manifest_files"] = MANIFEST_DOCUMENTS
