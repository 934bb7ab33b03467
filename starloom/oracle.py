"""For each query the same result in SQL over the provided tables."""

from __future__ import annotations

TS = "TIMESTAMP '2024-06-01 00:00:00'"
EARLIER = "TIMESTAMP '2022-01-01 00:00:00'"
EARLIEST = "TIMESTAMP '2020-01-01 00:00:00'"
OPEN_END = "TIMESTAMP '2999-12-31 00:00:00'"

GAPS = """
gaps AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
         NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment
  FROM customer)
"""

PART_GAPS = "part_gaps AS (SELECT p_brand, NULLIF(p_type, 'PROMO') AS p_type, p_retailprice FROM part)"

UPDATE = """
known AS (SELECT * FROM customer WHERE c_acctbal >= 0),
upd AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS c_acctbal,
         lower(c_mktsegment) AS c_mktsegment
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
"""

HISTORY = f"""
history AS (
  SELECT c_custkey, c_name, c_mktsegment, {EARLIER} AS effective_date, {OPEN_END} AS end_date, TRUE AS is_current
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT c_custkey, c_name, 'NONE', {EARLIEST}, {EARLIER}, FALSE FROM customer WHERE c_acctbal > 5000)
"""

UPSERTED = f"""
{HISTORY},
batch AS (
  SELECT CASE WHEN c_acctbal >= -900 THEN c_custkey END AS c_custkey, upper(c_name) AS c_name,
         CASE WHEN c_acctbal BETWEEN 1000 AND 4000 THEN 'MOVED'
              WHEN c_acctbal < 9000 THEN c_mktsegment END AS c_mktsegment
  FROM customer),
judged AS (
  SELECT b.*, h.c_custkey IS NOT NULL AS has_open,
         h.c_custkey IS NOT NULL AND b.c_mktsegment IS DISTINCT FROM h.c_mktsegment AS changed
  FROM batch b LEFT JOIN history h ON b.c_custkey = h.c_custkey AND h.is_current),
closed AS (SELECT DISTINCT c_custkey FROM judged WHERE changed),
upserted AS (
  SELECT h.c_custkey, h.c_name, h.c_mktsegment, h.effective_date,
         CASE WHEN h.is_current AND c.c_custkey IS NOT NULL THEN {TS} ELSE h.end_date END AS end_date,
         h.is_current AND c.c_custkey IS NULL AS is_current
  FROM history h LEFT JOIN closed c ON h.c_custkey = c.c_custkey
  UNION ALL
  SELECT c_custkey, c_name, c_mktsegment, {TS}, {OPEN_END}, TRUE FROM judged WHERE NOT has_open OR changed)
"""


CHAINED = f"""
first_event AS (
  SELECT user_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM events)
  WHERE rn = 1 AND value < 100),
incoming AS (
  SELECT CASE WHEN NOT (event_type = 'error' AND value > 400) THEN user_id END AS user_id, event_type, value, ts
  FROM events),
first_change AS (
  SELECT b.user_id, min(b.ts) AS ts FROM incoming b JOIN first_event e ON b.user_id = e.user_id
  WHERE b.event_type IS DISTINCT FROM e.event_type GROUP BY b.user_id),
inserted AS (
  SELECT b.* FROM incoming b LEFT JOIN first_event e ON b.user_id = e.user_id LEFT JOIN first_change f ON b.user_id = f.user_id
  WHERE e.user_id IS NULL OR b.ts >= f.ts),
chained AS (
  SELECT e.user_id, e.event_type, e.value, {EARLIER} AS effective_date,
         CASE WHEN f.user_id IS NOT NULL THEN {TS} ELSE {OPEN_END} END::VARCHAR AS end_date,
         f.user_id IS NULL AS is_current
  FROM first_event e LEFT JOIN first_change f ON e.user_id = f.user_id
  UNION ALL
  SELECT user_id, event_type, value, {TS}, CASE WHEN last THEN {OPEN_END} ELSE {TS} END::VARCHAR, last
  FROM (SELECT *, user_id IS NULL OR row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 AS last FROM inserted))
"""



def dims(customers: str = "customer") -> str:
    return f"""
dim_customer AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_mktsegment FROM {customers}),
dim_supplier AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey FROM supplier),
dim_part_type AS (
  SELECT row_number() OVER (ORDER BY p_brand, p_type) AS part_type_key, p_brand, p_type
  FROM (SELECT DISTINCT p_brand, p_type FROM part)),
dim_period AS (
  SELECT row_number() OVER (ORDER BY order_year, order_quarter, o_orderpriority, o_orderstatus) AS period_key, *
  FROM (SELECT DISTINCT year(o_orderdate)::BIGINT AS order_year, quarter(o_orderdate)::BIGINT AS order_quarter,
               o_orderpriority, o_orderstatus FROM orders)),
bound AS (
  SELECT customer_key, supplier_key, part_type_key, period_key, l_orderkey, l_linenumber, l_quantity,
         l_extendedprice, NULLIF(l_returnflag, 'N') AS returned,
         CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END::BIGINT AS returned_flag,
         o_orderdate, order_year, c_mktsegment
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN dim_customer ON o_custkey = c_custkey
  JOIN dim_supplier ON l_suppkey = s_suppkey
  JOIN dim_part_type d ON part.p_brand = d.p_brand AND part.p_type = d.p_type
  JOIN dim_period t ON year(o_orderdate) = t.order_year AND quarter(o_orderdate) = t.order_quarter
    AND orders.o_orderpriority = t.o_orderpriority AND orders.o_orderstatus = t.o_orderstatus)
"""


FACT_ORDER = (
    "l_orderkey, l_linenumber, customer_key, supplier_key, part_type_key, period_key, l_quantity, "
    "l_extendedprice, returned NULLS FIRST"
)
FACT_COLUMNS = (
    "customer_key, supplier_key, part_type_key, period_key, l_orderkey, l_linenumber, l_quantity, "
    "l_extendedprice, returned, returned_flag"
)

LOADS = f"""
{dims()},
first_load AS (SELECT * FROM bound WHERE o_orderdate < TIMESTAMP '1999-01-01'),
second_load AS (SELECT * FROM bound WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
fresh AS (
  SELECT * FROM second_load s WHERE NOT EXISTS (
    SELECT 1 FROM first_load f WHERE f.customer_key = s.customer_key AND f.l_orderkey = s.l_orderkey
      AND f.l_linenumber = s.l_linenumber))
"""

RAW_LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, NULLIF(l_returnflag, 'N') AS l_returnflag
  FROM lineitem),
raw AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_discount > 0.05),
uniq AS (SELECT DISTINCT * FROM raw),
present AS (SELECT * FROM uniq WHERE l_returnflag IS NOT NULL),
stats AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM present),
usual AS (SELECT present.* FROM present, stats WHERE abs((l_extendedprice - m) / s) < 1.5)
"""

RUNS = """
runs AS (
  SELECT CASE WHEN count(*) > 2 THEN 'silver' ELSE 'bronze' END AS layer, 'user_' || user_id AS table_name,
         'events' AS source, min(ts) AS start_time, max(ts) AS end_time,
         CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'failed' ELSE 'success' END AS status,
         count(*) AS rows_in, count(*) FILTER (event_type <> 'error') AS rows_out,
         count(*) AS transformations, count(*) FILTER (event_type = 'error') AS errors
  FROM events GROUP BY user_id, ts::DATE)
"""

SUITE = """
checks(position, "check", checked, passed, threshold, actual, duplicate_count, missing_keys, message_count) AS (
  SELECT 1, 'row_count', 'customer', count(*) > 10, 10, count(*)::VARCHAR, NULL::BIGINT, NULL::BIGINT,
         CASE WHEN count(*) > 10 THEN 0 ELSE 1 END FROM customer
  UNION ALL
  SELECT 2, 'null_percentage', 'customer', v = 0, NULL, NULL, NULL, NULL, v FROM (
    SELECT (avg(CASE WHEN c_custkey IS NULL THEN 1 ELSE 0 END) > 0)::INT
         + (avg(CASE WHEN c_acctbal IS NULL THEN 1 ELSE 0 END) > 0.25)::INT
         + (avg(CASE WHEN c_mktsegment IS NULL THEN 1 ELSE 0 END) > 0)::INT AS v FROM gaps)
  UNION ALL
  SELECT 3, 'data_type', 'customer', min(typeof(c_custkey)) = 'BIGINT', NULL, 'bigint', NULL, NULL, 0 FROM customer
  UNION ALL
  SELECT 4, 'data_type', 'customer', min(typeof(c_acctbal)) = 'DOUBLE', NULL, 'double', NULL, NULL, 0 FROM customer
  UNION ALL
  SELECT 5, 'data_type', 'customer', min(typeof(c_mktsegment)) = 'VARCHAR', NULL, 'string', NULL, NULL, 0 FROM customer
  UNION ALL
  SELECT 6, 'duplicate_keys', 'customer', count(*) = 0, NULL, NULL, coalesce(sum(n), 0), NULL,
         CASE WHEN count(*) = 0 THEN 0 ELSE 1 END
  FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1)
  UNION ALL
  SELECT 7, 'row_count', 'orders', count(*) > 100, 100, count(*)::VARCHAR, NULL, NULL,
         CASE WHEN count(*) > 100 THEN 0 ELSE 1 END FROM orders
  UNION ALL
  SELECT 8, 'null_percentage', 'orders', v = 0, NULL, NULL, NULL, NULL, v FROM (
    SELECT (count(*) > count(o_orderkey))::INT + (count(*) > count(o_custkey))::INT
         + (count(*) > count(o_orderstatus))::INT + (count(*) > count(o_totalprice))::INT
         + (count(*) > count(o_orderdate))::INT + (count(*) > count(o_orderpriority))::INT AS v FROM orders)
  UNION ALL
  SELECT 9, 'duplicate_keys', 'orders', count(*) = 0, NULL, NULL, coalesce(sum(n), 0), NULL,
         CASE WHEN count(*) = 0 THEN 0 ELSE 1 END
  FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL
  SELECT 10, 'data_type', 'orders', min(typeof(o_orderkey)) = 'BIGINT', NULL, 'bigint', NULL, NULL, 0 FROM orders
  UNION ALL
  SELECT 11, 'data_type', 'orders', FALSE, NULL, NULL, NULL, NULL, 1
  UNION ALL
  SELECT 12, 'duplicate_keys', 'lineitem', count(*) = 0, NULL, NULL, coalesce(sum(n), 0), NULL,
         CASE WHEN count(*) = 0 THEN 0 ELSE 1 END
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL
  SELECT 13, 'referential_integrity', 'lineitem to orders', count(DISTINCT l_orderkey) = 0, NULL, NULL, NULL,
         count(DISTINCT l_orderkey), CASE WHEN count(l_orderkey) = 0 THEN 0 ELSE 1 END
  FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL
  SELECT 14, 'referential_integrity', 'orders to customer', count(DISTINCT o_custkey) = 0, NULL, NULL, NULL,
         count(DISTINCT o_custkey), CASE WHEN count(o_custkey) = 0 THEN 0 ELSE 1 END
  FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL
  SELECT 15, 'referential_integrity', 'documents to labels', count(DISTINCT doc_id) = 0, NULL, NULL, NULL,
         count(DISTINCT doc_id), CASE WHEN count(doc_id) = 0 THEN 0 ELSE 1 END
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
"""


def profile(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count(*) AS row_count, "
        f"count(*) - count({c}) AS missing_count, count(DISTINCT {c}) AS distinct_count FROM {table}"
        for c, t in columns.items()
    )


ORACLE: dict[str, str] = {
    "q01_ingest_stamp": f"""
SELECT *, {TS} AS _ingestion_timestamp, 'raw_ingestion' AS _source_system FROM supplier""",
    "q02_standard_names": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "q03_type_coercion": """
SELECT o_orderkey, o_orderpriority AS priority_text, substr(o_orderpriority, 1, 1)::BIGINT AS priority_rank,
       o_totalprice AS total_price
FROM orders""",
    "q04_drop_missing": f"WITH {GAPS} SELECT * FROM gaps WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL",
    "q05_fill_mean": f"""
WITH {GAPS}, m AS (
  SELECT avg(NULLIF(c_nationkey, 7)) AS nation_mean, avg(c_acctbal) AS balance_mean FROM gaps)
SELECT c_custkey, c_name, round(coalesce(NULLIF(c_nationkey, 7)::DOUBLE, nation_mean), 4) AS c_nationkey,
       round(coalesce(c_acctbal, balance_mean), 4) AS c_acctbal, c_mktsegment
FROM gaps, m""",
    "q06_forward_fill": """
WITH gaps AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type NOT IN ('view', 'error') THEN value END AS value, props
  FROM events)
SELECT event_id, ts, user_id, event_type,
       last_value(value IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
       props
FROM gaps""",
    "q07_fill_value": f"""
WITH {GAPS}
SELECT c_custkey, c_name, c_nationkey, coalesce(c_acctbal, -1.0::DOUBLE) AS c_acctbal,
       coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment
FROM gaps""",
    "q08_outliers_sequential": """
WITH s1 AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem),
kept1 AS (SELECT lineitem.* FROM lineitem, s1 WHERE abs((l_extendedprice - m) / s) < 1.5),
s2 AS (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS s FROM kept1)
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM kept1, s2 WHERE abs((l_quantity - m) / s) < 1.5""",
    "q09_dedup_whole_row": "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)",
    "q10_dedup_keep_first": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
             l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""",
    "q11_dim_keep_last": f"""
SELECT row_number() OVER (ORDER BY user_id) AS user_key, user_id, event_type, value,
       {TS} AS dw_insert_date, {TS} AS dw_update_date
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, user_id DESC, event_type DESC, value DESC) AS rn
      FROM events)
WHERE rn = 1""",
    "q12_dim_distinct": f"""
WITH {PART_GAPS}
SELECT row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST) AS part_type_key, p_brand, p_type,
       {TS} AS dw_insert_date
FROM (SELECT DISTINCT p_brand, p_type FROM part_gaps)""",
    "q13_dim_period": f"""
SELECT row_number() OVER (ORDER BY order_year, order_quarter, o_orderpriority, o_orderstatus) AS period_key, *,
       {TS} AS dw_insert_date
FROM (SELECT DISTINCT year(o_orderdate)::BIGINT AS order_year, quarter(o_orderdate)::BIGINT AS order_quarter,
             o_orderpriority, o_orderstatus FROM orders)""",
    "q14_dim_scd2_initial": f"""
SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey, s_name, s_nationkey,
       {TS} AS effective_date, {OPEN_END}::VARCHAR AS end_date, TRUE AS is_current, {TS} AS dw_insert_date
FROM supplier""",
    "q15_fact_build": f"""
WITH {dims("(SELECT * FROM customer WHERE c_acctbal >= 0)")}
SELECT row_number() OVER (ORDER BY {FACT_ORDER}) AS result_key, {FACT_COLUMNS},
       {TS} AS dw_insert_date, {TS} AS dw_update_date
FROM bound""",
    "q16_scd1_upsert": f"""
WITH {UPDATE}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM known
WHERE c_custkey NOT IN (SELECT c_custkey FROM upd)
UNION ALL
SELECT c_custkey, c_name, NULL, c_acctbal, c_mktsegment FROM upd""",
    "q17_dim_scd1_merge": f"""
WITH {UPDATE},
existing AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, * FROM known),
added AS (SELECT * FROM upd WHERE c_custkey NOT IN (SELECT c_custkey FROM known))
SELECT e.customer_key, e.c_custkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_name ELSE e.c_name END AS c_name,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_mktsegment ELSE e.c_mktsegment END AS c_mktsegment,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_nationkey ELSE e.c_nationkey END AS c_nationkey,
       CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE e.c_acctbal END AS c_acctbal,
       {EARLIER} AS dw_insert_date,
       CASE WHEN u.c_custkey IS NOT NULL THEN {TS} ELSE {EARLIER} END AS dw_update_date
FROM existing e LEFT JOIN upd u ON e.c_custkey = u.c_custkey
UNION ALL
SELECT (SELECT max(customer_key) FROM existing) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name,
       c_mktsegment, c_nationkey, c_acctbal, {TS}, {TS}
FROM added""",
    "q18_scd2_upsert": f"WITH {UPSERTED} SELECT * REPLACE (end_date::VARCHAR AS end_date) FROM upserted",
    "q19_scd2_repeated_keys": f"WITH {CHAINED} SELECT * FROM chained",
    "q51_scd2_second_batch": f"""
WITH {CHAINED},
batch AS (SELECT DISTINCT user_id FROM events WHERE user_id % 3 = 0)
SELECT c.user_id, event_type, value, effective_date,
       CASE WHEN is_current AND b.user_id IS NOT NULL THEN TIMESTAMP '2024-06-02 00:00:00'::VARCHAR ELSE end_date END AS end_date,
       is_current AND b.user_id IS NULL AS is_current
FROM chained c LEFT JOIN batch b ON c.user_id = b.user_id
UNION ALL
SELECT user_id, 'again', 0.0::DOUBLE, TIMESTAMP '2024-06-02 00:00:00', {OPEN_END}::VARCHAR, TRUE FROM batch""",
    "q20_dim_scd2_merge": f"""
WITH existing AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey, c_name, c_mktsegment
  FROM customer WHERE c_acctbal >= 0),
batch AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal BETWEEN 1000 AND 4000 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer),
added AS (
  SELECT b.* FROM batch b LEFT JOIN existing e ON b.c_custkey = e.c_custkey
  WHERE e.c_custkey IS NULL OR b.c_mktsegment IS DISTINCT FROM e.c_mktsegment)
SELECT e.customer_key, e.c_custkey, e.c_name, e.c_mktsegment, {EARLIER} AS effective_date,
       CASE WHEN a.c_custkey IS NOT NULL THEN {TS} ELSE {OPEN_END} END::VARCHAR AS end_date,
       a.c_custkey IS NULL AS is_current, {EARLIER} AS dw_insert_date
FROM existing e LEFT JOIN added a ON e.c_custkey = a.c_custkey
UNION ALL
SELECT (SELECT max(customer_key) FROM existing) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name,
       c_mktsegment, {TS}, {OPEN_END}::VARCHAR, TRUE, {TS}
FROM added""",
    "q21_type0_merge": f"""
WITH {PART_GAPS},
existing AS (
  SELECT row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST) AS part_type_key, p_brand, p_type
  FROM (SELECT DISTINCT p_brand, p_type FROM part_gaps WHERE p_retailprice < 950)),
added AS (SELECT DISTINCT p_brand, p_type FROM part_gaps EXCEPT SELECT p_brand, p_type FROM existing)
SELECT part_type_key, p_brand, p_type, {EARLIER} AS dw_insert_date FROM existing
UNION ALL
SELECT (SELECT coalesce(max(part_type_key), 0) FROM existing)
       + row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST), p_brand, p_type, {TS}
FROM added""",
    "q22_scd2_current": f"""
WITH {UPSERTED} SELECT * REPLACE (end_date::VARCHAR AS end_date) FROM upserted WHERE is_current""",
    "q23_scd2_history": f"""
WITH {UPSERTED},
entity AS (SELECT c_custkey FROM upserted WHERE c_custkey IS NOT NULL GROUP BY c_custkey ORDER BY count(*) DESC, c_custkey DESC LIMIT 1)
SELECT row_number() OVER (ORDER BY effective_date)::INTEGER AS version, c_custkey, c_name, c_mktsegment, effective_date,
       end_date::VARCHAR AS end_date, is_current
FROM upserted WHERE c_custkey IN (SELECT c_custkey FROM entity)""",
    "q24_scd2_validate": f"""
WITH {HISTORY},
broken AS (
  SELECT is_current, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN {TS}
                          ELSE end_date END AS end_date
  FROM history)
SELECT 'sound' AS dimension, count(*) AS violations, count(*) = 0 AS valid
FROM history WHERE is_current AND end_date IS DISTINCT FROM {OPEN_END}
UNION ALL
SELECT 'broken', count(*), count(*) = 0 FROM broken WHERE is_current AND end_date IS DISTINCT FROM {OPEN_END}""",
    "q25_fact_fanout_all_versions": f"""
WITH {dims()},
vers AS (
  SELECT s_suppkey, s_nationkey, s_acctbal <= 5000 AS is_current FROM supplier
  UNION ALL
  SELECT s_suppkey, s_nationkey + 100, TRUE FROM supplier WHERE s_acctbal > 5000),
lines AS (SELECT s_suppkey FROM bound JOIN dim_supplier USING (supplier_key))
SELECT s_nationkey::INTEGER AS s_nationkey, count(*) AS fact_rows, 'current' AS version
FROM lines JOIN vers USING (s_suppkey) WHERE is_current GROUP BY s_nationkey
UNION ALL
SELECT s_nationkey::INTEGER, count(*), 'all' FROM lines JOIN vers USING (s_suppkey) GROUP BY s_nationkey""",
    "q26_fact_append": f"""
WITH {LOADS}
SELECT row_number() OVER (ORDER BY {FACT_ORDER}) AS result_key, {FACT_COLUMNS},
       {EARLIER} AS dw_insert_date, {EARLIER} AS dw_update_date
FROM first_load
UNION ALL
SELECT (SELECT count(*) FROM first_load) + row_number() OVER (ORDER BY {FACT_ORDER}), {FACT_COLUMNS}, {TS}, {TS}
FROM fresh""",
    "q27_append_replay": f"""
WITH {LOADS}
SELECT 'first' AS load, count(*) AS fact_rows FROM first_load
UNION ALL SELECT 'appended', count(*) FROM fresh
UNION ALL SELECT 'appended_one_per_grain', count(*)
  FROM (SELECT DISTINCT customer_key, l_orderkey, l_linenumber FROM fresh)
UNION ALL SELECT 'replayed', count(*) FROM second_load s
  WHERE NOT EXISTS (SELECT 1 FROM first_load f WHERE f.customer_key = s.customer_key
                    AND f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber)
    AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.customer_key = s.customer_key
                    AND f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber)""",
    "q28_append_stats": f"""
WITH {LOADS},
n AS (SELECT (SELECT count(*) FROM first_load) AS f, (SELECT count(*) FROM second_load) AS s,
             (SELECT count(*) FROM fresh) AS a)
SELECT '20200101_000000_000000' AS _batch_id, 'full' AS mode, f AS new_rows, 0::BIGINT AS appended_rows,
       0::BIGINT AS duplicate_keys_skipped, f AS last_key, {EARLIEST} AS promoted_at FROM n
UNION ALL SELECT '20220101_000000_000000', 'incremental', s, a, s - a, f + a, {EARLIER} FROM n
UNION ALL SELECT '20240601_000000_000000', 'incremental', s, 0, s, f + a, {TS} FROM n""",
    "q37_star_rollup": f"""
WITH {dims()}
SELECT c_mktsegment, order_year, count(*) AS fact_rows, round(avg(l_quantity), 4) AS avg_l_quantity,
       round(avg(l_extendedprice), 4) AS avg_l_extendedprice, sum(returned_flag)::BIGINT AS sum_returned_flag
FROM bound GROUP BY c_mktsegment, order_year""",
    "q29_check_row_count": """
SELECT 'nation' AS "table", 24::BIGINT AS threshold, count(*)::VARCHAR AS actual, count(*) > 24 AS passed FROM nation
UNION ALL SELECT 'nation at its size', 25, count(*)::VARCHAR, count(*) > 25 FROM nation
UNION ALL SELECT 'orders', 0, count(*)::VARCHAR, count(*) > 0 FROM orders
UNION ALL SELECT 'lineitem', 1000000000000, count(*)::VARCHAR, count(*) > 1000000000000 FROM lineitem""",
    "q30_check_null_pct": f"""
WITH {GAPS},
subjects AS (SELECT 'customers' AS subject, * FROM gaps
             UNION ALL SELECT 'no customers', * FROM gaps WHERE c_custkey < 0),
limits(column_name, max_fraction) AS (
  VALUES ('c_custkey', 0.0::DOUBLE), ('c_name', 0.0::DOUBLE), ('c_mktsegment', 0.05::DOUBLE),
         ('c_acctbal', 0.25::DOUBLE)),
names(subject) AS (VALUES ('customers'), ('no customers')),
fractions AS (
  SELECT n.subject, l.column_name, l.max_fraction,
         count(*) FILTER (CASE l.column_name WHEN 'c_custkey' THEN s.c_custkey IS NULL
                          WHEN 'c_name' THEN s.c_name IS NULL WHEN 'c_mktsegment' THEN s.c_mktsegment IS NULL
                          ELSE s.c_acctbal IS NULL END AND s.subject IS NOT NULL)
           / NULLIF(count(s.subject), 0)::DOUBLE AS f
  FROM names n JOIN limits l ON TRUE LEFT JOIN subjects s ON s.subject = n.subject
  GROUP BY n.subject, l.column_name, l.max_fraction)
SELECT column_name, round(f, 8) AS null_fraction, max_fraction, coalesce(f > max_fraction, FALSE) AS violates, subject
FROM fractions""",
    "q31_check_duplicates": f"""
WITH {GAPS}, {HISTORY},
groups AS (
  SELECT 'lineitem' AS t, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
  UNION ALL SELECT 'customer', count(*) FROM gaps GROUP BY c_custkey
  UNION ALL SELECT 'customer missing', count(*) FROM (
    SELECT c_mktsegment, c_acctbal, (SELECT NULL) AS x FROM (
      SELECT NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment,
             CASE WHEN c_acctbal >= 0 THEN c_acctbal WHEN c_acctbal < -500 THEN 'NaN'::DOUBLE END AS c_acctbal
      FROM customer)) GROUP BY c_mktsegment, c_acctbal
  UNION ALL SELECT 'history', count(*) FROM history GROUP BY c_custkey
  UNION ALL SELECT 'history open', count(*) FROM history WHERE is_current GROUP BY c_custkey)
SELECT t AS "table", coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS duplicate_count,
       coalesce(sum(n) FILTER (n > 1), 0) = 0 AS passed
FROM groups GROUP BY t""",
    "q32_check_referential": """
SELECT 'documents' AS fact_table, 'labels' AS dim_table, count(DISTINCT doc_id) AS missing_keys,
       count(DISTINCT doc_id) = 0 AS passed
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT 'orders', 'customer', count(DISTINCT o_custkey), count(DISTINCT o_custkey) = 0
FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'orders', 'known', count(DISTINCT o_custkey), count(DISTINCT o_custkey) = 0
FROM orders WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "q33_check_types": f"""
WITH {GAPS}, types AS (
  SELECT column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
                      WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' END AS actual_type
  FROM (SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name,
               unnest([min(typeof(c_custkey)), min(typeof(c_name)), min(typeof(c_nationkey)),
                       min(typeof(c_acctbal)), min(typeof(c_mktsegment))]) AS data_type FROM gaps)),
missing AS (
  SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name,
         unnest([count(*) - count(c_custkey), count(*) - count(c_name), count(*) - count(c_nationkey),
                 count(*) - count(c_acctbal), count(*) - count(c_mktsegment)]) AS missing_count FROM gaps),
rules(column_name, expected_type, nullable) AS (
  VALUES ('c_custkey', 'bigint', FALSE), ('c_name', 'string', FALSE), ('c_nationkey', 'bigint', TRUE),
         ('c_acctbal', 'double', TRUE), ('c_mktsegment', 'string', FALSE), ('c_phone', 'string', TRUE))
SELECT r.column_name, r.expected_type, t.actual_type, m.missing_count,
       coalesce(r.expected_type = t.actual_type, FALSE) AS type_ok,
       coalesce(r.nullable OR m.missing_count = 0, FALSE) AS nulls_ok
FROM rules r LEFT JOIN types t USING (column_name) LEFT JOIN missing m USING (column_name)""",
    "q34_quality_report": f"""
WITH {GAPS}, {SUITE},
report AS (
  SELECT count(*) FILTER (position <> 11) AS total_checks,
         count(*) FILTER (position <> 11 AND passed) AS passed, sum(message_count)::BIGINT AS failed
  FROM checks)
SELECT total_checks, passed, failed, round(passed / total_checks::DOUBLE, 8) AS pass_rate,
       passed / total_checks::DOUBLE >= 0.6 AS meets_low_gate,
       passed / total_checks::DOUBLE >= 0.95 AS meets_standard
FROM report""",
    "q42_quality_checks": f"""
WITH {GAPS}, {SUITE}
SELECT position::INTEGER AS position, "check", checked, passed, threshold::BIGINT AS threshold, actual,
       duplicate_count::BIGINT AS duplicate_count, missing_keys::BIGINT AS missing_keys,
       message_count::BIGINT AS message_count
FROM checks""",
    "q35_run_report": f"""
WITH {RUNS}
SELECT layer, table_name AS "table", source, status, start_time, end_time, rows_in, rows_out, transformations, errors
FROM runs""",
    "q43_run_history": f"""
WITH {RUNS}
SELECT layer, table_name, status, start_time, rows_in AS row_count_in, rows_out AS row_count_out
FROM runs WHERE layer = 'silver' OR table_name = 'user_7'""",
    "q36_latest_checkpoint": """
SELECT count(*) AS fact_table_size, count(*) FILTER (event_type = 'signup') AS new_rows_processed,
       (DATE '1970-01-01' + ((ts::DATE - DATE '1970-01-01') // 2 * 2)::INTEGER)::TIMESTAMP AS checkpoint_timestamp,
       (ts::DATE - DATE '1970-01-01')::BIGINT AS position
FROM events GROUP BY ts::DATE ORDER BY position DESC LIMIT 1""",
    "q38_profile": f"WITH {GAPS} "
    + profile(
        "gaps",
        {
            "c_custkey": "bigint",
            "c_name": "string",
            "c_nationkey": "int",
            "c_acctbal": "double",
            "c_mktsegment": "string",
        },
    ),
    "q44_profile_lines": profile(
        "lineitem",
        {
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_linenumber": "int",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
            "l_returnflag": "string",
            "l_linestatus": "string",
            "l_shipdate": "timestamp_ntz",
        },
    ),
    "q39_latest_snapshot": """
SELECT *, strftime(ts, '%Y%m%d') AS _batch_id FROM events
WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)""",
    "q40_silver_clean": f"""
WITH {RAW_LINES}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
       {EARLIER} AS _ingestion_timestamp, 'raw_ingestion' AS _source_system,
       {TS} AS _processing_timestamp, 'silver' AS _layer
FROM usual WHERE l_quantity > 5""",
    "q41_cleaning_issues": f"""
WITH {RAW_LINES}
SELECT 'duplicates' AS issue, (SELECT count(*) FROM raw) - (SELECT count(*) FROM uniq) AS amount,
       'rows removed' AS detail
UNION ALL SELECT 'missing_values', (SELECT count(*) FROM uniq WHERE l_returnflag IS NULL), 'drop'
UNION ALL SELECT 'outliers', (SELECT count(*) FROM present) - (SELECT count(*) FROM usual), 'rows removed'""",
    "q45_missing_cells": f"""
WITH {GAPS}
SELECT (2 * count(*) - count(c_acctbal) - count(c_mktsegment))::BIGINT AS missing_cells FROM gaps""",
    "q46_duplicate_groups": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1""",
    "q47_orphan_keys": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "q48_dense_keys": """
SELECT 1000 + row_number() OVER (ORDER BY user_id, ts) AS event_key, event_id, ts, user_id FROM events""",
    "q49_replay_after_failed_gate": f"""
WITH {LOADS},
keyed AS (SELECT row_number() OVER (ORDER BY {FACT_ORDER}) AS result_key, c_mktsegment FROM first_load)
SELECT c_mktsegment, count(*) AS fact_rows, max(result_key) AS last_key FROM keyed GROUP BY c_mktsegment""",
    "q54_dedup_user_flag": f"""
SELECT DISTINCT o_orderkey, o_orderstatus, flag::INTEGER AS _flag, {EARLIER} AS _ingestion_timestamp, 'raw_ingestion' AS _source_system
FROM (SELECT o_orderkey, o_orderstatus, 1 AS flag FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, o_orderkey % 2 FROM orders)""",
    "q55_outliers_default_columns": """
WITH p AS (SELECT p_partkey, p_size, p_retailprice AS _price FROM part),
s1 AS (SELECT avg(p_partkey) AS m, stddev_samp(p_partkey) AS s FROM p),
k1 AS (SELECT p.* FROM p, s1 WHERE abs((p_partkey - m) / s) < 1.2),
s2 AS (SELECT avg(p_size) AS m, stddev_samp(p_size) AS s FROM k1),
k2 AS (SELECT k1.* FROM k1, s2 WHERE abs((p_size - m) / s) < 1.2),
s3 AS (SELECT avg(_price) AS m, stddev_samp(_price) AS s FROM k2)
SELECT p_partkey, p_size, _price FROM k2, s3 WHERE abs((_price - m) / s) < 1.2""",
    "q50_csv_scan": """
SELECT doc_id, '"quoted", ' || text || chr(10) || ',end' AS text, lang, n_chars FROM documents""",
    "q53_layer_formats": """
WITH o AS (
  SELECT o_orderkey, o_orderdate, o_totalprice,
         CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '\\N' WHEN 2 THEN ' "a' || chr(10) || '\\' || o_orderpriority || '", '
                             WHEN 3 THEN o_orderstatus END AS note
  FROM orders)
SELECT o.*, fmt FROM o, (VALUES ('parquet'), ('json'), ('csv')) AS f(fmt)""",
    "q52_layer_types": f"""
WITH m AS (SELECT avg(NULLIF(c_nationkey, 7)) AS nation_mean FROM customer)
SELECT c_custkey, c_nationkey::DOUBLE AS c_nationkey, c_acctbal, NULL::VARCHAR AS c_acctbal_text, {EARLIER} AS _processing_timestamp FROM customer
UNION ALL
SELECT c_custkey, round(coalesce(NULLIF(c_nationkey, 7)::DOUBLE, nation_mean), 4), CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END,
       CASE WHEN c_custkey % 10 = 0 THEN 'none' END, {TS}
FROM customer, m""",
}

ORACLE |= {
    "q56_append_by_grain_index": f"WITH {LOADS} SELECT {FACT_COLUMNS} FROM fresh",
    # A dimension read from its base and a delta is the dimension.
    "q57_dim_scd1_delta": ORACLE["q17_dim_scd1_merge"],
    "q58_dim_scd2_delta": ORACLE["q20_dim_scd2_merge"],
    "q59_type0_delta": ORACLE["q21_type0_merge"],
    "q60_seeded_sample": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY md5(concat_ws(chr(31), '7', '=' || l_orderkey, '=' || l_linenumber, '=' || l_partkey)), l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 1000""",
    "q61_suite_from_states": f"""
WITH {LOADS},
loaded AS (SELECT * FROM first_load UNION ALL SELECT * FROM fresh),
c AS (SELECT count(*) AS n, avg((returned IS NULL)::INTEGER) AS gone, avg((l_quantity IS NULL)::INTEGER) AS no_quantity FROM loaded),
g AS (SELECT coalesce(sum(n), 0)::BIGINT AS copies FROM (SELECT count(*) AS n FROM loaded GROUP BY customer_key, l_orderkey, l_linenumber HAVING count(*) > 1))
SELECT 1::INTEGER AS position, 'row_count' AS "check", n::VARCHAR AS actual, n > 10 AS passed, NULL::BIGINT AS duplicate_count, NULL::BIGINT AS missing_keys FROM c
UNION ALL SELECT 2, 'null_percentage', NULL, gone <= 0.6, NULL, NULL FROM c
UNION ALL SELECT 3, 'null_percentage', NULL, gone <= 0.1 AND no_quantity <= 0, NULL, NULL FROM c
UNION ALL SELECT 4, 'duplicate_keys', NULL, true, 0, NULL
UNION ALL SELECT 5, 'duplicate_keys', NULL, copies = 0, copies, NULL FROM g
UNION ALL SELECT 6, 'referential_integrity', NULL, true, NULL, 0""",
    "q62_star_saved": f"""
WITH {dims()}
SELECT 'dim_customer' AS "table", count(*) AS row_count FROM dim_customer
UNION ALL SELECT 'dim_supplier', count(*) FROM dim_supplier
UNION ALL SELECT 'dim_part_type', count(*) FROM dim_part_type
UNION ALL SELECT 'dim_period', count(*) FROM dim_period
UNION ALL SELECT 'fact_sale', count(*) FROM bound""",
    "q63_run_log": """
WITH runs("table", status, start, n, errors) AS (
    SELECT 'nation', 'success', TIMESTAMP '2024-01-01 00:00:00', count(*), 0 FROM nation
    UNION ALL SELECT 'region', 'success', TIMESTAMP '2024-01-01 00:02:00', count(*), 0 FROM region
    UNION ALL SELECT 'absent', 'failed', TIMESTAMP '2024-01-01 00:04:00', NULL, 1)
SELECT folded, "table", status, start AS start_time, start + INTERVAL 1 MINUTE AS end_time, n AS rows_in, n AS rows_out, errors::BIGINT AS errors
FROM runs, (VALUES (false), (true)) AS f(folded)""",
    "q64_rollup_from_states": ORACLE["q37_star_rollup"],
    "q65_bucketed_rollup": ORACLE["q37_star_rollup"],
}
