"""Independent DuckDB statements for every entry of ``workload.QUERIES``.

The tables ``orders customer events lineitem`` are the shared test tables.
They restate each operator in plain SQL (QUALIFY, NOT EXISTS, UNION ALL),
without the Spark code path, so agreement is a real check.
"""

from __future__ import annotations

_ORDER_NEWEST = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST)"
_EVENT_NEWEST = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST)"

_MERGE_CTES = f"""
WITH ex AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS load_ts FROM orders
  WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND o_orderpriority IN ('1-URGENT', '5-LOW'), false)
  QUALIFY {_ORDER_NEWEST} = 1),
da AS (
  SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS load_ts FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND o_orderpriority IN ('1-URGENT', '5-LOW')
  QUALIFY {_ORDER_NEWEST} = 1),
touched AS (SELECT DISTINCT o_orderpriority FROM da),
ex_touched AS (
  SELECT * FROM ex WHERE EXISTS (
    SELECT 1 FROM touched t WHERE t.o_orderpriority IS NOT DISTINCT FROM ex.o_orderpriority)),
surv AS (
  SELECT * FROM ex_touched WHERE NOT EXISTS (SELECT 1 FROM da WHERE da.o_custkey = ex_touched.o_custkey)),
comb AS (SELECT * FROM da UNION ALL SELECT * FROM surv),
fin AS (
  SELECT * FROM ex WHERE NOT EXISTS (
    SELECT 1 FROM touched t WHERE t.o_orderpriority IS NOT DISTINCT FROM ex.o_orderpriority)
  UNION ALL SELECT * FROM comb)
"""

_SECOND_CTES = _MERGE_CTES.rstrip() + f""",
second AS (
  SELECT *, TIMESTAMP '2024-02-29 00:00:00' AS load_ts FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND o_orderpriority = '2-HIGH'
  QUALIFY {_ORDER_NEWEST} = 1),
second_part AS (
  SELECT * FROM second UNION ALL
  SELECT * FROM fin WHERE o_orderpriority = '2-HIGH'
    AND NOT EXISTS (SELECT 1 FROM second s WHERE s.o_custkey = fin.o_custkey) AND EXISTS (SELECT 1 FROM second)),
fin2 AS (
  SELECT * FROM fin WHERE o_orderpriority IS DISTINCT FROM '2-HIGH' OR NOT EXISTS (SELECT 1 FROM second)
  UNION ALL SELECT * FROM second_part)
"""

_ARCHIVE_CTE = """
WITH arc AS (
  SELECT o_custkey AS id, o_orderdate AS date,
         CAST(row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS INTEGER) AS version
  FROM orders)
"""

SQL: dict[str, str] = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_orc": "SELECT * FROM orders",
    "catalog_scan": "SELECT * FROM orders",
    "partition_subset_scan": _MERGE_CTES + "SELECT * FROM ex_touched",
    "overwrite_partitioned": "SELECT * FROM customer",
    "archive_append": _MERGE_CTES + """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS load_ts FROM orders
WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND o_orderpriority IN ('1-URGENT', '5-LOW'), false)
UNION ALL SELECT * FROM comb""",
    "json_sink": "SELECT * FROM orders",
    "partition_swap": _MERGE_CTES + "SELECT * FROM fin",
    "prefixed_projection": """
SELECT c_custkey AS daily_data_c_custkey, c_name AS daily_data_c_name, c_nationkey AS daily_data_c_nationkey,
       c_acctbal AS daily_data_c_acctbal, c_mktsegment AS daily_data_c_mktsegment
FROM customer""",
    "positional_rename": """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance, c_mktsegment AS segment
FROM customer""",
    "load_timestamp": "SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS load_ts FROM customer",
    "partition_copy_column": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_mktsegment AS c_mktsegment__temp FROM customer""",
    "reorder_columns": "SELECT c_mktsegment, c_custkey, c_name FROM customer",
    "rename_column": "SELECT c_custkey, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "drop_columns": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "partition_values": _MERGE_CTES + "SELECT * FROM touched",
    "survivors_anti_join": _MERGE_CTES + "SELECT * FROM surv",
    "version_join": """
SELECT c.*, o.* FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey""",
    "row_number_rank": f"SELECT *, CAST({_EVENT_NEWEST} AS INTEGER) AS row_num FROM events",
    "latest_per_key": f"SELECT * FROM orders QUALIFY {_ORDER_NEWEST} = 1",
    "latest_per_composite_key": """
SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
           l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
           l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
    "merge_union": _MERGE_CTES + "SELECT * FROM comb",
    "title_case": r"""
SELECT o_orderkey, o_orderpriority,
       array_to_string(list_transform(range(1, length(o_orderpriority) + 1), lambda i:
         CASE WHEN i > 1 AND regexp_matches(substr(o_orderpriority, i - 1, 1), '[\p{Lu}\p{Ll}\p{Lt}]')
              THEN lower(substr(o_orderpriority, i, 1)) ELSE upper(substr(o_orderpriority, i, 1)) END), '') AS o_orderpriority_title
FROM orders""",
    "version_increment": _ARCHIVE_CTE + """
SELECT c.*, a.version, CAST(coalesce(a.version, 0) + 1 AS INTEGER) AS inc_version
FROM customer c LEFT JOIN arc a ON c.c_custkey = a.id""",
    "initial_load": f"SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS load_ts FROM events QUALIFY {_EVENT_NEWEST} = 1",
    "initial_archive": "SELECT *, TIMESTAMP '2024-01-31 00:00:00' AS load_ts FROM events",
    "incremental_merge": _MERGE_CTES + "SELECT * FROM fin",
    "catalog_merge": _MERGE_CTES + "SELECT * FROM fin",
    "staged_merge": _SECOND_CTES + "SELECT * FROM fin2",
    "bucketed_merge": _SECOND_CTES + "SELECT * FROM fin2",
    "archive_as_of": _MERGE_CTES + "SELECT * FROM fin",
    "repeated_run": _SECOND_CTES + """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS load_ts, '2024-01-01 00:00:00.000000' AS run_id FROM orders
WHERE NOT coalesce(o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND o_orderpriority IN ('1-URGENT', '5-LOW'), false)
UNION ALL SELECT *, '2024-01-31 00:00:00.000000' FROM comb
UNION ALL SELECT *, '2024-02-29 00:00:00.000000' FROM second_part""",
    "streaming_merge": _MERGE_CTES + "SELECT * FROM fin",
    "version_job": _ARCHIVE_CTE + """
SELECT c.c_custkey AS id, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, a.version,
       CAST(coalesce(a.version, 0) + 1 AS INTEGER) AS inc_version
FROM customer c LEFT JOIN arc a ON c.c_custkey = a.id""",
}
