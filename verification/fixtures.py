"""Projections of the given tables onto the shapes the library loads.

Each text is valid in Spark and in DuckDB and gives the same rows there.  They are
inputs only: the work under test is done by the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "events", "lineitem", "nation", "orders", "part", "supplier")

FIXTURES: dict[str, str] = {}

FIXTURES["staffing_src"] = """
SELECT CAST(l_orderkey AS STRING) AS schedule_id,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS employee_id,
 CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS position_id,
 CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_suppkey % 5 AS STRING) END AS project_id,
 CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'Exempt' WHEN l_returnflag = 'R' THEN 'Non-Exempt'
      WHEN l_partkey % 4 = 0 THEN 'Casual' ELSE 'Exempt Agency' END AS schedule_type,
 CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Filled' END AS schedule_status,
 CAST(l_shipdate AS DATE) AS schedule_start_date,
 CAST(l_shipdate AS DATE) + (CAST(l_quantity AS INT) - 3) AS schedule_end_date,
 CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS period_start_date,
 CAST(l_shipdate AS DATE) + 27 AS period_end_date,
 CASE WHEN l_discount > 0.095 THEN NULL ELSE CAST(l_quantity - 2 AS DECIMAL(18,4)) END AS allocated_hours,
 CAST(l_shipdate AS DATE) AS reporting_date,
 l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS src_seq
FROM lineitem
"""

FIXTURES["cost_src"] = """
SELECT CAST(l_partkey AS STRING) AS cost_id,
 CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey % 9 AS STRING) END AS project_id,
 CAST(l_suppkey AS STRING) AS cost_center,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE 'T' || CAST(l_linenumber AS STRING) END AS cost_type,
 CASE WHEN l_returnflag = 'A' THEN 'Company' WHEN l_returnflag = 'R' THEN 'CLIENT' WHEN l_linestatus = 'O' THEN 'Partner' END AS cost_category,
 CASE WHEN l_suppkey % 2 = 0 THEN 'USD' ELSE 'AUD' END AS currency,
 CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) - CAST(l_quantity AS INT) END AS period_date,
 CASE WHEN l_discount > 0.095 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(22,6)) END AS amount,
 CASE WHEN l_linenumber = 2 THEN 'budget' WHEN l_linenumber = 4 THEN 's-curve' END AS curve_type,
 CASE WHEN l_linenumber = 1 THEN 'Actuals' WHEN l_linenumber = 5 THEN 'FC' WHEN l_linenumber = 6 THEN 'forecast'
      WHEN l_linenumber = 7 THEN NULL ELSE 'OTHER' END AS forecast_type,
 CAST(l_shipdate AS DATE) AS reporting_date,
 l_orderkey * 10000 + l_suppkey * 10 + l_linenumber AS src_seq
FROM lineitem
"""

FIXTURES["coded_src"] = """
SELECT 'P' || CAST(l_suppkey % 3 AS STRING) AS portfolio_id, CAST(l_suppkey % 11 AS STRING) AS project_id, l_returnflag AS business_unit,
 CASE WHEN l_linestatus = 'O' THEN 'AU-01' ELSE 'UK-02' END AS execution_center, 'BT' || CAST(l_linenumber % 2 AS STRING) AS bill_type,
 'W' || CAST(l_partkey % 3 AS STRING) AS wbs_1_code,
 CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'V' || CAST(l_partkey % 2 AS STRING) END AS wbs_2_code,
 'LABOR-' || CAST(l_linenumber AS STRING) AS cost_type, 'CBS-100-' || CAST(l_linenumber AS STRING) AS cbs,
 CASE WHEN l_linenumber % 3 = 0 THEN 'Company' WHEN l_linenumber % 3 = 1 THEN 'CLIENT' ELSE 'OTHER' END AS cost_basis,
 CAST(l_suppkey AS STRING) AS employee_id, CAST(l_partkey AS STRING) AS position_number, CAST(l_orderkey AS STRING) AS order_ref,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS plan_start_date,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) * 5 END AS plan_end_date,
 CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_shipdate AS DATE) + 45 END AS forecast_start_date,
 CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) * 7 END AS forecast_end_date,
 CAST(l_quantity AS DECIMAL(18,4)) AS hours_per_week,
 CAST(l_quantity AS DECIMAL(18,4)) AS original_budget_hours, CAST(l_extendedprice AS DECIMAL(22,6)) AS original_budget_cost,
 CAST(l_quantity + 1 AS DECIMAL(18,4)) AS current_budget_hours, CAST(l_extendedprice * 2 AS DECIMAL(22,6)) AS current_budget_cost,
 CAST(l_quantity + 2 AS DECIMAL(18,4)) AS forecast_budget_hours, CAST(l_extendedprice * 3 AS DECIMAL(22,6)) AS forecast_budget_cost,
 CAST(l_quantity + 3 AS DECIMAL(18,4)) AS etc_budget_hours, CAST(l_extendedprice * 4 AS DECIMAL(22,6)) AS etc_budget_cost,
 CAST(l_quantity + 4 AS DECIMAL(18,4)) AS earned_budget_hours, CAST(l_extendedprice * 5 AS DECIMAL(22,6)) AS earned_budget_cost,
 CAST(l_quantity + 5 AS DECIMAL(18,4)) AS client_hours, CAST(l_extendedprice * 6 AS DECIMAL(22,6)) AS value_of_work_done,
 CAST(l_shipdate AS DATE) AS reporting_date
FROM lineitem
"""

FIXTURES["run_log_src"] = """
SELECT event_id AS run_id, 1 + user_id % 2 AS entity_id,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE 1 + event_id % 4 END AS mapping_id,
 ts AS start_time,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) END AS end_time,
 CASE WHEN event_id % 97 = 0 THEN 'RUNNING' WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CAST(floor(value) AS BIGINT) AS rows_inserted, event_id % 7 AS rows_updated, event_id % 3 AS rows_expired, event_id % 2 AS rows_rejected,
 CASE WHEN event_type = 'error' THEN 'ETL-' || props END AS error_message
FROM events
"""

FIXTURES["error_log_src"] = """
SELECT event_id AS err_id, event_id AS run_id,
 CASE WHEN user_id % 2 = 0 THEN 'STAFFING_SCHEDULE' ELSE 'COST' END AS entity_name,
 CASE WHEN event_id % 3 = 0 THEN 'VAL_NOT_NULL' WHEN event_id % 3 = 1 THEN 'VAL_DERIVED_NULL' ELSE 'VAL_CHECK_FAILED' END AS error_code,
 props AS error_message, ts AS error_time, 'EVENT_ID=' || CAST(event_id AS STRING) AS record_key
FROM events WHERE event_type = 'error'
"""

# The coding reference; keys are built from the codes, so both engines agree on them.
FIXTURES["coding_reference_src"] = """
SELECT CAST(substring(portfolio_id, 2, 1) AS BIGINT) * 10000000 + CAST(project_id AS BIGINT) * 100000
  + CASE business_unit_id WHEN 'A' THEN 10000 WHEN 'N' THEN 20000 ELSE 30000 END
  + CASE operating_center_id WHEN 'AU' THEN 1000 ELSE 2000 END + CAST(substring(wbs1_id, 2, 1) AS BIGINT) * 100
  + CASE wbs2_id WHEN 'V0' THEN 10 WHEN 'V1' THEN 20 ELSE 0 END AS gcs_key,
 portfolio_id, project_id, business_unit_id, operating_center_id, bill_type_id, wbs1_id, wbs2_id, cost_type_id, cbs_id,
 1 AS staffing_flag, 0 AS cost_flag, CASE WHEN project_id = '10' AND wbs1_id = 'W2' THEN 0 ELSE 1 END AS is_valid
FROM (
 SELECT DISTINCT 'P' || CAST(l_suppkey % 3 AS STRING) AS portfolio_id, CAST(l_suppkey % 11 AS STRING) AS project_id,
  l_returnflag AS business_unit_id, CASE WHEN l_linestatus = 'O' THEN 'AU' ELSE 'UK' END AS operating_center_id,
  'BT' AS bill_type_id, 'W' || CAST(l_partkey % 3 AS STRING) AS wbs1_id,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE 'V' || CAST(l_partkey % 2 AS STRING) END AS wbs2_id,
  'LABOR' AS cost_type_id, 'CBS-100' AS cbs_id
 FROM lineitem) AS codings
"""

FIXTURES["step_log_src"] = """
SELECT event_id AS step_id, user_id AS run_id, 'STEP:' || event_type AS step_name, ts AS start_time,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts + INTERVAL '1' SECOND * CAST(floor(value) AS INT) END AS end_time,
 CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
 CAST(floor(value) AS BIGINT) AS rows_affected, props AS step_message
FROM events
"""

# A registry as large as the tables: customers as entities, orders as mappings, lines as columns.
FIXTURES["entity_src"] = """
SELECT c_custkey AS entity_id, 'ENTITY_' || CAST(c_custkey AS STRING) AS entity_name,
 'SOURCE_' || CAST(c_nationkey AS STRING) AS source_table, 'reporting_date' AS watermark_column,
 CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS is_active
FROM customer
"""

FIXTURES["mapping_src"] = """
SELECT o_orderkey AS mapping_id, o_custkey AS entity_id, 'DIM_' || CAST(o_orderkey AS STRING) AS target_table,
 'STG_' || CAST(o_orderkey AS STRING) AS staging_table,
 CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'SCD2' WHEN '2' THEN 'SCD1' WHEN '3' THEN 'INCREMENTAL'
      ELSE 'APPEND' END AS load_type,
 CASE WHEN o_totalprice > 400000 THEN NULL ELSE 'DIM_ID' END AS surrogate_key_col,
 CASE WHEN o_totalprice < 50000 THEN NULL ELSE 'SEQ_DIM' END AS surrogate_seq_name,
 CAST(substring(o_orderpriority, 1, 1) AS INT) * 10 AS load_order,
 CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS is_active
FROM orders
"""

FIXTURES["column_src"] = """
SELECT l_orderkey AS mapping_id, 'S' || CAST(l_linenumber AS STRING) AS source_column,
 'T' || CAST(l_linenumber AS STRING) AS target_column,
 CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END AS is_business_key,
 CASE WHEN l_linenumber = 1 THEN 'N' ELSE 'Y' END AS is_tracked,
 l_linenumber * 10 AS column_order, CASE WHEN l_returnflag = 'A' THEN 'N' ELSE 'Y' END AS is_active
FROM lineitem
"""

FIXTURES["rule_src"] = """
SELECT p_partkey AS rule_id, p_name AS rule_name, 'NOT_NULL' AS rule_type, p_type AS column_name FROM part
"""

FIXTURES["source_system_src"] = "SELECT n_nationkey AS system_id, n_name AS name FROM nation"

FIXTURES["control_src"] = """
SELECT c_custkey AS entity_id, CAST(ok_time AS DATE) AS last_watermark, CAST(run_time AS DATE) AS last_run_date,
 last_run_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'DISABLED' WHEN failed > 3 THEN 'FAILED' ELSE 'IDLE' END AS status
FROM customer LEFT JOIN (
 SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) AS ok_time, max(ts) AS run_time,
  max(event_id) AS last_run_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS failed
 FROM events GROUP BY user_id) AS r ON c_custkey = user_id
"""

# Column lists: what a contract expects, and what tables have.
FIXTURES["expected_columns_src"] = """
SELECT 'DIM_' || CAST(o_orderkey AS STRING) AS table_name,
 'T' || substring(o_orderpriority, 1, 1) AS column_name
FROM orders
"""

FIXTURES["actual_columns_src"] = """
SELECT 'DIM_' || CAST(l_orderkey AS STRING) AS table_name, 'T' || CAST(l_linenumber AS STRING) AS column_name
FROM lineitem
"""


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A projection as a DataFrame over the Parquet files of ``sf_dir``."""
    text = FIXTURES[name]
    for table in TABLES:
        if table in text:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(text)
