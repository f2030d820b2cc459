"""Source records with realistic faults, derived from the given tables.

Each view is one SQL text that Spark and DuckDB both run. Table names are in braces, so Spark fills in frames and
the checking SQL fills in names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "substr(CAST(o.o_orderdate AS STRING), 1, 10)"
FOUR = "lpad(CAST(o.o_custkey % 10000 AS STRING), 4, '0')"
LAST = "lpad(CAST(o.o_custkey * 7 % 10000 AS STRING), 4, '0')"

VIEWS = {
    "inbound": f"""
SELECT
  CASE WHEN o.o_orderkey % 97 = 0 THEN '' WHEN o.o_orderkey % 101 = 0 THEN NULL
       ELSE 'INB-' || lpad(CAST(CASE WHEN o.o_orderkey % 53 = 0 THEN o.o_orderkey + 1 ELSE o.o_orderkey END AS STRING), 9, '0')
  END AS consultation_id,
  CASE WHEN o.o_orderkey % 61 = 0 THEN '미분류' WHEN o.o_orderkey % 67 = 0 THEN ' ' WHEN o.o_orderkey % 71 = 0 THEN NULL
       WHEN o.o_orderkey % 73 = 0 THEN 'PENDING' WHEN o.o_orderkey % 79 = 0 THEN 'CST_999'
       ELSE 'CST_' || o.o_orderstatus END AS status,
  'CON_' || substr(o.o_orderpriority, 1, 1) AS consultation_type,
  CASE o.o_orderkey % 7
       WHEN 0 THEN {DAY} || ' 09:30:00'
       WHEN 1 THEN replace({DAY}, '-', '/') || ' 09:30:00'
       WHEN 2 THEN replace({DAY}, '-', '.') || ' 09:30:00'
       WHEN 3 THEN {DAY} || 'T09:30:00'
       WHEN 4 THEN replace({DAY}, '-', '') || '093000'
       WHEN 5 THEN {DAY}
       ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'unknown' ELSE NULL END END AS started_at,
  {DAY} || CASE WHEN o.o_orderkey % 89 = 0 THEN ' 08:00:00' ELSE ' 10:00:00' END AS ended_at,
  CASE o.o_custkey % 6
       WHEN 0 THEN '010-' || {FOUR} || '-' || {LAST}
       WHEN 1 THEN '010 ' || {FOUR} || ' ' || {LAST}
       WHEN 2 THEN ' 010.' || {FOUR} || '.' || {LAST} || ' '
       WHEN 3 THEN '010' || {FOUR} || {LAST}
       WHEN 4 THEN '+82-10-' || {FOUR}
       ELSE NULL END AS phone_number,
  CASE WHEN o.o_custkey % 11 = 0 THEN 'not-an-email' ELSE 'user' || CAST(o.o_custkey AS STRING) || '@example.com' END AS email,
  o.o_custkey AS customer_id, c.c_name AS customer_name,
  'POL-' || lpad(CAST(o.o_custkey % 500 AS STRING), 6, '0') AS policy_id,
  CASE WHEN o.o_orderkey % 83 = 0 THEN 'N/A' ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS STRING) END AS premium,
  '2026-09-' || lpad(CAST(o.o_orderkey % 3 + 13 AS STRING), 2, '0') AS ingest_date
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey""",
    "outbound": """
SELECT 'CTI-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS CTI_ID,
  'LEAD-' || CAST(l_orderkey AS STRING) AS LEAD_MGMT_NO, l_linenumber AS TRY_CNT,
  'GD-' || lpad(CAST(l_partkey % 50 AS STRING), 2, '0') AS GD_CD,
  CASE WHEN l_partkey % 29 = 0 THEN 'STD-none' WHEN l_partkey % 31 = 0 THEN ' '
       ELSE ' STD-' || lpad(CAST(l_partkey AS STRING), 6, '0') END AS STD_CD,
  CASE WHEN l_orderkey % 41 = 0 THEN 'C99' ELSE 'C' || CASE l_returnflag WHEN 'A' THEN '01' WHEN 'N' THEN '02' ELSE '03' END END AS CONN_RSLT_CD,
  CAST(l_shipdate AS STRING) AS CALL_ST_DTM,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'TMR-' || CAST(l_suppkey AS STRING) END AS TMR_ID,
  CAST(floor(l_extendedprice) AS BIGINT) AS MN_PREM
FROM {lineitem}""",
    "homepage": """
SELECT 'CMPL-' || lpad(CAST(doc_id AS STRING), 8, '0') AS COMPLAINT_ID, text AS COMPLAINT_CONTENT, n_chars,
  upper(lang) AS LANG_CD, source AS RCV_PATH,
  CASE WHEN doc_id % 9 = 0 THEN 'X' WHEN doc_id % 2 = 0 THEN 'Y' ELSE 'N' END AS FSS_RELATED_YN,
  '2026/0' || CAST(doc_id % 9 + 1 AS STRING) || '/1' || CAST(doc_id % 10 AS STRING) || ' 09:00' AS REG_DT,
  '2026/0' || CAST(doc_id % 8 + 1 AS STRING) || '/2' || CAST(doc_id % 10 AS STRING) AS ANSWER_DUE_DT,
  '2026/' || CAST(doc_id % 9 + 1 AS STRING) || '/' || CAST(doc_id % 28 + 1 AS STRING) || ' 09:00:00' AS CLOSED_DT
FROM {documents}""",
    "salesforce": """
SELECT 'a0X' || lpad(CAST(event_id AS STRING), 12, '0') AS Id, 'SF-' || CAST(event_id AS STRING) AS Consultation_No__c,
  event_type AS Consult_Category__c, 'SES-' || CAST(user_id AS STRING) AS Session_Id__c,
  substr(CAST(ts AS STRING), 1, 19) AS Consult_Datetime__c, props AS Consult_Content__c,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Y' ELSE 'N' END AS Consent_Yn__c
FROM {events}""",
    "product": """
SELECT 'STD-' || lpad(CAST(p_partkey AS STRING), 6, '0') AS STD_PRODUCT_CODE, p_name AS STD_PRODUCT_NAME,
  p_brand AS PRODUCT_CLASS, p_type AS STD_CATEGORY
FROM {part}""",
    # A later snapshot of the products: some gone, some changed, some with a new category, some new.
    "product_later": """
SELECT 'STD-' || lpad(CAST(p_partkey AS STRING), 6, '0') AS STD_PRODUCT_CODE,
  CASE WHEN p_partkey % 13 = 0 THEN p_name || ' II' ELSE p_name END AS STD_PRODUCT_NAME,
  p_brand AS PRODUCT_CLASS,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type END AS STD_CATEGORY
FROM {part} WHERE p_partkey % 11 <> 0
UNION ALL
SELECT 'NEW-' || lpad(CAST(p_partkey AS STRING), 6, '0'), p_name, p_brand, p_type FROM {part} WHERE p_partkey % 37 = 0""",
    # Version history of the products: version 1 of all but some, and a second version, inactive for some.
    "product_history": """
SELECT 'STD-' || lpad(CAST(p_partkey AS STRING), 6, '0') AS STD_PRODUCT_CODE, 1 AS version, true AS is_active,
  p_name AS STD_PRODUCT_NAME, p_brand AS PRODUCT_CLASS, CASE WHEN p_partkey % 5 = 0 THEN 'OLD' ELSE p_type END AS STD_CATEGORY
FROM {part} WHERE p_partkey % 41 <> 0
UNION ALL
SELECT 'STD-' || lpad(CAST(p_partkey AS STRING), 6, '0'), 2, p_partkey % 23 <> 0, p_name, p_brand, p_type
FROM {part} WHERE p_partkey % 41 <> 0 AND (p_partkey % 5 = 0 OR p_partkey % 23 = 0)""",
    # Customer records from two sources, before merging. Names or birth dates are missing for some.
    "customer_records": f"""
SELECT CAST(NULL AS STRING) AS CUST_ID,
  CASE WHEN o.o_orderkey % 47 = 0 THEN NULL ELSE c.c_name END AS CUST_NM,
  '19' || lpad(CAST(o.o_custkey % 60 + 40 AS STRING), 2, '0') || '-01-15' AS BRTH_DT,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE '010' || {FOUR} || {LAST} END AS TEL_NO,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_orderpriority END AS GRADE_CD,
  'inbound' AS _source_system, 'bronze.inbound' AS _source_table,
  'INB-' || CAST(o.o_orderkey AS STRING) AS _source_record_key,
  '2026-09-' || CAST(o.o_orderkey % 3 + 13 AS STRING) AS _source_batch_id,
  CASE WHEN o.o_orderkey % 59 = 0 THEN NULL WHEN o.o_custkey % 5 = 0 THEN substr({DAY}, 1, 4) || '-01-01' ELSE {DAY} END AS ref_day
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT CAST(NULL AS STRING), c.c_name,
  CASE WHEN l.l_partkey % 43 = 0 THEN NULL ELSE '19' || lpad(CAST(o.o_custkey % 60 + 40 AS STRING), 2, '0') || '-01-15' END,
  CASE WHEN l.l_partkey % 7 = 0 THEN '010' || {FOUR} || '0000' ELSE NULL END,
  NULL, 'outbound', 'bronze.outbound',
  'CTI-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING),
  '2026-09-14', CASE WHEN o.o_custkey % 5 = 0 THEN substr(CAST(l.l_shipdate AS STRING), 1, 4) || '-01-01' ELSE substr(CAST(l.l_shipdate AS STRING), 1, 10) END
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey JOIN {{customer}} c ON o.o_custkey = c.c_custkey""",
    # Mapped consultation records as they arrive at target validation.
    "counsel": f"""
SELECT CASE WHEN o.o_orderkey % 103 = 0 THEN NULL WHEN o.o_orderkey % 107 = 0 THEN ' '
            WHEN o.o_orderkey % 53 = 0 THEN 'INB-' || CAST(o.o_orderkey + 1 AS STRING) ELSE 'INB-' || CAST(o.o_orderkey AS STRING) END AS CNSL_ID,
  CASE o.o_orderstatus WHEN 'F' THEN 'FIN' WHEN 'O' THEN 'OPEN' ELSE CASE WHEN o.o_orderkey % 19 = 0 THEN NULL WHEN o.o_orderkey % 2 = 0 THEN 'PEND' ELSE 'OPEN' END END AS CNSL_ST_CD,
  o.o_orderpriority AS CNSL_TYPE_CD,
  {DAY} || CASE WHEN o.o_orderkey % 89 = 0 THEN ' 12:00:00' ELSE ' 09:30:00' END AS STRT_DTM,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE {DAY} || ' 10:00:00' END AS END_DTM,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 61 = 0 THEN 'CUST-X' ELSE 'CUST-' || lpad(CAST(o.o_custkey AS STRING), 6, '0') END AS CUST_ID,
  'inbound' AS _source_system, 'bronze.inbound' AS _source_table, 'INB-' || CAST(o.o_orderkey AS STRING) AS _source_record_key,
  '2026-09-' || CAST(o.o_orderkey % 3 + 13 AS STRING) AS _source_batch_id
FROM {{orders}} o
UNION ALL
SELECT CASE WHEN l.l_partkey % 1999 = 0 THEN 'INB-' || CAST(l.l_orderkey AS STRING) ELSE 'CTI-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) END,
  CASE l.l_linestatus WHEN 'F' THEN 'FIN' ELSE 'OPEN' END, l.l_returnflag, CAST(l.l_shipdate AS STRING), NULL,
  NULL, 'outbound', 'bronze.outbound',
  'CTI-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) || '-' || CAST(CAST(floor(l.l_extendedprice * 100) AS BIGINT) AS STRING),
  '2026-09-14'
FROM {{lineitem}} l""",
    "customer_parent": """
SELECT 'CUST-' || lpad(CAST(c_custkey AS STRING), 6, '0') AS CUST_ID, c_name AS CUST_NM FROM {customer} WHERE c_custkey % 17 <> 0""",
    # Approved product crosswalk: channel code and system to product key.
    "crosswalk": """
SELECT CASE WHEN p_partkey % 2 = 0 THEN 'OUTBOUND' ELSE 'inbound ' END AS SRC_SYS,
  'GD-' || lpad(CAST(p_partkey % 50 AS STRING), 2, '0') AS SRC_PRD_CD,
  'PRD-' || lpad(CAST(p_partkey % 50 AS STRING), 6, '0') AS TGT_PRD_ID,
  CASE WHEN p_partkey % 50 < 40 THEN 'Y' ELSE 'N' END AS APRV_YN
FROM {part}""",
    "product_parent": """
SELECT 'PRD-' || lpad(CAST(p_partkey AS STRING), 6, '0') AS PRD_ID, ' STD-' || lpad(CAST(p_partkey AS STRING), 6, '0') || ' ' AS PRD_CD
FROM {part} WHERE p_partkey % 3 <> 0""",
    # Which entity an outbound record went into.
    "customer_lineage": """
SELECT 'outbound' AS _source_system, '2026-09-14' AS _source_batch_id,
  'CTI-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS _source_record_key,
  'CUSTOMER' AS TARGET_ENTITY, min('CUST-' || lpad(CAST(l_orderkey % 1000 AS STRING), 6, '0')) AS TARGET_PK
FROM {lineitem} WHERE l_orderkey % 9 <> 0 GROUP BY l_orderkey, l_linenumber""",
}

TABLES = "region nation customer supplier part orders lineitem events documents labels conversations".split()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a frame over the given tables."""
    used = {t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in VIEWS[name]}
    return spark.sql(VIEWS[name], **used)


def cte(*names: str) -> str:
    """Views as common table expressions for the checking SQL."""
    return ",\n".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as nested chat sessions: every line of the text is a query, every turn before it a step."""
    turns = load(spark, sf_dir, "conversations")
    step = F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.greatest("turn", F.lit(1))),
        lambda n: F.struct(
            n.alias("step"),
            F.col("role").alias("menu_level"),
            F.concat(F.lit("menu "), n.cast("string")).alias("menu_name"),
            F.concat(F.lit("/"), F.col("role"), F.lit("/"), n.cast("string")).alias("full_path"),
            F.lit("2026-09-13T09:00:00+09:00").alias("timestamp"),
        ),
    )
    query = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("query"),
            (F.length(line) % 4 == 0).alias("matched"),
            F.array(F.col("role"), F.lit("x")).alias("matched_items"),
            F.lit("2026-09-13T09:01:00+09:00").alias("timestamp"),
        ),
    )
    session = F.struct(
        F.concat_ws("-", F.lit("CHAT"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("session_id"),
        F.lit("APP").alias("channel"),
        F.col("turn").alias("duration_seconds"),
        (F.col("conv_id") % 2 == 0).alias("is_logged_in"),
        F.struct(F.col("turn").alias("turns"), F.lit("done").alias("state")).alias("resolution"),
        F.when(F.col("turn") > 0, step).alias("navigation_path"),
        F.when(F.col("role") != "system", query).alias("free_text_queries"),
    )
    return turns.select(F.array(session).alias("sessions"))
