"""Mapping of inbound and outbound records to the consultation target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import joined_or_null
from tidemark.operators import mapping as m
from tidemark.operators.model import TargetModel
from tidemark.session import metadata_frame
from workload.views import cte, view

# Target model rows (table, column, type, key, nullable, description).
MODEL_ROWS = [
    ("COUNSEL", "CNSL_ID", "VARCHAR(20)", "PK", "N", ""),
    ("COUNSEL", "CHNL_CD", "VARCHAR(10)", None, "N", "INB/OUT/WEB"),
    ("COUNSEL", "CNSL_ST_CD", "VARCHAR(10)", None, "Y", "FIN/OPEN"),
    ("COUNSEL", "STRT_DTM", "TIMESTAMP", None, "N", ""),
    ("COUNSEL", "END_DTM", "TIMESTAMP", None, "Y", ""),
    ("COUNSEL", "REG_DT", "DATE", None, "Y", ""),
    ("COUNSEL", "PREM_AMT", "DECIMAL(15, 2)", None, "Y", ""),
    ("COUNSEL", "TEL_NO", "CHAR(20)", None, "Y", ""),
    ("COUNSEL", "CUST_ID", "VARCHAR(20)", "FK", "Y", "→ CUSTOMER.CUST_ID"),
    ("COUNSEL", "PRD_ID", "VARCHAR(20)", "FK", "Y", "→ PRODUCT.PRD_ID"),
    ("COUNSEL", "CNSL_NOTE", "TEXT", None, "Y", ""),
    ("CUSTOMER", "CUST_ID", "VARCHAR(20)", "PK", "N", ""),
    ("CUSTOMER", "CUST_NM", "VARCHAR(50)", None, "N", ""),
    ("PRODUCT", "PRD_ID", "VARCHAR(20)", "PK", "N", ""),
    ("PRODUCT", "PRD_CD", "VARCHAR(20)", "UK", "N", ""),
]
# Mapping rules (id, version, system, target column, source column, mapping type, process type, code rule, status).
RULE_ROWS = [
    ("M-INB-01", "1", "INBOUND", "CNSL_ID", "consultation_id", "RENAME", "COPY", None, "ACTIVE"),
    ("M-INB-02", "1", "inbound ", "CHNL_CD", "(SOURCE_SYSTEM)", "DERIVED", "CONSTANT", None, "ACTIVE"),
    ("M-INB-03", "2", "INBOUND", "CNSL_ST_CD", "status", "CODE", "LOOKUP", None, " active"),
    ("M-INB-04", "1", "INBOUND", "STRT_DTM", "started_at", "TRANSFORM", "FORMAT", None, "ACTIVE"),
    ("M-INB-05", "1", "INBOUND", "END_DTM", "ended_at", "DIRECT", "COPY", None, "ACTIVE"),
    ("M-INB-06", "1", "INBOUND", "REG_DT", "ingest_date", "DIRECT", "COPY", None, "ACTIVE"),
    ("M-INB-07", "1", "INBOUND", "PREM_AMT", "premium", "RENAME", "COPY", None, "ACTIVE"),
    ("M-INB-08", "1", "INBOUND", "TEL_NO", "phone_number", "TRANSFORM", "FORMAT", None, "ACTIVE"),
    ("M-INB-09", "1", "INBOUND", "CNSL_NOTE", "email", "CUSTOMER_MATCH", "EXPLODE", None, "ACTIVE"),
    ("M-INB-10", "1", "INBOUND", "TEL_NO", "email", "RENAME", "COPY", None, "SUPERSEDED"),
    ("M-OUT-01", "1", "OUTBOUND", "CNSL_ID", "CTI_ID", "RENAME", "COPY", None, "ACTIVE"),
    ("M-OUT-02", "1", "OUTBOUND", "CHNL_CD", "<SOURCE_SYSTEM>", "DERIVED", "CONSTANT", None, "ACTIVE"),
    ("M-OUT-03", "1", "OUTBOUND", "CNSL_ST_CD", "CONN_RSLT_CD", "CODE", "LOOKUP", None, "ACTIVE"),
    ("M-OUT-04", "1", "OUTBOUND", "STRT_DTM", "CALL_ST_DTM", "DIRECT", "COPY", None, "ACTIVE"),
    ("M-OUT-05", "1", "OUTBOUND", "CUST_ID", "CTI_ID", "DERIVED", "LOOKUP", None, "ACTIVE"),
    ("M-OUT-06", "1", "OUTBOUND", "PRD_ID", "GD_CD", "DERIVED", "LOOKUP", "product_mapping", "ACTIVE"),
]
# Code map rows (system, source column, target group, source code, target code, status).
CODE_ROWS = [
    ("인바운드", "status", "CNSL_ST_CD", "CST_F", "FIN", "APPROVED"),
    ("인바운드", "status", "CNSL_ST_CD", " CST_O ", "OPEN", "approved"),
    ("인바운드", "status", "CNSL_ST_CD", "CST_P", "PEND", "REVIEW"),
    ("인바운드", "status", "CNSL_ST_CD", "CST_999", " ", "APPROVED"),
    ("인바운드", "(SOURCE_SYSTEM)", "CHNL_CD", "인바운드", "INB", "APPROVED"),
    ("아웃바운드", "CONN_RSLT_CD", "CNSL_ST_CD", "C01", "FIN", "APPROVED"),
    ("아웃바운드", "CONN_RSLT_CD", "CNSL_ST_CD", "C02", "OPEN", "APPROVED"),
    ("아웃바운드", "<SOURCE_SYSTEM>", "CHNL_CD", "아웃바운드", "OUT", "APPROVED"),
]
MODEL_COLUMNS = ["TABLE_NAME", "COLUMN_NAME", "DATA_TYPE", "KEY", "NULLABLE", "DESCRIPTION"]
RULE_COLUMNS = ["rule_id", "rule_version", "source_system", "target_column", "source_column", "mapping_type", "process_type",
                "code_mapping_rule", "rule_status"]
CODE_COLUMNS = ["SOURCE_SYSTEM", "SOURCE_COLUMN", "TARGET_CODE_GROUP_ID", "SOURCE_CODE", "TARGET_CODE", "MAPPING_STATUS"]


def model_frame(spark: SparkSession) -> DataFrame:
    rows = [dict(zip(MODEL_COLUMNS, r), ORDINAL=i) for i, r in enumerate(MODEL_ROWS, 1)]
    return metadata_frame(spark, rows)


def rule_frame(spark: SparkSession) -> DataFrame:
    rows = [dict(zip(RULE_COLUMNS, r), target_table="COUNSEL") for r in RULE_ROWS]
    return metadata_frame(spark, rows)


def code_frame(spark: SparkSession) -> DataFrame:
    return metadata_frame(spark, [dict(zip(CODE_COLUMNS, r)) for r in CODE_ROWS])


def with_lineage(rows: DataFrame, source: str, key: str, batch) -> DataFrame:
    return rows.withColumns(
        {
            "_source_system": F.lit(source),
            "_source_table": F.lit(f"bronze.{source}"),
            "_source_record_key": F.col(key),
            "_source_batch_id": batch,
        }
    )


def mapped(spark, sf_dir, system: str) -> DataFrame:
    name = system.lower()
    if name == "inbound":
        rows = with_lineage(view(spark, sf_dir, name), name, "consultation_id", F.col("ingest_date"))
        lookups = m.Lookups()
    else:
        rows = with_lineage(view(spark, sf_dir, name), name, "CTI_ID", F.lit("2026-09-14"))
        parents = {"CUSTOMER": view(spark, sf_dir, "customer_parent"), "PRODUCT": view(spark, sf_dir, "product_parent")}
        lineage = {"CUSTOMER": view(spark, sf_dir, "customer_lineage")}
        lookups = m.Lookups(view(spark, sf_dir, "crosswalk"), parents, lineage)
    rules = m.load_rules(m.renamed_rules(rule_frame(spark)), system, "COUNSEL")
    model = TargetModel.from_frame(model_frame(spark))
    return m.map_source(rows, system, "COUNSEL", model, rules, code_frame(spark), lookups, "run").frame


def readable(df: DataFrame) -> DataFrame:
    """Times, dates and amounts as text, so both engines print them alike."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    return df.withColumns(
        {
            "STRT_DTM": F.date_format("STRT_DTM", stamp),
            "END_DTM": F.date_format("END_DTM", stamp),
            "REG_DT": F.date_format("REG_DT", "yyyy-MM-dd"),
            "PREM_AMT": F.col("PREM_AMT").cast("string"),
            "_map_errors": joined_or_null(F.col("_map_errors")),
            "_unmapped_codes": joined_or_null(F.col("_unmapped_codes")),
        }
    ).drop("_mapped_at", "_mapping_run_id", "_mapping_version", "_job_run_id", "_dq_run_id")


def columns(system: str, *names: str):
    def run(spark, sf_dir):
        return readable(mapped(spark, sf_dir, system)).select("_source_record_key", *names)

    return run


def both(spark, sf_dir) -> DataFrame:
    return mapped(spark, sf_dir, "INBOUND").unionByName(mapped(spark, sf_dir, "OUTBOUND"))


def map_fk_natural_key(spark, sf_dir):
    rows = m.join_natural_key(view(spark, sf_dir, "outbound"), "STD_CD", view(spark, sf_dir, "product_parent"), "PRD_CD", "PRD_ID", "PRD_ID")
    return rows.select("CTI_ID", "STD_CD", "PRD_ID")


def map_crosswalk_build(spark, sf_dir):
    """Crosswalk rows for every product, with the key of the loaded product."""
    products = view(spark, sf_dir, "product_parent")
    pairs = products.select(
        F.lit("OUTBOUND").alias("SRC_SYS"), F.concat(F.lit("GD-"), F.trim("PRD_CD")).alias("SRC_PRD_CD"), F.trim("PRD_CD").alias("STD_CODE")
    )
    return m.build_crosswalk(pairs, products, "PRD_CD", "PRD_ID")


def map_fk_lineage_fallback(spark, sf_dir):
    """Lookup in the representative rows of an entity, for targets without a lineage table."""
    rows = with_lineage(view(spark, sf_dir, "outbound"), "outbound", "CTI_ID", F.lit("2026-09-14"))
    parents = view(spark, sf_dir, "customer_lineage").withColumnRenamed("TARGET_PK", "CUST_ID")
    return m.join_lineage(rows, parents, "CUST_ID", "CUST_ID").select("_source_record_key", "CUST_ID")


def conflicting_codes(spark, sf_dir) -> DataFrame:
    """Code map rows derived from order priorities and status, where some codes have two targets."""
    orders = view(spark, sf_dir, "counsel").filter("_source_system = 'inbound'")
    return orders.select(
        F.lit("인바운드").alias("SOURCE_SYSTEM"), F.lit("type").alias("SOURCE_COLUMN"), F.lit("TYPE_CD").alias("TARGET_CODE_GROUP_ID"),
        F.concat(F.lit(" "), F.col("CUST_ID")).alias("SOURCE_CODE"),
        F.when(F.col("CNSL_TYPE_CD") == "1-URGENT", F.lit("U")).otherwise(F.lit("N")).alias("TARGET_CODE"),
        F.when(F.col("CNSL_ST_CD") == "FIN", F.lit("Approved")).otherwise(F.lit("REVIEW")).alias("MAPPING_STATUS"),
    )


def map_code_conflict(spark, sf_dir):
    found = m.code_conflicts(m.approved_codes(conflicting_codes(spark, sf_dir)))
    return found.select("SOURCE_CODE", "first_code", "last_code")


QUERIES = {
    "map_direct": lambda s, d: readable(mapped(s, d, "INBOUND")),
    "map_outbound": lambda s, d: readable(mapped(s, d, "OUTBOUND")),
    "map_constant": columns("OUTBOUND", "CHNL_CD"),
    "map_code_lookup": columns("INBOUND", "CNSL_ST_CD", "_unmapped_codes"),
    "map_timestamp_tz": columns("INBOUND", "STRT_DTM", "END_DTM", "_map_errors"),
    "map_date": columns("INBOUND", "REG_DT"),
    "map_fk_natural_key": map_fk_natural_key,
    "map_fk_crosswalk": columns("OUTBOUND", "PRD_ID", "_unmapped_codes"),
    "map_crosswalk_build": map_crosswalk_build,
    "map_fk_lineage": columns("OUTBOUND", "CUST_ID"),
    "map_fk_lineage_fallback": map_fk_lineage_fallback,
    "map_clean_rows": lambda s, d: readable(m.clean_rows(mapped(s, d, "INBOUND"))),
    "map_error_rows": lambda s, d: readable(m.error_rows(mapped(s, d, "INBOUND"))),
    "map_errors_unmapped": lambda s, d: m.mapping_summary(both(s, d)),
    "map_errors_by_column": lambda s, d: m.errors_by_column(both(s, d)),
    "map_unmapped_counts": lambda s, d: m.unmapped_by_value(both(s, d)),
    "map_code_conflict": map_code_conflict,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_STD = "%Y-%m-%d %H:%M:%S"


def _utc(text: str) -> str:
    """Local Seoul time as UTC. Seoul has had no summer time since 1988, so the offset is fixed for these dates."""
    shaped = rf"CASE WHEN regexp_matches(trim({text}), '^\d{{4}}-\d{{2}}-\d{{2}}( \d{{2}}:\d{{2}}:\d{{2}})?$') THEN coalesce(try_strptime(trim({text}), '{_STD}'), try_strptime(trim({text}), '%Y-%m-%d')) END"
    return f"strftime(({shaped}) - INTERVAL 9 HOUR, '{_STD}')"


_IN = f"""inb AS (SELECT consultation_id AS CNSL_ID, 'INB' AS CHNL_CD, CASE trim(status) WHEN 'CST_F' THEN 'FIN' WHEN 'CST_O' THEN 'OPEN' END AS CNSL_ST_CD,
  {_utc('started_at')} AS STRT_DTM, {_utc('ended_at')} AS END_DTM, ingest_date AS REG_DT, CAST(TRY_CAST(premium AS DECIMAL(15, 2)) AS VARCHAR) AS PREM_AMT,
  phone_number AS TEL_NO, CAST(NULL AS VARCHAR) AS CUST_ID, CAST(NULL AS VARCHAR) AS PRD_ID, CAST(NULL AS VARCHAR) AS CNSL_NOTE,
  'inbound' AS _source_system, 'bronze.inbound' AS _source_table, consultation_id AS _source_record_key, ingest_date AS _source_batch_id,
  nullif(concat_ws(',', CASE WHEN trim(coalesce(started_at, '')) <> '' AND {_utc('started_at')} IS NULL THEN 'STRT_DTM' END,
    CASE WHEN {_utc('ended_at')} IS NULL THEN 'END_DTM' END, CASE WHEN TRY_CAST(premium AS DECIMAL(15, 2)) IS NULL THEN 'PREM_AMT' END), '') AS _map_errors,
  CASE WHEN trim(coalesce(status, '')) <> '' AND trim(status) NOT IN ('CST_F', 'CST_O') THEN 'CNSL_ST_CD=' || trim(status) END AS _unmapped_codes FROM inbound)"""
_OUT = f"""x AS (SELECT DISTINCT trim(SRC_PRD_CD) AS code, TGT_PRD_ID FROM crosswalk WHERE upper(trim(SRC_SYS)) = 'OUTBOUND' AND APRV_YN = 'Y'),
lin AS (SELECT _source_record_key AS k, min(TARGET_PK) AS pk FROM customer_lineage GROUP BY 1),
outb AS (SELECT CTI_ID AS CNSL_ID, 'OUT' AS CHNL_CD, CASE CONN_RSLT_CD WHEN 'C01' THEN 'FIN' WHEN 'C02' THEN 'OPEN' END AS CNSL_ST_CD,
  {_utc('CALL_ST_DTM')} AS STRT_DTM, CAST(NULL AS VARCHAR) AS END_DTM, CAST(NULL AS VARCHAR) AS REG_DT, CAST(NULL AS VARCHAR) AS PREM_AMT, CAST(NULL AS VARCHAR) AS TEL_NO,
  pk AS CUST_ID, TGT_PRD_ID AS PRD_ID, CAST(NULL AS VARCHAR) AS CNSL_NOTE, 'outbound' AS _source_system, 'bronze.outbound' AS _source_table,
  CTI_ID AS _source_record_key, '2026-09-14' AS _source_batch_id, CAST(NULL AS VARCHAR) AS _map_errors,
  nullif(concat_ws(',', CASE WHEN CONN_RSLT_CD NOT IN ('C01', 'C02') THEN 'CNSL_ST_CD=' || CONN_RSLT_CD END, CASE WHEN pk IS NULL THEN 'CUST_ID=' || CTI_ID END,
    CASE WHEN TGT_PRD_ID IS NULL THEN 'PRD_ID=' || GD_CD END), '') AS _unmapped_codes
  FROM outbound LEFT JOIN x ON trim(GD_CD) = code LEFT JOIN lin ON CTI_ID = k)"""
_INB = f"WITH {cte('inbound')}, {_IN}"
_OUTB = f"WITH {cte('outbound', 'crosswalk', 'customer_lineage')}, {_OUT}"
_BOTH = f"WITH {cte('inbound', 'outbound', 'crosswalk', 'customer_lineage')}, {_IN}, {_OUT}, u AS (SELECT * FROM inb UNION ALL SELECT * FROM outb)"
ORACLES = {
    "map_direct": f"{_INB} SELECT * FROM inb",
    "map_outbound": f"{_OUTB} SELECT * FROM outb",
    "map_constant": f"{_OUTB} SELECT _source_record_key, CHNL_CD FROM outb",
    "map_code_lookup": f"{_INB} SELECT _source_record_key, CNSL_ST_CD, _unmapped_codes FROM inb",
    "map_timestamp_tz": f"{_INB} SELECT _source_record_key, STRT_DTM, END_DTM, _map_errors FROM inb",
    "map_date": f"{_INB} SELECT _source_record_key, REG_DT FROM inb",
    "map_fk_natural_key": f"""WITH {cte('outbound', 'product_parent')} SELECT CTI_ID, STD_CD, PRD_ID FROM outbound LEFT JOIN product_parent ON trim(STD_CD) = trim(PRD_CD)""",
    "map_fk_crosswalk": f"{_OUTB} SELECT _source_record_key, PRD_ID, _unmapped_codes FROM outb",
    "map_crosswalk_build": f"""WITH {cte('product_parent')} SELECT 'OUTBOUND' AS SRC_SYS, 'GD-' || trim(PRD_CD) AS SRC_PRD_CD, PRD_ID AS TGT_PRD_ID, 'Y' AS APRV_YN FROM product_parent""",
    "map_fk_lineage": f"{_OUTB} SELECT _source_record_key, CUST_ID FROM outb",
    "map_fk_lineage_fallback": f"{_OUTB} SELECT _source_record_key, CUST_ID FROM outb",
    "map_clean_rows": f"{_INB} SELECT * FROM inb WHERE _map_errors IS NULL",
    "map_error_rows": f"{_INB} SELECT * FROM inb WHERE _map_errors IS NOT NULL",
    "map_errors_unmapped": f"""{_BOTH} SELECT count(*) AS output_count, count(_map_errors) AS conversion_error_rows, count(_unmapped_codes) AS unmapped_code_rows FROM u""",
    "map_errors_by_column": f"{_BOTH} SELECT target_column, count(*) AS rows FROM (SELECT unnest(string_split(_map_errors, ',')) AS target_column FROM u) GROUP BY 1",
    "map_unmapped_counts": f"{_BOTH} SELECT unmapped, count(*) AS rows FROM (SELECT unnest(string_split(_unmapped_codes, ',')) AS unmapped FROM u) GROUP BY 1",
    "map_code_conflict": f"""WITH {cte('counsel')}, c AS (SELECT DISTINCT CUST_ID AS code, CASE WHEN CNSL_TYPE_CD = '1-URGENT' THEN 'U' ELSE 'N' END AS target
          FROM counsel WHERE _source_system = 'inbound' AND CNSL_ST_CD = 'FIN')
        SELECT code AS SOURCE_CODE, min(target) AS first_code, max(target) AS last_code FROM c GROUP BY 1 HAVING count(*) > 1""",
}
