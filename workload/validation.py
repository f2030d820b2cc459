"""Target constraints on consultation records, and table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import joined_or_null
from tidemark.operators import diff
from tidemark.operators import validation as v
from tidemark.operators.keys import duplicate_keys, rows_and_values
from tidemark.operators.model import TargetModel
from workload.views import cte, load, view

# Target model rows (column, type, key, nullable, description).
MODEL_ROWS = [
    ("CNSL_ID", "VARCHAR(14)", "PK", "N", ""),
    ("CNSL_ST_CD", "VARCHAR(10)", None, "N", "FIN/OPEN"),
    ("CNSL_TYPE_CD", "VARCHAR(8)", None, "Y", "type of the consultation"),
    ("STRT_DTM", "VARCHAR(30)", None, "N", ""),
    ("END_DTM", "VARCHAR(30)", None, "Y", ""),
    ("CUST_ID", "VARCHAR(20)", "FK", "Y", "→ CUSTOMER.CUST_ID"),
]
NAMES = ("COLUMN_NAME", "DATA_TYPE", "KEY", "NULLABLE", "DESCRIPTION")
MODEL = TargetModel([dict(zip(NAMES, r), TABLE_NAME="COUNSEL", ORDINAL=i) for i, r in enumerate(MODEL_ROWS, 1)])
ORDER = [("VR-COUNSEL-022", "STRT_DTM", "END_DTM")]
REPAIR = v.PrimaryKeyRepair("CNSL_ID", "outbound")


def checked(spark, sf_dir, repair: bool = True, parents: bool = True) -> v.Validated:
    found = {"CUSTOMER": view(spark, sf_dir, "customer_parent")} if parents else {}
    return v.validate(view(spark, sf_dir, "counsel"), "COUNSEL", MODEL, found, ORDER, REPAIR if repair else None)


def rule_rows(*kinds: str):
    """Records that break a rule of the given kinds, with the broken rules."""

    def run(spark, sf_dir) -> DataFrame:
        rules = [r for r in v.derive_rules(MODEL, "COUNSEL", ORDER) if r.kind in kinds]
        rows = v.with_violations(view(spark, sf_dir, "counsel"), rules, {"CUSTOMER": view(spark, sf_dir, "customer_parent")})
        text = joined_or_null(F.col("_violations")).alias("violations")
        return v.failed(rows).select("_source_record_key", text)

    return run


def val_split(spark, sf_dir):
    frame = checked(spark, sf_dir).frame
    return frame.withColumn("_violations", joined_or_null(F.col("_violations")))


def val_pk_dedup(spark, sf_dir):
    rows = v.repair_primary_keys(view(spark, sf_dir, "counsel"), REPAIR)
    return rows.filter(F.col("_remediated_CNSL_ID").isNotNull()).select("_source_record_key", "CNSL_ID", "_remediated_CNSL_ID")


def val_missing_parent(spark, sf_dir):
    """Without the parent table the foreign key is skipped: its rule never shows up."""
    return v.violations_by_rule(checked(spark, sf_dir, parents=False).frame)


def val_trace(spark, sf_dir):
    found = checked(spark, sf_dir)
    trace = v.migration_trace(found.frame, "COUNSEL", "CNSL_ID", "run", stored=True, unique=v.unique_rule(found.rules, "CNSL_ID"))
    return trace.drop("TRC_ID", "LOAD_DTM")


def val_trace_ids(spark, sf_dir):
    """Trace rows and their different ids, on records that all come twice."""
    rows = view(spark, sf_dir, "counsel")
    found = {"CUSTOMER": view(spark, sf_dir, "customer_parent")}
    twice = v.validate(rows.unionAll(rows), "COUNSEL", MODEL, found, ORDER, REPAIR)
    trace = v.migration_trace(twice.frame, "COUNSEL", "CNSL_ID", "run", stored=True, unique=v.unique_rule(twice.rules, "CNSL_ID"))
    return rows_and_values(trace, "TRC_ID", "rows", "ids")


def versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Outbound records, and the same with some gone, some changed and some twice."""
    old = view(spark, sf_dir, "outbound")
    price = F.when(F.col("MN_PREM") % 97 == 0, F.col("MN_PREM") + 1).otherwise(F.col("MN_PREM"))
    kept = old.filter(F.col("MN_PREM") % 89 != 0).withColumn("MN_PREM", price)
    return old, kept.unionByName(kept.filter(F.col("MN_PREM") % 83 == 0))


def diff_report(spark, sf_dir):
    old, new = versions(spark, sf_dir)
    return diff.table_report(old, new, "CTI_ID")


def diff_rows(spark, sf_dir):
    old, new = versions(spark, sf_dir)
    return diff.row_difference(old, new, diff.common_columns(old, new))


def diff_by_digest(spark, sf_dir):
    old, new = versions(spark, sf_dir)
    return diff.row_difference_by_digest(old, new, diff.common_columns(old, new))


def diff_only_old(spark, sf_dir):
    old, new = versions(spark, sf_dir)
    return diff.rows_only_in(old, new, diff.common_columns(old, new))


def diff_repeated_keys(spark, sf_dir):
    return duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES = {
    "val_constraints": rule_rows("NOT_NULL", "LENGTH", "DOMAIN", "ORDER"),
    "val_unique": rule_rows("UNIQUE"),
    "val_fk": rule_rows("FK"),
    "val_domain_length": rule_rows("DOMAIN", "LENGTH"),
    "val_pk_dedup": val_pk_dedup,
    "val_split": val_split,
    "val_by_rule": lambda s, d: v.violations_by_rule(checked(s, d).frame),
    "val_without_repair": lambda s, d: v.violations_by_rule(checked(s, d, repair=False).frame),
    "val_missing_parent": val_missing_parent,
    "val_reconcile": lambda s, d: v.reconcile(view(s, d, "counsel"), checked(s, d).frame),
    "val_trace": val_trace,
    "val_trace_ids": val_trace_ids,
    "diff_tables": diff_report,
    "diff_rows": diff_rows,
    "diff_by_digest": diff_by_digest,
    "diff_only_old": diff_only_old,
    "diff_repeated_keys": diff_repeated_keys,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_CONDITIONS = {
    "VR-COUNSEL-001-NOTNULL": "CNSL_ID IS NULL OR trim(CNSL_ID) = ''",
    "VR-COUNSEL-001-UNIQUE": "CNSL_ID IS NOT NULL AND trim(CNSL_ID) <> '' AND n > 1",
    "VR-COUNSEL-001-LENGTH": "length(CNSL_ID) > 14",
    "VR-COUNSEL-002-NOTNULL": "CNSL_ST_CD IS NULL OR trim(CNSL_ST_CD) = ''",
    "VR-COUNSEL-002-LENGTH": "length(CNSL_ST_CD) > 10",
    "VR-COUNSEL-002-DOMAIN": "CNSL_ST_CD NOT IN ('FIN', 'OPEN')",
    "VR-COUNSEL-003-LENGTH": "length(CNSL_TYPE_CD) > 8",
    "VR-COUNSEL-004-NOTNULL": "STRT_DTM IS NULL OR trim(STRT_DTM) = ''",
    "VR-COUNSEL-004-LENGTH": "length(STRT_DTM) > 30",
    "VR-COUNSEL-005-LENGTH": "length(END_DTM) > 30",
    "VR-COUNSEL-006-LENGTH": "length(CUST_ID) > 20",
    "VR-COUNSEL-022": "STRT_DTM > END_DTM",
    "VR-COUNSEL-006-FK": "CUST_ID IS NOT NULL AND CUST_ID NOT IN (SELECT CUST_ID FROM customer_parent)",
}


def _listed(*kinds: str) -> str:
    chosen = {r: c for r, c in _CONDITIONS.items() if not kinds or any(r.endswith(k) for k in kinds)}
    whens = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in chosen.items())
    return f"nullif(concat_ws(',', {whens}), '')"


_BASE = f"""WITH {cte('counsel', 'customer_parent')},
raw AS (SELECT *, count(*) OVER (PARTITION BY CNSL_ID) AS n FROM counsel),
ranked AS (SELECT * EXCLUDE (n), row_number() OVER (PARTITION BY CNSL_ID ORDER BY CASE WHEN _source_system = 'outbound' THEN 1 ELSE 0 END, _source_record_key) AS r FROM counsel
  JOIN (SELECT CNSL_ID, count(*) AS n FROM counsel GROUP BY 1) USING (CNSL_ID)),
fixed AS (SELECT c.* EXCLUDE (CNSL_ID, r), CASE WHEN r > 1 AND _source_system = 'outbound' THEN CNSL_ID || '-DUP' || CAST(r AS VARCHAR) ELSE CNSL_ID END AS CNSL_ID,
  CASE WHEN r > 1 AND _source_system = 'outbound' THEN CNSL_ID END AS "_remediated_CNSL_ID" FROM ranked c
  UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS "_remediated_CNSL_ID" FROM counsel WHERE CNSL_ID IS NULL),
again AS (SELECT *, count(*) OVER (PARTITION BY CNSL_ID) AS n FROM fixed),
checked AS (SELECT * EXCLUDE (n), {_listed()} AS _violations FROM again)"""
_ONE_PASS = "SELECT rule_id, count(*) AS violations FROM (SELECT unnest(string_split(_violations, ',')) AS rule_id FROM {0}) GROUP BY 1"


def _rows(*kinds: str) -> str:
    return f"{_BASE} SELECT _source_record_key, {_listed(*kinds)} AS violations FROM raw WHERE {_listed(*kinds)} IS NOT NULL"


_COLUMNS = ["CTI_ID", "LEAD_MGMT_NO", "TRY_CNT", "GD_CD", "STD_CD", "CONN_RSLT_CD", "CALL_ST_DTM", "TMR_ID", "MN_PREM"]
_ALL = ", ".join(_COLUMNS)
_DIFF = f"""WITH {cte('outbound')}, kept AS (SELECT * REPLACE (CASE WHEN MN_PREM % 97 = 0 THEN MN_PREM + 1 ELSE MN_PREM END AS MN_PREM) FROM outbound WHERE MN_PREM % 89 <> 0),
new AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE MN_PREM % 83 = 0),
only_old AS (SELECT {_ALL} FROM outbound EXCEPT ALL SELECT {_ALL} FROM new),
only_new AS (SELECT {_ALL} FROM new EXCEPT ALL SELECT {_ALL} FROM outbound)"""
_NULLS = "\nUNION ALL ".join(
    f"SELECT 'null:{c}' AS \"check\", (SELECT count(*) FROM outbound WHERE {c} IS NULL) AS old_value, (SELECT count(*) FROM new WHERE {c} IS NULL) AS new_value" for c in _COLUMNS
)
ORACLES = {
    "val_constraints": _rows("NOTNULL", "LENGTH", "DOMAIN", "022"),
    "val_unique": _rows("UNIQUE"),
    "val_fk": _rows("FK"),
    "val_domain_length": _rows("LENGTH", "DOMAIN"),
    "val_pk_dedup": f'{_BASE} SELECT _source_record_key, CNSL_ID, "_remediated_CNSL_ID" FROM fixed WHERE "_remediated_CNSL_ID" IS NOT NULL',
    "val_split": f"{_BASE} SELECT * FROM checked",
    "val_by_rule": f"{_BASE} {_ONE_PASS.format('checked')}",
    "val_without_repair": f"{_BASE}, c AS (SELECT {_listed()} AS _violations FROM raw) {_ONE_PASS.format('c')}",
    "val_missing_parent": f"{_BASE}, c AS (SELECT {_listed('NOTNULL', 'UNIQUE', 'LENGTH', 'DOMAIN', '022')} AS _violations FROM again) {_ONE_PASS.format('c')}",
    "val_reconcile": f"""{_BASE} SELECT (SELECT count(*) FROM counsel) AS input_count, count(*) FILTER (_violations IS NULL) AS loaded_count, count(_violations) AS quarantined_count,
        (SELECT count(*) FROM counsel) = count(*) AS reconciled FROM checked""",
    "val_trace": f"""{_BASE} SELECT _source_batch_id AS MIG_BATCH_ID, _source_system AS SRC_SYS, _source_table AS SRC_TBL, _source_record_key AS SRC_KEY, 'COUNSEL' AS TGT_TBL,
        CASE WHEN _violations IS NULL THEN CNSL_ID END AS TGT_KEY, CASE WHEN _violations IS NULL THEN "_remediated_CNSL_ID" END AS ORIG_KEY,
        CASE WHEN _violations IS NULL THEN 'LOADED' ELSE 'GOLD_QUARANTINED' END AS MIG_ST_CD FROM checked""",
    "val_trace_ids": f"WITH {cte('counsel')} SELECT 2 * count(*) AS rows, 2 * count(*) AS ids FROM counsel",
    "diff_tables": f"""{_DIFF}, c AS (SELECT 'row_count' AS "check", (SELECT count(*) FROM outbound) AS old_value, (SELECT count(*) FROM new) AS new_value
        UNION ALL {_NULLS}
        UNION ALL SELECT 'repeated_keys', (SELECT count(*) FROM (SELECT 1 FROM outbound GROUP BY CTI_ID HAVING count(*) > 1)), (SELECT count(*) FROM (SELECT 1 FROM new GROUP BY CTI_ID HAVING count(*) > 1)))
        SELECT *, old_value = new_value AS is_match FROM c
        UNION ALL SELECT 'differing_rows', (SELECT count(*) FROM only_old), (SELECT count(*) FROM only_new), (SELECT count(*) FROM only_old) + (SELECT count(*) FROM only_new) = 0
        UNION ALL SELECT 'schema', 0, 0, true""",
    "diff_rows": f"""{_DIFF}, d AS (SELECT *, 1 AS o, 0 AS n FROM only_old UNION ALL SELECT *, 0, 1 FROM only_new)
        SELECT {_ALL}, CAST(sum(o) AS BIGINT) AS only_in_old, CAST(sum(n) AS BIGINT) AS only_in_new FROM d GROUP BY {_ALL}""",
    "diff_only_old": f"{_DIFF} SELECT * FROM only_old",
    "diff_repeated_keys": "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
}

ORACLES["diff_by_digest"] = ORACLES["diff_rows"]
