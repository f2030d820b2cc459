"""Versioned snapshots of the product master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import content_hash
from tidemark.operators import snapshot
from tidemark.operators.rules import normalise_rules, rule_constraints
from tidemark.operators.snapshot import Constraint
from tidemark.session import metadata_frame
from workload import sqltext as t
from workload.quality import INBOUND_RULES, OUTBOUND_RULES
from workload.views import cte, load, view

KEY, FIELDS = "STD_PRODUCT_CODE", ["STD_PRODUCT_NAME", "PRODUCT_CLASS", "STD_CATEGORY"]


def history(spark, sf_dir) -> DataFrame:
    rows = view(spark, sf_dir, "product_history")
    return rows.withColumns({"definition_hash": content_hash(FIELDS), "change_reason": F.lit(None).cast("string")})


def scd_latest(spark, sf_dir):
    return snapshot.latest_versions(history(spark, sf_dir), KEY).drop("change_reason")


def scd_active(spark, sf_dir):
    return snapshot.active_versions(history(spark, sf_dir), KEY).select(KEY, "version")


def plan(spark, sf_dir) -> DataFrame:
    return snapshot.plan_sync(view(spark, sf_dir, "product_later"), history(spark, sf_dir), KEY, FIELDS)


def scd_counts(spark, sf_dir):
    return plan(spark, sf_dir).groupBy("sync_status").agg(F.count(F.lit(1)).alias("rows"))


def scd_apply(spark, sf_dir):
    return snapshot.version_rows(plan(spark, sf_dir), KEY, FIELDS)


def scd_resync(spark, sf_dir):
    """Statuses of a second comparison after the plan was applied: nothing may be left to do."""
    versions = history(spark, sf_dir).unionByName(scd_apply(spark, sf_dir))
    again = snapshot.plan_sync(view(spark, sf_dir, "product_later"), versions, KEY, FIELDS)
    return again.groupBy("sync_status").agg(F.count(F.lit(1)).alias("rows"))


def scd_bad_keys(spark, sf_dir):
    """Statuses for a snapshot in which some keys come twice and some rows have none."""
    rows = view(spark, sf_dir, "product_later")
    economy = rows.filter("STD_CATEGORY = 'ECONOMY'")
    bad = rows.unionByName(economy).unionByName(economy.withColumn(KEY, F.lit(None).cast("string")))
    found = snapshot.plan_sync(bad, history(spark, sf_dir), KEY, FIELDS)
    return found.groupBy("sync_status").agg(F.count(F.lit(1)).alias("rows"))


def constraints() -> list[Constraint]:
    return [
        Constraint("category is empty", F.col("STD_CATEGORY").isNull()),
        Constraint("class is unknown", ~F.col("PRODUCT_CLASS").rlike(r"^Brand#[0-9]$")),
        Constraint("name is too long", F.length("STD_PRODUCT_NAME") > 14),
    ]


def snapshot_validate(spark, sf_dir):
    """All problems of a snapshot that also contains some keys twice."""
    rows = view(spark, sf_dir, "product_later")
    return snapshot.snapshot_problems(rows.unionByName(rows.filter("STD_CATEGORY = 'ECONOMY'")), KEY, constraints())


def rule_problems(spark, sf_dir):
    """Rule checks over rules made from the products: one faulty rule per product, each in its own way."""
    parts = load(spark, sf_dir, "part")
    fault = F.col("p_partkey") % 10
    raw = parts.select(
        F.when(fault == 0, F.lit(" ")).otherwise(F.format_string("STD-%06d", "p_partkey")).alias("rule_id"),
        F.col("p_name").alias("rule_name"),
        F.when(fault != 1, F.lit("inbound")).alias("target_table"),
        F.when(fault == 2, F.lit("other_check")).when(fault == 3, F.lit("order_check")).when(fault == 4, F.lit("RANGE_CHECK"))
        .otherwise(F.lit("pattern_check ")).alias("rule_type"),
        F.when(fault == 5, F.lit("a, b,")).otherwise(F.lit(" a ")).alias("target_columns"),
        F.when(fault != 6, F.lit("^x$")).alias("pattern"),
        F.when(fault == 4, F.lit("9")).alias("min_value"),
        F.when(fault == 4, F.lit("1")).alias("max_value"),
        F.lit(None).cast("string").alias("code_group"),
        F.lit(None).cast("string").alias("dimension"),
        F.when(fault == 7, F.lit("1.5")).when(fault == 8, F.lit("many")).otherwise(F.lit("0.1")).alias("threshold_rate"),
        F.lit("high").alias("error_grade"),
        F.when(fault == 9, F.lit("CLN-VAL-001,CLN-XXX")).alias("cleansing_steps"),
        F.lit(None).cast("string").alias("datetime_kind"),
        F.lit(None).cast("string").alias("change_reason"),
    )
    given = metadata_frame(spark, [r.as_record() for r in [*INBOUND_RULES, *OUTBOUND_RULES]])
    rules = normalise_rules(raw.unionByName(given.select(*raw.columns)))
    problems = snapshot.snapshot_problems(rules, "rule_id", rule_constraints())
    return problems.groupBy("problem").agg(F.count(F.lit(1)).alias("rows"))


QUERIES = {
    "scd_latest": scd_latest,
    "scd_active": scd_active,
    "scd_sync_plan": plan,
    "scd_counts": scd_counts,
    "scd_apply": scd_apply,
    "scd_resync": scd_resync,
    "scd_bad_keys": scd_bad_keys,
    "snapshot_validate": snapshot_validate,
    "rule_problems": rule_problems,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_HASH = t.content_hash(FIELDS)
_BASE = f"""WITH {cte('product_history', 'product_later')},
h AS (SELECT *, {_HASH} AS hash FROM product_history),
latest AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY version DESC) AS n FROM h) WHERE n = 1),
inc AS (SELECT *, {_HASH} AS hash FROM product_later),
j AS (SELECT coalesce(i.{KEY}, l.{KEY}) AS {KEY}, i.{KEY} IS NULL AS gone, l.{KEY} IS NULL AS fresh, l.version AS from_version, l.is_active, l.hash AS old_hash, i.hash AS new_hash,
  {', '.join(f'i.{f} AS n_{f}, l.{f} AS o_{f}' for f in FIELDS)} FROM inc i FULL OUTER JOIN latest l ON i.{KEY} = l.{KEY}),
s AS (SELECT *, CASE WHEN gone AND is_active THEN 'deactivated' WHEN gone THEN 'absent' WHEN fresh THEN 'new' WHEN NOT is_active THEN 'reactivated'
  WHEN old_hash <> new_hash THEN 'changed' ELSE 'unchanged' END AS sync_status FROM j),
p AS (SELECT {KEY}, sync_status, from_version, CAST(CASE WHEN sync_status = 'unchanged' THEN from_version ELSE coalesce(from_version, 0) + 1 END AS INTEGER) AS to_version,
  CASE WHEN gone THEN old_hash ELSE new_hash END AS definition_hash,
  CASE WHEN sync_status = 'changed' THEN concat_ws('; ', {', '.join(f"CASE WHEN n_{f} IS DISTINCT FROM o_{f} THEN '{f}: ' || coalesce(o_{f}, 'None') || ' → ' || coalesce(n_{f}, 'None') END" for f in FIELDS)}) END AS diffs,
  {', '.join(f'CASE WHEN gone THEN o_{f} ELSE n_{f} END AS {f}' for f in FIELDS)} FROM s WHERE sync_status <> 'absent')"""
_PROBLEMS = {
    "rule_id is empty": "fault = 0", "target_table is empty": "fault = 1", "rule_type is unknown": "fault = 2", "ORDER_CHECK needs two columns": "fault = 3",
    "min_value is above max_value": "fault = 4", "this rule_type needs exactly one column": "fault = 5", "PATTERN_CHECK needs a pattern": "fault = 6",
    "threshold_rate is outside 0..1": "fault = 7", "threshold_rate is empty": "fault = 8", "a number cannot be read": "fault = 8",
    "a cleansing step is unknown": "fault = 9", "phone cleansing needs the standard phone pattern": "fault = 9",
}
ORACLES = {
    "scd_latest": f"{_BASE} SELECT * EXCLUDE (hash), hash AS definition_hash FROM latest",
    "scd_active": f"{_BASE} SELECT {KEY}, version FROM latest WHERE is_active",
    "scd_sync_plan": f"{_BASE} SELECT * FROM p",
    "scd_counts": f"{_BASE} SELECT sync_status, count(*) AS rows FROM p GROUP BY 1",
    "scd_apply": f"""{_BASE} SELECT {KEY}, to_version AS version, sync_status <> 'deactivated' AS is_active, definition_hash,
        CASE sync_status WHEN 'reactivated' THEN 'reactivated' WHEN 'deactivated' THEN 'missing from the snapshot' ELSE diffs END AS change_reason, {', '.join(FIELDS)}
        FROM p WHERE sync_status <> 'unchanged'""",
    "scd_resync": f"{_BASE} SELECT 'unchanged' AS sync_status, count(*) AS rows FROM inc",
    "scd_bad_keys": f"""{_BASE}, e AS (SELECT {KEY} FROM inc WHERE STD_CATEGORY = 'ECONOMY')
        SELECT sync_status, count(*) AS rows FROM p WHERE {KEY} NOT IN (SELECT {KEY} FROM e) GROUP BY 1 UNION ALL SELECT 'refused', 3 * count(*) FROM e""",
    "snapshot_validate": f"""{_BASE}, r AS (SELECT * FROM inc UNION ALL SELECT * FROM inc WHERE STD_CATEGORY = 'ECONOMY')
        SELECT {KEY} AS key, 'category is empty' AS problem FROM r WHERE STD_CATEGORY IS NULL
        UNION ALL SELECT {KEY}, 'class is unknown' FROM r WHERE NOT regexp_matches(PRODUCT_CLASS, '^Brand#[0-9]$')
        UNION ALL SELECT {KEY}, 'name is too long' FROM r WHERE length(STD_PRODUCT_NAME) > 14
        UNION ALL SELECT {KEY}, '{KEY} is repeated' FROM r WHERE {KEY} IN (SELECT {KEY} FROM r GROUP BY 1 HAVING count(*) > 1)""",
    "rule_problems": "WITH f AS (SELECT p_partkey % 10 AS fault FROM part), c AS ("
    + " UNION ALL ".join(f"SELECT '{problem}' AS problem, count(*) AS rows FROM f WHERE {condition}" for problem, condition in _PROBLEMS.items())
    + ") SELECT * FROM c WHERE rows > 0",
}
