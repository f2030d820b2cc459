"""Merging customer records of two sources, stable ids, and master data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import entity as e
from tidemark.operators.keys import number_rows, rows_with_keys
from tidemark.session import materialize
from workload.views import cte, load, view

KEYS = ["CUST_NM", "BRTH_DT"]
FILL = ["CUST_ID", "TEL_NO", "GRADE_CD"]


def records(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "customer_records")


def candidate(spark, sf_dir) -> DataFrame:
    return records(spark, sf_dir).drop("ref_day")


def reference(spark, sf_dir) -> DataFrame:
    return records(spark, sf_dir).select(*e.LINEAGE_KEY, F.col("ref_day").cast("timestamp").alias(e.REFERENCE))


def usable(spark, sf_dir) -> DataFrame:
    return e.matchable(candidate(spark, sf_dir), KEYS)


def timed(spark, sf_dir) -> DataFrame:
    """The candidates with their reference time. The view is joined together once, as several steps read it."""
    return e.with_own_reference_time(materialize(records(spark, sf_dir)), "ref_day")


def groups_of(rows: DataFrame) -> DataFrame:
    return e.merge_groups(e.matchable(rows, KEYS), KEYS, FILL)


def groups(spark, sf_dir) -> DataFrame:
    return groups_of(timed(spark, sf_dir))


def ent_latest_non_null(spark, sf_dir):
    return groups(spark, sf_dir).filter(~F.col("_conflict")).drop("_conflict", "CUST_ID")


def ent_conflicts(spark, sf_dir):
    return groups(spark, sf_dir).filter("_conflict").select(*KEYS, "_group_size")


def ent_unmatched(spark, sf_dir):
    rows = timed(spark, sf_dir)
    in_conflict = groups_of(rows).filter("_conflict").select(*KEYS)
    rows = rows.drop(e.REFERENCE)
    conflicting = rows_with_keys(e.matchable(rows, KEYS), KEYS, in_conflict)
    return e.unmatchable(rows, KEYS).unionByName(conflicting).drop("CUST_ID", "_source_table")


def merged(spark, sf_dir) -> e.MergeResult:
    return e.merge_entities(timed(spark, sf_dir), None, KEYS, "CUST_ID", "CUST", "CUSTOMER")


def ent_merged(spark, sf_dir):
    return merged(spark, sf_dir).merged.drop("_source_table")


def ent_crosswalk(spark, sf_dir):
    return merged(spark, sf_dir).lineage


def ent_id_reuse(spark, sf_dir):
    """Merge once, then again as if ids had been reset: every entity gets its id back through the lineage."""
    rows = timed(spark, sf_dir)
    lineage = materialize(e.merge_entities(rows, None, KEYS, "CUST_ID", "CUST", "CUSTOMER").lineage)
    again = e.merge_entities(rows, None, KEYS, "CUST_ID", "CUST", "CUSTOMER", lineage)
    return again.merged.select(*KEYS, "CUST_ID")


def ent_seq_ids(spark, sf_dir):
    """Ids for orders: a part already has one, the others continue after the highest."""
    orders = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    given = F.when(key % 10 == 0, F.format_string("ORD-%06d", (key / 10 + 1).cast("bigint")))
    rows = orders.select("o_orderkey", "o_custkey", given.alias("ORD_ID"))
    return e.assign_ids(rows, "ORD_ID", "ORD", ["o_custkey", "o_orderkey"])


def ent_rank_in_group(spark, sf_dir):
    """Order of the calls within each lead, numbered without a window over the group."""
    rows = view(spark, sf_dir, "outbound").select("LEAD_MGMT_NO", "TRY_CNT", "CALL_ST_DTM", "MN_PREM", "GD_CD")
    return number_rows(rows, ["TRY_CNT", "CALL_ST_DTM", "MN_PREM", "GD_CD"], ["LEAD_MGMT_NO"], "call_number")


def master(rows: DataFrame) -> DataFrame:
    named = rows.withColumnsRenamed({"STD_PRODUCT_CODE": "PRD_CD", "STD_PRODUCT_NAME": "PRD_NM"})
    return named.select(F.lit(None).cast("string").alias("PRD_ID"), "PRD_CD", "PRD_NM")


def master_id_reuse(spark, sf_dir):
    """Load the products, then a later snapshot: known codes keep their id, new ones continue."""
    first = materialize(e.load_master(master(view(spark, sf_dir, "product")), None, "PRD_CD", "PRD_ID", "PRD"))
    return e.load_master(master(view(spark, sf_dir, "product_later")), first, "PRD_CD", "PRD_ID", "PRD")


QUERIES = {
    "ent_match_groups": lambda s, d: e.group_sizes(usable(s, d), KEYS),
    "ent_reference_time": lambda s, d: e.with_reference_time(usable(s, d), reference(s, d)).select(
        *e.LINEAGE_KEY, F.date_format(e.REFERENCE, "yyyy-MM-dd").alias("ref_day")
    ),
    "ent_conflicts": ent_conflicts,
    "ent_unmatched": ent_unmatched,
    "ent_latest_non_null": ent_latest_non_null,
    "ent_merged": ent_merged,
    "ent_crosswalk": ent_crosswalk,
    "ent_id_reuse": ent_id_reuse,
    "ent_seq_ids": ent_seq_ids,
    "ent_rank_in_group": ent_rank_in_group,
    "master_id_reuse": master_id_reuse,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_ORDER = "ref_day DESC NULLS LAST, _source_batch_id DESC, _source_system DESC, _source_record_key DESC"
_KEY = "CUST_NM, BRTH_DT"


def _newest(column: str) -> str:
    return f"first({column} ORDER BY {_ORDER}) FILTER ({column} IS NOT NULL) AS {column}"


_BASE = f"""WITH {cte('customer_records')},
times AS (SELECT _source_system, _source_batch_id, _source_record_key, max(ref_day) AS day FROM customer_records GROUP BY 1, 2, 3),
u AS (SELECT r.* EXCLUDE (ref_day), day AS ref_day FROM customer_records r JOIN times USING (_source_system, _source_batch_id, _source_record_key)
  WHERE CUST_NM IS NOT NULL AND BRTH_DT IS NOT NULL),
top AS (SELECT *, max(ref_day) OVER (PARTITION BY {_KEY}) AS newest FROM u),
conflict AS (SELECT {_KEY} FROM top WHERE ref_day IS NOT DISTINCT FROM newest GROUP BY {_KEY} HAVING count(DISTINCT TEL_NO) > 1 OR count(DISTINCT GRADE_CD) > 1),
g AS (SELECT {_KEY}, {_newest('TEL_NO')}, {_newest('GRADE_CD')},
  first(_source_batch_id ORDER BY {_ORDER}) AS _source_batch_id, first(_source_system ORDER BY {_ORDER}) AS _source_system,
  first(_source_record_key ORDER BY {_ORDER}) AS _source_record_key, first(_source_table ORDER BY {_ORDER}) AS _source_table, count(*) AS _group_size
  FROM u GROUP BY {_KEY}),
clean AS (SELECT * FROM g WHERE ({_KEY}) NOT IN (SELECT ({_KEY}) FROM conflict)),
m AS (SELECT *, 'CUST-' || lpad(CAST(row_number() OVER (ORDER BY _source_batch_id, _source_record_key) AS VARCHAR), 6, '0') AS CUST_ID FROM clean)"""
ORACLES = {
    "ent_match_groups": f"{_BASE} SELECT {_KEY}, count(*) AS group_size FROM u GROUP BY {_KEY}",
    "ent_reference_time": f"{_BASE} SELECT _source_system, _source_batch_id, _source_record_key, ref_day FROM u",
    "ent_conflicts": f"{_BASE} SELECT {_KEY}, _group_size FROM g WHERE ({_KEY}) IN (SELECT ({_KEY}) FROM conflict)",
    "ent_unmatched": f"""{_BASE} SELECT * EXCLUDE (CUST_ID, _source_table, ref_day) FROM customer_records
        WHERE CUST_NM IS NULL OR BRTH_DT IS NULL OR ({_KEY}) IN (SELECT ({_KEY}) FROM conflict)""",
    "ent_latest_non_null": f"{_BASE} SELECT * FROM clean",
    "ent_merged": f"{_BASE} SELECT * EXCLUDE (_group_size, _source_table) FROM m",
    "ent_crosswalk": f"""{_BASE} SELECT u._source_system, u._source_batch_id, u._source_record_key, 'CUSTOMER' AS TARGET_ENTITY, m.CUST_ID AS TARGET_PK
        FROM u JOIN m USING (CUST_NM, BRTH_DT)""",
    "ent_id_reuse": f"{_BASE} SELECT {_KEY}, CUST_ID FROM m",
    "ent_seq_ids": """WITH k AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey // 10 + 1 END AS n FROM orders),
        f AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) + (SELECT max(n) FROM k) AS n FROM k WHERE n IS NULL)
        SELECT o_orderkey, o_custkey, 'ORD-' || lpad(CAST(n AS VARCHAR), CAST(greatest(6, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS ORD_ID
        FROM (SELECT o_orderkey, o_custkey, n FROM k WHERE n IS NOT NULL UNION ALL SELECT * FROM f)""",
    "ent_rank_in_group": f"""WITH {cte('outbound')} SELECT LEAD_MGMT_NO, TRY_CNT, CALL_ST_DTM, MN_PREM, GD_CD,
        row_number() OVER (PARTITION BY LEAD_MGMT_NO ORDER BY TRY_CNT, CALL_ST_DTM, MN_PREM, GD_CD) AS call_number FROM outbound""",
    "master_id_reuse": f"""WITH {cte('product', 'product_later')},
        a AS (SELECT STD_PRODUCT_CODE AS c, row_number() OVER (ORDER BY STD_PRODUCT_CODE) AS n FROM product),
        b AS (SELECT STD_PRODUCT_CODE AS c, STD_PRODUCT_NAME AS nm, n FROM product_later LEFT JOIN a ON STD_PRODUCT_CODE = c),
        f AS (SELECT c, nm, row_number() OVER (ORDER BY c) + (SELECT max(n) FROM b) AS n FROM b WHERE n IS NULL)
        SELECT 'PRD-' || lpad(CAST(n AS VARCHAR), 6, '0') AS PRD_ID, c AS PRD_CD, nm AS PRD_NM FROM (SELECT c, nm, n FROM b WHERE n IS NOT NULL UNION ALL SELECT * FROM f)""",
}
