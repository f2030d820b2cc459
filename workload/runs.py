"""Whole runs over tables in scratch databases: land, profile, check, map, merge and validate, as stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import joined_or_null
from tidemark.operators import entity as e
from tidemark.operators import survivorship as s
from tidemark.operators.model import TargetModel
from tidemark.plans import ingest, profiling, quality, validation
from tidemark.plans.entities import EntityStore
from tidemark.plans.layout import Layout
from tidemark.plans.mapping import MappingRun
from tidemark.plans.profile_history import ProfileHistory
from tidemark.session import materialize, scratch_dir
from tidemark.sources import tables
from workload import entities as we
from workload import mapping as wm
from workload import profiling as wp
from workload import quality as wq
from workload import storage as ws
from workload import validation as wv
from workload.views import cte, view

DAY = "2026-09-15"
LINEAGE_DAY = "2026-09-14"  # the batch that the customers' lineage is of
# The target and its parent, so that the foreign key is checked.
MODEL = TargetModel(
    [dict(zip(wv.NAMES, r), TABLE_NAME="COUNSEL", ORDINAL=i) for i, r in enumerate(wv.MODEL_ROWS, 1)]
    + [dict(zip(wv.NAMES, ("CUST_ID", "VARCHAR(20)", "PK", "N", "")), TABLE_NAME="CUSTOMER", ORDINAL=1)]
)
BATCHES = ["2026-09-15", "2026-09-13", "2026-09-14"]  # in the order of delivery


def scratch_layout(spark: SparkSession) -> Layout:
    """Databases of its own for a run that must not touch real tables."""
    layout = Layout("run_" + scratch_dir(spark).rsplit("/", 1)[1])
    for stage in Layout.STAGES:
        tables.ensure_database(spark, layout.database(stage), scratch_dir(spark))
    return layout


def store(rows: DataFrame, table: str, partition_by: list[str] = ()) -> None:
    tables.append(rows, table, list(partition_by))


def timed(spark, sf_dir) -> DataFrame:
    return e.matchable(we.timed(spark, sf_dir), we.KEYS).drop("CUST_ID")


def ent_merge_by_batch(spark, sf_dir):
    """The states of three batches, merged in the order of delivery, which is not that of time."""
    rows, fill = timed(spark, sf_dir), we.FILL[1:]
    state = None
    for batch in BATCHES:
        fresh = s.merge_records(rows.filter(F.col("_source_batch_id") == batch), we.KEYS, fill)
        state = materialize(fresh if state is None else s.merge_all([state, fresh], we.KEYS))
    return s.survivors(state, we.KEYS).filter("NOT _conflict").drop("_conflict")


def merged_store(spark, sf_dir) -> EntityStore:
    layout = scratch_layout(spark)
    kept = EntityStore(spark, layout, "CUSTOMER", we.KEYS, "CUST_ID", "CUST")
    records = materialize(we.records(spark, sf_dir))
    rows = records.drop("ref_day")
    reference = records.select(*e.LINEAGE_KEY, F.col("ref_day").cast("timestamp").alias(e.REFERENCE))
    for batch in BATCHES:
        systems = ["inbound", "outbound"] if batch == "2026-09-14" else ["inbound"]
        for system in systems:
            chosen = (F.col("_source_batch_id") == batch) & (F.col("_source_system") == system)
            kept.save(rows.filter(chosen), system, batch)
        kept.merge(reference, [(system, batch) for system in systems])
    return kept


def ent_merge_run(spark, sf_dir):
    """A store fed batch by batch: entities, with the number of records that their id has in the lineage, and what is unmatched."""
    kept = merged_store(spark, sf_dir)
    records = spark.table(kept.lineage).groupBy(F.col("TARGET_PK").alias("CUST_ID")).agg(F.count(F.lit(1)).alias("records"))
    entities = spark.table(kept.entities).join(records, "CUST_ID", "left").withColumn("stage", F.lit("merged"))
    aside = spark.table(kept.unmatched).withColumns({"records": F.lit(1).cast("bigint"), "stage": F.lit("unmatched")})
    return entities.unionByName(aside).drop("CUST_ID", "_source_table")


def checked_layout(spark, sf_dir) -> Layout:
    """A quality run over all inbound records, landed as one batch."""
    layout = scratch_layout(spark)
    tables.append_batch(view(spark, sf_dir, "inbound"), layout.table("bronze", "inbound"), {"ingest_date": DAY})
    quality.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, wq.code_tables(spark))
    return layout


def dq_run(spark, sf_dir):
    return spark.table(checked_layout(spark, sf_dir).table("meta", "dq_result")).select(
        "rule_id", "check_count", "initial_error_count", "error_count", "affected_rows", "error_rate", "result_status",
        "error_grade", "action_type", "unique_error_record_count", "auto_cleansed_record_count", "unresolved_record_count",
    )


def dq_run_routed(spark, sf_dir):
    layout = checked_layout(spark, sf_dir)
    kept = spark.table(layout.table("silver_candidate", "inbound")).withColumn("_unresolved_rule_ids", F.lit(None).cast("string"))
    held = spark.table(layout.table("dq_quarantine", "inbound")).withColumn("_unresolved_rule_ids", joined_or_null(F.col("_unresolved_rule_ids")))
    both = kept.drop("_candidate_created_at").unionByName(held.drop("_quarantined_at"))
    return both.drop("_dq_run_id", "_source_table")


def landed_for_mapping(spark, sf_dir) -> tuple[Layout, MappingRun]:
    layout = scratch_layout(spark)
    for name, key in (("inbound", "consultation_id"), ("outbound", "CTI_ID")):
        rows = wm.with_lineage(view(spark, sf_dir, name), name, key, F.lit(LINEAGE_DAY))
        tables.append_batch(rows, layout.table("silver_candidate", name), {"_source_batch_id": LINEAGE_DAY})
    return layout, MappingRun(spark, layout, wm.model_frame(spark), wm.rule_frame(spark), wm.code_frame(spark))


def stored_mapping(spark, layout: Layout) -> DataFrame:
    out = None
    for stage in ("gold_candidate", "gold_mapping_error"):
        rows = wm.readable(spark.table(layout.table(stage, "COUNSEL"))).withColumn("stage", F.lit(stage))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.drop("_source_table", "_deferred_keys")


def map_late_parents(spark, sf_dir):
    """A target that is mapped before anything it refers to exists; its keys are filled as the parents come in."""
    layout, run = landed_for_mapping(spark, sf_dir)
    run.run_target("COUNSEL")
    store(view(spark, sf_dir, "customer_parent"), layout.table("gold_candidate", "customer"))
    lineage, table = view(spark, sf_dir, "customer_lineage"), layout.table("gold_entity_lineage", "customer")
    early = F.xxhash64("_source_record_key") % 2 == 0
    store(lineage.filter(early), table)
    run.fill_deferred("COUNSEL")
    store(lineage.filter(~early), table)
    store(view(spark, sf_dir, "crosswalk"), layout.table("gold_candidate", "product_mapping"))
    run.fill_deferred("COUNSEL")
    return stored_mapping(spark, layout)


def map_run(spark, sf_dir):
    """Both sources of one target mapped and saved; kept and refused rows as stored."""
    layout, run = landed_for_mapping(spark, sf_dir)
    for name, parent in (("customer", "customer_parent"), ("product", "product_parent"), ("product_mapping", "crosswalk")):
        store(view(spark, sf_dir, parent), layout.table("gold_candidate", name))
    store(view(spark, sf_dir, "customer_lineage"), layout.table("gold_entity_lineage", "customer"))
    run.run_target("COUNSEL")
    return stored_mapping(spark, layout)


def val_run(spark, sf_dir):
    """Records checked against the target's constraints: gold and quarantine as stored."""
    layout = scratch_layout(spark)
    store(view(spark, sf_dir, "counsel"), layout.table("gold_candidate", "COUNSEL"))
    store(view(spark, sf_dir, "customer_parent"), layout.table("gold", "CUSTOMER"))
    validation.run_validation(spark, layout, MODEL, "COUNSEL")
    names = [c.name for c in wv.MODEL.columns("COUNSEL")]
    kept = spark.table(layout.table("gold", "COUNSEL")).select(*names, F.lit(None).cast("string").alias("_violations"))
    held = spark.table(layout.table("gold_quarantine", "COUNSEL")).select(*names, joined_or_null(F.col("_violations")).alias("_violations"))
    return kept.unionByName(held)


def profiled_layout(spark, sf_dir) -> Layout:
    layout = scratch_layout(spark)
    for name in wp.SPECS:
        tables.append_batch(view(spark, sf_dir, name), layout.table("bronze", name), {"ingest_date": DAY})
    masters = {"inbound": wp.master(spark)}
    profiling.run_profile(spark, layout, list(wp.SPECS.values()), DAY, masters)
    profiling.run_integrated(spark, layout, DAY)
    return layout


def profile_run(spark, sf_dir):
    """The stored column profile of all tables, with the text of their formats."""
    rows = spark.table(profiled_layout(spark, sf_dir).table("meta", "integrated_column_profile"))
    return rows.drop("executed_at", "ingest_date")


def inbound_history(spark, sf_dir) -> ProfileHistory:
    """States of three batches, of which one first comes with other rows and is then delivered again."""
    history = ProfileHistory(spark, scratch_layout(spark), wp.SPECS["inbound"])
    rows = view(spark, sf_dir, "inbound")
    history.add(rows.filter("ingest_date <> '2026-09-15' AND customer_id % 2 = 0"), "2026-09-15")
    for batch in BATCHES:
        history.add(rows.filter(F.col("ingest_date") == batch), batch)
    return history


def profile_history(kind: str, batches: list[str] | None = None):
    def run(spark, sf_dir):
        return inbound_history(spark, sf_dir).profile(batches, wp.master(spark))[kind]

    return run


def ingest_run(spark, sf_dir):
    path, columns = ws.csv_folder(spark, sf_dir)
    table = ingest.ingest(spark, scratch_layout(spark), "inbound", path, "csv", columns)
    return spark.table(table)


QUERIES = {
    "ent_merge_by_batch": ent_merge_by_batch,
    "ent_merge_run": ent_merge_run,
    "dq_run": dq_run,
    "dq_run_routed": dq_run_routed,
    "map_run": map_run,
    "map_late_parents": map_late_parents,
    "val_run": val_run,
    "profile_run": profile_run,
    "profile_history_columns": profile_history("column_profile"),
    "profile_history_categorical": profile_history("categorical_distribution"),
    "profile_history_duplicates": profile_history("duplicate_summary", BATCHES[:2]),
    "profile_history_sequence": profile_history("cross_column_check"),
    "ingest_run": ingest_run,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_NAMES = ", ".join(c.name for c in wv.MODEL.columns("COUNSEL"))
ORACLES = {
    "ent_merge_by_batch": we.ORACLES["ent_latest_non_null"],
    "ent_merge_run": f"""{we._BASE}, e AS (SELECT * EXCLUDE (_group_size, _source_table), _group_size AS records, 'merged' AS stage FROM clean)
        SELECT * FROM e UNION ALL BY NAME SELECT *, 1 AS records, 'unmatched' AS stage
        FROM ({we.ORACLES['ent_unmatched'].removeprefix(we._BASE)})""",
    "dq_run": f"""{wq._FULL} SELECT rule_id, check_count, initial_error_count, error_count, affected_rows, error_rate, result_status,
        error_grade, action_type, unique_error_record_count, auto_cleansed_record_count, unresolved_record_count
        FROM judged LEFT JOIN detail_counts USING (rule_id)""",
    "dq_run_routed": f"""{wq._ROUTED} SELECT * REPLACE ('{DAY}' AS ingest_date, '{DAY}' AS _source_batch_id) FROM routed""",
    "map_run": f"""{wm._BOTH} SELECT * EXCLUDE (_source_table) REPLACE ('{LINEAGE_DAY}' AS _source_batch_id),
        CASE WHEN _map_errors IS NULL THEN 'gold_candidate' ELSE 'gold_mapping_error' END AS stage FROM u""",
    "val_run": f"{wv._BASE} SELECT {_NAMES}, _violations FROM checked",
    "profile_run": f"""{wp._with(wp._ALL, f"m AS ({wp._union(wp._metrics_sql, wp._ALL)})", f"f AS ({wp._union(wp._formats_sql, wp._ALL)})")},
        texts AS (SELECT table_name, column_name, '[' || string_agg('{{''format'': ''' || format || ''', ''count'': ' || CAST(count AS VARCHAR)
          || ', ''ratio'': ' || CAST(ratio AS VARCHAR) || '}}', ', ' ORDER BY count DESC, format) || ']' AS format_distribution FROM f GROUP BY 1, 2)
        SELECT m.*, format_distribution FROM m LEFT JOIN texts USING (table_name, column_name)""",
    "ingest_run": f"WITH {cte('inbound')} SELECT {ws._TEXT.replace('CAST(ingest_date AS VARCHAR)', 'ingest_date')} FROM inbound WHERE ingest_date = (SELECT max(ingest_date) FROM inbound)",
}
ORACLES["map_late_parents"] = ORACLES["map_run"]
# The batch is no part of a row there, so the records of the chosen batches are compared without it.
_CHOSEN = cte("inbound").replace("inbound AS (", "whole AS (", 1) + f""",
inbound AS (SELECT * EXCLUDE (ingest_date) FROM whole WHERE ingest_date IN ({', '.join(f"'{b}'" for b in BATCHES[:2])}))"""
ORACLES |= {
    "profile_history_columns": wp.ORACLES["prof_columns"],
    "profile_history_categorical": f"SELECT * EXCLUDE (table_name) FROM ({wp.ORACLES['prof_categorical']})",
    "profile_history_duplicates": f"WITH {_CHOSEN} SELECT * EXCLUDE (table_name) FROM ({wp._duplicates_sql('inbound')})",
    "profile_history_sequence": f"{wp._with(('inbound',))} SELECT * EXCLUDE (table_name) FROM ({wp._sequences_sql('inbound')})",
}
