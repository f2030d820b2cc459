"""Validation runs: from a mapped target table to gold, quarantine and trace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import validation as v
from tidemark.operators.model import TargetModel
from tidemark.plans.layout import Layout
from tidemark.plans.quality import new_run_id
from tidemark.session import compact, materialize
from tidemark.sources import tables, zones

# Order rules between columns that the model cannot express.
BUSINESS_ORDER = {"COUNSEL": [("VR-COUNSEL-022", "STRT_DTM", "END_DTM")]}
# Approved repair of repeated primary keys.
PRIMARY_KEY_REPAIRS = {"COUNSEL": v.PrimaryKeyRepair("CNSL_ID", "outbound")}

PARTITION = ["_source_system", "_source_batch_id"]


def parents_in_gold(spark: SparkSession, layout: Layout, model: TargetModel) -> dict[str, DataFrame]:
    found = {name: layout.table("gold", name) for name in model.tables}
    return {name: spark.table(t) for name, t in found.items() if tables.table_exists(spark, t)}


def run_validation(
    spark: SparkSession,
    layout: Layout,
    model: TargetModel,
    target: str,
    job_run_id: str | None = None,
    zone_rows: int = zones.ZONE_ROWS,
) -> dict:
    """Check a mapped table and write it: good rows replace gold rows of the same key, the rest is quarantined.

    The checked rows are written to scratch once, with what was found, and feed all three outputs. Quarantine is replaced for every batch
    that was processed, also when nothing failed now, and gold rows whose key failed now are removed. Gold tables
    are laid out by ranges of the key with about `zone_rows` rows each, and an upsert rewrites only the ranges that its keys
    fall into.
    """
    with compact(spark):
        return _run_validation(spark, layout, model, target.upper(), job_run_id, zone_rows)


def _run_validation(spark, layout: Layout, model: TargetModel, target: str, job_run_id: str | None, zone_rows: int) -> dict:
    candidate, repair = spark.table(layout.table("gold_candidate", target)), PRIMARY_KEY_REPAIRS.get(target)
    checked = v.validate(
        candidate,
        target,
        model,
        parents_in_gold(spark, layout, model),
        BUSINESS_ORDER.get(target, []),
        repair,
    )
    run_id = new_run_id("VAL", target.lower())
    runs = {"_validation_run_id": F.lit(run_id), "_job_run_id": F.lit(job_run_id).cast("string")}
    rows = (checked.frame if repair else materialize(checked.frame)).withColumns(runs)  # with a repair, they are stored already
    names = [c.name for c in model.columns(target)]
    pk = model.require_key(target, "PK")
    for stage in ("gold", "gold_quarantine"):
        tables.ensure_database(spark, layout.database(stage))

    good, bad = v.passed(rows), v.failed(rows)
    gold_table, held_table = layout.table("gold", target), layout.table("gold_quarantine", target)
    zones.upsert(good.select(*names, *runs), gold_table, [pk], bad.select(pk), zone_rows, stored=True)

    held = bad.select(*names, *v.TRACE_LINEAGE, "_violations", *runs)
    tables.replace_batches(held, held_table, PARTITION)
    failures = rows.groupBy(*PARTITION).agg(F.count_if(F.size("_violations") > 0).alias("n"))
    for batch in failures.filter("n = 0").select(*PARTITION).toLocalIterator():  # one row per processed batch
        tables.drop_batch(spark, held_table, batch.asDict())

    trace_table = layout.table("gold", "migration_trace")
    trace = v.migration_trace(rows, target, pk, run_id, stored=True, unique=v.unique_rule(checked.rules, pk))
    tables.append(trace, trace_table)
    summary = v.reconcile(candidate, rows).first().asDict()
    counts = {r["rule_id"]: r["violations"] for r in v.violations_by_rule(rows).collect()}  # one row per rule
    return {
        "validation_run_id": run_id,
        "target_table": target,
        **summary,
        "violations_by_rule": counts,
        "rules_applied": [r.rule_id for r in checked.rules],
        "relationship_rules_skipped": checked.skipped,
    }
