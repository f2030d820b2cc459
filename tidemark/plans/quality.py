"""Quality run of one bronze table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import fixed_values as fixed
from tidemark.operators import quality as q
from tidemark.operators import snapshot
from tidemark.operators.keys import unfolded_with_unique_id
from tidemark.operators.rules import (
    DEFINITION_COLUMNS,
    RULE_COLUMNS,
    Rule,
    normalise_rules,
    rule_constraints,
    rules_from,
)
from tidemark.plans.layout import Layout
from tidemark.session import materialize, metadata_rows
from tidemark.sources import files, tables


class RuleRepository:
    """Versioned rule table. Every change of a rule appends a version; nothing is updated or deleted."""

    KEY = "rule_id"
    STORED = ["rule_name", *DEFINITION_COLUMNS]

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark = spark
        self.table = layout.table("meta", "dq_rule_def")
        self.database = layout.database("meta")

    def history(self, rule_id: str | None = None) -> DataFrame:
        rows = self.spark.table(self.table)
        return rows.filter(F.col("rule_id") == rule_id).orderBy("version") if rule_id else rows

    def load(self, target_table: str | None = None) -> list[Rule]:
        current = snapshot.active_versions(self.history(), self.KEY).withColumnRenamed("version", "rule_version")
        return rules_from(current.filter(F.col("target_table") == target_table) if target_table else current)

    def sync(self, incoming: DataFrame, change_reason: str | None = None, apply: bool = True) -> DataFrame:
        """Make the full rule list `incoming` current. Invalid input writes nothing. Returns the plan."""
        rules = normalise_rules(incoming)
        snapshot.require_valid(rules, self.KEY, rule_constraints())
        tables.ensure_database(self.spark, self.database)
        if tables.table_exists(self.spark, self.table):
            history = self.history()
        else:
            history = snapshot.first_versions(rules, self.KEY, DEFINITION_COLUMNS).filter(F.lit(False))
        plan = snapshot.plan_sync(rules, history, self.KEY, DEFINITION_COLUMNS)
        rows = metadata_rows(plan)  # rules are metadata; the rows must not change while their table grows
        plan = self.spark.createDataFrame([tuple(r.values()) for r in rows], plan.schema)
        if apply and any(r["sync_status"] != "unchanged" for r in rows):
            versions = snapshot.version_rows(plan, self.KEY, DEFINITION_COLUMNS)
            named = rules.select(self.KEY, "rule_name", F.col("change_reason").alias("__given"))
            versions = versions.join(named, self.KEY, "left").withColumns(
                {
                    "change_reason": F.coalesce("__given", F.lit(change_reason), "change_reason"),
                    "valid_from": F.current_timestamp(),
                }
            )
            tables.append(versions.drop("__given"), self.table)
        return plan

    def sync_csv(self, path: str, change_reason: str | None = None, apply: bool = True) -> DataFrame:
        incoming = files.read_metadata_csv(self.spark, path)
        return self.sync(files.require_columns(incoming, RULE_COLUMNS, path), change_reason, apply)


def new_run_id(kind: str, name: str) -> str:
    return f"{kind}-{datetime.now():%Y%m%d%H%M%S}-{name}-{uuid.uuid4().hex[:6]}"


def lineage_columns(source: str, table: str, key: str | None, batch: str, run_id: str) -> dict:
    return {
        "_source_system": F.lit(source),
        "_source_table": F.lit(table),
        "_source_record_key": F.col(key).cast("string") if key else F.lit(None).cast("string"),
        "_source_batch_id": F.lit(batch),
        "_dq_run_id": F.lit(run_id),
    }


def find_once(rows: DataFrame, rules: list[Rule], codes: q.CodeTables, record_key: str | None, row_hash: bool = False):
    """Rows that break a rule, stored with their violations in `__found`, and the judged rules: one evaluation for both.

    The counts are observed in the job that writes the rows. Should a repeated stage have counted rows twice, it stops.
    """
    spark, observation = rows.sparkSession, Observation("found")
    repeated = q.repeated_keys(rows, rules)
    marked = q.with_outcomes(rows, rules, codes, repeated={k: v.drop("__rows") for k, v in repeated.items()})
    hashes = {"__row": q.row_identity(rows.columns)} if row_hash else {}
    found = {"source_record_key": q.key_text(rows, record_key), **hashes, "__found": q.violation_entries(rules, codes)}
    marked = marked.withColumns(found)
    seen = F.count_if(F.size("__found") > 0).alias("seen")
    counted = marked.observe(observation, *q.observed_counts(len(rules)), seen)
    stored = materialize(counted.filter(F.size("__found") > 0).select(*found))
    observed = observation.get
    if stored.count() != observed["seen"]:
        raise RuntimeError("rows written and rows counted differ: run again")
    judged = q.judge(q.counts_from(spark, observed, rules, repeated), rules)
    return stored, spark.createDataFrame([tuple(r.values()) for r in metadata_rows(judged)], judged.schema)


def detail_with_ids(stored: DataFrame, judged: DataFrame, run_id: str) -> DataFrame:
    """Details of stored rows with `__found` and `__row`, the hash of the unmasked row.

    Adds `dq_detail_id`, one per rule and row.
    """

    def unfold(rows: DataFrame) -> DataFrame:
        return q.violation_detail(q.unfold_violations(rows, "__found", ["__row"]), judged)

    identity = F.concat_ws("#", F.lit(run_id), "rule_id", "__row")
    return unfolded_with_unique_id(stored, "__row", unfold, "dq_detail_id", identity).drop("__row")


def samples_as_json(samples: DataFrame) -> DataFrame:
    return samples.select("rule_id", F.to_json("sample_values").alias("sample_values_json"))


# Rows that no rule has anything to say about are final when they are written; the others are routed afterwards.
ROUTE, CLEAN, SEEN = "_route", "clean", "seen"
CANDIDATE_STAMP = "_candidate_created_at"


def candidate_columns(evaluated: DataFrame) -> list[str]:
    inner = ("source_record_key", "_source_batch_id")
    return [c for c in evaluated.columns if not c.startswith("__") and c not in inner]


def stored_schema(evaluated: DataFrame) -> StructType:
    marks = [f"__{kind}" for kind in ("err", "left")]
    kept = [f for f in evaluated.schema.fields if not any(f.name.startswith(m) for m in marks) and f.name != "_source_batch_id"]
    batch = StructField("_source_batch_id", StringType())
    return StructType([*kept, batch])


def write_evaluated(evaluated: DataFrame, candidate_table: str, n_rules: int) -> tuple[str, dict]:
    """Write the evaluated rows once, laid out by route, and return the folder and the counts observed on the way.

    Nothing is shuffled after the counting, so the counts are those of the tasks that wrote. Should a repeated stage have counted rows
    twice all the same, the run stops before it has changed any table.
    """
    spark = evaluated.sparkSession
    columns = candidate_columns(evaluated)
    shape = evaluated.select(*columns, F.lit("CLEAN").alias("_dq_status"), F.current_timestamp().alias(CANDIDATE_STAMP), "_source_batch_id")
    shaped = tables.shaped_for(shape, candidate_table, ["_source_batch_id"])
    folder, observation = tables.parts_folder(spark, candidate_table), Observation("rules")
    typed = {c: F.col(c).cast(shaped.schema[c].dataType) for c in columns}
    silent = (F.size("__found") == 0) & ~F.col("_cleansed_yn") & (F.size("__broken") == 0)
    counted = evaluated.observe(observation, *q.observed_counts(n_rules))
    rows = counted.withColumns(typed).select(
        *[f.name for f in stored_schema(evaluated).fields if f.name != "_source_batch_id"],
        F.lit("CLEAN").alias("_dq_status"),
        F.current_timestamp().alias(CANDIDATE_STAMP),
        F.when(silent, CLEAN).otherwise(SEEN).alias(ROUTE),
    )
    tables.write_by_route(rows, ROUTE, folder)
    for route in (CLEAN, SEEN):  # a route without rows is an empty folder
        spark.createDataFrame([], rows.drop(ROUTE).schema).write.mode("append").parquet(f"{folder}/{ROUTE}={route}")
    observed = observation.get
    stored = spark.read.schema(rows.schema).parquet(folder).count()
    if stored != observed["n"]:
        raise RuntimeError(f"{stored} rows written, {observed['n']} counted: run the batch again")
    return folder, observed


def take_candidates(late: DataFrame, table: str, folder: str, batch: dict) -> int:
    """Add the candidates among the routed rows to those that were final at once, and make all the table's batch."""
    spark, path = late.sparkSession, f"{folder}/{ROUTE}={CLEAN}"
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    rows = late.drop(*batch).withColumn(CANDIDATE_STAMP, F.current_timestamp())
    rows.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns]).write.mode("append").parquet(path)
    tables.attach_batch(spark, table, batch, path)
    return spark.table(table).filter(F.col("_source_batch_id") == batch["_source_batch_id"]).count()


def run_quality(
    spark: SparkSession, layout: Layout, source: str, rules: list[Rule], codes: q.CodeTables, batch: str | None = None
) -> dict:
    """Check, cleanse, judge and route one batch; append results and details, replace candidate and quarantine.

    The rules are evaluated once, in the job that writes the rows: its counts are observed on the way, and rows without
    any finding are candidates where they lie. Only the results, one row per rule, come to the driver: they decide which
    rules isolate records.
    """
    table = layout.table("bronze", source)
    if batch is None:
        batch = spark.table(table).agg(F.max(F.nullif(F.col(files.BATCH_COLUMN), F.lit("")))).first()[0]
        if batch is None:
            raise FileNotFoundError(f"{table} has no batch")
    rows = spark.table(table).filter(F.col(files.BATCH_COLUMN) == batch)
    key = fixed.RECORD_KEYS.get(source)
    run_id = new_run_id("DQ", source)
    stamp = F.current_timestamp()
    for stage in ("meta", "silver_candidate", "dq_quarantine"):
        tables.ensure_database(spark, layout.database(stage))

    candidate_table = layout.table("silver_candidate", source)
    lineage = lineage_columns(source, table, key, batch, run_id)
    repeated = q.repeated_keys(rows, rules)
    evaluated = q.evaluate(rows, rules, codes, key, lineage, repeated)
    folder, observed = write_evaluated(evaluated, candidate_table, len(rules))
    judged = q.judge(q.counts_from(spark, observed, rules, repeated), rules)
    judged = spark.createDataFrame([tuple(r.values()) for r in metadata_rows(judged)], judged.schema)

    seen = spark.read.schema(stored_schema(evaluated)).parquet(f"{folder}/{ROUTE}={SEEN}")
    detail = detail_with_ids(seen, judged, run_id).withColumns(
        {
            "dq_run_id": F.lit(run_id),
            "source_system": F.lit(source),
            "source_table": F.lit(table),
            "created_at": stamp,
            "updated_at": stamp,
        }
    )
    detail_table = layout.table("meta", "dq_cleansing_detail")
    tables.append_batch(detail, detail_table, {"source_batch_id": batch})
    written = spark.table(detail_table).filter((F.col("source_batch_id") == batch) & (F.col("dq_run_id") == run_id))

    results = judged.join(q.detail_counts(written), "rule_id", "left")
    results = results.join(samples_as_json(q.error_samples(written)), "rule_id", "left").withColumns(
        {
            "executed_at": stamp,
            "ingest_date": F.lit(batch),
            "dq_run_id": F.lit(run_id),
            "source_system": F.lit(source),
            "source_batch_id": F.lit(batch),
        }
    )
    result_rows = metadata_rows(results)
    results = spark.createDataFrame([tuple(r.values()) for r in result_rows], results.schema)
    tables.append(results, layout.table("meta", "dq_result"), ["ingest_date"])

    actions = {r["rule_id"]: r["action_type"] for r in result_rows}
    isolate = [r.rule_id for r in rules if actions[r.rule_id] in fixed.ISOLATING_ACTIONS]
    routed = q.routed_by(seen, isolate).select(*rows.columns, *lineage, "_cleansed_yn", "_dq_status", "_unresolved_rule_ids")
    partition = {"_source_batch_id": batch}
    kept = take_candidates(q.candidates(routed), candidate_table, folder, partition)
    held = tables.replace_batch(
        q.quarantined(routed).withColumn("_quarantined_at", stamp), layout.table("dq_quarantine", source), partition
    )
    return {
        "target_table": table,
        "dq_run_id": run_id,
        "source_batch_id": batch,
        "results": results,
        "candidate_row_count": kept,
        "quarantine_row_count": held,
        "silver_ready": held == 0,
    }


def clear_results(spark: SparkSession, layout: Layout, batch: str) -> None:
    """Drop the stored results of one batch date. Not part of a normal run, which only appends."""
    tables.drop_batch(spark, layout.table("meta", "dq_result"), {"ingest_date": batch})
