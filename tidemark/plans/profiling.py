"""Profiling runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import profile as p
from tidemark.plans.layout import Layout
from tidemark.session import materialize
from tidemark.sources import files, tables

KINDS = (
    "summary", "column_profile", "categorical_distribution", "duplicate_summary", "duplicate_key_rows",
    "cross_column_check", "unusual_candidates",
)


def profile_frame(
    df: DataFrame, spec: p.TableProfile, batch: str, code_master: DataFrame | None = None, staged: bool = True
) -> dict[str, DataFrame]:
    """All profile results of a frame. The value counts and the repeated keys are written once and serve every metric."""
    counts = p.value_counts(df, list(spec.column_roles), spec.columns_with("TEXT"))
    repeated = p.repeated_keys(df, spec.key_columns)
    if staged:
        counts, repeated = materialize(counts), materialize(repeated)
    out = {
        "summary": p.table_summary(df, spec, batch),
        "column_profile": p.column_profile(counts, spec),
        "duplicate_summary": p.duplicate_summary(df, spec.key_columns, repeated),
        "duplicate_key_rows": p.duplicate_key_values(df, spec.key_columns, repeated),
    }
    if spec.columns_with("CODE"):
        out["categorical_distribution"] = p.categorical_distribution(counts, spec, code_master)
        out["unusual_candidates"] = p.unusual_values(out["categorical_distribution"])
    if spec.sequences:
        out["cross_column_check"] = p.sequence_distribution(df, spec)
    return out


def run_profile(
    spark: SparkSession,
    layout: Layout,
    specs: list[p.TableProfile],
    batch: str | None = None,
    code_masters: dict[str, DataFrame] | None = None,
    csv_folder: str | None = None,
) -> dict[str, str]:
    """Profile one batch of several bronze tables into one result table per kind.

    The kinds with the same columns for every table hold all tables, partitioned by batch and table, so a re-run
    replaces its own partitions. Repeated keys have different columns per table and go to a table of their own.
    """
    tables.ensure_database(spark, layout.database("meta"))
    if batch is None:
        first = spark.table(layout.table("bronze", specs[0].table_name))
        batch = first.agg(F.max(files.BATCH_COLUMN)).first()[0]
        if batch is None:
            raise RuntimeError(f"{specs[0].table_name} has no batch to profile")
    written = {}
    for spec in specs:
        rows = spark.table(layout.table("bronze", spec.table_name)).filter(F.col(files.BATCH_COLUMN) == batch)
        results = profile_frame(rows, spec, batch, (code_masters or {}).get(spec.table_name))
        for kind, frame in results.items():
            name = f"profile_{kind}" + (f"_{spec.table_name}" if kind == "duplicate_key_rows" else "")
            table = layout.table("meta", name)
            stamped = frame.withColumn("executed_at", F.current_timestamp())
            tables.replace_batch(stamped, table, {"ingest_date": batch, "table_name": spec.table_name})
            if csv_folder:
                saved = spark.table(table).filter(
                    (F.col("ingest_date") == batch) & (F.col("table_name") == spec.table_name)
                )
                files.export_csv(saved, f"{csv_folder}/{spec.table_name}/{kind}")
            written[kind] = table
    return written


def integrated(spark: SparkSession, layout: Layout, batch: str) -> dict[str, DataFrame]:
    """Cross-table views of one batch: column profile, categorical distribution, and one summary row per table."""

    def rows(kind: str) -> DataFrame:
        return spark.table(layout.table("meta", f"profile_{kind}")).filter(F.col("ingest_date") == batch)

    return {
        "integrated_column_profile": rows("column_profile").orderBy("table_name", "column_name"),
        "integrated_categorical_distribution": rows("categorical_distribution").orderBy(
            "table_name", "column_name", F.desc("count")
        ),
        "integrated_summary": p.integrated_summary(rows("duplicate_summary"), rows("cross_column_check")),
    }


def run_integrated(spark: SparkSession, layout: Layout, batch: str) -> dict[str, str]:
    written = {}
    for name, frame in integrated(spark, layout, batch).items():
        written[name] = layout.table("meta", name)
        stamped = frame.withColumn("executed_at", F.current_timestamp())
        tables.replace_batch(stamped, written[name], {"ingest_date": batch})
    return written
