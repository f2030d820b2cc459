"""Landing source files as dated bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.layout import Layout
from tidemark.sources import files, tables


def read_source(spark: SparkSession, base: str, fmt: str, columns: list[str] | None = None, schema=None) -> DataFrame:
    """Newest batch of a source folder with its `ingest_date` column."""
    if fmt == "csv":
        return files.read_csv_batches(spark, base, columns)
    if fmt in ("json_unified", "json_lines"):  # one document per file, read by one task, or one per line
        folder, batch = files.newest_batch_folder(spark, base)
        return files.read_sessions(spark, folder, schema, fmt == "json_unified").withColumn(files.BATCH_COLUMN, F.lit(batch))
    raise ValueError(f"unsupported source format {fmt}")


def ingest(
    spark: SparkSession, layout: Layout, source: str, base: str, fmt: str, columns: list[str] | None = None, schema=None
) -> str:
    """Land the newest batch. Only its own `ingest_date` partition is replaced; earlier batches stay."""
    table = layout.table("bronze", source)
    tables.ensure_database(spark, layout.database("bronze"))
    tables.replace_batches(read_source(spark, base, fmt, columns, schema), table, [files.BATCH_COLUMN])
    return table
