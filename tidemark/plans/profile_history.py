"""Profiles over many batches from stored states, so that rows of earlier batches are never read again.

Every batch leaves three states behind: how often each value of each column occurs, how often each key and row digest
occurs, and how its date sequences are ordered. All of them are counts, so those of several batches add up to what one
pass over all rows would count, and a batch that is delivered again only replaces its own. States have a row per
distinct value or row at most; texts are held as hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import profile as p
from tidemark.plans.layout import Layout
from tidemark.session import materialize
from tidemark.sources import files, tables

BATCH = files.BATCH_COLUMN


class ProfileHistory:
    """States of one table's batches, and the profile of any of them together."""

    def __init__(self, spark: SparkSession, layout: Layout, spec: p.TableProfile):
        if BATCH in spec.key_columns:
            raise ValueError(f"{spec.table_name}: {BATCH} names the batch and cannot be a key")
        self.spark, self.spec = spark, spec
        tables.ensure_database(spark, layout.database("meta"))
        self.values, self.rows, self.sequences = (
            layout.table("meta", f"profile_state_{kind}_{spec.table_name}") for kind in ("values", "rows", "sequences")
        )

    def add(self, rows: DataFrame, batch: str) -> None:
        """Take a batch in, in place of what it said before. Its rows are read here and not again.

        The batch column is no part of a row: the same record in two batches is a repeated row.
        """
        rows = rows.drop(BATCH)
        columns = [c for c in self.spec.column_roles if c != BATCH]
        states = {
            self.values: p.value_counts(rows, columns, self.spec.columns_with("TEXT")),
            self.rows: p.row_states(rows, self.spec.key_columns),
        }
        if self.spec.sequences:
            states[self.sequences] = p.sequence_counts(rows, self.spec)
        for table, state in states.items():
            tables.replace_batch(state, table, {BATCH: batch})

    def remove(self, batch: str) -> None:
        for table in (self.values, self.rows, self.sequences):
            if tables.table_exists(self.spark, table):
                tables.drop_batch(self.spark, table, {BATCH: batch})

    def _states(self, table: str, batches: list[str] | None) -> DataFrame:
        states = self.spark.table(table)
        return (states if batches is None else states.filter(F.col(BATCH).isin(*batches))).drop(BATCH)

    def profile(self, batches: list[str] | None = None, code_master: DataFrame | None = None) -> dict[str, DataFrame]:
        """Profile results over the rows of some batches, or of all, as `profile_frame` gives them for one frame."""
        counts = materialize(p.merged_counts(self._states(self.values, batches)))
        keys = self.spec.key_columns
        rows = self._states(self.rows, batches)
        out = {
            "column_profile": p.column_profile(counts, self.spec),
            "duplicate_summary": p.merged_duplicates(rows, keys),
            "duplicate_key_rows": p.merged_key_values(rows, keys),
        }
        if self.spec.columns_with("CODE"):
            out["categorical_distribution"] = p.categorical_distribution(counts, self.spec, code_master)
            out["unusual_candidates"] = p.unusual_values(out["categorical_distribution"])
        if self.spec.sequences:
            out["cross_column_check"] = p.sequence_ratios(self._states(self.sequences, batches))
        return out
