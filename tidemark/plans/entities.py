"""Entities that are merged batch by batch: stored records, states, ids and lineage of one target.

A merge reads the records of its own batches only. What earlier batches said is in their stored states, one row per entity
and batch, of which those of the touched entities are merged again. A batch that is delivered again replaces its own
states, so a correction withdraws what the batch said before. Records of other batches are read only where an entity
changes sides, that is, where it falls into conflict or comes out of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of
from tidemark.operators import entity
from tidemark.operators.keys import rows_with_keys
from tidemark.operators.model import LINEAGE_KEY
from tidemark.operators.survivorship import merge_records, merge_states, survivors
from tidemark.plans.layout import Layout
from tidemark.session import materialize
from tidemark.sources import tables

PARTITION = ["_source_system", "_source_batch_id"]
# The batch a state is of; the names inside a state say where its values come from.
STATE_PARTITION = ["_state_system", "_state_batch"]


class EntityStore:
    """Merged entities of one target in `gold_candidate`, and what is needed to go on merging."""

    def __init__(self, spark: SparkSession, layout: Layout, target: str, keys: list[str], id_column: str, prefix: str):
        self.spark, self.target, self.keys = spark, target, keys
        self.id_column, self.prefix = id_column, prefix
        self.records, self.states, self.entities, self.lineage, self.unmatched = (
            layout.table(stage, target)
            for stage in ("gold_entity_record", "gold_entity_state", "gold_candidate", "gold_entity_lineage", "gold_mapping_error")
        )
        self.ids = layout.table("gold_entity_state", f"{target}_id")
        for table in (self.records, self.states, self.entities, self.lineage, self.unmatched):
            tables.ensure_database(spark, table.split(".")[0])

    def _table(self, name: str, schema_of: DataFrame, parts: list[str]) -> DataFrame:
        tables.create_empty(schema_of, name, parts)
        return self.spark.table(name)

    def _of_batches(self, rows: DataFrame, columns: list[str], batches: list[tuple[str, str]]) -> DataFrame:
        chosen = [F.col(columns[0]).eqNullSafe(F.lit(s)) & F.col(columns[1]).eqNullSafe(F.lit(b)) for s, b in batches]
        return rows.filter(any_of(chosen))

    def save(self, records: DataFrame, system: str, batch: str) -> None:
        """Take the records of a batch in, in place of what the batch held."""
        part = dict(zip(PARTITION, (system, batch)))
        tables.replace_batch(records, self.records, part)
        if tables.table_exists(self.spark, self.unmatched):
            tables.drop_batch(self.spark, self.unmatched, part)

    def merge(self, reference: DataFrame, batches: list[tuple[str, str]]) -> dict:
        """Merge the saved records of these batches into the entities.

        Afterwards entities, lineage and unmatched records are those of one merge over all saved batches, in whatever
        order the batches came; only the numbers in ids follow the order in which entities appeared.
        """
        keys = self.keys
        fresh = self._of_batches(self.spark.table(self.records), PARTITION, batches)
        columns = self.spark.table(self.records).columns
        fill = [c for c in columns if not c.startswith("_") and c not in (*keys, self.id_column)]
        usable = entity.matchable(fresh, keys)
        # A record is timed by its lineage key, which names its batch, so the times of other batches are left out.
        timed = entity.with_reference_time(usable.drop(self.id_column), self._of_batches(reference, PARTITION, batches))
        parts = [F.col(c).alias(p) for c, p in zip(PARTITION, STATE_PARTITION)]
        fresh_states = materialize(merge_records(timed.select("*", *parts), keys, fill, STATE_PARTITION))

        states = self._table(self.states, fresh_states, STATE_PARTITION)
        replaced = self._of_batches(states, STATE_PARTITION, batches).select(*keys)
        touched = materialize(replaced.unionByName(fresh_states.select(*keys)).distinct())
        for system, batch in batches:
            part = dict(zip(STATE_PARTITION, (system, batch)))
            tables.replace_batch(self._of_batches(fresh_states, STATE_PARTITION, [(system, batch)]).drop(*part), self.states, part)
        said = materialize(rows_with_keys(self.spark.table(self.states), keys, touched))
        groups = materialize(survivors(merge_states(said.drop(*STATE_PARTITION), keys), keys))

        named = self._with_ids(groups.filter("NOT _conflict").drop("_conflict", "_group_size"))
        merged = materialize(named.select(*columns))
        before = rows_with_keys(self._table(self.entities, merged, PARTITION), keys, touched)
        was, now = materialize(before.select(*keys)), merged.select(*keys)
        # Entities that other batches speak of too, and that were not there before, or are not any more.
        others = said.join(F.broadcast(self._named(batches)), STATE_PARTITION, "left_anti").select(*keys).distinct()
        risen = materialize(rows_with_keys(rows_with_keys(others, keys, now), keys, was, "left_anti"))
        fallen = materialize(rows_with_keys(rows_with_keys(others, keys, was), keys, now, "left_anti"))

        placed = self._placed(usable, merged, groups.filter("_conflict"))
        self._trace(placed, merged, batches, risen, fallen)
        self._set_aside(fresh, placed, batches, risen, fallen)
        tables.upsert(merged, self.entities, keys, touched)
        return {"merged_rows": merged.count(), "touched_keys": touched.count()}

    def _named(self, batches: list[tuple[str, str]]) -> DataFrame:
        kind = ", ".join(f"{c} string" for c in STATE_PARTITION)
        return self.spark.createDataFrame(batches, kind)

    def _with_ids(self, groups: DataFrame) -> DataFrame:
        """Every entity gets the id that its key was ever given, or the next one, which is noted at once."""
        given = groups.select(*self.keys, F.lit(None).cast("string").alias("__id")).limit(0)
        given = self._table(self.ids, given, [])
        floor = given.agg(F.coalesce(F.max(entity.id_number("__id", self.prefix)), F.lit(0))).first()[0]
        known = groups.join(given, self.keys, "left").withColumnRenamed("__id", self.id_column)
        named = materialize(entity.assign_ids(known, self.id_column, self.prefix, ["_source_batch_id", "_source_record_key"], floor))
        ids = named.select(*self.keys, F.col(self.id_column).alias("__id"))
        tables.append(materialize(rows_with_keys(ids, self.keys, given.select(*self.keys), "left_anti")), self.ids)
        return named

    def _older(self, keys: DataFrame, batches: list[tuple[str, str]]) -> DataFrame:
        """Records of other batches with one of the keys."""
        records = self.spark.table(self.records)
        chosen = [F.col(PARTITION[0]).eqNullSafe(F.lit(s)) & F.col(PARTITION[1]).eqNullSafe(F.lit(b)) for s, b in batches]
        return rows_with_keys(records.filter(~any_of(chosen)), self.keys, keys)

    def _placed(self, usable: DataFrame, merged: DataFrame, in_conflict: DataFrame) -> DataFrame:
        """Each record with the id of its entity as `__pk`, NULL where its key is in conflict. Records meet the keys once."""
        ids = merged.select(*self.keys, F.col(self.id_column).alias("__pk"))
        ids = ids.unionByName(in_conflict.select(*self.keys, F.lit(None).cast("string").alias("__pk")))
        return materialize(usable.join(ids, self.keys, "inner").select(*usable.columns, "__pk"))

    def _trace(self, placed: DataFrame, merged: DataFrame, batches, risen: DataFrame, fallen: DataFrame) -> None:
        entries = placed.filter("__pk IS NOT NULL").withColumn("TARGET_ENTITY", F.lit(self.target))
        lineage = entries.select(*LINEAGE_KEY, "TARGET_ENTITY", F.col("__pk").alias("TARGET_PK"))
        stored = self._table(self.lineage, lineage, PARTITION)
        for system, batch in batches:
            part = dict(zip(PARTITION, (system, batch)))
            tables.replace_batch(self._of_batches(lineage, PARTITION, [(system, batch)]).drop(*part), self.lineage, part)
        added = entity.entity_lineage(self._older(risen, batches), merged, self.keys, self.id_column, self.target)
        gone = self._older(fallen, batches).select(*LINEAGE_KEY)
        tables.upsert(materialize(added.select(*stored.columns)), self.lineage, LINEAGE_KEY, materialize(gone))

    def _set_aside(self, fresh: DataFrame, placed: DataFrame, batches, risen: DataFrame, fallen: DataFrame) -> None:
        """Records without a full key or with a key in conflict are unmatched; those of merged entities no longer are."""
        aside = entity.unmatchable(fresh, self.keys).unionByName(placed.filter("__pk IS NULL").drop("__pk"))
        rows = aside.unionByName(self._older(fallen, batches))
        settled = self._older(risen, batches).select(*LINEAGE_KEY)
        stored = self._table(self.unmatched, rows, PARTITION)
        # Of the merged records only those matter that a merge before has set aside; mostly there are none.
        before = materialize(self._of_batches(stored, PARTITION, batches).select(*LINEAGE_KEY).distinct())
        if not before.isEmpty():
            merged = placed.filter("__pk IS NOT NULL").select(*LINEAGE_KEY)
            settled = settled.unionByName(rows_with_keys(before, LINEAGE_KEY, merged))
        tables.upsert(materialize(rows), self.unmatched, LINEAGE_KEY, materialize(settled))
