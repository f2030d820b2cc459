"""Merging records of one entity, stable ids, lineage, and loading master data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, any_of
from tidemark.operators.keys import SENT_HASHES, join_grouped, key_counts, number_rows, rows_with_keys
from tidemark.operators.model import LINEAGE_KEY
from tidemark.operators.survivorship import REFERENCE, merge_records, survivors
from tidemark.session import materialize


@dataclass
class MergeResult:
    merged: DataFrame  # one row per match key, ids assigned
    unmatched: DataFrame  # rows without a full key, and rows of groups in conflict
    lineage: DataFrame  # every merged source record and the id it went into


def matchable(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with every match key present."""
    return df.dropna(subset=keys)


def unmatchable(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(any_of([F.col(k).isNull() for k in keys]))


def with_reference_time(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Add `_ref_ts` by lineage key. A record that occurs more often in the reference counts once."""
    return join_grouped(df, LINEAGE_KEY, reference, F.max(REFERENCE).alias(REFERENCE))


def with_own_reference_time(records: DataFrame, time: str) -> DataFrame:
    """`with_reference_time` for stored records whose own column `time` is the reference: it becomes `_ref_ts`.

    A record whose lineage key occurs once has its own time, so only those that share a short hash of it with another are joined with
    the latest times. `records` is read from files twice.
    """
    timed = records.withColumn(REFERENCE, F.col(time).cast("timestamp")).drop(time)
    short = F.xxhash64(*LINEAGE_KEY)
    repeated = key_counts(records.select(short.alias("__short")), ["__short"], "__n").filter("__n > 1")
    again = materialize(repeated.select("__short"))
    if again.limit(SENT_HASHES + 1).count() > SENT_HASHES:
        return with_reference_time(timed.drop(REFERENCE), timed.select(*LINEAGE_KEY, REFERENCE))
    sent = F.broadcast(again)
    alone = timed.join(sent, short == F.col("__short"), "left_anti")
    shared = timed.join(sent, short == F.col("__short"), "left_semi")
    return alone.unionByName(with_reference_time(shared.drop(REFERENCE), shared.select(*LINEAGE_KEY, REFERENCE)))


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"))


def merge_groups(df: DataFrame, keys: list[str], fill: list[str]) -> DataFrame:
    """One row per match key, by aggregates only.

    Every `fill` column takes its newest non-NULL value; the other columns come from the newest row. `_conflict` is true
    when the rows at the newest time disagree on a value.
    """
    return survivors(merge_records(df, keys, fill), keys)


def id_number(id_column: str, prefix: str) -> Column:
    return F.regexp_extract(id_column, rf"^{prefix}-(\d+)$", 1).try_cast("bigint")


def assign_ids(df: DataFrame, id_column: str, prefix: str, order_by: list[str], floor: int = 0) -> DataFrame:
    """Give rows without an id the numbers after the highest existing one, as `PREFIX-000001`, in the given order.

    `floor` is the highest number that exists elsewhere.

    The rows are needed for the highest number, for numbering and for the result, so they are written to scratch once.
    """
    df = materialize(df)
    missing = F.col(id_column).isNull()
    highest = F.greatest(F.coalesce(F.max(id_number(id_column, prefix)), F.lit(0)), F.lit(floor))
    highest = df.agg(highest.alias("n")).scalar()
    fresh = number_rows(df.filter(missing), order_by, name="__number")
    fresh = fresh.withColumn(id_column, F.format_string(f"{prefix}-%06d", F.col("__number") + highest))
    return df.filter(~missing).unionByName(fresh.drop("__number"))


def earlier_ids(df: DataFrame, keys: list[str], lineage: DataFrame) -> DataFrame:
    """(keys, __earlier): the id an earlier run gave to records of this match key. Each id goes to one key only."""
    names = [f"__l{i}" for i in range(len(LINEAGE_KEY))]
    known = lineage.select(*[F.col(k).alias(n) for k, n in zip(LINEAGE_KEY, names)], "TARGET_PK").distinct()
    condition = all_of([F.col(k).eqNullSafe(F.col(n)) for k, n in zip(LINEAGE_KEY, names)])
    per_key = df.select(*keys, *LINEAGE_KEY).join(known, condition).groupBy(*keys).agg(F.min("TARGET_PK").alias("i"))
    owner = per_key.groupBy("i").agg(F.min(F.struct(*keys)).alias("k"))
    return owner.select(*[F.col(f"k.{c}").alias(c) for c in keys], F.col("i").alias("__earlier"))


def merge_entities(
    candidate: DataFrame,
    reference: DataFrame | None,
    keys: list[str],
    id_column: str,
    prefix: str,
    entity: str,
    earlier_lineage: DataFrame | None = None,
) -> MergeResult:
    """Merge candidate rows that agree on all match keys; conflicts and rows without full keys are set aside.

    The merged groups are written to scratch once, because ids, conflicts and lineage all start from them. Without a `reference` the
    candidate rows carry their time as `_ref_ts`; they should be stored then, since they are read for the groups and for the lineage.
    """
    timed = matchable(candidate, keys)
    timed = timed if reference is None else with_reference_time(timed, reference)
    candidate = candidate.drop(REFERENCE) if reference is None else candidate
    fill = [c for c in candidate.columns if not c.startswith("_") and c not in keys]
    usable = matchable(candidate, keys)
    groups = materialize(merge_groups(timed, keys, fill))
    in_conflict = groups.filter("_conflict").select(*keys)
    merged = groups.filter(~F.col("_conflict")).drop("_conflict", "_group_size")
    if earlier_lineage is not None:
        merged = merged.join(earlier_ids(usable, keys, earlier_lineage), keys, "left")
        merged = merged.withColumn(id_column, F.coalesce(id_column, "__earlier")).drop("__earlier")
    merged = assign_ids(merged.select(*candidate.columns), id_column, prefix, ["_source_batch_id", "_source_record_key"])
    unmatched = unmatchable(candidate, keys).unionByName(rows_with_keys(usable, keys, in_conflict))
    return MergeResult(merged, unmatched, entity_lineage(usable, merged, keys, id_column, entity))


def entity_lineage(records: DataFrame, merged: DataFrame, keys: list[str], id_column: str, entity: str) -> DataFrame:
    """(lineage key, TARGET_ENTITY, TARGET_PK) for every source record of a merged entity."""
    ids = merged.select(*keys, F.col(id_column).alias("TARGET_PK"))
    joined = records.select(*LINEAGE_KEY, *keys).join(ids, keys, "inner")
    return joined.select(*LINEAGE_KEY, F.lit(entity).alias("TARGET_ENTITY"), "TARGET_PK")


def carried_lineage(earlier: DataFrame, current: DataFrame) -> DataFrame:
    """The current entries, and those of records that earlier merges took in and that are no candidates any more.

    An earlier entry follows its entity: if a record of the same earlier id has another id now, so has the entry.
    """
    records = current.select(*LINEAGE_KEY).distinct()
    gone = rows_with_keys(earlier, LINEAGE_KEY, records, "left_anti")
    names = [f"__c{i}" for i in range(len(LINEAGE_KEY))]
    now = current.select(*[F.col(k).alias(n) for k, n in zip(LINEAGE_KEY, names)], F.col("TARGET_PK").alias("__now"))
    same = all_of([F.col(k).eqNullSafe(F.col(n)) for k, n in zip(LINEAGE_KEY, names)])
    moved = earlier.join(now, same).groupBy(F.col("TARGET_PK").alias("__was")).agg(F.min("__now").alias("__is"))
    followed = gone.join(moved, F.col("TARGET_PK") == F.col("__was"), "left")
    followed = followed.withColumn("TARGET_PK", F.coalesce("__is", "TARGET_PK"))
    return current.unionByName(followed.select(*current.columns))


def reuse_ids(df: DataFrame, existing: DataFrame, key: str, id_column: str) -> DataFrame:
    """Carry over the ids of rows whose natural key is already known; all others get NULL."""
    known = existing.filter(F.col(id_column).isNotNull()).groupBy(F.col(key).alias("__key"))
    ids = known.agg(F.min(id_column).alias("__id"))
    joined = df.join(ids, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(id_column, F.col("__id")).drop("__key", "__id").select(*df.columns)


def load_master(df: DataFrame, existing: DataFrame | None, key: str, id_column: str, prefix: str) -> DataFrame:
    """Full snapshot of master data with stable ids: known natural keys keep theirs, new ones get the next numbers."""
    rows = df if existing is None else reuse_ids(df, existing, key, id_column)
    return assign_ids(rows, id_column, prefix, [key])
