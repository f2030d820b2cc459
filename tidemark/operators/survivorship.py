"""Survivorship that can go on: what some records say of an entity is a state, and states merge.

A state has one row per match key: the newest reference time among its records, the row that carries the columns which
are not filled, per filled column the newest value with its own time and tie-break, and the least and greatest value at
the newest time, by which a conflict shows. All of it is a maximum or minimum, so states merge in any order and any
grouping to the same state, and a later merge knows how old each value is without the records it came from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of

REFERENCE = "_ref_ts"
TIE_BREAK = ["_source_batch_id", "_source_system", "_source_record_key"]
STATE = ["_group_size", "_newest", "_row", "_top", "_low", "_high"]


def record_states(records: DataFrame, keys: list[str], fill: list[str], also: list[str] = ()) -> DataFrame:
    """Every record as the state it makes alone. `also` are columns to keep beside the keys, such as a partition.

    Newest means `_ref_ts` (NULL oldest), then batch, source and record key.
    """
    rest = [c for c in records.columns if c not in (*keys, *fill, REFERENCE, *TIE_BREAK)]
    newest = F.struct(F.col(REFERENCE).isNotNull().alias("known"), F.col(REFERENCE).alias("at"))
    tie = [F.col(c) for c in TIE_BREAK]

    def value(c: str) -> Column:
        dated = F.struct(newest.alias("newest"), *tie, F.col(c).alias("value"))
        return F.when(F.col(c).isNotNull(), dated).alias(c)

    plain = F.struct(*[F.col(c) for c in fill])
    return records.select(
        *keys,
        *also,
        F.lit(1).cast("bigint").alias("_group_size"),
        newest.alias("_newest"),
        F.struct(*tie, *[F.col(c) for c in rest]).alias("_row"),
        F.struct(*[value(c) for c in fill]).alias("_top"),
        plain.alias("_low"),
        plain.alias("_high"),
    )


def merge_records(records: DataFrame, keys: list[str], fill: list[str], also: list[str] = ()) -> DataFrame:
    """`merge_states(record_states(...))` in one aggregate over the records as they are.

    The least value at the newest time is a minimum too, as times can be negated. So records are exchanged once, combined before that,
    and what is sorted for it are the plain columns, not the wide states. `_ref_ts` is a timestamp.
    """
    rest = [c for c in records.columns if c not in (*keys, *fill, REFERENCE, *TIE_BREAK)]
    known, tie = F.col(REFERENCE).isNotNull(), [F.col(c) for c in TIE_BREAK]
    newest = F.struct(known.alias("known"), F.col(REFERENCE).alias("at"))
    micros = F.unix_micros(F.col(REFERENCE).cast("timestamp"))
    row = F.struct(newest.alias("newest"), F.struct(*tie, *[F.col(c) for c in rest]).alias("row"))

    def top(c: str) -> Column:
        dated = F.struct(newest.alias("newest"), *tie, F.col(c).alias("value"))
        return F.max(F.when(F.col(c).isNotNull(), dated))

    def low(c: str) -> Column:
        return F.min(F.struct((~known).alias("unknown"), (-micros).alias("age"), F.col(c).isNull().alias("empty"), F.col(c).alias("value")))

    def high(c: str) -> Column:
        return F.max(F.struct(newest.alias("newest"), F.col(c).isNotNull().alias("filled"), F.col(c).alias("value")))

    merged = records.groupBy(*keys, *also).agg(
        F.count(F.lit(1)).alias("_group_size"),
        F.max(row).alias("__row"),
        *[top(c).alias(f"__top_{c}") for c in fill],
        *[low(c).alias(f"__low_{c}") for c in fill],
        *[high(c).alias(f"__high_{c}") for c in fill],
    )

    def values(name: str) -> Column:
        return F.struct(*[F.col(f"__{name}_{c}.value").alias(c) for c in fill])

    return merged.select(
        *keys,
        *also,
        "_group_size",
        F.col("__row.newest").alias("_newest"),
        F.col("__row.row").alias("_row"),
        F.struct(*[F.col(f"__top_{c}").alias(c) for c in fill]).alias("_top"),
        values("low").alias("_low"),
        values("high").alias("_high"),
    )


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state per key. First per key and time, then per key, both with map-side combining: group size does not matter."""
    fill = states.schema["_top"].dataType.names
    per_time = states.groupBy(*keys, "_newest").agg(
        F.sum("_group_size").alias("_group_size"),
        F.max("_row").alias("_row"),
        *[F.max(f"_top.{c}").alias(f"__top_{c}") for c in fill],
        *[F.min(f"_low.{c}").alias(f"__low_{c}") for c in fill],
        *[F.max(f"_high.{c}").alias(f"__high_{c}") for c in fill],
    )

    def packed(name: str) -> Column:
        return F.struct(*[F.col(f"__{name}_{c}").alias(c) for c in fill])

    per_key = per_time.groupBy(*keys).agg(
        F.sum("_group_size").alias("_group_size"),
        F.max("_newest").alias("_newest"),
        F.max_by("_row", "_newest").alias("_row"),
        *[F.max(f"__top_{c}").alias(f"__top_{c}") for c in fill],
        F.max_by(packed("low"), "_newest").alias("_low"),
        F.max_by(packed("high"), "_newest").alias("_high"),
    )
    return per_key.select(*keys, "_group_size", "_newest", "_row", packed("top").alias("_top"), "_low", "_high")


def merge_all(states: list[DataFrame], keys: list[str]) -> DataFrame:
    """States of several batches as one, whatever their order."""
    return merge_states(reduce(DataFrame.unionByName, states), keys)


def survivors(state: DataFrame, keys: list[str]) -> DataFrame:
    """The entity that each state stands for, `_group_size`, and `_conflict`: records at the newest time disagree."""
    fill, row = state.schema["_top"].dataType.names, state.schema["_row"].dataType.names
    differs = any_of([F.coalesce(F.col(f"_low.{c}") != F.col(f"_high.{c}"), F.lit(False)) for c in fill])
    return state.select(
        *keys,
        *[F.col(f"_top.{c}.value").alias(c) for c in fill],
        *[F.col(f"_row.{c}").alias(c) for c in row],
        "_group_size",
        differs.alias("_conflict"),
    )
