"""Tables laid out by key ranges, so that an upsert reads and rewrites only the ranges its keys fall into.

A table has one partition per zone, and a zone is named by the least key that belongs to it, as JSON. So the list of partitions,
which the catalog keeps, is the zone map: it cannot differ from the data, and nothing is read to get it. A key belongs to the
last zone whose name is not above it; it is found by a binary search over the names. Neighbouring keys share zones, unlike
with hash buckets. A zone that has grown beyond twice the wanted size is split where it is rewritten anyway, at keys that cut its rows evenly.

Zones are metadata, and each costs a change of the catalog. So their number does not grow with the table: once it has more rows
than `ZONES` zones of the wanted size, the size that zones are split at grows with it.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import number_rows, rows_with_keys
from tidemark.session import METADATA_ROW_LIMIT, materialize, metadata_rows
from tidemark.sources import tables

ZONE = "_zone"
FIRST = "{}"  # a key of NULLs, below which there is none
ZONE_ROWS = 1_000_000
ZONES = 500


def zone_names(spark: SparkSession, table: str) -> list[str]:
    """The zones of a table, from the catalog."""
    names = [unquote(r[0]).partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").limit(METADATA_ROW_LIMIT + 1).collect()]
    if len(names) > METADATA_ROW_LIMIT:
        raise ValueError(f"{table} has more than {METADATA_ROW_LIMIT} zones: choose larger ones")
    return names


def zone_of(df: DataFrame, keys: list[str], names: list[str]) -> Column:
    """The zone a row of the frame belongs to."""
    kinds = dict(df.dtypes)
    fields = ", ".join(f"`{k}`: {kinds[k]}" for k in keys)
    every = sorted({FIRST, *names})
    lows = F.sort_array(F.from_json(F.lit(f"[{', '.join(every)}]"), f"array<struct<{fields}>>"))
    key = F.struct(*keys)

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        above = F.get(lows, middle) > key
        return F.struct(
            F.when(above, span["low"]).otherwise(middle).alias("low"), F.when(above, middle).otherwise(span["high"]).alias("high")
        )

    span = F.struct(F.lit(0).alias("low"), F.lit(len(every)).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(len(every).bit_length())), span, halve) if len(every) > 1 else span
    return F.to_json(F.get(lows, found["low"]))


def split_points(rows: DataFrame, keys: list[str], zone_rows: int) -> list[str]:
    """Names of further zones for the zones of the frame that hold more than twice the wanted rows."""
    sizes = rows.groupBy(ZONE).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * zone_rows)
    crowded = rows.select(ZONE, *keys).join(F.broadcast(sizes.select(ZONE)), ZONE)  # zones are metadata
    numbered = number_rows(crowded, keys, [ZONE], "__number")
    cuts = numbered.filter((F.col("__number") > 1) & ((F.col("__number") - 1) % zone_rows == 0))
    return [r["name"] for r in metadata_rows(cuts.select(F.to_json(F.struct(*keys)).alias("name")).distinct())]


def upsert(
    df: DataFrame, table: str, keys: list[str], removed: DataFrame | None = None, zone_rows: int = ZONE_ROWS, stored: bool = False
) -> dict:
    """Rows of the frame take the place of rows with the same key; keys of `removed` disappear as well.

    Only zones that one of these keys falls into are read and written. Returns their number and that of all zones. The frame is read
    several times, so it is written once unless it is `stored`: read from files. Of a table without zones nothing is replaced.
    """
    spark = df.sparkSession
    tables.create_empty(df.withColumn(ZONE, F.lit(FIRST)), table, [ZONE])
    names = zone_names(spark, table)
    rows = tables.align(df.withColumn(ZONE, F.lit(FIRST)), table).drop(ZONE)
    rows = rows.withColumn(ZONE, zone_of(rows, keys, names))
    rows = rows if stored else materialize(rows)
    leaving = rows.select(*keys, ZONE)
    if removed is not None:
        gone = removed.select(*[F.col(k).cast(rows.schema[k].dataType).alias(k) for k in keys])
        leaving = leaving.unionByName(gone.withColumn(ZONE, zone_of(gone, keys, names)))
    if names:
        leaving = materialize(leaving.distinct())
    touched = [r[ZONE] for r in metadata_rows(leaving.select(ZONE).distinct())]
    staged, replaced = rows, set(touched) & set(names)
    if replaced:
        held = spark.table(table).filter(F.col(ZONE).isin(touched))
        staged = materialize(rows_with_keys(held, keys, leaving.select(*keys), "left_anti").unionByName(rows))
    apart = spark.table(table).filter(~F.col(ZONE).isin(touched)) if touched else spark.table(table)
    total = apart.count() + staged.count()  # from the footers of the files
    cuts = split_points(staged, keys, max(zone_rows, -(-total // ZONES)))
    if cuts:
        staged = staged.withColumn(ZONE, zone_of(staged, keys, [*names, *cuts]))
    tables.replace_batches(staged, table, [ZONE])
    left = {r[ZONE] for r in metadata_rows(staged.select(ZONE).distinct())} if replaced else set()
    for name in sorted(replaced - left):  # emptied zones fall to the one before
        tables.drop_batch(spark, table, {ZONE: name})
    return {"touched_zones": len(touched), "zones": len(zone_names(spark, table))}
