"""Comparison of two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of
from tidemark.operators.keys import filter_of, flag_like
from tidemark.session import materialize, metadata_frame

SLICE_BITS = 16
VOLATILE_COLUMNS = ("_mapping_run_id", "_mapped_at")


def schema_difference(old: DataFrame, new: DataFrame) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(name, type) pairs only in the old and only in the new schema."""
    a, b = set(old.dtypes), set(new.dtypes)
    return sorted(a - b), sorted(b - a)


def common_columns(old: DataFrame, new: DataFrame, skip: tuple[str, ...] = VOLATILE_COLUMNS) -> list[str]:
    return [c for c in old.columns if c in new.columns and c not in skip]


def row_difference(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Bag difference both ways in one aggregate: every differing row with its surplus in `old` and in `new`.

    Equal rows cancel inside the map-side combine, so a row with very many copies does not travel copy by copy.
    """
    tagged = old.select(*columns, F.lit(1).alias("__sign")).unionByName(new.select(*columns, F.lit(-1).alias("__sign")))
    balance = tagged.groupBy(*columns).agg(F.sum("__sign").alias("__balance")).filter("__balance <> 0")
    return balance.select(
        *columns,
        F.greatest(F.col("__balance"), F.lit(0)).alias("only_in_old"),
        F.greatest(-F.col("__balance"), F.lit(0)).alias("only_in_new"),
    )


def _hash_of(df: DataFrame, columns: list[str], salt: int) -> Column:
    """64-bit hash of some columns in which a NULL counts by its place, and 0.0 is -0.0."""
    kinds, parts = dict(df.dtypes), [F.lit(salt)]
    for c in columns:
        value = F.col(c) + F.lit(0.0).cast(kinds[c]) if kinds[c] in ("float", "double") else F.col(c)
        parts += [F.col(c).isNull(), value]
    return F.xxhash64(*parts)


def _unequal(rows: DataFrame, slices: list[str], hashes: tuple[str, ...] = ("__h", "__g")) -> DataFrame:
    """Slices whose digests of both sides differ. A digest is the count and the sums of the hashes, in halves that
    cannot overflow; it does not depend on the order of rows, and copies count."""
    sums = [F.sum("__sign").alias("__n")]
    for name in hashes:
        low, high = F.col(name).bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(name, 32)
        sums += [F.sum(F.col("__sign") * low).alias(f"{name}_low"), F.sum(F.col("__sign") * high).alias(f"{name}_high")]
    digests = rows.groupBy(*slices).agg(*sums)
    names = [c for c in digests.columns if c not in slices]
    return digests.filter(any_of([F.col(c) != 0 for c in names])).select(*slices)


def _with_hash_like(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows whose `__h` is among the hashes, and by chance some others: a filter of fixed size is sent to the rows, which stay in place."""
    return flag_like(rows, F.col("__h"), filter_of(hashes), "__like").filter("__like").drop("__like")


def row_difference_by_digest(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """What `row_difference` gives, without moving rows that both sides have.

    Rows are dealt by hash into 65,536 slices, and only a digest per slice is exchanged. Of slices that differ a digest per hash is
    exchanged, and only rows whose hash differs are compared, with those that a filter of fixed size lets through by chance, and
    which cancel. Of equal tables nothing but digests moves; the rows are read once for that, and at most three times. Two different bags have equal digests with a chance
    of about one in 2^128.
    """

    def signed(df: DataFrame, sign: int) -> DataFrame:
        hashes = [_hash_of(df, columns, salt).alias(name) for salt, name in ((0, "__h"), (1, "__g"))]
        return df.select(*columns, *hashes, F.lit(sign).alias("__sign"))

    bits = (1 << SLICE_BITS) - 1
    rows = signed(old, 1).unionByName(signed(new, -1))
    rows = rows.withColumn("__slice", F.col("__h").bitwiseAND(F.lit(bits)))
    slices = materialize(_unequal(rows, ["__slice"]))
    some = rows.join(F.broadcast(slices), "__slice", "left_semi")  # at most 2 ** SLICE_BITS rows
    few = _with_hash_like(some, _unequal(some, ["__h"], ("__g",)))
    return row_difference(few.filter("__sign = 1"), few.filter("__sign = -1"), columns)


def rows_only_in(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the left bag that the right bag does not cover."""
    return left.select(*columns).exceptAll(right.select(*columns))


def table_report(old: DataFrame, new: DataFrame, primary_key: str | None = None) -> DataFrame:
    """(check, old_value, new_value, is_match): row counts, schema, repeated keys, NULLs per column, row differences."""
    spark = old.sparkSession
    columns = common_columns(old, new)
    plain = [c for c in columns if not c.startswith("_")]

    def counts(df: DataFrame, side: str) -> DataFrame:
        sums = [F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in plain]]
        wide = df.agg(*sums)
        names = wide.columns
        return wide.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias(side)) for c in names]))
        )

    report = counts(old, "old_value").join(counts(new, "new_value"), "check")
    if primary_key:
        both = old.select(primary_key, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
            new.select(primary_key, F.lit(0).alias("o"), F.lit(1).alias("n"))
        )
        keys = both.groupBy(primary_key).agg(F.sum("o").alias("o"), F.sum("n").alias("n"))
        repeated = keys.agg(
            F.count_if(F.col("o") > 1).alias("old_value"), F.count_if(F.col("n") > 1).alias("new_value")
        )
        report = report.unionByName(repeated.select(F.lit("repeated_keys").alias("check"), "old_value", "new_value"))
    differing = row_difference_by_digest(old, new, columns).agg(
        F.coalesce(F.sum("only_in_old"), F.lit(0)).alias("old_value"),
        F.coalesce(F.sum("only_in_new"), F.lit(0)).alias("new_value"),
    )
    report = report.unionByName(differing.select(F.lit("differing_rows").alias("check"), "old_value", "new_value"))
    only_old, only_new = schema_difference(old, new)
    schema = metadata_frame(spark, [{"check": "schema", "old_value": len(only_old), "new_value": len(only_new)}])
    number = {c: F.col(c).cast("bigint") for c in ("old_value", "new_value")}
    report = report.unionByName(schema.withColumns(number))
    surplus = F.col("check").isin("differing_rows", "schema")
    same = F.when(surplus, (F.col("old_value") == 0) & (F.col("new_value") == 0))
    return report.withColumn("is_match", same.otherwise(F.col("old_value") == F.col("new_value")))
