"""Comparison by digests against the plain bag difference."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import diff

KINDS = "a string, b string, n int, d double, t timestamp"
COLUMNS = ["a", "b", "n", "d", "t"]


def bags(spark, seed: int):
    rng = random.Random(seed)

    def row():
        return (rng.choice([None, "", "x"]), rng.choice([None, "", "x"]), rng.choice([None, 0, 1]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]), None)

    old = [row() for _ in range(300)] + [("hot", None, 1, 2.0, None)] * 400
    new = [r for r in old if rng.random() < 0.97] + [row() for _ in range(5)] + [("hot", None, 1, 2.0, None)] * rng.choice([0, 3])
    rng.shuffle(new)
    return [spark.createDataFrame(rows, KINDS).repartition(3) for rows in (old, new)]


@pytest.mark.parametrize("seed", [1, 2])
def test_differing_rows(spark, seed, monkeypatch):
    old, new = bags(spark, seed)
    want = sorted(map(str, diff.row_difference(old, new, COLUMNS).collect()))
    assert want and sorted(map(str, diff.row_difference_by_digest(old, new, COLUMNS).collect())) == want
    monkeypatch.setattr(diff, "SLICE_BITS", 1)  # nearly everything shares a slice
    assert sorted(map(str, diff.row_difference_by_digest(old, new, COLUMNS).collect())) == want


def test_places_of_nulls_and_copies_count(spark):
    def one(*rows):
        return spark.createDataFrame(list(rows), "a string, b string")

    for old, new in ((one((None, "x")), one(("x", None))), (one(("x", "")), one(("", "x"))), (one(("x", "y"), ("x", "y")), one()), (one(("x", "y")), one(*[("x", "y")] * 3))):
        assert diff.row_difference_by_digest(old, new, ["a", "b"]).count() == diff.row_difference(old, new, ["a", "b"]).count() > 0
    assert diff.row_difference_by_digest(one(), one(), ["a", "b"]).count() == 0


def test_equal_tables_exchange_digests_only(spark, monkeypatch):
    """Every row of equal tables is stopped by the empty list of slices: the comparison itself gets none."""
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    compared = []
    plain = diff.row_difference

    def watched(old, new, columns):
        compared.append(old.count() + new.count())
        return plain(old, new, columns)

    monkeypatch.setattr(diff, "row_difference", watched)
    assert diff.row_difference_by_digest(rows, rows.repartition(5), ["id", "v"]).count() == 0
    changed = rows.withColumn("v", F.when(F.col("id") == 77, "other").otherwise(F.col("v")))
    assert diff.row_difference_by_digest(rows, changed, ["id", "v"]).count() == 2
    assert compared == [0, 2]


def test_rows_are_filtered_where_they_lie(spark):
    """Where many rows differ all over a large table, the others are not joined with the list of differing ones."""
    rows = spark.range(5_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("id") % 3 == 0, "other").otherwise(F.col("v")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = diff.row_difference_by_digest(rows, changed, ["id", "v"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 2 * 1667
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
