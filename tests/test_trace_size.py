"""Trace ids and key rules on repeated rows and keys: right ids, and rows that do not travel without need."""

from collections import Counter

from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tidemark.operators import keys as k
from tidemark.operators import validation as v
from workload import registry


def ids(rows, **kind):
    return Counter((r.n, r.i) for r in k.with_unique_id(rows, "i", F.col("t"), **kind).collect())


def test_ids_do_not_depend_on_other_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    more = rows.unionByName(rows.filter("n = 1")).unionByName(spark.createDataFrame([(3, "b")], "n int, t string"))
    first, second = ids(rows), ids(more, stored=True)
    assert set(first) < set(second) and len(second) == 4 and set(second.values()) == {1}


def test_many_copies_and_many_repeated_rows(spark, monkeypatch):
    """A group of copies larger than a task writes out at once, and more repeated rows than are sent to all tasks."""
    rows = spark.range(0, 9000, numPartitions=5).select(F.when(F.col("id") < 5000, F.lit(0)).otherwise(F.col("id") % 2000).alias("n"))
    rows = rows.withColumn("t", F.col("n").cast("string"))
    few = ids(rows)
    monkeypatch.setattr(k, "SENT_HASHES", 10)
    assert ids(rows) == few
    assert len(few) == 9000 and set(few.values()) == {1}
    assert Counter(n for n, _ in few) == Counter(r.n for r in rows.collect())


def test_large_key_group_is_repaired_alike(spark, monkeypatch):
    rows = spark.range(0, 300, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("A")).when(F.col("id") % 3 == 1, F.lit(" ")).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("outbound")).otherwise(F.lit("inbound")).alias("_source_system"),
        F.format_string("%04d", "id").alias("_source_record_key"),
    )
    repair = v.PrimaryKeyRepair("id", "outbound")
    want = Counter(map(tuple, v.repair_primary_keys(rows, repair).collect()))
    monkeypatch.setattr(v, "GROUP_ROWS", 5)
    assert Counter(map(tuple, v.repair_primary_keys(rows, repair).collect())) == want
    assert ("A-DUP51", "outbound", "0000", "A") in want


def test_checked_rows_stay_where_they_are(spark, sf_dir):
    """With few wrong keys, the rows themselves are neither sorted nor exchanged after the repair."""
    plan = plan_of(registry.QUERIES["val_split"](spark, sf_dir))
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
