"""Table writes: only touched partitions are rewritten, values are escaped, and a stopped overwrite is recovered."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.keys import with_unique_id
from tidemark.sources import tables

ROWS = [(i, f"v{i}", part) for i, part in enumerate(["a", "a", "b", "b", "it's", None])]


@pytest.fixture
def table(spark, layout):
    name = f"{layout.database('gold')}.t"
    frame = spark.createDataFrame(ROWS, "id int, v string, part string")
    tables.create_empty(frame, name, ["part"])
    tables.append(frame, name)
    return name


def files(spark, table):
    spark.catalog.refreshTable(table)
    found = spark.table(table).select("part", F.input_file_name().alias("f")).distinct().collect()
    return {(r.part, r.f) for r in found}


def content(spark, table):
    return sorted((r.id, r.v, str(r.part)) for r in spark.table(table).collect())


def test_delete_touches_its_partitions_only(spark, table):
    before = files(spark, table)
    tables.delete_where(spark, table, F.col("id") == 1)
    after = files(spark, table)
    assert {f for f in before if f[0] != "a"} == {f for f in after if f[0] != "a"}
    assert [r[0] for r in content(spark, table)] == [0, 2, 3, 4, 5]
    tables.delete_where(spark, table, F.col("part") == "it's")
    tables.delete_where(spark, table, F.col("part").isNull())
    assert [r[0] for r in content(spark, table)] == [0, 2, 3]


def test_replace_touches_its_partitions_only(spark, table):
    before = files(spark, table)
    new = spark.createDataFrame([(9, "new", "b")], "id int, v string, part string")
    tables.replace_where(new, table, F.col("part") == "b")
    after = files(spark, table)
    assert {f for f in before if f[0] != "b"} == {f for f in after if f[0] != "b"}
    assert [r[0] for r in content(spark, table)] == [0, 1, 4, 5, 9]


def test_upsert_moves_and_removes(spark, table):
    before = files(spark, table)
    new = spark.createDataFrame([(2, "moved", "a"), (4, "same place", "it's")], "id int, v string, part string")
    tables.upsert(new, table, ["id"], removed=spark.createDataFrame([(3,)], "id int"))
    after = files(spark, table)
    assert {f for f in before if f[0] is None} == {f for f in after if f[0] is None}
    assert content(spark, table) == [(0, "v0", "a"), (1, "v1", "a"), (2, "moved", "a"), (4, "same place", "it's"), (5, "v5", "None")]


def test_batches_with_quotes_and_nulls(spark, table):
    tables.drop_batch(spark, table, {"part": "it's"})
    assert [r[0] for r in content(spark, table)] == [0, 1, 2, 3, 5]
    assert tables.replace_batch(spark.createDataFrame([(7, "x")], "id int, v string"), table, {"part": "o'k"}) == 1


def test_stopped_overwrite_is_recovered(spark, layout):
    table = f"{layout.database('gold')}.whole"
    tables.overwrite_staged(spark.createDataFrame([(1, "x")], "id int, v string"), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old")
    assert not tables.table_exists(spark, table)
    tables.overwrite_staged(spark.createDataFrame([(2, "y")], "id int, v string"), table)
    assert not tables.table_exists(spark, f"{table}__old")
    tables.overwrite_staged(spark.table(table).withColumn("v", F.upper("v")), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [(2, "Y")]


def test_partitioned_overwrite(spark, table):
    tables.overwrite_staged(spark.table(table).filter("part = 'a'").withColumn("v", F.upper("v")), table, ["part"])
    assert content(spark, table) == [(0, "V0", "a"), (1, "V1", "a")]


def test_unique_ids(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (2, None), (3, "b")], "n int, t string").repartition(3)
    identity = F.to_json(F.struct("n", "t"))
    first, second = ({r.i for r in with_unique_id(rows, "i", identity).collect()} for _ in range(2))
    assert len(first) == 6 and first == second
