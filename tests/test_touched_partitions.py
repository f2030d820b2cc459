"""The list of touched partitions meets the rows of a table without an exchange of these rows."""

from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tidemark.sources import tables


def test_rows_of_a_large_partition_stay_in_place(spark, layout, monkeypatch):
    table = f"{layout.database('gold')}.one_part"
    rows = spark.range(0, 20000, numPartitions=4).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("part"))
    tables.append(rows, table, ["part"])
    plans, write = [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df: (plans.append(plan_of(df)), write(df))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        within = spark.table(table).filter("id < 10").select("part")
        tables.replace_where(rows.filter("id < 10").withColumn("v", F.lit("new")), table, F.col("id") < 10, within)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before) if before else spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plans[-1] and "BroadcastHashJoin" in plans[-1]
    assert spark.table(table).filter("v = 'new'").count() == 10 and spark.table(table).count() == 20000
