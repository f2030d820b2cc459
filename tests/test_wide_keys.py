"""Part numbers of more than six digits."""

from pyspark.sql import functions as F

from workload import versions


def test_faulty_rules_of_wide_part_numbers(spark, tmp_path):
    """Every part has a rule of its own, also where its product code is cut."""
    parts = spark.range(999_990, 1_000_030).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type")
    )
    parts.write.parquet(f"{tmp_path}/part.parquet")
    got = {r.problem: r.rows for r in versions.rule_problems(spark, str(tmp_path)).collect()}
    assert got.pop("rule_id is empty") == 4 and "rule_id is repeated" not in got
    assert set(got.values()) == {4} and len(got) == 11
