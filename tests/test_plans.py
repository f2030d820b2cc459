"""Shapes of plans that must hold at any scale."""

import re

import pytest
from pyspark.sql import functions as F

from workload import registry
from tidemark.operators import keys as k
from workload import entities, quality, validation
from workload.views import view

# Queries that write to scratch while they are built are covered by the others they are made of.
BUILT_LAZILY = [n for n in sorted(registry.QUERIES) if not n.startswith(("src_", "sink_", "latest_"))]


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


# These number rows inside groups; the window there runs over the counts per partition only.
NUMBERING = ("dq_detail_ids", "ent_", "master_", "val_pk_dedup", "val_split", "val_by_rule", "val_missing_parent", "val_reconcile", "val_trace")


@pytest.mark.parametrize("name", BUILT_LAZILY)
def test_no_pairwise_joins_no_python_no_window_over_groups(spark, sf_dir, name):
    """Groups are aggregated, not gathered. The only window over rows is the top-5 ranking, limited before its shuffle."""
    plan = plan_of(registry.QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in plan, word
    if name == "dq_samples_masked":
        assert "WindowGroupLimit" in plan
    elif not name.startswith(NUMBERING):
        assert not re.search(r"\bWindow\b", plan)


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(registry.QUERIES["dq_duplicate"](spark, sf_dir))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"l_orderkey:bigint,l_linenumber:int"}


def test_filter_reaches_the_scan(spark, sf_dir):
    rows = view(spark, sf_dir, "product").filter("PRODUCT_CLASS = 'Brand#1'")
    assert "EqualTo(p_brand,Brand#1)" in plan_of(rows)


def test_latest_batch_prunes_partitions(spark, sf_dir, layout):
    from tidemark.sources import files, tables

    table = layout.table("bronze", "inbound")
    tables.replace_batches(view(spark, sf_dir, "inbound"), table, ["ingest_date"])
    latest = files.latest_batch(spark.table(table)).select("consultation_id")
    assert re.search(r"PartitionFilters: \[.*ingest_date.* = Subquery", plan_of(latest))


def test_all_row_rules_share_one_aggregate(spark, sf_dir):
    rules = [r for r in quality.INBOUND_RULES if r.rule_type != "DUPLICATE_CHECK"]
    plan = plan_of(quality.q.rule_counts(view(spark, sf_dir, "inbound"), rules, quality.code_tables(spark)))
    assert plan.count("orders.parquet") == 1


def test_hot_key_is_split(spark):
    """A key with a third of all rows: the join with the key set splits its rows over several tasks."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "96k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        number = F.col("id")
        rows = spark.range(0, 90000, numPartitions=16).select(
            F.when(number % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (number % 40000).cast("string"))).alias("key"),
            F.sha2(number.cast("string"), 256).alias("payload"),
        )
        flagged = k.flag_duplicates(rows, ["key"], "d")
        flagged.write.format("noop").mode("overwrite").save()
        collected = flagged.groupBy("d").count()
        done = {r["d"]: r["count"] for r in collected.collect()}
        assert sum(done.values()) == 90000
        flagged_rows = flagged.select("key", "payload", "d")
        flagged_rows.collect()
        final = flagged_rows._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_merge_is_aggregates_only(spark, sf_dir):
    plan = plan_of(entities.groups(spark, sf_dir))
    assert not re.search(r"\bWindow\b", plan) and "partial_max" in plan


def test_foreign_key_is_a_join(spark, sf_dir):
    plan = plan_of(validation.rule_rows("FK")(spark, sf_dir))
    assert "LeftOuter" in plan


def test_no_long_text_is_shuffled(spark, sf_dir):
    """Text columns are profiled by hash and length: the text itself ends before the exchange."""
    from workload.profiling import SPECS, counts

    name = next(n for n, spec in SPECS.items() if spec.columns_with("TEXT"))
    frame = counts(spark, sf_dir, name)
    texts = SPECS[name].columns_with("TEXT")
    longest = frame.filter(F.col("column_name").isin(*texts) & (F.trim("value") != "")).agg(F.max(F.length("value"))).first()[0]
    assert longest == 64
