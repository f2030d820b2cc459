"""What a quality run stores and moves: rules are evaluated once, details are stored once, and batches stay in place."""

from pyspark.sql import functions as F

from tidemark.operators import keys as k
from tidemark.operators import quality as q
from tidemark.plans import quality as quality_run
from tidemark.sources import tables
from workload import quality as wq
from workload.views import view


def test_details_are_stored_once_without_a_shuffle(spark, layout, sf_dir, monkeypatch):
    tables.append_batch(view(spark, sf_dir, "inbound"), layout.table("bronze", "inbound"), {"ingest_date": "2026-09-15"})
    staged, plans = [], []
    materialize, rebalance = k.materialize, tables.clustered
    monkeypatch.setattr(k, "materialize", lambda df: staged.append(df.columns) or materialize(df))
    monkeypatch.setattr(tables, "clustered", lambda df, parts: plans.append(df.columns) or rebalance(df, parts))
    quality_run.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, wq.code_tables(spark))
    assert staged and all("before_value" not in columns for columns in staged)
    assert all("dq_detail_id" not in columns for columns in plans)
    detail = spark.table(layout.table("meta", "dq_cleansing_detail"))
    assert detail.count() == detail.select("dq_detail_id").distinct().count() > 0
    assert [r[0] for r in detail.select("source_batch_id").distinct().collect()] == ["2026-09-15"]


def test_ids_of_unfolded_rows_are_those_of_stored_details(spark, monkeypatch):
    entries = F.array(*[F.struct(F.lit(n).alias("rule_id")) for n in ("a", "b")])
    text = F.when(F.col("id") < 3, F.lit("same")).otherwise(F.col("id").cast("string"))
    rows = k.materialize(spark.range(9).select(text.alias("__row"), entries.alias("found")))
    identity = F.concat_ws("#", "rule_id", "__row")

    def unfold(df):
        return df.select("__row", F.explode("found").alias("v")).select("v.rule_id", "__row")

    want = sorted(map(tuple, k.with_unique_id(unfold(rows), "i", identity).collect()))
    assert sorted(map(tuple, k.unfolded_with_unique_id(rows, "__row", unfold, "i", identity).collect())) == want
    assert len({r[2] for r in want}) == 18
    monkeypatch.setattr(k, "SENT_HASHES", 0)
    assert sorted(map(tuple, k.unfolded_with_unique_id(rows, "__row", unfold, "i", identity).collect())) == want


def test_queries_evaluate_each_source_once(spark, sf_dir, monkeypatch):
    evaluated, outcomes = [], q.with_outcomes
    monkeypatch.setattr(q, "with_outcomes", lambda *args, **named: evaluated.append(1) or outcomes(*args, **named))
    for name, sources in (("dq_run_summary", 2), ("dq_detail_ids", 1), ("dq_violation_detail", 1)):
        evaluated.clear()
        wq.QUERIES[name](spark, sf_dir).collect()
        assert len(evaluated) == sources, name


def test_an_appended_batch_stays_in_place(spark, layout):
    table, batch = layout.table("bronze", "t"), {"day": "it's"}
    for number in range(2):
        tables.append_batch(spark.range(0, 8, 1, 4).withColumn(f"c{number}", F.lit("x")), table, batch)
    stored = spark.table(table)
    assert stored.columns == ["id", "c0", "c1", "day"] and stored.filter("day = 'it\\'s'").count() == 16
    assert len(stored.inputFiles()) == 8  # a file per task: four tasks, twice


def test_rows_written_by_route_are_not_sorted(spark, layout):
    rows = spark.range(0, 1000, 1, 1).select("id", (F.col("id") % 2).cast("string").alias("r"))
    folder = tables.parts_folder(spark, layout.table("bronze", "t"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    tables.write_by_route(rows, "r", folder)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    plans = spark._jsparkSession.sharedState().statusStore().executionsList()
    assert "Sort " not in plans.apply(plans.size() - 1).physicalPlanDescription()
    assert spark.read.parquet(folder).count() == 1000
