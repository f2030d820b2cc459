"""One evaluation of the rules and of the mapping per run: same results as the separate steps, and a single write."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.operators import quality as q
from tidemark.operators.rules import Rule
from tidemark.plans import quality as quality_run
from tidemark.sources import tables
from workload import quality as wq
from workload.views import view

# Two cleansing rules on one column, rules that are judged on a column another rule cleanses, and repeated keys of such a column.
MORE_RULES = [
    *wq.INBOUND_RULES,
    Rule("DQ-X-1", "PATTERN_CHECK", ("phone_number",), "HIGH", 0.1, "inbound", pattern=r"^\S+$", cleansing_steps=("CLN-COM-001",)),
    Rule("DQ-X-2", "NULL_CHECK", ("status",), "CRITICAL", 0.0, "inbound"),
    Rule("DQ-X-3", "DUPLICATE_CHECK", ("phone_number", "started_at"), "REVIEW", 0.0, "inbound"),
]


@pytest.mark.parametrize("rules", [wq.INBOUND_RULES, MORE_RULES], ids=["one rule a column", "several"])
def test_evaluation_agrees_with_the_separate_steps(spark, sf_dir, rules):
    rows, codes = view(spark, sf_dir, "inbound"), wq.code_tables(spark)
    lineage = {"_source_record_key": F.col("consultation_id")}
    repeated = q.repeated_keys(rows, rules)
    evaluated = q.evaluate(rows, rules, codes, "consultation_id", lineage, repeated)
    observed = evaluated.agg(*q.observed_counts(len(rules))).first().asDict()
    counts = q.counts_from(spark, observed, rules, repeated)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, q.rule_counts(rows, rules, codes).select(*counts.columns).collect()))
    found = q.unfold_violations(evaluated, "__found", ["__row"])
    assert sorted(map(str, found.collect())) == sorted(map(str, q.violations(rows, rules, codes, "consultation_id", "__row").collect()))
    isolate = rules[::2]
    columns = [*rows.columns, *lineage, "_cleansed_yn", "_dq_status", "_unresolved_rule_ids"]
    routed = q.routed_by(evaluated, [r.rule_id for r in isolate]).select(*columns)
    plain = q.route_records(rows, [r for r in rules if r.cleansing_steps], isolate, codes, lineage).select(*columns)
    assert sorted(map(str, routed.collect())) == sorted(map(str, plain.collect()))


def test_a_run_evaluates_once(spark, layout, sf_dir, monkeypatch):
    table = layout.table("bronze", "inbound")
    tables.replace_batches(view(spark, sf_dir, "inbound"), table, ["ingest_date"])
    plans = []
    evaluate = q.evaluate

    def watched(*args):
        frame = evaluate(*args)
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return frame

    def refused(*_args, **_named):
        raise AssertionError("a second evaluation")

    monkeypatch.setattr(q, "evaluate", watched)
    for step in ("rule_counts", "violations", "route_records"):
        monkeypatch.setattr(q, step, refused)
    done = quality_run.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, wq.code_tables(spark))
    assert len(plans) == 1 and plans[0].count(f"Relation spark_catalog.{table}") == 1  # the table is scanned once for all outcomes
    stored = spark.table(layout.table("silver_candidate", "inbound"))
    batch = view(spark, sf_dir, "inbound").filter(F.col("ingest_date") == done["source_batch_id"]).count()
    assert stored.count() == done["candidate_row_count"] and batch == done["candidate_row_count"] + done["quarantine_row_count"]
    assert {r[0] for r in stored.select("_dq_status").distinct().collect()} == {"CLEAN", "CLEANSED"}


def test_a_run_without_any_finding_or_rows(spark, layout):
    table = layout.table("bronze", "inbound")
    rule = Rule("R1", "NULL_CHECK", ("consultation_id",), "CRITICAL", 0.0, "inbound")
    rows = spark.createDataFrame([("a", "d1"), ("b", "d1"), (None, "d2")], "consultation_id string, ingest_date string")
    tables.replace_batches(rows, table, ["ingest_date"])
    codes = q.CodeTables(spark.createDataFrame([], "CODE_GROUP string, CODE string"))
    for batch, kept, held in (("d1", 2, 0), ("d2", 0, 1), ("d0", 0, 0), ("d1", 2, 0)):
        done = quality_run.run_quality(spark, layout, "inbound", [rule], codes, batch)
        assert (done["candidate_row_count"], done["quarantine_row_count"]) == (kept, held)
    assert sorted(r["consultation_id"] for r in spark.table(layout.table("silver_candidate", "inbound")).collect()) == ["a", "b"]
    assert spark.table(layout.table("dq_quarantine", "inbound")).count() == 1


def test_split_write(spark, layout):
    a, b = layout.table("gold_candidate", "T"), layout.table("gold_mapping_error", "T")
    # Each row draws its side anew whenever it is computed, so a second evaluation would lose rows or repeat them.
    drawn = spark.range(0, 4000, 1, 4).select(F.col("id"), (F.rand() < 0.3).alias("bad"), F.lit("x").alias("n"))
    route = F.when(F.col("bad"), "error").otherwise("clean")
    batch = {"src": "s", "day": None}
    for _ in range(2):
        counts = tables.split_write(drawn, route, {"clean": (a, ["id", "n"]), "error": (b, ["id", "bad", "n"])}, batch)
        kept, held = spark.table(a), spark.table(b)
        assert kept.columns == ["id", "n", "src", "day"] and held.columns == ["id", "bad", "n", "src", "day"]
        ids = [r.id for r in kept.collect()] + [r.id for r in held.collect()]
        assert sorted(ids) == list(range(4000)) and counts == {"clean": kept.count(), "error": held.count()}
        assert held.filter("NOT bad OR src <> 's' OR day IS NOT NULL").count() == 0
    folder = layout.table("gold_candidate", "T").split(".")[0]
    root = spark.catalog.getDatabase(folder).locationUri.removeprefix("file:")
    old = [d for d in os.listdir(f"{root}/_parts") if os.path.exists(f"{root}/_parts/{d}/_route=clean")]
    assert len(old) == 1  # the files of the first save are gone
    other = {"src": "t", "day": "1"}
    few = spark.range(3).select("id", F.lit(False).alias("bad"), F.lit("y").alias("n"))
    assert tables.split_write(few, route, {"clean": (a, ["id", "n"]), "error": (b, ["id", "bad", "n"])}, other) == {"clean": 3, "error": 0}
    # Taken-in partitions are partitions like others: they are replaced, upserted, dropped and emptied.
    tables.upsert(few.select("id", F.lit("z").alias("n"), F.lit("t").alias("src"), F.lit("1").alias("day")).filter("id = 1"), a, ["id", "src"])
    assert {r.n for r in spark.table(a).filter("src = 't'").collect()} == {"y", "z"} and spark.table(a).filter("src = 't'").count() == 3
    tables.split_write(few.limit(0), route, {"clean": (a, ["id", "n"]), "error": (b, ["id", "bad", "n"])}, other)
    assert spark.table(a).filter("src = 't'").count() == 0
    tables.overwrite_staged(spark.table(a).filter("id < 10"), a, ["src", "day"])
    assert spark.table(a).count() == spark.table(a).filter("id < 10").count() > 0
