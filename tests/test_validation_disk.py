"""Validation of large tables: rows travel once and are written once, and what is found on the way is right."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tidemark.operators import keys as k
from tidemark.operators import validation as v
from tidemark.sources import zones
from workload import validation as wv
from workload.views import view


@pytest.fixture
def no_broadcasts(spark):
    """Joins as they are when no key set is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def random_rows(spark, seed: int):
    rng = random.Random(seed)
    names = [None, "", " ", "A", "B", "C", "A-DUP2", "A-DUP2-DUP2", "B-DUP3", "-DUP2", "D-DUPx", "E\n", "E-DUP2\n", "F1", "F"]
    rows = [(rng.choice(names), rng.choice(["p", "p", "o", None]), f"{rng.randrange(40):02d}") for _ in range(120)]
    rows += [(f"only{i}", "p", "00") for i in range(60)] + [("only1-DUP2", "o", "00"), ("only2", "p", "01"), ("only2-DUP2", "o", "02")]
    return spark.createDataFrame(rows, "id string, _source_system string, _source_record_key string").repartition(4)


@pytest.mark.parametrize("suffix", ["-DUP", "1", ""])
@pytest.mark.parametrize("group_rows, full", [(1000, k.FULL), (3, k.FULL), (1000, -1)])
def test_repair_tells_which_keys_are_still_repeated(spark, monkeypatch, suffix, group_rows, full):
    monkeypatch.setattr(v, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(k, "FULL", full)
    monkeypatch.setattr(v, "TASK_ROWS", 5 if full == -1 else v.TASK_ROWS)
    rows = random_rows(spark, 7)
    got = [r.asDict() for r in v.repair_primary_keys(rows, v.PrimaryKeyRepair("id", "p", suffix=suffix), "again").collect()]
    want = Counter(r["id"] for r in got)
    assert [r["again"] for r in got] == [bool(r["id"] and r["id"].strip(" ")) and want[r["id"]] > 1 for r in got]
    groups = {}
    for r in got:
        was = r["id"] if r["_remediated_id"] is None else r["_remediated_id"]
        groups.setdefault(was, []).append(r)
    assert Counter(map(lambda r: r.id, rows.collect())) == {key: len(g) for key, g in groups.items()}
    for key, group in groups.items():
        if key is None or not key.strip(" "):
            assert all(r["id"] == key for r in group)
            continue
        ranked = sorted(group, key=lambda r: (r["_source_system"] == "p", r["_source_record_key"]))
        later = {n for n, r in enumerate(ranked, 1) if n > 1 and r["_source_system"] == "p"}
        assert sorted(r["id"] for r in group if r["_remediated_id"]) == sorted(f"{key}{suffix}{n}" for n in later)


def test_checked_rows_that_all_repeat_are_not_joined_with_their_keys(spark, sf_dir, no_broadcasts, monkeypatch):
    plans, write = [], v.materialize
    monkeypatch.setattr(v, "materialize", lambda df: (plans.append(plan_of(df)), write(df))[1])
    rows = view(spark, sf_dir, "counsel")
    checked = v.validate(rows.unionAll(rows), "COUNSEL", wv.MODEL, {}, wv.ORDER, wv.REPAIR)
    assert "SortMergeJoin" not in plan_of(checked.frame) and not any("SortMergeJoin" in p for p in plans)
    assert checked.frame.count() == 2 * rows.count()


def test_rows_with_a_key_of_their_own_are_not_searched_for_equal_ones(spark, sf_dir, monkeypatch):
    searched, plain = [], k._copies
    monkeypatch.setattr(k, "_copies", lambda df: (searched.append(df.count()), plain(df))[1])
    monkeypatch.setattr(k, "FULL", -1)  # as if too many hashes were repeated
    rows = view(spark, sf_dir, "counsel")
    checked = v.validate(rows.unionAll(rows), "COUNSEL", wv.MODEL, {}, wv.ORDER, wv.REPAIR)
    unique = v.unique_rule(checked.rules, "CNSL_ID")
    trace = v.migration_trace(checked.frame, "COUNSEL", "CNSL_ID", "run", stored=True, unique=unique)
    ids = [r[0] for r in trace.select("TRC_ID").collect()]
    assert len(set(ids)) == len(ids) == 2 * rows.count()
    breaking = checked.frame.filter(F.array_contains("_violations", unique) | F.expr("coalesce(trim(CNSL_ID), '') = ''")).count()
    assert searched == [breaking] and 0 < breaking < len(ids) / 2


def test_different_values_are_counted_exactly(spark):
    rows = spark.range(0, 900, numPartitions=5).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") < 300, F.col("id") % 7).otherwise(F.col("id")).cast("string").alias("t")
    )
    for some in (rows, rows.filter("id >= 300"), rows.limit(0)):
        want = some.agg(F.count(F.lit(1)), F.count_distinct("t")).first()
        assert k.rows_and_values(some, "t", "n", "d").collect() == [want]
    plan = []
    write = k.materialize
    k.materialize, found = (lambda df: (plan.append(1), write(df))[1]), None
    try:
        found = k.rows_and_values(spark.range(500).selectExpr("sha2(string(id), 256) t"), "t", "n", "d").first()
    finally:
        k.materialize = write
    assert tuple(found) == (500, 500) and not plan  # nothing is compared as it is

def test_first_rows_of_a_zoned_table_are_not_copied(spark, layout, monkeypatch):
    written, write = [], zones.materialize
    monkeypatch.setattr(zones, "materialize", lambda df: (written.append(df.columns), write(df))[1])
    rows = write(spark.range(300).select(F.format_string("K-%06d", "id").alias("k"), F.lit("old").alias("v")))
    table = layout.table("gold", "fresh")
    assert zones.upsert(rows, table, ["k"], rows.limit(1).select(F.lit("gone").alias("k")), 50, stored=True) == {"touched_zones": 1, "zones": 6}
    assert not written and spark.table(table).count() == 300
    later = write(spark.range(290, 310).select(F.format_string("K-%06d", "id").alias("k"), F.lit("new").alias("v")))
    zones.upsert(later, table, ["k"], zone_rows=50, stored=True)
    assert spark.table(table).filter("v = 'new'").count() == 20 and spark.table(table).count() == 310
