"""Key operators against brute force, with one key owning a large share of the rows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keys as k
from tidemark.operators import validation as v
from tidemark.operators.entity import assign_ids


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; a third share one key, some keys are NULL or blank, and there are full copies."""
    random.seed(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else "" if i % 50 == 2 else f"k{random.randint(0, 900)}")
        rows.append((key, random.randint(0, 40), i % 7))
    return spark.createDataFrame(rows, "key string, n int, m int").repartition(8).cache(), rows


def test_flag_duplicates(skewed):
    frame, rows = skewed
    counts = Counter(r[0] for r in rows)
    got = Counter((r["key"], r["n"], r["m"], r["d"]) for r in k.flag_duplicates(frame, ["key"], "d").collect())
    assert got == Counter((*r, counts[r[0]] > 1) for r in rows)
    filled = Counter((r["key"], r["d"]) for r in k.flag_duplicates(frame, ["key"], "d", filled_only=True).collect())
    assert filled == Counter((r[0], bool(r[0]) and counts[r[0]] > 1) for r in rows)


def test_flag_duplicates_two_keys(skewed):
    frame, rows = skewed
    counts = Counter((r[0], r[1]) for r in rows)
    got = Counter((r["key"], r["n"], r["d"]) for r in k.flag_duplicates(frame, ["key", "n"], "d").collect())
    assert got == Counter((r[0], r[1], counts[r[0], r[1]] > 1) for r in rows)


def test_flag_members(spark, skewed):
    frame, rows = skewed
    members = spark.createDataFrame([("hot",), ("k1",), ("k1",), (None,)], "v string")
    got = Counter((r["key"], r["f"]) for r in k.flag_members(frame, F.col("key"), members, "f").collect())
    assert got == Counter((r[0], r[0] in ("hot", "k1")) for r in rows)


def test_semi_and_anti_are_complements(skewed):
    frame, rows = skewed
    chosen = frame.filter("key = 'hot' OR key IS NULL").select("key").distinct()
    inside, outside = k.rows_with_keys(frame, ["key"], chosen), k.rows_with_keys(frame, ["key"], chosen, "left_anti")
    assert inside.count() == sum(r[0] in ("hot", None) for r in rows)
    assert inside.count() + outside.count() == len(rows)


def test_number_rows(skewed):
    frame, rows = skewed
    got = sorted(((r["num"], r["n"], r["m"]) for r in k.number_rows(frame, ["n", "m"], name="num").collect()))
    assert [g[0] for g in got] == list(range(1, len(rows) + 1))
    assert [g[1:] for g in got] == sorted((r[1], r[2]) for r in rows)


def test_number_rows_in_groups(skewed):
    """The hot group spans partitions, and its numbers still run without gaps."""
    frame, rows = skewed
    got = defaultdict(list)
    for r in k.number_rows(frame, ["n", "m"], ["key"], "num").collect():
        got[r["key"]].append((r["num"], r["n"], r["m"]))
    want = defaultdict(list)
    for key, n, m in rows:
        want[key].append((n, m))
    assert set(got) == set(want)
    for key, items in got.items():
        items.sort()
        assert [i[0] for i in items] == list(range(1, len(items) + 1))
        assert [i[1:] for i in items] == sorted(want[key])


def test_number_rows_spreads_copies(spark):
    """Rows that are all equal are numbered in several partitions."""
    copies = spark.range(0, 4000, numPartitions=8).select(F.lit("same").alias("a"))
    numbered = k.number_rows(copies, ["a"], name="num")
    assert sorted(r["num"] for r in numbered.collect()) == list(range(1, 4001))


def test_assign_ids(spark):
    rows = spark.createDataFrame([("X-000007", "c"), (None, "b"), ("other", "d"), (None, "a")], "id string, k string")
    got = {r["k"]: r["id"] for r in assign_ids(rows, "id", "X", ["k"]).collect()}
    assert got == {"c": "X-000007", "d": "other", "a": "X-000008", "b": "X-000009"}
    wide = spark.createDataFrame([("X-999999", "a"), (None, "b")], "id string, k string")
    assert {r["id"] for r in assign_ids(wide, "id", "X", ["k"]).collect()} == {"X-999999", "X-1000000"}


def test_primary_key_repair(spark):
    rows = [("A", "outbound", "2"), ("A", "outbound", "1"), ("B", "outbound", "1"), ("B", "inbound", "9"), ("C", "inbound", "1"),
            ("C", "inbound", "2"), (None, "outbound", "1"), (None, "outbound", "2"), ("D", "outbound", "5")]
    frame = spark.createDataFrame(rows, "id string, _source_system string, _source_record_key string")
    got = v.repair_primary_keys(frame, v.PrimaryKeyRepair("id", "outbound")).collect()
    found = Counter((r["id"], r["_source_system"], r["_source_record_key"], r["_remediated_id"]) for r in got)
    assert found == Counter(
        [("A", "outbound", "1", None), ("A-DUP2", "outbound", "2", "A"), ("B", "inbound", "9", None), ("B-DUP2", "outbound", "1", "B"),
         ("C", "inbound", "1", None), ("C", "inbound", "2", None), (None, "outbound", "1", None), (None, "outbound", "2", None),
         ("D", "outbound", "5", None)]
    )
