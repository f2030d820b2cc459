"""Entity merge against a plain Python merge."""

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entity as e

COLUMNS = "ID string, NM string, TEL string, GRADE string, _source_system string, _source_batch_id string, _source_record_key string, _extra string"


def build(seed: int):
    random.seed(seed)
    rows, times = [], {}
    for i in range(400):
        name = random.choice(["hot", "hot", None, *[f"p{n}" for n in range(60)]])
        key = ("s" + str(i % 2), "b" + str(i % 3), f"r{i}")
        rows.append((None, name, random.choice([None, "1", "2"]), random.choice([None, None, "A"]), *key, f"x{i}"))
        if random.random() < 0.9:
            times[key] = datetime(2026, 1, random.randint(1, 28), random.choice([0, 0, 5]))
    return rows, times


def plain_merge(rows, times):
    groups, unmatched = defaultdict(list), []
    for r in rows:
        (groups[r[1]] if r[1] is not None else unmatched).append(r)
    merged = {}
    for name, members in groups.items():
        def order(r):
            t = times.get(r[4:7])
            return (t is not None, t or datetime.min, r[5], r[4], r[6])

        members = sorted(members, key=order, reverse=True)
        newest = times.get(members[0][4:7])
        top = [r for r in members if times.get(r[4:7]) == newest]
        if any(len({r[c] for r in top if r[c] is not None}) > 1 for c in (2, 3)):
            unmatched.extend(members)
            continue
        first = [next((r[c] for r in members if r[c] is not None), None) for c in (2, 3)]
        merged[name] = (*first, *members[0][4:])
    return merged, unmatched


@pytest.mark.parametrize("seed", [1, 2])
def test_merge(spark, seed):
    rows, times = build(seed)
    frame = spark.createDataFrame(rows, COLUMNS).repartition(6)
    reference = spark.createDataFrame([(*k, t) for k, t in times.items()], "_source_system string, _source_batch_id string, _source_record_key string, _ref_ts timestamp")
    result = e.merge_entities(frame, reference, ["NM"], "ID", "P", "PERSON")
    merged, unmatched = plain_merge(rows, times)
    got = result.merged.collect()
    assert {r["NM"]: (r["TEL"], r["GRADE"], r["_source_system"], r["_source_batch_id"], r["_source_record_key"], r["_extra"]) for r in got} == merged
    assert len(got) == len(merged)
    assert sorted(r["_extra"] for r in result.unmatched.collect()) == sorted(r[7] for r in unmatched)
    in_order = sorted(got, key=lambda r: (r["_source_batch_id"], r["_source_record_key"]))
    assert [r["ID"] for r in in_order] == [f"P-{i:06d}" for i in range(1, len(got) + 1)]
    # Every record of a merged group is in the lineage exactly once, with the id of its group.
    ids = {r["NM"]: r["ID"] for r in got}
    lineage = {r["_source_record_key"]: r["TARGET_PK"] for r in result.lineage.collect()}
    assert lineage == {r[6]: ids[r[1]] for r in rows if r[1] in ids}


def test_all_times_missing(spark):
    rows = [(None, "a", None, "A", "s", "b", "1", ""), (None, "a", "7", "A", "s", "b", "2", ""), (None, "b", "1", None, "s", "b", "3", ""), (None, "b", "2", None, "s", "b", "4", "")]
    frame = spark.createDataFrame(rows, COLUMNS)
    reference = spark.createDataFrame([], "_source_system string, _source_batch_id string, _source_record_key string, _ref_ts timestamp")
    result = e.merge_entities(frame, reference, ["NM"], "ID", "P", "PERSON")
    assert [(r["NM"], r["TEL"], r["GRADE"]) for r in result.merged.collect()] == [("a", "7", "A")]
    assert sorted(r["_source_record_key"] for r in result.unmatched.collect()) == ["3", "4"]


def test_ids_survive_a_reset(spark):
    """New groups, a lost id column: known records keep their id, others continue."""
    rows = [(None, n, None, None, "s", "b", k, "") for n, k in (("a", "5"), ("b", "4"))]
    frame = spark.createDataFrame(rows, COLUMNS)
    reference = spark.createDataFrame([], "_source_system string, _source_batch_id string, _source_record_key string, _ref_ts timestamp")
    first = e.merge_entities(frame, reference, ["NM"], "ID", "P", "PERSON")
    assert {r["NM"]: r["ID"] for r in first.merged.collect()} == {"b": "P-000001", "a": "P-000002"}
    more = frame.unionByName(spark.createDataFrame([(None, "c", None, None, "s", "b", "1", "")], COLUMNS))
    again = e.merge_entities(more, reference, ["NM"], "ID", "P", "PERSON", first.lineage)
    assert {r["NM"]: r["ID"] for r in again.merged.collect()} == {"b": "P-000001", "a": "P-000002", "c": "P-000003"}


def test_master_reload(spark):
    def master(codes):
        return spark.createDataFrame([(None, c, c.lower()) for c in codes], "PRD_ID string, PRD_CD string, PRD_NM string")

    first = e.load_master(master("BAC"), None, "PRD_CD", "PRD_ID", "PRD")
    assert {r["PRD_CD"]: r["PRD_ID"] for r in first.collect()} == {"A": "PRD-000001", "B": "PRD-000002", "C": "PRD-000003"}
    second = e.load_master(master("CDA0"), first, "PRD_CD", "PRD_ID", "PRD")
    assert {r["PRD_CD"]: r["PRD_ID"] for r in second.collect()} == {"A": "PRD-000001", "C": "PRD-000003", "0": "PRD-000004", "D": "PRD-000005"}
    assert second.filter(F.col("PRD_CD") == "B").isEmpty()


def test_lineage_is_carried_over(spark):
    """Records of an earlier merge keep an entry, under the id that their entity has now."""
    names = "_source_system string, _source_batch_id string, _source_record_key string, TARGET_ENTITY string, TARGET_PK string"
    earlier = [("s", "b1", "r1", "C", "C-1"), ("s", "b1", "r2", "C", "C-1"), ("s", "b1", "r4", "C", "C-2"), ("s", None, "r5", "C", "C-2")]
    current = [("s", "b1", "r2", "C", "C-7"), ("s", "b2", "r3", "C", "C-7")]
    frames = [spark.createDataFrame(rows, names) for rows in (earlier, current)]
    got = sorted((r._source_record_key, r.TARGET_PK) for r in e.carried_lineage(*frames).collect())
    assert got == [("r1", "C-7"), ("r2", "C-7"), ("r3", "C-7"), ("r4", "C-2"), ("r5", "C-2")]
