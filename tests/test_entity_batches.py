"""Merging batch by batch against one merge of all records, in several orders, with batches delivered again."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from tests.test_entity import COLUMNS, build, plain_merge
from tidemark.operators import entity as e
from tidemark.operators import survivorship as s
from tidemark.plans.entities import EntityStore

TIMES = "_source_system string, _source_batch_id string, _source_record_key string, _ref_ts timestamp"


def reference_of(spark, times):
    return spark.createDataFrame([(*k, t) for k, t in times.items()], TIMES)


def as_map(rows):
    return {r["NM"]: (r["TEL"], r["GRADE"], r["_source_system"], r["_source_batch_id"], r["_source_record_key"], r["_extra"]) for r in rows}


def test_states_merge_in_any_order(spark):
    rows, times = build(3)
    frame = e.with_reference_time(e.matchable(spark.createDataFrame(rows, COLUMNS), ["NM"]).drop("ID"), reference_of(spark, times))
    fill = ["TEL", "GRADE"]
    whole = s.survivors(s.merge_states(s.record_states(frame, ["NM"], fill), ["NM"]), ["NM"])
    want = sorted(map(str, whole.collect()))
    parts = [s.merge_states(s.record_states(frame.filter(F.abs(F.hash("_extra")) % 4 == i), ["NM"], fill), ["NM"]) for i in range(4)]
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        state = parts[order[0]]
        for i in order[1:]:
            state = s.merge_all([state, parts[i]], ["NM"])
        assert sorted(map(str, s.survivors(state, ["NM"]).collect())) == want


def test_a_value_keeps_its_own_time(spark):
    """An old number and a newer record without one, then a number from between: the one from between is newer."""
    names = "NM string, TEL string, _source_system string, _source_batch_id string, _source_record_key string, _ref_ts timestamp"
    first = spark.createDataFrame([("a", "1", "s", "b1", "r1", datetime(2019, 1, 1)), ("a", None, "s", "b1", "r2", datetime(2023, 1, 1))], names)
    later = spark.createDataFrame([("a", "2", "s", "b2", "r3", datetime(2021, 1, 1))], names)
    states = [s.merge_states(s.record_states(f, ["NM"], ["TEL"]), ["NM"]) for f in (first, later)]
    row = s.survivors(s.merge_all(states, ["NM"]), ["NM"]).first()
    assert (row["TEL"], row["_source_record_key"], row["_conflict"]) == ("2", "r2", False)


def store_of(spark, layout, name="PERSON"):
    return EntityStore(spark, layout, name, ["NM"], "ID", "P")


def check(spark, store, rows, times):
    """The stored tables say what one merge of these records says."""
    merged, unmatched = plain_merge(rows, times)
    got = spark.table(store.entities).collect()
    assert as_map(got) == merged and len(got) == len(merged)
    assert len({r["ID"] for r in got}) == len(got) and all(r["ID"] for r in got)
    ids = {r["NM"]: r["ID"] for r in got}
    lineage = sorted((r["_source_system"], r["_source_batch_id"], r["_source_record_key"], r["TARGET_PK"]) for r in spark.table(store.lineage).collect())
    assert lineage == sorted((*r[4:7], ids[r[1]]) for r in rows if r[1] in ids)
    assert sorted(r["_extra"] for r in spark.table(store.unmatched).collect()) == sorted(r[7] for r in unmatched)
    return ids


def test_batch_by_batch_is_all_at_once(spark, layout):
    rows, times = build(11)
    store, given, seen = store_of(spark, layout), {}, []
    for b in (2, 0, 1):
        batches = []
        for system in ("s0", "s1"):
            part = [r for r in rows if r[4] == system and r[5] == f"b{b}"]
            seen += part
            store.save(spark.createDataFrame(part, COLUMNS).repartition(3), system, f"b{b}")
            batches.append((system, f"b{b}"))
        store.merge(reference_of(spark, times), batches)
        ids = check(spark, store, seen, times)
        # Whoever has an id keeps it, also through a conflict.
        assert all(ids[n] == i for n, i in given.items() if n in ids)
        given.update(ids)


def test_a_batch_again_and_corrected(spark, layout):
    rows, times = build(12)
    rows = [r for r in rows if r[4] == "s0"]
    store = store_of(spark, layout)
    for b in range(3):
        store.save(spark.createDataFrame([r for r in rows if r[5] == f"b{b}"], COLUMNS), "s0", f"b{b}")
    store.merge(reference_of(spark, times), [("s0", f"b{b}") for b in range(3)])
    ids = check(spark, store, rows, times)
    store.merge(reference_of(spark, times), [("s0", "b1")])  # a retry changes nothing
    assert check(spark, store, rows, times) == ids
    random.seed(2)
    fewer = [r for r in rows if r[5] != "b1" or random.random() < 0.3]
    store.save(spark.createDataFrame([r for r in fewer if r[5] == "b1"], COLUMNS), "s0", "b1")
    store.merge(reference_of(spark, times), [("s0", "b1")])
    later = check(spark, store, fewer, times)
    assert all(later[n] == ids[n] for n in later if n in ids)
    gone = [r for r in rows if r[5] != "b1"]
    store.save(spark.createDataFrame([], COLUMNS), "s0", "b1")  # an empty delivery withdraws the batch
    store.merge(reference_of(spark, times), [("s0", "b1")])
    check(spark, store, gone, times)


def test_only_touched_entities_are_merged(spark, layout):
    """Of the entities, only those that the batch speaks of are merged again."""
    store = store_of(spark, layout)
    rows = [(None, n, "1", None, "s", "b0", f"r{n}", n) for n in "abc"]
    store.save(spark.createDataFrame(rows, COLUMNS), "s", "b0")
    store.merge(reference_of(spark, {}), [("s", "b0")])
    more = [(None, "b", "2", None, "s", "b1", "x", "later")]
    store.save(spark.createDataFrame(more, COLUMNS), "s", "b1")
    done = store.merge(reference_of(spark, {("s", "b1", "x"): datetime(2026, 1, 1)}), [("s", "b1")])
    assert done == {"merged_rows": 1, "touched_keys": 1}
    assert {r["NM"]: r["TEL"] for r in spark.table(store.entities).collect()} == {"a": "1", "b": "2", "c": "1"}
