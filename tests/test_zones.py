"""Upserts by key range: only overlapping zones are rewritten, zones split and fall together, keys of any kind."""

import random

from pyspark.sql import functions as F

from tidemark.sources import zones


def content(spark, table, keys):
    return {tuple(r[k] for k in keys): r["v"] for r in spark.table(table).collect()}


def files_of(spark, table):
    found = {}
    for r in spark.table(table).select(zones.ZONE, F.input_file_name().alias("f")).distinct().collect():
        found.setdefault(r[0], set()).add(r["f"])
    return found


def test_neighbouring_keys_touch_few_zones(spark, layout):
    table = layout.table("gold", "t")
    rows = spark.range(1000).select(F.format_string("K-%06d", "id").alias("k"), F.lit("old").alias("v"))
    first = zones.upsert(rows, table, ["k"], zone_rows=50)
    assert first == {"touched_zones": 1, "zones": 20}
    before = files_of(spark, table)
    batch = spark.range(495, 560).select(F.format_string("K-%06d", "id").alias("k"), F.lit("new").alias("v"))
    done = zones.upsert(batch, table, ["k"], zone_rows=50)
    after = files_of(spark, table)
    assert done == {"touched_zones": 3, "zones": 20}
    assert sum(before[z] != after[z] for z in before) == 3  # all other files are the same
    assert content(spark, table, ["k"]) == {(f"K-{i:06d}",): "new" if 495 <= i < 560 else "old" for i in range(1000)}
    # New keys at the end fill the last zone until it splits; removed ones empty a zone, which falls to its neighbour.
    more = spark.range(1000, 1120).select(F.format_string("K-%06d", "id").alias("k"), F.lit("more").alias("v"))
    gone = spark.range(100, 150).select(F.format_string("K-%06d", "id").alias("k"))
    assert zones.upsert(more, table, ["k"], gone, zone_rows=50) == {"touched_zones": 2, "zones": 22}
    between = spark.createDataFrame([("K-000120", "back")], "k string, v string")
    assert zones.upsert(between, table, ["k"], zone_rows=50)["touched_zones"] == 1
    want = {(f"K-{i:06d}",): "new" if 495 <= i < 560 else "old" if i < 1000 else "more" for i in range(1120) if not 100 <= i < 150}
    assert content(spark, table, ["k"]) == {**want, ("K-000120",): "back"}


def test_any_keys_against_a_dictionary(spark, layout):
    table, rng, want = layout.table("gold", "u"), random.Random(4), {}
    words = [None, "", "a/b=c", "x y", "é%41", '"q"', "{", "\\", "z"]
    for _ in range(4):
        batch = {(rng.choice(words), rng.choice([None, *range(-5, 30)])): str(rng.random()) for _ in range(40)}
        gone = [k for k in want if rng.random() < 0.2]
        want = {**{k: v for k, v in want.items() if k not in gone}, **batch}
        frame = spark.createDataFrame([(*k, v) for k, v in batch.items()], "a string, n int, v string").repartition(3)
        zones.upsert(frame, table, ["a", "n"], spark.createDataFrame(gone, "a string, n int"), zone_rows=10)
        assert content(spark, table, ["a", "n"]) == want
    assert len(zones.zone_names(spark, table)) > 4
    nothing = spark.createDataFrame([], "a string, n int, v string")
    assert zones.upsert(nothing, table, ["a", "n"])["touched_zones"] == 0 and content(spark, table, ["a", "n"]) == want


def test_the_number_of_zones_does_not_grow_with_the_table(spark, layout, monkeypatch):
    monkeypatch.setattr(zones, "ZONES", 10)
    table = layout.table("gold", "bounded")
    rows = spark.range(2000).select(F.format_string("K-%06d", "id").alias("k"), F.lit("old").alias("v"))
    assert zones.upsert(rows, table, ["k"], zone_rows=20)["zones"] == 10
    more = spark.range(1900, 4000).select(F.format_string("K-%06d", "id").alias("k"), F.lit("new").alias("v"))
    assert zones.upsert(more, table, ["k"], zone_rows=20)["zones"] < 20
    assert content(spark, table, ["k"]) == {(f"K-{i:06d}",): "old" if i < 1900 else "new" for i in range(4000)}
