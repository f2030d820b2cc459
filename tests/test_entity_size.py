"""Records are joined together once, exchanged once for merging, and have the time that the plain way gives."""

import random
import re

from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tidemark.operators import entity as e
from tidemark.operators import survivorship as s
from tidemark.session import materialize
from workload import entities

COLUMNS = "NM string, TEL string, GRADE string, _source_system string, _source_batch_id string, _source_record_key string, day string"


def random_records(spark, seed: int):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    rows = [
        (pick("a", "b", "c", "d"), pick(None, "", "1", "2"), pick(None, "x", "y"), pick("p", None), pick("1", "2"), pick(None, *map(str, range(60))), pick(None, "1960-01-01", "2020-01-01", "2020-01-02"))
        for _ in range(150)
    ]
    return materialize(spark.createDataFrame(rows, COLUMNS))


def bag(df):
    return sorted(map(str, df.collect()))


def test_own_reference_time_is_the_latest_of_the_lineage_key(spark):
    rows = random_records(spark, 1)
    times = rows.select(*e.LINEAGE_KEY, F.col("day").cast("timestamp").alias(e.REFERENCE))
    own = e.with_own_reference_time(rows, "day")
    plain = e.with_reference_time(rows.drop("day"), times)
    assert bag(own.select(*plain.columns)) == bag(plain)


def test_own_reference_time_with_many_repeated_keys(spark, monkeypatch):
    rows = random_records(spark, 2)
    few = bag(e.with_own_reference_time(rows, "day"))
    monkeypatch.setattr(e, "SENT_HASHES", 0)
    assert bag(e.with_own_reference_time(rows, "day")) == few


def test_one_aggregate_gives_the_merged_states(spark):
    for seed in (3, 4, 5):
        rows = e.with_own_reference_time(random_records(spark, seed), "day").withColumn("_part", F.length("_source_batch_id"))
        for fill, also in ((["TEL", "GRADE"], []), (["TEL"], ["_part"])):
            rows = rows.withColumn("_extra", F.col("GRADE"))
            plain = s.merge_states(s.record_states(rows, ["NM"], fill, also), ["NM", *also])
            assert bag(s.merge_records(rows, ["NM"], fill, also).select(*plain.columns)) == bag(plain)


def test_records_are_exchanged_once(spark, sf_dir):
    rows = entities.timed(spark, sf_dir)
    assert "lineitem.parquet" not in plan_of(rows)  # the view is stored
    merged = plan_of(e.merge_groups(materialize(rows), entities.KEYS, entities.FILL))
    assert len(re.findall(r"^\(\d+\) Exchange$", merged, re.M)) == 1
