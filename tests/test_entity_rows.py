"""Merging a batch: records meet times and keys once, and what earlier merges settled is not carried along."""

import re

from pyspark.sql import functions as F

from tests.test_entity_size import bag, random_records
from tests.test_plans import plan_of
from tidemark.operators import entity as e
from tidemark.plans.entities import EntityStore
from tidemark.sources import tables


def plain_times(df, reference):
    """By a loop over collected rows, NULLs of the key equal."""
    latest = {}
    for r in reference.collect():
        at, known = tuple(r[k] for k in e.LINEAGE_KEY), r[e.REFERENCE]
        latest[at] = max(filter(None, (latest.get(at), known)), default=None)
    return sorted(str((*r, latest.get(tuple(r[k] for k in e.LINEAGE_KEY)))) for r in df.collect())


def test_times_are_exchanged_once(spark):
    rows, other = random_records(spark, 5).drop("day"), random_records(spark, 6)
    times = other.select(*e.LINEAGE_KEY, F.col("day").cast("timestamp").alias(e.REFERENCE))
    timed = e.with_reference_time(rows, times)
    assert timed.columns == [*rows.columns, e.REFERENCE]
    assert sorted(str(tuple(r)) for r in timed.collect()) == plain_times(rows, times)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(e.with_reference_time(rows, times))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"^\(\d+\) Exchange$", plan, re.M)) == 2


def test_a_merge_reads_times_of_its_batches_and_settles_what_was_set_aside(spark, layout, monkeypatch):
    kind = "CUST_ID string, NM string, TEL string, _source_system string, _source_table string, _source_record_key string, _source_batch_id string"
    rows = [(None, f"n{i % 30}", f"t{i % 3}", "s", "t", f"r{i}", b) for b in ("b1", "b2") for i in range(90)]
    records = spark.createDataFrame(rows, kind)
    reference = records.select(*e.LINEAGE_KEY, F.to_timestamp(F.lit("2020-01-01")).alias(e.REFERENCE))
    timed, removed, plain, upsert = [], [], e.with_reference_time, tables.upsert

    def watched(df, table, keys, gone=None):
        if "mapping_error" in table:
            removed.append(gone.count())
        upsert(df, table, keys, gone)

    monkeypatch.setattr(e, "with_reference_time", lambda df, ref: (timed.append(ref.count()), plain(df, ref))[1])
    monkeypatch.setattr(tables, "upsert", watched)
    kept = EntityStore(spark, layout, "CUSTOMER", ["NM"], "CUST_ID", "CUST")
    for batch in ("b1", "b2"):
        kept.save(records.filter(F.col("_source_batch_id") == batch), "s", batch)
        kept.merge(reference, [("s", batch)])
    assert timed == [90, 90] and removed == [0, 0]  # names agree on one telephone number, so nothing is set aside
    other = records.withColumn("TEL", F.col("_source_record_key"))  # now they do not
    kept.save(other.filter("_source_batch_id = 'b1'"), "s", "b1")
    kept.merge(reference, [("s", "b1")])
    assert spark.table(kept.unmatched).count() == 180 and spark.table(kept.lineage).count() == 0
    first = records.filter("_source_batch_id = 'b1'")
    tables.replace_batch(first, kept.records, {"_source_system": "s", "_source_batch_id": "b1"})  # saved otherwise: still set aside
    kept.merge(reference, [("s", "b1")])
    assert removed[-1] == 180 and spark.table(kept.unmatched).count() == 0
    assert spark.table(kept.lineage).count() == 180 and spark.table(kept.entities).count() == 30
    assert bag(spark.table(kept.lineage).select("_source_record_key")) == bag(records.select("_source_record_key"))
