"""Keys that are filled late: rows are evaluated and written once, and become partitions where they lie."""

import pytest
from pyspark.sql import functions as F

from tests.test_late_parents import small_run, state
from tidemark.plans import mapping
from tidemark.sources import tables

PARTS = ["s", "b"]


def bag(spark, table):
    return sorted(spark.table(table).select("n", "v", *PARTS).collect(), key=str)


@pytest.mark.parametrize("names", [("b1", "b2", "b3"), ("a/b=c d", "é%41:x", "{'\\"), ("b1", None, "b3")])
def test_rows_of_changed_partitions_are_replaced(spark, layout, monkeypatch, names):
    table = f"{layout.database('gold')}.waiting"
    rows = spark.createDataFrame([(i, "waits" if i % 3 else "stays", "sys", names[i % 4 % 3]) for i in range(60)], "n int, v string, s string, b string")
    tables.append(rows, table, PARTS)

    def files():
        found = {}
        for r in spark.table(table).select("b", F.input_file_name()).distinct().collect():
            found.setdefault(r[0], set()).add(r[1])
        return found

    before, copied, write = files(), [], tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df: (copied.append(df.columns), write(df))[1])
    waits = F.col("v") == "waits"
    late = spark.table(table).filter(waits).withColumn("_hit", ~F.col("b").eqNullSafe(names[2]) & (F.col("n") % 3 == 1))
    late = late.withColumn("v", F.when(F.col("_hit"), F.lit("filled")).otherwise(F.col("v")))
    want = sorted(late.drop("_hit").unionByName(rows.filter(~waits)).select("n", "v", *PARTS).collect(), key=str)
    hits = {(r["s"], r["b"]): r["count"] for r in late.filter("_hit").groupBy(*PARTS).count().collect()}
    assert dict(tables.replace_changed(late, table, waits, "_hit", PARTS)) == hits and len(hits) == 2
    assert bag(spark, table) == want and spark.table(table).columns == ["n", "v", *PARTS]
    after = files()
    assert after[names[2]] == before[names[2]] and all(not after[b] & before[b] for b in names[:2])
    assert bool(copied) == (None in names)
    none = spark.table(table).filter(waits).withColumn("_hit", F.lit(False))
    assert tables.replace_changed(none, table, waits, "_hit", PARTS) == [] and files() == after


def test_filling_keys_copies_no_rows(spark, layout, monkeypatch):
    run = small_run(spark, layout, [(str(i), "AB"[i % 2], "5" if i % 5 else "x", f"k{i}", f"b{i % 3}") for i in range(30)])
    for batch in ("b0", "b1", "b2"):
        run.save(run.map("INBOUND", "COUNSEL", batch).frame, "COUNSEL", "inbound", batch)
    tables.append(spark.createDataFrame([("P-A", "A ")], "PRD_ID string, PRD_CD string"), layout.table("gold_candidate", "product"))
    copied = []
    for module in (tables, mapping):
        monkeypatch.setattr(module, "materialize", lambda df: copied.append(df.columns) or df)
    done = run.fill_deferred("COUNSEL")
    assert not copied and done["filled_rows"] == 30 and sorted(done["batches"]) == [("inbound", f"b{i}") for i in range(3)]
    late = state(spark, layout)
    for batch in ("b0", "b1", "b2"):  # mapping everything again gives the same
        run.save(run.map("INBOUND", "COUNSEL", batch).frame, "COUNSEL", "inbound", batch)
    assert state(spark, layout) == late
