"""Order of targets by foreign keys, and keys that are filled once their parents exist."""

import pytest
from pyspark.sql import functions as F

from tests.test_runs import mapping_run
from tidemark.operators import mapping as m
from tidemark.operators.model import TargetModel
from tidemark.plans.mapping import MappingRun
from tidemark.session import metadata_frame
from tidemark.sources import tables
from workload import mapping as wm
from workload.views import view

NAMES = wm.MODEL_COLUMNS


def model_of(**references):
    """Tables with a key of their own and foreign keys to the named tables."""
    rows = []
    for table, parents in references.items():
        rows.append((table, f"{table}_ID", "VARCHAR(20)", "PK", "N", ""))
        rows += [(table, f"{p}_ID", "VARCHAR(20)", "FK", "Y", f"→ {p}.{p}_ID") for p in parents]
    return TargetModel([dict(zip(NAMES, r), ORDINAL=i) for i, r in enumerate(rows)])


def test_parents_come_first():
    model = model_of(A=["B", "C"], B=["C"], C=["C"], D=[])
    assert model.load_order(["A", "D", "b", "C"]) == ["C", "B", "A", "D"]
    assert model.load_order(["D", "A"]) == ["D", "A"]
    assert model.load_order([]) == []
    assert model.parents("C") == []


def test_a_cycle_is_reported():
    model = model_of(X=["A"], A=["B"], B=["C"], C=["A"])
    with pytest.raises(ValueError, match="cycle: A -> B -> C -> A"):
        model.load_order(["X", "A", "B", "C"])
    assert model.load_order(["A", "B"]) == ["B", "A"]


MODEL = [
    ("COUNSEL", "CNSL_ID", "VARCHAR(20)", "PK", "N", ""), ("COUNSEL", "PRD_ID", "VARCHAR(20)", "FK", "Y", "→ PRODUCT.PRD_ID"),
    ("COUNSEL", "PREM_AMT", "INTEGER", None, "Y", ""),
    ("PRODUCT", "PRD_ID", "VARCHAR(20)", "PK", "N", ""), ("PRODUCT", "PRD_CD", "VARCHAR(20)", "UK", "N", ""),
]
RULES = [
    ("INBOUND", "COUNSEL", "CNSL_ID", "id", "RENAME", "COPY"), ("INBOUND", "COUNSEL", "PRD_ID", "code", "DERIVED", "LOOKUP"),
    ("INBOUND", "COUNSEL", "PREM_AMT", "amount", "DIRECT", "COPY"),
]


def small_run(spark, layout, records):
    names = ("source_system", "target_table", "target_column", "source_column", "mapping_type", "process_type")
    rules = [dict(zip(names, r), rule_id=f"M{i:02d}", rule_version="1", rule_status="ACTIVE") for i, r in enumerate(RULES)]
    model = [dict(zip(NAMES, r), ORDINAL=i) for i, r in enumerate(MODEL)]
    rows = spark.createDataFrame(records, "id string, code string, amount string, _source_record_key string, _source_batch_id string")
    rows = rows.withColumns({"_source_system": F.lit("inbound"), "_source_table": F.lit("bronze.inbound")})
    tables.append(rows, layout.table("silver_candidate", "inbound"), ["_source_batch_id"])
    return MappingRun(spark, layout, metadata_frame(spark, model), metadata_frame(spark, rules), wm.code_frame(spark))


def state(spark, layout):
    out = {}
    for stage in ("gold_candidate", "gold_mapping_error"):
        for r in spark.table(layout.table(stage, "COUNSEL")).collect():
            out.setdefault((r["CNSL_ID"], r["_source_batch_id"]), []).append((stage, r["PRD_ID"], r["_unmapped_codes"]))
    return out


def test_keys_are_filled_when_parents_arrive(spark, layout):
    """Null, blank, repeated and unknown values; record keys that are shared by rows; an error row; two batches."""
    records = [
        ("1", " A", "5", "k", "b1"), ("2", "B", "5", "k", "b1"), ("3", None, "5", None, "b1"), ("4", " ", "5", "k4", "b1"),
        ("5", "Z", "5", "k5", "b1"), ("6", "A", "x", "k6", "b1"), ("7", "B", "5", "k7", "b2"),
    ]
    run = small_run(spark, layout, records)
    for batch in ("b1", "b2"):
        mapped = run.map("INBOUND", "COUNSEL", batch)
        assert ("PRD_ID", "not supported (DERIVED/LOOKUP)") in mapped.deferred
        run.save(mapped.frame, "COUNSEL", "inbound", batch)
    assert run.fill_deferred("COUNSEL")["filled_rows"] == 0

    product = layout.table("gold_candidate", "product")
    tables.append(spark.createDataFrame([("P-A", "A ")], "PRD_ID string, PRD_CD string"), product)
    run.fill_deferred("COUNSEL")
    assert state(spark, layout) == {
        ("1", "b1"): [("gold_candidate", "P-A", [])], ("2", "b1"): [("gold_candidate", None, ["PRD_ID=B"])],
        ("3", "b1"): [("gold_candidate", None, [])], ("4", "b1"): [("gold_candidate", None, [])],
        ("5", "b1"): [("gold_candidate", None, ["PRD_ID=Z"])], ("6", "b1"): [("gold_mapping_error", "P-A", [])],
        ("7", "b2"): [("gold_candidate", None, ["PRD_ID=B"])],
    }

    tables.append(spark.createDataFrame([("P-B", "B")], "PRD_ID string, PRD_CD string"), product)
    assert run.fill_deferred("COUNSEL")["filled_rows"] == 2
    late = state(spark, layout)
    assert late[("2", "b1")] == [("gold_candidate", "P-B", [])] and late[("7", "b2")] == late[("2", "b1")]
    for batch in ("b1", "b2"):  # mapping everything again gives the same
        run.save(run.map("INBOUND", "COUNSEL", batch).frame, "COUNSEL", "inbound", batch)
    assert state(spark, layout) == late


def test_only_partitions_with_filled_rows_are_rewritten(spark, layout):
    run = small_run(spark, layout, [("1", "A", "5", "k1", "b1"), ("2", "Z", "5", "k2", "b2"), ("3", "A", "5", "k3", "b1")])
    product = layout.table("gold_candidate", "product")
    tables.append(spark.createDataFrame([("P-0", "0")], "PRD_ID string, PRD_CD string"), product)
    for batch in ("b1", "b2"):
        run.save(run.map("INBOUND", "COUNSEL", batch).frame, "COUNSEL", "inbound", batch)

    def files():
        rows = spark.table(layout.table("gold_candidate", "COUNSEL")).select("_source_batch_id", "_metadata.file_path").distinct()
        out = {}
        for r in rows.collect():
            out.setdefault(r[0], set()).add(r[1])
        return out

    before = files()
    tables.append(spark.createDataFrame([("P-A", "A")], "PRD_ID string, PRD_CD string"), product)
    done = run.fill_deferred("COUNSEL")
    assert done["filled_rows"] == 2 and done["batches"] == [("inbound", "b1")]
    after = files()
    assert after["b2"] == before["b2"] and not after["b1"] & before["b1"]


def test_entities_as_parents(spark, layout, sf_dir):
    """The child is run first; `run_all` then merges the parent and fills the child, as a run in order would."""
    rows = wm.with_lineage(view(spark, sf_dir, "inbound"), "inbound", "consultation_id", F.lit("2026-09-15"))
    tables.append(rows, layout.table("silver_candidate", "inbound"), ["_source_batch_id"])
    run, model = mapping_run(spark, layout)
    assert model.load_order(["COUNSEL", "CUSTOMER"]) == ["CUSTOMER", "COUNSEL"]
    run.run_target("COUNSEL")
    counsel = layout.table("gold_candidate", "COUNSEL")
    assert spark.table(counsel).filter("CUST_ID IS NOT NULL").isEmpty()
    filled = run.run_all(["CUSTOMER"])["filled"]
    assert filled == {"COUNSEL": spark.table(counsel).count() + spark.table(layout.table("gold_mapping_error", "COUNSEL")).count()}
    names = [c.name for c in model.columns("COUNSEL")]
    late = spark.table(counsel).select(*names, "_unmapped_codes")
    late = spark.createDataFrame(late.collect(), late.schema)
    run.run_target("COUNSEL")
    again = spark.table(counsel).select(*late.columns)
    assert again.exceptAll(late).isEmpty() and late.exceptAll(again).isEmpty()
    assert late.filter("CUST_ID IS NOT NULL").count() > 0
