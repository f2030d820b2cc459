"""Whole runs over tables: land, check, map, merge, validate, and run again."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import diff
from tidemark.operators.model import TargetModel
from tidemark.operators.rules import Rule
from tidemark.plans import ingest, profiling
from tidemark.plans import quality as quality_run
from tidemark.plans import validation as validation_run
from tidemark.plans.mapping import MappingRun
from tidemark.session import metadata_frame, scratch_dir
from tidemark.sources import files, tables
from workload import mapping as wm
from workload import quality as wq
from workload.profiling import SPECS
from workload.views import sessions, view


def land_inbound(spark, layout, sf_dir):
    rows, base = view(spark, sf_dir, "inbound"), scratch_dir(spark)
    files_of = rows.write.partitionBy("ingest_date").option("header", True)
    files_of.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(base)
    columns = [c for c in rows.columns if c != "ingest_date"]
    return base, columns, ingest.ingest(spark, layout, "inbound", base, "csv", columns)


def test_ingest_keeps_earlier_batches(spark, layout, sf_dir):
    base, columns, table = land_inbound(spark, layout, sf_dir)
    newest = spark.table(table).count()
    assert [r[0] for r in spark.table(table).select("ingest_date").distinct().collect()] == ["2026-09-15"]
    older = files.read_csv_batches(spark, base, columns, latest_only=False).filter("ingest_date = '2026-09-13'")
    tables.replace_batches(older, table, ["ingest_date"])
    ingest.ingest(spark, layout, "inbound", base, "csv", columns)
    assert spark.table(table).filter("ingest_date = '2026-09-15'").count() == newest
    assert spark.table(table).filter("ingest_date = '2026-09-13'").count() == older.count()
    with pytest.raises(ValueError, match="unsupported"):
        ingest.ingest(spark, layout, "inbound", base, "xml")


def test_ingest_nested_document(spark, layout, tmp_path):
    """A multi-line document, with a list missing and an unknown field, in a dated folder."""
    for day, name in (("2026-09-01", "old"), ("2026-09-02", "new")):
        folder = tmp_path / f"ingest_date={day}"
        folder.mkdir()
        document = {"sessions": [
            {"session_id": name, "is_logged_in": True, "duration_seconds": 5, "resolution": {"a": 1}, "product_interest": ["x"],
             "navigation_path": [{"step": 1, "menu_name": "m"}, {"step": 2}],
             "free_text_queries": [{"query": "q1", "matched": True, "matched_items": ["i"]}, {"query": "q2"}, {"query": "q3"}]},
            {"session_id": name + "2", "unknown": 1}]}
        (folder / "chat.json").write_text(json.dumps(document, indent=1))
    table = ingest.ingest(spark, layout, "chatbot", str(tmp_path), "json_unified")
    rows = spark.table(table).orderBy("session_id", "nav_step", "user_query").collect()
    assert [(r["session_id"], r["nav_step"], r["user_query"]) for r in rows] == [
        *[("new", s, q) for s in ("1", "2") for q in ("q1", "q2", "q3")], ("new2", None, None),
    ]
    first = rows[0]
    assert (first["resolution"], first["product_interest"], first["is_logged_in"], first["query_matched_items"]) == ('{"a":1}', '["x"]', "true", '["i"]')
    assert first["ingest_date"] == "2026-09-02" and first["consent_screen_shown"] is None and len(rows[0]) == 35


def test_flatten_covers_every_pair(spark, sf_dir):
    nested = sessions(spark, sf_dir)
    count = nested.select(F.explode("sessions").alias("s")).select(
        F.sum(F.greatest(F.coalesce(F.size("s.navigation_path"), F.lit(1)), F.lit(1)) * F.greatest(F.coalesce(F.size("s.free_text_queries"), F.lit(1)), F.lit(1)))
    )
    assert files.flatten_sessions(nested).count() == count.first()[0]


def test_bucket_upsert_touches_only_its_partitions(spark, layout):
    key, table = ["k"], layout.table("gold", "t")
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    tables.append(tables.with_key_bucket(rows, key, 8), table, [tables.KEY_BUCKET])

    def files_of() -> dict[int, set[str]]:
        found = {}
        for r in spark.table(table).select(tables.KEY_BUCKET, F.input_file_name().alias("f")).distinct().collect():
            found.setdefault(r[0], set()).add(r["f"])
        return found

    before = files_of()
    stored = spark.table(table)
    emptied = stored.filter("_key_bucket = 2").select("k")
    gone = {r["k"] for r in emptied.collect()}
    change = tables.with_key_bucket(spark.createDataFrame([("5", "new"), ("x", "new")], "k string, v string"), key, 8)
    changed = {r[0] for r in change.select(tables.KEY_BUCKET).collect()}
    tables.upsert(change, table, key, removed=emptied)
    after = files_of()
    assert 2 not in after or 2 in changed
    assert {b for b in before if before[b] == after.get(b)} == set(before) - changed - {2}
    got = {r["k"]: r["v"] for r in spark.table(table).collect()}
    want = {str(i): "old" for i in range(200) if str(i) not in gone} | {"5": "new", "x": "new"}
    assert got == want


def test_metadata_file(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('﻿TABLE_NAME,COLUMN_NAME,KEY\nA,x,\nA,"y, z",PK\n', encoding="utf-8")
    rows = files.read_metadata_csv(spark, str(path), ordinal="ORDINAL").collect()
    assert [tuple(r) for r in rows] == [("1", "A", "x", None), ("2", "A", "y, z", "PK")]
    with pytest.raises(ValueError, match="1 values of TABLE_NAME are repeated"):
        files.read_metadata_csv(spark, str(path), key="TABLE_NAME")
    with pytest.raises(ValueError, match="missing columns"):
        files.require_columns(files.read_metadata_csv(spark, str(path)), ["OTHER"], "m.csv")


def test_rule_repository(spark, layout, tmp_path):
    repository = quality_run.RuleRepository(spark, layout)

    def frame(rules):
        return metadata_frame(spark, [r.as_record() for r in rules])

    plan = repository.sync(frame(wq.INBOUND_RULES))
    assert {r["sync_status"] for r in plan.collect()} == {"new"}
    assert repository.load("inbound") == wq.INBOUND_RULES
    assert {r["sync_status"] for r in repository.sync(frame(wq.INBOUND_RULES)).collect()} == {"unchanged"}
    assert repository.history().count() == len(wq.INBOUND_RULES)

    stricter = Rule("DQ-VAL-INB-006", "RANGE_CHECK", ("premium",), "LOW", 0.01, "inbound", min_value=0.0, max_value=400000.0)
    renamed = Rule("DQ-COM-INB-001", "NULL_CHECK", ("consultation_id",), "CRITICAL", 0.0, "inbound", rule_name="new name")
    plan = {r["rule_id"]: r for r in repository.sync(frame([renamed, *wq.INBOUND_RULES[1:-2], stricter])).collect()}
    assert plan["DQ-VAL-INB-006"]["sync_status"] == "changed" and plan["DQ-VAL-INB-006"]["diffs"] == "threshold_rate: 0.02 → 0.01"
    assert plan["DQ-VAL-INB-005"]["sync_status"] == "deactivated" and plan["DQ-COM-INB-001"]["sync_status"] == "unchanged"
    assert "DQ-VAL-INB-005" not in {r.rule_id for r in repository.load()}
    plan = {r["rule_id"]: r["sync_status"] for r in repository.sync(frame(wq.INBOUND_RULES)).collect()}
    assert plan["DQ-VAL-INB-005"] == "reactivated"
    assert [r["version"] for r in repository.history("DQ-VAL-INB-005").collect()] == [1, 2, 3]

    with pytest.raises(ValueError) as refused:
        repository.sync(frame([Rule("R1", "ORDER_CHECK", ("a",), "HIGH", 2.0, "t"), Rule("R1", "NULL_CHECK", ("a",), "BAD", 0.0, "t")]))
    for text in ("ORDER_CHECK needs two columns", "outside 0..1", "error_grade is unknown", "rule_id is repeated"):
        assert text in str(refused.value)
    assert repository.history("R1").count() == 0

    path = tmp_path / "rules.csv"
    import csv

    with path.open("w", encoding="utf-8-sig", newline="") as out:
        writer = csv.DictWriter(out, list(wq.INBOUND_RULES[0].as_record()))
        writer.writeheader()
        writer.writerows([r.as_record() for r in wq.INBOUND_RULES])
    assert {r["sync_status"] for r in repository.sync_csv(str(path)).collect()} == {"unchanged"}


def test_quality_run(spark, layout, sf_dir):
    _, _, table = land_inbound(spark, layout, sf_dir)
    rows = spark.table(table).count()
    codes = wq.code_tables(spark)
    first = quality_run.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, codes)
    assert first["candidate_row_count"] + first["quarantine_row_count"] == rows and first["quarantine_row_count"] > 0
    results = {r["rule_id"]: r for r in first["results"].collect()}
    assert set(results) == {r.rule_id for r in wq.INBOUND_RULES}
    held = spark.table(layout.table("dq_quarantine", "inbound"))
    for rule_id, result in results.items():
        # Rows that carry the rule in quarantine are exactly the unresolved rows of its result.
        listed = held.filter(F.array_contains("_unresolved_rule_ids", rule_id)).count()
        if result["action_type"] in ("BLOCK", "REVIEW"):
            assert listed == result["unresolved_record_count"], rule_id
        else:
            assert listed == 0
        assert len(json.loads(result["sample_values_json"] or "[]")) <= 5
    detail = spark.table(layout.table("meta", "dq_cleansing_detail"))
    assert detail.count() == sum(r["affected_rows"] for r in results.values())
    again = quality_run.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, codes)
    assert spark.table(layout.table("silver_candidate", "inbound")).count() == again["candidate_row_count"]
    stored = spark.table(layout.table("meta", "dq_result"))
    assert stored.select("dq_run_id").distinct().count() == 2  # results are appended, candidates replaced
    quality_run.clear_results(spark, layout, first["source_batch_id"])
    assert spark.table(layout.table("meta", "dq_result")).isEmpty()


def test_profile_run(spark, layout, sf_dir):
    for name in ("inbound", "outbound"):
        rows = view(spark, sf_dir, name)
        rows = rows if "ingest_date" in rows.columns else rows.withColumn("ingest_date", F.lit("2026-09-15"))
        tables.replace_batches(rows, layout.table("bronze", name), ["ingest_date"])
    for _ in range(2):
        written = profiling.run_profile(spark, layout, [SPECS["inbound"], SPECS["outbound"]], csv_folder=scratch_dir(spark))
        integrated = profiling.run_integrated(spark, layout, "2026-09-15")
    assert set(written) == set(profiling.KINDS)
    summary = {r["table_name"]: r for r in spark.table(integrated["integrated_summary"]).collect()}
    assert set(summary) == {"inbound", "outbound"}
    batch = view(spark, sf_dir, "inbound").filter("ingest_date = '2026-09-15'")
    assert summary["inbound"]["row_count"] == batch.count()
    assert spark.table(integrated["integrated_column_profile"]).count() == sum(len(SPECS[n].column_roles) for n in ("inbound", "outbound"))


DEFINITIONS = [
    {"TARGET_ENTITY": "CUSTOMER", "INTEGRATION_TYPE": "MERGE", "MATCHING_RULE": "NAME_DOB_PHONE_EXACT", "MATCHING_KEY_COLUMNS": "CUST_NM, EMAIL",
     "CONFLICT_RULE": "LATEST_NON_NULL", "CONFLICT_REFERENCE": "COUNSEL.END_DTM", "REVIEW_STATUS": "approved", "FINAL_MIGRATION_APPLY_YN": "y"},
    {"TARGET_ENTITY": "PRODUCT", "INTEGRATION_TYPE": "MASTER", "MATCHING_RULE": None, "MATCHING_KEY_COLUMNS": None, "CONFLICT_RULE": None,
     "CONFLICT_REFERENCE": None, "REVIEW_STATUS": "MODIFIED_APPROVED", "FINAL_MIGRATION_APPLY_YN": "Y"},
]
MODEL = [
    ("COUNSEL", "CNSL_ID", "VARCHAR(20)", "PK", "N", ""), ("COUNSEL", "STRT_DTM", "TIMESTAMP", None, "Y", ""),
    ("COUNSEL", "END_DTM", "TIMESTAMP", None, "Y", ""), ("COUNSEL", "CUST_ID", "VARCHAR(20)", "FK", "Y", "→ CUSTOMER.CUST_ID"),
    ("CUSTOMER", "CUST_ID", "VARCHAR(20)", "PK", "N", ""), ("CUSTOMER", "CUST_NM", "VARCHAR(50)", None, "N", ""),
    ("CUSTOMER", "EMAIL", "VARCHAR(50)", None, "Y", ""), ("CUSTOMER", "TEL_NO", "VARCHAR(20)", None, "Y", ""),
    ("PRODUCT", "PRD_ID", "VARCHAR(20)", "PK", "N", ""), ("PRODUCT", "PRD_CD", "VARCHAR(20)", "UK", "N", ""),
    ("PRODUCT", "PRD_NM", "VARCHAR(200)", None, "Y", ""),
]
RULES = [
    ("INBOUND", "CUSTOMER", "CUST_NM", "customer_name", "RENAME", "COPY"), ("INBOUND", "CUSTOMER", "EMAIL", "email", "RENAME", "COPY"),
    ("INBOUND", "CUSTOMER", "TEL_NO", "phone_number", "RENAME", "COPY"), ("INBOUND", "COUNSEL", "CNSL_ID", "consultation_id", "RENAME", "COPY"),
    ("INBOUND", "COUNSEL", "STRT_DTM", "started_at", "DIRECT", "COPY"), ("INBOUND", "COUNSEL", "END_DTM", "ended_at", "DIRECT", "COPY"),
    ("INBOUND", "COUNSEL", "CUST_ID", "customer_id", "DERIVED", "LOOKUP"),
    ("PRODUCT_MASTER", "PRODUCT", "PRD_ID", "STD_PRODUCT_CODE", "DERIVED", "GENERATE_ID"),
    ("PRODUCT_MASTER", "PRODUCT", "PRD_CD", "STD_PRODUCT_CODE", "RENAME", "COPY"),
    ("PRODUCT_MASTER", "PRODUCT", "PRD_NM", "STD_PRODUCT_NAME", "RENAME", "COPY"),
]


def mapping_run(spark, layout):
    names = ("source_system", "target_table", "target_column", "source_column", "mapping_type", "process_type")
    rules = [dict(zip(names, r), rule_id=f"M{i:02d}", rule_version="1", rule_status="ACTIVE") for i, r in enumerate(RULES)]
    model = [dict(zip(wm.MODEL_COLUMNS, r), ORDINAL=i) for i, r in enumerate(MODEL)]
    frames = [metadata_frame(spark, rows) for rows in (model, rules)]
    return MappingRun(spark, layout, *frames, wm.code_frame(spark), metadata_frame(spark, DEFINITIONS)), TargetModel.from_frame(frames[0])


def test_mapping_merge_and_validation(spark, layout, sf_dir):
    land_inbound(spark, layout, sf_dir)
    quality_run.run_quality(spark, layout, "inbound", wq.INBOUND_RULES, wq.code_tables(spark))
    rows = spark.table(layout.table("silver_candidate", "inbound")).count()
    run, model = mapping_run(spark, layout)
    run.require_ready(["CUSTOMER", "COUNSEL"])
    assert run.executable(["customer", "CONTRACT", "COUNSEL"]) == (["CUSTOMER", "COUNSEL"], ["PRODUCT"])
    with pytest.raises(ValueError, match="CONTRACT"):
        run.require_ready(["CUSTOMER", "CONTRACT"])

    first = run.run_target("COUNSEL")  # the customers do not exist yet
    assert first["integration_type"] == "DIRECT" and ("CUST_ID", "not supported (DERIVED/LOOKUP)") in first["deferred"]["INBOUND"]
    counsel, errors = (spark.table(layout.table(s, "COUNSEL")) for s in ("gold_candidate", "gold_mapping_error"))
    assert counsel.count() + errors.count() == rows
    before = tables.snapshot(spark, layout.table("gold_candidate", "COUNSEL"), layout.table("meta", "counsel_before"))

    merged = run.run_target("CUSTOMER")
    customers = spark.table(layout.table("gold_candidate", "CUSTOMER"))
    assert merged["integration"]["merged_rows"] == customers.count() == customers.select("CUST_NM", "EMAIL").distinct().count()
    ids = {r["CUST_NM"]: r["CUST_ID"] for r in customers.collect()}
    again = run.run_target("CUSTOMER")  # saving again resets the ids, the lineage brings them back
    assert again["integration"]["merged_rows"] == merged["integration"]["merged_rows"]
    assert {r["CUST_NM"]: r["CUST_ID"] for r in spark.table(layout.table("gold_candidate", "CUSTOMER")).collect()} == ids

    second = run.run_target("COUNSEL")  # now the lineage resolves the foreign key
    assert not any(c == "CUST_ID" for c, _ in second["deferred"]["INBOUND"])
    linked = spark.table(layout.table("gold_candidate", "COUNSEL"))
    assert linked.filter(F.col("CUST_ID").isNotNull()).count() > 0
    report = {r["check"]: r for r in diff.table_report(before, linked, "CNSL_ID").collect()}
    assert report["row_count"]["is_match"] and not report["null:CUST_ID"]["is_match"] and report["null:END_DTM"]["is_match"]

    early = validation_run.run_validation(spark, layout, model, "COUNSEL")
    assert [s["ref_table"] for s in early["relationship_rules_skipped"]] == ["CUSTOMER"]
    validation_run.run_validation(spark, layout, model, "CUSTOMER")
    for _ in range(2):
        done = validation_run.run_validation(spark, layout, model, "COUNSEL", "job")
        assert done["reconciled"] and done["input_count"] == linked.count() and not done["relationship_rules_skipped"]
        assert spark.table(layout.table("gold", "COUNSEL")).count() == done["loaded_count"]
        assert spark.table(layout.table("gold_quarantine", "COUNSEL")).count() == done["quarantined_count"]
    trace = spark.table(layout.table("gold", "migration_trace")).filter("TGT_TBL = 'COUNSEL'")
    assert trace.count() == 3 * linked.count()


def test_master_target(spark, layout, sf_dir):
    run, _ = mapping_run(spark, layout)

    def deliver(name):
        rows = wm.with_lineage(view(spark, sf_dir, name), "product_master", "STD_PRODUCT_CODE", F.lit("2026-09-15"))
        tables.replace_batches(rows, layout.table("silver_candidate", "product_master"), ["_source_batch_id"])

    deliver("product")
    first = run.run_target("PRODUCT")["master"]
    assert first["newly_assigned_rows"] == first["output_rows"] == view(spark, sf_dir, "product").count()
    ids = {r["PRD_CD"]: r["PRD_ID"] for r in spark.table(layout.table("gold_candidate", "PRODUCT")).collect()}
    deliver("product_later")
    run.run_target("PRODUCT")
    later = {r["PRD_CD"]: r["PRD_ID"] for r in spark.table(layout.table("gold_candidate", "PRODUCT")).collect()}
    assert set(later) == {r[0] for r in view(spark, sf_dir, "product_later").select("STD_PRODUCT_CODE").collect()}
    assert all(later[c] == ids[c] for c in later if c in ids) and len(set(later.values())) == len(later)


def test_crosswalk_refuses_unknown_codes(spark):
    from tidemark.operators import mapping as m

    products = spark.createDataFrame([("P1", " A "), ("P2", "B")], "PRD_ID string, PRD_CD string")
    pairs = spark.createDataFrame([("INBOUND", "x", "A"), ("OUTBOUND", "y", "C")], "SRC_SYS string, SRC_PRD_CD string, STD_CODE string")
    with pytest.raises(ValueError, match="unknown standard codes.*C"):
        m.build_crosswalk(pairs, products, "PRD_CD", "PRD_ID")
    kept = m.build_crosswalk(pairs.filter("STD_CODE = 'A'"), products, "PRD_CD", "PRD_ID")
    assert [tuple(r) for r in kept.collect()] == [("INBOUND", "x", "P1", "Y")]


def test_definition_is_checked(spark, layout, sf_dir):
    from tidemark.operators import mapping as m

    model = TargetModel([dict(zip(wm.MODEL_COLUMNS, r), ORDINAL=i) for i, r in enumerate(MODEL)])
    rules = [m.MappingRule("A", "1", "email", "NONE", "RENAME", "COPY"), m.MappingRule("B", "1", "gone", "EMAIL", "RENAME", "COPY"),
             m.MappingRule("C", "1", "email", "EMAIL", "RENAME", "COPY", data_type="DATE")]
    with pytest.raises(ValueError) as refused:
        m.check_definition(rules, model.columns("CUSTOMER"), view(spark, sf_dir, "inbound"))
    for text in ("no column NONE", "no column gone", "differs from the model", "mapped by B and C"):
        assert text in str(refused.value)
    with pytest.raises(ValueError, match="unsupported target type"):
        m.spark_type("BLOB")
