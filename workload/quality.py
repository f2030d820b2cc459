"""Quality checks, cleansing, routing and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cleansing
from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import joined_or_null
from tidemark.operators import quality as q
from tidemark.operators.rules import Rule
from tidemark.plans.quality import detail_with_ids, find_once
from tidemark.session import metadata_frame, metadata_rows
from workload import sqltext as t
from workload.views import cte, load, view

STARTED = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
INBOUND_RULES = [
    Rule("DQ-COM-INB-001", "NULL_CHECK", ("consultation_id",), "CRITICAL", 0.0, "inbound"),
    Rule("DQ-CON-INB-001", "ORDER_CHECK", ("started_at", "ended_at"), "MEDIUM", 0.05, "inbound"),
    Rule("DQ-UNI-INB-001", "DUPLICATE_CHECK", ("consultation_id",), "CRITICAL", 0.0, "inbound"),
    Rule("DQ-VAL-INB-001", "CODE_EXISTS", ("status",), "HIGH", 0.01, "inbound", code_group="CST", cleansing_steps=("CLN-COM-001",)),
    Rule("DQ-VAL-INB-002", "CODE_EXISTS", ("consultation_type",), "LOW", 0.0, "inbound", code_group="CON"),
    Rule("DQ-VAL-INB-003", "PATTERN_CHECK", ("phone_number",), "MEDIUM", 0.5, "inbound", pattern=fixed.PHONE_DIGITS_PATTERN, cleansing_steps=("CLN-COM-001", "CLN-VAL-001")),
    Rule("DQ-VAL-INB-004", "PATTERN_CHECK", ("started_at",), "HIGH", 0.2, "inbound", pattern=STARTED, cleansing_steps=("CLN-COM-001", "CLN-VAL-002"), datetime_kind="TIMESTAMP"),
    Rule("DQ-VAL-INB-005", "PATTERN_CHECK", ("email",), "REVIEW", 0.0, "inbound", pattern=fixed.PROFILE_EMAIL_PATTERN),
    Rule("DQ-VAL-INB-006", "RANGE_CHECK", ("premium",), "LOW", 0.02, "inbound", min_value=0.0, max_value=400000.0),
]
OUTBOUND_RULES = [
    Rule("DQ-COM-OUT-001", "NULL_CHECK", ("TMR_ID",), "LOW", 0.2, "outbound"),
    Rule("DQ-UNI-OUT-001", "DUPLICATE_CHECK", ("LEAD_MGMT_NO", "TRY_CNT"), "HIGH", 0.5, "outbound"),
    Rule("DQ-VAL-OUT-001", "CODE_EXISTS", ("CONN_RSLT_CD",), "MEDIUM", 0.01, "outbound", code_group="CONN"),
]
ORDER_RULE = Rule("DQ-CON-ORD-001", "ORDER_CHECK", ("a", "b"), "LOW", 0.1, "orders", pattern="yyyy/MM/dd HH:mm:ss|yyyyMMddHHmmss")
BY_ID = {r.rule_id: r for r in [*INBOUND_RULES, *OUTBOUND_RULES]}
CODES = [("CST", "CST_F"), ("CST", "CST_O"), ("CST", "CST_P"), *[("CON", f"CON_{n}") for n in range(1, 5)],
         *[("CONN", f"C0{n}") for n in range(1, 4)]]
CODE_MAPPING = [("CST", "PENDING", "CST_P", "Y"), ("CST", "미분류", "CST_X", "Y"), ("CST", "CST_999", "CST_F", "Y"),
                ("CST", "CST_999", "CST_O", "Y"), ("CST", " ", "CST_F", "N")]


def code_tables(spark: SparkSession, code_steps: bool = False) -> q.CodeTables:
    master = metadata_frame(spark, [{"CODE_GROUP": g, "CODE": c} for g, c in CODES])
    names = ("CODE_GROUP", "SOURCE_CODE", "STANDARD_CODE", "APPROVED_YN")
    mapping = metadata_frame(spark, [dict(zip(names, r)) for r in CODE_MAPPING])
    if not code_steps:
        return q.CodeTables(master, unique=True)
    return q.CodeTables(master, q.approved_code_mapping(mapping, master), frozenset(["CLN-VAL-003"]), unique=True)


def inbound(spark, sf_dir):
    return view(spark, sf_dir, "inbound")


def outbound(spark, sf_dir):
    return view(spark, sf_dir, "outbound")


def counts_of(source: str, rule_ids: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = [BY_ID[i] for i in rule_ids]
        return q.rule_counts(view(spark, sf_dir, source), rules, code_tables(spark))

    return run


def judged(spark, sf_dir) -> DataFrame:
    return q.judge(q.rule_counts(inbound(spark, sf_dir), INBOUND_RULES, code_tables(spark)), INBOUND_RULES)


def dq_judgement(spark, sf_dir):
    return judged(spark, sf_dir).select(
        "rule_id", "check_count", "initial_error_count", "error_count", "affected_rows", "error_rate",
        "initial_error_rate", "result_status", "error_grade", "action_type", "cleansing_required_yn",
    )


def found(spark, sf_dir) -> DataFrame:
    return q.violations(inbound(spark, sf_dir), INBOUND_RULES, code_tables(spark), "consultation_id")


def dq_samples_masked(spark, sf_dir):
    samples = q.error_samples(found(spark, sf_dir))
    text = F.array_join("sample_values", " | ", "NULL")
    return samples.select("rule_id", text.alias("sample_values"))


def detail(spark, sf_dir) -> DataFrame:
    stored, ruled = find_once(inbound(spark, sf_dir), INBOUND_RULES, code_tables(spark), "consultation_id")
    return q.violation_detail(q.unfold_violations(stored, "__found"), ruled)


def dq_violation_detail(spark, sf_dir):
    return detail(spark, sf_dir).drop("dq_reason")


def dq_detail_counts(spark, sf_dir):
    return q.detail_counts(detail(spark, sf_dir))


def results(spark, sf_dir) -> DataFrame:
    """Results of both sources with the counts from the violation detail."""
    codes, parts = code_tables(spark), []
    for source, rules, key in (("inbound", INBOUND_RULES, "consultation_id"), ("outbound", OUTBOUND_RULES, "CTI_ID")):
        stored, ruled = find_once(view(spark, sf_dir, source), rules, codes, key)
        counts = q.detail_counts(q.violation_detail(q.unfold_violations(stored, "__found"), ruled))
        parts.append(ruled.join(counts, "rule_id", "left"))
    return parts[0].unionByName(parts[1])


def dq_run_summary(spark, sf_dir):
    return q.run_summary(results(spark, sf_dir))


def dq_overall(spark, sf_dir):
    return q.overall_metrics(results(spark, sf_dir))


def dq_failure_report(spark, sf_dir):
    return q.failure_report(results(spark, sf_dir)).drop("rule_name", "dq_reason")


def dq_top_failures(spark, sf_dir):
    return q.top_failures(q.failure_report(results(spark, sf_dir)))


def routed(spark, sf_dir) -> DataFrame:
    codes = code_tables(spark)
    actions = {r["rule_id"]: r["action_type"] for r in metadata_rows(judged(spark, sf_dir))}  # one row per rule
    isolate = [r for r in INBOUND_RULES if actions[r.rule_id] in fixed.ISOLATING_ACTIONS]
    lineage = {
        "_source_system": F.lit("inbound"),
        "_source_record_key": F.col("consultation_id"),
        "_source_batch_id": F.col("ingest_date"),
        "_dq_run_id": F.concat(F.lit("DQ-inbound-"), F.col("ingest_date")),
    }
    cleanse = [r for r in INBOUND_RULES if r.cleansing_steps]
    return q.route_records(inbound(spark, sf_dir), cleanse, isolate, codes, lineage)


def dq_candidate(spark, sf_dir):
    return q.candidates(routed(spark, sf_dir)).drop("_dq_run_id")


def dq_quarantine(spark, sf_dir):
    rows = q.quarantined(routed(spark, sf_dir)).drop("_dq_run_id")
    return rows.withColumn("_unresolved_rule_ids", joined_or_null(F.col("_unresolved_rule_ids")))


def dq_status_counts(spark, sf_dir):
    rows = routed(spark, sf_dir).groupBy("_source_batch_id", "_dq_status").agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumnsRenamed({"_source_batch_id": "batch", "_dq_status": "status"})


def dq_latest_run(spark, sf_dir):
    rows = routed(spark, sf_dir)
    runs = rows.groupBy(F.col("_source_system").alias("source_system"), F.col("_dq_run_id").alias("dq_run_id")).agg(
        F.max(F.to_timestamp("_source_batch_id")).alias("executed_at")
    )
    return q.latest_run_counts(runs, rows)


def cln(step, columns):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = inbound(spark, sf_dir)
        return rows.select("consultation_id", *[F.col(c).alias(f"{c}_before") for c in columns],
                           *[step(F.col(c)).alias(f"{c}_after") for c in columns])

    return run


def cln_datetime(spark, sf_dir):
    rows = inbound(spark, sf_dir).select(F.col("started_at").alias("before"), F.lit("inbound").alias("source"))
    closed = view(spark, sf_dir, "homepage").select(F.col("CLOSED_DT").alias("before"), F.lit("homepage").alias("source"))
    both = rows.unionByName(closed)
    return both.withColumns(
        {
            "as_timestamp": cleansing.standard_datetime(F.col("before")),
            "as_date": cleansing.standard_datetime(F.col("before"), "DATE"),
        }
    )


def cln_code_map(spark, sf_dir):
    rule = Rule("R", "CODE_EXISTS", ("status",), "HIGH", code_group="CST", cleansing_steps=("CLN-VAL-003",))
    rows = q.cleanse_column(inbound(spark, sf_dir), rule, code_tables(spark, True), "after")
    return rows.groupBy(F.col("status").alias("before"), "after", joined_or_null(F.col("after_steps")).alias("steps")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def cln_recheck(spark, sf_dir):
    """Outcome of the cleansing chain of every cleansing rule: tried, changed, passed the second check."""
    return (
        found(spark, sf_dir)
        .filter(F.col("re_dq_result").isNotNull())
        .groupBy("rule_id", "cleansing_rule_id", "cleansing_action", "re_dq_result")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def dq_detail_ids(spark, sf_dir):
    """Per rule the stored details and their different ids: as many, also for equal rows."""
    stored, ruled = find_once(inbound(spark, sf_dir), INBOUND_RULES, code_tables(spark), "consultation_id", row_hash=True)
    detail = detail_with_ids(stored, ruled, "run")
    return detail.groupBy("rule_id").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("dq_detail_id").alias("ids"))


def dq_order_formats(spark, sf_dir):
    """An order rule with formats of its own, on times written in two of them."""
    rows = load(spark, sf_dir, "orders").select(order_text(F.col("o_orderkey")).alias("a"), order_text(F.col("o_custkey")).alias("b"))
    return q.rule_counts(rows, [ORDER_RULE], code_tables(spark))


def order_text(key: Column) -> Column:
    number = F.lpad((key % 28 + 1).cast("string"), 2, "0")
    slash = F.concat(F.lit("2026/09/"), number, F.lit(" 09:30:00"))
    return F.when(key % 3 == 0, slash).otherwise(F.concat(F.lit("202609"), number, F.lit("093000")))


def mask_documents(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", cleansing.mask_pii(F.col("text")).alias("masked"))


QUERIES = {
    "dq_null": counts_of("inbound", ["DQ-COM-INB-001"]),
    "dq_pattern": counts_of("inbound", ["DQ-VAL-INB-003", "DQ-VAL-INB-004", "DQ-VAL-INB-005"]),
    "dq_range": counts_of("inbound", ["DQ-VAL-INB-006"]),
    "dq_order": counts_of("inbound", ["DQ-CON-INB-001"]),
    "dq_code_exists": counts_of("outbound", ["DQ-VAL-OUT-001"]),
    "dq_duplicate": counts_of("outbound", ["DQ-UNI-OUT-001"]),
    "dq_judgement": dq_judgement,
    "dq_samples_masked": dq_samples_masked,
    "dq_violation_detail": dq_violation_detail,
    "dq_detail_counts": dq_detail_counts,
    "dq_run_summary": dq_run_summary,
    "dq_overall": dq_overall,
    "dq_failure_report": dq_failure_report,
    "dq_top_failures": dq_top_failures,
    "dq_candidate": dq_candidate,
    "dq_quarantine": dq_quarantine,
    "dq_status_counts": dq_status_counts,
    "dq_latest_run": dq_latest_run,
    "cln_whitespace": cln(cleansing.trim_all_space, ["status", "phone_number"]),
    "cln_phone": cln(cleansing.standard_phone, ["phone_number"]),
    "cln_phone_hyphen": cln(lambda c: cleansing.standard_phone(c, "HYPHEN"), ["phone_number"]),
    "dq_detail_ids": dq_detail_ids,
    "dq_order_formats": dq_order_formats,
    "cln_datetime": cln_datetime,
    "cln_code_map": cln_code_map,
    "cln_recheck": cln_recheck,
    "mask_documents": mask_documents,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_CODES = ", ".join(f"('{g}', '{c}')" for g, c in CODES)
_MAPPING = ", ".join(str(r) for r in CODE_MAPPING)
_ORDER = f"NOT coalesce({t.parse('started_at')} <= {t.parse('ended_at')}, false)"
_EMAIL = fixed.PROFILE_EMAIL_PATTERN
_STATUS, _PHONE, _STARTED = t.trim_all("status"), t.phone(t.trim_all("phone_number")), t.datetime_text(t.trim_all("started_at"))


def _is_code(value: str, group: str) -> str:
    return f"coalesce({value} IN (SELECT code FROM codes WHERE code_group = '{group}'), false)"


def _marks(source: str, status: str, phone: str, started: str) -> str:
    """Per-row error flags of the inbound rules on given columns of a source."""
    return f"""SELECT *,
  consultation_id IS NULL OR consultation_id = '' AS e1,
  {_ORDER.replace('started_at', started)} AS e2,
  count(*) OVER (PARTITION BY consultation_id) > 1 AS e3,
  NOT {_is_code(status, 'CST')} AS e4,
  NOT {_is_code('consultation_type', 'CON')} AS e5,
  NOT coalesce(regexp_matches({phone}, '^01[0-9][0-9]{{7,8}}$'), false) AS e6,
  NOT coalesce(regexp_matches({started}, '{STARTED}'), false) AS e7,
  NOT coalesce(regexp_matches(email, '{_EMAIL}'), false) AS e8,
  NOT coalesce(TRY_CAST(premium AS DOUBLE) BETWEEN 0 AND 400000, false) AS e9
FROM {source}"""


_BASE = f"""WITH {cte('inbound')},
codes(code_group, code) AS (VALUES {_CODES}),
cleaned AS (SELECT *, row_number() OVER () AS rid, {_STATUS} AS c_status, {_PHONE} AS c_phone, {_STARTED} AS c_started,
  {t.trim_all('phone_number')} AS s_phone, {t.trim_all('started_at')} AS s_started FROM inbound),
before AS ({_marks('cleaned', 'status', 'phone_number', 'started_at')}),
marked AS (SELECT *,
  e4 AND NOT {_is_code('c_status', 'CST')} AS l4,
  e6 AND NOT coalesce(regexp_matches(c_phone, '^01[0-9][0-9]{{7,8}}$'), false) AS l6,
  e7 AND NOT coalesce(regexp_matches(c_started, '{STARTED}'), false) AS l7 FROM before),
groups AS (SELECT consultation_id, count(*) AS n FROM inbound GROUP BY 1),
counts AS (
"""
_LEFT = {4: "l4", 6: "l6", 7: "l7"}


def _count_rows(ids: list[str]) -> str:
    parts = []
    for i, rule in enumerate(INBOUND_RULES, 1):
        if rule.rule_id not in ids:
            continue
        if i == 3:
            parts.append(
                f"SELECT '{rule.rule_id}' AS rule_id, CAST(sum(n) AS BIGINT) AS check_count, count(*) FILTER (n > 1) AS initial_error_count,"
                " count(*) FILTER (n > 1) AS error_count, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS affected_rows FROM groups"
            )
        else:
            left = _LEFT.get(i, f"e{i}")
            parts.append(
                f"SELECT '{rule.rule_id}' AS rule_id, count(*) AS check_count, count(*) FILTER (e{i}) AS initial_error_count,"
                f" count(*) FILTER ({left}) AS error_count, count(*) FILTER (e{i}) AS affected_rows FROM marked"
            )
    return "\nUNION ALL ".join(parts)


_ALL = _BASE + _count_rows([r.rule_id for r in INBOUND_RULES]) + ")"


def _spec(rules: list[Rule]) -> str:
    rows = [f"('{r.rule_id}', '{r.target_table}', '{', '.join(r.columns)}', {r.threshold_rate}::DOUBLE, '{r.error_grade}')" for r in rules]
    return f"spec(rule_id, target_table, target_column, threshold_rate, grade) AS (VALUES {', '.join(rows)})"


_JUDGED = f"""judged AS (SELECT *,
  CASE WHEN NOT failed THEN 'ALLOW' WHEN grade = 'REVIEW' THEN 'REVIEW' WHEN grade IN ('CRITICAL', 'HIGH') THEN 'BLOCK' ELSE 'WARN' END AS action_type,
  CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS result_status, CASE WHEN failed THEN grade ELSE 'INFO' END AS error_grade,
  {t.rate('error_count', 'check_count', 6)} AS error_rate, {t.rate('initial_error_count', 'check_count', 6)} AS initial_error_rate
  FROM (SELECT *, CASE WHEN grade = 'REVIEW' THEN error_count > 0 ELSE error_count::DOUBLE / check_count > threshold_rate END AS failed
        FROM counts JOIN spec USING (rule_id)))"""

_BEFORE_TEXT = {
    1: "consultation_id",
    2: "'started_at=' || coalesce(started_at, 'NULL') || ', ended_at=' || coalesce(ended_at, 'NULL')",
    3: "consultation_id", 4: "status", 5: "consultation_type", 6: "phone_number", 7: "started_at", 8: "email", 9: "premium",
}


def _found() -> str:
    parts = []
    for i, rule in enumerate(INBOUND_RULES, 1):
        steps, after, left, actions, cleansed = "NULL", "NULL", f"e{i}", "NULL", i in _LEFT
        if i == 4:
            after, changed = "c_status", "status IS DISTINCT FROM c_status"
            steps, actions = f"CASE WHEN {changed} THEN 'CLN-COM-001' END", f"CASE WHEN {changed} THEN 'WHITESPACE_NORMALIZE' END"
        elif i in (6, 7):
            raw, mid, after = ("phone_number", "s_phone", "c_phone") if i == 6 else ("started_at", "s_started", "c_started")
            step, action = ("CLN-VAL-001", "PHONE_FORMAT") if i == 6 else ("CLN-VAL-002", "DATETIME_FORMAT")
            first, second = f"{raw} IS DISTINCT FROM {mid}", f"{mid} IS DISTINCT FROM {after}"
            steps = f"nullif(concat_ws(',', CASE WHEN {first} THEN 'CLN-COM-001' END, CASE WHEN {second} THEN '{step}' END), '')"
            actions = f"nullif(concat_ws(',', CASE WHEN {first} THEN 'WHITESPACE_NORMALIZE' END, CASE WHEN {second} THEN '{action}' END), '')"
        left = _LEFT.get(i, left)
        parts.append(
            f"SELECT '{rule.rule_id}' AS rule_id, consultation_id AS source_record_key, '{rule.label}' AS target_column,"
            f" {_BEFORE_TEXT[i]} AS raw, {after} AS after, {steps} AS cleansing_rule_id, {actions} AS cleansing_action,"
            f" {left} AS still, {'true' if cleansed else 'false'} AS cleansed FROM marked WHERE e{i}"
        )
    union = "\nUNION ALL ".join(parts)
    return f"""found AS (SELECT rule_id, source_record_key, target_column, {t.mask('raw')} AS before_value,
  CASE WHEN cleansing_rule_id IS NOT NULL THEN {t.mask('after')} END AS proposed_value,
  CASE WHEN NOT still THEN {t.mask('after')} END AS final_value, cleansing_action, cleansing_rule_id,
  CASE WHEN cleansed THEN CASE WHEN still THEN 'FAIL' ELSE 'PASS' END END AS re_dq_result, cleansed AND NOT still AS auto
  FROM ({union}))"""


_DETAIL = """detail AS (SELECT f.* EXCLUDE (auto),
  CASE WHEN auto THEN 'AUTO_CLEANSED' WHEN action_type IN ('BLOCK', 'REVIEW') THEN 'UNRESOLVED' WHEN action_type = 'ALLOW' THEN 'NOT_REQUIRED' ELSE 'ALLOWED' END AS cleansing_status,
  action_type IN ('BLOCK', 'REVIEW') AND NOT auto AS review_required_yn FROM found f JOIN judged USING (rule_id))"""
_DETAIL_COUNTS = """detail_counts AS (SELECT rule_id, count(DISTINCT source_record_key) + max(CASE WHEN source_record_key IS NULL THEN 1 ELSE 0 END) AS unique_error_record_count,
  count(*) FILTER (cleansing_status = 'AUTO_CLEANSED') AS auto_cleansed_record_count, count(*) FILTER (cleansing_status = 'UNRESOLVED') AS unresolved_record_count FROM detail GROUP BY 1)"""

_IN = f"{_ALL}, {_spec(INBOUND_RULES)}, {_JUDGED}"
_FULL = f"{_IN}, {_found()}, {_DETAIL}, {_DETAIL_COUNTS}"

# Outbound results next to the inbound ones.
_OUT = f"""{cte('outbound')},
o_marked AS (SELECT *, TMR_ID IS NULL OR TMR_ID = '' AS o1, count(*) OVER (PARTITION BY LEAD_MGMT_NO, TRY_CNT) > 1 AS o2,
  NOT {_is_code('CONN_RSLT_CD', 'CONN')} AS o3 FROM outbound),
o_counts AS (
 SELECT 'DQ-COM-OUT-001' AS rule_id, count(*) AS check_count, count(*) FILTER (o1) AS error_count, count(*) FILTER (o1) AS affected,
   count(DISTINCT CTI_ID) FILTER (o1) AS uniq FROM o_marked
 UNION ALL SELECT 'DQ-UNI-OUT-001', count(*), count(DISTINCT LEAD_MGMT_NO || '/' || TRY_CNT) FILTER (o2), count(*) FILTER (o2), count(DISTINCT CTI_ID) FILTER (o2) FROM o_marked
 UNION ALL SELECT 'DQ-VAL-OUT-001', count(*), count(*) FILTER (o3), count(*) FILTER (o3), count(DISTINCT CTI_ID) FILTER (o3) FROM o_marked),
o_judged AS (SELECT *, CASE WHEN NOT failed THEN 'ALLOW' WHEN grade IN ('CRITICAL', 'HIGH') THEN 'BLOCK' ELSE 'WARN' END AS action_type
  FROM (SELECT *, error_count::DOUBLE / check_count > threshold_rate AS failed FROM o_counts JOIN o_spec USING (rule_id)))"""
_RESULTS = f"""{_FULL}, {_spec(OUTBOUND_RULES).replace('spec(', 'o_spec(', 1)}, {_OUT},
results AS (SELECT rule_id, target_table, target_column, check_count, error_count, error_rate, threshold_rate, result_status, error_grade, action_type,
    unique_error_record_count, auto_cleansed_record_count, unresolved_record_count FROM judged LEFT JOIN detail_counts USING (rule_id)
  UNION ALL SELECT rule_id, target_table, target_column, check_count, error_count, {t.rate('error_count', 'check_count', 6)}, threshold_rate,
    CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END, CASE WHEN failed THEN grade ELSE 'INFO' END, action_type,
    uniq, 0, CASE WHEN action_type = 'BLOCK' THEN affected ELSE 0 END FROM o_judged)"""
_REPORT = f"""{_RESULTS}, report AS (SELECT rule_id, target_table, target_column, error_grade, action_type, check_count, error_count,
  CAST(round(error_rate * 100, 2) AS VARCHAR) || '%' AS error_rate_pct, CAST(round(threshold_rate * 100, 2) AS VARCHAR) || '%' AS threshold_rate_pct,
  coalesce(auto_cleansed_record_count, 0) AS auto_cleansed_count, coalesce(unresolved_record_count, 0) AS unresolved_count
  FROM results WHERE result_status = 'FAIL' OR action_type <> 'ALLOW')"""

# Routing: apply cleansed values that pass, then judge the isolating rules on the cleansed record.
_ROUTED = f"""{_IN},
applied AS (SELECT consultation_id, CASE WHEN e4 AND NOT l4 THEN c_status ELSE status END AS status, consultation_type,
  CASE WHEN e7 AND NOT l7 THEN c_started ELSE started_at END AS started_at, ended_at,
  CASE WHEN e6 AND NOT l6 THEN c_phone ELSE phone_number END AS phone_number, email, customer_id, customer_name, policy_id, premium, ingest_date,
  (e4 AND NOT l4) OR (e6 AND NOT l6) OR (e7 AND NOT l7) AS _cleansed_yn FROM marked),
rejudged AS ({_marks('applied', 'status', 'phone_number', 'started_at')}),
act AS (SELECT rule_id FROM judged WHERE action_type IN ('BLOCK', 'REVIEW')),
listed AS (SELECT * , nullif(concat_ws(',', {', '.join(f"CASE WHEN e{i} AND '{r.rule_id}' IN (SELECT rule_id FROM act) THEN '{r.rule_id}' END" for i, r in enumerate(INBOUND_RULES, 1))}), '') AS _unresolved_rule_ids FROM rejudged),
routed AS (SELECT * EXCLUDE (e1, e2, e3, e4, e5, e6, e7, e8, e9), 'inbound' AS _source_system, consultation_id AS _source_record_key, ingest_date AS _source_batch_id,
  CASE WHEN _unresolved_rule_ids IS NOT NULL THEN 'UNRESOLVED' WHEN _cleansed_yn THEN 'CLEANSED' ELSE 'CLEAN' END AS _dq_status FROM listed)"""


def _counts_sql(ids: list[str]) -> str:
    return _BASE + _count_rows(ids) + ") SELECT * FROM counts"


def _outbound_sql(rule_id: str) -> str:
    codes = f"codes(code_group, code) AS (VALUES {_CODES})"
    spec = _spec(OUTBOUND_RULES).replace("spec(", "o_spec(", 1)
    return (
        f"WITH {codes}, {spec}, {_OUT} SELECT rule_id, check_count, error_count AS initial_error_count, error_count,"
        f" affected AS affected_rows FROM o_counts WHERE rule_id = '{rule_id}'"
    )


ORACLES = {
    "dq_null": _counts_sql(["DQ-COM-INB-001"]),
    "dq_pattern": _counts_sql(["DQ-VAL-INB-003", "DQ-VAL-INB-004", "DQ-VAL-INB-005"]),
    "dq_range": _counts_sql(["DQ-VAL-INB-006"]),
    "dq_order": _counts_sql(["DQ-CON-INB-001"]),
    "dq_code_exists": _outbound_sql("DQ-VAL-OUT-001"),
    "dq_duplicate": _outbound_sql("DQ-UNI-OUT-001"),
    "dq_judgement": f"""{_IN} SELECT rule_id, check_count, initial_error_count, error_count, affected_rows, error_rate, initial_error_rate,
        result_status, error_grade, action_type, action_type <> 'ALLOW' AS cleansing_required_yn FROM judged""",
    "dq_samples_masked": f"""{_FULL}, ranked AS (SELECT rule_id, before_value,
        row_number() OVER (PARTITION BY rule_id ORDER BY source_record_key NULLS FIRST, before_value NULLS FIRST) AS n FROM found)
        SELECT rule_id, string_agg(coalesce(before_value, 'NULL'), ' | ' ORDER BY n) AS sample_values FROM ranked WHERE n <= 5 GROUP BY 1""",
    "dq_violation_detail": f"{_FULL} SELECT * FROM detail",
    "dq_detail_counts": f"{_FULL} SELECT * FROM detail_counts",
    "dq_run_summary": f"""{_RESULTS} SELECT target_table, count(*) AS total_rules, count(*) FILTER (result_status = 'PASS') AS pass_count,
        count(*) FILTER (result_status = 'FAIL') AS fail_count, CAST(coalesce(sum(auto_cleansed_record_count), 0) AS BIGINT) AS auto_cleansed_record_count,
        CAST(coalesce(sum(unresolved_record_count), 0) AS BIGINT) AS unresolved_record_count FROM results GROUP BY 1""",
    "dq_overall": f"""{_RESULTS} SELECT count(*) AS total_rules_executed, count(*) FILTER (result_status = 'PASS') AS pass_count,
        count(*) FILTER (result_status = 'FAIL') AS fail_count, count(*) FILTER (result_status = 'FAIL' AND error_grade = 'CRITICAL') AS critical_fail_count,
        count(*) FILTER (result_status = 'FAIL' AND error_grade = 'HIGH') AS high_fail_count,
        count(*) FILTER (action_type = 'REVIEW' OR error_grade = 'REVIEW') AS review_count,
        CAST(coalesce(sum(auto_cleansed_record_count), 0) AS BIGINT) AS auto_cleansed_record_count,
        CAST(coalesce(sum(unresolved_record_count), 0) AS BIGINT) AS unresolved_record_count,
        CASE WHEN count(*) FILTER (result_status = 'FAIL' AND error_grade IN ('CRITICAL', 'HIGH') AND (unresolved_record_count IS NULL OR unresolved_record_count > 0)) > 0
             THEN 'BLOCK' ELSE 'PASS' END AS overall_status FROM results""",
    "dq_failure_report": f"{_REPORT} SELECT * FROM report",
    "dq_top_failures": f"""{_REPORT} SELECT rule_id, target_column, error_grade, error_count, error_rate_pct,
        greatest((SELECT count(*) FROM report) - 5, 0) AS more_failures FROM report ORDER BY rule_id LIMIT 5""",
    "dq_candidate": f"{_ROUTED} SELECT * EXCLUDE (_unresolved_rule_ids) FROM routed WHERE _dq_status <> 'UNRESOLVED'",
    "dq_quarantine": f"{_ROUTED} SELECT * FROM routed WHERE _dq_status = 'UNRESOLVED'",
    "dq_status_counts": f"{_ROUTED} SELECT ingest_date AS batch, _dq_status AS status, count(*) AS rows FROM routed GROUP BY 1, 2",
    "dq_latest_run": f"""{_ROUTED}, latest AS (SELECT * FROM routed WHERE ingest_date = (SELECT max(ingest_date) FROM routed)),
        n AS (SELECT count(*) AS total, count(*) FILTER (_dq_status <> 'UNRESOLVED') AS done, count(*) FILTER (_dq_status = 'UNRESOLVED') AS pending FROM latest)
        SELECT 'inbound' AS source_system, * FROM n UNION ALL SELECT 'TOTAL', * FROM n""",
    "cln_whitespace": f"""WITH {cte('inbound')} SELECT consultation_id, status AS status_before, phone_number AS phone_number_before,
        {t.trim_all('status')} AS status_after, {t.trim_all('phone_number')} AS phone_number_after FROM inbound""",
    "cln_phone": f"""WITH {cte('inbound')} SELECT consultation_id, phone_number AS phone_number_before, {t.phone('phone_number')} AS phone_number_after FROM inbound""",
    "cln_datetime": f"""WITH {cte('inbound', 'homepage')}, b AS (SELECT started_at AS before, 'inbound' AS source FROM inbound
        UNION ALL SELECT CLOSED_DT, 'homepage' FROM homepage)
        SELECT before, source, {t.datetime_text('before')} AS as_timestamp,
        {t.datetime_text('before', ('%Y-%m-%d', '%Y/%m/%d', '%Y.%m.%d', '%Y%m%d'), '%Y-%m-%d')} AS as_date FROM b""",
    "cln_code_map": f"""WITH {cte('inbound')}, codes(code_group, code) AS (VALUES {_CODES}), m(g, s, d, ok) AS (VALUES {_MAPPING}),
        single AS (SELECT g, s, min(d) AS d FROM m WHERE ok = 'Y' GROUP BY g, s HAVING count(DISTINCT d) = 1),
        approved AS (SELECT s, d FROM single WHERE g = 'CST' AND (g, d) IN (SELECT (code_group, code) FROM codes))
        SELECT status AS before, coalesce(d, status) AS after, CASE WHEN d IS NOT NULL AND d <> status THEN 'CLN-VAL-003' END AS steps, count(*) AS rows
        FROM inbound LEFT JOIN approved ON status = s GROUP BY 1, 2, 3""",
    "cln_recheck": f"""{_FULL} SELECT rule_id, cleansing_rule_id, cleansing_action, re_dq_result, count(*) AS rows FROM found
        WHERE re_dq_result IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "mask_documents": f"SELECT doc_id, {t.mask('text')} AS masked FROM documents",
}

_HYPHEN = rf"CASE WHEN {t.phone('phone_number')} ~ '^01[0-9]{{8,9}}$' THEN regexp_replace({t.phone('phone_number')}, '^(...)([0-9]*)([0-9]{{4}})$', '\1-\2-\3') ELSE phone_number END"
ORACLES |= {
    "cln_phone_hyphen": f"WITH {cte('inbound')} SELECT consultation_id, phone_number AS phone_number_before, {_HYPHEN} AS phone_number_after FROM inbound",
    "dq_detail_ids": f"SELECT rule_id, count(*) AS rows, count(*) AS ids FROM ({ORACLES['dq_violation_detail']}) GROUP BY 1",
    "dq_order_formats": """SELECT 'DQ-CON-ORD-001' AS rule_id, count(*) AS check_count, count(*) FILTER (o_orderkey % 28 > o_custkey % 28) AS initial_error_count,
        count(*) FILTER (o_orderkey % 28 > o_custkey % 28) AS error_count, count(*) FILTER (o_orderkey % 28 > o_custkey % 28) AS affected_rows FROM orders""",
}
