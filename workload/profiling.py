"""Column, category, duplicate and sequence profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.temporal import parse_any
from tidemark.operators import profile as p
from tidemark.session import metadata_frame
from workload import sqltext as t
from workload.views import cte, load, view

# Columns of the inputs, their roles, and the formats of their dates.
SPECS = {
    "inbound": p.TableProfile(
        "inbound",
        ["consultation_id"],
        {
            "consultation_id": "BUSINESS_KEY", "status": "CODE", "consultation_type": "CODE",
            "started_at": "DATE_DATETIME", "ended_at": "DATE_DATETIME", "phone_number": "PHONE", "email": "EMAIL",
            "customer_id": "GENERAL", "customer_name": "TEXT", "policy_id": "GENERAL", "premium": "GENERAL",
        },
        date_formats={"started_at": ("yyyy-MM-dd HH:mm:ss", "yyyy.MM.dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")},
        expected_patterns={"consultation_type": r"^CON_[1-4]$"},
        semantic_variants={"status": ("보류", "PENDING")},
        sequences=[["started_at", "ended_at"]],
    ),
    "outbound": p.TableProfile(
        "outbound",
        ["CTI_ID"],
        {"CTI_ID": "BUSINESS_KEY", "LEAD_MGMT_NO": "GENERAL", "TRY_CNT": "GENERAL", "GD_CD": "CODE", "CONN_RSLT_CD": "CODE",
         "CALL_ST_DTM": "DATE_DATETIME", "TMR_ID": "GENERAL", "MN_PREM": "GENERAL"},
        expected_patterns={"GD_CD": r"^[A-Z]+-[0-9]{2}$", "CONN_RSLT_CD": r"^C0[0-9]$"},
        sequences=[["CALL_ST_DTM", "CALL_ST_DTM"]],
    ),
    "homepage": p.TableProfile(
        "homepage",
        ["COMPLAINT_ID"],
        {"COMPLAINT_ID": "BUSINESS_KEY", "COMPLAINT_CONTENT": "TEXT", "LANG_CD": "CODE", "RCV_PATH": "CODE",
         "FSS_RELATED_YN": "CODE", "REG_DT": "DATE_DATETIME", "ANSWER_DUE_DT": "DATE_DATETIME", "CLOSED_DT": "DATE_DATETIME"},
        date_formats={"REG_DT": ("yyyy/MM/dd HH:mm",), "ANSWER_DUE_DT": ("yyyy/MM/dd",)},
        expected_patterns={"LANG_CD": r"^[A-Z]{2}$", "FSS_RELATED_YN": r"^[YN]$"},
        sequences=[["REG_DT", "ANSWER_DUE_DT"], ["REG_DT", "ANSWER_DUE_DT", "CLOSED_DT"]],
    ),
    "salesforce": p.TableProfile(
        "salesforce",
        ["Consultation_No__c"],
        {"Id": "TECHNICAL_PK", "Consultation_No__c": "BUSINESS_KEY", "Consult_Category__c": "CODE", "Session_Id__c": "GENERAL",
         "Consult_Datetime__c": "DATE_DATETIME", "Consult_Content__c": "TEXT", "Consent_Yn__c": "CODE"},
        date_formats={"Consult_Datetime__c": ("yyyy-MM-dd HH:mm:ss",)},
        expected_patterns={"Consent_Yn__c": r"^[YN]$", "Consult_Category__c": r"^[a-z]+$"},
        sequences=[["Consult_Datetime__c", "Consult_Datetime__c"]],
    ),
}
MASTER = [("status", f"CST_{c}") for c in "FOP"]


def master(spark: SparkSession) -> DataFrame:
    return metadata_frame(spark, [{"CODE_GROUP_ID": g, "CODE_VALUE": v} for g, v in MASTER])


def counts(spark, sf_dir, name: str) -> DataFrame:
    return p.value_counts(view(spark, sf_dir, name), list(SPECS[name].column_roles), SPECS[name].columns_with("TEXT"))


def over_tables(build, names=tuple(SPECS)):
    """The same profile of several tables, with the table name in front."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = None
        for name in names:
            part = build(spark, sf_dir, name).withColumn("table_name", F.lit(name))
            out = part if out is None else out.unionByName(part)
        return out

    return run


def columns_of(spark, sf_dir, name):
    return p.column_profile(counts(spark, sf_dir, name), SPECS[name])


def metrics_of(spark, sf_dir, name):
    return p.column_metrics(counts(spark, sf_dir, name), SPECS[name])


def formats_of(spark, sf_dir, name):
    return p.format_distribution(counts(spark, sf_dir, name), SPECS[name])


def categories_of(spark, sf_dir, name):
    codes = master(spark) if name == "inbound" else None
    return p.categorical_distribution(counts(spark, sf_dir, name), SPECS[name], codes)


def duplicates_of(spark, sf_dir, name):
    return p.duplicate_summary(view(spark, sf_dir, name), SPECS[name].key_columns)


def sequences_of(spark, sf_dir, name):
    return p.sequence_distribution(view(spark, sf_dir, name), SPECS[name])


def summary_of(spark, sf_dir, name):
    return p.table_summary(view(spark, sf_dir, name), SPECS[name], "2026-09-13")


def prof_columns(spark, sf_dir):
    return columns_of(spark, sf_dir, "inbound")


def prof_dates(spark, sf_dir):
    rows = over_tables(metrics_of, ("inbound", "homepage", "salesforce"))(spark, sf_dir)
    dated = rows.filter(F.col("column_role") == p.DATE_ROLE)
    return dated.select("table_name", "column_name", "parse_success_count", "parse_fail_count", "min_value", "max_value")


def prof_unusual(spark, sf_dir):
    return p.unusual_values(categories_of(spark, sf_dir, "inbound"))


def prof_duplicate_keys(spark, sf_dir):
    return p.duplicate_key_values(view(spark, sf_dir, "outbound"), ["LEAD_MGMT_NO", "TRY_CNT"])


def prof_integrated(spark, sf_dir):
    return p.integrated_summary(over_tables(duplicates_of)(spark, sf_dir), over_tables(sequences_of)(spark, sf_dir))


def prof_sequence_unparsable(spark, sf_dir):
    return p.sequence_distribution(view(spark, sf_dir, "inbound"), SPECS["inbound"], unparsable=True)


OTHER_LAYOUTS = ("MM/dd/yyyy", "yyyy-MM-dd H:mm", "d MMM yyyy")


def prof_dates_other_layouts(spark, sf_dir):
    """Order dates written in layouts that Spark's own parser reads."""
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    text = F.when(key == 0, F.date_format(day, "MM/dd/yyyy")).when(key == 1, F.date_format(day, "yyyy-MM-dd '7:05'"))
    text = text.when(key == 2, F.date_format(day, "d MMM yyyy")).otherwise("someday")
    rows = load(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", F.date_format(parse_any(F.col("text"), OTHER_LAYOUTS), "yyyy-MM-dd HH:mm").alias("read"))


QUERIES = {
    "prof_dates_other_layouts": prof_dates_other_layouts,
    "prof_columns": prof_columns,
    "prof_dates": prof_dates,
    "prof_formats": over_tables(formats_of, ("inbound", "homepage")),
    "prof_categorical": over_tables(categories_of, ("inbound",)),
    "prof_unusual": prof_unusual,
    "prof_duplicates": over_tables(duplicates_of, ("inbound", "outbound")),
    "prof_duplicate_keys": prof_duplicate_keys,
    "prof_sequence": over_tables(sequences_of, ("inbound", "homepage")),
    "prof_sequence_unparsable": prof_sequence_unparsable,
    "prof_summary": over_tables(summary_of),
    "prof_integrated": prof_integrated,
    "prof_integrated_columns": over_tables(metrics_of),
    "prof_integrated_categorical": over_tables(categories_of),
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_LAYOUTS = {
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "yyyy.MM.dd HH:mm:ss": "%Y.%m.%d %H:%M:%S",
    "yyyy/MM/dd HH:mm:ss": "%Y/%m/%d %H:%M:%S", "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
    "yyyy/MM/dd HH:mm": "%Y/%m/%d %H:%M", "yyyy/MM/dd": "%Y/%m/%d",
}


def _strict_parse(name: str, column: str) -> str:
    """Parse with the column's formats. One-digit months are refused first, since the SQL parser would take them."""
    formats = SPECS[name].date_formats.get(column)
    layouts = tuple(_LAYOUTS[f] for f in formats) if formats else t.PROFILE_LAYOUTS
    return rf"CASE WHEN NOT regexp_matches({column}, '/\d/|/\d($| )') THEN {t.parse(column, layouts)} END"


def _filled(column: str) -> str:
    return f"{column} IS NOT NULL AND trim({column}) <> ''"


def _label(name: str, column: str) -> str:
    role = SPECS[name].column_roles[column]
    if role == "DATE_DATETIME":
        whens = " ".join(f"WHEN regexp_matches(trim({column}), '{r}') THEN '{label}'" for r, label in fixed.DATE_FORMAT_LABELS)
        return f"CASE {whens} ELSE 'OTHER' END"
    pattern = r"^01[0-9]-[0-9]{3,4}-[0-9]{4}$" if role == "PHONE" else fixed.PROFILE_EMAIL_PATTERN
    return f"CASE WHEN regexp_matches(trim({column}), '{pattern}') THEN 'MATCH_PATTERN' ELSE 'UNMATCH_PATTERN' END"


def _text_view(name: str) -> str:
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SPECS[name].column_roles)
    return f"{name}_t AS (SELECT {casts} FROM {name})"


def _metrics_sql(name: str) -> str:
    parts = []
    for c, role in SPECS[name].column_roles.items():
        filled, dated = _filled(c), role == "DATE_DATETIME"
        ts = _strict_parse(name, c) if dated else "CAST(NULL AS TIMESTAMP)"
        low, high = (t.stamp(f"min({ts})"), t.stamp(f"max({ts})")) if dated else (f"min({c}) FILTER ({filled})", f"max({c}) FILTER ({filled})")
        if not dated and role not in p.RANGE_ROLES:
            low = high = "CAST(NULL AS VARCHAR)"

        def plain(expression: str, kind: str = "BIGINT", dated=dated) -> str:
            return f"CAST({'NULL' if dated else expression} AS {kind})"

        parts.append(f"""SELECT '{name}' AS table_name, '{c}' AS column_name, '{role}' AS column_role, count(*) AS total_count,
  count(*) FILTER ({c} IS NULL) AS null_count, {t.percent(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_ratio,
  count(*) FILTER ({c} IS NOT NULL AND trim({c}) = '') AS blank_count, {t.percent(f"count(*) FILTER ({c} IS NOT NULL AND trim({c}) = '')", 'count(*)')} AS blank_ratio,
  count(DISTINCT {c}) AS distinct_count, {t.percent(f'count(DISTINCT {c})', 'count(*)')} AS distinct_rate, {low} AS min_value, {high} AS max_value,
  {plain(f'min(length({c}))')} AS min_length, {plain(f'max(length({c}))')} AS max_length,
  {plain(f'floor(sum(length({c})) * 100.0::DOUBLE / count({c}) + 0.5::DOUBLE) / 100.0::DOUBLE', 'DOUBLE')} AS avg_length,
  CAST({f'count(*) FILTER ({filled} AND ({ts}) IS NOT NULL)' if dated else 'NULL'} AS BIGINT) AS parse_success_count,
  CAST({f'count(*) FILTER ({filled} AND ({ts}) IS NULL)' if dated else 'NULL'} AS BIGINT) AS parse_fail_count FROM {name}_t""")
    return "\nUNION ALL ".join(parts)


def _formats_sql(name: str) -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {_label(name, c)} AS format, count(*) AS count,
  {t.percent('count(*)', f'(SELECT count(*) FROM {name})')} AS ratio FROM {name}_t WHERE {_filled(c)} GROUP BY 1, 2, 3"""
        for c, role in SPECS[name].column_roles.items()
        if role in ("DATE_DATETIME", "PHONE", "EMAIL")
    ]
    return "\nUNION ALL ".join(parts)


def _categories_sql(name: str) -> str:
    parts, holders = [], ", ".join(f"'{v}'" for v in fixed.PLACEHOLDER_VALUES)
    for c, role in SPECS[name].column_roles.items():
        if role != "CODE":
            continue
        variants = SPECS[name].semantic_variants.get(c, ())
        variant = f"WHEN trim({c}) IN ({', '.join(repr(v) for v in variants)}) THEN 'SEMANTIC_VARIANT'" if variants else ""
        last = ""
        if name == "inbound" and c == "status":
            last = f"WHEN trim({c}) NOT IN ({', '.join(repr(v) for _, v in MASTER)}) THEN 'MASTER_UNMATCH'"
        elif c in SPECS[name].expected_patterns:
            last = f"WHEN NOT regexp_matches(trim({c}), '{SPECS[name].expected_patterns[c]}') THEN 'PATTERN_UNMATCH'"
        parts.append(f"""SELECT '{name}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS count, {t.percent('count(*)', f'(SELECT count(*) FROM {name})')} AS ratio,
  CASE WHEN {c} IS NULL THEN 'NULL' WHEN trim({c}) = '' THEN 'BLANK' WHEN trim({c}) IN ({holders}) THEN 'PLACEHOLDER' {variant}
       WHEN contains(trim({c}), '999') THEN 'RESERVED_CANDIDATE' {last} ELSE 'STANDARD_VALUE' END AS value_category FROM {name}_t GROUP BY {c}""")
    return "\nUNION ALL ".join(parts)


def _duplicates_sql(name: str) -> str:
    keys = SPECS[name].key_columns
    listed = ", ".join(keys)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{name}' AS table_name, unnest(['key_columns', 'row_count', 'distinct_row_count', 'row_duplicate_count', 'row_duplicate_ratio', 'key_null_count',
    'duplicate_key_value_count', 'duplicate_extra_count', 'max_duplicate_count']) AS metric,
  unnest(['{','.join(keys)}', CAST(n AS VARCHAR), CAST(d AS VARCHAR), CAST(n - d AS VARCHAR), CAST({t.percent('n - d', 'n')} AS VARCHAR), CAST(nulls AS VARCHAR),
    CAST(groups AS VARCHAR), CAST(extra AS VARCHAR), CAST(most AS VARCHAR)]) AS value
  FROM (SELECT count(*) AS n, count(*) FILTER ({missing}) AS nulls FROM {name}), (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM {name})),
    (SELECT count(*) AS groups, coalesce(sum(c - 1), 0)::BIGINT AS extra, coalesce(max(c), 0) AS most FROM (SELECT count(*) AS c FROM {name} GROUP BY {listed} HAVING count(*) > 1))"""


def _sequences_sql(name: str, unparsable: bool = False) -> str:
    parts = []
    for columns in SPECS[name].sequences:
        parsed = [_strict_parse(name, c) for c in columns]
        missing = " OR ".join(f"{c} IS NULL" for c in columns)
        chain = " AND ".join(f"({a}) <= ({b})" for a, b in zip(parsed, parsed[1:]))
        unread = f"WHEN {' OR '.join(f'({x}) IS NULL' for x in parsed)} THEN 'UNPARSABLE'" if unparsable else ""
        status = f"CASE WHEN {missing} THEN 'CONTAINS_NULL' WHEN {chain} THEN 'ORDERED' {unread} ELSE 'REVERSED' END"
        parts.append(f"""SELECT '{name}' AS table_name, '{' <= '.join(columns)}' AS target_columns, {status} AS sequence_status, count(*) AS count,
  {t.percent('count(*)', f'(SELECT count(*) FROM {name})')} AS ratio FROM {name} GROUP BY 3""")
    return "\nUNION ALL ".join(parts)


def _with(names, *ctes: str) -> str:
    return f"WITH {cte(*names)}, {', '.join(_text_view(n) for n in names)}" + "".join(f", {c}" for c in ctes)


def _union(build, names) -> str:
    return "\nUNION ALL ".join(build(n) for n in names)


_ALL = tuple(SPECS)
_TEXTS = """texts AS (SELECT column_name, '[' || string_agg('{''format'': ''' || format || ''', ''count'': ' || CAST(count AS VARCHAR) || ', ''ratio'': ' || CAST(ratio AS VARCHAR) || '}', ', ' ORDER BY count DESC, format) || ']' AS format_distribution FROM f GROUP BY 1)"""
ORACLES = {
    "prof_columns": f"""{_with(('inbound',), f"m AS ({_metrics_sql('inbound')})", f"f AS ({_formats_sql('inbound')})", _TEXTS)}
        SELECT m.* EXCLUDE (table_name), format_distribution FROM m LEFT JOIN texts USING (column_name)""",
    "prof_dates": f"""{_with(('inbound', 'homepage', 'salesforce'), f"m AS ({_union(_metrics_sql, ('inbound', 'homepage', 'salesforce'))})")}
        SELECT table_name, column_name, parse_success_count, parse_fail_count, min_value, max_value FROM m WHERE column_role = 'DATE_DATETIME'""",
    "prof_formats": f"{_with(('inbound', 'homepage'))} {_union(_formats_sql, ('inbound', 'homepage'))}",
    "prof_categorical": f"{_with(('inbound',))} {_categories_sql('inbound')}",
    "prof_unusual": f"""{_with(('inbound',), f"c AS ({_categories_sql('inbound')})")} SELECT * EXCLUDE (table_name) FROM c WHERE value_category NOT IN ('STANDARD_VALUE', 'NULL')""",
    "prof_duplicates": f"{_with(('inbound', 'outbound'))} {_union(_duplicates_sql, ('inbound', 'outbound'))}",
    "prof_duplicate_keys": f"WITH {cte('outbound')} SELECT LEAD_MGMT_NO, TRY_CNT, count(*) AS count FROM outbound GROUP BY 1, 2 HAVING count(*) > 1",
    "prof_sequence": f"{_with(('inbound', 'homepage'))} {_union(_sequences_sql, ('inbound', 'homepage'))}",
    "prof_sequence_unparsable": f"""{_with(('inbound',), f"s AS ({_sequences_sql('inbound', True)})")} SELECT * EXCLUDE (table_name) FROM s""",
    "prof_summary": f"WITH {cte(*_ALL)} "
    + "\nUNION ALL ".join(
        f"""SELECT '{n}' AS table_name, unnest(['table_name', 'row_count', 'column_count', 'business_key_columns', 'categorical_column_count', 'ingest_date']) AS metric,
        unnest(['{n}', CAST((SELECT count(*) FROM {n}) AS VARCHAR), (SELECT CAST(count(*) AS VARCHAR) FROM (FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {n} LIMIT 1) UNPIVOT INCLUDE NULLS (v FOR c IN (COLUMNS(*))))), '{','.join(SPECS[n].key_columns)}',
          '{len(SPECS[n].columns_with('CODE'))}', '2026-09-13']) AS value"""
        for n in _ALL
    ),
    "prof_integrated": f"""{_with(_ALL, f"d AS ({_union(_duplicates_sql, _ALL)})", f"s AS ({_union(_sequences_sql, _ALL)})")}
        SELECT table_name, CAST(max(value) FILTER (metric = 'row_count') AS BIGINT) AS row_count,
          CAST(max(value) FILTER (metric = 'duplicate_extra_count') AS BIGINT) AS duplicate_key_extra_count,
          CAST(max(value) FILTER (metric = 'key_null_count') AS BIGINT) AS key_null_count,
          CAST(coalesce((SELECT sum(count) FROM s WHERE s.table_name = d.table_name AND sequence_status = 'REVERSED'), 0) AS BIGINT) AS sequence_reversed_count
        FROM d GROUP BY table_name""",
    "prof_integrated_columns": f"{_with(_ALL)} {_union(_metrics_sql, _ALL)}",
    "prof_integrated_categorical": f"{_with(_ALL)} {_union(_categories_sql, _ALL)}",
}

ORACLES["prof_dates_other_layouts"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 4 = 1 THEN ' 07:05' ELSE ' 00:00' END END AS read
FROM orders"""
