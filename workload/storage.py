"""Files and tables: every query writes to shared scratch with the operators under test and reads the result back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import joined_or_null
from tidemark.operators import profile as p
from tidemark.operators.validation import TRACE_LINEAGE
from tidemark.plans.layout import Layout
from tidemark.plans.mapping import MappingRun
from tidemark.session import scratch_dir
from tidemark.sources import files, tables, zones
from workload import mapping as wm
from workload import profiling as wp
from workload.views import cte, sessions, view

BATCH = "ingest_date"


def csv_folder(spark, sf_dir) -> tuple[str, list[str]]:
    """Inbound records as dated CSV folders."""
    rows, path = view(spark, sf_dir, "inbound"), scratch_dir(spark)
    writer = rows.write.partitionBy(BATCH).option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path, [c for c in rows.columns if c != BATCH]


def src_csv_roundtrip(spark, sf_dir):
    path, columns = csv_folder(spark, sf_dir)
    return files.read_csv_batches(spark, path, columns, latest_only=False)


def latest_batch_scan(spark, sf_dir):
    path, columns = csv_folder(spark, sf_dir)
    return files.read_csv_batches(spark, path, columns)


def src_batch_of_path(spark, sf_dir):
    path, columns = csv_folder(spark, sf_dir)
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).schema(files.text_schema(columns)).csv(path)
    return rows.groupBy(files.batch_of_path().alias("batch")).agg(F.count(F.lit(1)).alias("rows"))


def src_json_leaf(spark, sf_dir):
    """A number out of JSON text, and the text written again from its parts."""
    rows = view(spark, sf_dir, "salesforce").withColumn("props", F.from_json("Consult_Content__c", "k BIGINT"))
    return rows.select(
        "Consultation_No__c", F.col("props.k").alias("k"), F.get_json_object("Consult_Content__c", "$.k").alias("k_text"),
        F.to_json("props").alias("again"),
    )


def src_nested_flatten(spark, sf_dir):
    nested, path = sessions(spark, sf_dir), scratch_dir(spark)
    nested.write.json(path)
    return files.read_sessions(spark, path, nested.schema, multi_line=False)


def table(spark, sf_dir, name: str, partition_by: list[str] = ()) -> str:
    """A view as a table of its own in scratch."""
    target = f"{tables.scratch_database(spark)}.{name}"
    tables.append(view(spark, sf_dir, name), target, partition_by)
    return target


def sink_batch_replace(spark, sf_dir):
    """One batch gets fewer rows, one becomes empty, the third stays."""
    target = table(spark, sf_dir, "inbound", [BATCH])
    rows = view(spark, sf_dir, "inbound")
    tables.replace_batch(rows.filter("ingest_date = '2026-09-14' AND customer_id % 2 = 0"), target, {BATCH: "2026-09-14"})
    tables.replace_batch(rows.filter(F.lit(False)), target, {BATCH: "2026-09-15"})
    return spark.table(target)


def sink_dynamic_replace(spark, sf_dir):
    """Only the partitions that occur in the new rows are replaced."""
    target = table(spark, sf_dir, "inbound", [BATCH])
    rows = view(spark, sf_dir, "inbound").filter("ingest_date = '2026-09-13'")
    tables.replace_batches(rows.filter("customer_id % 3 = 0"), target, [BATCH])
    return spark.table(target)


def sink_drop_batch(spark, sf_dir):
    target = table(spark, sf_dir, "inbound", [BATCH])
    tables.drop_batch(spark, target, {BATCH: "2026-09-13"})
    return spark.table(target).groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))


def sink_append_widening(spark, sf_dir):
    """A second append brings a new column; older rows have NULL there."""
    target = table(spark, sf_dir, "product")
    more = view(spark, sf_dir, "product_later").withColumn("ORIGIN", F.lit("later"))
    tables.append(more, target)
    return spark.table(target)


def sink_pk_upsert(spark, sf_dir):
    target = table(spark, sf_dir, "product")
    later = view(spark, sf_dir, "product_later")
    gone = later.filter("STD_CATEGORY IS NULL")
    tables.upsert(later.filter("STD_CATEGORY IS NOT NULL"), target, ["STD_PRODUCT_CODE"], removed=gone)
    return spark.table(target)


def sink_bucket_upsert(spark, sf_dir):
    """The same upsert into a table that is partitioned by key, where only touched partitions are rewritten."""
    target = f"{tables.scratch_database(spark)}.product"
    key = ["STD_PRODUCT_CODE"]
    tables.append(tables.with_key_bucket(view(spark, sf_dir, "product"), key, 8), target, [tables.KEY_BUCKET])
    later = tables.with_key_bucket(view(spark, sf_dir, "product_later"), key, 8)
    gone = later.filter("STD_CATEGORY IS NULL")
    tables.upsert(later.filter("STD_CATEGORY IS NOT NULL"), target, key, removed=gone)
    return spark.table(target).drop(tables.KEY_BUCKET)


def sink_zone_upsert(spark, sf_dir):
    """The same upsert into a table that is laid out by key ranges, small ones here so that there are several."""
    target, key = f"{tables.scratch_database(spark)}.product", ["STD_PRODUCT_CODE"]
    zones.upsert(view(spark, sf_dir, "product"), target, key, zone_rows=100)
    later = view(spark, sf_dir, "product_later")
    zones.upsert(later.filter("STD_CATEGORY IS NOT NULL"), target, key, later.filter("STD_CATEGORY IS NULL"), zone_rows=100)
    return spark.table(target).drop(zones.ZONE)


def sink_staged_swap(spark, sf_dir):
    """A table is overwritten with a frame that reads it."""
    target = table(spark, sf_dir, "product")
    rows = spark.table(target).filter("STD_CATEGORY <> 'ECONOMY'")
    return tables.overwrite_staged(rows.withColumn("STD_PRODUCT_NAME", F.upper("STD_PRODUCT_NAME")), target)


def sink_selective_replace(spark, sf_dir):
    """Rows of one class are replaced; unknown columns are dropped and missing ones are NULL."""
    target = table(spark, sf_dir, "product")
    rows = view(spark, sf_dir, "product_later").filter("PRODUCT_CLASS = 'Brand#1'")
    tables.replace_where(rows.drop("STD_CATEGORY").withColumn("UNKNOWN", F.lit(1)), target, F.col("PRODUCT_CLASS") == "Brand#1")
    return spark.table(target)


def sink_delete_where(spark, sf_dir):
    target = table(spark, sf_dir, "inbound", [BATCH])
    tables.delete_where(spark, target, F.col("status") == "PENDING")
    return spark.table(target)


def sink_snapshot(spark, sf_dir):
    target = table(spark, sf_dir, "homepage")
    return tables.snapshot(spark, target, f"{target}_copy")


def sink_csv_export(spark, sf_dir):
    """A profile result as table and as CSV export; the export is read back."""
    spec = wp.SPECS["outbound"]
    result = p.categorical_distribution(wp.counts(spark, sf_dir, "outbound"), spec)
    target, path = f"{tables.scratch_database(spark)}.categories", scratch_dir(spark)
    tables.append(result, target)
    files.export_csv(spark.table(target), path)
    rows = files.read_csv(spark, path, result.columns)
    return rows.withColumns({"count": F.col("count").cast("bigint"), "ratio": F.col("ratio").cast("double")})


def sink_mapped_split(spark, sf_dir):
    """Mapped rows of one source and batch, split into candidates and conversion errors, saved twice."""
    layout = Layout(tables.scratch_database(spark))
    for stage in ("gold_candidate", "gold_mapping_error"):
        tables.ensure_database(spark, layout.database(stage), scratch_dir(spark))
    run = MappingRun(spark, layout, wm.model_frame(spark), wm.rule_frame(spark), wm.code_frame(spark))
    rows = wm.mapped(spark, sf_dir, "INBOUND").filter("_source_batch_id = '2026-09-14'")
    for _ in range(2):  # the second save replaces the first
        run.save(rows, "COUNSEL", "inbound", "2026-09-14")
    out = None
    for stage in ("gold_candidate", "gold_mapping_error"):
        saved = spark.table(layout.table(stage, "COUNSEL")).select(
            F.lit(stage).alias("stage"), *TRACE_LINEAGE, "CNSL_ST_CD", joined_or_null(F.col("_map_errors")).alias("errors")
        )
        out = saved if out is None else out.unionByName(saved)
    return out


def meta_split_files(spark, sf_dir):
    """Metadata that comes as a folder of files, each with a header, numbered through."""
    path = scratch_dir(spark)
    rows = view(spark, sf_dir, "product").repartitionByRange(5, "STD_PRODUCT_CODE").sortWithinPartitions("STD_PRODUCT_CODE")
    rows.write.option("header", True).csv(path)
    return files.read_metadata_csv(spark, path, ordinal="ORDINAL", key="STD_PRODUCT_CODE")


QUERIES = {
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_json_leaf": src_json_leaf,
    "src_nested_flatten": src_nested_flatten,
    "src_batch_of_path": src_batch_of_path,
    "latest_batch_scan": latest_batch_scan,
    "meta_split_files": meta_split_files,
    "sink_append_widening": sink_append_widening,
    "sink_batch_replace": sink_batch_replace,
    "sink_dynamic_replace": sink_dynamic_replace,
    "sink_drop_batch": sink_drop_batch,
    "sink_delete_where": sink_delete_where,
    "sink_pk_upsert": sink_pk_upsert,
    "sink_bucket_upsert": sink_bucket_upsert,
    "sink_zone_upsert": sink_zone_upsert,
    "sink_staged_swap": sink_staged_swap,
    "sink_selective_replace": sink_selective_replace,
    "sink_snapshot": sink_snapshot,
    "sink_csv_export": sink_csv_export,
    "sink_mapped_split": sink_mapped_split,
}

# ---- checking SQL ----------------------------------------------------------------------------------------------

_NAMES = ["consultation_id", "status", "consultation_type", "started_at", "ended_at", "phone_number", "email", "customer_id",
          "customer_name", "policy_id", "premium", "ingest_date"]
# A blank CSV cell is read as NULL.
_TEXT = ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in _NAMES)
_GIVEN = {"session_id": "'CHAT-' || conv_id || '-' || turn", "channel": "'APP'", "duration_seconds": "CAST(turn AS VARCHAR)",
          "is_logged_in": "CASE WHEN conv_id % 2 = 0 THEN 'true' ELSE 'false' END",
          "resolution": "'{\"turns\":' || turn || ',\"state\":\"done\"}'"}
_HEAD = ", ".join(f"{_GIVEN.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in files.SESSION_HEAD)
ORACLES = {
    "src_csv_roundtrip": f"WITH {cte('inbound')} SELECT {_TEXT} FROM inbound",
    "src_json_leaf": f"""WITH {cte('salesforce')} SELECT Consultation_No__c, CAST(json_extract_string(Consult_Content__c, '$.k') AS BIGINT) AS k,
        json_extract_string(Consult_Content__c, '$.k') AS k_text, '{{"k":' || json_extract_string(Consult_Content__c, '$.k') || '}}' AS again FROM salesforce""",
    "src_nested_flatten": f"""WITH n AS (SELECT conv_id, turn, unnest(CASE WHEN turn > 0 THEN range(1, turn + 1) ELSE [NULL] END) AS step FROM conversations),
        q AS (SELECT conv_id, turn, role, unnest(CASE WHEN role <> 'system' THEN string_split(text, chr(10)) ELSE [NULL] END) AS line FROM conversations)
        SELECT {_HEAD}, CAST(step AS VARCHAR) AS nav_step, CASE WHEN step IS NOT NULL THEN role END AS nav_menu_level,
          CASE WHEN step IS NOT NULL THEN 'menu ' || step END AS nav_menu_name, CASE WHEN step IS NOT NULL THEN '/' || role || '/' || step END AS nav_full_path,
          CASE WHEN step IS NOT NULL THEN '2026-09-13T09:00:00+09:00' END AS nav_timestamp, line AS user_query,
          CASE WHEN line IS NOT NULL THEN CASE WHEN length(line) % 4 = 0 THEN 'true' ELSE 'false' END END AS query_matched,
          CASE WHEN line IS NOT NULL THEN '["' || role || '","x"]' END AS query_matched_items,
          CASE WHEN line IS NOT NULL THEN '2026-09-13T09:01:00+09:00' END AS query_timestamp
        FROM n JOIN q USING (conv_id, turn)""",
    "src_batch_of_path": f"WITH {cte('inbound')} SELECT ingest_date AS batch, count(*) AS rows FROM inbound GROUP BY 1",
    "latest_batch_scan": f"WITH {cte('inbound')} SELECT {_TEXT} FROM inbound WHERE ingest_date = (SELECT max(ingest_date) FROM inbound)",
    "meta_split_files": f"""WITH {cte('product')} SELECT CAST(row_number() OVER (ORDER BY STD_PRODUCT_CODE) AS VARCHAR) AS ORDINAL, * FROM product""",
    "sink_append_widening": f"""WITH {cte('product', 'product_later')} SELECT *, CAST(NULL AS VARCHAR) AS ORIGIN FROM product UNION ALL SELECT *, 'later' FROM product_later""",
    "sink_batch_replace": f"""WITH {cte('inbound')} SELECT * FROM inbound WHERE ingest_date = '2026-09-13' OR (ingest_date = '2026-09-14' AND customer_id % 2 = 0)""",
    "sink_dynamic_replace": f"""WITH {cte('inbound')} SELECT * FROM inbound WHERE ingest_date <> '2026-09-13' OR customer_id % 3 = 0""",
    "sink_drop_batch": f"WITH {cte('inbound')} SELECT ingest_date, count(*) AS rows FROM inbound WHERE ingest_date <> '2026-09-13' GROUP BY 1",
    "sink_delete_where": f"WITH {cte('inbound')} SELECT * FROM inbound WHERE status IS NULL OR status <> 'PENDING'",
    "sink_pk_upsert": f"""WITH {cte('product', 'product_later')} SELECT * FROM product WHERE STD_PRODUCT_CODE NOT IN (SELECT STD_PRODUCT_CODE FROM product_later)
        UNION ALL SELECT * FROM product_later WHERE STD_CATEGORY IS NOT NULL""",
    "sink_bucket_upsert": f"""WITH {cte('product', 'product_later')} SELECT * FROM product WHERE STD_PRODUCT_CODE NOT IN (SELECT STD_PRODUCT_CODE FROM product_later)
        UNION ALL SELECT * FROM product_later WHERE STD_CATEGORY IS NOT NULL""",
    "sink_staged_swap": f"WITH {cte('product')} SELECT * REPLACE (upper(STD_PRODUCT_NAME) AS STD_PRODUCT_NAME) FROM product WHERE STD_CATEGORY <> 'ECONOMY'",
    "sink_selective_replace": f"""WITH {cte('product', 'product_later')} SELECT * FROM product WHERE PRODUCT_CLASS <> 'Brand#1'
        UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS STD_CATEGORY) FROM product_later WHERE PRODUCT_CLASS = 'Brand#1'""",
    "sink_snapshot": f"WITH {cte('homepage')} SELECT * FROM homepage",
    "sink_csv_export": f"{wp._with(('outbound',))} SELECT * EXCLUDE (table_name) FROM ({wp._categories_sql('outbound')})",
    "sink_mapped_split": f"""{wm._INB} SELECT CASE WHEN _map_errors IS NULL THEN 'gold_candidate' ELSE 'gold_mapping_error' END AS stage, {', '.join(TRACE_LINEAGE)}, CNSL_ST_CD, _map_errors AS errors
        FROM inb WHERE _source_batch_id = '2026-09-14'""",
}

ORACLES["sink_zone_upsert"] = ORACLES["sink_bucket_upsert"]
