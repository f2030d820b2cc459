"""Profiling of one table.

All column metrics come from one frame, `value_counts`: the columns are unpivoted and counted per (column, value)
once. Exact distinct counts need that shuffle anyway; null, length, date, format and category metrics then work on
distinct values instead of rows. Hot values are combined on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import any_of, is_filled, percent
from tidemark.functions.predicates import match_label, sequence_status, value_category
from tidemark.functions.temporal import format_label, parse_any
from tidemark.operators.keys import key_counts, rows_with_keys

RANGE_ROLES = ("GENERAL", "BUSINESS_KEY", "TECHNICAL_PK")
DATE_ROLE = "DATE_DATETIME"


@dataclass(frozen=True)
class TableProfile:
    """What to profile in one table. Roles: BUSINESS_KEY, TECHNICAL_PK, GENERAL, CODE, TEXT, DATE_DATETIME, PHONE, EMAIL."""

    table_name: str
    key_columns: list[str]
    column_roles: dict[str, str]
    date_formats: dict[str, tuple[str, ...]] = field(default_factory=dict)
    expected_patterns: dict[str, str] = field(default_factory=dict)
    semantic_variants: dict[str, tuple[str, ...]] = field(default_factory=dict)
    extra_placeholders: tuple[str, ...] = ()
    sequences: list[list[str]] = field(default_factory=list)

    def columns_with(self, *roles: str) -> list[str]:
        return [c for c, r in self.column_roles.items() if r in roles]


def value_counts(df: DataFrame, columns: list[str], text_columns: list[str] = ()) -> DataFrame:
    """(column_name, value, length, count) with every distinct value of every column, NULL included.

    Of text columns only lengths and the number of different values are wanted, so a wide hash stands for each text and
    no long text is shuffled. Blank texts stay what they are.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], columns, "column_name", "value").withColumn("length", F.length("value"))
    if text_columns:
        hidden = F.col("column_name").isin(*text_columns) & is_filled(F.col("value"))
        long = long.withColumn("value", F.when(hidden, F.sha2("value", 256)).otherwise(F.col("value")))
    return key_counts(long, ["column_name", "value", "length"])


def merged_counts(states: DataFrame) -> DataFrame:
    """Value counts of several batches as those of all their rows."""
    return states.groupBy("column_name", "value", "length").agg(F.sum("count").alias("count"))


def _by_column(choices: dict[str, Column], default: Column) -> Column:
    """Expression chosen by `column_name`; columns that share an expression share the branch."""
    out = None
    for name, expression in choices.items():
        hit = F.col("column_name") == name
        out = F.when(hit, expression) if out is None else out.when(hit, expression)
    return default if out is None else out.otherwise(default)


def _parsed(spec: TableProfile) -> Column:
    groups: dict[tuple, list[str]] = {}
    for name in spec.columns_with(DATE_ROLE):
        groups.setdefault(tuple(spec.date_formats.get(name, fixed.PROFILE_DATE_FORMATS)), []).append(name)
    out = None
    for formats, names in groups.items():
        hit, value = F.col("column_name").isin(*names), parse_any(F.col("value"), formats)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(None).cast("timestamp") if out is None else out


def _role(spec: TableProfile) -> Column:
    return _by_column({c: F.lit(r) for c, r in spec.column_roles.items()}, F.lit(None).cast("string"))


def column_metrics(counts: DataFrame, spec: TableProfile) -> DataFrame:
    """One row per column: counts, ratios, distinct values, lengths, value range, and date parse results."""
    value, n = F.col("value"), F.col("count")
    filled = is_filled(value)
    rows = counts.filter(F.col("column_name").isin(*spec.column_roles)).withColumn("parsed", _parsed(spec))
    sums = rows.groupBy("column_name").agg(
        F.sum("count").alias("total_count"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(value.isNotNull() & ~filled, n)), F.lit(0)).alias("blank_count"),
        F.count("value").alias("distinct_count"),
        F.min("length").cast("bigint").alias("shortest"),
        F.max("length").cast("bigint").alias("longest"),
        F.sum(F.col("length") * n).alias("text_length"),
        F.sum(F.when(value.isNotNull(), n)).alias("texts"),
        F.min(F.when(filled, value)).alias("lowest"),
        F.max(F.when(filled, value)).alias("highest"),
        F.coalesce(F.sum(F.when(filled & F.col("parsed").isNotNull(), n)), F.lit(0)).alias("parsed_rows"),
        F.coalesce(F.sum(F.when(filled & F.col("parsed").isNull(), n)), F.lit(0)).alias("unparsed_rows"),
        F.min("parsed").alias("earliest"),
        F.max("parsed").alias("latest"),
    )
    role, total = F.col("column_role"), F.col("total_count")
    dated, ranged = role == DATE_ROLE, role.isin(*RANGE_ROLES)
    stamp = "yyyy-MM-dd HH:mm:ss"
    return sums.withColumn("column_role", _role(spec)).select(
        "column_name",
        "column_role",
        "total_count",
        "null_count",
        percent(F.col("null_count"), total).alias("null_ratio"),
        "blank_count",
        percent(F.col("blank_count"), total).alias("blank_ratio"),
        "distinct_count",
        percent(F.col("distinct_count"), total).alias("distinct_rate"),
        F.when(dated, F.date_format("earliest", stamp)).when(ranged, F.col("lowest")).alias("min_value"),
        F.when(dated, F.date_format("latest", stamp)).when(ranged, F.col("highest")).alias("max_value"),
        F.when(~dated, F.col("shortest")).alias("min_length"),
        F.when(~dated, F.col("longest")).alias("max_length"),
        F.when(
            ~dated, F.floor(F.col("text_length") * F.lit(100.0) / F.col("texts") + F.lit(0.5)) / F.lit(100.0)
        ).alias("avg_length"),
        F.when(dated, F.col("parsed_rows")).alias("parse_success_count"),
        F.when(dated, F.col("unparsed_rows")).alias("parse_fail_count"),
    )


def format_distribution(counts: DataFrame, spec: TableProfile) -> DataFrame:
    """(column_name, format, count, ratio): date layouts of date columns, match labels of phone and e-mail columns."""
    value = F.col("value")
    dates, phones, emails = spec.columns_with(DATE_ROLE), spec.columns_with("PHONE"), spec.columns_with("EMAIL")
    name = F.col("column_name")
    label = (
        F.when(name.isin(*dates), format_label(value))
        .when(name.isin(*phones), match_label(value, fixed.PHONE_HYPHEN_PATTERN))
        .otherwise(match_label(value, fixed.PROFILE_EMAIL_PATTERN))
    )
    rows = counts.filter(name.isin(*dates, *phones, *emails))
    filled_rows = F.sum(F.when(is_filled(value), F.col("count")))
    labelled = rows.withColumn("format", F.when(is_filled(value), label))
    grouped = labelled.groupBy("column_name", "format").agg(
        filled_rows.alias("count"), F.sum("count").alias("rows")
    )
    totals = grouped.groupBy(F.col("column_name").alias("__c")).agg(F.sum("rows").alias("__total"))
    joined = grouped.filter(F.col("format").isNotNull()).join(totals, F.col("column_name") == F.col("__c"))
    return joined.select("column_name", "format", "count", percent(F.col("count"), F.col("__total")).alias("ratio"))


def format_texts(formats: DataFrame) -> DataFrame:
    """One text per column listing its formats, most frequent first. There are only a few labels per column."""
    entry = F.concat(
        F.lit("{'format': '"), F.col("format"), F.lit("', 'count': "), F.col("count").cast("string"),
        F.lit(", 'ratio': "), F.col("ratio").cast("string"), F.lit("}"),
    )
    listed = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("o"), "format", entry.alias("e"))))
    text = F.array_join(F.transform(listed, lambda x: x["e"]), ", ")
    return formats.groupBy("column_name").agg(
        F.concat(F.lit("["), text, F.lit("]")).alias("format_distribution")
    )


def column_profile(counts: DataFrame, spec: TableProfile) -> DataFrame:
    """Column metrics with the format text."""
    texts = format_texts(format_distribution(counts, spec))
    return column_metrics(counts, spec).join(texts, "column_name", "left")


def categorical_distribution(counts: DataFrame, spec: TableProfile, code_master: DataFrame | None = None) -> DataFrame:
    """(column_name, value, count, ratio, value_category) of every code column.

    `code_master` has (CODE_GROUP_ID, CODE_VALUE) with the column name as group. A column with a master is checked
    against it, any other against its expected pattern.
    """
    codes = spec.columns_with("CODE")
    rows = counts.filter(F.col("column_name").isin(*codes))
    totals = rows.groupBy(F.col("column_name").alias("__c")).agg(F.sum("count").alias("__total"))
    out = rows.join(totals, F.col("column_name") == F.col("__c"))
    text = F.trim("value")
    if code_master is None:
        has_master, known = F.lit(False), F.lit(False)
    else:
        master = code_master.select(F.col("CODE_GROUP_ID").alias("__g"), F.col("CODE_VALUE").alias("__v")).distinct()
        groups = master.select(F.col("__g").alias("__has")).distinct()
        out = out.join(master, (F.col("column_name") == F.col("__g")) & (text == F.col("__v")), "left")
        out = out.join(groups, F.col("column_name") == F.col("__has"), "left")
        has_master, known = F.col("__has").isNotNull(), F.col("__v").isNotNull()
    patterns = {c: ~text.rlike(p) for c, p in spec.expected_patterns.items() if c in codes}
    off_pattern = _by_column(patterns, F.lit(False))
    variants = {c: text.isin(*v) for c, v in spec.semantic_variants.items() if c in codes}
    unmatched = F.when(has_master, F.when(~known, F.lit("MASTER_UNMATCH"))).when(off_pattern, F.lit("PATTERN_UNMATCH"))
    placeholders = (*fixed.PLACEHOLDER_VALUES, *spec.extra_placeholders)
    category = value_category(F.col("value"), _by_column(variants, F.lit(False)), unmatched, placeholders)
    return out.select(
        "column_name",
        "value",
        "count",
        percent(F.col("count"), F.col("__total")).alias("ratio"),
        category.alias("value_category"),
    )


def unusual_values(distribution: DataFrame) -> DataFrame:
    """Code values worth a look, frequent ones first within their column."""
    rows = distribution.filter(~F.col("value_category").isin("STANDARD_VALUE", "NULL"))
    return rows.orderBy("column_name", F.desc("count"), "value")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, count) of the keys with more than one row; both duplicate profiles can be made from it."""
    return key_counts(df, keys).filter(F.col("count") > 1)


def duplicate_key_values(df: DataFrame, keys: list[str], repeated: DataFrame | None = None) -> DataFrame:
    """Repeated keys with their row counts, most frequent first. `repeated` has the `repeated_keys`, where they are known."""
    found = repeated_keys(df, keys) if repeated is None else repeated
    return found.orderBy(F.desc("count"), *keys)


def duplicate_summary(df: DataFrame, keys: list[str], repeated: DataFrame | None = None) -> DataFrame:
    """(metric, value) rows about repeated rows and keys.

    Rows that are equal as a whole also share their key, so only rows with a repeated key are compared as a whole;
    the others are distinct by definition and only their narrow keys are shuffled. `repeated` has the `repeated_keys`,
    where they are known: then no key is counted again.
    """
    found = repeated_keys(df, keys) if repeated is None else repeated
    shared = rows_with_keys(df, keys, found.select(*keys))
    whole = shared.distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    sums = found.agg(
        F.struct(
            F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.max("count"), F.lit(0)).alias("most"),
        ).alias("s")
    ).scalar()
    missing = any_of([F.col(k).isNull() for k in keys])
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(missing).alias("key_null_count")).withColumn("s", sums)
    metrics = {
        "distinct_row_count": F.col("row_count") - F.col("s.rows") + whole,
        "duplicate_key_value_count": F.col("s.keys"),
        "duplicate_extra_count": F.col("s.rows") - F.col("s.keys"),
        "max_duplicate_count": F.col("s.most"),
    }
    return _duplicate_metrics(totals.withColumns(metrics), keys)


def row_states(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_digest, count): what a batch adds to the duplicates of a table, with a digest in place of each row."""
    digest = F.unhex(F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256))
    return key_counts(df.select(*keys, digest.alias("row_digest")), [*keys, "row_digest"])


def merged_duplicates(states: DataFrame, keys: list[str]) -> DataFrame:
    """`duplicate_summary` of all rows of several batches, from their row states."""
    rows = states.groupBy(*keys, "row_digest").agg(F.sum("count").alias("count"))
    counts = rows.groupBy(*keys).agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("__different"))
    totals = _key_totals(counts, keys, F.coalesce(F.sum("__different"), F.lit(0)).alias("distinct_row_count"))
    return _duplicate_metrics(totals, keys)


def merged_key_values(states: DataFrame, keys: list[str]) -> DataFrame:
    """`duplicate_key_values` of all rows of several batches."""
    counts = states.groupBy(*keys).agg(F.sum("count").alias("count"))
    return counts.filter(F.col("count") > 1).orderBy(F.desc("count"), *keys)


def _key_totals(counts: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Sums over (keys, n), one row per key."""
    repeated = F.col("n") > 1
    missing = any_of([F.col(k).isNull() for k in keys])
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(~repeated).alias("single_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("key_null_count"),
        F.count_if(repeated).alias("duplicate_key_value_count"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("duplicate_extra_count"),
        F.coalesce(F.max(F.when(repeated, F.col("n"))), F.lit(0)).alias("max_duplicate_count"),
        *more,
    )


def _duplicate_metrics(totals: DataFrame, keys: list[str]) -> DataFrame:
    out = totals.withColumn("row_duplicate_count", F.col("row_count") - F.col("distinct_row_count"))
    out = out.withColumn("row_duplicate_ratio", percent(F.col("row_duplicate_count"), F.col("row_count")))
    metrics = [
        "row_count", "distinct_row_count", "row_duplicate_count", "row_duplicate_ratio", "key_null_count",
        "duplicate_key_value_count", "duplicate_extra_count", "max_duplicate_count",
    ]
    rows = [F.struct(F.lit("key_columns").alias("metric"), F.lit(",".join(keys)).alias("value"))]
    rows += [F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value")) for m in metrics]
    return out.select(F.inline(F.array(*rows)))


def sequence_distribution(df: DataFrame, spec: TableProfile, unparsable: bool = False) -> DataFrame:
    """(target_columns, sequence_status, count, ratio) of every date sequence, all in one pass."""
    return sequence_ratios(sequence_counts(df, spec, unparsable))


def sequence_counts(df: DataFrame, spec: TableProfile, unparsable: bool = False) -> DataFrame:
    """(target_columns, sequence_status, count); counts of several batches add up."""
    entries = [
        F.struct(
            F.lit(" <= ".join(s)).alias("target_columns"),
            sequence_status(s, spec.date_formats, unparsable).alias("sequence_status"),
        )
        for s in spec.sequences
    ]
    return df.select(F.inline(F.array(*entries))).groupBy("target_columns", "sequence_status").agg(
        F.count(F.lit(1)).alias("count")
    )


def sequence_ratios(counts: DataFrame) -> DataFrame:
    """The distribution from the sequence counts of one or several batches."""
    grouped = counts.groupBy("target_columns", "sequence_status").agg(F.sum("count").alias("count"))
    totals = grouped.groupBy(F.col("target_columns").alias("__t")).agg(F.sum("count").alias("__total"))
    joined = grouped.join(totals, F.col("target_columns") == F.col("__t"))
    ratio = percent(F.col("count"), F.col("__total")).alias("ratio")
    return joined.select("target_columns", "sequence_status", "count", ratio)


def table_summary(df: DataFrame, spec: TableProfile, batch: str) -> DataFrame:
    """(metric, value) rows describing the profiled table."""
    values = {
        "table_name": F.lit(spec.table_name),
        "row_count": F.count(F.lit(1)).cast("string"),
        "column_count": F.lit(str(len(df.columns))),
        "business_key_columns": F.lit(",".join(spec.key_columns)),
        "categorical_column_count": F.lit(str(len(spec.columns_with("CODE")))),
        "ingest_date": F.lit(batch),
    }
    wide = df.agg(*[v.alias(m) for m, v in values.items()])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in values])))


def integrated_summary(duplicates: DataFrame, sequences: DataFrame) -> DataFrame:
    """One row per table from the (table_name, metric, value) and (table_name, sequence_status, count) results."""
    wanted = ["row_count", "duplicate_extra_count", "key_null_count"]
    pivoted = duplicates.groupBy("table_name").pivot("metric", wanted).agg(F.first("value"))
    reversed_rows = sequences.groupBy("table_name").agg(
        F.coalesce(F.sum(F.when(F.col("sequence_status") == "REVERSED", F.col("count"))), F.lit(0)).alias("r")
    )
    joined = pivoted.join(reversed_rows, "table_name", "left")

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("bigint"), F.lit(0))

    return joined.select(
        "table_name",
        number("row_count").alias("row_count"),
        number("duplicate_extra_count").alias("duplicate_key_extra_count"),
        number("key_null_count").alias("key_null_count"),
        number("r").alias("sequence_reversed_count"),
    )
