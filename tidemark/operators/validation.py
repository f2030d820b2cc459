"""Target constraints: derived from the model, checked on every row, with repair of repeated primary keys."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions import predicates
from tidemark.functions.columns import is_filled, labels_where
from tidemark.operators.keys import (
    duplicate_keys,
    filter_of,
    flag_duplicates,
    flag_like,
    flag_members,
    flag_rows_with_keys,
    is_full,
    key_counts,
    number_rows,
    rows_with_keys,
    with_unique_id,
)
from tidemark.operators.model import TargetModel
from tidemark.session import compact, materialize

# Rows of one key that a window may hold; keys with more are numbered in another way.
GROUP_ROWS = 1000
# Rows that a task of this window sorts, few enough for memory. More rows make more tasks, so none of them spills.
TASK_ROWS = 1_000_000
TRACE_LINEAGE = ["_source_system", "_source_table", "_source_record_key", "_source_batch_id"]


@dataclass(frozen=True)
class TargetRule:
    rule_id: str
    kind: str  # NOT_NULL, UNIQUE, LENGTH, DOMAIN, ORDER, FK
    columns: tuple[str, ...]
    argument: object = None


@dataclass(frozen=True)
class PrimaryKeyRepair:
    """Repeated keys of one source get a numbered suffix. Rows of other sources keep their key."""

    column: str
    source: str
    order_by: str = "_source_record_key"
    suffix: str = "-DUP"


@dataclass
class Validated:
    frame: DataFrame  # all rows with `_violations`
    rules: list[TargetRule]
    skipped: list[dict] = field(default_factory=list)  # foreign keys whose parent does not exist yet


def derive_rules(model: TargetModel, table: str, business_order: list[tuple[str, str, str]] = ()) -> list[TargetRule]:
    """Rules of a table from its model rows; `business_order` adds (rule id, earlier column, later column)."""
    rules = []
    for column in model.columns(table):
        name = f"VR-{table.upper()}-{column.position:03d}"
        own = (column.name,)
        if not column.nullable:
            rules.append(TargetRule(f"{name}-NOTNULL", "NOT_NULL", own))
        if {"PK", "UK"} & set(column.keys):
            rules.append(TargetRule(f"{name}-UNIQUE", "UNIQUE", own))
        if column.max_length is not None:
            rules.append(TargetRule(f"{name}-LENGTH", "LENGTH", own, column.max_length))
        if column.domain:
            rules.append(TargetRule(f"{name}-DOMAIN", "DOMAIN", own, column.domain))
    rules += [TargetRule(rule_id, "ORDER", (a, b)) for rule_id, a, b in business_order]
    for column in model.columns(table):
        if "FK" not in column.keys:
            continue
        if column.reference is None:
            raise ValueError(f"{table}.{column.name} is a foreign key but its description names no TABLE.COLUMN")
        rules.append(
            TargetRule(f"VR-{table.upper()}-{column.position:03d}-FK", "FK", (column.name,), column.reference)
        )
    return rules


def _row_condition(rule: TargetRule) -> Column:
    c = F.col(rule.columns[0])
    if rule.kind == "NOT_NULL":
        return predicates.not_null_violation(c)
    if rule.kind == "LENGTH":
        return predicates.length_violation(c, rule.argument)
    if rule.kind == "DOMAIN":
        return predicates.domain_violation(c, rule.argument)
    return predicates.order_violation(c, F.col(rule.columns[1]))


def with_violations(
    df: DataFrame,
    rules: list[TargetRule],
    parents: dict[str, DataFrame],
    keys_of: DataFrame | None = None,
    known: dict[str, str] | None = None,
) -> DataFrame:
    """Add `_violations`, the ids of all broken rules. Uniqueness and foreign keys are joins with the sets of wrong keys.

    These sets are made of keys alone and written to scratch, so the planner knows their size: it sends a small one to the
    rows, and only a large one makes the rows travel. The keys may be read from another frame with the same ones, `keys_of`. `known`
    names, per column, a flag that the rows have already where a filled value of it occurs more than once.
    """
    out, flagged, helpers = df, [], []
    keys_of, known = df if keys_of is None else keys_of, known or {}
    for i, rule in enumerate(rules):
        flag = f"__rule{i}"
        column = rule.columns[0]
        if rule.kind == "UNIQUE" and column in known:
            flagged.append((rule.rule_id, F.col(known[column])))
            continue
        if rule.kind == "UNIQUE":
            repeated = materialize(duplicate_keys(keys_of, [column], filled_only=True))
            out = flag_rows_with_keys(out, [column], repeated, flag)
        elif rule.kind == "FK":
            table, key = rule.argument
            given = keys_of.select(column).filter(F.col(column).isNotNull()).distinct()
            parent = parents[table].select(F.col(key).alias("__parent"))
            orphans = materialize(given.join(parent, F.col(column) == F.col("__parent"), "left_anti"))
            out = flag_members(out, F.col(column), orphans, flag, unique=True)
            out = out.withColumn(flag, F.col(column).isNotNull() & F.col(flag))
        else:
            flagged.append((rule.rule_id, _row_condition(rule)))
            continue
        helpers.append(flag)
        flagged.append((rule.rule_id, F.col(flag)))
    return out.withColumn("_violations", labels_where(flagged)).drop(*helpers)


def _meeting(candidates: DataFrame, pk: str, suffix: str) -> tuple[list[DataFrame], DataFrame, DataFrame | None]:
    """Rows with a key of their own, rows that may share theirs, and of those the ones that a window should not get.

    Keys that differ only in numbered suffixes count as one, as a repaired key may equal one that is there already. Of a key
    only a hash is exchanged. The last part are the rows of large groups, and those that meet such a suffix.
    """
    root = F.regexp_replace(F.col(pk).cast("string"), rf"(?:{re.escape(suffix)}[0-9]+)+\z", "")
    short = F.xxhash64(root)
    marked = candidates.select(short.alias("__short"), (root != F.col(pk).cast("string")).alias("__numbered"))
    counts = marked.groupBy("__short").agg(F.count(F.lit(1)).alias("__n"), F.max("__numbered").alias("__numbered"))
    special, seen = (F.col("__n") > GROUP_ROWS) | (F.col("__numbered") & (F.col("__n") > 1)), Observation()
    found = (F.count_if(special).alias("special"), F.sum(F.when(F.col("__n") > 1, F.col("__n"))).alias("rows"))
    sent = filter_of(counts.observe(seen, *found).filter("__n > 1").select("__short"))
    alone, shared = [], candidates
    if not is_full(sent):
        flagged = flag_like(candidates, short, sent, "__like")
        alone, shared = [flagged.filter("NOT __like").drop("__like")], flagged.filter("__like").drop("__like")
    tasks = -(-(seen.get["rows"] or 0) // TASK_ROWS)
    if tasks > int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        shared = shared.repartition(tasks, pk)
    if not seen.get["special"]:
        return alone, shared, None
    apart = materialize(counts.filter(special).select("__short"))
    shared = shared.withColumn("__short", short)
    parts = [rows_with_keys(shared, ["__short"], apart, how).drop("__short") for how in ("left_anti", "left_semi")]
    return alone, *parts


def repair_primary_keys(df: DataFrame, repair: PrimaryKeyRepair, flag: str | None = None) -> DataFrame:
    """Number the rows behind a repeated key, rows of other sources first, and suffix the later rows of the source.

    Adds `_remediated_<pk>` with the key before the change and, where a name is given for it, a `flag`: does the key still occur more than
    once. Rows with a key of their own stay in place. The others meet once, in a window over groups of at most `GROUP_ROWS` rows; rows
    of a larger group are numbered over several partitions. The frame is read twice.
    """
    pk, audit = repair.column, f"_remediated_{repair.column}"
    if flag and not re.search(r"[^0-9]$", repair.suffix):  # a repaired key does not tell where its number begins
        return flag_duplicates(materialize(repair_primary_keys(df, repair)), [pk], flag, filled_only=True)
    columns = df.columns
    filled = is_filled(F.col(pk))
    own = F.coalesce(F.col("_source_system") == repair.source, F.lit(False)).cast("int")
    alone, shared, apart = _meeting(df.filter(filled), pk, repair.suffix)

    def fixed(ranked: DataFrame, also: list[str] = ()) -> DataFrame:
        change = (F.col("__own") == 1) & (F.col("__rank") > 1)
        key = F.concat(F.col(pk), F.lit(repair.suffix), F.col("__rank").cast("string"))
        return ranked.withColumns({audit: F.when(change, F.col(pk)), pk: F.when(change, key).otherwise(F.col(pk))}).select(
            *columns, audit, *also
        )

    group = Window.partitionBy(pk)
    order = group.orderBy("__own", repair.order_by, F.xxhash64(*columns))
    ranked = shared.withColumn("__own", own).withColumn("__rank", F.row_number().over(order).cast("bigint"))
    if flag:  # rows of other sources keep the key; one of the source does where there is none
        others = F.count_if(F.col("__own") == 0).over(group)
        ranked = ranked.withColumn(flag, (F.col("__own") == 0) & (others > 1))
    out = fixed(ranked, [flag] if flag else [])
    if apart is not None:
        large = fixed(number_rows(apart.withColumn("__own", own), ["__own", repair.order_by], [pk], "__rank"))
        out = out.unionByName(flag_duplicates(materialize(large), [pk], flag, filled_only=True) if flag else large)
    for rows in [*alone, df.filter(~filled)]:
        rows = rows.withColumn(audit, F.lit(None).cast("string"))
        out = rows.withColumn(flag, F.lit(False)).unionByName(out) if flag else rows.unionByName(out)
    return out


def validate(
    df: DataFrame,
    table: str,
    model: TargetModel,
    parents: dict[str, DataFrame],
    business_order: list[tuple[str, str, str]] = (),
    repair: PrimaryKeyRepair | None = None,
) -> Validated:
    """Repair, then check. A foreign key whose parent table is missing is skipped and reported, never failed.

    Repaired rows are checked on their way to scratch and written once; what the key rules compare is read before that. The rows that met
    for the repair tell which keys are still repeated.
    """
    columns = [c.name for c in model.columns(table)]
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: not a mapped frame, missing {missing}")
    rules, skipped = [], []
    for rule in derive_rules(model, table, business_order):
        if rule.kind == "FK" and rule.argument[0] not in parents:
            skipped.append(
                {"rule_id": rule.rule_id, "fk_column": rule.columns[0], "ref_table": rule.argument[0],
                 "ref_column": rule.argument[1], "reason": "the parent table does not exist yet"}
            )
            continue
        rules.append(rule)
    if not repair:
        return Validated(with_violations(df, rules, parents), rules, skipped)
    with compact(df.sparkSession):
        repaired, given = repair_primary_keys(df, repair, "__repeated"), df
        if any(r.kind == "FK" and repair.column in r.columns for r in rules):
            repaired = given = materialize(repaired)
        checked = with_violations(repaired, rules, parents, given, {repair.column: "__repeated"})
        return Validated(materialize(checked.drop("__repeated")), rules, skipped)


def unique_rule(rules: list[TargetRule], column: str) -> str | None:
    """The id of the rule by which a filled value of the column occurs once."""
    return next((r.rule_id for r in rules if r.kind == "UNIQUE" and r.columns == (column,)), None)


def passed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_violations") == 0).drop("_violations")


def failed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_violations") > 0)


def violations_by_rule(checked: DataFrame) -> DataFrame:
    rows = checked.select(F.explode("_violations").alias("rule_id"))
    return rows.groupBy("rule_id").agg(F.count(F.lit(1)).alias("violations"))


def reconcile(source: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: input rows, rows loaded, rows quarantined, and whether nothing was lost or doubled."""
    routed = checked.agg(
        F.count_if(F.size("_violations") == 0).alias("loaded_count"),
        F.count_if(F.size("_violations") > 0).alias("quarantined_count"),
    )
    given = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return routed.select(
        given.alias("input_count"),
        "loaded_count",
        "quarantined_count",
        (given == F.col("loaded_count") + F.col("quarantined_count")).alias("reconciled"),
    )


def migration_trace(
    checked: DataFrame, table: str, pk: str, run_id: str, stored: bool = False, unique: str | None = None
) -> DataFrame:
    """One trace row per input record. The id is made of the whole row and, for equal rows, of their number.

    Of a row only its hash and what the trace shows is kept. `stored` rows are read again instead of written once more. `unique` is the
    rule by which a key occurs once: a row with a key that does not break it equals no other, so only the rest is searched for equal rows.
    """
    loaded = F.size("_violations") == 0
    audit = f"_remediated_{pk}"
    before = F.col(audit) if audit in checked.columns else F.lit(None).cast("string")
    identity = F.to_json(F.struct(F.lit(run_id).alias("run"), F.lit(table).alias("table"), *checked.columns))
    alone = is_filled(F.col(pk)) & ~F.array_contains("_violations", unique) if unique else F.lit(False)
    shown = checked.select(
        F.unhex(F.sha2(identity, 256)).alias("__row"),
        F.col("_source_batch_id").alias("MIG_BATCH_ID"),
        F.col("_source_system").alias("SRC_SYS"),
        F.col("_source_table").alias("SRC_TBL"),
        F.col("_source_record_key").alias("SRC_KEY"),
        F.lit(table).alias("TGT_TBL"),
        F.when(loaded, F.col(pk).cast("string")).alias("TGT_KEY"),
        F.when(loaded, before).alias("ORIG_KEY"),
        F.when(loaded, F.lit("LOADED")).otherwise(F.lit("GOLD_QUARANTINED")).alias("MIG_ST_CD"),
        alone.alias("__alone"),
    )
    traced = with_unique_id(shown, "TRC_ID", F.hex("__row"), stored, F.col("__alone"))
    names = [c for c in shown.columns if not c.startswith("__")]
    return traced.select("TRC_ID", *names, F.current_timestamp().alias("LOAD_DTM"))
