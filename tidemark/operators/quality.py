"""Quality checks of one table: all rules in one pass, judgement, violation detail, and routing of records.

Flow: `with_outcomes` marks every row for every rule (row-local rules as expressions, code rules through a join with
the code master, duplicate rules through a join with the set of duplicate keys). `rule_counts` turns the marks into
one row per rule, `judge` into PASS or FAIL with an action. `violations` explodes the marks into one row per
violation, and `route_records` applies cleansed values and splits records into candidate and quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions import predicates
from tidemark.functions.cleansing import mask_pii, standard_datetime, standard_phone, trim_all_space
from tidemark.functions.columns import any_of, joined_or_null, key_value_text, labels_where, rate
from tidemark.operators.keys import duplicate_keys, flag_members, flag_rows_with_keys, key_counts
from tidemark.operators.rules import Rule
from tidemark.session import materialize, metadata_frame


@dataclass(frozen=True)
class CodeTables:
    """Code master (CODE_GROUP, CODE) and, when code cleansing is on, the approved code mapping.

    `unique` promises that no code occurs twice in its group.
    """

    master: DataFrame
    mapping: DataFrame | None = None
    enabled_steps: frozenset[str] = frozenset()
    unique: bool = False

    def codes(self, group: str | None) -> DataFrame:
        return self.master.filter(F.col("CODE_GROUP") == F.lit(group)).select(F.col("CODE").cast("string"))

    def steps_of(self, rule: Rule) -> list[str]:
        off = [s for s in fixed.DISABLED_STEPS if s not in self.enabled_steps]
        return [s for s in rule.cleansing_steps if s not in off]


def approved_code_mapping(mapping: DataFrame, master: DataFrame) -> DataFrame:
    """(CODE_GROUP, SOURCE_CODE, STANDARD_CODE) that is approved, leads to one code only, and exists in the master."""
    approved = mapping.filter(
        (F.col("APPROVED_YN") == "Y") & F.col("SOURCE_CODE").isNotNull() & F.col("STANDARD_CODE").isNotNull()
    )
    single = (
        approved.groupBy("CODE_GROUP", "SOURCE_CODE")
        .agg(F.min("STANDARD_CODE").alias("STANDARD_CODE"), F.max("STANDARD_CODE").alias("__other"))
        .filter(F.col("STANDARD_CODE") == F.col("__other"))
        .drop("__other")
    )
    known = master.select("CODE_GROUP", F.col("CODE").alias("STANDARD_CODE")).distinct()
    return single.join(known, ["CODE_GROUP", "STANDARD_CODE"]).select("CODE_GROUP", "SOURCE_CODE", "STANDARD_CODE")


def map_codes(df: DataFrame, value: Column, mapping: DataFrame, group: str, out: str) -> DataFrame:
    """Column `out`: the standard code of `value` in the group, or the value itself when none is approved."""
    lookup = mapping.filter(F.col("CODE_GROUP") == group).select(
        F.col("SOURCE_CODE").alias(f"__src_{out}"), F.col("STANDARD_CODE").alias(f"__std_{out}")
    )
    joined = df.join(lookup, value == F.col(f"__src_{out}"), "left")
    return joined.withColumn(out, F.coalesce(F.col(f"__std_{out}"), value)).drop(f"__src_{out}", f"__std_{out}")


def cleanse_values(df: DataFrame, rules: list[tuple[Rule, str]], codes: CodeTables) -> DataFrame:
    """Apply the cleansing steps of several rules, each to the text of its own column.

    Adds per (rule, out) pair `out`, the cleansed text, and `out`_steps, the ids of the steps that changed something.
    The first steps of all rules form one projection, then the second steps, and so on.
    """
    before = {out: F.col(rule.column).cast("string") for rule, out in rules}
    changes: dict[str, list[tuple[str, Column]]] = {out: [] for _, out in rules}
    frame, helpers = df, []
    for number in range(max((len(codes.steps_of(r)) for r, _ in rules), default=0)):
        stage_columns = {}
        for rule, out in rules:
            steps = codes.steps_of(rule)
            if number >= len(steps):
                continue
            step, stage, current = steps[number], f"{out}_{number}", before[out]
            if step == "CLN-VAL-003":
                frame = map_codes(frame, current, codes.mapping, rule.code_group, stage)
            elif step == "CLN-COM-001":
                stage_columns[stage] = trim_all_space(current)
            elif step == "CLN-VAL-001":
                stage_columns[stage] = standard_phone(current, phone_style(rule.pattern))
            else:
                stage_columns[stage] = standard_datetime(current, rule.datetime_kind or "TIMESTAMP")
            changes[out].append((step, ~current.eqNullSafe(F.col(stage))))
            before[out] = F.col(stage)
            helpers.append(stage)
        frame = frame.withColumns(stage_columns) if stage_columns else frame
    results = {}
    for _, out in rules:
        results |= {out: before[out], f"{out}_steps": labels_where(changes[out])}
    return frame.withColumns(results).drop(*helpers)


def cleanse_column(df: DataFrame, rule: Rule, codes: CodeTables, out: str) -> DataFrame:
    return cleanse_values(df, [(rule, out)], codes)


def phone_style(pattern: str | None) -> str:
    """Style of the phone numbers that a rule's pattern asks for."""
    return next((style for style, (wanted, _) in fixed.PHONE_STYLES.items() if wanted == pattern), "DIGITS")


def order_formats(pattern: str | None) -> tuple[str, ...]:
    """Formats of an order rule's dates: its own, between bars, or the usual ones."""
    return tuple(pattern.split("|")) if pattern else fixed.PROFILE_DATE_FORMATS


def _row_error(rule: Rule, value: str | None) -> Column:
    """Error condition of a row-local rule, on its own column or on another text."""
    c = F.col(value or rule.column)
    if rule.rule_type == "NULL_CHECK":
        return predicates.null_error(c)
    if rule.rule_type == "PATTERN_CHECK":
        return predicates.pattern_error(c, rule.pattern)
    if rule.rule_type == "RANGE_CHECK":
        return predicates.range_error(c, rule.min_value, rule.max_value)
    if rule.rule_type == "ORDER_CHECK":
        return predicates.order_error(F.col(rule.columns[0]), F.col(rule.columns[1]), order_formats(rule.pattern))
    raise ValueError(f"unknown rule type {rule.rule_type}")


def flag_errors(
    df: DataFrame,
    checks: list[tuple[str, Rule, str | None]],
    codes: CodeTables,
    repeated: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Boolean columns for (flag, rule, value) checks: does the row break the rule?

    A check is judged on the text column `value` instead of the rule's own column, if one is given. Row-local rules
    share one projection; code and duplicate rules are joins with key sets. `repeated` has the key sets of duplicate
    rules, by rule id, where they are known.
    """
    out, flags = df, {}
    for flag, rule, value in checks:
        if rule.rule_type == "CODE_EXISTS":
            text = F.col(value or rule.column).cast("string")
            out = flag_members(out, text, codes.codes(rule.code_group), f"__known{flag}", codes.unique)
            flags[flag] = ~F.col(f"__known{flag}")
        elif rule.rule_type == "DUPLICATE_CHECK":
            keys = list(rule.columns)
            known = (repeated or {}).get(rule.rule_id)
            out = flag_rows_with_keys(out, keys, duplicate_keys(df, keys) if known is None else known, f"__known{flag}")
            flags[flag] = F.col(f"__known{flag}")
        else:
            flags[flag] = _row_error(rule, value)
    return out.withColumns(flags).drop(*[f"__known{flag}" for flag in flags])


def with_outcomes(
    df: DataFrame,
    rules: list[Rule],
    codes: CodeTables,
    row_local_only: bool = False,
    repeated: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Marks of every rule on every row, in columns with the rule's position:

    `__err{i}` broken as delivered, `__left{i}` still broken after the rule's own cleansing,
    `__val{i}` / `__val{i}_steps` the cleansed text and the steps behind it (cleansing rules only).
    """
    repeats = [(i, r) for i, r in enumerate(rules) if r.rule_type == "DUPLICATE_CHECK"]
    local = [(i, r) for i, r in enumerate(rules) if r.rule_type != "DUPLICATE_CHECK"]
    chosen = local if row_local_only else [*repeats, *local]
    cleansing = [(i, r) for i, r in chosen if codes.steps_of(r)]
    out = df
    if repeats and not row_local_only:  # these joins may move rows, so they come before columns are added
        out = flag_errors(out, [(f"__err{i}", r, None) for i, r in repeats], codes, repeated)
    out = cleanse_values(out, [(r, f"__val{i}") for i, r in cleansing], codes) if cleansing else out
    checks = [(f"__err{i}", r, None) for i, r in local] + [(f"__again{i}", r, f"__val{i}") for i, r in cleansing]
    out = flag_errors(out, checks, codes) if checks else out
    again = {i for i, _ in cleansing}
    left = {
        f"__left{i}": F.col(f"__err{i}") & F.col(f"__again{i}") if i in again else F.col(f"__err{i}") for i, _ in chosen
    }
    return out.withColumns(left).drop(*[f"__again{i}" for i in again])


def rule_counts(df: DataFrame, rules: list[Rule], codes: CodeTables) -> DataFrame:
    """One row per rule: rows checked, errors as delivered, errors left after cleansing, rows affected.

    All row-local rules share one aggregate. A duplicate rule counts key groups as errors, and rows as affected.
    """
    local = [(i, r) for i, r in enumerate(rules) if r.rule_type != "DUPLICATE_CHECK"]
    parts = []
    if local:
        marked = with_outcomes(df, rules, codes, row_local_only=True)
        sums = [F.count(F.lit(1)).alias("n")]
        for i, _ in local:
            sums += [F.count_if(f"__err{i}").alias(f"e{i}"), F.count_if(f"__left{i}").alias(f"l{i}")]
        rows = [
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.col("n").alias("check_count"),
                F.col(f"e{i}").alias("initial_error_count"),
                F.col(f"l{i}").alias("error_count"),
                F.col(f"e{i}").alias("affected_rows"),
            )
            for i, r in local
        ]
        parts.append(marked.agg(*sums).select(F.inline(F.array(*rows))))
    for rule in rules:
        if rule.rule_type == "DUPLICATE_CHECK":
            groups = df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
            repeated = F.col("n") > 1
            parts.append(
                groups.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("check_count"),
                    F.count_if(repeated).alias("initial_error_count"),
                    F.count_if(repeated).alias("error_count"),
                    F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("affected_rows"),
                ).select(F.lit(rule.rule_id).alias("rule_id"), "*")
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rule_table(spark, rules: list[Rule]) -> DataFrame:
    """The rules as a small local relation, for joins with results."""
    rows = [
        {
            "rule_id": r.rule_id,
            "rule_name": r.rule_name,
            "target_table": r.target_table,
            "target_column": ", ".join(r.columns),
            "dimension": r.dimension,
            "threshold_rate": r.threshold_rate,
            "configured_grade": r.error_grade,
            "dq_reason": r.reason,
            "dq_rule_version": r.rule_version,
        }
        for r in rules
    ]
    typed = {"threshold_rate": "double", "dq_rule_version": "int"}
    frame = metadata_frame(spark, rows)
    return frame.withColumns({c: F.col(c).cast(t) for c, t in typed.items()})


def judge(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add error rates, result, grade and action. Judged on the errors that cleansing left."""
    spark = counts.sparkSession
    out = counts.join(F.broadcast(rule_table(spark, rules)), "rule_id")  # one row per rule
    errors, checked, grade = F.col("error_count"), F.col("check_count"), F.col("configured_grade")
    exact_rate = F.when(checked > 0, errors / checked).otherwise(F.lit(0.0))
    review = grade == "REVIEW"
    failed = F.when(review, errors > 0).otherwise(exact_rate > F.col("threshold_rate"))
    action = (
        F.when(~failed, F.lit("ALLOW"))
        .when(review, F.lit("REVIEW"))
        .when(grade.isin(*fixed.BLOCKING_GRADES), F.lit("BLOCK"))
        .otherwise(F.lit("WARN"))
    )
    return out.select(
        "rule_id",
        "rule_name",
        "target_table",
        "target_column",
        "dimension",
        "check_count",
        "error_count",
        rate(errors, checked, 6).alias("error_rate"),
        "initial_error_count",
        rate(F.col("initial_error_count"), checked, 6).alias("initial_error_rate"),
        "affected_rows",
        "threshold_rate",
        F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("result_status"),
        F.when(failed, grade).otherwise(F.lit("INFO")).alias("error_grade"),
        action.alias("action_type"),
        (action != "ALLOW").alias("cleansing_required_yn"),
        "dq_reason",
        "dq_rule_version",
    )


def violation_entries(rules: list[Rule], codes: CodeTables) -> Column:
    """Array with a struct per rule that the row breaks, over the marks of `with_outcomes`."""
    entries = []
    for i, rule in enumerate(rules):
        cleansed = bool(codes.steps_of(rule))
        none = F.lit(None).cast("string")
        steps = F.col(f"__val{i}_steps") if cleansed else F.array().cast("array<string>")
        after = F.col(f"__val{i}") if cleansed else none
        entries.append(
            F.when(
                F.col(f"__err{i}"),
                F.struct(
                    F.lit(rule.rule_id).alias("rule_id"),
                    F.lit(rule.label).alias("target_column"),
                    key_value_text(list(rule.columns)).alias("raw"),
                    after.alias("after"),
                    steps.alias("steps"),
                    F.lit(cleansed).alias("cleansed"),
                    F.col(f"__left{i}").alias("left"),
                ),
            )
        )
    return F.array_compact(F.array(*entries))


def row_identity(columns: list[str]) -> Column:
    """Hash of a whole row as it came in."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def key_text(df: DataFrame, record_key: str | None) -> Column:
    return F.col(record_key).cast("string") if record_key in df.columns else F.lit(None).cast("string")


def unfold_violations(rows: DataFrame, entries: Column | str, kept: list[str] = ()) -> DataFrame:
    """One row per entry, with masked values; `rows` has source_record_key."""
    exploded = rows.select("source_record_key", *kept, F.explode(entries).alias("v")).select("source_record_key", *kept, "v.*")
    actions = F.create_map(*[F.lit(x) for pair in fixed.CLEANSING_ACTIONS.items() for x in pair])
    changed = F.size("steps") > 0
    return exploded.select(
        "rule_id",
        "source_record_key",
        "target_column",
        mask_pii(F.col("raw")).alias("before_value"),
        F.when(changed, mask_pii(F.col("after"))).alias("proposed_value"),
        F.when(~F.col("left"), mask_pii(F.col("after"))).alias("final_value"),
        joined_or_null(F.transform("steps", lambda s: F.element_at(actions, s))).alias("cleansing_action"),
        joined_or_null(F.col("steps")).alias("cleansing_rule_id"),
        F.when(F.col("cleansed"), F.when(F.col("left"), F.lit("FAIL")).otherwise(F.lit("PASS"))).alias("re_dq_result"),
        (F.col("cleansed") & ~F.col("left")).alias("auto"),
        *kept,
    )


def violations(
    df: DataFrame, rules: list[Rule], codes: CodeTables, record_key: str | None, row_hash: str | None = None
) -> DataFrame:
    """One row per rule and row it breaks, with masked values. All rules in one pass, then one explode.

    `row_hash` names a further column, the hash of the whole row as it came in.
    """
    marked = with_outcomes(df, rules, codes)
    hashes = [row_identity(df.columns).alias(row_hash)] if row_hash else []
    keyed = marked.select("*", key_text(df, record_key).alias("source_record_key"), *hashes)
    return unfold_violations(keyed, violation_entries(rules, codes), [row_hash] if row_hash else [])


def violation_detail(found: DataFrame, judged: DataFrame) -> DataFrame:
    """Give every violation the status that follows from its rule's action."""
    action = judged.select("rule_id", "action_type", "dq_reason")
    out = found.join(F.broadcast(action), "rule_id")  # one row per rule
    isolate = F.col("action_type").isin(*fixed.ISOLATING_ACTIONS)
    status = (
        F.when(F.col("auto"), F.lit("AUTO_CLEANSED"))
        .when(isolate, F.lit("UNRESOLVED"))
        .when(F.col("action_type") == "ALLOW", F.lit("NOT_REQUIRED"))
        .otherwise(F.lit("ALLOWED"))
    )
    return out.select(
        *[c for c in found.columns if c != "auto"],
        status.alias("cleansing_status"),
        (isolate & ~F.col("auto")).alias("review_required_yn"),
        "dq_reason",
    )


def detail_counts(detail: DataFrame) -> DataFrame:
    """Per rule: distinct records (records without a key count once), auto-cleansed rows, unresolved rows.

    Records are grouped first, so a rule that most rows break is still spread over the cluster.
    """
    per_record = detail.groupBy("rule_id", "source_record_key").agg(
        F.count_if(F.col("cleansing_status") == "AUTO_CLEANSED").alias("a"),
        F.count_if(F.col("cleansing_status") == "UNRESOLVED").alias("u"),
    )
    return per_record.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("unique_error_record_count"),
        F.sum("a").alias("auto_cleansed_record_count"),
        F.sum("u").alias("unresolved_record_count"),
    )


def error_samples(found: DataFrame, size: int = 5) -> DataFrame:
    """The first masked values per rule, as an array. The ranking limit is applied before the shuffle."""
    from pyspark.sql import Window

    order = Window.partitionBy("rule_id").orderBy(
        F.col("source_record_key").asc_nulls_first(), F.col("before_value").asc_nulls_first()
    )
    top = found.select("rule_id", "source_record_key", "before_value").withColumn("n", F.row_number().over(order))
    picked = top.filter(F.col("n") <= size)
    value = F.struct("n", F.col("before_value").alias("v"))
    listed = F.transform(F.array_sort(F.collect_list(value)), lambda x: x["v"])  # at most `size` values
    return picked.groupBy("rule_id").agg(listed.alias("sample_values"))


def apply_cleansing(df: DataFrame, rules: list[Rule], codes: CodeTables) -> DataFrame:
    """Overwrite values that were wrong and are right after cleansing; `_cleansed_yn` tells whether any was.

    Rules of different columns are applied together; a later rule of the same column sees the value of the earlier.
    """
    rounds: list[list[Rule]] = []
    for rule in rules:
        if codes.steps_of(rule):
            used = [n for n, chosen in enumerate(rounds) if rule.column in {r.column for r in chosen}]
            number = used[-1] + 1 if used else 0
            rounds += [[]] if number == len(rounds) else []
            rounds[number].append(rule)
    kinds, out, changed = dict(df.dtypes), df, F.lit(False)
    for number, chosen in enumerate(rounds):
        out = with_outcomes(out, chosen, codes)
        hits = {i: F.col(f"__err{i}") & ~F.col(f"__left{i}") for i in range(len(chosen))}
        values = {
            r.column: F.when(hits[i], F.col(f"__val{i}").cast(kinds[r.column])).otherwise(F.col(r.column))
            for i, r in enumerate(chosen)
        }
        helpers = [f"__{kind}{i}" for i in hits for kind in ("err", "left", "val")] + [f"__val{i}_steps" for i in hits]
        out = out.withColumns({**values, f"__changed{number}": any_of(list(hits.values()))}).drop(*helpers)
        changed = changed | F.col(f"__changed{number}")
    return out.withColumn("_cleansed_yn", changed).drop(*[f"__changed{n}" for n in range(len(rounds))])


def route_records(
    df: DataFrame, cleanse: list[Rule], isolate: list[Rule], codes: CodeTables, lineage: dict[str, Column]
) -> DataFrame:
    """Cleansed records with lineage, `_dq_status` and the ids of isolating rules they still break.

    CLEAN and CLEANSED records are candidates, UNRESOLVED ones belong in quarantine.
    """
    out = apply_cleansing(df, cleanse, codes)
    out = flag_errors(out, [(f"__iso{i}", rule, None) for i, rule in enumerate(isolate)], codes)
    broken = [(r.rule_id, F.col(f"__iso{i}")) for i, r in enumerate(isolate)]
    status = (
        F.when(any_of([b for _, b in broken]), F.lit("UNRESOLVED"))
        .when(F.col("_cleansed_yn"), F.lit("CLEANSED"))
        .otherwise(F.lit("CLEAN"))
    )
    return out.select(
        *df.columns,
        *[c.alias(name) for name, c in lineage.items()],
        "_cleansed_yn",
        status.alias("_dq_status"),
        labels_where(broken).alias("_unresolved_rule_ids"),
    )


def repeated_keys(df: DataFrame, rules: list[Rule]) -> dict[str, DataFrame]:
    """Per duplicate rule its repeated keys with `__rows`, written once: for the flags and for the counts."""
    found = {}
    for rule in rules:
        if rule.rule_type == "DUPLICATE_CHECK":
            found[rule.rule_id] = materialize(key_counts(df, list(rule.columns), "__rows").filter("__rows > 1"))
    return found


def evaluate(
    df: DataFrame,
    rules: list[Rule],
    codes: CodeTables,
    record_key: str | None,
    lineage: dict[str, Column],
    repeated: dict[str, DataFrame],
) -> DataFrame:
    """All that a run needs of each row, from one evaluation of the rules.

    The cleansed record with its lineage and `_cleansed_yn`; `__broken`, the rules that it breaks after cleansing;
    `__found`, the violations as delivered; `source_record_key` and `__row`, the key and hash of the row as delivered;
    and per rule `__err{i}` and `__left{i}`. A rule is judged again on the cleansed record only where another rule may
    have changed one of its columns.
    """
    kinds = dict(df.dtypes)
    marked = with_outcomes(df, rules, codes, repeated={k: v.drop("__rows") for k, v in repeated.items()})
    marked = marked.withColumns(
        {
            "source_record_key": key_text(df, record_key),
            "__row": row_identity(df.columns),
            "__found": violation_entries(rules, codes),
        }
    )
    cleansing = [(i, r) for i, r in enumerate(rules) if codes.steps_of(r)]
    first = {r.column: i for i, r in reversed(cleansing)}
    later = [r for i, r in cleansing if first[r.column] != i]
    hits = {i: F.col(f"__err{i}") & ~F.col(f"__left{i}") for i in first.values()}
    values = {
        c: F.when(hits[i], F.col(f"__val{i}").cast(kinds[c])).otherwise(F.col(c)) for c, i in first.items()
    }
    marks = {f"__{kind}{i}": f"__was_{kind}{i}" for i in range(len(rules)) for kind in ("err", "left")}
    out = marked.withColumns({**values, "__hit": any_of(list(hits.values()))}).withColumnsRenamed(marks)
    out = out.drop(*[f"__val{i}{suffix}" for i, _ in cleansing for suffix in ("", "_steps")])
    out = apply_cleansing(out, later, codes).withColumn("_cleansed_yn", F.col("_cleansed_yn") | F.col("__hit"))
    changed_by = {c: {i for i, r in cleansing if r.column == c} for c in df.columns}
    again = [(i, r) for i, r in enumerate(rules) if any(changed_by[c] - {i} for c in r.columns)]
    out = flag_errors(out, [(f"__iso{i}", r, None) for i, r in again], codes) if again else out
    anew = {i for i, _ in again}
    broken = [(r.rule_id, F.col(f"__iso{i}" if i in anew else f"__was_left{i}")) for i, r in enumerate(rules)]
    return out.select(
        *df.columns,
        *[c.alias(name) for name, c in lineage.items()],
        "_cleansed_yn",
        labels_where(broken).alias("__broken"),
        "__found",
        "source_record_key",
        "__row",
        *[F.col(was).alias(now) for now, was in marks.items()],
    )


def observed_counts(n_rules: int) -> list[Column]:
    """Metrics of an evaluated frame for `DataFrame.observe`: rows, and per rule errors as delivered and left."""
    counts = [F.count(F.lit(1)).alias("n")]
    for i in range(n_rules):
        counts += [F.count_if(f"__err{i}").alias(f"e{i}"), F.count_if(f"__left{i}").alias(f"l{i}")]
    return counts


def counts_from(spark, observed: dict, rules: list[Rule], repeated: dict[str, DataFrame]) -> DataFrame:
    """What `rule_counts` gives, from observed metrics and the repeated keys."""
    rows = []
    for i, rule in enumerate(rules):
        errors, left, affected = observed[f"e{i}"], observed[f"l{i}"], observed[f"e{i}"]
        if rule.rule_id in repeated:
            keys = repeated[rule.rule_id].agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"))
            errors, affected = keys.first()
            left = errors
        rows.append((rule.rule_id, observed["n"], errors, left, affected))
    kind = "rule_id string, check_count bigint, initial_error_count bigint, error_count bigint, affected_rows bigint"
    return spark.createDataFrame(rows, kind)


def routed_by(evaluated: DataFrame, isolate: list[str]) -> DataFrame:
    """Rows of an evaluated frame with `_dq_status` and `_unresolved_rule_ids`, once it is known which rules isolate."""
    unresolved = F.filter("__broken", lambda r: r.isin(*isolate)) if isolate else F.array().cast("array<string>")
    status = (
        F.when(F.size(unresolved) > 0, F.lit("UNRESOLVED"))
        .when(F.col("_cleansed_yn"), F.lit("CLEANSED"))
        .otherwise(F.lit("CLEAN"))
    )
    return evaluated.withColumns({"_dq_status": status, "_unresolved_rule_ids": unresolved})


def candidates(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("_dq_status") != "UNRESOLVED").drop("_unresolved_rule_ids")


def quarantined(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("_dq_status") == "UNRESOLVED")


def run_summary(results: DataFrame) -> DataFrame:
    """Per table: rules passed and failed, values cleansed, violations left."""
    return results.groupBy("target_table").agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(F.col("result_status") == "PASS").alias("pass_count"),
        F.count_if(F.col("result_status") == "FAIL").alias("fail_count"),
        F.coalesce(F.sum("auto_cleansed_record_count"), F.lit(0)).alias("auto_cleansed_record_count"),
        F.coalesce(F.sum("unresolved_record_count"), F.lit(0)).alias("unresolved_record_count"),
    )


def overall_metrics(results: DataFrame) -> DataFrame:
    """One row over all results. BLOCK when a failed CRITICAL or HIGH rule has unresolved rows or an unknown number."""
    failed = F.col("result_status") == "FAIL"
    open_rows = F.col("unresolved_record_count").isNull() | (F.col("unresolved_record_count") > 0)
    blocking = F.count_if(failed & F.col("error_grade").isin(*fixed.BLOCKING_GRADES) & open_rows)
    return results.agg(
        F.count(F.lit(1)).alias("total_rules_executed"),
        F.count_if(F.col("result_status") == "PASS").alias("pass_count"),
        F.count_if(failed).alias("fail_count"),
        F.count_if(failed & (F.col("error_grade") == "CRITICAL")).alias("critical_fail_count"),
        F.count_if(failed & (F.col("error_grade") == "HIGH")).alias("high_fail_count"),
        F.count_if((F.col("action_type") == "REVIEW") | (F.col("error_grade") == "REVIEW")).alias("review_count"),
        F.coalesce(F.sum("auto_cleansed_record_count"), F.lit(0)).alias("auto_cleansed_record_count"),
        F.coalesce(F.sum("unresolved_record_count"), F.lit(0)).alias("unresolved_record_count"),
        F.when(blocking > 0, F.lit("BLOCK")).otherwise(F.lit("PASS")).alias("overall_status"),
    )


def failure_report(results: DataFrame) -> DataFrame:
    """Failed rules with readable percentages."""

    def text(c: str) -> Column:
        return F.concat(F.round(F.col(c) * 100, 2).cast("string"), F.lit("%"))

    failed = results.filter((F.col("result_status") == "FAIL") | (F.col("action_type") != "ALLOW"))
    return failed.select(
        "rule_id",
        "rule_name",
        "target_table",
        "target_column",
        "error_grade",
        "action_type",
        "check_count",
        "error_count",
        text("error_rate").alias("error_rate_pct"),
        text("threshold_rate").alias("threshold_rate_pct"),
        F.coalesce("auto_cleansed_record_count", F.lit(0)).alias("auto_cleansed_count"),
        F.coalesce("unresolved_record_count", F.lit(0)).alias("unresolved_count"),
        "dq_reason",
    )


def top_failures(report: DataFrame, size: int = 5) -> DataFrame:
    """The first failures by rule id, each with the number of failures that are not shown."""
    total = report.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        report.withColumn("more_failures", F.greatest(total - F.lit(size), F.lit(0)))
        .orderBy("rule_id")
        .limit(size)
        .select("rule_id", "target_column", "error_grade", "error_count", "error_rate_pct", "more_failures")
    )


def latest_run_counts(results: DataFrame, routed: DataFrame) -> DataFrame:
    """Rows processed and rows waiting in quarantine for the latest run of each source, and the total of all."""
    latest = results.groupBy("source_system").agg(F.max_by("dq_run_id", "executed_at").alias("_dq_run_id"))
    rows = routed.groupBy(F.col("_source_system").alias("source_system"), "_dq_run_id").agg(
        F.count_if(F.col("_dq_status") != "UNRESOLVED").alias("done"),
        F.count_if(F.col("_dq_status") == "UNRESOLVED").alias("pending"),
    )
    per_source = latest.join(rows, ["source_system", "_dq_run_id"], "left").select(
        "source_system", F.coalesce("done", F.lit(0)).alias("done"), F.coalesce("pending", F.lit(0)).alias("pending")
    )
    return per_source.rollup("source_system").agg(
        F.sum(F.col("done") + F.col("pending")).alias("total"), F.sum("done").alias("done"),
        F.sum("pending").alias("pending"),
    ).withColumn("source_system", F.coalesce("source_system", F.lit("TOTAL")))
