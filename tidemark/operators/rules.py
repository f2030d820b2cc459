"""Quality rules: their shape, their checks on entry, and reading them from files or tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.operators.snapshot import Constraint
from tidemark.session import metadata_rows

RULE_COLUMNS = [
    "rule_id", "rule_name", "target_table", "rule_type", "target_columns", "pattern", "min_value", "max_value",
    "code_group", "dimension", "threshold_rate", "error_grade", "cleansing_steps", "datetime_kind", "change_reason",
]
NUMERIC_COLUMNS = ["min_value", "max_value", "threshold_rate"]
DEFINITION_COLUMNS = [c for c in RULE_COLUMNS if c not in ("rule_id", "rule_name", "change_reason")]


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_type: str
    columns: tuple[str, ...]
    error_grade: str
    threshold_rate: float = 0.0
    target_table: str = ""
    rule_name: str = ""
    dimension: str | None = None
    pattern: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    code_group: str | None = None
    cleansing_steps: tuple[str, ...] = ()
    datetime_kind: str | None = None
    rule_version: int = 1

    @property
    def column(self) -> str:
        return self.columns[0]

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    @property
    def reason(self) -> str:
        return fixed.REASONS[self.rule_type].format(
            *self.columns,
            pattern=self.pattern,
            min_value=self.min_value,
            max_value=self.max_value,
            code_group=self.code_group,
            columns=list(self.columns),
        )

    def as_record(self) -> dict:
        """The rule as a row of a rule file."""
        record = {c: getattr(self, c, None) for c in RULE_COLUMNS}
        record["target_columns"] = ",".join(self.columns)
        record["cleansing_steps"] = ",".join(self.cleansing_steps) or None
        return record


def normalise_rules(raw: DataFrame) -> DataFrame:
    """Rule rows as read from text: trimmed, blanks to NULL, lists and codes in one spelling, numbers typed."""

    def text(name: str) -> Column:
        return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))

    def listed(name: str) -> Column:
        parts = F.filter(F.transform(F.split(text(name), ","), lambda x: F.trim(x)), lambda x: x != "")
        return F.nullif(F.array_join(parts, ","), F.lit(""))

    out = []
    for name in RULE_COLUMNS:
        if name in NUMERIC_COLUMNS:
            value = text(name).try_cast("double")
        elif name in ("target_columns", "cleansing_steps"):
            value = listed(name)
        elif name in ("rule_type", "error_grade", "datetime_kind"):
            value = F.upper(text(name))
        else:
            value = text(name)
        out.append(value.alias(name))
    unreadable = [
        F.when(text(n).isNotNull() & text(n).try_cast("double").isNull(), F.lit(n)) for n in NUMERIC_COLUMNS
    ]
    return raw.select(*out, F.array_compact(F.array(*unreadable)).alias("_unreadable_numbers"))


def rule_constraints() -> list[Constraint]:
    """What must hold for every row of a normalised rule snapshot."""
    c = F.col
    count = F.when(c("target_columns").isNull(), F.lit(0)).otherwise(F.size(F.split(c("target_columns"), ",")))
    steps = F.split(F.coalesce(c("cleansing_steps"), F.lit("")), ",")
    has_steps = c("cleansing_steps").isNotNull()
    kind = c("rule_type")
    known_steps = list(fixed.CLEANSING_ACTIONS)
    single = kind.isin("NULL_CHECK", "PATTERN_CHECK", "RANGE_CHECK", "CODE_EXISTS")
    conditions: list[tuple[str, Column]] = [
        ("rule_id is empty", c("rule_id").isNull()),
        *[(f"{n} is empty", c(n).isNull()) for n in ("target_table", "rule_type", "target_columns", "error_grade")],
        ("a number cannot be read", F.size("_unreadable_numbers") > 0),
        ("threshold_rate is empty", c("threshold_rate").isNull()),
        ("threshold_rate is outside 0..1", ~c("threshold_rate").between(0.0, 1.0)),
        ("rule_type is unknown", ~kind.isin(*fixed.RULE_TYPES)),
        ("error_grade is unknown", ~c("error_grade").isin(*fixed.ERROR_GRADES)),
        ("ORDER_CHECK needs two columns", (kind == "ORDER_CHECK") & (count != 2)),
        ("DUPLICATE_CHECK needs a column", (kind == "DUPLICATE_CHECK") & (count < 1)),
        ("this rule_type needs exactly one column", single & (count != 1)),
        ("PATTERN_CHECK needs a pattern", (kind == "PATTERN_CHECK") & c("pattern").isNull()),
        ("RANGE_CHECK needs min_value and max_value",
         (kind == "RANGE_CHECK") & (c("min_value").isNull() | c("max_value").isNull())),
        ("min_value is above max_value", (kind == "RANGE_CHECK") & (c("min_value") > c("max_value"))),
        ("CODE_EXISTS needs a code_group", (kind == "CODE_EXISTS") & c("code_group").isNull()),
        ("this rule_type cannot be cleansed", has_steps & ~kind.isin(*fixed.CLEANSABLE_TYPES)),
        ("a cleansing step is unknown", has_steps & F.exists(steps, lambda s: ~s.isin(*known_steps))),
        ("phone cleansing needs the standard phone pattern",
         F.array_contains(steps, "CLN-VAL-001")
         & ~F.coalesce(c("pattern").isin(*[p for p, _ in fixed.PHONE_STYLES.values()]), F.lit(False))),
        ("datetime_kind is unknown", ~c("datetime_kind").isin("DATE", "TIMESTAMP")),
    ]
    return [Constraint(problem, condition) for problem, condition in conditions]


def rules_from(df: DataFrame) -> list[Rule]:
    """Active rules as plan input, ordered by id. Rules are metadata, so they are bounded and collected."""

    def listed(value: str | None) -> tuple[str, ...]:
        return tuple(p.strip() for p in (value or "").split(",") if p.strip())

    rules = []
    for row in metadata_rows(df):
        rules.append(
            Rule(
                rule_id=row["rule_id"],
                rule_type=row["rule_type"],
                columns=listed(row["target_columns"]),
                error_grade=row["error_grade"],
                threshold_rate=float(row["threshold_rate"]),
                target_table=row["target_table"],
                rule_name=row.get("rule_name") or "",
                dimension=row.get("dimension"),
                pattern=row.get("pattern"),
                min_value=row.get("min_value"),
                max_value=row.get("max_value"),
                code_group=row.get("code_group"),
                cleansing_steps=listed(row.get("cleansing_steps")),
                datetime_kind=row.get("datetime_kind"),
                rule_version=int(row.get("rule_version") or 1),
            )
        )
    return sorted(rules, key=lambda r: r.rule_id)
