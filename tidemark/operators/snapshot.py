"""Versioned snapshots of keyed tables: check an incoming snapshot, compare it with the history, append versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import content_hash
from tidemark.operators.keys import flag_duplicates

VERSION_COLUMNS = ["version", "is_active", "definition_hash", "change_reason"]


@dataclass(frozen=True)
class Constraint:
    """A named condition that is true for a wrong row. NULL counts as not wrong."""

    problem: str
    condition: Column


def latest_versions(history: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Row of the highest version per key, inactive ones included. An aggregate, so no group is gathered."""
    row = F.max_by(F.struct(*[F.col(c) for c in history.columns]), F.col(version)).alias("r")
    return history.groupBy(F.col(key).alias("__key")).agg(row).select("r.*")


def active_versions(history: DataFrame, key: str, version: str = "version") -> DataFrame:
    return latest_versions(history, key, version).filter("is_active")


def snapshot_problems(incoming: DataFrame, key: str, constraints: list[Constraint]) -> DataFrame:
    """One row (key, problem) for every broken constraint, repeated keys included."""
    flagged = flag_duplicates(incoming, [key], "__repeated", filled_only=True)
    problems = [F.when(c.condition, F.lit(c.problem)) for c in constraints]
    problems.append(F.when(F.col("__repeated"), F.lit(f"{key} is repeated")))
    listed = F.array_compact(F.array(*problems))
    return flagged.select(F.col(key).alias("key"), F.explode(listed).alias("problem"))


def require_valid(incoming: DataFrame, key: str, constraints: list[Constraint], shown: int = 50) -> None:
    """All or nothing: raises with the problems found (the first `shown` are listed, all are counted)."""
    problems = snapshot_problems(incoming, key, constraints)
    first = problems.orderBy("key", "problem").limit(shown).collect()
    if first:
        listed = "\n".join(f"  {r['key']}: {r['problem']}" for r in first)
        raise ValueError(f"snapshot refused, nothing was written; {problems.count()} problem(s):\n{listed}")


def plan_sync(
    incoming: DataFrame, history: DataFrame, key: str, fields: list[str], deactivate_missing: bool = True
) -> DataFrame:
    """Compare a full snapshot with the history.

    One row per key with `sync_status` (new, reactivated, changed, deactivated, unchanged), the version before and
    after, the hash of the fields, the values to store, and `diffs`, the text of every changed field. Incoming rows
    without a key, or with one that another row has, come out one by one as `refused`, without versions, and take no part
    in the comparison; a repeated key counts as missing from the snapshot no more than as present, so its history stays.
    """
    old = latest_versions(history, key).select(
        F.col(key).alias("__old_key"),
        F.col("version").alias("from_version"),
        F.col("is_active").alias("__old_active"),
        F.col("definition_hash").alias("__old_hash"),
        *[F.col(f).alias(f"__old_{f}") for f in fields],
        F.lit(True).alias("__stored"),
    )
    marked = flag_duplicates(incoming.select(key, *fields, content_hash(fields).alias("__new_hash")), [key], "__again")
    bad = F.col("__again") | F.col(key).isNull()
    refused = marked.filter(bad).drop("__again")
    new = marked.filter(~bad).drop("__again").withColumn("__given", F.lit(True))
    old = old.join(refused.select(F.col(key).alias("__k")).filter("__k IS NOT NULL").distinct(), F.col("__old_key") == F.col("__k"), "left_anti")
    both = new.join(old, F.col(key) == F.col("__old_key"), "full_outer")
    gone = F.col("__given").isNull()
    status = (
        F.when(gone & F.col("__old_active"), F.lit("deactivated"))
        .when(gone, F.lit("absent"))
        .when(F.col("__stored").isNull(), F.lit("new"))
        .when(~F.col("__old_active"), F.lit("reactivated"))
        .when(F.col("__old_hash") != F.col("__new_hash"), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    diffs = [
        F.when(
            ~F.col(f).eqNullSafe(F.col(f"__old_{f}")),
            F.concat(F.lit(f"{f}: "), shown(F.col(f"__old_{f}")), F.lit(" → "), shown(F.col(f))),
        )
        for f in fields
    ]
    kept = F.col("sync_status") == "unchanged"
    planned = both.withColumn("sync_status", status).filter(F.col("sync_status") != "absent")
    if not deactivate_missing:
        planned = planned.filter(F.col("sync_status") != "deactivated")
    stored = [F.when(gone, F.col(f"__old_{f}")).otherwise(F.col(f)).alias(f) for f in fields]
    compared = planned.select(
        F.coalesce(F.col(key), F.col("__old_key")).alias(key),
        "sync_status",
        "from_version",
        F.when(kept, F.col("from_version"))
        .otherwise(F.coalesce(F.col("from_version"), F.lit(0)) + 1)
        .cast("int")
        .alias("to_version"),
        F.when(gone, F.col("__old_hash")).otherwise(F.col("__new_hash")).alias("definition_hash"),
        F.when(F.col("sync_status") == "changed", F.array_join(F.array_compact(F.array(*diffs)), "; ")).alias("diffs"),
        *stored,
    )
    nothing = F.lit(None)
    return compared.unionByName(
        refused.select(
            key,
            F.lit("refused").alias("sync_status"),
            nothing.cast("int").alias("from_version"),
            nothing.cast("int").alias("to_version"),
            F.col("__new_hash").alias("definition_hash"),
            nothing.cast("string").alias("diffs"),
            *fields,
        )
    )


def version_rows(plan: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The rows to append for a plan: nothing for unchanged keys and refused rows."""
    reason = (
        F.when(F.col("sync_status") == "reactivated", F.lit("reactivated"))
        .when(F.col("sync_status") == "deactivated", F.lit("missing from the snapshot"))
        .otherwise(F.col("diffs"))
    )
    return plan.filter(~F.col("sync_status").isin("unchanged", "refused")).select(
        key,
        F.col("to_version").alias("version"),
        (F.col("sync_status") != "deactivated").alias("is_active"),
        "definition_hash",
        reason.alias("change_reason"),
        *fields,
    )


def first_versions(snapshot: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A snapshot as the first version of its history."""
    return snapshot.select(
        key,
        F.lit(1).alias("version"),
        F.lit(True).alias("is_active"),
        content_hash(fields).alias("definition_hash"),
        F.lit(None).cast("string").alias("change_reason"),
        *fields,
    )
