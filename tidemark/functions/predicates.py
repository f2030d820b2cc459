"""Error conditions of quality rules and target constraints. True means "this row is wrong"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import is_blank
from tidemark.functions.temporal import parse_any


def null_error(c: Column) -> Column:
    """NULL or empty. Spaces count as a value here."""
    return c.isNull() | (c.cast("string") == "")


def pattern_error(c: Column, pattern: str) -> Column:
    return ~F.coalesce(c.cast("string").rlike(pattern), F.lit(False))


def range_error(c: Column, low: float, high: float) -> Column:
    """Outside the closed range, NULL, or not a number at all."""
    return ~F.coalesce(c.cast("string").try_cast("double").between(low, high), F.lit(False))


def order_error(start: Column, end: Column, formats=fixed.PROFILE_DATE_FORMATS) -> Column:
    """Start after end, or either missing or unreadable. Compares instants, not texts."""
    return ~F.coalesce(parse_any(start, formats) <= parse_any(end, formats), F.lit(False))


def not_null_violation(c: Column) -> Column:
    return is_blank(c)


def length_violation(c: Column, limit: int) -> Column:
    return F.coalesce(F.length(c.cast("string")) > limit, F.lit(False))


def domain_violation(c: Column, allowed: list[str]) -> Column:
    return F.coalesce(~c.isin(allowed), F.lit(False))


def order_violation(a: Column, b: Column) -> Column:
    """Both present and reversed."""
    return F.coalesce(a > b, F.lit(False))


def match_label(c: Column, pattern: str) -> Column:
    return F.when(F.trim(c).rlike(pattern), F.lit("MATCH_PATTERN")).otherwise(F.lit("UNMATCH_PATTERN"))


def sequence_status(columns: list[str], formats: dict[str, tuple] | None = None, unparsable: bool = False) -> Column:
    """ORDERED, REVERSED or CONTAINS_NULL over two or more date columns.

    Unreadable dates count as REVERSED, or as UNPARSABLE when `unparsable` asks for the finer label.
    """
    formats = formats or {}
    parsed = [parse_any(F.col(c), formats.get(c, fixed.PROFILE_DATE_FORMATS)) for c in columns]
    missing, in_order, unread = F.lit(False), F.lit(True), F.lit(False)
    for name, value in zip(columns, parsed):
        missing = missing | F.col(name).isNull()
        unread = unread | value.isNull()
    for left, right in zip(parsed, parsed[1:]):
        in_order = in_order & (left <= right)
    status = F.when(missing, F.lit("CONTAINS_NULL")).when(in_order, F.lit("ORDERED"))
    if unparsable:
        status = status.when(unread, F.lit("UNPARSABLE"))
    return status.otherwise(F.lit("REVERSED"))


def value_category(
    c: Column, variant: Column, unmatched: Column, placeholders: tuple[str, ...] = fixed.PLACEHOLDER_VALUES
) -> Column:
    """Category of a code value; the first that applies.

    `variant` tells whether the value is a known spelling variant; `unmatched` is the label for a value that no
    code master or pattern accepts, or NULL.
    """
    text = F.trim(c)
    return (
        F.when(c.isNull(), F.lit("NULL"))
        .when(text == "", F.lit("BLANK"))
        .when(text.isin(*placeholders), F.lit("PLACEHOLDER"))
        .when(variant, F.lit("SEMANTIC_VARIANT"))
        .when(text.contains(fixed.RESERVED_MARK), F.lit("RESERVED_CANDIDATE"))
        .otherwise(F.coalesce(unmatched, F.lit("STANDARD_VALUE")))
    )
