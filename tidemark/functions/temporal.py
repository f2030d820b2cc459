"""Reading and writing date and time texts.

A format first selects by shape and then parses with a cast. Trying one formatter after another would throw an
exception inside the JVM for every format that does not fit, which costs far more than the parsing itself.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed

_TOKENS = {
    "yyyy": r"\d{4}",
    "MM": r"\d{2}",
    "dd": r"\d{2}",
    "HH": r"\d{2}",
    "mm": r"\d{2}",
    "SSS": r"\d{3}",
    "ss": r"\d{2}",
    "XXX": r"(?:Z|[+-]\d{2}:\d{2})",
    "'T'": "T",
}
_TOKEN = re.compile("|".join(map(re.escape, _TOKENS)))


def shape_of(pattern: str, short_days: bool = False) -> str:
    """Regular expression for the texts of a format. `short_days` lets month and day have one digit."""
    out, at = "", 0
    for found in _TOKEN.finditer(pattern):
        token = found.group(0)
        out += pattern[at : found.start()].replace(".", r"\.")
        out += r"\d{1,2}" if short_days and token in ("MM", "dd") else _TOKENS[token]
        at = found.end()
    return out + pattern[at:].replace(".", r"\.")


def _by_shape(pattern: str) -> bool:
    rest = _TOKEN.sub("", pattern)
    return pattern.startswith("yyyy") and not re.search(r"[A-Za-z\[\]']", rest) and pattern[4:5] in ("-", "/", ".", "M")


def _checked(pattern: str) -> str:
    """The pattern, if it can name a date: a pattern that Spark cannot read would give NULL for every row."""
    letters = re.sub(r"'[^']*'", "", pattern)
    unknown = sorted(set(re.findall(r"[A-Za-z]", letters)) - set("GyMLdQqEaDFhHkKmsSVzOXx"))
    if unknown or not re.search(r"[yu]", letters) or letters.count("'"):
        raise ValueError(f"not a date pattern: {pattern!r}")
    return pattern


def _has_shape(text: Column, shapes: list[str]) -> Column:
    return text.rlike(f"^(?:{'|'.join(shapes)})$")


def read_first(text: Column, formats: tuple[str, ...], short_slash_days: bool = False) -> Column:
    """Timestamp of a text in one of the formats; NULL when it has no such shape or the date is impossible.

    Formats that begin with the year and consist of the known tokens are read by shape: those read the same way share one
    shape test, and no text has the shape of two. Any other format goes to Spark's own parser, after them.
    """
    shapes: dict[str, list[str]] = {}
    for pattern in filter(_by_shape, formats):
        way = "digits" if pattern.startswith("yyyyMMdd") else pattern[4]
        shapes.setdefault(way, []).append(shape_of(pattern, short_slash_days and way == "/"))
    out = None
    for way, alternatives in shapes.items():
        if way == "digits":
            plain = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3 ")
            plain = F.regexp_replace(plain, r"(\d{2})(\d{2})(\d{2})$", "$1:$2:$3")
        else:
            plain = text if way == "-" else F.translate(text, way, "-")
        fits, value = _has_shape(text, alternatives), plain.try_cast("timestamp")
        out = F.when(fits, value) if out is None else out.when(fits, value)
    own = [F.try_to_timestamp(text, F.lit(_checked(f))) for f in formats if not _by_shape(f)]
    return F.coalesce(*([] if out is None else [out]), *own)


def parse_any(c: Column, formats: tuple[str, ...] = fixed.PROFILE_DATE_FORMATS) -> Column:
    """Timestamp of the trimmed text in the one format it has; NULL when it has none."""
    return read_first(F.trim(c), tuple(formats))


def format_label(c: Column) -> Column:
    """Which known date layout a text has: of all labels whose pattern fits, the first."""
    fitting = [F.when(F.trim(c).rlike(pattern), label) for pattern, label in fixed.DATE_FORMAT_LABELS]
    return F.coalesce(*fitting, F.lit("OTHER"))


def zoned_instant(c: Column, zone: str) -> Column:
    """Standard local time text of `zone` as an instant; a bare date means midnight there."""
    text = F.trim(c)
    full = F.concat(text, F.lit(f" {zone}"))
    midnight = F.concat(text, F.lit(f" 00:00:00 {zone}"))
    out = F.when(_has_shape(text, [shape_of(fixed.STANDARD_TIMESTAMP)]), full.try_cast("timestamp"))
    return out.when(_has_shape(text, [shape_of(fixed.STANDARD_DATE)]), midnight.try_cast("timestamp"))


def strict_date(c: Column) -> Column:
    text = F.trim(c)
    return F.when(_has_shape(text, [shape_of(fixed.STANDARD_DATE)]), text.try_cast("date"))
