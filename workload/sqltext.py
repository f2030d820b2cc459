"""Pieces of the checking SQL."""

from __future__ import annotations

# Layouts of the accepted date formats in the checking engine's notation. Layouts with zone offsets or
# fractions are left out, because no text in the given tables has them.
PROFILE_LAYOUTS = (
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%Y/%m/%d %H:%M", "%Y/%m/%d", "%Y.%m.%d",
)
CLEANSING_LAYOUTS = (
    "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y.%m.%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M",
    "%Y/%m/%d %H:%M", "%Y%m%d%H%M%S",
)
STANDARD = "%Y-%m-%d %H:%M:%S"


def parse(text: str, layouts=PROFILE_LAYOUTS) -> str:
    return "coalesce(" + ", ".join(f"try_strptime(trim({text}), '{x}')" for x in layouts) + ")"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '{STANDARD}')"


def trim_all(text: str) -> str:
    return rf"nullif(regexp_replace({text}, '^[\s\x{{00A0}}\x{{3000}}]+|[\s\x{{00A0}}\x{{3000}}]+$', '', 'g'), '')"


def phone(text: str) -> str:
    digits = rf"regexp_replace({text}, '[\s.\-]', '', 'g')"
    return (
        rf"CASE WHEN regexp_matches({text}, '^(?:[0-9]|[\s.\-])+$') AND regexp_matches({digits}, '^01[0-9][0-9]{{7,8}}$')"
        f" THEN {digits} ELSE {text} END"
    )


def datetime_text(text: str, layouts=CLEANSING_LAYOUTS, standard: str = STANDARD) -> str:
    month = rf"regexp_replace({text}, '^(\d{{4}})/(\d)/', '\1/0\2/')"
    padded = rf"regexp_replace({month}, '^(\d{{4}}/\d{{2}})/(\d)($|[^0-9])', '\1/0\2\3')"
    parsed = "coalesce(" + ", ".join(f"try_strptime({padded}, '{x}')" for x in layouts) + ")"
    return f"coalesce(strftime({parsed}, '{standard}'), {text})"


def mask(text: str) -> str:
    email = r"^([^@\s]{1,2})[^@\s]*(@.+)$"
    number = r"(01[0-9])[\s.\-]?(\d{3,4})[\s.\-]?(\d{4})"
    return (
        rf"CASE WHEN regexp_matches({text}, '{email}') THEN regexp_replace({text}, '{email}', '\1***\2')"
        rf" ELSE regexp_replace({text}, '{number}', '\1-****-\3', 'g') END"
    )


def rate(part: str, whole: str, digits: int) -> str:
    scale = f"{float(10**digits)}::DOUBLE"
    return f"CASE WHEN {whole} > 0 THEN floor(({part}) * {scale} / ({whole}) + 0.5::DOUBLE) / {scale} ELSE 0.0::DOUBLE END"


def percent(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN floor(({part}) * 10000.0::DOUBLE / ({whole}) + 0.5::DOUBLE) / 100.0::DOUBLE ELSE 0.0::DOUBLE END"


def content_hash(fields: list[str], length: int = 16) -> str:
    parts = [
        f"CASE WHEN {f} IS NULL THEN 'n' ELSE 'v' || CAST(length(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR) END"
        for f in fields
    ]
    return f"substr(sha1({' || '.join(parts)}), 1, {length})"
