import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import cleansing, predicates, temporal
from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import content_hash, key_value_text, percent, rate


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "c string").select(expression(F.col("c")).alias("r")).first()["r"]


def many(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r["r"] for r in rows.select("i", expression(F.col("c")).alias("r")).orderBy("i").collect()]


def masked(text):
    found = re.match(r"^([^@\s]{1,2})[^@\s]*(@.+)$", text)
    if found:
        return f"{found[1]}***{found[2]}"
    return re.sub(r"(01[0-9])[\s.\-]?(\d{3,4})[\s.\-]?(\d{4})", r"\1-****-\3", text)


def test_mask(spark):
    values = ["kim@example.com", "k@x.kr", "call 010 4568 3510 or 01012345678", "010.1234.5678", "plain", "", "+82-10-1234"]
    assert many(spark, cleansing.mask_pii, values) == [masked(v) for v in values]
    assert one(spark, cleansing.mask_pii, None) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="01 -.@ab9", max_size=24), min_size=40, max_size=40))
def test_mask_agrees_with_plain_regex(spark, values):
    assert many(spark, cleansing.mask_pii, values) == [masked(v) for v in values]


def test_whitespace(spark):
    values = ["  a b\t", "　 x ", " \n ", "", None]
    assert many(spark, cleansing.trim_all_space, values) == ["a b", "x", None, None, None]


def test_phone(spark):
    values = ["010-4568-3510", "010 456 3510", "+82-10-1234-5678", "010-12-34", "02-123-4567", None]
    assert many(spark, cleansing.standard_phone, values) == [
        "01045683510", "0104563510", "+82-10-1234-5678", "010-12-34", "02-123-4567", None,
    ]
    hyphen = lambda c: cleansing.standard_phone(c, "HYPHEN")
    assert many(spark, hyphen, ["010 4568 3510", "0104563510"]) == ["010-4568-3510", "010-456-3510"]


def test_datetime(spark):
    values = {
        "2026-01-05 10:00:00": "2026-01-05 10:00:00", "2026/1/5 10:00:00": "2026-01-05 10:00:00",
        "2026/01/05 10:00": "2026-01-05 10:00:00", "2026.01.05 10:00:01": "2026-01-05 10:00:01",
        "2026-01-05T10:00:00": "2026-01-05 10:00:00", "20260105100000": "2026-01-05 10:00:00",
        "2026-01-05 10:00": "2026-01-05 10:00:00", "2026-02-30 10:00:00": "2026-02-30 10:00:00",
        "2026/13/40 10:00:00": "2026/13/40 10:00:00", "2026-01-05": "2026-01-05", "unknown": "unknown", "2026-1-5 10:00:00": "2026-1-5 10:00:00",
        "2026-01-05 25:00:00": "2026-01-05 25:00:00",
    }
    assert many(spark, cleansing.standard_datetime, list(values)) == list(values.values())
    dates = {"2026/1/5": "2026-01-05", "2026.01.05": "2026-01-05", "20260105": "2026-01-05", "20261305": "20261305", "1990/3/15": "1990-03-15"}
    as_date = lambda c: cleansing.standard_datetime(c, "DATE")
    assert many(spark, as_date, list(dates)) == list(dates.values())


def test_shapes_read_like_formatters(spark):
    """Every format reads exactly what Spark's own formatter reads with the same pattern."""
    values = [
        "2026-01-05 10:11:12", "2026-01-05 10:11:12.345", "2026-01-05T10:11:12Z", "2026-01-05T10:11:12+09:00",
        "2026-01-05T10:11:12.345+09:00", "2026-01-05T10:11:12", "2026-01-05", "2026/01/05 10:11", "2026/01/05", "2026.01.05",
        "2026/01/05 10:11:12", "2026.01.05 10:11:12", "20260105101112", "20260105", "2026-02-29", "2024-02-29", "26-01-05", "2026-01-05 24:00:00",
        "2026-01-05 10:60:00", "x2026-01-05", "2026-01-05 ", "", "9999-12-31", "2026-1-5", "2026/1/5",
    ]
    for formats in (fixed.PROFILE_DATE_FORMATS, fixed.CLEANSING_TIMESTAMP_FORMATS, fixed.CLEANSING_DATE_FORMATS):
        plain = lambda c: F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in formats])  # noqa: E731,B023
        ours = lambda c: temporal.parse_any(c, formats)  # noqa: E731,B023
        assert many(spark, ours, values) == many(spark, plain, values)


def test_zoned_instant(spark):
    text = lambda c: F.date_format(temporal.zoned_instant(c, "Asia/Seoul"), "yyyy-MM-dd HH:mm:ss")
    assert many(spark, text, ["2026-01-05 09:00:00", " 2026-01-05 ", "2026/01/05", None, ""]) == [
        "2026-01-05 00:00:00", "2026-01-04 15:00:00", None, None, None,
    ]
    summer = lambda c: F.date_format(temporal.zoned_instant(c, "Europe/Berlin"), "yyyy-MM-dd HH:mm:ss")
    assert one(spark, summer, "2026-07-01 12:00:00") == "2026-07-01 10:00:00"


def test_predicates(spark):
    assert many(spark, predicates.null_error, [None, "", " ", "a"]) == [True, True, False, False]
    ranged = lambda c: predicates.range_error(c, 0.0, 10.0)
    assert many(spark, ranged, ["0", "10", "10.5", "x", None, "-1"]) == [False, False, True, True, True, True]
    matched = lambda c: predicates.pattern_error(c, "b")
    assert many(spark, matched, ["abc", "a", None]) == [False, True, True]
    rows = spark.createDataFrame([("2026-01-01", "2026/01/02"), ("2026-01-03", "2026/01/02"), ("x", "2026/01/02"), (None, "2026-01-01")], "a string, b string")
    assert [r[0] for r in rows.select(predicates.order_error(F.col("a"), F.col("b"))).collect()] == [False, True, True, True]


def test_sequence_status(spark):
    rows = spark.createDataFrame([("2026-01-01", "2026-01-02"), ("2026-01-02", "2026-01-01"), (None, "2026-01-01"), ("x", "2026-01-01")], "a string, b string")
    assert [r[0] for r in rows.select(predicates.sequence_status(["a", "b"])).collect()] == ["ORDERED", "REVERSED", "CONTAINS_NULL", "REVERSED"]
    assert [r[0] for r in rows.select(predicates.sequence_status(["a", "b"], unparsable=True)).collect()][3] == "UNPARSABLE"


def test_rates_round_half_up(spark):
    rows = spark.createDataFrame([(3, 60000), (1, 3), (1, 16), (0, 0)], "p long, w long")
    assert [r[0] for r in rows.select(percent(F.col("p"), F.col("w"))).collect()] == [0.01, 33.33, 6.25, 0.0]
    assert rows.select(rate(F.col("p"), F.col("w"), 6)).collect()[1][0] == 0.333333


def test_hash_keeps_parts_apart(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "n"), ("n", None)], "a string, b string")
    assert len({r[0] for r in rows.select(content_hash(["a", "b"])).collect()}) == 4


def test_key_value_text(spark):
    rows = spark.createDataFrame([("1", None)], "a string, b string")
    assert rows.select(key_value_text(["a", "b"])).first()[0] == "a=1, b=NULL"
