"""Profiles over several batches from stored states, and metadata in several files."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.profile import TableProfile
from tidemark.plans import profiling
from tidemark.plans.profile_history import ProfileHistory
from tidemark.sources import files

SPEC = TableProfile(
    "t", ["k"], {"k": "BUSINESS_KEY", "c": "CODE", "d": "DATE_DATETIME", "e": "DATE_DATETIME", "x": "TEXT"},
    date_formats={"d": ("yyyy-MM-dd",), "e": ("yyyy-MM-dd",)}, expected_patterns={"c": "^[A-Z]$"}, sequences=[["d", "e"]],
)
ROWS = [
    ("b1", "1", "A", "2024-01-01", "2024-01-02", "one"), ("b1", "1", "A", "2024-01-01", "2024-01-02", "one"),
    ("b1", "2", None, "2024-01-03", "2024-01-02", " "), ("b1", None, " ", None, "x", ""),
    ("b2", "1", "A", "2024-01-01", "2024-01-02", "one"), ("b2", "2", "b", "2024-02-30", None, None),
    ("b2", None, "A", "2023-01-01", "2024-01-02", "é" * 300), ("b3", "3", "A", "2024-01-01", "2024-01-02", "one"),
]


def whole(frame):
    return sorted(map(repr, (sorted(r.asDict().items()) for r in frame.collect())))


def test_states_add_up(spark, layout):
    rows = spark.createDataFrame(ROWS, "ingest_date string, k string, c string, d string, e string, x string")
    history = ProfileHistory(spark, layout, SPEC)
    history.add(rows.filter("k = '1'"), "b2")  # a first delivery that is corrected below
    for batch in ("b3", "b1", "b2"):
        history.add(rows.filter(F.col("ingest_date") == batch), batch)

    def same(batches):
        wanted = rows.filter(F.col("ingest_date").isin(*batches)).drop("ingest_date")
        wanted = profiling.profile_frame(wanted, SPEC, "")
        got = history.profile(batches)
        assert set(got) == set(wanted) - {"summary"}
        for kind, frame in got.items():
            assert frame.columns == wanted[kind].columns
            assert whole(frame) == whole(wanted[kind]), kind

    same(["b1", "b2"])
    same(["b3"])
    assert whole(history.profile()["duplicate_summary"]) == whole(history.profile(["b1", "b2", "b3"])["duplicate_summary"])
    history.add(rows.limit(0), "b1")  # delivered again, empty
    assert whole(history.profile(["b1", "b3"])["duplicate_summary"]) == whole(history.profile(["b3"])["duplicate_summary"])
    history.remove("b2")
    assert whole(history.profile()["duplicate_summary"]) == whole(history.profile(["b3"])["duplicate_summary"])
    same([])
    with pytest.raises(ValueError, match="cannot be a key"):
        ProfileHistory(spark, layout, TableProfile("t", ["ingest_date"], {"k": "GENERAL"}))


def test_lines_are_numbered_through_files(spark, tmp_path):
    """Marks, repeated and missing headers, quoted line ends, an empty file, and the largest file last."""
    many = "".join(f"r{i},v\n" for i in range(500))
    parts = {"a.csv": '﻿K,V\nx,"1\n2"\n', "b.csv": "﻿K,V\n", "c.csv": "y,\nz,3\n", "d.csv": "", "e.csv": f"K,V\nK,V\n{many}"}
    for name, text in parts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = files.read_metadata_csv(spark, str(tmp_path), ordinal="N").collect()
    got = [tuple(r) for r in sorted(rows, key=lambda r: int(r[0]))]
    want = [("x", "1\n2"), ("y", None), ("z", "3"), ("K", "V"), *((f"r{i}", "v") for i in range(500))]
    assert got == [(str(i), *row) for i, row in enumerate(want, 1)]
    assert files.read_metadata_csv(spark, str(tmp_path)).columns == ["K", "V"]
    (tmp_path / "f.csv").write_text("V,K\n1,q\n", encoding="utf-8")
    with pytest.raises(ValueError, match="another order"):
        files.read_metadata_csv(spark, str(tmp_path))


def test_a_header_is_needed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("K,\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no complete header"):
        files.read_metadata_csv(spark, str(tmp_path))
