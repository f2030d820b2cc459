"""Keys are counted once for both duplicate profiles."""

from tidemark.operators import profile as p
from tidemark.plans import profiling


def test_keys_are_counted_once_and_metrics_agree(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("b", 1, "x"), (None, 1, "x"), (None, 1, "x"), (None, None, "z")],
        "k string, m int, v string",
    )
    spec = p.TableProfile("t", ["k", "m"], {"v": "GENERAL"})
    counted, key_counts = [], p.key_counts
    monkeypatch.setattr(p, "key_counts", lambda df, keys, *name: counted.append(keys) or key_counts(df, keys, *name))
    out = profiling.profile_frame(rows, spec, "d")
    assert counted.count(["k", "m"]) == 1
    found = dict(map(tuple, out["duplicate_summary"].collect()))
    assert found == {
        "key_columns": "k,m", "row_count": "7", "distinct_row_count": "5", "row_duplicate_count": "2", "row_duplicate_ratio": found["row_duplicate_ratio"],
        "key_null_count": "3", "duplicate_key_value_count": "2", "duplicate_extra_count": "3", "max_duplicate_count": "3",
    }
    merged = p.merged_duplicates(p.row_states(rows, ["k", "m"]), ["k", "m"])
    assert found == dict(map(tuple, merged.collect()))
    assert [tuple(r) for r in out["duplicate_key_rows"].collect()] == [("a", 1, 3), (None, 1, 2)]
    none = dict(map(tuple, p.duplicate_summary(rows.limit(0), ["k"]).collect()))
    assert none["row_count"] == none["distinct_row_count"] == none["max_duplicate_count"] == "0"
