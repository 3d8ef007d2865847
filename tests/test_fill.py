"""Gaps of a table are filled from work on the columns that have some."""

from __future__ import annotations

from zonalis.operators import imputation


def test_only_lacking_columns_get_medians_and_modes(spark, monkeypatch):
    asked = []
    plain = imputation.exact_percentiles

    def watched(df, keys, columns, *rest):
        asked.extend(columns)
        return plain(df, keys, columns, *rest)

    monkeypatch.setattr(imputation, "exact_percentiles", watched)
    rows = [(1.0, 5, float("nan"), "x", None, None), (None, 7, 2.0, "y", "b", None), (4.0, 9, 3.0, "y", "b", None)]
    df = spark.createDataFrame(rows, "full_not double, full int, odd double, t string, gap string, none string")
    got = [tuple(r) for r in imputation.fill_remaining(df, ["full_not", "full", "odd"], ["t", "gap", "none"]).orderBy("full").collect()]
    assert asked == ["full_not"]
    assert [r[0] for r in got] == [1.0, 2.5, 4.0] and [r[3:] for r in got] == [("x", "b", "unknown"), ("y", "b", "unknown"), ("y", "b", "unknown")]
    assert imputation.fill_remaining(df.limit(0), ["full"], ["t"]).count() == 0
