"""The registered heatmap with gaps has a column for every week of the feed."""

import __spark_entry__ as registry


def test_weeks_after_the_ninth(spark, sf_dir, monkeypatch):
    rows = [("2024-01-01", k, 10 - k, 10, (10 - k) / 10) for k in range(0, 12, 11)]
    retention = spark.createDataFrame(rows, "cohort_week string, week_index int, active long, size long, retention_rate double")
    monkeypatch.setattr(registry, "_retention", lambda spark, folder: retention)
    out = registry.queries()["cohort_heatmap_gaps"](spark, sf_dir)
    assert out.columns == ["cohort_week", *(f"week_{k}" for k in range(12))]
    row = out.first()
    assert row["week_0"] == 1.0 and row["week_9"] is None and row["week_11"] == -0.1
