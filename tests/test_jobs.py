"""The stored jobs, from CSV files to the model report."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import feeds
from clickstrata import schema
from clickstrata.operators import curves, models, ranking
from clickstrata.operators.features import assign_split, session_features
from clickstrata.operators.model_tables import LogisticModel, TreeModel
from clickstrata.plans import run_bronze, run_gold, run_lakehouse, run_modelling, run_sessions, run_silver
from clickstrata.plans.modelling import Cuts
from clickstrata.sources import export_parquet, read_layer
from clickstrata.sources.sample_feed import raw_events


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw_events(spark, sf_dir).write.option("header", True).csv(f"{root}/raw")
    marts = run_lakehouse(spark, f"{root}/raw", root)
    return root, marts


@pytest.fixture(scope="module")
def dataset(spark, lake):
    root, _ = lake
    events, sessions = (read_layer(spark, root, name) for name in ("fact_events", "fact_sessions"))
    export_parquet(session_features(sessions, events), f"{root}/dataset")
    return spark.read.parquet(f"{root}/dataset")


@pytest.fixture(scope="module")
def sizes(sf_dir):
    """Rows of a query's result by its SQL."""
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    return lambda query: duck.execute(f"SELECT count(*) FROM ({registry.oracle_sql()[query]})").fetchone()[0]


QUERY_OF = {"bronze_events": "bronze_ingest", "fact_events": "clean_events", "fact_sessions": "build_sessions",
            "product_daily": "product_daily", "user_daily": "user_daily", "funnel_daily": "funnel_daily"}


def test_layers_match_the_queries(spark, sf_dir, lake, sizes):
    root, _ = lake
    for name, query in QUERY_OF.items():
        assert read_layer(spark, root, name).count() == sizes(query), name
    stored = registry._comparable(read_layer(spark, root, "product_daily"))
    queried = registry.queries()["product_daily"](spark, sf_dir)
    assert stored.select(queried.columns).exceptAll(queried).isEmpty()


def test_marts_and_reports(spark, lake, sizes):
    root, marts = lake
    assert {name: df.count() for name, df in marts.items()} == {
        "mart_cohort_weekly_retention": sizes("cohort_retention"), "mart_experiment_readout": 1,
        "mart_session_funnel_daily": sizes("session_funnel_daily")}
    assert spark.sql("SELECT max(retention_rate) FROM mart_cohort_weekly_retention").first()[0] == 1.0
    report = spark.read.json(f"{root}/reports/quality_silver_events").first()
    assert report["rows"] == sizes("clean_events") == sum(e["count"] for e in report["event_type_distribution"])
    assert spark.read.json(f"{root}/reports/quality_bronze").first()["rows"] == sizes("bronze_ingest")
    assert spark.read.json(f"{root}/reports/quality_silver_sessions").first()["sessions"] == sizes("build_sessions")
    assert spark.read.json(f"{root}/reports/quality_gold_features").first()["tables"]["user_daily"]


def test_rebuilt_layers_keep_nothing_stale(spark, tmp_path):
    """A month whose only event is no longer a known one leaves no rows in the later layers."""
    root = str(tmp_path)
    day = {"event_time": "2024-01-05 00:00:00 UTC"}, {"event_time": "2024-03-05 00:00:00 UTC", "user_session": "b"}
    for change in ({}, {"event_type": "remove_from_cart"}):
        run_bronze(spark, feeds.raw(spark, day[0], day[1] | change), root)
        for job in (run_silver, run_sessions, run_gold):
            job(spark, root)
    for name in ("fact_sessions", "product_daily", "user_daily", "funnel_daily"):
        assert {r["month"] for r in read_layer(spark, root, name).select("month").collect()} == {1}, name


def test_rerun_is_identical(spark, lake, rows):
    root, _ = lake
    before = {name: rows(read_layer(spark, root, name)) for name in ("fact_events", "fact_sessions")}
    run_lakehouse(spark, f"{root}/raw", root)
    for name, old in before.items():
        assert rows(read_layer(spark, root, name)) == old


def test_modelling(spark, lake, sizes):
    root, _ = lake
    report = run_modelling(spark, root, gbt_iter=3, logistic_iter=30, min_rows_per_leaf=3, max_rows=40).first()
    assert report["dataset_profile"]["rows"] == sizes("build_sessions")
    assert (report["logistic_sampling"]["rows"], report["logistic_sampling"]["sampled"]) == (40, True)
    assert {(m["model"], m["split"]) for m in report["models"]} == {
        (m, s) for m in ("logistic_regression", "boosted_trees") for s in ("validation", "test")}
    for entry in report["models"]:
        assert 0 <= entry["roc_auc"] <= 1 and 0 <= entry["pr_auc"] <= 1
        assert len(entry["ranking"]) == 3 and len(entry["confusion_matrix"]) == 2
        assert entry["pr_curve"]["x"][-1] == 0.0 and entry["roc_curve"]["y"][-1] == 1.0
    assert len(report["feature_importance"]) == 14
    scores = spark.read.parquet(f"{root}/gold/ml_session_scores")
    assert scores.count() == report["score_summary"]["rows"] == sizes("build_sessions")
    assert dict(scores.dtypes) == {"session_id": "string", "prediction_score": "float", "label": "int"}
    again = TreeModel.load(spark, f"{root}/models/session_boosted_trees", schema.FEATURES)
    features = spark.read.parquet(f"{root}/gold/ml_session_dataset")
    assert models.as_exported(again.scores(features)).exceptAll(scores).isEmpty()
    logistic = LogisticModel.load(spark, f"{root}/models/session_logistic_regression")
    assert logistic.scores(features).count() == scores.count() and set(logistic.coefficients) == set(schema.FEATURES)


def test_splits_read_only_their_months(spark, tmp_path):
    """The model table is stored by month: date bounds of a split reach its folders."""
    days = [f"2024-0{month}-{day:02d}" for month in range(1, 7) for day in (3, 17)]
    table = spark.createDataFrame([(d, k) for k, d in enumerate(days)], "session_date string, n long").withColumn("session_date", F.col("session_date").cast("date"))
    path = str(tmp_path / "table")
    table.withColumns({"year": F.year("session_date"), "month": F.month("session_date")}).write.partitionBy("year", "month").parquet(path)
    stored = spark.read.parquet(path)
    cuts = Cuts.of(stored)
    found = {}
    for split in ("train", "validation", "test"):
        part = cuts.part(stored, split)
        text = part._jdf.queryExecution().executedPlan().toString()
        assert "month" in text.split("PartitionFilters: [")[1].split("]")[0]
        found[split] = {str(r["session_date"]) for r in part.collect()}
        expected = assign_split(stored).where(F.col("split") == split).collect()
        assert found[split] == {str(r["session_date"]) for r in expected}
    assert sum(map(len, found.values())) == 12
    assert len({f.split("/month=")[1][0] for f in cuts.part(stored, "test").inputFiles()}) >= 1


def test_models_learn(dataset):
    """Scored on their own training rows, both models must rank far better than chance."""
    for model in (models.train_logistic(dataset), models.train_gbt(dataset, max_iter=5, min_rows_per_leaf=2)):
        steps = curves.score_steps(ranking.score_table(models.score_sessions(model, dataset)))
        assert curves.roc_auc(steps).first()[0] > 0.75


def test_best_round():
    assert models.best_round([3.0, 2.0, 2.5, 1.0, 1.5], patience=5) == 4
    assert models.best_round([3.0, 2.0, 2.5, 2.2, 1.0], patience=2) == 2
    assert models.best_round([3.0, 2.0, 1.0], patience=1) == 3
    assert models.best_round([1.0, 2.0, 3.0], patience=30) == 1


def test_early_stopping_keeps_the_best_rounds(dataset):
    """On flipped labels the validation loss rises from the start: one round stays."""
    flipped = dataset.withColumn("label", 1 - dataset["label"])
    settings = dict(max_iter=4, min_rows_per_leaf=5)
    assert models.train_gbt(dataset, flipped, **settings).stages[-1].getNumTrees == 1
    assert models.train_gbt(dataset, dataset, **settings).stages[-1].getNumTrees == 4


def test_shorter_model_has_the_first_rounds_of_the_longer(dataset):
    long, short = (
        models.train_gbt(dataset, max_iter=n, min_rows_per_leaf=5).stages[-1].trees for n in (4, 2)
    )

    def nodes(tree):
        return tree.toDebugString.split("\n", 1)[1]

    assert [nodes(t) for t in short] == [nodes(t) for t in long[:2]]


def test_empty_validation_part_counts_as_none(dataset):
    alone = models.train_gbt(dataset, max_iter=2, min_rows_per_leaf=5)
    with_empty = models.train_gbt(dataset, dataset.limit(0), max_iter=2, min_rows_per_leaf=5)
    assert models.score_sessions(alone, dataset).exceptAll(models.score_sessions(with_empty, dataset)).isEmpty()


def test_logistic_is_the_balanced_optimum(dataset):
    """The gradient of C * sum(weighted log loss) + |b|^2 / 2 vanishes at the fitted coefficients."""
    c = 0.5
    fitted = models.train_logistic(dataset, c=c, max_iter=1000).stages[-1]
    table = dataset.toPandas()
    x, y = table[schema.FEATURES].to_numpy(), table["label"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    slope, intercept = fitted.coefficients.toArray(), fitted.intercept
    error = weight * (1 / (1 + np.exp(-(x @ slope + intercept))) - y)
    gradient = (c * x.T @ error + slope) * np.maximum(x.std(axis=0), 1e-9)
    start = c * x.T @ (weight * (0.5 - y)) * np.maximum(x.std(axis=0), 1e-9)
    assert np.abs(gradient).max() < 1e-3 * np.abs(start).max()
    assert abs(error.sum()) < 1e-3 * len(y)
