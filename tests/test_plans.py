"""Shapes of the physical plans that the scale of the data depends on."""

import pytest

import __spark_entry__ as registry
from clickstrata import schema
from clickstrata.operators import cohorts, experiment, gold, quality, silver
from clickstrata.operators.features import session_event_features, session_features
from clickstrata.operators.sessions import build_sessions
from clickstrata.sources import read_layer, write_layer
from clickstrata.sources.files import layer_path

MODELS = {name for name in registry.queries() if name.startswith(("gbt_", "logistic_"))} | {"feature_importance", "score_summary", "model_report"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_events(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    events = silver.clean_events(registry._bronze(spark, sf_dir))
    write_layer(events, layer_path(root, "fact_events"))
    return read_layer(spark, root, "fact_events")


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - MODELS))
def test_no_query_pairs_rows_without_a_key(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "Python" not in text


def test_scans_read_only_what_is_needed(stored_events):
    def read_schema(df):
        return plan(df).split("ReadSchema: struct<")[1].split(">")[0]

    assert read_schema(cohorts.cohort_retention(stored_events)) == "event_date:date,user_id:bigint"
    assert read_schema(experiment.user_purchases(stored_events)) == "event_type:string,user_id:bigint,price:double"
    assert "category" not in read_schema(build_sessions(stored_events))


def test_filters_reach_the_scan(stored_events):
    text = plan(silver.require_fields(stored_events, schema.REQUIRED_GOLD_FIELDS))
    assert "IsNotNull(event_type)" in text.split("PushedFilters: [")[1].split("]")[0]


def test_stage_users_need_no_row_expansion(stored_events):
    text = plan(gold.funnel_daily(stored_events))
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 2


def test_retention_scans_once_and_joins_nothing(stored_events):
    text = plan(cohorts.cohort_retention(stored_events))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_session_ids_are_not_computed_per_event(stored_events):
    text = plan(session_features(build_sessions(stored_events), stored_events))
    assert "sha2" not in "".join(line for line in text.splitlines() if "Filter" in line or "FileScan" in line)


def expands_scan(df):
    """Whether rows are copied for several distinct counts right above a scan."""
    lines = plan(df).splitlines()
    for k, line in enumerate(lines):
        if "Expand" in line:
            below = next((x for x in lines[k + 1 :] if "Aggregate" in x or "FileScan" in x), "")
            if "FileScan" in below:
                return True
    return False


def test_distinct_counts_do_not_copy_events(stored_events):
    assert not expands_scan(session_event_features(stored_events))
    assert "Expand" not in plan(quality.quality_events(stored_events))
    assert "Expand" not in plan(quality.quality_sessions(build_sessions(stored_events)))


def test_checking_assignments_costs_no_extra_scan(spark, stored_events, tmp_path):
    path = str(tmp_path / "assigned")
    experiment.assign_variants(stored_events).write.parquet(path)
    assigned = spark.read.parquet(path)
    text = plan(experiment.experiment_arms(assigned, experiment.user_purchases(stored_events)))
    assert text.count("FileScan") == 2 and "raise_error" in text
