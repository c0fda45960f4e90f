import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickstrata.functions import chi_square_sf, erfc, two_sided_p
from clickstrata.operators import cohorts, experiment
from clickstrata.operators.reporting import cohort_heatmap, overview_kpis, top_rows
from clickstrata.operators.sessions import build_sessions

from feeds import events


def _cohort_feed(spark):
    return events(
        spark,
        {"user_id": 1, "event_time": "2023-12-31 12:00:00 UTC"},
        {"user_id": 1, "event_time": "2024-01-01 12:00:00 UTC"},
        {"user_id": 1, "event_time": "2024-01-15 12:00:00 UTC"},
        {"user_id": 2, "event_time": "2023-12-25 00:00:00 UTC"},
        {"user_id": 3, "event_time": "2024-01-07 23:59:59 UTC"},
        {"user_id": 3, "event_time": "2024-01-07 23:59:59 UTC"},
    )


def test_cohorts_over_the_year_boundary(spark):
    feed = _cohort_feed(spark)
    found = [tuple(r) for r in cohorts.cohort_retention(feed).collect()]
    assert found == [
        (date(2023, 12, 25), date(2023, 12, 25), 0, 2, 2, 1.0),
        (date(2023, 12, 25), date(2024, 1, 1), 1, 2, 1, 0.5),
        (date(2023, 12, 25), date(2024, 1, 15), 3, 2, 1, 0.5),
        (date(2024, 1, 1), date(2024, 1, 1), 0, 1, 1, 1.0),
    ]
    joined = cohorts.cohort_activity(cohorts.user_first_week(feed), cohorts.user_weekly_activity(feed))
    counts = joined.groupBy("cohort_week", "week_index").agg(F.count_distinct("user_id").alias("n")).collect()
    assert {(r[0], r[1]): r[2] for r in counts} == {(r[0], r[2]): r[4] for r in found}
    assert top_rows(cohorts.cohort_retention(feed), ["cohort_week", "week_index"], 2).count() == 2
    assert cohorts.weeks_between(cohorts.cohort_retention(feed), 1, 8).count() == 2


def test_heatmap_fill(spark):
    retention = cohorts.cohort_retention(_cohort_feed(spark))
    filled = [tuple(r) for r in cohort_heatmap(retention, range(4)).collect()]
    assert filled == [(date(2023, 12, 25), 1.0, 0.5, 0.0, 0.5), (date(2024, 1, 1), 1.0, 0.0, 0.0, 0.0)]
    assert cohort_heatmap(retention, range(4), fill=None).first()["week_2"] is None


def test_erfc(spark):
    points = [k / 40 for k in range(0, 1080)]
    df = spark.createDataFrame([(x,) for x in points], "x double")
    for row in df.select("x", erfc("x").alias("y")).collect():
        assert math.isclose(row["y"], math.erfc(row["x"]), rel_tol=1e-12)
    tails = df.select("x", two_sided_p("x").alias("p"), chi_square_sf("x").alias("q"))
    row = tails.where("x = 2.5").first()
    assert math.isclose(row["p"], math.erfc(2.5 / math.sqrt(2)), rel_tol=1e-12)
    assert math.isclose(row["q"], math.erfc(math.sqrt(1.25)), rel_tol=1e-12)


def _experiment(spark, control, treatment):
    """Arms as (users, buyers); every buyer pays 10."""
    feed, assigned, user = [], [], 0
    for arm, (users, buyers) in (("control", control), ("treatment", treatment)):
        for i in range(users):
            user += 1
            assigned.append((user, arm))
            feed.append({"user_id": user})
            if i < buyers:
                feed.append({"user_id": user, "event_type": "purchase", "price": 10.0})
    return events(spark, *feed), spark.createDataFrame(assigned, "user_id long, variant string")


def test_readout(spark):
    feed, assigned = _experiment(spark, (50, 10), (40, 12))
    row = experiment.experiment_readout(feed, assigned).first()
    p_c, p_t = 0.2, 0.3
    margin = 1.96 * math.sqrt(p_c * 0.8 / 50 + p_t * 0.7 / 40)
    assert row["lift"] == pytest.approx(0.1)
    assert (row["ci_low"], row["ci_high"]) == (pytest.approx(0.1 - margin), pytest.approx(0.1 + margin))
    assert (row["srm_flag"], row["p_value"]) == (1, None)
    assert row["lift_revenue_per_user"] == pytest.approx(1.0)
    summary = experiment.experiment_summary(experiment.experiment_readout(feed, assigned)).first()
    assert summary["error_below"] == pytest.approx(margin)


def test_enhanced_readout(spark):
    feed, assigned = _experiment(spark, (50, 10), (40, 12))
    row = experiment.experiment_readout_enhanced(feed, assigned).first()
    pooled = 22 / 90
    z = 0.1 / math.sqrt(pooled * (1 - pooled) * (1 / 50 + 1 / 40))
    assert row["z_statistic"] == pytest.approx(z)
    assert row["conversion_p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-12)
    assert row["chi_squared_srm"] == pytest.approx(50 / 45)
    assert row["srm_flag"] == 0
    assert row["incremental_conversions"] == pytest.approx(4.0)
    assert row["incremental_revenue"] == pytest.approx(40.0)
    assert row["relative_lift"] == pytest.approx(0.5)


def test_equal_arms_and_no_conversions(spark):
    row = experiment.experiment_readout_enhanced(*_experiment(spark, (5, 0), (5, 0))).first()
    assert (row["chi_squared_srm"], row["srm_p_value"], row["conversion_p_value"]) == (0.0, 1.0, 1.0)
    assert row["relative_lift"] == 0.0
    # The floored variance keeps the interval from collapsing.
    assert row["ci_high"] == pytest.approx(1.96e-6)


def test_missing_arm(spark):
    feed, assigned = _experiment(spark, (3, 1), (0, 0))
    plain = experiment.experiment_readout(feed, assigned).first()
    assert (plain["control_n"], plain["treatment_n"], plain["lift"], plain["srm_flag"]) == (3, None, None, 0)
    enhanced = experiment.experiment_readout_enhanced(feed, assigned).first()
    assert enhanced["control_value"] == pytest.approx(1 / 3)
    for name in ("absolute_effect", "relative_lift", "ci_low", "conversion_p_value", "srm_p_value", "srm_flag"):
        assert enhanced[name] is None


def test_assigned_users_without_events_count(spark):
    feed, assigned = _experiment(spark, (4, 2), (4, 2))
    more = assigned.unionByName(spark.createDataFrame([(99, "treatment")], assigned.schema))
    row = experiment.experiment_readout(feed, more).first()
    assert (row["treatment_n"], row["treatment_converters"], row["treatment_value"]) == (5, 2, 0.4)


def test_assignment_is_stable_and_salted(spark, rows):
    users = spark.range(1, 2001).withColumnRenamed("id", "user_id")
    first = rows(experiment.assign_variants(users))
    assert first == rows(experiment.assign_variants(users.union(users).repartition(5)))
    share = sum(v == "control" for _, v in first) / len(first)
    assert 0.46 < share < 0.54
    assert first != rows(experiment.assign_variants(users, salt="other"))


def test_overview(spark):
    feed, assigned = _experiment(spark, (5, 2), (5, 3))
    kpis = overview_kpis(
        build_sessions(feed), cohorts.cohort_retention(feed), experiment.experiment_readout(feed, assigned)
    ).first()
    assert (kpis["total_sessions"], kpis["conversion_rate"], kpis["week1_retention"]) == (10, 0.5, None)
    assert kpis["experiment_lift"] == pytest.approx(0.2)


def test_a_user_with_two_arms_is_an_error(spark):
    feed, assigned = _experiment(spark, (3, 1), (3, 2))
    twice = assigned.unionByName(assigned)
    assert experiment.experiment_readout(feed, twice).collect() == experiment.experiment_readout(feed, assigned).collect()
    both = assigned.unionByName(spark.createDataFrame([(1, "treatment")], assigned.schema))
    with pytest.raises(Exception, match="two variants of user 1"):
        experiment.experiment_readout(feed, both).collect()
