"""Carried states: the users' weeks and the days' bitmaps."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clickstrata.operators import bitmaps, cohorts
from clickstrata.sources import read_nested

START = date(2021, 12, 28)


def activity(spark, seed=1, n=900, days=900, users=40):
    r = random.Random(seed)
    rows = [(r.choice(["view", "cart", "purchase", "other"]), START + timedelta(r.randrange(days)), r.choice([-5, 0, 1, 32_768, 32_769, 10**12, *range(2, users)])) for _ in range(n)]
    rows += [("view", None, 1), ("view", START, None), (None, START, 3)]
    return spark.createDataFrame(rows, "event_type string, event_date date, user_id long")


def test_retention_from_merged_states(spark, rows):
    """Three deliveries that overlap and come in any order; users with years between their events."""
    events = activity(spark)
    cuts = [START + timedelta(k) for k in (0, 250, 600, 900)]
    parts = [events.where(F.col("event_date").between(low - timedelta(20), high)) for low, high in zip(cuts, cuts[1:])]
    state = cohorts.week_state(parts[2])
    for part in (parts[0], parts[1]):
        state = cohorts.merge_week_states(state, cohorts.week_state(part))
    assert rows(cohorts.retention_from_state(state)) == rows(cohorts.cohort_retention(events))
    assert rows(cohorts.retention_from_state(cohorts.week_state(events))) == rows(cohorts.cohort_retention(events))


def test_state_is_one_row_per_user_and_word(spark):
    events = activity(spark)
    state = cohorts.week_state(events)
    assert state.groupBy("user_id", "word").count().where("count > 1").isEmpty()
    assert state.count() <= 46 * 4


@pytest.mark.parametrize("day", [date(1969, 12, 1), date(1970, 1, 4), date(1970, 1, 5), date(2400, 2, 29)])
def test_weeks_of_any_century(spark, rows, day):
    events = spark.createDataFrame([(day, 1), (day + timedelta(434), 1)], "event_date date, user_id long")
    assert rows(cohorts.retention_from_state(cohorts.week_state(events))) == rows(cohorts.cohort_retention(events))


@pytest.mark.parametrize("unit", ["week", "month", "quarter", "year"])
def test_periods_from_stored_days(spark, tmp_path, rows, unit):
    events = activity(spark, 2)
    path = str(tmp_path / "days")
    bitmaps.day_bitmaps(events).write.parquet(path)
    known = events.where("event_date is not null and user_id is not null and event_type is not null")

    def users(kind):
        return F.count_distinct(F.when(F.col("event_type") == kind, F.col("user_id"))).alias(f"{kind}_users")

    expected = known.groupBy(F.trunc("event_date", unit).alias("period")).agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"{kind}s") for kind in ("view", "cart", "purchase")],
        *map(users, ("view", "cart", "purchase")),
        F.count_distinct("user_id").alias("users"),
    )
    found = bitmaps.funnel_periods(spark.read.parquet(path), unit)
    assert rows(found) == rows(expected.select(found.columns))


def test_distinct_users_of_all(spark):
    events = activity(spark, 3)
    known = events.where("event_date is not null and user_id is not null and event_type is not null")
    found = bitmaps.distinct_users(bitmaps.day_bitmaps(events)).first()
    assert (found["users"], found["events"]) == (known.select("user_id").distinct().count(), known.count())


def test_empty(spark):
    events = activity(spark).limit(0)
    assert cohorts.retention_from_state(cohorts.week_state(events)).isEmpty()
    assert bitmaps.funnel_periods(bitmaps.day_bitmaps(events)).isEmpty()


def test_nested_folders_with_other_columns(spark, tmp_path, rows):
    spark.createDataFrame([(1, "a")], "k long, brand string").write.parquet(str(tmp_path / "x/2024/01"))
    spark.createDataFrame([(2, 5.0)], "k long, price double").write.parquet(str(tmp_path / "x/late=1/deep/er"))
    found = read_nested(spark, str(tmp_path / "x"))
    assert rows(found, "k", "brand", "price") == [(1, "a", None), (2, None, 5.0)]
