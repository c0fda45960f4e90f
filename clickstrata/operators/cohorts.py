"""Weekly retention by the week of a user's first event. Weeks start on Monday."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _week_index():
    # Both days are Mondays, so whole weeks lie between them.
    return F.expr("datediff(activity_week, cohort_week) div 7")


def user_first_week(events: DataFrame) -> DataFrame:
    """(user_id, cohort_week)."""
    return events.groupBy("user_id").agg(F.trunc(F.min("event_date"), "week").alias("cohort_week"))


def user_weekly_activity(events: DataFrame) -> DataFrame:
    """Distinct (user_id, activity_week)."""
    return events.select("user_id", F.trunc("event_date", "week").alias("activity_week")).distinct()


def cohort_activity(first_weeks: DataFrame, weekly: DataFrame) -> DataFrame:
    """Each user's active weeks next to the user's cohort, from the first week on."""
    return (
        first_weeks.join(weekly, "user_id")
        .select("cohort_week", "activity_week", _week_index().alias("week_index"), "user_id")
        .where("week_index >= 0")
    )


def cohort_retention(events: DataFrame) -> DataFrame:
    """(cohort_week, activity_week, week_index, cohort_size, active_users, retention_rate).

    One scan and no join: the events shrink to distinct (user, week) rows, the
    first week is the minimum within the user's weeks, and as every user is
    active in the first week, a cohort's size is its count at index 0.
    """
    weekly = user_weekly_activity(events).where("user_id is not null and activity_week is not null")
    placed = weekly.withColumn("cohort_week", F.min("activity_week").over(Window.partitionBy("user_id")))
    counts = placed.groupBy("cohort_week", "activity_week").agg(F.count("*").alias("active_users"))
    return _rated(counts)


def _rated(counts: DataFrame) -> DataFrame:
    """The mart from active users by cohort and week."""
    at_start = F.when(F.col("activity_week") == F.col("cohort_week"), F.col("active_users"))
    sized = counts.withColumn("cohort_size", F.max(at_start).over(Window.partitionBy("cohort_week")))
    return sized.select(
        "cohort_week",
        "activity_week",
        _week_index().alias("week_index"),
        "cohort_size",
        "active_users",
        (F.col("active_users") / F.col("cohort_size")).alias("retention_rate"),
    ).orderBy("cohort_week", "week_index")


# Weeks as bits, counted from a Monday; a word leaves the sign bit of a long alone.
FIRST_MONDAY = "1970-01-05"
WORD_BITS = 62


def week_state(events: DataFrame) -> DataFrame:
    """(user_id, word, bits): the weeks in which each user is active, a bit for each week.

    A user has a row for every 62 weeks in which there is an event, so a state of all time is no larger than
    its users and years. Events without a user or day are left out.
    """
    monday = F.trunc("event_date", "week")
    week = F.floor(F.date_diff(monday, F.lit(FIRST_MONDAY).cast("date")) / 7)
    placed = events.where("user_id is not null and event_date is not null").select("user_id", week.alias("_week"))
    word = F.floor(F.col("_week") / WORD_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_week", F.lit(WORD_BITS)).cast("int"))
    return placed.groupBy("user_id", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def merge_week_states(*states: DataFrame) -> DataFrame:
    """The state of all the events behind the states; overlapping ones do no harm."""
    return reduce(DataFrame.unionByName, states).groupBy("user_id", "word").agg(F.bit_or("bits").alias("bits"))


def retention_from_state(state: DataFrame) -> DataFrame:
    """:func:`cohort_retention` from the users' weeks, without a pass over the events."""
    lowest = F.bit_count(F.col("bits").bitwiseAND(-F.col("bits")) - 1)
    start = F.min(F.col("word") * WORD_BITS + lowest).over(Window.partitionBy("user_id"))
    inside = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda k: F.call_function("bit_get", F.col("bits"), k) == 1)
    numbers = F.transform(inside, lambda k: F.col("word") * WORD_BITS + k)
    weeks = state.withColumn("_start", start).select("_start", F.explode(numbers).alias("_week"))

    def monday(week):
        return F.date_add(F.lit(FIRST_MONDAY).cast("date"), (F.col(week) * 7).cast("int"))

    counts = weeks.groupBy("_start", "_week").agg(F.count("*").alias("active_users"))
    return _rated(counts.select(monday("_start").alias("cohort_week"), monday("_week").alias("activity_week"), "active_users"))


def weeks_between(retention: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the retention mart within a span of week indexes."""
    return retention.where(F.col("week_index").between(first, last))
