"""Exact distinct users that add up: a bitmap of users for each day and event type.

Distinct counts of days cannot be added to those of weeks; bitmaps can be joined. The
users of a day and type are spread over buckets of 32,768 ids, each a bitmap of 4 KB, so
any number of users is counted exactly from stored days, without the events.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.operators.gold import STAGE_COUNTS
from clickstrata.operators.silver import require_fields


def day_bitmaps(events: DataFrame) -> DataFrame:
    """(event_date, event_type, bucket, users, events): the users of a day and type, and how many events they had.

    Events without a day, type or user are left out. Bitmaps are built map-side, so a day or user with most
    of the events sends one row per map task and bucket.
    """
    known = require_fields(events, ("event_date", "event_type", "user_id"))
    return known.groupBy("event_date", "event_type", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"), F.count("*").alias("events")
    )


def distinct_users(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """(by, users, events): exact distinct users and events of each group of bitmaps, of all without a group."""
    joined = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"), F.sum("events").alias("events"))
    names = joined.columns[: len(by)]
    return joined.groupBy(*names).agg(F.sum(F.bitmap_count("users")).alias("users"), F.sum("events").alias("events"))


def funnel_periods(bitmaps: DataFrame, unit: str = "month") -> DataFrame:
    """Events and distinct users by stage, and distinct users of any type, of each week, month, quarter or year."""
    period = F.trunc("event_date", unit).alias("period")
    joined = bitmaps.groupBy(period, "event_type", "bucket").agg(
        F.bitmap_or_agg("users").alias("users"), F.sum("events").alias("events")
    )
    of_any = joined.groupBy("period", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("users")).alias("users"),
        *[F.sum(F.when(F.col("event_type") == kind, F.col("events"))).alias(name) for name, kind in STAGE_COUNTS.items()],
        *[F.sum(F.when(F.col("event_type") == kind, F.bitmap_count("users"))).alias(f"{kind}_users") for kind in STAGE_COUNTS.values()],
    )
    columns = [*STAGE_COUNTS, *[f"{kind}_users" for kind in STAGE_COUNTS.values()]]
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in columns]
    return of_any.groupBy("period").agg(*sums, F.sum("users").alias("users"))
