"""Session feature table, its profile and its split by time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.functions import category_key, safe_ratio, session_key, session_label

# Where the ordered days are cut.
TRAIN_SHARE = 0.7
VALIDATION_SHARE = 0.85
SPLITS = ("train", "validation", "test")


def session_event_features(events: DataFrame) -> DataFrame:
    """Distinct viewed products, distinct categories, mean and top view price per session.

    Events are first grouped by session, viewed product and category, map-side too. The two
    distinct counts, which copy their input rows, then see these groups and not the events.
    """
    is_view = F.col("event_type") == "view"
    view_price = F.when(is_view, F.col("price"))
    seen = events.groupBy(
        "user_id",
        session_label().alias("_label"),
        F.when(is_view, F.col("product_id")).alias("_product"),
        category_key().alias("_category"),
    ).agg(F.sum(view_price).alias("_total"), F.count(view_price).alias("_priced"), F.max(view_price).alias("_top"))
    per_session = seen.groupBy("user_id", "_label").agg(
        F.count_distinct("_product").cast("double").alias("distinct_products_viewed"),
        F.count_distinct("_category").cast("double").alias("distinct_categories"),
        F.try_divide(F.sum("_total"), F.sum("_priced")).alias("avg_view_price"),
        F.max("_top").alias("max_view_price"),
    )
    return per_session.withColumn("session_id", session_key(label="_label")).drop("user_id", "_label")


def prior_user_history(sessions: DataFrame) -> DataFrame:
    """Sessions and purchases of the user on strictly earlier days, per (user_id, session_date).

    The window runs over daily totals: a user has at most one row per day,
    however many sessions there are, and sessions of one day do not see each other.
    """
    daily = sessions.groupBy("user_id", "session_date").agg(
        F.count("*").alias("_sessions"), F.sum("has_purchase").alias("_purchases")
    )
    earlier = (
        Window.partitionBy("user_id").orderBy("session_date").rowsBetween(Window.unboundedPreceding, -1)
    )

    def total(name):
        return F.coalesce(F.sum(name).over(earlier), F.lit(0)).cast("double")

    return daily.select(
        "user_id",
        "session_date",
        total("_sessions").alias("prior_sessions"),
        total("_purchases").alias("prior_purchases"),
    )


def session_features(sessions: DataFrame, events: DataFrame) -> DataFrame:
    """The modelling table: ids, dates, label and :data:`schema.FEATURES`, all double.

    Purchase counts of the session itself are not among the features. Both
    joins are on keys that are unique on the right; on the left a user-day with
    very many sessions is cut by adaptive skew-join handling.
    """
    start = "session_start_ts"
    base = sessions.select(
        "session_id",
        "user_id",
        start,
        "session_end_ts",
        "session_date",
        F.col("has_purchase").cast("int").alias("label"),
        *[F.col(name).cast("double") for name in ("num_events", "n_view", "n_cart", "session_duration_s")],
        F.hour(start).cast("double").alias("hour"),
        (F.dayofweek(start) - 1).cast("double").alias("day_of_week"),
        F.dayofmonth(start).cast("double").alias("day_of_month"),
    )
    joined = base.join(session_event_features(events), "session_id", "left").join(
        prior_user_history(sessions), ["user_id", "session_date"], "left"
    )
    rated = joined.withColumn("prior_conversion_rate", safe_ratio("prior_purchases", "prior_sessions"))
    return rated.select(
        "session_id",
        "user_id",
        start,
        "session_end_ts",
        "session_date",
        "label",
        *[F.coalesce(name, F.lit(0.0)).alias(name) for name in schema.FEATURES],
    )


PROFILE_MEANS = (
    "num_events n_view n_cart session_duration_s distinct_products_viewed "
    "distinct_categories prior_sessions prior_conversion_rate"
).split()


def dataset_profile(features: DataFrame) -> DataFrame:
    """One row: size, purchase rate, first and last day, means."""
    return features.agg(
        F.count("*").alias("rows"),
        F.avg("label").alias("purchase_rate"),
        F.min("session_date").alias("min_date"),
        F.max("session_date").alias("max_date"),
        *[F.avg(name).alias(f"avg_{name}") for name in PROFILE_MEANS],
    )


def time_split(df: DataFrame, date: str = "session_date") -> DataFrame:
    """One row: train_end, validation_end, test_start, from the ordered distinct days.

    The days gather into one array, which the calendar bounds: decades make
    some ten thousand entries. Fewer than three days raise an error when run.
    """
    days = df.select(date).where(F.col(date).isNotNull()).distinct()
    ordered = days.agg(F.sort_array(F.collect_list(date)).alias("days"))
    too_few = F.raise_error(F.lit("a time-based split needs at least 3 distinct days"))
    n = F.size("days")
    checked = ordered.select(F.when(n >= 3, F.col("days")).otherwise(too_few).alias("days"))
    train = F.greatest(F.floor(n * F.lit(TRAIN_SHARE)) - 1, F.lit(0))
    validation = F.least(F.greatest(train + 1, F.floor(n * F.lit(VALIDATION_SHARE)) - 1), n - 2)

    def day(index):
        return F.get("days", index.cast("int"))

    return checked.select(
        day(train).alias("train_end"),
        day(validation).alias("validation_end"),
        day(validation + 1).alias("test_start"),
    )


def assign_split(df: DataFrame, cuts: DataFrame | None = None, date: str = "session_date") -> DataFrame:
    """Adds ``split``: train, validation or test. The cut days come in as one scalar subquery."""
    cuts = time_split(df, date) if cuts is None else cuts
    ends = cuts.select(F.struct("train_end", "validation_end")).scalar()
    day = F.col(date)
    name = (
        F.when(day <= ends["train_end"], SPLITS[0])
        .when(day <= ends["validation_end"], SPLITS[1])
        .otherwise(SPLITS[2])
    )
    return df.withColumn("split", name)


def split_counts(with_split: DataFrame) -> DataFrame:
    """(split, rows, purchase_rate) in the order train, validation, test."""
    place = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    return (
        with_split.groupBy("split")
        .agg(F.count("*").alias("rows"), F.avg("label").alias("purchase_rate"))
        .orderBy(place)
    )
