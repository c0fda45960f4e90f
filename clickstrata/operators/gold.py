"""Daily aggregates over events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.functions import event_count, purchase_revenue, safe_ratio
from clickstrata.operators.silver import require_fields

STAGE_COUNTS = {"views": "view", "carts": "cart", "purchases": "purchase"}
FUNNEL_RATES = {
    "view_to_cart_rate": ("carts", "views"),
    "cart_to_purchase_rate": ("purchases", "carts"),
    "view_to_purchase_rate": ("purchases", "views"),
}
USER_RATES = {"cart_rate": ("carts", "views"), "purchase_rate": ("purchases", "views")}


def _counts():
    return [event_count(kind).alias(name) for name, kind in STAGE_COUNTS.items()]


def _with_rates(df: DataFrame, rates: dict[str, tuple[str, str]]) -> DataFrame:
    calendar = {"year": F.year("event_date"), "month": F.month("event_date")}
    return df.withColumns({**{name: safe_ratio(*parts) for name, parts in rates.items()}, **calendar})


def _daily(events: DataFrame, entity: str, counted: str, alias: str) -> DataFrame:
    # A single distinct count: Spark first aggregates on (date, entity, counted), which also
    # spreads an entity with most of the events over many tasks.
    return (
        require_fields(events, schema.REQUIRED_GOLD_FIELDS)
        .groupBy("event_date", entity)
        .agg(*_counts(), F.sum(purchase_revenue()).alias("revenue"), F.count_distinct(counted).alias(alias))
    )


def product_daily(events: DataFrame) -> DataFrame:
    """Counts, revenue, distinct users and event-level rates per day and product."""
    return _with_rates(_daily(events, "product_id", "user_id", "unique_users"), FUNNEL_RATES)


def user_daily(events: DataFrame) -> DataFrame:
    """Counts, revenue, distinct products and event-level rates per day and user."""
    return _with_rates(_daily(events, "user_id", "product_id", "unique_products"), USER_RATES)


def stage_users(user_days: DataFrame) -> DataFrame:
    """Event counts and distinct users per stage and day, from one row per day and user.

    A user counts for a stage on the days with at least one such event, so
    three filtered distinct counts come down to plain counts, without the
    row-tripling that several distinct aggregates cost.
    """
    reached = [
        F.count_if(F.col(name) > 0).alias(f"{kind}_users") for name, kind in STAGE_COUNTS.items()
    ]
    return user_days.groupBy("event_date").agg(*[F.sum(name).alias(name) for name in STAGE_COUNTS], *reached)


def funnel_daily(events: DataFrame) -> DataFrame:
    """Site-wide counts, users per stage and event-level rates per day."""
    user_days = (
        require_fields(events, schema.REQUIRED_GOLD_FIELDS).groupBy("event_date", "user_id").agg(*_counts())
    )
    return funnel_from_user_daily(user_days)


def funnel_from_user_daily(user_days: DataFrame) -> DataFrame:
    """:func:`funnel_daily` from the stored ``user_daily`` layer: no pass over the events."""
    return _with_rates(stage_users(user_days), FUNNEL_RATES)
