"""Session-level daily funnel; its rates differ from the event-level ones in ``gold``."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions import safe_ratio


def session_funnel_daily(sessions: DataFrame) -> DataFrame:
    """Sessions per day that reached each stage, and rates between the stages.

    ``view_to_cart_rate`` and ``view_to_purchase_rate`` compare totals and may
    pass 1; ``cart_to_purchase_rate`` counts only purchases in sessions with a cart.
    """
    both = F.count_if((F.col("has_cart") == 1) & (F.col("has_purchase") == 1))
    daily = sessions.groupBy(F.col("session_date").alias("event_date")).agg(
        F.count("*").alias("sessions_total"),
        F.sum("has_view").alias("sessions_with_view"),
        F.sum("has_cart").alias("sessions_with_cart"),
        F.sum("has_purchase").alias("sessions_with_purchase"),
        both.alias("_cart_and_purchase"),
    )
    rates = {
        "view_to_cart_rate": safe_ratio("sessions_with_cart", "sessions_with_view"),
        "cart_to_purchase_rate": safe_ratio("_cart_and_purchase", "sessions_with_cart"),
        "view_to_purchase_rate": safe_ratio("sessions_with_purchase", "sessions_with_view"),
    }
    return daily.withColumns(rates).drop("_cart_and_purchase").orderBy("event_date")
