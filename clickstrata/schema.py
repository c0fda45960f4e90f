"""Schemas and column lists shared by the layers."""

from pyspark.sql import types as T

# The raw feed's column names and types, the stored layers'
# column order, the event types kept, and the model inputs.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)
EVENT_TYPES = ("view", "cart", "purchase")
BRONZE_COLUMNS = (
    "event_ts event_date event_type product_id category_id category_code "
    "brand price user_id user_session year month"
).split()
FACT_EVENT_COLUMNS = (
    "event_ts event_date event_type user_id user_session product_id "
    "category_id category_code brand price year month"
).split()
FACT_SESSION_COLUMNS = (
    "session_id user_id session_start_ts session_end_ts session_duration_s "
    "num_events n_view n_cart n_purchase has_view has_cart has_purchase "
    "session_date year month"
).split()
REQUIRED_EVENT_FIELDS = ("event_ts", "event_type", "user_id", "product_id")
REQUIRED_GOLD_FIELDS = ("event_date", "event_type", "user_id", "product_id")
EVENT_IDENTITY = ("event_ts", "event_type", "user_id", "product_id", "user_session")
FEATURES = (
    "num_events n_view n_cart session_duration_s hour day_of_week day_of_month "
    "distinct_products_viewed distinct_categories avg_view_price max_view_price "
    "prior_sessions prior_purchases prior_conversion_rate"
).split()
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TIME_SUFFIX = r"\s+UTC$"
SESSION_SEPARATOR = "::"
MISSING_SESSION = "NULL"
EXPERIMENT_ID = "exp_checkout_ui_v1"
EXPERIMENT_METRIC = "conversion_rate"
