"""The supplied ``events`` test table in the raw feed's shape.

The table has an event id, a time, a user, a type, a value and a small JSON.
The mapping adds what the jobs must cope with: unreadable times, upper-case and
unknown types, missing keys, sessions and prices, repeats with another price,
users that start later and weeks that they skip.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
# Which events and weeks a user has, the item an event is about, and its type.
VISITS = [
    "event_id",
    "ts",
    "user_id",
    "value",
    "cast(get_json_object(props, '$.k') AS bigint) AS item",
    "datediff(cast(ts AS date), DATE '2024-01-01') AS day",
    """CASE WHEN event_type = 'click' THEN 'cart'
            WHEN event_type = 'purchase' AND event_id % 10 <> 0 THEN 'remove_from_cart'
            ELSE event_type END AS kind""",
]
STARTED = "day >= user_id % 4 * 7"
ACTIVE_WEEK = "(user_id div 4 + day div 7 * 2) % 3 <> 0"
# Every event stays: those before a user's start and in skipped weeks are another user's.
VISITOR = f"CASE WHEN {STARTED} AND {ACTIVE_WEEK} THEN user_id ELSE user_id + 1000000 END"
# One event in twenty arrives twice, the second time with another price.
COPIES = "explode(CASE WHEN event_id % 20 = 0 THEN array(0.0D, 1.0D) ELSE array(0.0D) END) AS surcharge"
FEED = [
    """CASE WHEN event_id % 211 = 0 THEN 'not-a-time'
            ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') || ' UTC' END AS event_time""",
    "CASE WHEN event_id % 7 = 0 THEN upper(kind) ELSE kind END AS event_type",
    "CASE WHEN event_id % 101 <> 0 THEN item END AS product_id",
    "CASE WHEN item % 13 <> 0 THEN item % 12 END AS category_id",
    "CASE WHEN item % 3 <> 0 THEN 'cat.' || item % 9 END AS category_code",
    "CASE WHEN item % 5 <> 0 THEN 'brand' || item % 8 END AS brand",
    "CASE WHEN event_id % 53 <> 0 THEN value + surcharge END AS price",
    "CASE WHEN event_id % 307 <> 0 THEN user_id END AS user_id",
    "CASE WHEN event_id % 97 <> 0 THEN 's' || day div 2 END AS user_session",
]


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the raw feed's columns, derived from ``<folder>/events.parquet``."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")
    visits = events.selectExpr(*VISITS).withColumn("user_id", F.expr(VISITOR))
    return visits.selectExpr("*", COPIES).selectExpr(*FEED)


def synthetic_scores(sessions: DataFrame) -> DataFrame:
    """(session_id, label, score): a repeatable score that leans towards the label and has many ties."""
    noise = "cast(conv(substr(session_id, 1, 7), 16, 10) AS bigint) % 1000"
    score = f"round(0.7D * ({noise}) / 1000 + 0.3D * has_purchase, 4) AS score"
    return sessions.selectExpr("session_id", "has_purchase AS label", score)
