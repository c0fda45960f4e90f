"""Small hand-made tables."""

from datetime import datetime

from clickstrata import schema
from clickstrata.operators.bronze import ingest_events

SF_DIR = "/root/testdata/sf0.001"
BRONZE_DEFAULTS = dict(
    event_type="view", product_id=1, category_id=None, category_code=None, brand=None, price=1.0, user_id=1,
    user_session="a",
)


def raw(spark, *events):
    """Raw rows; each event is a dict over the defaults with ``event_time`` as text."""
    full = [{**BRONZE_DEFAULTS, "event_time": "2024-01-01 00:00:00 UTC", **e} for e in events]
    return spark.createDataFrame([tuple(e[n] for n in schema.RAW_EVENTS.names) for e in full], schema.RAW_EVENTS)


def events(spark, *rows):
    """Silver-shaped events, without deduplication."""
    return ingest_events(raw(spark, *rows)).select(*schema.FACT_EVENT_COLUMNS)


def scores(spark, *triples):
    return spark.createDataFrame(list(triples), "session_id string, label int, score double")


def ts(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
