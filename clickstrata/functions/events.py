"""Column expressions on event columns. All stay inside whole-stage codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickstrata import schema


def parse_event_time(raw: str = "event_time") -> Column:
    """Timestamp of a ``2019-11-01 15:35:08 UTC`` text; NULL where it does not parse."""
    stripped = F.regexp_replace(raw, schema.EVENT_TIME_SUFFIX, "")
    return F.try_to_timestamp(stripped, F.lit(schema.EVENT_TIME_FORMAT))


def canonical_event_type(raw: str = "event_type") -> Column:
    """Lower-cased type when it is one the funnel knows, else NULL."""
    lowered = F.lower(raw)
    return F.when(lowered.isin(*schema.EVENT_TYPES), lowered)


def is_event(kind: str) -> Column:
    """1 on rows of the given event type, else 0."""
    return F.coalesce((F.col("event_type") == kind).cast("int"), F.lit(0))


def event_count(kind: str) -> Column:
    """Aggregate: rows of the given event type."""
    return F.count_if(F.col("event_type") == kind)


def purchase_revenue() -> Column:
    """Price on purchases (unpriced ones bring 0), 0 elsewhere."""
    return F.coalesce(F.when(F.col("event_type") == "purchase", F.col("price")), F.lit(0.0))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, 0.0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def session_label() -> Column:
    """The feed's session text with the missing ones spelled out."""
    return F.coalesce("user_session", F.lit(schema.MISSING_SESSION))


def session_key(user: str = "user_id", label: Column | str | None = None) -> Column:
    """SHA-256 over user and session label: the same id on every run and engine.

    The digest is never NULL. Saying so spares the not-null filter that a join
    on the id would otherwise push down to the events, one digest per event.
    """
    label = session_label() if label is None else label
    text = F.concat_ws(schema.SESSION_SEPARATOR, F.col(user).cast("string"), label)
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def category_key() -> Column:
    """Category code, or the id as text where there is no code."""
    return F.coalesce("category_code", F.col("category_id").cast("string"))
