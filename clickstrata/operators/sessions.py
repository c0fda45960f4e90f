"""Events to sessions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.functions import event_count, session_key, session_label
from clickstrata.operators.bronze import add_calendar


def session_aggregates(events: DataFrame) -> DataFrame:
    """Start, end and event counts per session.

    Grouping is on the raw user and label, which name a session as uniquely as
    its digest does: the hash aggregate works on short keys, and SHA-256 runs
    once per session rather than once per event. All buffers are fixed-width
    numbers, so a session with most of the events is combined map-side.
    """
    grouped = events.groupBy("user_id", session_label().alias("_label")).agg(
        F.min("event_ts").alias("session_start_ts"),
        F.max("event_ts").alias("session_end_ts"),
        F.count("*").alias("num_events"),
        event_count("view").alias("n_view"),
        event_count("cart").alias("n_cart"),
        event_count("purchase").alias("n_purchase"),
    )
    return grouped.withColumn("session_id", session_key(label="_label")).drop("_label")


def session_flags(sessions: DataFrame) -> DataFrame:
    """Adds whole-second duration, ``has_*`` flags and the calendar of the session's start."""
    seconds = F.unix_seconds("session_end_ts") - F.unix_seconds("session_start_ts")
    flags = {f"has_{kind}": (F.col(f"n_{kind}") > 0).cast("int") for kind in schema.EVENT_TYPES}
    return add_calendar(
        sessions.withColumns({"session_duration_s": seconds, **flags}), "session_start_ts", "session_date"
    )


def build_sessions(events: DataFrame) -> DataFrame:
    """The ``fact_sessions`` layer. A user's events without a session form one session."""
    return session_flags(session_aggregates(events)).select(*schema.FACT_SESSION_COLUMNS)


def session_ids(events: DataFrame) -> DataFrame:
    """(user_id, session_id) of the sessions that events belong to; a digest for each session, not for each event."""
    labels = events.select("user_id", session_label().alias("_label")).distinct()
    return labels.select("user_id", session_key(label="_label").alias("session_id"))


def reaching_sessions(sessions: DataFrame, first: int, last: int, ids: DataFrame) -> DataFrame:
    """Stored sessions that new events of the numbered months ``first`` to ``last`` can change.

    These are the sessions that began in or before ``last`` and ended in or after ``first``, which may have
    lost events, and those among ``ids``, the sessions that have events there now, wherever they lay before.
    """
    ended = F.year("session_end_ts") * 12 + F.month("session_end_ts")
    overlaps = (F.col("year") * 12 + F.col("month") <= last) & (ended >= first)
    marked = ids.select("session_id", F.lit(True).alias("_has_events"))
    found = sessions.select("session_id", "user_id", "session_end_ts", "year", "month").join(marked, "session_id", "left")
    return found.where(overlaps | F.col("_has_events")).drop("_has_events")


def session_months(sessions: DataFrame) -> list[int]:
    """The numbered months between start and end of each session; the calendar bounds how many there are."""
    ended = F.year("session_end_ts") * 12 + F.month("session_end_ts")
    months = sessions.select(F.explode(F.sequence(F.col("year") * 12 + F.col("month"), ended)).alias("month"))
    return sorted(row["month"] for row in months.distinct().collect())


def rebuild_sessions(events: DataFrame, ids: DataFrame) -> DataFrame:
    """The sessions named by (user_id, session_id), from events among which are all of theirs."""
    # By user first: most events of others go before any digest is taken.
    theirs = events.join(ids.select("user_id").distinct(), "user_id", "left_semi")
    return build_sessions(theirs).join(ids, ["user_id", "session_id"], "left_semi").select(*schema.FACT_SESSION_COLUMNS)
