"""Raw feed to bronze: typed times and calendar columns. Narrow, no shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.functions import parse_event_time


def parse_times(raw: DataFrame) -> DataFrame:
    """Adds ``event_ts``."""
    return raw.withColumn("event_ts", parse_event_time())


def add_calendar(df: DataFrame, ts: str, date: str) -> DataFrame:
    """Adds the day of ``ts`` under the name ``date``, and ``year`` and ``month``."""
    return df.withColumns({date: F.to_date(ts), "year": F.year(ts), "month": F.month(ts)})


def drop_unparsed(df: DataFrame) -> DataFrame:
    """Without the rows whose time did not parse."""
    return df.where(F.col("event_ts").isNotNull())


def ingest_events(raw: DataFrame) -> DataFrame:
    """The bronze layer of a raw feed."""
    dated = add_calendar(drop_unparsed(parse_times(raw)), "event_ts", "event_date")
    return dated.select(*schema.BRONZE_COLUMNS)
