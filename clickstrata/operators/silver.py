"""Bronze to silver: canonical types, required fields, one row per event."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.functions import canonical_event_type

# Which copy survives: the cheapest, then by the remaining attributes.
SURVIVOR_ORDER = ("price", "category_id", "category_code", "brand")


def with_canonical_types(df: DataFrame) -> DataFrame:
    """Replaces ``event_type`` with its canonical form."""
    return df.withColumn("event_type", canonical_event_type())


def require_fields(df: DataFrame, columns: Sequence[str] = schema.REQUIRED_EVENT_FIELDS) -> DataFrame:
    """Rows in which all the columns are present. A plain filter, so Parquet scans get it pushed down."""
    present: list[Column] = [F.col(name).isNotNull() for name in columns]
    return df.where(reduce(Column.__and__, present))


def dedup_events(
    df: DataFrame,
    keys: Sequence[str] = schema.EVENT_IDENTITY,
    order: Sequence[str] = SURVIVOR_ORDER,
) -> DataFrame:
    """One row per key, always the same one; NULL keys equal each other.

    Catalyst turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well, so of a key repeated across the whole table each map task
    sends one row.
    """
    copies = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(name) for name in order])
    return df.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")


def clean_events(bronze: DataFrame) -> DataFrame:
    """The ``fact_events`` layer. One shuffle, on the event identity."""
    valid = require_fields(with_canonical_types(bronze))
    return dedup_events(valid).select(*schema.FACT_EVENT_COLUMNS)
