"""Counts and rates that describe a layer."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata import schema

STAGES = schema.EVENT_TYPES


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """(column, count), most frequent first."""
    return df.groupBy(column).count().orderBy(F.desc("count"), F.asc_nulls_last(column))


def flag_distribution(sessions: DataFrame, n: int = 20) -> DataFrame:
    """Sessions per combination of stages reached, most frequent first."""
    flags = [(F.col(f"has_{stage}") == 1).alias(stage) for stage in STAGES]
    return sessions.groupBy(*flags).count().orderBy(F.desc("count"), *STAGES).limit(n)


def null_rates(df: DataFrame) -> DataFrame:
    """(column_name, null_rate), all columns in one pass; 0 for an empty table."""
    rates = [_null_rate(name).alias(name) for name in df.columns]
    return df.agg(*rates).unpivot([], df.columns, "column_name", "null_rate")


def _null_rate(name: str) -> Column:
    return F.coalesce(F.avg(F.col(name).isNull().cast("int")), F.lit(0.0))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    repeated = df.groupBy(*keys).count().where("count > 1")
    return repeated.agg(F.count("*").alias("dup_keys"))


def profile(df: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, cols, null_rate (a struct by column) and, with keys, dup_keys."""
    out = df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("cols"),
        F.struct(*[_null_rate(name).alias(name) for name in df.columns]).alias("null_rate"),
    )
    if key_cols:
        out = out.withColumn("dup_keys", duplicate_keys(df, key_cols).scalar())
    return out


def warehouse_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def quality_bronze(bronze: DataFrame) -> DataFrame:
    """One row: rows."""
    return bronze.agg(F.count("*").alias("rows"))


def _counted(groups: DataFrame, rows: str, order: Sequence[Column], name: str) -> DataFrame:
    """One row: the sum of the groups' counts, and the groups themselves as one array of structs."""
    entry = F.struct(*groups.columns).alias("entry")
    ordered = F.sort_array(F.collect_list(F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)], entry)))
    return groups.agg(F.coalesce(F.sum("count"), F.lit(0)).alias(rows), ordered["entry"].alias(name))


def _distinct(df: DataFrame, column: str) -> Column:
    # Grouped, as Spark would merge several distinct counts into one aggregate that copies every row once for each.
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count("*")).scalar()


def quality_events(events: DataFrame) -> DataFrame:
    """One row: rows, distinct users, distinct products, distribution of the event types that there are.

    Three scans of one column each; hand in a stored table.
    """
    types = events.groupBy("event_type").agg(F.count("*").alias("count"))
    # NULL, if there is one, comes last among equals.
    order = [-F.col("count"), F.col("event_type").isNull(), F.col("event_type")]
    return _counted(types, "rows", order, "event_type_distribution").select(
        "rows",
        _distinct(events, "user_id").alias("distinct_users"),
        _distinct(events, "product_id").alias("distinct_products"),
        "event_type_distribution",
    )


def quality_sessions(sessions: DataFrame) -> DataFrame:
    """One row: sessions, distinct users, distribution of the stages reached, whatever values the flags have.

    Two scans; hand in a stored table.
    """
    flags = [(F.col(f"has_{stage}") == 1).alias(stage) for stage in STAGES]
    reached = sessions.groupBy(*flags).agg(F.count("*").alias("count"))
    return _counted(reached, "sessions", [-F.col("count"), *map(F.col, STAGES)], "funnel_flag_distribution").select(
        "sessions", _distinct(sessions, "user_id").alias("distinct_users"), "funnel_flag_distribution"
    )
