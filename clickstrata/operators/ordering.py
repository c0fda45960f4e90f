"""Global positions and running totals without a single-partition window.

``ordered`` range-sorts a table, notes each row's part and place in it, and
stores the result. From there a position is the place within the part plus the
size of the parts before it, and a running total is a window within the part
plus the totals of the parts before it. Range bounds are drawn on the whole sort
key, so a value shared by very many rows is spread over several parts.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.sources.scratch import stage

PART, PLACE = "_part", "_place"


def ordered(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` sorted by ``by`` and ``order``, stored once with its parts. Eager.

    Sorting draws its range bounds from a sample; a second evaluation could draw
    others. Storing the table keeps later passes in agreement, also when
    executors are lost. ``order`` should end in a unique key.
    """
    placed = df.orderBy(*by, *order).withColumns(
        {PART: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}
    )
    return stage(placed, "ordered")


def _join_parts(df: DataFrame, parts: DataFrame, by: Sequence[str]) -> DataFrame:
    # Without groups there is one row per part, at most spark.sql.shuffle.partitions of them.
    # Groups add theirs; stored, the table has a known size and the planner broadcasts it only if small.
    return df.join(stage(parts, "parts") if by else F.broadcast(parts), [*by, PART])


# The windows below run over one row per part (and group), never over the table itself.


def _before(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def _totals(columns: Sequence[str], by: Sequence[str]) -> list[Column]:
    whole = Window.partitionBy(*by)
    return [
        out
        for name in columns
        for out in (
            F.coalesce(F.sum(name).over(_before(by)), F.lit(0)).alias(f"{name}_before"),
            F.sum(name).over(whole).alias(f"{name}_total"),
        )
    ]


def positions(stored: DataFrame, totals: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Adds ``position`` (from 1), ``rows_total`` and ``<column>_total`` per group. No shuffle of the rows."""
    parts = stored.groupBy(*by, PART).agg(
        F.count("*").alias("rows"), F.min(PLACE).alias("_first"), *[F.sum(name).alias(name) for name in totals]
    )
    offsets = parts.select(*by, PART, "_first", *_totals(["rows", *totals], by))
    position = F.col(PLACE) - F.col("_first") + F.col("rows_before") + 1
    joined = _join_parts(stored, offsets, by).withColumn("position", position)
    return joined.drop(PART, PLACE, "_first", "rows_before", *[f"{name}_before" for name in totals])


def running_totals(
    rows: DataFrame, columns: Sequence[str], by: Sequence[str] = (), stored: DataFrame | None = None
) -> DataFrame:
    """Adds ``<column>_running`` (inclusive) and ``<column>_total`` per group, in the stored order.

    ``rows`` is a stored table or derived from one. Where the columns are already
    in the stored table, passing it spares the part totals the derivation.
    """
    source = rows if stored is None else stored
    parts = source.groupBy(*by, PART).agg(*[F.sum(name).alias(name) for name in columns])
    offsets = parts.select(*by, PART, *_totals(columns, by))
    within = Window.partitionBy(*by, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    joined = _join_parts(rows, offsets, by)
    running = {f"{name}_running": F.sum(name).over(within) + F.col(f"{name}_before") for name in columns}
    return joined.withColumns(running).drop(*[f"{name}_before" for name in columns])


def next_row(
    rows: DataFrame, columns: Sequence[str], by: Sequence[str] = (), stored: DataFrame | None = None
) -> DataFrame:
    """Adds ``<column>_next``, the value on the following row of the group, across parts too."""
    source = rows if stored is None else stored
    firsts = source.groupBy(*by, PART).agg(
        *[F.min_by(name, PLACE).alias(f"_first_{name}") for name in columns]
    )
    following = Window.partitionBy(*by).orderBy(PART)
    heads = firsts.select(
        *by, PART, *[F.lead(f"_first_{name}").over(following).alias(f"_head_{name}") for name in columns]
    )
    within = Window.partitionBy(*by, PART).orderBy(PLACE)
    ahead = {
        f"{name}_next": F.coalesce(F.lead(name).over(within), F.col(f"_head_{name}")) for name in columns
    }
    return _join_parts(rows, heads, by).withColumns(ahead).drop(*[f"_head_{name}" for name in columns])
