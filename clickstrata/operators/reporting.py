"""Tables behind the charts and the overview."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FUNNEL_RATE_SERIES = ("view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate")
FUNNEL_COUNT_SERIES = (
    "sessions_total",
    "sessions_with_view",
    "sessions_with_cart",
    "sessions_with_purchase",
)


def overview_kpis(sessions: DataFrame, retention: DataFrame, readout: DataFrame) -> DataFrame:
    """One row: total_sessions, conversion_rate, week1_retention (mean over cohorts), experiment_lift."""
    week1 = retention.where("week_index = 1").agg(F.avg("retention_rate"))
    return sessions.agg(
        F.count("*").alias("total_sessions"), F.avg("has_purchase").alias("conversion_rate")
    ).withColumns({"week1_retention": week1.scalar(), "experiment_lift": readout.select("lift").scalar()})


def cohort_heatmap(
    retention: DataFrame, weeks: Sequence[int] | None = None, fill: float | None = 0.0, at_least: int = 0
) -> DataFrame:
    """Retention with one row per cohort and one column per week; ``fill=None`` leaves gaps NULL.

    Without ``weeks``, all weeks up to the last one in the data have a column, and the first ``at_least`` in any case.
    """
    if weeks is None:
        last = retention.agg(F.max("week_index")).first()[0]
        weeks = range(max(at_least, 0 if last is None else last + 1))
    wide = retention.groupBy("cohort_week").pivot("week_index", list(weeks)).agg(F.first("retention_rate"))
    names = {str(week): f"week_{week}" for week in weeks}
    out = wide.withColumnsRenamed(names)
    return (out if fill is None else out.fillna(fill, list(names.values()))).orderBy("cohort_week")


def funnel_series(funnel: DataFrame, series: Sequence[str] = FUNNEL_RATE_SERIES) -> DataFrame:
    """(event_date, series, value), long form."""
    values = [F.col(name).cast("double").alias(name) for name in series]
    return funnel.select("event_date", *values).unpivot(["event_date"], list(series), "series", "value")


def score_histogram(scores: DataFrame, bins: int = 50) -> DataFrame:
    """(label, bin, bin_start, n, density): equal-width bins, density integrates to 1 per label."""
    span = scores.agg(F.struct(F.min("score").alias("low"), F.max("score").alias("high")).alias("span")).scalar()
    low = span["low"]
    width = (span["high"] - low) / bins
    bin_ = F.coalesce(F.floor(F.try_divide(F.col("score") - low, width)), F.lit(0))
    counted = scores.groupBy("label", F.least(bin_, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("label"))
    return counted.select(
        "label",
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        "n",
        F.try_divide(F.col("n"), total * width).alias("density"),
    )


def top_rows(df: DataFrame, by: Sequence[str | Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*by).limit(n)
