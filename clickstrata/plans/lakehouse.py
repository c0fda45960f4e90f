"""Batch jobs from the raw feed to the marts.

Each job reads the layer before it, writes its own, and reports from what it
wrote, so that no lineage runs twice. Bronze replaces the months that the feed
holds; the later layers are rebuilt as a whole, so nothing stale stays in them.

With ``since`` and ``until`` a job renews the months from one day's to the other's only:
events, products, users and funnel of these months, and the sessions that have or had
events in them, wherever those began. What a month no longer has is deleted. The
result is that of a whole rebuild, if nothing else has changed.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.operators.bronze import ingest_events
from clickstrata.operators.cohorts import cohort_retention
from clickstrata.operators.experiment import experiment_readout
from clickstrata.operators.funnel import session_funnel_daily
from clickstrata.operators.gold import funnel_from_user_daily, product_daily, user_daily
from clickstrata.operators.quality import quality_bronze, quality_events, quality_sessions
from clickstrata.operators.sessions import (
    build_sessions,
    reaching_sessions,
    rebuild_sessions,
    session_ids,
    session_months,
)
from clickstrata.operators.silver import clean_events
from clickstrata.sources import (
    build_mart,
    in_months,
    layer_exists,
    layer_manifest,
    layer_path,
    month_number,
    read_layer,
    read_raw_csv,
    register_views,
    replace_months,
    stage,
    write_layer,
    write_report,
)


def _report(df: DataFrame, root: str, name: str, **paths: str) -> DataFrame:
    stamped = df.withColumns({"generated_at": F.current_timestamp(), **{k: F.lit(v) for k, v in paths.items()}})
    path = f"{root.rstrip('/')}/reports/{name}"
    write_report(stamped, path)
    return df.sparkSession.read.json(path)


def _span(since: date | None, until: date | None) -> range | None:
    """The numbered months from one day's to the other's; None for a whole rebuild."""
    if since is None and until is None:
        return None
    if since is None or until is None or since > until:
        raise ValueError("a bounded run needs since and until, in this order")
    return range(month_number(since), month_number(until) + 1)


def run_bronze(
    spark: SparkSession,
    source: str | DataFrame,
    root: str,
    rebalance: bool | int = True,
    coalesce: int | None = None,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Raw CSV (or a raw DataFrame) to bronze; reports the layer's rows. Without ``rebalance`` there is no shuffle, but up to a file per input split and month.

    Months that the feed does not hold stay. With ``since`` and ``until`` the feed is all there is of these
    months, and its rows outside of them are left out.
    """
    raw = read_raw_csv(spark, source) if isinstance(source, str) else source
    path, events, months = layer_path(root, "bronze_events"), ingest_events(raw), _span(since, until)
    if months is None:
        write_layer(events, path, rebalance=rebalance, coalesce=coalesce)
    else:
        replace_months(events.where(in_months(months)), root, "bronze_events", months, rebalance)
    # Counting a stored layer takes the Parquet footers only.
    return _report(quality_bronze(read_layer(spark, root, "bronze_events")), root, "quality_bronze", out_bronze=path)


def run_silver(
    spark: SparkSession, root: str, rebalance: bool | int = True, since: date | None = None, until: date | None = None
) -> DataFrame:
    """Bronze to ``fact_events`` with its quality report. Copies of an event share its time, so a month's events come from that month."""
    path, bronze = layer_path(root, "fact_events"), read_layer(spark, root, "bronze_events")
    months = _span(since, until)
    if months is None:
        write_layer(clean_events(bronze), path, dynamic=False, rebalance=rebalance)
    else:
        replace_months(clean_events(bronze.where(in_months(months))), root, "fact_events", months, rebalance)
    events = read_layer(spark, root, "fact_events")
    return _report(quality_events(events), root, "quality_silver_events", out_silver=path)


def run_sessions(
    spark: SparkSession, root: str, rebalance: bool | int = True, since: date | None = None, until: date | None = None
) -> DataFrame:
    """``fact_events`` to ``fact_sessions`` with its quality report.

    A bounded run reads the events of the months that the sessions with events there reach: the months
    themselves and their neighbours, unless labels come back after months or users have events without
    one far apart, which form one session each. Only those users' events are grouped anew.
    """
    path, events = layer_path(root, "fact_sessions"), read_layer(spark, root, "fact_events")
    months = _span(since, until)
    if months is None or not layer_exists(spark, root, "fact_sessions"):
        write_layer(build_sessions(events), path, dynamic=False, rebalance=rebalance)
    else:
        _renew_sessions(spark, root, events, months, rebalance)
    sessions = read_layer(spark, root, "fact_sessions")
    return _report(quality_sessions(sessions), root, "quality_silver_sessions", out_sessions=path)


def _renew_sessions(spark: SparkSession, root: str, events: DataFrame, months: range, rebalance: bool | int) -> None:
    """Rebuilds the sessions that have or had events in the months, and moves them to the months in which they begin now.

    Their ids are looked for in all months of the layer, of which that reads ids, users and times.
    """
    stored = read_layer(spark, root, "fact_sessions")
    # Each is used more than once, and the layer they read is about to change.
    ids = stage(session_ids(events.where(in_months(months))), "ids")
    known = stage(reaching_sessions(stored, months[0], months[-1], ids), "known")
    changed = stage(known.select("user_id", "session_id").unionByName(ids).distinct(), "changed")
    reached = {*months, *session_months(known)}
    anew = stage(rebuild_sessions(events.where(in_months(reached)), changed), "anew")
    starts = known.select("year", "month").unionByName(anew.select("year", "month")).distinct().collect()
    touched = {r["year"] * 12 + r["month"] for r in starts}
    kept = stored.where(in_months(touched)).join(changed.select("session_id"), "session_id", "left_anti")
    if touched:
        replace_months(kept.select(anew.columns).unionByName(anew), root, "fact_sessions", touched, rebalance)


def run_gold(
    spark: SparkSession, root: str, rebalance: bool | int = True, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The three daily aggregates; the funnel comes from the stored user days."""
    events, months = read_layer(spark, root, "fact_events"), _span(since, until)

    def write(df: DataFrame, name: str) -> None:
        if months is None:
            write_layer(df, layer_path(root, name), dynamic=False, rebalance=rebalance)
        else:
            replace_months(df, root, name, months, rebalance)

    def picked(df: DataFrame) -> DataFrame:
        return df if months is None else df.where(in_months(months))

    write(product_daily(picked(events)), "product_daily")
    write(user_daily(picked(events)), "user_daily")
    write(funnel_from_user_daily(picked(read_layer(spark, root, "user_daily"))), "funnel_daily")
    manifest = layer_manifest(spark, root).agg(
        F.map_from_entries(F.collect_list(F.struct("table_name", "path"))).alias("tables")
    )
    return _report(manifest, root, "quality_gold_features", out_gold=f"{root.rstrip('/')}/gold")


def run_marts(spark: SparkSession, root: str, assignments: DataFrame | None = None) -> dict[str, DataFrame]:
    """Views over the layers, and the three marts stored, exported and registered as views."""
    tables = register_views(spark, root)
    marts = {
        "mart_cohort_weekly_retention": cohort_retention(tables["fact_events"]),
        "mart_experiment_readout": experiment_readout(tables["fact_events"], assignments),
        "mart_session_funnel_daily": session_funnel_daily(tables["fact_sessions"]),
    }
    return {name: build_mart(spark, name, mart, layer_path(root, name)) for name, mart in marts.items()}


def run_lakehouse(
    spark: SparkSession, source: str | DataFrame, root: str, since: date | None = None, until: date | None = None
) -> dict[str, DataFrame]:
    """All jobs in order; returns the marts. With ``since`` and ``until`` the feed renews the months between them."""
    run_bronze(spark, source, root, since=since, until=until)
    for job in (run_silver, run_sessions, run_gold):
        job(spark, root, since=since, until=until)
    return run_marts(spark, root)
