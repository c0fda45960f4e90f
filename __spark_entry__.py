"""Registered queries over the supplied tables, and the SQL that checks them.

Every query starts from the whole ``events`` table of the folder it is given,
mapped to the raw feed's columns, and runs the layers it needs.
"""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Callable
from datetime import date
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clickstrata import functions as fn  # noqa: E402
from clickstrata import schema  # noqa: E402
from clickstrata.operators import (  # noqa: E402
    bitmaps,
    boosting,
    bronze,
    cohorts,
    curves,
    experiment,
    features,
    funnel,
    gold,
    model_tables,
    models,
    quality,
    ranking,
    reporting,
    reweighted,
    sampling,
    sessions,
    silver,
)
from clickstrata.plans import lakehouse, modelling  # noqa: E402
from clickstrata.session import apply_settings  # noqa: E402
from clickstrata.sources import (  # noqa: E402
    build_mart,
    export_parquet,
    read_layer,
    read_nested,
    read_raw_csv,
    read_table,
    register_views,
    scratch_path,
    stage,
    write_layer,
    write_report,
)
from clickstrata.sources import scratch  # noqa: E402
from clickstrata.sources.files import layer_path  # noqa: E402
from clickstrata.sources.sample_feed import raw_events, synthetic_scores  # noqa: E402

import expected_models  # noqa: E402
from expected_sql import EXPECTED  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
DECIMALS = 6

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _prepare(spark: SparkSession) -> None:
    """Settings, and a folder of this machine for intermediate tables where a local session names none."""
    apply_settings(spark)
    if not scratch.configured(spark) and spark.sparkContext.master.startswith("local["):
        scratch.use_folder(spark, _own_folder(spark.sparkContext.applicationId))


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-")


def query(build: Query) -> Query:
    """Registers ``build`` under its name, in the form in which results are compared with SQL."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return _comparable(build(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def _comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded, times as plain UTC clock times whatever zone the reader is in."""
    changed = {}
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("double", "float"):
            changed[field.name] = F.round(F.col(field.name).cast("double"), DECIMALS)
        elif kind == "timestamp":
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


# ---- layers ---------------------------------------------------------------


def _raw(spark, sf_dir):
    return raw_events(spark, sf_dir)


def _bronze(spark, sf_dir):
    return bronze.ingest_events(_raw(spark, sf_dir))


def _events(spark, sf_dir):
    return silver.clean_events(_bronze(spark, sf_dir))


def _sessions(spark, sf_dir):
    return sessions.build_sessions(_events(spark, sf_dir))


def _stored_events(spark, sf_dir):
    """The layer as the jobs store it, for queries that read it more than once."""
    return stage(_events(spark, sf_dir), "fact_events")


def _stored_sessions(spark, sf_dir):
    return stage(_sessions(spark, sf_dir), "fact_sessions")


def _labelled(spark, sf_dir):
    return _stored_sessions(spark, sf_dir).withColumn("label", F.col("has_purchase"))


def _features(spark, sf_dir):
    events = _stored_events(spark, sf_dir)
    return features.session_features(sessions.build_sessions(events), events)


def _retention(spark, sf_dir):
    return cohorts.cohort_retention(_events(spark, sf_dir))


def _readout(spark, sf_dir):
    return experiment.experiment_readout(_events(spark, sf_dir))


def _scores(spark, sf_dir):
    return synthetic_scores(_sessions(spark, sf_dir))


def _ranked(spark, sf_dir):
    return ranking.rank_scores(_scores(spark, sf_dir))


def _steps(spark, sf_dir):
    return curves.score_steps(_scores(spark, sf_dir))


# ---- sources and sinks ----------------------------------------------------


@query
def scan_raw_csv(spark, sf_dir):
    path = scratch_path(spark, "raw_csv")
    _raw(spark, sf_dir).write.option("header", True).csv(path)
    return read_raw_csv(spark, path)


@query
def scan_parquet(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


@query
def views_count(spark, sf_dir):
    root = scratch_path(spark, "lake")
    events = _stored_events(spark, sf_dir)
    layers = {
        "fact_events": events,
        "fact_sessions": sessions.build_sessions(events),
        "product_daily": gold.product_daily(events),
        "user_daily": gold.user_daily(events),
        "funnel_daily": gold.funnel_daily(events),
    }
    for name, df in layers.items():
        write_layer(df, layer_path(root, name))
    views = register_views(spark, root)
    return quality.warehouse_counts({name: spark.table(name) for name in sorted(views)})


@query
def views_nested_drift(spark, sf_dir):
    """Older days without brands in one layout of folders, newer ones in another, read as one view."""
    root, events = scratch_path(spark, "nested"), _stored_events(spark, sf_dir)
    old = F.col("event_date") < "2024-01-15"
    events.where(old).drop("brand", "category_code").write.parquet(f"{root}/2024/01/early")
    events.where(~old).withColumn("part", F.dayofmonth("event_date") % 2).write.partitionBy("part").parquet(f"{root}/late")
    read_nested(spark, root).createOrReplaceTempView("all_events")
    return spark.sql("SELECT event_ts, event_type, user_id, product_id, brand, category_code, price FROM all_events")


@query
def sink_partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "fact_events")
    write_layer(_events(spark, sf_dir), path, rebalance=True)
    return spark.read.parquet(path).select(*schema.FACT_EVENT_COLUMNS)


@query
def sink_dynamic_overwrite(spark, sf_dir):
    """A rerun from the 16th on, with other revenue, must leave the earlier days as they were."""
    path = scratch_path(spark, "user_daily")
    days = stage(gold.user_daily(_events(spark, sf_dir)), "user_daily")
    write_layer(days, path, ["event_date"], rebalance=True)
    rerun = days.where(F.col("event_date") >= "2024-01-16").withColumn("revenue", F.col("revenue") + 1)
    write_layer(rerun, path, ["event_date"], rebalance=True)
    return spark.read.parquet(path).select(days.columns)


# The feed's days four days apart, so that it spans four months and sessions cross their ends; and a later delivery
# of February and March in which some events are gone, some have moved and some cost more.
STRETCHED = "date_format(try_to_timestamp(replace(event_time, ' UTC'), 'yyyy-MM-dd HH:mm:ss') + make_dt_interval(3 * cast(substr(event_time, 9, 2) AS int)), 'yyyy-MM-dd HH:mm:ss') || ' UTC'"
REVISED = "CASE WHEN product_id % 7 <> 3 OR event_type NOT IN ('view', 'VIEW') THEN user_session ELSE 'moved' END"


def _stretched(spark, sf_dir, revised):
    stretched = F.when(F.col("event_time") != "not-a-time", F.expr(STRETCHED)).otherwise(F.col("event_time"))
    feed = _raw(spark, sf_dir).withColumn("event_time", stretched)
    if not revised:
        return feed
    changed = feed.where("event_time LIKE '2024-02-%' AND NOT (user_id <=> 3) AND NOT product_id % 11 <=> 4")
    changed = changed.withColumns({"user_session": F.expr(REVISED), "price": F.col("price") + 5})
    return changed.unionByName(feed.where("event_time LIKE '2024-03-%' AND event_type = 'remove_from_cart'"))


@cache
def _renewed_lake(application, spark, sf_dir):
    """All layers of the stretched feed, then a bounded run over the revised February and a March without known events."""
    root = scratch_path(spark, "lake")
    lakehouse.run_lakehouse(spark, _stretched(spark, sf_dir, False), root)
    lakehouse.run_lakehouse(spark, _stretched(spark, sf_dir, True), root, date(2024, 2, 1), date(2024, 3, 31))
    return root


def _renewed(spark, sf_dir, name):
    return read_layer(spark, _renewed_lake(spark.sparkContext.applicationId, spark, sf_dir), name)


@query
def rerun_months_sessions(spark, sf_dir):
    return _renewed(spark, sf_dir, "fact_sessions").select(*schema.FACT_SESSION_COLUMNS)


@query
def rerun_months_user_daily(spark, sf_dir):
    return _renewed(spark, sf_dir, "user_daily")


@query
def rerun_months_funnel_daily(spark, sf_dir):
    return _renewed(spark, sf_dir, "funnel_daily")


@query
def sink_zstd_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "retention")
    export_parquet(_retention(spark, sf_dir), path)
    return spark.read.parquet(path)


@query
def sink_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(quality.quality_events(_stored_events(spark, sf_dir)), path)
    report = spark.read.json(path)
    entry_json = F.transform("event_type_distribution", lambda e: F.struct(e["event_type"], e["count"]))
    return report.select(
        "rows", "distinct_users", "distinct_products", F.to_json(entry_json).alias("event_type_distribution")
    )


@query
def mart_rows(spark, sf_dir):
    """The three marts stored and queried through their views."""
    events = _stored_events(spark, sf_dir)
    marts = {
        "mart_cohort_weekly_retention": cohorts.cohort_retention(events),
        "mart_experiment_readout": experiment.experiment_readout(events),
        "mart_session_funnel_daily": funnel.session_funnel_daily(sessions.build_sessions(events)),
    }
    for name, df in marts.items():
        build_mart(spark, name, df, scratch_path(spark, name))
    return quality.warehouse_counts({name: spark.table(name) for name in marts})


@query
def warehouse_counts(spark, sf_dir):
    events = _stored_events(spark, sf_dir)
    return quality.warehouse_counts({"fact_events": events, "fact_sessions": sessions.build_sessions(events)})


# ---- bronze and silver ----------------------------------------------------


@query
def parse_event_time(spark, sf_dir):
    return bronze.parse_times(_raw(spark, sf_dir)).select("event_time", "event_ts")


@query
def derive_calendar(spark, sf_dir):
    dated = bronze.add_calendar(bronze.parse_times(_raw(spark, sf_dir)), "event_ts", "event_date")
    return dated.select("event_ts", "event_date", "year", "month")


@query
def bronze_ingest(spark, sf_dir):
    return _bronze(spark, sf_dir)


@query
def canonical_event_type(spark, sf_dir):
    typed = _bronze(spark, sf_dir).withColumnRenamed("event_type", "raw_type")
    mapped = typed.select("raw_type", F.col("raw_type").alias("event_type"))
    return silver.with_canonical_types(mapped).groupBy("raw_type", "event_type").agg(F.count("*").alias("n"))


@query
def required_fields(spark, sf_dir):
    return silver.require_fields(silver.with_canonical_types(_bronze(spark, sf_dir)))


@query
def dedup_events(spark, sf_dir):
    return silver.dedup_events(silver.require_fields(silver.with_canonical_types(_bronze(spark, sf_dir))))


@query
def clean_events(spark, sf_dir):
    return _events(spark, sf_dir)


@query
def purchase_revenue_by_type(spark, sf_dir):
    return (
        silver.with_canonical_types(_bronze(spark, sf_dir))
        .groupBy("event_type")
        .agg(F.sum(fn.purchase_revenue()).alias("revenue"), F.count("*").alias("n"))
    )


@query
def session_key(spark, sf_dir):
    return _events(spark, sf_dir).select("user_id", "user_session", fn.session_key().alias("session_id")).distinct()


@query
def build_sessions(spark, sf_dir):
    return _sessions(spark, sf_dir)


# ---- gold and marts -------------------------------------------------------


@query
def product_daily(spark, sf_dir):
    return gold.product_daily(_events(spark, sf_dir))


@query
def user_daily(spark, sf_dir):
    return gold.user_daily(_events(spark, sf_dir))


@query
def funnel_daily(spark, sf_dir):
    return gold.funnel_daily(_events(spark, sf_dir))


@query
def funnel_from_user_daily(spark, sf_dir):
    return gold.funnel_from_user_daily(gold.user_daily(_events(spark, sf_dir)))


def _stored_bitmaps(spark, sf_dir):
    """The stretched feed's days, so that there are several months."""
    events = silver.clean_events(bronze.ingest_events(_stretched(spark, sf_dir, False)))
    return stage(bitmaps.day_bitmaps(events), "bitmaps")


@query
def funnel_monthly_users(spark, sf_dir):
    return bitmaps.funnel_periods(_stored_bitmaps(spark, sf_dir), "month")


@query
def funnel_weekly_users(spark, sf_dir):
    return bitmaps.funnel_periods(_stored_bitmaps(spark, sf_dir), "week")


@query
def distinct_users_by_type(spark, sf_dir):
    return bitmaps.distinct_users(_stored_bitmaps(spark, sf_dir), "event_type")


@query
def session_funnel_daily(spark, sf_dir):
    return funnel.session_funnel_daily(_sessions(spark, sf_dir))


@query
def user_first_week(spark, sf_dir):
    return cohorts.user_first_week(_events(spark, sf_dir))


@query
def user_weekly_activity(spark, sf_dir):
    return cohorts.user_weekly_activity(_events(spark, sf_dir))


@query
def cohort_activity_join(spark, sf_dir):
    events = _stored_events(spark, sf_dir)
    return cohorts.cohort_activity(cohorts.user_first_week(events), cohorts.user_weekly_activity(events))


@query
def cohort_retention(spark, sf_dir):
    return _retention(spark, sf_dir)


@query
def retention_from_state(spark, sf_dir):
    """The users' weeks carried over three deliveries of ten days each, merged one after the other."""
    events, state = _stored_events(spark, sf_dir), None
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "9999-12-31")):
        new = cohorts.week_state(events.where(F.col("event_date").between(first, last)))
        state = stage(new if state is None else cohorts.merge_week_states(state, new), "week_state")
    return cohorts.retention_from_state(state)


@query
def top_cohort_rows(spark, sf_dir):
    return reporting.top_rows(_retention(spark, sf_dir), ["cohort_week", "week_index"], 10)


@query
def weeks_between(spark, sf_dir):
    return cohorts.weeks_between(_retention(spark, sf_dir), 1, 3)


# ---- experiment -----------------------------------------------------------


@query
def user_purchases(spark, sf_dir):
    return experiment.user_purchases(_events(spark, sf_dir))


@query
def assign_variants(spark, sf_dir):
    return experiment.assign_variants(_events(spark, sf_dir))


@query
def experiment_arms(spark, sf_dir):
    """Assignment over all users of the feed, also those whose events do not survive cleaning."""
    assigned = experiment.assign_variants(_raw(spark, sf_dir).where("user_id is not null"))
    return experiment.experiment_arms(assigned, experiment.user_purchases(_events(spark, sf_dir)))


@query
def experiment_readout(spark, sf_dir):
    return _readout(spark, sf_dir)


@query
def experiment_readout_assigned(spark, sf_dir):
    """The readout with an assignment table given from outside."""
    assigned = experiment.assign_variants(_raw(spark, sf_dir).where("user_id is not null"))
    return experiment.experiment_readout(_events(spark, sf_dir), assigned)


@query
def experiment_readout_enhanced(spark, sf_dir):
    return experiment.experiment_readout_enhanced(_events(spark, sf_dir))


@query
def experiment_summary(spark, sf_dir):
    return experiment.experiment_summary(_readout(spark, sf_dir))


# ---- quality --------------------------------------------------------------


@query
def event_type_distribution(spark, sf_dir):
    return quality.value_distribution(_events(spark, sf_dir), "event_type")


@query
def funnel_flag_distribution(spark, sf_dir):
    return quality.flag_distribution(_sessions(spark, sf_dir))


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_bronze(spark, sf_dir), schema.EVENT_IDENTITY)


@query
def null_rates(spark, sf_dir):
    return quality.null_rates(_bronze(spark, sf_dir))


@query
def profile_events(spark, sf_dir):
    report = quality.profile(_bronze(spark, sf_dir), schema.EVENT_IDENTITY)
    rates = [F.col(f"null_rate.{name}").alias(f"null_rate_{name}") for name in schema.BRONZE_COLUMNS]
    return report.select("rows", "cols", "dup_keys", *rates)


@query
def quality_bronze(spark, sf_dir):
    return quality.quality_bronze(_bronze(spark, sf_dir))


@query
def quality_events(spark, sf_dir):
    report = quality.quality_events(_stored_events(spark, sf_dir))
    return report.withColumn("event_type_distribution", F.to_json("event_type_distribution"))


@query
def quality_sessions(spark, sf_dir):
    report = quality.quality_sessions(_stored_sessions(spark, sf_dir))
    return report.withColumn("funnel_flag_distribution", F.to_json("funnel_flag_distribution"))


# ---- features and splits --------------------------------------------------


@query
def session_event_features(spark, sf_dir):
    return features.session_event_features(_events(spark, sf_dir))


@query
def prior_user_history(spark, sf_dir):
    return features.prior_user_history(_sessions(spark, sf_dir))


@query
def session_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def dataset_profile(spark, sf_dir):
    return features.dataset_profile(_features(spark, sf_dir))


@query
def time_split_dates(spark, sf_dir):
    return features.time_split(_sessions(spark, sf_dir))


@query
def split_rows(spark, sf_dir):
    return features.assign_split(_stored_sessions(spark, sf_dir)).select("session_id", "session_date", "split")


@query
def split_counts(spark, sf_dir):
    return features.split_counts(features.assign_split(_labelled(spark, sf_dir)))


@query
def cap_sample(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select("session_id", "session_date", "label")
    return sampling.cap_sample(rows, "session_id", max_rows=100)


# ---- evaluation of scores -------------------------------------------------


@query
def score_ranks(spark, sf_dir):
    return _ranked(spark, sf_dir).select("session_id", "score", "label", "rank")


@query
def ranking_metrics(spark, sf_dir):
    return ranking.ranking_metrics(_ranked(spark, sf_dir))


@query
def lift_curve(spark, sf_dir):
    return ranking.lift_curve(_ranked(spark, sf_dir))


@query
def threshold_metrics(spark, sf_dir):
    return ranking.threshold_metrics(_scores(spark, sf_dir))


@query
def calibration_curve(spark, sf_dir):
    return ranking.calibration_curve(_ranked(spark, sf_dir))


@query
def roc_auc(spark, sf_dir):
    return curves.roc_auc(_steps(spark, sf_dir))


@query
def roc_curve(spark, sf_dir):
    return curves.roc_curve(_steps(spark, sf_dir))


@query
def roc_curve_full(spark, sf_dir):
    return curves.roc_curve(_steps(spark, sf_dir), drop_collinear=False)


@query
def average_precision(spark, sf_dir):
    return curves.average_precision(_steps(spark, sf_dir))


@query
def pr_curve(spark, sf_dir):
    return curves.pr_curve(_steps(spark, sf_dir))


@query
def thin_curve(spark, sf_dir):
    return curves.thin_curve(curves.pr_curve(_steps(spark, sf_dir)))


# ---- reports --------------------------------------------------------------


@query
def overview_kpis(spark, sf_dir):
    events = _stored_events(spark, sf_dir)
    return reporting.overview_kpis(
        sessions.build_sessions(events), cohorts.cohort_retention(events), experiment.experiment_readout(events)
    )


HEATMAP_WEEKS = range(9)  # those of the figure; the expected SQL needs named columns


@query
def cohort_heatmap(spark, sf_dir):
    return reporting.cohort_heatmap(_retention(spark, sf_dir), HEATMAP_WEEKS)


@query
def cohort_heatmap_gaps(spark, sf_dir):
    """All weeks of the data, and those that the expected SQL names also where the data has none."""
    return reporting.cohort_heatmap(_retention(spark, sf_dir), fill=None, at_least=len(HEATMAP_WEEKS))


@query
def funnel_series(spark, sf_dir):
    return reporting.funnel_series(funnel.session_funnel_daily(_sessions(spark, sf_dir)))


@query
def funnel_count_series(spark, sf_dir):
    daily = funnel.session_funnel_daily(_sessions(spark, sf_dir))
    return reporting.funnel_series(daily, reporting.FUNNEL_COUNT_SERIES)


@query
def sample_scores(spark, sf_dir):
    return sampling.sample_rows(synthetic_scores(_stored_sessions(spark, sf_dir)), "session_id", n=100)


@query
def score_histogram(spark, sf_dir):
    return reporting.score_histogram(synthetic_scores(_stored_sessions(spark, sf_dir)))


# ---- models ---------------------------------------------------------------


def _model_table(spark, sf_dir):
    return features.assign_split(stage(_features(spark, sf_dir), "features"))


def _part(table, split):
    return table.where(F.col("split") == split)


def _logistic(table):
    train = sampling.cap_sample(_part(table, features.SPLITS[0]), "session_id")
    return reweighted.train_reweighted(stage(train, "sample"))


@query
def logistic_scores(spark, sf_dir):
    table = _model_table(spark, sf_dir)
    return _logistic(table).scores(table)


@query
def logistic_coefficients(spark, sf_dir):
    return _logistic(_model_table(spark, sf_dir)).table()


@query
def gbt_bin_edges(spark, sf_dir):
    return boosting.bin_edges(_part(_model_table(spark, sf_dir), features.SPLITS[0]))


@cache
def _fitted(train_boosted, application, spark, sf_dir):
    """The model table and an ensemble with the library's settings, which stop on the validation part; stored, once a session."""
    table = _model_table(spark, sf_dir)
    model = train_boosted(*(_part(table, name) for name in features.SPLITS[:2]))
    path = scratch_path(spark, "model")
    model.save(path)
    return table, path


def _boosted(spark, sf_dir):
    """The model table, and the ensemble as it is stored."""
    table, path = _fitted(boosting.train_boosted, spark.sparkContext.applicationId, spark, sf_dir)
    return table, model_tables.TreeModel.load(spark, path, schema.FEATURES)


@query
def gbt_nodes(spark, sf_dir):
    return _boosted(spark, sf_dir)[1].table()


@query
def gbt_scores(spark, sf_dir):
    table, model = _boosted(spark, sf_dir)
    return model.scores(table)


@query
def feature_importance(spark, sf_dir):
    return models.top_importance(_boosted(spark, sf_dir)[1].importance(), 12)


@query
def score_summary(spark, sf_dir):
    table, model = _boosted(spark, sf_dir)
    return models.score_summary(model.scores(table))


# The same with a few rounds of small trees, which SQL can write out: fitted and scored on the whole tables.


def _few_rounds(spark, sf_dir):
    table = _model_table(spark, sf_dir)
    train = _part(table, features.SPLITS[0])
    few = dict(rounds=expected_models.ROUNDS, leaves=expected_models.LEAVES, least_rows=expected_models.LEAST_ROWS)
    return table, boosting.train_boosted(train, **few)


@query
def gbt_rounds_nodes(spark, sf_dir):
    return _few_rounds(spark, sf_dir)[1].table()


@query
def gbt_rounds_scores(spark, sf_dir):
    table, model = _few_rounds(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.save(path)
    return model_tables.TreeModel.load(spark, path, schema.FEATURES).scores(table)


@query
def gbt_rounds_summary(spark, sf_dir):
    table, model = _few_rounds(spark, sf_dir)
    return models.score_summary(model.walked_scores(table))


@query
def gbt_rounds_importance(spark, sf_dir):
    return models.top_importance(_few_rounds(spark, sf_dir)[1].importance(), 12)


@query
def model_report(spark, sf_dir):
    events = _stored_events(spark, sf_dir)
    table = stage(features.session_features(sessions.build_sessions(events), events), "features")
    report = modelling.fit_and_report(table, events).report
    return report.select(*[F.to_json(c).alias(c) if c != "best_iteration" else c for c in report.columns])


# ---- contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Daily session funnel, from the feed through cleaning and sessions."""
    return queries()["session_funnel_daily"](spark, SMOKE_DIR)


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and of the pipeline, where they can be imported."""
    try:
        from clickstrata.llm.queries import ORACLES, QUERIES
    except ImportError:
        return {}, {}
    found, sql = dict(QUERIES), dict(ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        pass
    else:
        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: _prepared(build) for name, build in found.items()}, sql


def _prepared(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return build(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return _QUERIES | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in EXPECTED.items() if name in _QUERIES} | _text_queries()[1]
