"""A third of all rows on one key: results stay whole and right."""

import pytest
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.operators import cohorts, experiment, features, gold, silver
from clickstrata.operators.sessions import build_sessions

N = 30_000


def _events(spark, hot):
    """``N`` distinct events, of which the ones with ``hot`` set get its columns."""
    i = F.col("id")
    columns = {
        "event_ts": F.timestamp_seconds(F.lit(1704067200) + i * 60),
        "event_type": F.element_at(F.array(*[F.lit(k) for k in schema.EVENT_TYPES]), (i % 3 + 1).cast("int")),
        "user_id": i % 997,
        "user_session": F.concat(F.lit("s"), (i % 5).cast("string")),
        "product_id": i % 89,
        "category_id": i % 7,
        "category_code": F.concat(F.lit("c"), (i % 6).cast("string")),
        "brand": F.lit("b"),
        "price": (i % 50).cast("double"),
    }
    for name, value in hot.items():
        columns[name] = F.when(i % 3 == 0, value).otherwise(columns[name])
    df = spark.range(0, N, 1, 6).select(*[c.alias(n) for n, c in columns.items()])
    return df.withColumns(
        {"event_date": F.to_date("event_ts"), "year": F.year("event_ts"), "month": F.month("event_ts")}
    ).select(*schema.FACT_EVENT_COLUMNS)


def test_copies_of_one_event(spark):
    same = {
        "event_ts": F.timestamp_seconds(F.lit(1)),
        "event_type": F.lit("view"),
        "user_id": F.lit(7),
        "product_id": F.lit(3),
        "user_session": F.lit(None),
    }
    clean = silver.dedup_events(_events(spark, same))
    assert clean.count() == N - N // 3 + 1
    assert clean.where("event_ts = timestamp_seconds(1)").first()["price"] == 0.0


@pytest.fixture(scope="module")
def hot_session(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "events")
    _events(spark, {"user_id": F.lit(1_000_000), "user_session": F.lit("hot")}).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_session(hot_session):
    sessions = build_sessions(hot_session)
    assert sessions.agg(F.sum("num_events"), F.max("num_events")).first() == (N, N // 3)
    table = features.session_features(sessions, hot_session)
    row = table.orderBy(F.desc("num_events")).first()
    expected = hot_session.where("user_id = 1000000").agg(
        F.count_distinct(F.expr("CASE WHEN event_type = 'view' THEN product_id END")),
        F.count_distinct("category_code"),
    ).first()
    assert (row["distinct_products_viewed"], row["distinct_categories"]) == tuple(expected)
    assert table.count() == sessions.count()


def test_hot_user_in_aggregates(hot_session):
    for daily in (gold.user_daily(hot_session), gold.product_daily(hot_session), gold.funnel_daily(hot_session)):
        assert daily.agg(F.sum(F.col("views") + F.col("carts") + F.col("purchases"))).first()[0] == N
    start = cohorts.cohort_retention(hot_session).where("week_index = 0")
    assert start.agg(F.sum("active_users")).first()[0] == hot_session.select("user_id").distinct().count()
    arms = experiment.experiment_readout(hot_session).first()
    assert arms["control_n"] + arms["treatment_n"] == hot_session.select("user_id").distinct().count()


def test_hot_user_day(spark, hot_session):
    """Many sessions of one user on one day share the history of the days before."""
    sessions = build_sessions(hot_session).drop("session_date")
    crowded = sessions.select("*", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("copy")).withColumns(
        {
            "session_id": F.sha2(F.concat("session_id", "copy"), 256),
            "user_id": F.when(F.col("copy") > 3, 5).otherwise(F.col("user_id")),
            "session_date": F.when(F.col("copy") > 3, F.lit("2024-03-01")).otherwise(F.lit("2024-02-01")).cast("date"),
        }
    )
    history = features.prior_user_history(crowded).where("user_id = 5").orderBy("session_date").collect()
    early = crowded.where("user_id = 5 AND session_date = '2024-02-01'").count()
    assert [r["prior_sessions"] for r in history] == [0.0, float(early)]
