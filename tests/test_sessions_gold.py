import hashlib
from datetime import date

from clickstrata.operators import gold
from clickstrata.operators.funnel import session_funnel_daily
from clickstrata.operators.quality import flag_distribution, quality_events, quality_sessions
from clickstrata.operators.reporting import FUNNEL_COUNT_SERIES, funnel_series
from clickstrata.operators.sessions import build_sessions

from feeds import events


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_session_over_midnight_and_month_end(spark):
    feed = events(
        spark,
        {"event_time": "2024-01-31 23:59:50 UTC"},
        {"event_time": "2024-02-01 00:00:10 UTC", "event_type": "purchase"},
    )
    row = build_sessions(feed).first()
    assert row["session_id"] == _digest("1::a")
    assert (row["session_duration_s"], row["session_date"], row["year"], row["month"]) == (
        20, date(2024, 1, 31), 2024, 1,
    )
    assert (row["num_events"], row["n_view"], row["n_cart"], row["n_purchase"]) == (2, 1, 0, 1)
    assert (row["has_view"], row["has_cart"], row["has_purchase"]) == (1, 0, 1)


def test_missing_sessions_share_one_bucket_per_user(spark, rows):
    feed = events(
        spark,
        {"user_session": None},
        {"user_session": None, "event_time": "2024-01-20 00:00:00 UTC"},
        {"user_session": "NULL"},
        {"user_session": None, "user_id": 2},
    )
    assert rows(build_sessions(feed), "session_id", "num_events") == sorted(
        [(_digest("1::NULL"), 3), (_digest("2::NULL"), 1)], key=str
    )


def test_daily_rates_without_views(spark):
    feed = events(
        spark,
        {"event_type": "cart"},
        {"event_type": "purchase", "price": None},
        {"event_type": "purchase", "price": 4.5, "user_id": 2},
    )
    product = gold.product_daily(feed).first()
    assert (product["view_to_cart_rate"], product["cart_to_purchase_rate"]) == (0.0, 2.0)
    assert (product["revenue"], product["unique_users"]) == (4.5, 2)
    assert all(r["purchase_rate"] == 0.0 for r in gold.user_daily(feed).collect())
    funnel = gold.funnel_daily(feed).first()
    assert (funnel["view_users"], funnel["cart_users"], funnel["purchase_users"]) == (0, 1, 2)


def test_gold_layers_agree(spark, rows):
    feed = events(
        spark,
        *[
            {"user_id": u, "product_id": p, "event_type": t, "event_time": f"2024-01-0{d} 10:00:00 UTC"}
            for u in (1, 2, 3)
            for p in (1, 2)
            for d in (1, 2)
            for t in ("view", "view", "cart", "purchase")[: u + p]
        ],
    )
    product, user, funnel = gold.product_daily(feed), gold.user_daily(feed), gold.funnel_daily(feed)
    for name in ("views", "carts", "purchases"):
        totals = {df.agg({name: "sum"}).first()[0] for df in (product, user, funnel)}
        assert len(totals) == 1
    assert rows(funnel) == rows(gold.funnel_from_user_daily(user))
    assert build_sessions(feed).agg({"num_events": "sum"}).first()[0] == feed.count()


def test_session_funnel_rates(spark):
    feed = events(
        spark,
        {"user_session": "a"},
        {"user_session": "b", "event_type": "cart"},
        {"user_session": "c", "event_type": "cart"},
        {"user_session": "c", "event_type": "purchase"},
        {"user_session": "d", "event_type": "purchase"},
    )
    sessions = build_sessions(feed)
    row = session_funnel_daily(sessions).first()
    assert row["sessions_total"] == 4
    # Totals over totals may pass 1; cart to purchase counts sessions with both.
    assert (row["view_to_cart_rate"], row["cart_to_purchase_rate"], row["view_to_purchase_rate"]) == (2.0, 0.5, 2.0)
    series = funnel_series(session_funnel_daily(sessions), FUNNEL_COUNT_SERIES)
    assert {r["series"]: r["value"] for r in series.collect()}["sessions_with_cart"] == 2.0
    flags = flag_distribution(sessions, n=2).collect()
    assert len(flags) == 2 and all(r["count"] == 1 for r in flags)


def test_quality_reports(spark):
    feed = events(
        spark, {}, {"user_id": 2}, {"user_id": 2, "event_type": "purchase"}, {"user_id": 3, "user_session": "b"}
    )
    report = quality_events(feed).first()
    assert (report["rows"], report["distinct_users"], report["distinct_products"]) == (4, 3, 1)
    assert [tuple(e) for e in report["event_type_distribution"]] == [("view", 3), ("purchase", 1)]
    sessions = quality_sessions(build_sessions(feed)).first()
    assert (sessions["sessions"], sessions["distinct_users"]) == (3, 3)
    assert [tuple(e) for e in sessions["funnel_flag_distribution"]] == [
        (True, False, False, 2), (True, False, True, 1),
    ]


def test_reports_list_all_values(spark):
    """Types and flags beyond the known ones are listed too, NULL among them."""
    feed = spark.createDataFrame([("view", 1, 1), ("view", 2, 1), ("refund", 2, 1), (None, 3, None)], "event_type string, user_id long, product_id long")
    report = quality_events(feed).first()
    assert (report["rows"], report["distinct_users"], report["distinct_products"]) == (4, 3, 1)
    assert [tuple(e) for e in report["event_type_distribution"]] == [("view", 2), ("refund", 1), (None, 1)]
    rows = [(1, 1, 0, 0), (2, 1, 0, 0), (3, 2, None, 1)]
    sessions = quality_sessions(spark.createDataFrame(rows, "user_id long, has_view int, has_cart int, has_purchase int")).first()
    assert [tuple(e) for e in sessions["funnel_flag_distribution"]] == [(True, False, False, 2), (False, None, True, 1)]


def test_reports_of_empty_tables(spark):
    feed = events(spark, {}).limit(0)
    assert quality_events(feed).first()["event_type_distribution"] == []
    assert quality_sessions(build_sessions(feed)).first()["funnel_flag_distribution"] == []
