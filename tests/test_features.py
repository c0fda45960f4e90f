from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException

from clickstrata import schema
from clickstrata.operators import features
from clickstrata.operators.sessions import build_sessions

from feeds import events


def _features(feed):
    return features.session_features(build_sessions(feed), feed)


def test_event_features(spark):
    feed = events(
        spark,
        {"product_id": 1, "price": 2.0, "category_code": "x", "category_id": 7},
        {"product_id": 1, "price": 4.0, "category_id": 7},
        {"product_id": 2, "price": None},
        {"product_id": 3, "price": 100.0, "event_type": "cart", "category_code": "x"},
    )
    row = _features(feed).first()
    assert (row["distinct_products_viewed"], row["distinct_categories"]) == (2.0, 2.0)
    assert (row["avg_view_price"], row["max_view_price"]) == (3.0, 4.0)


def test_calendar_features(spark):
    # 2024-01-07 is a Sunday, which counts as day 0.
    row = _features(events(spark, {"event_time": "2024-01-07 13:05:00 UTC"})).first()
    assert (row["hour"], row["day_of_week"], row["day_of_month"]) == (13.0, 0.0, 7.0)


def test_session_without_views(spark):
    row = _features(events(spark, {"event_type": "cart"})).first()
    assert [row[n] for n in ("distinct_products_viewed", "avg_view_price", "max_view_price")] == [0.0, 0.0, 0.0]


def test_history_sees_earlier_days_only(spark):
    def visit(day, session, kind="view", user=1):
        return {"event_time": f"2024-01-{day:02d} 10:00:00 UTC", "user_session": session, "event_type": kind,
                "user_id": user}

    feed = events(
        spark,
        visit(1, "a", "purchase"),
        visit(1, "b"),
        visit(3, "c"),
        visit(3, "d", "purchase"),
        visit(9, "e"),
        visit(2, "f", user=2),
    )
    table = {
        (r["user_id"], r["session_date"].day, r["label"]): (
            r["prior_sessions"], r["prior_purchases"], r["prior_conversion_rate"])
        for r in _features(feed).collect()
    }
    assert table == {
        (1, 1, 1): (0.0, 0.0, 0.0),
        (1, 1, 0): (0.0, 0.0, 0.0),
        (1, 3, 0): (2.0, 1.0, 0.5),
        (1, 3, 1): (2.0, 1.0, 0.5),
        (1, 9, 0): (4.0, 2.0, 0.5),
        (2, 2, 0): (0.0, 0.0, 0.0),
    }


def test_label_is_not_a_feature():
    assert not {"n_purchase", "has_purchase", "label"} & set(schema.FEATURES)


def _days(spark, n):
    first = date(2024, 1, 1)
    rows = [(first + timedelta(days=i), i % 2) for i in range(n) for _ in range(2)]
    return spark.createDataFrame(rows, "session_date date, label int")


@pytest.mark.parametrize("n", [3, 4, 5, 7, 10, 20, 30, 31, 100])
def test_split_days(spark, n):
    t = max(0, int(n * 0.7) - 1)
    v = min(max(t + 1, int(n * 0.85) - 1), n - 2)
    found = features.time_split(_days(spark, n)).first()
    first = date(2024, 1, 1)
    assert tuple(found) == tuple(first + timedelta(days=i) for i in (t, v, v + 1))


def test_split_assignment(spark):
    counted = features.split_counts(features.assign_split(_days(spark, 10))).collect()
    assert [(r["split"], r["rows"]) for r in counted] == [("train", 14), ("validation", 2), ("test", 4)]


def test_split_needs_three_days(spark):
    with pytest.raises(PySparkException, match="at least 3 distinct days"):
        features.time_split(_days(spark, 2)).collect()


def test_profile(spark):
    row = features.dataset_profile(_features(events(spark, {}, {"user_id": 2, "event_type": "purchase"}))).first()
    assert (row["rows"], row["purchase_rate"], row["min_date"]) == (2, 0.5, date(2024, 1, 1))
