from clickstrata import schema
from clickstrata.operators import silver
from clickstrata.operators.bronze import ingest_events
from clickstrata.operators.quality import duplicate_keys, null_rates, profile, quality_bronze, value_distribution

from feeds import events, raw, ts


def test_times(spark, rows):
    feed = raw(
        spark,
        {"event_time": "2024-01-31 23:59:59 UTC", "user_id": 1},
        {"event_time": "2024-02-01 00:00:00", "user_id": 2},
        {"event_time": "2024-03-05 01:02:03   UTC", "user_id": 3},
        {"event_time": "not-a-time"},
        {"event_time": None},
        {"event_time": "2024-13-01 00:00:00 UTC"},
        {"event_time": "2024-01-01 00:00:00 GMT"},
    )
    bronze = ingest_events(feed)
    assert bronze.columns == schema.BRONZE_COLUMNS
    assert rows(bronze, "user_id", "event_ts", "year", "month") == [
        (1, ts("2024-01-31 23:59:59"), 2024, 1),
        (2, ts("2024-02-01 00:00:00"), 2024, 2),
        (3, ts("2024-03-05 01:02:03"), 2024, 3),
    ]
    assert quality_bronze(bronze).first()["rows"] == 3


def test_types_and_required_fields(spark, rows):
    feed = ingest_events(
        raw(
            spark,
            {"event_type": "VIEW", "user_id": 1},
            {"event_type": "Cart", "user_id": 2},
            {"event_type": "remove_from_cart", "user_id": 3},
            {"event_type": None, "user_id": 4},
            {"user_id": None},
            {"user_id": 5, "product_id": None},
        )
    )
    typed = silver.with_canonical_types(feed)
    assert typed.where("event_type is null").count() == 2
    assert rows(silver.clean_events(feed), "user_id", "event_type") == [(1, "view"), (2, "cart")]


def test_dedup_keeps_the_same_copy(spark, rows):
    feed = ingest_events(
        raw(
            spark,
            {"price": 6.0, "brand": "x"},
            {"price": 5.0, "brand": "z"},
            {"price": 5.0, "brand": "y"},
            {"price": None, "brand": "a"},
            {"user_session": None, "price": 2.0},
            {"user_session": None, "price": 1.0},
        )
    )
    expected = [("a", 5.0, "y"), (None, 1.0, None)]
    for parts in (1, 3, 7):
        clean = silver.clean_events(feed.repartition(parts))
        assert rows(clean, "user_session", "price", "brand") == sorted(expected, key=str)


def test_dedup_limits_copies_before_the_shuffle(spark):
    plan = silver.clean_events(ingest_events(raw(spark, {})))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_profile(spark):
    feed = events(spark, {"brand": "b"}, {}, {"user_id": 2, "price": None})
    row = profile(feed, schema.EVENT_IDENTITY).first()
    assert (row["rows"], row["cols"], row["dup_keys"]) == (3, 12, 1)
    assert row["null_rate"]["brand"] == 2 / 3 and row["null_rate"]["price"] == 1 / 3
    assert "dup_keys" not in profile(feed).columns
    assert {r["null_rate"] for r in null_rates(feed.limit(0)).collect()} == {0.0}
    assert duplicate_keys(feed, ["user_id"]).first()["dup_keys"] == 1
    counts = value_distribution(feed, "brand").collect()
    assert [tuple(r) for r in counts] == [(None, 2), ("b", 1)]
