"""Bounded reruns against whole rebuilds."""

import random
from datetime import date

import pytest

import feeds
from clickstrata import schema
from clickstrata.plans import run_bronze, run_lakehouse, run_sessions
from clickstrata.sources import read_layer
from clickstrata.sources.files import layer_path

LAYERS = ("bronze_events", "fact_events", "fact_sessions", "product_daily", "user_daily", "funnel_daily")


def feed(seed, months, n=60):
    """Events of few users over the months; sessions cross month ends, and some have no label."""
    r = random.Random(seed)
    return [
        {
            "event_time": f"2024-{r.choice(months):02d}-{r.choice([1, 2, 15, 28, 29]):02d} {r.randrange(24):02d}:00:00 UTC",
            "event_type": r.choice(["view", "cart", "purchase", "other"]),
            "user_id": r.randrange(8),
            "user_session": r.choice(["a", "b", "c", None]),
            "product_id": r.randrange(5),
            "price": float(r.randrange(20)),
        }
        for _ in range(n)
    ]


def contents(spark, root, rows):
    return {name: rows(read_layer(spark, root, name).select(sorted(read_layer(spark, root, name).columns))) for name in LAYERS}


def month_of(event):
    return int(event["event_time"][5:7])


@pytest.mark.parametrize("case", ["changed", "emptied", "two months", "moved session", "first month", "new month"])
def test_rerun_equals_a_rebuild(spark, tmp_path, rows, case):
    before = feed(1, [1, 2, 3, 4, 5])
    span = {"two months": (2, 3), "first month": (1, 1), "new month": (6, 6)}.get(case, (3, 3))
    if case == "emptied":
        delivered = []
    elif case == "moved session":
        # A session that began in February and went on in March now has its March events under another label.
        own = [e for e in before if month_of(e) == 3]
        delivered = [e | {"user_session": "moved"} for e in own]
    else:
        delivered = feed(2, list(range(span[0], span[1] + 1)), 25)
    after = [e for e in before if not span[0] <= month_of(e) <= span[1]] + delivered
    bounded, whole = str(tmp_path / "bounded"), str(tmp_path / "whole")
    run_lakehouse(spark, feeds.raw(spark, *before), bounded)
    run_lakehouse(spark, _raw(spark, delivered), bounded, date(2024, span[0], 7), date(2024, span[1], 8))
    run_lakehouse(spark, _raw(spark, after), whole)
    assert contents(spark, bounded, rows) == contents(spark, whole, rows)


def _raw(spark, events):
    return feeds.raw(spark, *events) if events else spark.createDataFrame([], schema.RAW_EVENTS)


def test_rows_outside_of_the_span_are_left_out(spark, tmp_path, rows):
    root = str(tmp_path)
    first = feed(3, [1, 2])
    run_lakehouse(spark, feeds.raw(spark, *first), root)
    before = rows(read_layer(spark, root, "fact_events").where("month = 1"))
    run_lakehouse(spark, feeds.raw(spark, *feed(4, [1, 2])), root, date(2024, 2, 1), date(2024, 2, 29))
    assert rows(read_layer(spark, root, "fact_events").where("month = 1")) == before


def test_other_months_are_not_rewritten(spark, tmp_path):
    """Files of months that no changed session reaches stay the same files."""
    root = str(tmp_path)
    days = [{"event_time": f"2024-{m:02d}-10 00:00:00 UTC", "user_session": f"s{m}", "user_id": m} for m in (1, 2, 3)]
    run_lakehouse(spark, feeds.raw(spark, *days), root)

    def files(name):
        found = spark.read.parquet(layer_path(root, name)).inputFiles()
        return {f for f in found if "month=3" not in f}, {f for f in found if "month=3" in f}

    before = {name: files(name) for name in LAYERS}
    run_lakehouse(spark, feeds.raw(spark, days[2] | {"price": 9.0}), root, date(2024, 3, 1), date(2024, 3, 1))
    for name in LAYERS:
        others, own = files(name)
        assert others == before[name][0] and own != before[name][1], name


def test_bounds_come_together(spark, tmp_path):
    for span in ({"since": date(2024, 1, 1)}, {"until": date(2024, 1, 1)}, {"since": date(2024, 2, 1), "until": date(2024, 1, 1)}):
        with pytest.raises(ValueError, match="since and until"):
            run_bronze(spark, feeds.raw(spark, {}), str(tmp_path), **span)


def test_bounded_first_run_builds_the_sessions(spark, tmp_path):
    root = str(tmp_path)
    run_lakehouse(spark, feeds.raw(spark, {}), root, date(2024, 1, 1), date(2024, 1, 31))
    assert read_layer(spark, root, "fact_sessions").count() == 1
    run_sessions(spark, root, since=date(2024, 1, 1), until=date(2024, 1, 31))
    assert read_layer(spark, root, "fact_sessions").count() == 1
