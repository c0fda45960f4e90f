import gzip
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickstrata import schema, sources
from clickstrata.operators.bronze import ingest_events
from clickstrata.operators.quality import warehouse_counts
from clickstrata.sources import scratch
from clickstrata.sources.files import GOLD_TABLES

from feeds import raw

HEADER = ",".join(schema.RAW_EVENTS.names)


def test_csv_file_and_folder(spark, tmp_path):
    (tmp_path / "one.csv").write_text(f"{HEADER}\n2024-01-01 00:00:00 UTC,view,1,2,a.b,x,1.5,9,s\n")
    (tmp_path / "two.csv").write_text(f"{HEADER}\n2024-01-01 00:00:01 UTC,cart,oops,,,,,9,\n")
    assert sources.read_raw_csv(spark, str(tmp_path / "one.csv")).count() == 1
    with gzip.open(tmp_path / "packed.gz", "wt") as packed:
        packed.write((tmp_path / "one.csv").read_text())
    assert sources.read_raw_csv(spark, str(tmp_path / "packed.gz")).first()["user_id"] == 9
    (tmp_path / "packed.gz").unlink()
    both = sources.read_raw_csv(spark, str(tmp_path)).orderBy("event_time").collect()
    assert [r["product_id"] for r in both] == [1, None]
    assert (both[1]["price"], both[1]["user_session"], both[1]["brand"]) == (None, None, None)


def _bronze(spark, *times):
    return ingest_events(raw(spark, *[{"event_time": t, "user_id": i} for i, t in enumerate(times, 1)]))


def test_rerun_of_a_month_leaves_the_others(spark, tmp_path, rows):
    path = sources.layer_path(str(tmp_path), "fact_events")
    sources.write_layer(_bronze(spark, "2024-01-05 00:00:00", "2024-02-05 00:00:00"), path, rebalance=True)
    rerun = _bronze(spark, "2024-02-09 00:00:00").withColumn("user_id", F.lit(7).cast("long"))
    sources.write_layer(rerun, path, rebalance=2)
    stored = sources.read_layer(spark, str(tmp_path), "fact_events")
    assert rows(stored, "user_id", "month") == [(1, 1), (7, 2)]
    sources.write_layer(rerun, path, dynamic=False, coalesce=1)
    assert spark.read.parquet(path).count() == 1


def test_date_bounds_prune_folders(spark, tmp_path, rows):
    times = ["2023-12-31 10:00:00", "2024-01-01 10:00:00", "2024-01-31 10:00:00", "2024-02-01 10:00:00"]
    sources.write_layer(_bronze(spark, *times), sources.layer_path(str(tmp_path), "fact_events"))
    part = sources.read_layer(spark, str(tmp_path), "fact_events", date(2024, 1, 1), date(2024, 1, 30))
    assert rows(part, "user_id") == [(2,)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "year" in filters and "month" in filters


def test_views_counts_manifest(spark, tmp_path, rows):
    root = str(tmp_path)
    for name in ("fact_events", "funnel_daily"):
        sources.write_layer(_bronze(spark, "2024-01-05 00:00:00"), sources.layer_path(root, name))
    tables = sources.register_views(spark, root, ["fact_events", "funnel_daily"])
    assert spark.sql("SELECT count(*) FROM funnel_daily").first()[0] == 1
    assert rows(warehouse_counts(tables)) == [("fact_events", 1), ("funnel_daily", 1)]
    assert rows(sources.layer_manifest(spark, root), "table_name") == sorted((n,) for n in GOLD_TABLES)


def test_mart_and_export_are_zstd(spark, tmp_path):
    mart = sources.build_mart(spark, "mart_x", spark.range(3), str(tmp_path / "mart"))
    assert mart.count() == spark.table("mart_x").count() == 3
    file = max((tmp_path / "mart").glob("*.parquet"), key=lambda f: f.stat().st_size)
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_report_and_schema_listing(spark, tmp_path):
    df = spark.createDataFrame([(1, [("view", 2)])], "rows long, d array<struct<event_type:string,count:long>>")
    sources.write_report(df, str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("*.json"))) == 1
    assert spark.read.json(str(tmp_path / "report")).first()["d"][0]["count"] == 2
    assert [tuple(r) for r in sources.describe(df).collect()] == [
        ("rows", "bigint"), ("d", "array<struct<event_type:string,count:bigint>>"),
    ]


class _Session:
    """As much of a session as the choice of the scratch folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {scratch.CONF: folder}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")


def test_scratch_folder(monkeypatch):
    monkeypatch.setattr(scratch, "_own", {})
    assert scratch._root(_Session("yarn", "s3a://shared/tmp/")) == "s3a://shared/tmp/clickstrata-app-1"
    assert scratch._root(_Session("local[2]", "/given")) == "/given/clickstrata-app-1"
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError, match="share"):
            scratch._root(_Session(master))
    scratch.use_folder(_Session("local[2]"), "/own")
    assert scratch._root(_Session("local[2]")) == "/own/clickstrata-app-1"
    assert scratch._root(_Session("local[2]", "/given")) == "/given/clickstrata-app-1"


def test_clear_scratch(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_root", lambda _, root=f"{scratch._root(spark)}-cleared": root)
    stored = sources.stage(spark.range(5), "numbers")
    assert stored.count() == 5
    folder = Path(stored.inputFiles()[0].removeprefix("file://")).parents[1]
    assert folder.exists()
    sources.clear_scratch(spark)
    assert not folder.exists()


def test_feed_keeps_every_event(spark, sf_dir):
    from clickstrata.sources.sample_feed import raw_events

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    repeated = events.where("event_id % 20 = 0").count()
    assert raw_events(spark, sf_dir).count() == events.count() + repeated
