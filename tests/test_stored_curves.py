"""The modelling job stores the whole curves; only the report's arrays are thinned."""

import __spark_entry__ as registry
from clickstrata.plans import run_bronze, run_modelling, run_sessions, run_silver


def test_full_curves_are_stored(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    run_bronze(spark, registry._raw(spark, sf_dir), root)
    run_silver(spark, root)
    run_sessions(spark, root)
    report = run_modelling(spark, root, gbt_iter=2, logistic_iter=20, min_rows_per_leaf=3, max_points=4).first()
    for name, key in (("ml_pr_curve", "pr_curve"), ("ml_roc_curve", "roc_curve")):
        stored = spark.read.parquet(f"{root}/gold/{name}").groupBy("model", "split").count().collect()
        points = {(r["model"], r["split"]): r["count"] for r in stored}
        assert len(points) == 4 and max(points.values()) > 4
        for m in report["models"]:
            assert len(m[key]["x"]) == min(4, points[m["model"], m["split"]])
