"""Feature table to models, scores and the model report."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.operators.boosting import train_boosted
from clickstrata.operators.curves import (
    MAX_POINTS,
    average_precision,
    curve_arrays,
    pr_curve,
    roc_auc,
    roc_curve,
    score_steps,
    thin_curve,
)
from clickstrata.operators.experiment import experiment_readout_enhanced
from clickstrata.operators.features import (
    SPLITS,
    assign_split,
    dataset_profile,
    session_features,
    split_counts,
    time_split,
)
from clickstrata.operators.model_tables import LogisticModel, TreeModel
from clickstrata.operators.models import as_exported, score_summary
from clickstrata.operators.ranking import (
    calibration_curve,
    lift_curve,
    rank_scores,
    ranking_metrics,
    score_table,
    threshold_metrics,
)
from clickstrata.operators.reweighted import train_reweighted
from clickstrata.operators.sampling import cap_sample, sample_summary
from clickstrata.sources import (
    export_parquet,
    layer_path,
    read_layer,
    stage,
    write_layer,
    write_report,
)


def _listed(df: DataFrame, by: Sequence[str], name: str, order: str) -> DataFrame:
    """The rows of each set as one ordered array of structs; for a handful of rows per set."""
    fields = [c for c in df.columns if c not in by and c != order]
    rows = F.sort_array(F.collect_list(F.struct(order, *fields)))
    return df.groupBy(*by).agg(rows.alias(name))


@dataclass
class Curves:
    """The whole curves of score sets, and the steps they come from; stored."""

    steps: DataFrame
    pr: DataFrame
    roc: DataFrame


def whole_curves(scores: DataFrame, by: Sequence[str]) -> Curves:
    """Sorts the scores once for both curves."""
    steps = score_steps(scores, by)
    return Curves(steps, stage(pr_curve(steps, by), "pr_curve"), stage(roc_curve(steps, by), "roc_curve"))


def evaluate(scores: DataFrame, by: Sequence[str], max_points: int = MAX_POINTS, curves: Curves | None = None) -> DataFrame:
    """One row per score set with its metrics and curves; all sets go through each pass together.

    ``max_points`` bounds the points of each curve in these rows only; the metrics come from all steps.
    With ``curves``, those of the scores, ``scores`` is a stored table.
    """
    by = list(by)
    if curves is None:
        scores = stage(scores, "scores")
        curves = whole_curves(scores, by)
    ranked, steps = rank_scores(scores, by), curves.steps
    pr = curve_arrays(thin_curve(curves.pr, max_points), "recall", "precision", by)
    roc = curve_arrays(thin_curve(curves.roc, max_points), "fpr", "tpr", by)
    confusion = F.array(
        F.array("true_negatives", "false_positives"), F.array("false_negatives", "true_positives")
    )
    at_threshold = threshold_metrics(scores, by=by).select(
        *by, "precision", "recall", "f1", "brier_score", confusion.alias("confusion_matrix")
    )
    parts = [
        average_precision(steps, by).withColumnRenamed("average_precision", "pr_auc"),
        roc_auc(steps, by),
        at_threshold,
        _listed(ranking_metrics(ranked, by=by), by, "ranking", "cutoff"),
        pr.select(*by, F.struct("x", "y").alias("pr_curve")),
        roc.select(*by, F.struct("x", "y").alias("roc_curve")),
        _listed(calibration_curve(ranked, by=by), by, "calibration_curve", "bin"),
        _listed(lift_curve(ranked, by=by), by, "lift_curve", "bucket"),
    ]
    return reduce(lambda left, right: left.join(right, by, "left"), parts)


def model_report(
    features: DataFrame,
    evaluation: DataFrame,
    importance: DataFrame,
    sampling: DataFrame,
    scored: DataFrame,
    experiment: DataFrame,
    best_iteration: int,
    settings: dict[str, int],
) -> DataFrame:
    """Everything about a modelling run in one row. ``features`` carries the split column; ``settings`` are those of the run."""

    def one(df):
        return df.select(F.struct(*df.columns)).scalar()

    def many(df):
        return df.agg(F.collect_list(F.struct(*df.columns))).scalar()

    profile = dataset_profile(features).select("rows", "purchase_rate", "min_date", "max_date")
    return features.agg(F.max("session_date").alias("_")).select(
        F.struct(*[F.lit(value).alias(name) for name, value in settings.items()]).alias("settings"),
        one(profile).alias("dataset_profile"),
        one(time_split(features)).alias("splits"),
        many(split_counts(features)).alias("split_counts"),
        F.array(*[F.lit(name) for name in schema.FEATURES]).alias("feature_columns"),
        one(sampling).alias("logistic_sampling"),
        many(evaluation).alias("models"),
        F.lit(best_iteration).alias("best_iteration"),
        many(importance).alias("feature_importance"),
        one(score_summary(scored)).alias("score_summary"),
        one(experiment).alias("experiment_enhanced"),
    )


@dataclass(frozen=True)
class Cuts:
    """The days that split a feature table, as values: filters on them reach the scan."""

    train_end: date
    validation_end: date

    @classmethod
    def of(cls, features: DataFrame) -> "Cuts":
        row = time_split(features).first()
        return cls(row["train_end"], row["validation_end"])

    def part(self, features: DataFrame, split: str) -> DataFrame:
        """The rows of a split. On a table stored by month the months outside of it are not read."""
        spans = {
            SPLITS[0]: (None, self.train_end),
            SPLITS[1]: (self.train_end, self.validation_end),
            SPLITS[2]: (self.validation_end, None),
        }
        after, until = spans[split]
        day, monthly = F.col("session_date"), "month" in features.columns
        month = (F.col("year") * 12 + F.col("month")) if monthly else None
        if after is not None:
            features = features.where(day > F.lit(after))
            features = features.where(month >= after.year * 12 + after.month) if monthly else features
        if until is not None:
            features = features.where(day <= F.lit(until))
            features = features.where(month <= until.year * 12 + until.month) if monthly else features
        return features.withColumn("split", F.lit(split))


def held_out_scores(features: DataFrame, cuts: Cuts, logistic: LogisticModel, boosted: TreeModel) -> DataFrame:
    """Scores of both models for all sessions outside of the training part, with columns ``model`` and ``split``."""
    held_out = cuts.part(features, SPLITS[1]).unionByName(cuts.part(features, SPLITS[2]))
    sets = [
        score_table(model.scores(held_out, ["split"]), keep=["split"]).withColumn("model", F.lit(name))
        for name, model in (("logistic_regression", logistic), ("boosted_trees", boosted))
    ]
    return sets[0].unionByName(sets[1])


@dataclass
class Fit:
    """What a modelling run makes; tables are stored, but for the report."""

    logistic: LogisticModel
    boosted: TreeModel
    scores: DataFrame
    curves: Curves
    experiment: DataFrame
    report: DataFrame


def fit_and_report(
    features: DataFrame,
    events: DataFrame,
    *,
    max_rows: int = 1_000_000,
    logistic_iter: int = 50,
    gbt_iter: int = 300,
    min_rows_per_leaf: int = 100,
    max_points: int = MAX_POINTS,
) -> Fit:
    """Models, scores of all sessions, whole curves, experiment readout and report from a stored feature table.

    ``max_points`` is the length of the report's curve arrays at most; the curves of the result are whole.
    """
    cuts, by = Cuts.of(features), ["model", "split"]
    train = cuts.part(features, SPLITS[0])
    sample = stage(cap_sample(train, "session_id", max_rows), "sample")
    logistic = train_reweighted(sample, max_rounds=logistic_iter)
    boosted = train_boosted(train, cuts.part(features, SPLITS[1]), rounds=gbt_iter, least_rows=min_rows_per_leaf)

    held_out = stage(held_out_scores(features, cuts, logistic, boosted), "scores")
    curves = whole_curves(held_out, by)
    scored = stage(boosted.scores(features), "all_scores")
    experiment = stage(experiment_readout_enhanced(events), "experiment")
    report = model_report(
        assign_split(features, time_split(features)),
        evaluate(held_out, by, max_points, curves),
        boosted.importance(),
        sample_summary(sample, train),
        scored,
        experiment,
        boosted.rounds,
        dict(max_rows=max_rows, logistic_iter=logistic_iter, gbt_iter=gbt_iter, min_rows_per_leaf=min_rows_per_leaf),
    )
    return Fit(logistic, boosted, scored, curves, experiment, report)


def run_modelling(spark: SparkSession, root: str, **settings: int) -> DataFrame:
    """Stores features by month, scores, full curves by model and split, enhanced readout, report and both models below ``root``."""
    root = root.rstrip("/")
    events = read_layer(spark, root, "fact_events")
    features = session_features(read_layer(spark, root, "fact_sessions"), events)
    by_month = features.withColumns({"year": F.year("session_date"), "month": F.month("session_date")})
    write_layer(by_month, layer_path(root, "ml_session_dataset"), dynamic=False, rebalance=True)
    fit = fit_and_report(read_layer(spark, root, "ml_session_dataset"), events, **settings)
    export_parquet(as_exported(fit.scores), layer_path(root, "ml_session_scores"))
    for name, curve in (("ml_pr_curve", fit.curves.pr), ("ml_roc_curve", fit.curves.roc)):
        export_parquet(curve, layer_path(root, name))
    export_parquet(fit.experiment, layer_path(root, "experiment_readout_enhanced"))
    write_report(fit.report, f"{root}/reports/ml_metrics")
    fit.logistic.save(f"{root}/models/session_logistic_regression")
    fit.boosted.save(f"{root}/models/session_boosted_trees")
    return spark.read.json(f"{root}/reports/ml_metrics")
