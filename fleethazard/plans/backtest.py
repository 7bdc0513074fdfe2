"""Expanding-fold backtest: each fold chooses its model and threshold on its own val engines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.columns import model_feature_columns
from fleethazard.operators.classifiers import FITTERS, predict_by_model
from fleethazard.operators.metrics import calibration_bins, compute_metrics, metrics_long, select_best_model, top_errors
from fleethazard.operators.ordered import lookup_join
from fleethazard.operators.quality import require_valid_features
from fleethazard.operators.splits import expanding_folds, train_val_engines
from fleethazard.operators.sweep import ranking_metrics, required_thresholds, thresholds_max_precision
from fleethazard.params import Profile
from fleethazard.plans.tables import training_table
from fleethazard.session import checkpointed, compiled_methods, written

KEYS = ["engine_id", "cycle", "label", "remaining", "split"]


def _fold_scores(table: DataFrame, roles: DataFrame, number: int, profile: Profile, features: list[str], names: list[str]) -> DataFrame:
    """Val and test rows of a fold, scored by every candidate fitted on its train rows."""
    rows = lookup_join(table, roles, ["engine_id"])  # the table is written once; a fold is a filter on it
    train, rest = (rows.where(F.col("split") == "train"), rows.where(F.col("split") != "train"))
    models = {c: FITTERS[c](train, features, profile.models) for c in names}
    return predict_by_model(models, rest, KEYS).select(F.lit(number).alias("fold"), "model", *KEYS, "y_proba")


def run_backtest(full: DataFrame, profile: Profile) -> dict:
    """``metrics, errors, calibration, folds, scored, thresholds`` with ``fold`` as a column, or a message when no fold fits.

    Models are fitted fold by fold; all their scores make one table, and the best model, the threshold and the reports of
    all folds are taken from it in sweeps grouped by fold."""
    spec, policy = profile.backtest, profile.policy
    names = [c for c in spec.candidates if c in FITTERS]
    if not names:
        raise ValueError("none of the candidates names a known model")
    table = written(training_table(full, profile), "training")
    require_valid_features(table.drop("label", "remaining", "failure_cycle"), profile.window_l)
    features = model_feature_columns(table)
    folds = expanding_folds(table, spec.n_folds, spec.train_min_engines, spec.test_engines_per_fold)
    folds = checkpointed(train_val_engines(folds, spec.val_ratio))
    sizes = folds.groupBy("fold").pivot("role", ["train", "val", "test"]).agg(F.count(F.lit(1))).fillna(0)
    roles = sorted(sizes.collect(), key=lambda r: r["fold"])  # a row per fold
    if not roles:
        return {"message": "The fleet is too small for a single fold."}
    if any(not r["val"] for r in roles):
        raise ValueError("a fold has no engine left to validate on; raise train_min_engines or val_ratio")

    of = lambda k: folds.where(F.col("fold") == k).select("engine_id", F.col("role").alias("split"))
    scored = reduce(DataFrame.unionByName, [_fold_scores(table, of(r["fold"]), r["fold"], profile, features, names) for r in roles])
    with compiled_methods(full.sparkSession):
        scored = written(scored, "fold-scores")
    val = scored.where(F.col("split") == "val")
    best = select_best_model(ranking_metrics(val, group=["fold", "model"]).withColumn("split", F.lit("val")), names, ["fold"])
    chosen = lookup_join(scored, best.select("fold", "model"), ["fold", "model"])  # a row per fold
    found = thresholds_max_precision(chosen.where(F.col("split") == "val"), policy.target_recall, policy.min_precision, group=["fold"])
    thresholds = {r["fold"]: r["threshold"] for r in required_thresholds(found, ["fold"], policy.target_recall, policy.min_precision)}
    at = F.create_map(*[F.lit(x) for k in thresholds for x in (k, thresholds[k])])[F.col("fold")]
    test = written(chosen.where(F.col("split") == "test").withColumn("threshold", at), "fold-tests")
    predicted = test.withColumn("y_pred", (F.col("y_proba") >= F.col("threshold")).cast("int"))
    return {
        "metrics": metrics_long(compute_metrics(test, F.col("threshold"), group=["fold", "model"]), ["fold", "model"]),
        "errors": top_errors(predicted, profile.horizon_n, spec.early_alarm_slack, 20, group=["fold"]),
        "calibration": calibration_bins(test, spec.calibration_bins, spec.calibration_strategy, group=["fold"]),
        "folds": sizes, "thresholds": thresholds, "best": best, "scored": scored, "test": test,
    }
