"""End-to-end runs: train and select, compare all models, sequence model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethazard.functions.columns import model_feature_columns
from fleethazard.operators.classifiers import (
    FITTERS,
    fit_window_classifier_by_epochs,
    predict_by_model,
    predict_window_proba,
    top_feature_importance,
)
from fleethazard.operators.isolation_forest import fit_isolation_forest, score_isolation_forest
from fleethazard.operators.labeling import label_horizon
from fleethazard.operators.metrics import (
    compute_metrics,
    early_stop_best_epoch,
    eval_sequence_metrics,
    metrics_long,
    overfit_gap,
    select_best_model,
    split_base_rate,
    top_anomalies,
    topk_lift,
)
from fleethazard.operators.ordered import lookup_join
from fleethazard.operators.quality import require_valid_features
from fleethazard.operators.scaling import check_finite, fit_median_imputer, impute_median, median_params, nonfinite_counts
from fleethazard.operators.sequences import build_sequence_pipeline
from fleethazard.operators.splits import assign_split, cap_engines_per_split, fit_split, split_engines
from fleethazard.operators.sweep import (
    ranking_metrics, required_thresholds, select_threshold_highest, select_threshold_max_precision, thresholds_max_precision,
)
from fleethazard.params import Profile
from fleethazard.plans.tables import training_table
from fleethazard.session import checkpointed, compiled_methods, written
from fleethazard.sources.registry import save_model_version

SCORED = ["engine_id", "cycle", "label", "remaining", "split"]


def prepared_table(full: DataFrame, profile: Profile, history: str = "full") -> DataFrame:
    """Checked training table with its split, written once for the many reads that follow."""
    table = written(assign_split(training_table(full, profile, history), fit_split(full, profile.split)), "training")
    if history == "full":
        require_valid_features(table.drop("split", "label", "remaining", "failure_cycle"), profile.window_l)
    return table


def fit_candidates(table: DataFrame, profile: Profile, candidates: Sequence[str]) -> tuple[dict, DataFrame]:
    """Models fitted on the train rows, and the scores of all rows by every model (written once)."""
    features = model_feature_columns(table, ["split"])
    train = table.where(F.col("split") == "train")
    models = {c: FITTERS[c](train, features, profile.models) for c in candidates if c in FITTERS}
    if not models:
        raise ValueError("none of the candidates names a known model")
    with compiled_methods(table.sparkSession):
        return models, checkpointed(predict_by_model(models, table, SCORED))


def train_select_report(full: DataFrame, profile: Profile, candidates: Sequence[str] = ("logreg", "gbt"),
                        root: str | None = None, name: str = "tabular", version: str = "v1") -> dict:
    """Fit the candidates, choose by val PR-AUC, choose the threshold by policy, report all splits, save."""
    table = prepared_table(full, profile)
    models, scored = fit_candidates(table, profile, candidates)
    val_areas = ranking_metrics(scored.where(F.col("split") == "val"), group=["model"]).withColumn("split", F.lit("val"))
    best = select_best_model(val_areas, [c for c in candidates if c in models]).first()["model"]
    chosen = scored.where(F.col("model") == best)
    threshold = select_threshold_max_precision(
        chosen.where(F.col("split") == "val"), profile.policy.target_recall, profile.policy.min_precision)
    metrics = checkpointed(compute_metrics(chosen, threshold, group=["model", "split"]))
    features = model_feature_columns(table, ["split"])
    by_split = {r["split"]: r.asDict() for r in metrics.collect()}
    metadata = {
        "model_type": best, "featureset_version": profile.featureset_version, "horizon_n": profile.horizon_n,
        "window_l": profile.window_l, "feature_columns": features, "threshold": threshold,
        "bucket_cutoffs": list(profile.policy.bucket_cutoffs), "target_recall": profile.policy.target_recall,
        "min_precision": profile.policy.min_precision, "val_metrics": by_split.get("val"), "test_metrics": by_split.get("test"),
    }
    if root:
        save_model_version(full.sparkSession, name, version, models[best], metadata, root)
    return {"model": models[best], "metadata": metadata, "metrics": metrics_long(metrics, ["model", "split"]),
            "scored": scored}


def _window_splits(full: DataFrame, profile: Profile, caps: dict[str, int | None]) -> tuple[DataFrame, DataFrame]:
    labeled = label_horizon(full, profile.horizon_n, profile.window_l)
    return labeled, cap_engines_per_split(split_engines(full, profile.split), caps)


def train_window_model(full: DataFrame, profile: Profile, caps: dict[str, int | None] | None = None,
                       root: str | None = None, name: str = "seq", version: str = "v0") -> dict:
    """Sequence training: label, split, cap engines, scale, cut windows, fit with early stopping on val, threshold on val, report, save."""
    spark = full.sparkSession
    labeled, split = _window_splits(full, profile, caps or {})
    split = checkpointed(split)
    parts = build_sequence_pipeline(labeled, split.where(F.col("split") == "train"), profile.window_l, keep=["remaining"])
    n = len(parts["feature_columns"])
    windows = written(lookup_join(parts["windows"], split.select("engine_id", "split"), ["engine_id"]), "windows")
    of = lambda name: windows.where(F.col("split") == name)
    model, history = fit_window_classifier_by_epochs(of("train"), of("val"), profile.window_l, n, profile.models)
    scored = predict_window_proba(model, windows, profile.window_l, n).withColumnRenamed("pred_cycle", "cycle")
    scored = checkpointed(scored)
    threshold = select_threshold_highest(
        scored.where(F.col("split") == "val"), profile.policy.target_recall, profile.policy.min_precision)
    order = [F.col("engine_id"), F.col("cycle")]
    report = eval_sequence_metrics(scored, order, threshold, group=["split"], score="y_proba")
    val = report.where(F.col("split") == "val").first()
    best = early_stop_best_epoch(history, profile.models.mlp_patience).first()
    metadata = {
        "featureset_version": profile.featureset_version, "val_metrics": val.asDict() if val else None,
        "model_type": "mlp", "hparams": {"window_l": profile.window_l, "n_features": n}, "threshold": threshold,
        "feature_columns": parts["feature_columns"], "bucket_cutoffs": list(profile.policy.bucket_cutoffs),
        "target_recall": profile.policy.target_recall, "min_precision": profile.policy.min_precision,
        "scaler_params": parts["scaler_params"], "horizon_n": profile.horizon_n, "window_l": profile.window_l,
        "best_epoch": best["best_epoch"], "epochs_run": best["epochs_run"],
    }
    if root:
        save_model_version(spark, name, version, model, metadata, root)
    return {"model": model, "metadata": metadata, "metrics": report, "scored": scored, "history": history}


def run_anomaly(full: DataFrame, profile: Profile, history: str = "labeled", root: str | None = None,
                table: DataFrame | None = None) -> dict:
    """Impute by train medians, fit the forest on train, score every split, report.

    ``table`` is the `prepared_table` of ``history``, if it is there already.

    ``topk`` (lifts), ``base_rates`` per split, ``nonfinite`` (what was imputed, per feature), ``top_anomalies`` (the ten strangest rows of
    each split), ``scored`` and ``forest``; with ``root``, scores and forest are stored under it."""
    table = prepared_table(full, profile, history) if table is None else table
    features = model_feature_columns(table, ["split"])
    if not features:
        raise ValueError("the table holds no features")
    train = table.where(F.col("split") == "train")
    medians = median_params(fit_median_imputer(train, features))
    with compiled_methods(full.sparkSession):
        filled = written(impute_median(table, medians), "imputed")
    check_finite(filled, features, "features after imputation")
    train = filled.where(F.col("split") == "train")
    forest = written(fit_isolation_forest(train, features, profile.forest), "forest")
    scored = score_isolation_forest(forest, filled, features, profile.forest.max_samples, train.count())
    scored = written(scored.select("engine_id", "cycle", "label", "remaining", "anomaly_score", "split"), "anomaly-scores")
    if root:
        scored.write.mode("overwrite").parquet(f"{root}/scores")
        forest.write.mode("overwrite").parquet(f"{root}/forest")
    return {"scored": scored, "topk": topk_lift(scored), "forest": forest, "features": features, "imputed": filled,
            "base_rates": split_base_rate(scored), "nonfinite": nonfinite_counts(table, features),
            "top_anomalies": top_anomalies(scored, 10)}


def compare_models(full: DataFrame, profile: Profile, candidates: Sequence[str] = ("logreg", "gbt"),
                   with_windows: bool = True, with_forest: bool = True) -> dict:
    """All supervised models and the forest: metrics per split at each model's own threshold, gap, best model, top-k lifts.

    The thresholds of the candidates come from one sweep, grouped by model."""
    table = prepared_table(full, profile)
    _, scored = fit_candidates(table, profile, candidates)
    names = [c for c in candidates if c in FITTERS]
    policy = profile.policy
    thresholds = required_thresholds(
        thresholds_max_precision(scored.where(F.col("split") == "val"), policy.target_recall, policy.min_precision, group=["model"]),
        ["model"], policy.target_recall, policy.min_precision)
    thresholds = {r["model"]: r["threshold"] for r in thresholds}
    if with_windows:
        window_run = train_window_model(full, profile)
        thresholds["mlp"] = window_run["metadata"]["threshold"]
        rows = window_run["scored"].select(F.lit("mlp").alias("model"), *SCORED, "y_proba")
        scored, names = scored.unionByName(rows), [*names, "mlp"]
    threshold = F.create_map(*[F.lit(x) for c in names for x in (c, thresholds[c])])[F.col("model")]
    scored = scored.withColumn("threshold", threshold)
    metrics = checkpointed(compute_metrics(scored, F.col("threshold"), group=["model", "split"]))
    out = {"metrics": metrics_long(metrics, ["model", "split"]), "gap": overfit_gap(metrics),
           "best": select_best_model(metrics, names), "thresholds": thresholds, "scored": scored}
    return out | ({"topk": run_anomaly(full, profile, history="full", table=table)["topk"]} if with_forest else {})


def importance_report(spark: SparkSession, full: DataFrame, profile: Profile, top: int = 20) -> DataFrame:
    """Largest importances of the boosted trees."""
    table = prepared_table(full, profile)
    features = model_feature_columns(table, ["split"])
    model = FITTERS["gbt"](table.where(F.col("split") == "train"), features, profile.models)
    return top_feature_importance(model, features, spark, top)
