"""Score the newest window of every engine, or a table of JSON requests, with a saved model."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.functions.columns import signal_columns
from fleethazard.functions.policy import apply_policy
from fleethazard.functions.scalar import is_finite
from fleethazard.operators.classifiers import predict_window_proba
from fleethazard.operators.features import last_window_features
from fleethazard.operators.requests import parse_window_json, request_features
from fleethazard.operators.scaling import standardize
from fleethazard.operators.sequences import sequence_windows
from fleethazard.params import Profile
from fleethazard.streaming.alerts import score_batch, split_complete


def latest_window_features(full: DataFrame, profile: Profile) -> DataFrame:
    """Features of the last window of every engine that has a full window."""
    newest = last_window_features(full.select("engine_id", "cycle", *signal_columns(full)), profile.features, profile.window_l)
    return newest.where(F.col("rows_seen") == profile.window_l).drop("rows_seen")


def latest_window_rejects(full: DataFrame, profile: Profile) -> DataFrame:
    """Engines that `score_latest_windows` cannot score, with the reason: fewer rows than a window, or a missing feature."""
    newest = last_window_features(full.select("engine_id", "cycle", *signal_columns(full)), profile.features, profile.window_l)
    features = {"feature_columns": [c for c in newest.columns if "__" in c]}
    short = newest.where(F.col("rows_seen") < profile.window_l).select("engine_id", "cycle", F.lit("short history").alias("reject_reason"))
    return short.unionByName(split_complete(newest.where(F.col("rows_seen") == profile.window_l), features)[1])


def score_latest_windows(full: DataFrame, model: PipelineModel, metadata: dict, profile: Profile) -> DataFrame:
    return score_batch(model, metadata, latest_window_features(full, profile))


def score_latest_with_network(full: DataFrame, model: PipelineModel, metadata: dict) -> tuple[DataFrame, DataFrame]:
    """(responses, rejected) of the newest window of every engine, by a model that `train_window_model` saved.

    A window must have all its rows and finite readings; it is scaled by the saved statistics before it is scored.
    """
    names, length = metadata["feature_columns"], metadata["window_l"]
    newest = Window.partitionBy("engine_id").orderBy(F.col("cycle").desc())
    recent = full.select("engine_id", "cycle", *names).withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= length)
    faulty = F.count_if(reduce(or_, [F.col(c).isNull() | ~is_finite(F.col(c)) for c in names]))
    reason = F.when(F.count("*") < length, "short history").when(faulty > 0, "not finite")
    judged = recent.groupBy("engine_id").agg(F.max("cycle").alias("cycle"), reason.alias("reject_reason"))
    good = judged.where(F.col("reject_reason").isNull()).select("engine_id")
    windows = sequence_windows(standardize(recent.join(good, "engine_id"), metadata["scaler_params"]), names, length, None)
    scored = predict_window_proba(model, windows, length, len(names)).withColumnsRenamed(
        {"pred_cycle": "cycle", "y_proba": "risk_score"})
    responses = apply_policy(scored, metadata["threshold"], metadata["bucket_cutoffs"], "risk_score").select(
        "engine_id", "cycle", "risk_score", "bucket", "threshold", "is_alert",
        F.lit(metadata.get("version", "v0")).alias("model_version"), F.lit(metadata["model_type"]).alias("model_type"))
    return responses, judged.where(F.col("reject_reason").isNotNull())


def score_window_requests(requests: DataFrame, signals: list[str], model: PipelineModel, metadata: dict,
                          profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(responses, rejected) for a table ``request_id, body``."""
    features, rejected = request_features(parse_window_json(requests), signals, profile.features, profile.window_l)
    renamed = features.withColumnRenamed("request_id", "engine_id").withColumn("cycle", F.lit(profile.window_l).cast("long"))
    responses = score_batch(model, metadata, renamed).drop("cycle").withColumnRenamed("engine_id", "request_id")
    return responses, rejected
