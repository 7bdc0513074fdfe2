"""Scores and alerts from a feature stream."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleethazard.functions.policy import apply_policy
from fleethazard.functions.scalar import is_finite
from fleethazard.operators.classifiers import predict_proba
from fleethazard.params import FeatureSpec
from fleethazard.streaming.features import Sink, parquet_sink, stream_features


def split_complete(features: DataFrame, metadata: dict) -> tuple[DataFrame, DataFrame]:
    """(rows a model can score, rejected keys with their reason): every feature must be there and finite."""
    missing = reduce(or_, [F.col(c).isNull() | ~is_finite(F.col(c)) for c in metadata["feature_columns"]])
    rejected = features.where(missing).select("engine_id", "cycle", F.lit("missing features").alias("reject_reason"))
    return features.where(~missing), rejected


def score_batch(model: PipelineModel, metadata: dict, features: DataFrame) -> DataFrame:
    """Response rows for complete feature rows: score, bucket, threshold, alert, model. `split_complete` has the others."""
    scored = predict_proba(model, split_complete(features, metadata)[0], "risk_score")
    responses = apply_policy(scored, metadata["threshold"], metadata["bucket_cutoffs"], "risk_score")
    return responses.select(
        "engine_id", "cycle", "risk_score", "bucket", "threshold", "is_alert",
        F.lit(metadata.get("version", "v1")).alias("model_version"), F.lit(metadata["model_type"]).alias("model_type"))


def alert_sink(model: PipelineModel, metadata: dict, out_path: str, alerts_only: bool = True, rejects_path: str | None = None) -> Sink:
    """Responses of every micro-batch to a folder of its own, rejected rows to one under ``rejects_path`` (``out_path`` +
    ``_rejected``); a repeated micro-batch overwrites itself."""
    responses, rejects = parquet_sink(out_path), parquet_sink(rejects_path or f"{out_path}_rejected")

    def write(features: DataFrame, batch_id: int) -> None:
        features = features.persist()  # scored and searched for rejects
        scored = score_batch(model, metadata, features)
        responses(scored.where("is_alert") if alerts_only else scored, batch_id)
        rejects(split_complete(features, metadata)[1], batch_id)
        features.unpersist()

    return write


def stream_score_alerts(stream: DataFrame, spec: FeatureSpec, model: PipelineModel, metadata: dict, out_path: str,
                        state_path: str, checkpoint: str, alerts_only: bool = True, trigger: dict | None = None,
                        rejects_path: str | None = None) -> StreamingQuery:
    """Features, scores and alerts of a stream of cycles."""
    sink = alert_sink(model, metadata, out_path, alerts_only, rejects_path)
    return stream_features(stream, spec, sink, state_path, checkpoint, trigger)
