"""Scoring requests: JSON windows in, features out, faulty requests set aside with a reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.scalar import is_finite
from fleethazard.operators.features import last_window_features
from fleethazard.params import FeatureSpec

WINDOW_TYPE = "array<map<string,double>>"


def parse_window_json(requests: DataFrame, body: str = "body") -> DataFrame:
    """Add ``window`` parsed from ``{"window": [{signal: value, ...}, ...]}``; null when it does not parse."""
    parsed = F.from_json(F.col(body), f"window {WINDOW_TYPE}", {"allowNonNumericNumbers": "true"})
    return requests.withColumn("window", parsed["window"])


def reject_reason(window: Column, signals: Sequence[str], window_l: int) -> Column:
    """Why a window cannot be scored, or null."""
    needed = F.array(*[F.lit(s) for s in signals])
    has_all = F.forall(window, lambda row: F.size(F.array_except(needed, F.map_keys(row))) == 0)
    finite = F.forall(window, lambda row: F.forall(needed, lambda s: F.coalesce(is_finite(row[s]), F.lit(False))))
    return (
        F.when(window.isNull(), "unreadable")
        .when(F.size(window) != window_l, "wrong length")
        .when(~has_all, "missing keys")
        .when(~finite, "not finite")
    )


def validate_window_request(parsed: DataFrame, signals: Sequence[str], window_l: int) -> DataFrame:
    return parsed.withColumn("reject_reason", reject_reason(F.col("window"), signals, window_l))


def window_rows(valid: DataFrame, signals: Sequence[str], request_id: str = "request_id") -> DataFrame:
    """One row per cycle of each window; the request takes the place of the engine."""
    return valid.select(F.col(request_id).alias("engine_id"), F.posexplode("window").alias("pos", "row")).select(
        "engine_id", F.col("pos").cast("long").alias("cycle"), *[F.col("row")[s].alias(s) for s in signals])


def request_features(parsed: DataFrame, signals: Sequence[str], spec: FeatureSpec, window_l: int,
                     request_id: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """(features per valid request, rejected requests with reason)."""
    checked = validate_window_request(parsed, signals, window_l)
    valid = checked.where(F.col("reject_reason").isNull())
    rows = window_rows(valid, signals, request_id)
    features = last_window_features(rows, spec, window_l).drop("cycle", "rows_seen")
    rejected = checked.where(F.col("reject_reason").isNotNull()).select(request_id, "reject_reason")
    return features.withColumnRenamed("engine_id", request_id), rejected
