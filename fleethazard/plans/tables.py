"""The training table: features and labels of every scorable cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.operators.features import build_tabular_features
from fleethazard.operators.labeling import fails_within, label_horizon, with_failure_cycle
from fleethazard.params import Profile


def join_features_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join of two separate tables on (engine_id, cycle); the compound key spreads a hot engine."""
    return features.join(labels, ["engine_id", "cycle"], "inner")


def join_remaining_left(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``remaining`` to scored rows."""
    return scored.join(labels.select("engine_id", "cycle", "remaining"), ["engine_id", "cycle"], "left")


def training_table(full: DataFrame, profile: Profile, history: str = "full") -> DataFrame:
    """Features, ``remaining`` and ``label`` in one pass over the sensor table.

    ``history='full'`` lets features look back over all cycles; ``'labeled'``
    builds them from the rows left after labelling, whose first frames are null.
    """
    if history not in ("full", "labeled"):
        raise ValueError(f"history must be 'full' or 'labeled', got {history}")
    if history == "labeled":
        base = label_horizon(full, profile.horizon_n, profile.window_l)
        return build_tabular_features(base, profile.features, profile.window_l,
                                      keep=["failure_cycle", "remaining", "label"])
    rows = with_failure_cycle(full).withColumn("remaining", F.col("failure_cycle") - F.col("cycle"))
    rows = rows.withColumn("label", fails_within(F.col("remaining"), profile.horizon_n))
    return build_tabular_features(rows, profile.features, profile.window_l,
                                  keep=["failure_cycle", "remaining", "label"])
