"""What a score leads to: bucket, threshold, alert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.scalar import risk_bucket


def apply_policy(df: DataFrame, threshold: Column | float, bucket_cutoffs: Sequence[float],
                 score: str = "y_proba") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumns({
        "bucket": risk_bucket(F.col(score), bucket_cutoffs),
        "threshold": t,
        "is_alert": F.col(score) >= t,
    })
