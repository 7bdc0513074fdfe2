"""Column expressions without state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonfinite_to_null(c: Column) -> Column:
    return F.when(is_finite(c), c)


def is_finite(c: Column) -> Column:
    """False for NaN and both infinities; null stays null."""
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def logit_loss(z: Column, y: Column) -> Column:
    """Binary cross-entropy of a logit, in the form that does not overflow."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z


def predict_at(score: Column, threshold: Column | float) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= t).cast("int")


def risk_bucket(score: Column, cutoffs: Sequence[float]) -> Column:
    if len(cutoffs) != 2:
        raise ValueError("three buckets need two cut-offs")
    low, high = (float(c) for c in cutoffs)
    return F.when(score < low, "low").when(score < high, "med").otherwise("high")


def digitize(x: Column, edges: Column) -> Column:
    """Index of the right-closed bin: how many edges lie strictly below ``x``."""
    return F.size(F.filter(edges, lambda e: e < x))


def linspace_edges(n_bins: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n_bins)), lambda i: i / F.lit(float(n_bins)))


def ceil_count(n: Column, fraction: float) -> Column:
    """ceil(fraction * n), at least one, in double arithmetic."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(n.cast("double") * F.lit(float(fraction))).cast("long"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
