"""Failure labels from run-to-failure histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.columns import require_columns
from fleethazard.operators.ordered import lookup_join


def failure_cycles(df: DataFrame) -> DataFrame:
    """Last cycle of every engine; aggregated before it is shuffled."""
    return df.groupBy("engine_id").agg(F.max("cycle").alias("failure_cycle"))


def with_failure_cycle(df: DataFrame) -> DataFrame:
    return lookup_join(df, failure_cycles(df), ["engine_id"])


def fails_within(remaining: Column, horizon_n: int) -> Column:
    """1 iff 0 < remaining <= horizon; the failure cycle itself counts as 0."""
    return ((remaining > 0) & (remaining <= horizon_n)).cast("int")


def label_horizon(df: DataFrame, horizon_n: int = 30, window_l: int = 50) -> DataFrame:
    """Add ``failure_cycle, remaining, label`` and drop the cycles before ``window_l``."""
    require_columns(df, ["engine_id", "cycle"])
    return (
        with_failure_cycle(df)
        .select(*df.columns, "failure_cycle")
        .withColumn("remaining", F.col("failure_cycle") - F.col("cycle"))
        .withColumn("label", fails_within(F.col("remaining"), horizon_n))
        .where(F.col("cycle") >= window_l)
    )
