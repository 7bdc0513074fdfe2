"""Summary tables of a fleet."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.scalar import is_finite
from fleethazard.operators.labeling import with_failure_cycle
from fleethazard.operators.ordered import exact_quantiles, lookup_join

LOW_VARIANCE = 0.01


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of one column, as one row."""
    basics = df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"), F.lit(1).alias("_k"))
    quartiles = exact_quantiles(df, value, [0.25, 0.5, 0.75]).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))],
        F.lit(1).alias("_k"))
    return basics.join(F.broadcast(quartiles), "_k").drop("_k")  # one row each


def engine_lifetime(df: DataFrame) -> DataFrame:
    """Last cycle per engine."""
    return df.groupBy("engine_id").agg(F.max("cycle").alias("lifetime"))


def missingness(df: DataFrame, top: int = 10) -> DataFrame:
    """Share of missing values per column, highest first."""
    is_missing = {f.name: F.col(f.name).isNull() | F.isnan(f.name) if f.dataType.typeName() in ("double", "float")
                  else F.col(f.name).isNull() for f in df.schema.fields}
    shares = df.agg(*[F.avg(c.cast("double")).alias(n) for n, c in is_missing.items()], F.lit(1).alias("_k"))
    long = shares.unpivot(["_k"], df.columns, "column", "missing_share").drop("_k")
    return long.orderBy(F.col("missing_share").desc(), "column").limit(top)


def label_distribution(labeled: DataFrame) -> DataFrame:
    """n, positives, negatives, positive rate, negatives per positive."""
    positives = F.sum(F.col("label").cast("long"))
    negatives = F.count("*") - positives
    return labeled.agg(
        F.count("*").alias("n"), positives.alias("positives"), negatives.alias("negatives"),
        F.avg(F.col("label").cast("double")).alias("positive_rate"),
        F.try_divide(negatives.cast("double"), positives.cast("double")).alias("imbalance"))


def positives_per_engine(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("engine_id").agg(F.sum(F.col("label").cast("long")).alias("positives"))


def remaining_range(labeled: DataFrame, full: DataFrame) -> DataFrame:
    """Smallest and largest remaining life; rows kept of all rows."""
    kept = labeled.agg(F.min("remaining").alias("min_remaining"), F.max("remaining").alias("max_remaining"),
                       F.count("*").alias("rows_kept"), F.lit(1).alias("_k"))
    return kept.join(F.broadcast(full.agg(F.count("*").alias("rows_all"), F.lit(1).alias("_k"))), "_k").drop("_k")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bin, low, high, count`` of the non-empty equal-width bins; the last bin is closed."""
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin long, low double, high double, count long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = high - low
    bin_of = F.least(F.floor((F.col(value) - F.lit(low)) * bins / F.lit(width)), F.lit(bins - 1)).cast("long")
    return (
        df.where(F.col(value).isNotNull()).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("count"))
        .select("bin", (F.lit(low) + F.col("bin") * F.lit(width) / bins).alias("low"),
                (F.lit(low) + (F.col("bin") + 1) * F.lit(width) / bins).alias("high"), "count")
    )


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, n, x, y, xx, yy, xy, x_low, x_high, y_low, y_high`` of every pair of columns (i < j): moments over the rows that hold both
    values, taken around the columns' means. NaN and infinities count as missing.

    Each task keeps one matrix per moment and adds its batches to it as matrix products, with masks for missing values; what is
    shuffled is one row per task and pair. The means come from a pass of their own, so that the sums don't cancel."""
    d = len(columns)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    means = [m or 0.0 for m in rows.agg(*[F.avg(F.when(is_finite(F.col(f"c{k}")), F.col(f"c{k}"))) for k in range(d)]).first()]
    left, right = np.triu_indices(d, 1)
    names = ["n", "x", "y", "xx", "yy", "xy", "x_low", "x_high", "y_low", "y_high"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros((d, d)) for m in ("n", "x", "xx", "xy")}
        low, high = np.full((d, d), np.inf), np.full((d, d), -np.inf)
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            there = np.isfinite(raw)
            held = there.astype(float)
            v = np.where(there, raw - means, 0.0)
            total["n"] += held.T @ held
            total["x"] += v.T @ held
            total["xx"] += (v * v).T @ held
            total["xy"] += v.T @ v
            for k in range(d):  # extremes of each column over the rows that hold column k
                both = there & there[:, [k]]
                low[:, k] = np.minimum(low[:, k], np.where(both, v, np.inf).min(axis=0, initial=np.inf))
                high[:, k] = np.maximum(high[:, k], np.where(both, v, -np.inf).max(axis=0, initial=-np.inf))
        at, back = (left, right), (right, left)
        columns_of = [total["n"][at], total["x"][at], total["x"][back], total["xx"][at], total["xx"][back], total["xy"][at],
                      low[at], high[at], low[back], high[back]]
        yield pa.RecordBatch.from_arrays([pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), *[pa.array(c) for c in columns_of]], ["i", "j", *names])

    parts = rows.mapInArrow(partial, "i int, j int, " + ", ".join(f"{n} double" for n in names))
    how = {n: F.min if n.endswith("low") else F.max if n.endswith("high") else F.sum for n in names}
    return parts.groupBy("i", "j").agg(*[how[n](n).alias(n) for n in names])


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every pair (i < j) in long form, over the rows that hold both values; null for constant columns."""
    c = F.col
    varies = (c("x_low") < c("x_high")) & (c("y_low") < c("y_high"))
    r = F.try_divide(c("xy") - c("x") * c("y") / c("n"), F.sqrt((c("xx") - c("x") * c("x") / c("n")) * (c("yy") - c("y") * c("y") / c("n"))))
    named = F.array(*[F.lit(n) for n in columns])
    return comoments(df, columns).select(F.get(named, c("i")).alias("a"), F.get(named, c("j")).alias("b"), F.when(varies, r).alias("r"))


def high_corr_pairs(df: DataFrame, columns: Sequence[str], above: float = 0.9) -> DataFrame:
    return correlation(df, columns).where(F.abs("r") > above).withColumn("r", F.round("r", 3))


def sensor_variability(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample deviation per sensor, lowest first, and whether it is nearly constant."""
    wide = df.agg(*[F.stddev_samp(c).alias(c) for c in columns], F.lit(1).alias("_k"))
    long = wide.unpivot(["_k"], list(columns), "sensor", "std").drop("_k")
    return long.withColumn("low_variance", F.col("std") < LOW_VARIANCE).orderBy("std", "sensor")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, engines and distinct values per column."""
    names = {"engine_id": "n_engines", **{c: f"n_{c}" for c in columns}}
    counts = [df.select(F.col(c)).distinct().agg(F.count(c).alias(n)) for c, n in names.items()]  # one row each
    return reduce(DataFrame.crossJoin, counts, df.agg(F.count("*").alias("n_rows")))


def degradation_profile(df: DataFrame, sensors: Sequence[str], last_n: int = 50) -> DataFrame:
    """Mean and deviation of each sensor by cycles to failure, over the last ``last_n`` cycles of every engine."""
    aligned = with_failure_cycle(df.select("engine_id", "cycle", *sensors)).withColumn(
        "cycles_to_failure", F.col("failure_cycle") - F.col("cycle")).where(F.col("cycles_to_failure") < last_n)
    return aligned.groupBy("cycles_to_failure").agg(
        *[f(s).alias(f"{s}_{n}") for s in sensors for n, f in (("mean", F.avg), ("std", F.stddev_samp))])


def sample_series(df: DataFrame, sensors: Sequence[str], engines: int = 3) -> DataFrame:
    """Series of the first engines, with their lifetime."""
    first = df.groupBy("engine_id").agg(F.max("cycle").alias("lifetime")).orderBy("engine_id").limit(engines)
    return lookup_join(df.select("engine_id", "cycle", *sensors), first, ["engine_id"])
