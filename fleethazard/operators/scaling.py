"""Statistics fitted on the train engines and applied everywhere.

A fitted set is one row per feature, so applying it is plain column arithmetic
with literals: no join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.columns import require_columns
from fleethazard.functions.scalar import nonfinite_to_null
from fleethazard.operators.ordered import running_totals
from fleethazard.session import compiled_methods, written


def _cells(columns: Sequence[str]) -> Column:
    """The columns of a row as one array: hundreds of columns are then one expression, not hundreds."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def count_cells(df: DataFrame, columns: Sequence[str], tests: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """How many rows pass each test in each column: ``test, column, n``. A test takes a value and its column number.

    One count for each test and column, which Spark compiles; an expression over an array of the cells would be interpreted."""
    places = [(t, c) for t in tests for c in columns]
    counts = [F.count_if(tests[t](F.col(c).cast("double"), F.lit(i))) for t in tests for i, c in enumerate(columns)]
    counted = df.agg(*[n.alias(f"n{k}") for k, n in enumerate(counts)])
    rows = F.array(*[F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(f"n{k}").alias("n")) for k, (t, c) in enumerate(places)])
    return counted.select(F.inline(rows))


def fit_scaler(train: DataFrame, feature_columns: Sequence[str]) -> DataFrame:
    """``feature, mean, std`` over the train rows: population deviation; a constant feature gets deviation 1.

    Constancy is read from the extremes: merged partial deviations of a
    constant may be a rounding error above 0. A missing value makes its
    feature's statistics NaN.
    """
    if not feature_columns:
        raise ValueError("a scaler needs at least one feature")
    require_columns(train, feature_columns)
    if train.isEmpty():
        raise ValueError("the train engines have no rows")
    known = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in feature_columns])  # compiled, unlike a lambda
    summary = train.select(array_to_vector(known).alias("_v")).agg(
        Summarizer.metrics("count", "mean", "variance", "min", "max").summary(F.col("_v")).alias("s"))
    columns = [F.array(*[F.lit(c) for c in feature_columns]).alias("feature")]
    columns += [vector_to_array(F.col(f"s.{m}")).alias(m) for m in ("mean", "variance", "min", "max")]
    long = summary.select(F.col("s.count").alias("n"), F.inline(F.arrays_zip(*columns)))
    population = F.sqrt(F.col("variance") * (F.col("n") - 1) / F.col("n"))
    constant = (F.col("min") == F.col("max")) | (F.col("variance") == 0.0)
    return long.select("feature", "mean", F.when(constant, 1.0).otherwise(population).alias("std"))


def scaler_params(fitted: DataFrame) -> dict:
    """The fitted scaler as plain values (one row per feature)."""
    with compiled_methods(fitted.sparkSession):
        rows = fitted.orderBy("feature").collect()
    return {
        "feature_columns": [r["feature"] for r in rows],
        "mean": [r["mean"] for r in rows],
        "std": [r["std"] for r in rows],
    }


def standardize(df: DataFrame, params: dict) -> DataFrame:
    """(x - mean) / std for every feature of ``params``."""
    if any(k not in params for k in ("feature_columns", "mean", "std")):
        raise ValueError("a scaler is described by feature_columns, mean and std")
    names, mean, std = params["feature_columns"], params["mean"], params["std"]
    if not len(names) == len(mean) == len(std):
        raise ValueError("feature_columns, mean and std differ in length")
    require_columns(df, names)
    return df.withColumns({
        c: (F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(names, mean, std)
    })


def _around_middle(train: DataFrame, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """``place`` (of the feature), ``value, n`` of the finite values from ``low`` to ``high``, collapsed batch by batch; and without a value
    ``n``, how many values there are, and ``below``, how many lie below ``low``. Written once."""

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c[np.isfinite(c)] for c in (batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns))]
            kept = [np.unique(c[(c >= low[i]) & (c <= high[i])], return_counts=True) for i, c in enumerate(columns)]
            places = np.arange(len(columns))
            n = [len(c) for c in columns]
            below = [int((c < low[i]).sum()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([places, np.repeat(places, [len(v) for v, _ in kept])]).astype(np.int32)),
                pa.array(np.concatenate([np.full(len(n), np.nan), *[v for v, _ in kept]]), from_pandas=True),
                pa.array(np.concatenate([n, *[k for _, k in kept]]).astype(np.int64)),
                pa.array(np.concatenate([below, np.zeros(sum(len(v) for v, _ in kept))]).astype(np.int64)),
            ], names=["place", "value", "n", "below"])

    return written(train.mapInArrow(narrow, "place int, value double, n long, below long"), "middle")


def fit_median_imputer(train: DataFrame, feature_columns: Sequence[str]) -> DataFrame:
    """``feature, median``: exact medians of the finite values, for any number of rows.

    A sketch brackets every median; only values inside the brackets (about 1% of each column, ties collapsed) are ordered exactly. A
    bracket that turns out not to hold the middle of its column is opened to all of it.
    """
    train = train.select(*[F.col(c).cast("double").alias(c) for c in feature_columns])
    around = lambda c: F.when(F.count(c) > 0, F.kll_sketch_get_quantile_double(
        F.kll_sketch_agg_double(c, 2000), F.array(F.lit(0.495), F.lit(0.505))))
    with compiled_methods(train.sparkSession):
        sketched = train.select(*[nonfinite_to_null(F.col(c)).alias(c) for c in feature_columns]).agg(*[around(c).alias(f"c{i}") for i, c in enumerate(feature_columns)]).first()
    empty = [c for c, ends in zip(feature_columns, sketched) if ends is None]
    if empty:
        raise ValueError(f"no finite train value to take a median of: {empty[:20]}")
    low, high = (np.array([ends[end] for ends in sketched], dtype=float) for end in (0, 1))
    while True:
        found = _around_middle(train, low, high)
        counts = {r["place"]: r for r in found.groupBy("place").agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("n"), F.sum("below").alias("below"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("inside")).collect()}  # a row per feature
        missed = [i for i, r in counts.items() if (r["n"] - 1) // 2 < r["below"] or r["n"] // 2 >= r["below"] + r["inside"]]
        if not missed:
            break
        low[missed], high[missed] = -np.inf, np.inf

    inside = found.where(F.col("value").isNotNull()).groupBy("place", "value").agg(F.sum("n").alias("_n"))
    ranked = running_totals(inside, [F.col("value")], {"_upto": "_n"}, ["place"], by="value")
    numbers = F.create_map(*[x for i, c in enumerate(feature_columns) for x in (
        F.lit(i), F.struct(F.lit(c).alias("feature"), F.lit(counts[i]["n"]).alias("n"), F.lit(counts[i]["below"]).alias("below")))])
    at = numbers[F.col("place")]
    first, upto = at["below"] + F.col("_upto") - F.col("_n"), at["below"] + F.col("_upto")
    holds = lambda place: (place >= first) & (place < upto)
    lower, upper = F.floor((at["n"] - 1) / 2), F.floor(at["n"] / 2)
    return ranked.groupBy(at["feature"].alias("feature")).agg(
        ((F.max(F.when(holds(lower), F.col("value"))) + F.max(F.when(holds(upper), F.col("value")))) / 2.0).alias("median")
    )


def median_params(fitted: DataFrame) -> dict[str, float]:
    return {r["feature"]: r["median"] for r in fitted.collect()}


def impute_median(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Replace missing and non-finite values by the train median."""
    return df.withColumns({
        c: F.coalesce(nonfinite_to_null(F.col(c)), F.lit(float(m))) for c, m in medians.items()
    })


def nonfinite_counts(df: DataFrame, feature_columns: Sequence[str], by: Sequence[str] = ("split",)) -> DataFrame:
    """Missing and infinite values per split, over all features."""
    cells = _cells(feature_columns)
    missing = F.size(F.filter(cells, lambda v: v.isNull() | F.isnan(v)))
    infinite = F.size(F.filter(cells, lambda v: F.abs(v) == float("inf")))
    return df.groupBy(*by).agg(F.sum(missing).cast("long").alias("n_nan"), F.sum(infinite).cast("long").alias("n_inf"))


def all_finite(df: DataFrame, feature_columns: Sequence[str]) -> bool:
    """Whether no value is missing or infinite. Batches of columns tell faster than an expression over all columns of a row."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not all(np.isfinite(batch.column(i).to_numpy(zero_copy_only=False)).all() for i in range(batch.num_columns)):
                yield pa.RecordBatch.from_arrays([pa.array([True])], names=["bad"])

    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(feature_columns)])
    return values.mapInArrow(look, "bad boolean").agg(F.count("*")).first()[0] == 0


def check_finite(df: DataFrame, feature_columns: Sequence[str], what: str = "features") -> None:
    if not all_finite(df, feature_columns):
        raise ValueError(f"{what}: some values are missing or infinite")
