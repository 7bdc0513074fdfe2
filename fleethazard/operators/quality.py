"""Checks on tables. `check_*` return counts or violations; `require_*` raise."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.functions.columns import require_columns
from fleethazard.operators.scaling import all_finite, count_cells


def check_expected_columns(df: DataFrame, expected: Sequence[str]) -> None:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"columns not found: {missing}")
    extra = sorted(set(df.columns) - set(expected))
    if extra:
        raise ValueError(f"columns not expected: {extra}")


def check_no_duplicates(df: DataFrame, keys: Sequence[str] = ("engine_id", "cycle")) -> DataFrame:
    """``duplicate_rows``: all rows that share their key with another row."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"))
    )


def require_no_duplicates(df: DataFrame, keys: Sequence[str] = ("engine_id", "cycle")) -> None:
    n = check_no_duplicates(df, keys).first()["duplicate_rows"]
    if n:
        raise ValueError(f"{n} rows share their key {list(keys)} with a duplicate")


LEAF_SHIFT, BRANCH_SHIFT = 16, 10  # ordinals of a block of rows; blocks of a group, at every level above


def _level(rows: DataFrame, up: Column, place: Column, fault: Callable[[Column, Column], Column], keys: Sequence[str] = ()) -> DataFrame:
    """Rows (``keys, at, first, last, bad``) under the group ``up`` they belong to: one row per group, with the faults between
    neighbours along ``place``, from the last of one row to the first of the next."""
    rows = rows.withColumn("_up", up)
    before = F.lag("last").over(Window.partitionBy(*keys, "_up").orderBy(place))
    marked = rows.withColumn("_step", F.coalesce(fault(F.col("first"), before), F.lit(False)))
    return marked.groupBy(*keys, "_up").agg(F.min_by("first", place).alias("first"), F.max_by("last", place).alias("last"),
                                            (F.sum("bad") + F.count_if("_step")).alias("bad")).withColumnRenamed("_up", "at")


def check_monotonic_cycle(df: DataFrame, ordinal: str) -> DataFrame:
    """``engine_id, violations``: rows whose cycle does not exceed the engine's previous one in ingest order.

    An engine's rows are compared in blocks of ordinals, as in `check_sorted_by_key`: no table of blocks is joined or broadcast,
    however far an engine's ordinals lie apart. Rows of an engine that share an ordinal are taken in order of their cycle."""
    rows = df.select("engine_id", F.col(ordinal).cast("long").alias("at"), F.col("cycle").alias("first"), F.col("cycle").alias("last"),
                     F.lit(0).cast("long").alias("bad"))
    place, back = F.struct("at", "first"), lambda first, before: first <= before
    rows = _level(rows, F.shiftright("at", LEAF_SHIFT), place, back, ["engine_id"])
    for _ in range(-(-(64 - LEAF_SHIFT) // BRANCH_SHIFT)):
        rows = _level(rows, F.shiftright("at", BRANCH_SHIFT), place, back, ["engine_id"])
    # the ordinals below 0, those from 0 on, and rows without one, which come first
    rows = _level(rows, F.lit(0).cast("long"), place, back, ["engine_id"])
    return rows.where(F.col("bad") > 0).select("engine_id", F.col("bad").alias("violations"))


def require_monotonic_cycle(df: DataFrame, ordinal: str) -> None:
    bad = check_monotonic_cycle(df, ordinal).first()
    if bad is not None:
        raise ValueError(f"cycles of engine {bad['engine_id']} are not monotonic in ingest order")


def check_sorted_by_key(df: DataFrame, ordinal: str) -> DataFrame:
    """``violations``: rows whose (engine_id, cycle) is below that of the row before them in ingest order.

    Blocks of 2^16 ordinals are ordered each by itself and leave their first and last key; neighbouring blocks are compared by those,
    level by level, 2^10 at a time. No task orders more than that, however long the table. Ordinals must be unique."""
    key = F.struct("engine_id", "cycle")
    rows = df.select(F.col(ordinal).cast("long").alias("at"), key.alias("first"), key.alias("last"), F.lit(0).cast("long").alias("bad"))
    down = lambda first, before: first < before
    rows = _level(rows, F.shiftright("at", LEAF_SHIFT), F.col("at"), down)
    for _ in range(-(-(64 - LEAF_SHIFT) // BRANCH_SHIFT)):
        rows = _level(rows, F.shiftright("at", BRANCH_SHIFT), F.col("at"), down)
    # what is left is at most one group of ordinals from 0 on and one below; the latter comes first
    ends = rows.agg(F.sum("bad").alias("bad"), F.max(F.when(F.col("at") < 0, F.col("last"))).alias("below"), F.max(F.when(F.col("at") >= 0, F.col("first"))).alias("above"))
    return ends.select(F.coalesce(F.col("bad") + F.when(F.col("above") < F.col("below"), 1).otherwise(0), F.lit(0)).alias("violations"))


def require_sorted_by_key(df: DataFrame, ordinal: str) -> None:
    if check_sorted_by_key(df, ordinal).first()["violations"]:
        raise ValueError("rows do not arrive in key order")


def validate_tabular_features(df: DataFrame, window_l: int, id_col: str = "engine_id",
                              time_col: str = "cycle", ordinal: str | None = None) -> DataFrame:
    """``check, column, violations`` of a feature table, one row per check and column; 0 means passed.

    Checks: key uniqueness, infinite values anywhere, missing values at or
    after ``window_l``. Row order is no property of a DataFrame: it is checked
    if a column ``ordinal`` tells it.
    """
    require_columns(df, [id_col, time_col])
    features = [c for c in df.columns if c not in (id_col, time_col, ordinal)]
    if not features:
        raise ValueError("the table holds no features")
    late = F.col(time_col) >= window_l
    per_column = count_cells(df, features, {
        "non_finite": lambda v, i: F.abs(v) == float("inf"),
        "missing": lambda v, i: (v.isNull() | F.isnan(v)) & late,
    }).withColumnsRenamed({"test": "check", "n": "violations"})
    duplicates = check_no_duplicates(df, [id_col, time_col]).select(
        F.lit("duplicate_key").alias("check"), F.lit(f"{id_col},{time_col}").alias("column"),
        F.col("duplicate_rows").alias("violations"))
    found = per_column.unionByName(duplicates)
    if ordinal is not None:
        keyed = df.withColumnsRenamed({id_col: "engine_id", time_col: "cycle"})
        found = found.unionByName(check_sorted_by_key(keyed, ordinal).select(
            F.lit("row_order").alias("check"), F.lit(ordinal).alias("column"), F.col("violations").cast("long").alias("violations")))
    return found


def require_valid_features(df: DataFrame, window_l: int) -> None:
    """Raise unless the table passes every check.

    Two counts for each of many columns are more than Spark compiles as one, so one look tells first whether all values are finite;
    their columns are then counted no further."""
    features = [c for c in df.columns if c not in ("engine_id", "cycle")]
    if features and all_finite(df, features):
        df = df.select("engine_id", "cycle", features[0])
    bad = validate_tabular_features(df, window_l).where(F.col("violations") > 0).first()
    if bad is not None:
        raise ValueError(f"Feature table check failed: {bad['check']} on {bad['column']} ({bad['violations']} rows)")
