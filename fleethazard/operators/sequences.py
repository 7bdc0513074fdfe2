"""Fixed-length sliding windows over engine histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.functions.columns import require_columns, sequence_feature_columns
from fleethazard.functions.scalar import is_finite
from fleethazard.operators.ordered import drop_halo, lookup_join, with_halo, with_position
from fleethazard.operators.scaling import check_finite, fit_scaler, scaler_params, standardize

CHUNK_ROWS = 4096


def _check_length(window_length: int) -> None:
    if window_length < 1:
        raise ValueError("a window has at least one row")


def engine_position(df: DataFrame) -> DataFrame:
    """Add ``end_pos``, the 0-based row position along the engine."""
    return with_position(df, "end_pos")


def engine_arrays(df: DataFrame, feature_columns: Sequence[str], label_col: str = "label",
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Cycle-ordered arrays per engine: ``cycles, x`` (float rows), ``y`` and ``remaining`` if present.

    A history longer than ``chunk_rows`` comes as several rows, in order of
    ``start_pos``: an array cell is always bounded.
    """
    require_columns(df, ["engine_id", "cycle", label_col, *feature_columns])
    extra = ["remaining"] if "remaining" in df.columns else []
    step = F.struct(
        F.col("cycle"),
        F.array(*[F.col(c).cast("float") for c in feature_columns]).alias("x"),
        F.col(label_col).cast("long").alias("y"),
        *[F.col(c).cast("float").alias(c) for c in extra],
    )
    chunk = F.floor(F.col("end_pos") / chunk_rows)
    steps = (
        with_position(df.select("engine_id", "cycle", label_col, *extra, *feature_columns))
        .groupBy("engine_id", chunk.alias("_chunk"))
        .agg(F.array_sort(F.collect_list(step)).alias("s"))
    )
    return steps.select(
        "engine_id", (F.col("_chunk") * chunk_rows).cast("long").alias("start_pos"),
        F.col("s.cycle").alias("cycles"), F.col("s.x").alias("x"), F.col("s.y").alias("y"),
        *[F.col(f"s.{c}").alias(c) for c in extra],
    )


def sequence_index(df: DataFrame, window_length: int) -> DataFrame:
    """``engine_id, pred_cycle, end_pos`` of every row that ends a full window."""
    _check_length(window_length)
    return (
        with_position(df.select("engine_id", "cycle"))
        .where(F.col("end_pos") >= window_length - 1)
        .select("engine_id", F.col("cycle").alias("pred_cycle"), "end_pos")
    )


def filter_index_by_engine_ids(index: DataFrame, engines: DataFrame) -> DataFrame:
    return lookup_join(index, engines.select("engine_id"), ["engine_id"], "left_semi")


def sequence_windows(df: DataFrame, feature_columns: Sequence[str], window_length: int,
                     label_col: str | None = "label", keep: Sequence[str] = ()) -> DataFrame:
    """``engine_id, pred_cycle, window`` (L rows of F floats) and the label at the window's last row."""
    _check_length(window_length)
    kept = [*([label_col] if label_col else []), *keep]
    rows, parts = with_halo(
        df.select("engine_id", "cycle", *kept, F.array(*[F.col(c).cast("float") for c in feature_columns]).alias("_x")),
        window_length - 1)
    frame = Window.partitionBy(*parts).orderBy("cycle").rowsBetween(-(window_length - 1), 0)
    return (
        drop_halo(rows.withColumn("window", F.collect_list("_x").over(frame)))
        .where(F.size("window") == window_length)
        .select("engine_id", F.col("cycle").alias("pred_cycle"), *kept, "window")
    )


def extract_window(df: DataFrame, feature_columns: Sequence[str], engine_id: int, end_pos: int,
                   window_length: int) -> DataFrame:
    """The rows of one window, by engine and end position."""
    _check_length(window_length)
    engine = df.where(F.col("engine_id") == engine_id)
    n = engine.count()
    if n == 0:
        raise KeyError(f"no rows of engine {engine_id}")
    if not 0 <= end_pos < n:
        raise ValueError(f"end_pos {end_pos} is out of range for {n} rows")
    if end_pos < window_length - 1:
        raise ValueError(f"the first window ends at window_length - 1, not at {end_pos}")
    return (
        with_position(engine.select("engine_id", "cycle", *feature_columns), "pos")
        .where(F.col("pos").between(end_pos - window_length + 1, end_pos))
        .select("engine_id", "cycle", *[F.col(c).cast("float").alias(c) for c in feature_columns])
    )


def validate_index(index: DataFrame, df: DataFrame, window_length: int) -> DataFrame:
    """The faulty entries of a sequence index, with the reason."""
    _check_length(window_length)
    lengths = df.groupBy("engine_id").agg(F.count("*").alias("_t"))
    joined = lookup_join(index, lengths, ["engine_id"], "left")
    reason = (
        F.when(F.col("_t").isNull(), "engine not found")
        .when((F.col("end_pos") < 0) | (F.col("end_pos") >= F.col("_t")), "end_pos out of range")
        .when(F.col("end_pos") < window_length - 1, "end_pos < window_length - 1")
    )
    return joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_t")


def require_valid_index(index: DataFrame, df: DataFrame, window_length: int) -> None:
    bad = validate_index(index, df, window_length).first()
    if bad is not None:
        raise ValueError(f"{bad['reason']}: engine {bad['engine_id']}, end_pos {bad['end_pos']}")


def validate_sequences(windows: DataFrame, window_length: int, n_features: int) -> DataFrame:
    """One row of counts: windows, windows of the wrong shape, windows with a non-finite value."""
    finite = F.forall("window", lambda row: F.forall(row, lambda v: F.coalesce(is_finite(v), F.lit(False))))
    shape = (F.size("window") == window_length) & F.forall("window", lambda row: F.size(row) == n_features)
    return windows.agg(
        F.count("*").alias("n_windows"), F.count_if(~shape).alias("bad_shape"), F.count_if(~finite).alias("non_finite"))


def build_sequence_pipeline(df: DataFrame, train: DataFrame, window_length: int, label_col: str = "label",
                            keep: Sequence[str] = ()) -> dict:
    """Scale on the train engines, check, and cut windows.

    Returns ``feature_columns, scaler_params, scaled, index, windows``.
    """
    feature_columns = sequence_feature_columns(df)
    if not feature_columns:
        raise ValueError("table has no signal columns")
    params = scaler_params(fit_scaler(lookup_join(df, train.select("engine_id"), ["engine_id"], "left_semi"),
                                      feature_columns))
    scaled = standardize(df, params)
    check_finite(scaled, feature_columns, "scaled sequences")
    index = sequence_index(scaled, window_length)
    if index.isEmpty():
        raise ValueError("no engine is long enough for a window")
    return {
        "feature_columns": feature_columns,
        "scaler_params": params,
        "scaled": scaled,
        "index": index,
        "windows": sequence_windows(scaled, feature_columns, window_length, label_col, keep),
    }
