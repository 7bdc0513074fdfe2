"""Past-only features per engine: rolling statistics, lags and deltas.

All frames are ROWS frames along (engine, cycle), so one exchange and one sort
serve every feature. A statistic is null until its window holds ``w`` values.

Expressions are built as SQL text: a wide fleet has hundreds of them, and one
`selectExpr` takes them all in a single call.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fleethazard.functions.columns import delta_name, lag_name, roll_name, signal_columns
from fleethazard.functions.scalar import nonfinite_to_null
from fleethazard.operators.ordered import drop_halo, with_halo
from fleethazard.params import FeatureSpec

# statistic name -> SQL aggregate
_FRAME_STATS = {"mean": "avg", "std": "stddev_samp", "var": "var_samp", "sum": "sum", "min": "min", "max": "max", "count": "count"}
FRAME_ROWS = 2  # windows of more rows are merged from chunks; shorter frames are cheaper to aggregate as they are


def along(parts: Sequence[str]) -> str:
    """Window order of an engine (or a block of it), without the closing bracket."""
    return f"(PARTITION BY {', '.join(parts)} ORDER BY cycle"


def frame(window: int, order: str) -> str:
    return f"OVER {order} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"


def _check_stat(stat: str) -> None:
    if stat not in _FRAME_STATS and stat != "median":
        raise ValueError(f"Unknown stat {stat!r}; choose one of {sorted([*_FRAME_STATS, 'median'])}")


def rolling_stat(signal: str, window: int, stat: str, order: str) -> str:
    """``stat`` of the values in the last ``window`` rows, however many they are, from a sliding frame."""
    _check_stat(stat)
    over = frame(window, order)
    if stat == "median":
        values = f"array_sort(collect_list({signal}) {over})"  # `window` values at most
        return f"(get({values}, {(window - 1) // 2}) + get({values}, {window // 2})) / 2D"
    return f"CAST({_FRAME_STATS[stat]}({signal}) {over} AS DOUBLE)"


def lag_feature(signal: str, k: int, order: str) -> str:
    return f"lag({signal}, {k}) OVER {order})"


def delta_feature(signal: str, k: int, order: str) -> str:
    return f"{signal} - lag({signal}, {k}) OVER {order})"


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS `{n}`" for n, e in columns.items()])


def _slid(df: DataFrame, signals: Sequence[str], windows: Sequence[int], stats: Sequence[str], order: str) -> tuple[DataFrame, dict[str, str]]:
    """Rolling statistics from sliding frames: work per row grows with the window. One count serves all stats."""
    values = {}
    for s in signals:
        for w in windows:
            values[f"_k_{s}_{w}"] = f"count({s}) {frame(w, order)}"
            values |= {f"_v_{roll_name(s, w, t)}": rolling_stat(s, w, t, order) for t in stats}
    out = {roll_name(s, w, t): f"CASE WHEN _k_{s}_{w} >= {w} THEN _v_{roll_name(s, w, t)} END"
           for s in signals for w in windows for t in stats}
    return _with(df, values), out


def _two_sided(x: np.ndarray, w: int, ufunc: np.ufunc) -> tuple[np.ndarray, np.ndarray]:
    """Running aggregates of ``x`` (a whole number of chunks of ``w``) inside each chunk: from its beginning, and to its end."""
    chunks = x.reshape(-1, w)
    return ufunc.accumulate(chunks, axis=1).ravel(), ufunc.accumulate(chunks[:, ::-1], axis=1)[:, ::-1].ravel()


def _rolled(x: np.ndarray, w: int, stats: Sequence[str]) -> dict[str, np.ndarray]:
    """The statistics of ``x[i - w + 1 .. i]`` for every ``i`` from ``w - 1`` on.

    A frame is the end of one chunk of ``w`` rows and the beginning of the next, or a whole chunk. Nothing is ever taken away from
    an aggregate. Deviations are summed about a value of the frame itself (the chunk's first or last), so a level shift before the
    frame costs no digit."""
    n = len(x)
    at = np.arange(w - 1, n)
    back, whole = at - (w - 1), at % w == w - 1
    x = np.concatenate([x, np.zeros(-n % w)])
    out: dict[str, np.ndarray] = {}
    for t, ufunc in (("min", np.minimum), ("max", np.maximum)):
        if t in stats:
            first, second = _two_sided(x, w, ufunc)
            out[t] = ufunc(first[at], second[back])
    if "sum" in stats:
        begun, ended = _two_sided(x, w, np.add)
        out["sum"] = begun[at] + np.where(whole, 0.0, ended[back])
    if {"mean", "std", "var"} & {*stats}:
        chunks = x.reshape(-1, w)
        count = at % w + 1.0  # rows of the frame in its second chunk
        low, high = np.repeat(chunks[:, 0], w), np.repeat(chunks[:, -1], w)
        a, b = _two_sided(x - low, w, np.add)[0][at] / count, _two_sided(x - high, w, np.add)[1][back]
        rest = np.where(whole, 1.0, w - count)  # rows in the first chunk; 1 avoids a division by 0
        b = b / rest
        step = np.where(whole, 0.0, (high[back] + b) - (low[at] + a))
        out["mean"] = low[at] + a + step * (w - count) / w
        if {"std", "var"} & {*stats}:
            second = _two_sided((x - low) ** 2, w, np.add)[0][at] - count * a * a
            first = np.where(whole, 0.0, _two_sided((x - high) ** 2, w, np.add)[1][back] - rest * b * b)
            spread = np.maximum(first, 0.0) + np.maximum(second, 0.0) + step * step * count * (w - count) / w
            out["var"] = spread / (w - 1) if w > 1 else np.full(len(at), np.nan)
            out["std"] = np.sqrt(out["var"])
    if "count" in stats:
        out["count"] = np.full(len(at), float(w))
    return {t: out[t] for t in stats}


def _merged(df: DataFrame, signals: dict[str, str], windows: Sequence[int], stats: Sequence[str], order: str) -> DataFrame:
    """The rows with their rolling statistics, whose work per row does not depend on the window.

    The rows cross one exchange as they are and are sorted once; each task then takes them batch by batch in that order, led by the
    rows the longest frame reaches back to."""
    rows = _with(df, {"_row": f"row_number() OVER {order})", **{f"_x_{s}": f"CAST({e} AS DOUBLE)" for s, e in signals.items()}})
    names = [roll_name(s, w, t) for s in signals for w in windows for t in stats]
    given = [c for c in rows.columns if c not in ("_row", *[f"_x_{s}" for s in signals], *[f"_s_{s}" for s in signals])]
    schema = StructType([rows.schema[c] for c in given] + [StructField(n, DoubleType()) for n in names])
    reach = max(windows) - 1

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past = {s: np.empty(0) for s in signals}
        for batch in batches:
            nth, n = batch.column("_row").to_numpy(), batch.num_rows
            found = []
            for s in signals:
                x = np.concatenate([past[s], batch.column(f"_x_{s}").to_numpy(zero_copy_only=False)])
                past[s] = x[max(0, len(x) - reach):]
                missing = np.isnan(x)
                holes = np.concatenate([[0], np.cumsum(missing)])
                x = np.where(missing, 0.0, x)
                for w in windows:
                    whole = np.zeros(n, dtype=bool)  # frames of this batch that hold w rows of one engine, none missing
                    new = max(0, w - 1 - (len(x) - n))  # rows of the batch before its first frame
                    ends = np.arange(len(x) - n + new, len(x))
                    whole[new:] = (nth[new:] >= w) & (holes[ends + 1] == holes[ends + 1 - w])
                    # frames that end in this batch need no earlier rows than these
                    got = _rolled(x[max(0, len(x) - n - w + 1):], w, stats) if len(ends) else {}
                    for t in stats:
                        value = np.full(n, np.nan)
                        if len(ends):
                            value[new:] = got[t]
                        found.append(pa.array(value, mask=~whole | (np.isnan(value) if w == 1 else False)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in given], *found], names=[*given, *names])

    return rows.mapInArrow(roll, schema)



def _finite(df: DataFrame, signals: Sequence[str]) -> list[Column]:
    """The signals with NaN and infinities as null: a reading that is no number is missing."""
    kinds = dict(df.dtypes)
    return [nonfinite_to_null(F.col(s)).alias(s) if kinds[s] in ("double", "float") else F.col(s) for s in signals]


def feature_frame(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """All features of every row: key, kept columns, then feature columns in name order.

    Each frame is aggregated from its own rows, so a feature depends on the
    rows of its frames alone: not on level shifts before them, on other
    engines, or on how an engine is cut into blocks.
    """
    signals = signal_columns(df)
    rows, parts = with_halo(df.select("engine_id", "cycle", *keep, *_finite(df, signals)), spec.history())
    order = along(parts)
    for t in spec.stats:
        _check_stat(t)
    merging = [t for t in spec.stats if t != "median"]
    long = [w for w in spec.windows if w > FRAME_ROWS and merging]
    features = {}
    for windows, stats in (([w for w in spec.windows if w not in long], spec.stats), (long, [t for t in spec.stats if t == "median"])):
        if windows and stats:
            rows, found = _slid(rows, signals, windows, stats, order)
            features |= found
    for s in signals:
        features |= {lag_name(s, k): lag_feature(s, k, order) for k in spec.lags}
        features |= {delta_name(s, k): delta_feature(s, k, order) for k in spec.deltas}

    kept = [c for c in ("_halo", "_block") if c in rows.columns]
    named = [f"{features[n]} AS `{n}`" for n in sorted(features)]
    if long:  # after all frames, which share its exchange and order
        rows = rows.selectExpr("engine_id", "cycle", *keep, *kept, *[f"{s} AS `_s_{s}`" for s in signals], *named)
        rows = _merged(rows, {s: f"`_s_{s}`" for s in signals}, long, merging, order)
        names = sorted([*features, *[roll_name(s, w, t) for s in signals for w in long for t in merging]])
        return drop_halo(rows.select("engine_id", "cycle", *keep, *kept, *names))
    return drop_halo(rows.selectExpr("engine_id", "cycle", *keep, *kept, *named))


def filter_min_history(df: DataFrame, spec: FeatureSpec, window_l: int) -> DataFrame:
    """Keep cycles (by value, not by row count) at which a gap-free engine has every feature."""
    return df.where(F.col("cycle") >= spec.first_complete_cycle(window_l))


def build_tabular_features(df: DataFrame, spec: FeatureSpec, window_l: int, filter_after: bool = True,
                           id_col: str = "engine_id", time_col: str = "cycle",
                           keep: Sequence[str] = ()) -> DataFrame:
    """The feature table, from the first cycle on at which a gap-free engine has every feature."""
    renamed = df.withColumnsRenamed({id_col: "engine_id", time_col: "cycle"})
    features = feature_frame(renamed, spec, keep)
    if filter_after:
        features = filter_min_history(features, spec, window_l)
    return features.withColumnsRenamed({"engine_id": id_col, "cycle": time_col})


def last_window_features(df: DataFrame, spec: FeatureSpec, window_l: int) -> DataFrame:
    """Features of the newest row of each key, from its last ``window_l`` rows alone.

    A window longer than the rows at hand is cut short instead of giving null,
    and the deviation of a single row is 0.
    """
    signals = signal_columns(df)
    newest = Window.partitionBy("engine_id").orderBy(F.col("cycle").desc())
    recent = df.select("engine_id", "cycle", *_finite(df, signals)).withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= window_l)
    at = lambda s, back: F.max(F.when(F.col("_back") == back, F.col(s)))
    features: dict[str, Column] = {}
    for s in signals:
        for w in spec.windows:
            x = F.when(F.col("_back") <= w, F.col(s))
            for stat in spec.stats:
                if stat == "std":
                    features[roll_name(s, w, stat)] = F.when(F.count(x) > 1, F.stddev_samp(x)).otherwise(0.0)
                elif stat == "median" or stat in _FRAME_STATS:
                    features[roll_name(s, w, stat)] = getattr(F, _FRAME_STATS.get(stat, stat))(x).cast("double")
                else:
                    raise ValueError(f"Unknown stat {stat!r}; choose one of {sorted([*_FRAME_STATS, 'median'])}")
        features |= {lag_name(s, k): at(s, k + 1) for k in spec.lags}
        features |= {delta_name(s, k): at(s, 1) - at(s, k + 1) for k in spec.deltas}
    return recent.groupBy("engine_id").agg(
        F.max("cycle").alias("cycle"), F.count("*").alias("rows_seen"), *[features[n].alias(n) for n in sorted(features)]
    )
