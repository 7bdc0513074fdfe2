import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleethazard.operators import features as feature_module
from fleethazard.operators.features import build_tabular_features, feature_frame, last_window_features
from fleethazard.operators.labeling import label_horizon
from fleethazard.params import FeatureSpec
from fleethazard.sources.fleets import events_fleet, lineitem_fleet, number_cycles

SMALL = FeatureSpec(windows=(3,), stats=("mean",), lags=(1,), deltas=(1,))
SF = "/root/testdata/sf0.001"


def test_label_edges(spark):
    n, window = 30, 50
    rows = [(1, c) for c in (window - 1, window, window + 1, window + n + 1)] + [(2, c) for c in (window, window + 1, window + n)]
    out = {(r.engine_id, r.cycle): r for r in label_horizon(spark.createDataFrame(rows, "engine_id long, cycle long"), n, window).collect()}
    assert len(out) == 6 and min(c for _, c in out) == window
    assert out[(1, window + n + 1)].failure_cycle == window + n + 1 and out[(1, window + n + 1)].label == 0
    assert out[(2, window)].remaining == n and out[(2, window)].label == 1
    assert out[(1, window)].remaining == n + 1 and out[(1, window)].label == 0


def test_label_needs_keys(spark):
    with pytest.raises(ValueError, match="lacks the columns"):
        label_horizon(spark.createDataFrame([(1,)], "engine_id long"))


def test_hand_computed_features(fleet):
    df = fleet({1: [10, 20, 30, 40, 50, 60]})
    row = build_tabular_features(df, SMALL, 1, filter_after=False).where("cycle = 4").first()
    assert (row["sensor_1__roll3__mean"], row["sensor_1__lag1"], row["sensor_1__delta1"]) == (30.0, 30.0, 10.0)


def test_future_values_change_nothing(fleet):
    a = build_tabular_features(fleet({1: [10, 20, 30, 40, 50, 60]}), SMALL, 1).where("cycle = 5").first()
    b = build_tabular_features(fleet({1: [10, 20, 30, 40, 50, 9999]}), SMALL, 1).where("cycle = 5").first()
    assert a == b


def test_no_signal_columns(spark):
    with pytest.raises(ValueError, match="no numeric column"):
        feature_frame(spark.createDataFrame([(1, 1, 2.0)], "engine_id long, cycle long, other double"), SMALL)


def test_min_history_counts_cycles_not_rows(fleet):
    df = fleet({1: range(20)}, start=101)
    assert build_tabular_features(df, FeatureSpec(), 50).count() == 20  # cycles are past 50, rows are few
    assert FeatureSpec(windows=(), lags=(), deltas=()).first_complete_cycle(7) == 7


def _pandas_features(pdf, spec):
    pdf = pdf.sort_values(["engine_id", "cycle"]).reset_index(drop=True)
    out = pdf[["engine_id", "cycle"]].copy()
    x = pdf.groupby("engine_id")["sensor_1"]
    for w in spec.windows:
        for stat in spec.stats:
            out[f"sensor_1__roll{w}__{stat}"] = x.rolling(w, min_periods=w).agg(stat).reset_index(level=0, drop=True)
    for k in spec.lags:
        out[f"sensor_1__lag{k}"] = x.shift(k)
    for k in spec.deltas:
        out[f"sensor_1__delta{k}"] = x.diff(k)
    return out


def test_features_equal_pandas_with_nulls_and_gaps(spark, monkeypatch):
    """Small blocks force the halo path; one engine holds a third of the rows."""
    rng = np.random.default_rng(3)
    frames = []
    for engine, n in [(1, 300), *[(e, 60) for e in range(2, 12)]]:
        values = 1e3 + np.cumsum(rng.normal(size=n))
        values[rng.random(n) < 0.1] = np.nan
        frames.append(pd.DataFrame({"engine_id": engine, "cycle": np.cumsum(rng.choice([1, 2, 40], n)), "sensor_1": values}))
    pdf = pd.concat(frames)
    original = feature_module.with_halo
    monkeypatch.setattr(feature_module, "with_halo", lambda df, rows, **k: original(df, rows, shift=6))
    spec = FeatureSpec(windows=(1, 3, 10), stats=("mean", "std"), lags=(1, 5), deltas=(1, 4))
    clean = spark.createDataFrame(pdf).withColumn("sensor_1", F.when(~F.isnan("sensor_1"), F.col("sensor_1")))
    got = feature_frame(clean, spec).toPandas().sort_values(["engine_id", "cycle"]).reset_index(drop=True)
    want = _pandas_features(pdf, spec)[got.columns]
    pd.testing.assert_frame_equal(got, want, rtol=1e-9, atol=1e-9, check_dtype=False)


def test_every_statistic_equals_pandas(spark):
    pdf = pd.DataFrame({"engine_id": 1, "cycle": range(1, 41), "sensor_1": np.random.default_rng(5).normal(size=40)})
    spec = FeatureSpec(windows=(4, 7), stats=("mean", "std", "var", "sum", "min", "max", "median"), lags=(), deltas=())
    got = feature_frame(spark.createDataFrame(pdf), spec).toPandas().sort_values("cycle").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, _pandas_features(pdf, spec)[got.columns], rtol=1e-9, atol=1e-12)


def test_unknown_statistic(fleet):
    with pytest.raises(ValueError, match="Unknown stat"):
        feature_frame(fleet({1: [1, 2]}), FeatureSpec(stats=("mode",)))


def test_a_constant_has_no_deviation_and_a_step_leaves_no_trace(fleet):
    noise = [(i * 37 % 11) / 11 for i in range(100)]
    df = fleet({1: [100.1] * 60, 2: [x + (1e8 if i >= 50 else 0) for i, x in enumerate(noise)]})
    spec = FeatureSpec(windows=(10,), lags=(), deltas=())
    got = feature_frame(df, spec).toPandas().set_index(["engine_id", "cycle"])["sensor_1__roll10__std"].sort_index()
    assert (got.loc[1].dropna() == 0.0).all()
    np.testing.assert_allclose(got.loc[(2, 100)], np.std(noise[90:], ddof=1), rtol=1e-6)


def test_nonfinite_readings_are_missing_and_forgotten(fleet):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, float("nan"), 7.0, 8.0, 9.0, float("inf"), 11.0, 12.0, 13.0]
    null = [v if np.isfinite(v) else None for v in values]
    spec = FeatureSpec(windows=(3,), stats=("mean", "std", "median"), lags=(1,), deltas=(1,))
    a, b = (feature_frame(fleet({1: v}), spec).orderBy("cycle").collect() for v in (values, null))
    assert a == b and a[8]["sensor_1__roll3__mean"] == 8.0 and a[6]["sensor_1__roll3__mean"] is None
    assert last_window_features(fleet({1: values}), spec, 5).collect() == last_window_features(fleet({1: null}), spec, 5).collect()


def test_another_long_engine_changes_nothing(fleet):
    spec = FeatureSpec(windows=(10,))
    short = {1: [1e6 + (i * 7 % 13) * 0.1 for i in range(60)]}
    alone = feature_frame(fleet(short), spec).orderBy("cycle").collect()
    beside = feature_frame(fleet({**short, 2: range(1500)}), spec).where("engine_id = 1").orderBy("cycle").collect()
    assert alone == beside


def test_last_window_equals_batch_when_the_window_is_full(fleet):
    df = fleet({1: range(60), 2: [i * i % 17 for i in range(55)]})
    spec = FeatureSpec()
    batch = feature_frame(df, spec).where("(engine_id = 1 AND cycle = 60) OR (engine_id = 2 AND cycle = 55)").toPandas()
    last = last_window_features(df, spec, 50).drop("rows_seen").toPandas()
    pd.testing.assert_frame_equal(last.sort_values("engine_id").reset_index(drop=True)[batch.columns.tolist()],
                                  batch.sort_values("engine_id").reset_index(drop=True), rtol=1e-9)


def test_a_single_row_has_deviation_zero(fleet):
    row = last_window_features(fleet({1: [5]}), FeatureSpec(windows=(3,), lags=(), deltas=()), 10).first()
    assert row["sensor_1__roll3__std"] == 0.0 and row["sensor_1__roll3__mean"] == 5.0


@pytest.mark.parametrize("make", [lineitem_fleet, events_fleet])
def test_hot_engines_are_numbered_alike(spark, make):
    plain, blocked = make(spark, SF), make(spark, SF, hot_rows=30)
    assert plain.exceptAll(blocked).isEmpty() and plain.count() == blocked.count()


def test_numbering_mixes_hot_and_cold_engines(spark):
    rows = [(0, i) for i in range(1000)] + [(e, i) for e in range(1, 50) for i in range(10)]
    df = spark.createDataFrame(rows, "engine_id long, t long")
    got = number_cycles(df, F.col("t").bitwiseAND(-16), ["t"], hot_rows=100)
    assert got.where("cycle <> t + 1").isEmpty() and got.count() == len(rows)


ALL_STATS = ("mean", "std", "var", "sum", "min", "max", "median", "count")


def _walk(n, seed, gaps=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n) + np.where(np.arange(n) > n // 2, 1e8, 0.0)  # a step that running sums would never forget
    return np.where(rng.random(n) < gaps, np.nan, np.round(x, 3))


@pytest.mark.parametrize("frame_rows,shift", [(1, 16), (1, 4), (64, 16)])
def test_merged_windows_equal_sliding_frames(spark, monkeypatch, frame_rows, shift):
    """Chunks of any size, whole and cut engines, missing values and a level shift."""
    from fleethazard.operators import ordered

    monkeypatch.setattr(feature_module, "FRAME_ROWS", frame_rows)
    monkeypatch.setattr(ordered.with_halo, "__defaults__", (*ordered.with_halo.__defaults__[:-1], shift))
    pdf = pd.concat([pd.DataFrame({"engine_id": e, "cycle": np.arange(1, n + 1), "sensor_1": _walk(n, e, gaps)})
                     for e, n, gaps in [(1, 300, 0.0), (2, 90, 0.02), (3, 7, 0.0), (4, 1, 0.0), (5, 40, 1.0)]], ignore_index=True)
    spec = FeatureSpec(windows=(1, 2, 3, 10, 37, 90, 128), stats=ALL_STATS, lags=(2,), deltas=())
    df = spark.createDataFrame(pdf, "engine_id long, cycle long, sensor_1 double")
    got = feature_frame(df, spec).toPandas().sort_values(["engine_id", "cycle"]).reset_index(drop=True)
    for w in spec.windows:
        for e, x in pdf.groupby("engine_id"):
            frames = [x.sensor_1.to_numpy()[max(0, i - w + 1):i + 1] for i in range(len(x))]
            full = [len(f) == w and not np.isnan(f).any() for f in frames]
            mine = got[got.engine_id == e].reset_index(drop=True)
            for stat, want in {"mean": np.mean, "sum": np.sum, "min": np.min, "max": np.max, "median": np.median, "count": len,
                               "var": lambda f: np.var(f, ddof=1) if w > 1 else np.nan, "std": lambda f: np.std(f, ddof=1) if w > 1 else np.nan}.items():
                expected = [want(f) if ok else np.nan for f, ok in zip(frames, full)]
                np.testing.assert_allclose(mine[f"sensor_1__roll{w}__{stat}"].astype(float), expected, rtol=1e-7, atol=1e-6, err_msg=f"{w} {stat}")


def test_long_windows_cost_no_more_than_short_ones(spark):
    """20,000 cycles: a window of 5,000 rows against one of 100, within a small factor (sliding frames need 50 times the work)."""
    df = spark.range(4).selectExpr("id AS engine_id", "explode(sequence(1, 5000)) AS cycle").selectExpr("*", "rand(7) AS sensor_1").repartition(4).cache()
    df.count()

    def seconds(w):
        times = []
        for _ in range(2):
            begin = time.perf_counter()
            feature_frame(df, FeatureSpec(windows=(w,), stats=("mean", "std", "min"), lags=(), deltas=())).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        return min(times)

    assert seconds(4000) < 3 * seconds(100) + 0.5


def test_all_windows_share_one_sort(spark):
    """Short and long windows, lags and deltas: rows are sorted once, before any statistic makes them wide."""
    df = spark.range(4).selectExpr("id AS engine_id", "explode(sequence(1, 300)) AS cycle").selectExpr("*", "rand(7) AS sensor_1")
    spec = FeatureSpec(windows=(2, 10, 100, 150), stats=("mean", "std", "min", "count"), lags=(1,), deltas=(1,))
    plan = feature_frame(df, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1


def test_windows_across_batches(spark):
    """Batches far shorter than a window, with an engine's rows split between them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(e, i, None if (e, i) == (1, 40) else float((i * 37 + e) % 11)) for e in range(3) for i in range(1, 90)]
        df = spark.createDataFrame(rows, "engine_id long, cycle long, sensor_1 double")
        got = feature_frame(df, FeatureSpec(windows=(5, 30), stats=("sum", "max"), lags=(), deltas=())).toPandas().sort_values(["engine_id", "cycle"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    values = pd.DataFrame(rows, columns=["engine_id", "cycle", "x"])
    for w in (5, 30):
        frames = values.groupby("engine_id").x.rolling(w, min_periods=w)
        for stat, want in (("sum", frames.sum()), ("max", frames.max())):
            np.testing.assert_allclose(got[f"sensor_1__roll{w}__{stat}"].astype(float), want.to_numpy(), atol=1e-9)
