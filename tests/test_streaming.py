import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleethazard.operators.features import feature_frame
from fleethazard.params import FeatureSpec
from fleethazard.streaming.features import EngineRows, batch_features, parquet_sink, stream_features

SPEC = FeatureSpec(windows=(1, 3, 5), stats=("mean", "std", "min", "max", "sum", "median", "var", "count"), lags=(1, 4), deltas=(1, 2))
SCHEMA = "engine_id long, cycle long, sensor_1 double, sensor_2 double"


def _run(spark, tmp_path, deliveries, spec=SPEC, all_every=20):
    source, out, state, checkpoint = (str(tmp_path / n) for n in ("source", "out", "state", "checkpoint"))
    for part in deliveries:
        spark.createDataFrame(part, SCHEMA).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        stream_features(stream, spec, parquet_sink(out), state, checkpoint, all_every=all_every).awaitTermination()
    return _sorted(spark.read.parquet(out).drop("batch"))


def _sorted(df):
    return df.toPandas().sort_values(["engine_id", "cycle"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def history():
    rng = np.random.default_rng(8)
    frames = [pd.DataFrame({"engine_id": e, "cycle": np.cumsum(rng.choice([1, 1, 3], n)), "sensor_1": rng.normal(size=n) + 50,
                            "sensor_2": np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n))})
              for e, n in [(1, 90), (2, 30), (3, 2), (4, 25)]]
    return pd.concat(frames, ignore_index=True)


@pytest.mark.parametrize("all_every", [1, 2, 20])
def test_stream_equals_batch(spark, tmp_path, history, all_every):
    cuts = [0, 20, 21, 24, 1000]
    got = _run(spark, tmp_path, [history[(history.cycle > a) & (history.cycle <= b)] for a, b in zip(cuts, cuts[1:])], all_every=all_every)
    clean = spark.createDataFrame(history, SCHEMA).withColumn("sensor_2", F.when(~F.isnan("sensor_2"), F.col("sensor_2")))
    want = feature_frame(clean, SPEC).toPandas().sort_values(["engine_id", "cycle"]).reset_index(drop=True)
    assert (got["dropped"] == 0).all()
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-9, atol=1e-12, check_dtype=False)


def test_late_and_repeated_cycles_are_dropped_and_counted(spark, tmp_path):
    row = lambda c, x: (1, c, float(x), 0.0)
    spec = FeatureSpec(windows=(2,), stats=("mean",), lags=(), deltas=())
    frame = lambda rows: pd.DataFrame(rows, columns=["engine_id", "cycle", "sensor_1", "sensor_2"])
    got = _run(spark, tmp_path, [frame([row(3, 30), row(1, 10), row(2, 20)]), frame([row(2, 99), row(3, 99)]), frame([row(4, 40), row(1, 99)])], spec)
    assert got.cycle.tolist() == [1, 2, 3, 4]
    assert got["sensor_1__roll2__mean"].tolist()[1:] == [15.0, 25.0, 35.0]
    assert got.dropped.tolist() == [0, 0, 0, 3]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, history):
    """After a crash the stream runs its last micro-batch again, with parts of its first attempt written."""
    out, state = str(tmp_path / "out"), EngineRows(spark, str(tmp_path / "state"), ["sensor_1", "sensor_2"], SPEC.history(), 2)
    parts = [spark.createDataFrame(history[(history.cycle > a) & (history.cycle <= b)], SCHEMA) for a, b in ((0, 15), (15, 30), (30, 1000))]
    stop = lambda features, batch_id: (parquet_sink(out)(features.limit(3), batch_id), 1 / 0)

    for i, part in enumerate(parts):
        with pytest.raises(ZeroDivisionError):
            batch_features(part, i, SPEC, state, stop)
        for _ in range(2):
            batch_features(part, i, SPEC, state, parquet_sink(out))
    got = _sorted(spark.read.parquet(out).drop("batch"))
    want = _run(spark, tmp_path / "whole", [history])
    pd.testing.assert_frame_equal(got, want[got.columns], rtol=1e-9, atol=1e-12)


def test_engines_cut_into_blocks(spark, tmp_path, monkeypatch):
    """An engine of many rows in one micro-batch, among tails from before, is cut as in the batch operator."""
    from fleethazard.operators import ordered

    monkeypatch.setattr(ordered, "BLOCK_SHIFT", 4)
    monkeypatch.setattr(ordered.with_halo, "__defaults__", (*ordered.with_halo.__defaults__[:-1], 4))
    rng = np.random.default_rng(2)
    long = pd.DataFrame({"engine_id": 1, "cycle": np.arange(1, 301), "sensor_1": rng.normal(size=300), "sensor_2": rng.normal(size=300)})
    got = _run(spark, tmp_path, [long[:100], long[100:]])
    want = _sorted(feature_frame(spark.createDataFrame(long, SCHEMA), SPEC))
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-9, atol=1e-12)
