from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.operators import classifiers
from fleethazard.operators.classifiers import (
    FITTERS, fit_logreg, predict_by_model, predict_proba, top_feature_importance, with_balanced_weights,
)
from fleethazard.operators.isolation_forest import fit_isolation_forest, mean_path, recomputed_scores, score_isolation_forest
from fleethazard.operators.quality import require_valid_features
from fleethazard.operators.scaling import fit_scaler, scaler_params
from fleethazard.operators.metrics import early_stop_best_epoch
from fleethazard.operators.sweep import PolicyError, ranking_metrics
from fleethazard.params import BacktestSpec, FeatureSpec, ForestSpec, ModelSpec, PolicySpec, Profile
from fleethazard.plans import backtest, training
from fleethazard.plans.backtest import run_backtest
from fleethazard.plans.scoring import score_latest_with_network, score_latest_windows, score_window_requests
from fleethazard.plans.tables import training_table
from fleethazard.plans.training import compare_models, run_anomaly, train_select_report, train_window_model
from fleethazard.streaming.alerts import split_complete
from fleethazard.sources.registry import (
    get_active_version, load_active_model, load_model_version, save_model_version, set_active_version, write_attempt,
)

PROFILE = Profile(
    horizon_n=8, window_l=10, features=FeatureSpec(windows=(3, 10), lags=(1,), deltas=(1,)),
    models=ModelSpec(logreg_max_iter=40, gbt_trees=5, gbt_depth=3, mlp_epochs=60),
    forest=ForestSpec(n_trees=30, max_samples=128),
    backtest=BacktestSpec(n_folds=2, train_min_engines=12, test_engines_per_fold=4),
)


@pytest.fixture(scope="module")
def wearing(spark):
    """Engines whose first sensor drifts as failure comes near."""
    rng = np.random.default_rng(11)
    frames = []
    for engine in range(1, 25):
        n = int(rng.integers(40, 60))
        left = n - np.arange(1, n + 1)
        frames.append(pd.DataFrame({
            "engine_id": engine, "cycle": np.arange(1, n + 1), "op_setting_1": 100.0,
            "sensor_1": 20 * np.exp(-left / 6) + rng.normal(size=n), "sensor_2": rng.normal(size=n)}))
    return spark.createDataFrame(pd.concat(frames)).cache()


def test_logreg_solves_the_balanced_penalised_problem(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2)) * [3.0, 0.5] + [10.0, -1.0]
    y = (x[:, 0] - 10 + rng.normal(size=400) * 3 > 2).astype(int)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "label": y})
    fitted = fit_logreg(spark.createDataFrame(pdf), ["a", "b"], ModelSpec()).stages[-1]
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w = np.where(y == 1, 400 / (2 * y.sum()), 400 / (2 * (1 - y).sum()))
    beta, b0 = fitted.coefficients.toArray(), fitted.intercept
    p = 1 / (1 + np.exp(-(z @ beta + b0)))
    assert np.abs(z.T @ (w * (p - y)) + beta).max() < 0.05  # gradient of the summed loss with strength 1
    assert abs((w * (p - y)).sum()) < 0.05


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    assert {(r.label, r._weight) for r in with_balanced_weights(df).collect()} == {(1, 2.0), (0, 4 / 6)}


def test_isolation_forest_ranks_strangers_higher(spark):
    rng = np.random.default_rng(0)
    normal, strange = rng.normal(size=(1200, 5)), rng.normal(size=(20, 5)) + 8
    names = [f"f{i}" for i in range(5)]
    pdf = pd.DataFrame(np.vstack([normal, strange]), columns=names)
    pdf["engine_id"], pdf["cycle"] = np.arange(len(pdf)) % 9, np.arange(len(pdf))
    df = spark.createDataFrame(pdf)
    forest = fit_isolation_forest(df.where("cycle < 1000"), names)
    sizes = forest.groupBy("tree").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] == 100 and sizes[1] <= 511
    out = score_isolation_forest(forest, df.where("cycle >= 1000"), names).toPandas()
    assert np.isfinite(out.anomaly_score).all() and len(out) == 220 and out.anomaly_score.between(0, 1).all()
    assert out[out.cycle >= 1200].anomaly_score.min() > out[out.cycle < 1200].anomaly_score.median()
    again = fit_isolation_forest(df.where("cycle < 1000").repartition(7), names)
    assert forest.exceptAll(again).isEmpty()  # independent of the partitioning


def test_isolation_forest_arguments(spark):
    df = spark.createDataFrame([(1, 1, 2.0)], "engine_id long, cycle long, a double")
    for bad in (0.0, 0.6):
        with pytest.raises(ValueError, match="contamination must lie"):
            fit_isolation_forest(df, ["a"], ForestSpec(contamination=bad))
    with pytest.raises(ValueError):
        fit_isolation_forest(df, [])
    assert mean_path([1, 2]).tolist() == [0.0, 1.0]
    # a forest of one row still scores
    assert score_isolation_forest(fit_isolation_forest(df, ["a"]), df, ["a"], n_train=1).count() == 1


def test_training_table_in_one_pass_equals_the_join(wearing):
    from fleethazard.operators.features import build_tabular_features
    from fleethazard.operators.labeling import label_horizon
    from fleethazard.plans.tables import join_features_labels

    one = training_table(wearing, PROFILE).select("engine_id", "cycle", "label", "sensor_1__roll10__std")
    two = join_features_labels(build_tabular_features(wearing, PROFILE.features, 10), label_horizon(wearing, 8, 10)).select(*one.columns)
    assert one.exceptAll(two).isEmpty() and one.count() == two.count()


def test_train_select_report_and_registry(spark, wearing, tmp_path):
    run = train_select_report(wearing, PROFILE, root=str(tmp_path))
    metrics = {(r.model, r.split, r.metric): r.value for r in run["metrics"].collect()}
    best = run["metadata"]["model_type"]
    assert metrics[(best, "val", "recall")] >= 0.85 and metrics[(best, "val", "precision")] >= 0.3
    assert metrics[(best, "test", "pr_auc")] > 0.7
    model, metadata = load_active_model(spark, "tabular", str(tmp_path))
    assert metadata["version"] == "v1" and metadata["threshold"] == run["metadata"]["threshold"]
    assert metadata["feature_columns"] == sorted(metadata["feature_columns"])
    latest = score_latest_windows(wearing, model, metadata, PROFILE).toPandas()
    assert len(latest) == 24 and latest.risk_score.between(0, 1).all()
    assert (latest.is_alert == (latest.risk_score >= metadata["threshold"])).all()

    body = ('{"window": [' + ", ".join('{"op_setting_1": 100.0, "sensor_1": %d.5, "sensor_2": 0.0}' % i for i in range(10)) + "]}")
    requests = spark.createDataFrame([(1, body), (2, '{"window": []}')], "request_id long, body string")
    good, bad = score_window_requests(requests, ["op_setting_1", "sensor_1", "sensor_2"], model, metadata, PROFILE)
    assert [r.request_id for r in good.collect()] == [1] and [r.reject_reason for r in bad.collect()] == ["wrong length"]


def test_registry_errors(spark, wearing, tmp_path):
    with pytest.raises(FileNotFoundError):
        get_active_version(spark, "none", str(tmp_path))
    set_active_version(spark, "seq", "v1", str(tmp_path))
    set_active_version(spark, "seq", "v2", str(tmp_path))
    assert get_active_version(spark, "seq", str(tmp_path)) == "v2"
    model = fit_logreg(wearing.withColumn("label", (F.col("sensor_1") > 3).cast("int")), ["sensor_1"], ModelSpec(logreg_max_iter=2))
    good = {"model_type": "logreg", "featureset_version": "v1", "horizon_n": 8, "window_l": 10, "feature_columns": ["sensor_1"],
            "threshold": 0.5, "bucket_cutoffs": [0.2, 0.5], "target_recall": 0.85, "min_precision": 0.3, "val_metrics": None}
    for change, message in (({"threshold": 1.5}, "threshold"), ({"bucket_cutoffs": [0.5, 0.2]}, "bucket_cutoffs")):
        with pytest.raises(ValueError, match=message):
            save_model_version(spark, "m", "v1", model, {**good, **change}, str(tmp_path))
    for key in good:
        with pytest.raises(ValueError, match=key):
            save_model_version(spark, "m", "v1", model, {k: v for k, v in good.items() if k != key}, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        get_active_version(spark, "m", str(tmp_path))
    save_model_version(spark, "m", "v1", model, good, str(tmp_path))
    save_model_version(spark, "m", "v2", model, good, str(tmp_path), set_active=False)
    assert get_active_version(spark, "m", str(tmp_path)) == "v1"


def test_training_stops_by_its_history(wearing):
    """Fewer epochs than allowed, the best weights kept, and the rule on the published history says the same."""
    out = train_window_model(wearing, replace(PROFILE, models=replace(PROFILE.models, mlp_epochs=12, mlp_patience=2, mlp_steps=4)))
    history = out["history"].orderBy("epoch").collect()
    rule = early_stop_best_epoch(out["history"], 2).first()
    assert [r.epoch for r in history] == list(range(1, rule.epochs_run + 1))
    assert rule.epochs_run in (12, rule.best_epoch + 2)
    val = out["scored"].where("split = 'val'")
    assert ranking_metrics(val).first().pr_auc == pytest.approx(rule.best_val_pr_auc, abs=1e-12)
    assert len({r.val_loss for r in history}) == len(history)  # each epoch goes on from the weights of the one before


def test_forest_scores_by_expressions(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["a", "b", "c"])
    pdf["engine_id"], pdf["cycle"] = np.arange(400) % 9, np.arange(400)
    df, spec = spark.createDataFrame(pdf).repartition(3), ForestSpec(n_trees=15, max_samples=64)
    forest = fit_isolation_forest(df, ["a", "b", "c"], spec)
    both = recomputed_scores(forest, score_isolation_forest(forest, df, ["a", "b", "c"], 64, 400), ["a", "b", "c"], 64, 400, "again").collect()
    assert len(both) == 400 and max(abs(r.again - r.anomaly_score) for r in both) < 1e-12


def test_a_version_is_committed_once(spark, wearing, tmp_path):
    """Writers that compete for a version, a crash before the commit, and files that change afterwards."""
    model = fit_logreg(wearing.withColumn("label", (F.col("sensor_1") > 3).cast("int")), ["sensor_1"], ModelSpec(logreg_max_iter=2))
    meta = lambda t: {"model_type": "logreg", "featureset_version": "v1", "horizon_n": 8, "window_l": 10, "feature_columns": ["sensor_1"],
                      "threshold": t, "bucket_cutoffs": [0.2, 0.5], "target_recall": 0.85, "min_precision": 0.3, "val_metrics": None}
    root = str(tmp_path)
    write_attempt(spark, "m", "v1", model, meta(0.9), root)  # never committed
    with pytest.raises(FileNotFoundError):
        load_model_version(spark, "m", "v1", root)
    with ThreadPoolExecutor(4) as pool:
        saves = [pool.submit(save_model_version, spark, "m", "v1", model, meta(t / 10), root) for t in range(4)]
    failed = [type(s.exception()) for s in saves if s.exception()]
    assert failed == [FileExistsError] * 3
    won = next(t for t, s in enumerate(saves) if not s.exception())
    assert load_active_model(spark, "m", root)[1]["threshold"] == won / 10
    assert not [p for p in (tmp_path / "m" / "v1").glob("COMMIT.*") if not p.name.endswith(".crc")]
    part = next(Path(saves[won].result(), "metadata").glob("part-*"))
    (part.parent / f".{part.name}.crc").unlink()
    part.write_text(part.read_text().replace("logreg", "gbt"))
    with pytest.raises(ValueError, match="differs from what was committed"):
        load_active_model(spark, "m", root)


def test_policy_out_of_reach_raises(wearing):
    impossible = Profile(horizon_n=8, window_l=10, features=PROFILE.features, models=PROFILE.models,
                         policy=PolicySpec(target_recall=1.0, min_precision=1.0))
    with pytest.raises(PolicyError):
        train_select_report(wearing, impossible, candidates=("logreg",))
    with pytest.raises(ValueError, match="known model"):
        train_select_report(wearing, PROFILE, candidates=("unknown",))


def test_backtest(wearing):
    out = run_backtest(wearing, PROFILE)
    folds = {r.fold: (r.train, r.val, r.test) for r in out["folds"].collect()}
    assert folds == {0: (9, 3, 4), 1: (12, 4, 4)}
    metrics = out["metrics"].where("metric = 'pr_auc'").collect()
    assert {r.fold for r in metrics} == {0, 1} and all(r.value > 0.6 for r in metrics)
    assert out["calibration"].groupBy("fold").agg(F.sum("count")).count() == 2
    assert out["errors"].where("error = 'fp' AND fp_kind IS NULL").isEmpty()
    none = run_backtest(wearing, Profile(horizon_n=8, window_l=10, features=PROFILE.features))
    assert "too small" in none["message"]


def test_backtest_scores_a_fold_in_one_pass(wearing, monkeypatch):
    passes, predict = [], backtest.predict_by_model
    monkeypatch.setattr(backtest, "predict_by_model", lambda models, rows, keep: passes.append(sorted(models)) or predict(models, rows, keep))
    out = run_backtest(wearing, PROFILE)
    assert passes == [["gbt", "logreg"]] * 2
    scored = out["scored"].groupBy("fold", "model", "split").count().collect()
    sizes = {(r["fold"], r["split"], r["count"]) for r in scored}
    assert len(scored) == 8 and len(sizes) == 4 and {r.split for r in scored} == {"val", "test"}


def test_large_train_tables_get_few_rounds_of_parts(spark):
    """The driver's larger tables: a part for each core up to 100 million values, then rounds of them."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(100).withColumnRenamed("id", "engine_id")
    for n_rows, rounds in ((2_000_000 * cores, 1), (4_000_000 * cores, 2)):
        even = classifiers._in_even_parts(rows, ["engine_id", "cycle"], n_rows, 45)
        assert even.rdd.getNumPartitions() == rounds * cores and even.count() == 100
        even.unpersist()


@pytest.mark.parametrize("history", ["full", "labeled"])
def test_anomaly_run(wearing, history):
    out = run_anomaly(wearing, PROFILE, history)
    assert {r.split for r in out["topk"].collect()} == {"train", "val", "test"}
    assert out["topk"].where("k = 0.05 AND split = 'train'").first().lift > 1.5
    rows = training_table(wearing, PROFILE, history)
    assert out["scored"].count() == rows.count()


def test_window_model(wearing):
    out = train_window_model(wearing, PROFILE, caps={"train": 10})
    metrics = {r.split: r for r in out["metrics"].collect()}
    assert metrics["val"].recall >= 0.85 and metrics["train"].pr_auc > 0.5 and metrics["test"].loss > 0
    assert out["scored"].where("split = 'train'").select("engine_id").distinct().count() == 10


def test_newest_windows_by_the_network_and_their_rejects(spark, wearing, tmp_path):
    out = train_window_model(wearing, PROFILE, root=str(tmp_path))
    model, metadata = load_active_model(spark, "seq", str(tmp_path))
    assert metadata["val_metrics"]["recall"] >= 0.85 and metadata["featureset_version"] == "v1"
    last = F.col("cycle") == F.max("cycle").over(Window.partitionBy("engine_id"))
    spoiled = wearing.withColumn("sensor_2", F.when((F.col("engine_id") == 3) & last, float("inf")).otherwise(F.col("sensor_2")))
    short = wearing.where("engine_id = 1 AND cycle <= 9").withColumn("engine_id", F.lit(99).cast("long"))
    good, bad = score_latest_with_network(spoiled.unionByName(short), model, metadata)
    assert {r.engine_id: r.reject_reason for r in bad.collect()} == {3: "not finite", 99: "short history"}
    want = {(r.engine_id, r.cycle): r.y_proba for r in out["scored"].collect()}
    rows = good.collect()
    assert len(rows) == 23
    assert all(r.risk_score == pytest.approx(want[(r.engine_id, r.cycle)]) and r.is_alert == (r.risk_score >= r.threshold) for r in rows)


def test_rows_a_model_cannot_score_come_back(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (1, 3, float("nan")), (1, 4, float("inf"))], "engine_id long, cycle long, a double")
    complete, rejected = split_complete(df, {"feature_columns": ["a"]})
    assert [r.cycle for r in complete.collect()] == [1]
    assert sorted((r.cycle, r.reject_reason) for r in rejected.collect()) == [(c, "missing features") for c in (2, 3, 4)]


def test_compare(wearing):
    out = compare_models(wearing, PROFILE)
    assert set(out["thresholds"]) == {"logreg", "gbt", "mlp"}
    assert out["metrics"].count() == 3 * 3 * 10 and out["gap"].count() == 3
    best = out["best"].first()
    top = max(r.value for r in out["metrics"].where("split = 'val' AND metric = 'pr_auc'").collect())
    assert best.val_pr_auc == pytest.approx(top)


def test_compare_makes_the_training_table_once(wearing, monkeypatch):
    """The forest reads the table the classifiers were fitted on: same fleet, profile and history."""
    made, prepare = [], training.prepared_table
    monkeypatch.setattr(training, "prepared_table", lambda *given, **named: made.append(prepare(*given, **named)) or made[-1])
    out = compare_models(wearing, PROFILE, candidates=("logreg",), with_windows=False)
    assert len(made) == 1
    want = run_anomaly(wearing, PROFILE, history="full")["topk"].select("split", "k", "n", "positives", "m")
    assert out["topk"].select(*want.columns).exceptAll(want).isEmpty() and want.count() == 6


def test_scores_of_several_models_come_from_one_pass(wearing):
    table = training_table(wearing, PROFILE).withColumn("split", F.lit("train"))
    models, scored = training.fit_candidates(table, PROFILE, ("logreg", "gbt"))
    features = predict_by_model(models, table, ["engine_id", "cycle"])
    plan = features._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and "Union" not in plan
    assert scored.columns == ["model", *training.SCORED, "y_proba"] and scored.count() == 2 * table.count()
    for name, model in models.items():
        want = predict_proba(model, table).select("engine_id", "cycle", F.round("y_proba", 12))
        got = scored.where(F.col("model") == name).select("engine_id", "cycle", F.round("y_proba", 12))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_epochs_of_the_network_pass_over_even_parts(spark, monkeypatch):
    seen, fit = [], classifiers.MultilayerPerceptronClassifier.fit

    def spy(self, rows, *rest):
        seen.append([len(part) for part in rows.rdd.glom().collect()])
        return fit(self, rows, *rest)

    monkeypatch.setattr(classifiers.MultilayerPerceptronClassifier, "fit", spy)
    windows = _uneven(spark).select("engine_id", F.col("cycle").alias("pred_cycle"), "label", F.array(F.array("a", "b"), F.array("b", "a")).alias("window"))
    classifiers.fit_window_classifier_by_epochs(windows, windows, 2, 2, ModelSpec(mlp_epochs=2, mlp_hidden=2))
    assert len(seen) == 2 and all(len(s) % spark.sparkContext.defaultParallelism == 0 and sum(s) == 540 for s in seen)
    assert all(max(s) < 1.3 * sum(s) / len(s) for s in seen)


def test_importance_names_the_informative_sensor(spark, wearing):
    table = training_table(wearing, PROFILE)
    features = [c for c in table.columns if "__" in c]
    model = FITTERS["gbt"](table, features, PROFILE.models)
    top = top_feature_importance(model, features, spark, 3).collect()
    assert len(top) == 3 and top[0].feature.startswith("sensor_1__")
    assert predict_proba(model, table).where("y_proba < 0 OR y_proba > 1").isEmpty()


def _uneven(spark):
    """540 rows, nearly all of them in one of five parts; ``c`` is constant and ``b`` nearly so."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"engine_id": np.arange(540) % 9, "cycle": np.arange(540) // 9, "a": rng.normal(size=540), "b": 1.0, "c": 4.0})
    pdf.loc[7, "b"] = 2.0
    pdf["label"] = (pdf.a + rng.normal(size=540) > 0).astype(int)
    many = spark.createDataFrame(pdf).coalesce(1)
    return reduce(DataFrame.unionByName, [many.where(f"cycle % 60 = {k}") for k in range(4)], many.where("cycle >= 4"))


@pytest.mark.parametrize("kind, name", [("gbt", "GBTClassifier"), ("logreg", "LogisticRegression")])
def test_fits_pass_over_even_parts(spark, monkeypatch, kind, name):
    """As many parts for each core, however the rows came; trees see no constant feature."""
    seen, estimator = [], getattr(classifiers, name)
    fit = estimator.fit

    def spy(self, rows, *rest):
        seen.append([len(part) for part in rows.rdd.glom().collect()])
        seen.append({len(r.features) for r in rows.collect()})
        return fit(self, rows, *rest)

    monkeypatch.setattr(estimator, "fit", spy)
    FITTERS[kind](_uneven(spark), ["a", "b", "c"], PROFILE.models)
    sizes, width = seen
    assert len(sizes) % spark.sparkContext.defaultParallelism == 0 and sum(sizes) == 540
    assert max(sizes) < 1.3 * sum(sizes) / len(sizes)
    assert width == ({2} if kind == "gbt" else {3})


def test_constant_features_have_no_importance_and_no_effect(spark):
    df = _uneven(spark)
    with_c, without = FITTERS["gbt"](df, ["c", "a", "b"], PROFILE.models), FITTERS["gbt"](df, ["a", "b"], PROFILE.models)
    top = {r.feature: r.importance for r in top_feature_importance(with_c, ["c", "a", "b"], spark, 3).collect()}
    want = {r.feature: r.importance for r in top_feature_importance(without, ["a", "b"], spark, 3).collect()}
    assert top == pytest.approx(want | {"c": 0.0}) and want["a"] > 0
    scores = [predict_proba(m, df).select("engine_id", "cycle", F.round("y_proba", 9)) for m in (with_c, without)]
    assert scores[0].exceptAll(scores[1]).isEmpty()
    # missing in one row only is not constant, and a table of constants alone still gives a model
    flat = df.withColumn("a", F.lit(0.0))
    assert FITTERS["gbt"](flat, ["c", "a"], PROFILE.models).stages[-1].numFeatures == 1
    with pytest.raises(Exception, match="null|NaN"):
        FITTERS["gbt"](df.withColumn("c", F.when(F.col("cycle") != 5, 4.0)), ["a", "c"], PROFILE.models)


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf"), float("-inf")])
def test_one_bad_value_among_sound_ones_is_named(spark, bad):
    rows = [(1, c, 0.0, -1.5, 3) for c in range(10, 20)]
    schema = "engine_id long, cycle long, a double, b double, n long"
    require_valid_features(spark.createDataFrame(rows, schema), 10)
    with pytest.raises(ValueError, match="duplicate_key"):
        require_valid_features(spark.createDataFrame([*rows, rows[0]], schema), 10)
    with pytest.raises(ValueError, match=" on b "):
        require_valid_features(spark.createDataFrame([*rows, (1, 20, 0.0, bad, 3)], schema), 10)
    early = spark.createDataFrame([*rows, (1, 3, 0.0, None, 3)], schema)
    require_valid_features(early, 10)  # before the first window


def test_scaler_inside_the_saved_model_is_the_population_scaler(wearing):
    labeled = wearing.withColumn("label", (F.col("sensor_1") > 3).cast("int"))
    model = fit_logreg(labeled, ["sensor_1", "op_setting_1"], ModelSpec(logreg_max_iter=3))
    z = model.stages[1].transform(model.stages[0].transform(labeled)).select("_z_0", "_z_1", "sensor_1").toPandas()
    params = scaler_params(fit_scaler(labeled, ["sensor_1"]))
    first = "_z_0" if z["_z_0"].abs().sum() else "_z_1"
    assert np.allclose(z[first], (z.sensor_1 - params["mean"][0]) / params["std"][0])
