"""Fitted models, end-to-end runs and streams.

SQL cannot fit a model. These queries return what it can derive all the same: rows and classes behind every report, slopes at
rest, and whether scores, metrics, thresholds and choices are those worked out again from what was published (`recheck`).
"""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    EV, EVENT_SIGNALS, EVL, KEY, SHORT, TRIAL, events, feature_columns, feature_places, feature_sql, query, scratch, split_sql,
)
from fleethazard.catalog.recheck import errors_agree, lifts_agree, metrics_again, metrics_agree, threshold_again
from fleethazard.catalog.tables import REQ, request_bodies
from fleethazard.functions.columns import model_feature_columns
from fleethazard.operators.classifiers import (
    FITTERS, WEIGHT, fit_window_classifier, predict_proba, predict_window_proba, with_balanced_weights,
)
from fleethazard.operators.isolation_forest import fit_isolation_forest, recomputed_scores, score_isolation_forest
from fleethazard.operators.metrics import early_stop_best_epoch
from fleethazard.operators.requests import parse_window_json, request_features
from fleethazard.operators.scaling import fit_scaler, scaler_params
from fleethazard.operators.sequences import build_sequence_pipeline
from fleethazard.operators.splits import assign_split, fit_split, split_engines
from fleethazard.operators.labeling import label_horizon
from fleethazard.params import BacktestSpec, FeatureSpec, Profile
from fleethazard.plans.backtest import run_backtest
from fleethazard.plans.scoring import latest_window_rejects, score_latest_windows, score_latest_with_network, score_window_requests
from fleethazard.plans.training import (
    compare_models, importance_report, prepared_table, run_anomaly, train_select_report, train_window_model,
)
from fleethazard.session import replace_file, written
from fleethazard.sources.registry import load_active_model, save_model_version, set_active_version, write_attempt
from fleethazard.streaming.alerts import stream_score_alerts
from fleethazard.streaming.features import EngineRows, batch_features, parquet_sink, stream_features

FOREST_FEATURES = EVENT_SIGNALS


TAB = f"{EVL}, {split_sql('ev')}, tab AS (SELECT engine_id, cycle, label, remaining, split FROM evl JOIN sp USING (engine_id))"
WIN = f"""{TAB}, win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle) AS pos FROM tab) WHERE pos >= 10)"""
MODEL_FEATURES = feature_columns(EVENT_SIGNALS, SHORT.features.windows)
NAMES = ", ".join(f"('{c}')" for c in MODEL_FEATURES)
PER_SPLIT = "sum(1 - label)::DOUBLE AS negatives, sum(label)::DOUBLE AS positives"


def _fitted(spark, d, kind):
    table = prepared_table(events(spark, d), TRIAL)
    features = model_feature_columns(table, ["split"])
    return table, features, FITTERS[kind](table.where("split = 'train'"), features, TRIAL.models)


def _standardised(table, features):
    """(x - mean) / std as an array, from the train rows' statistics."""
    params = scaler_params(fit_scaler(table.where("split = 'train'"), features))
    return F.array(*[(F.col(c) - m) / s for c, m, s in zip(params["feature_columns"], params["mean"], params["std"])])


def _logit(fitted):
    """The published coefficients applied to the column ``z``."""
    terms = [F.get("z", F.lit(i)) * float(w) for i, w in enumerate(fitted.coefficients)]
    return reduce(lambda a, b: a + b, terms, F.lit(float(fitted.intercept)))


def _consistent(responses):
    """Bucket and alert recomputed from score and threshold."""
    low, high = TRIAL.policy.bucket_cutoffs
    bucket = F.when(F.col("risk_score") < low, "low").when(F.col("risk_score") < high, "med").otherwise("high")
    return responses.select(*KEY, (
        F.col("risk_score").between(0, 1) & (bucket == F.col("bucket"))
        & ((F.col("risk_score") >= F.col("threshold")) == F.col("is_alert").cast("boolean"))).alias("consistent"))


@query("fit_logreg", f"""SELECT feature, TRUE AS stationary FROM (SELECT unnest(list_value({NAMES.replace('(', '').replace(')', '')}, '(intercept)')) AS feature)""")
def _(spark, d):
    """Whether each coefficient is at rest: its slope of the balanced, penalised loss, from the train rows."""
    table, features, model = _fitted(spark, d, "logreg")
    fitted = model.stages[-1]
    train = with_balanced_weights(table.where("split = 'train'")).withColumn("z", _standardised(table, features))
    off = train.withColumn("off", F.col(WEIGHT) * (1 / (1 + F.exp(-_logit(fitted))) - F.col("label")))
    n = train.count()
    slopes = off.agg(*[F.sum(F.col("off") * F.get("z", F.lit(i))) for i in range(len(features))], F.sum("off")).first()
    penalty = [float(w) for w in fitted.coefficients] + [0.0]
    rows = [(name, abs(s + p) / n < 1e-4) for name, s, p in zip([*features, "(intercept)"], slopes, penalty)]
    return spark.createDataFrame(rows, "feature string, stationary boolean")


@query("fit_gbt", "SELECT i::INTEGER AS tree, CASE WHEN i = 0 THEN 1e0 ELSE 1e-1 END AS weight, TRUE AS shallow FROM range(100) t(i)")
def _(spark, d):
    """Weight and depth of every boosted tree."""
    _, _, model = _fitted(spark, d, "gbt")
    fitted = model.stages[-1]
    rows = [(i, float(w), t.depth <= TRIAL.models.gbt_depth and t.numNodes < 2 ** (t.depth + 1)) for i, (t, w) in enumerate(zip(fitted.trees, fitted.treeWeights))]
    return spark.createDataFrame(rows, "tree int, weight double, shallow boolean")


@query("predict_proba", f"WITH {TAB} SELECT engine_id, cycle, split, label, TRUE AS reproduced FROM tab")
def _(spark, d):
    """Every row's score against the published scaler and coefficients."""
    table, features, model = _fitted(spark, d, "logreg")
    scored = predict_proba(model, table.withColumn("z", _standardised(table, features)))
    again = 1 / (1 + F.exp(-_logit(model.stages[-1])))
    return scored.select(*KEY, "split", "label", (F.abs(again - F.col("y_proba")) < 1e-9).alias("reproduced"))


@query("top_feature_importance", f"""SELECT i::INTEGER AS rank, TRUE AS is_feature, TRUE AS falling FROM range(1, 21) t(i)""")
def _(spark, d):
    """The places of the report: known features in falling order."""
    rows = importance_report(spark, events(spark, d), TRIAL).collect()
    ok = [(i, r["feature"] in MODEL_FEATURES and len({x["feature"] for x in rows}) == len(rows),
           i == 1 or rows[i - 2]["importance"] >= r["importance"] >= 0) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(ok, "rank int, is_feature boolean, falling boolean")


@query("fit_isolation_forest", "SELECT i::INTEGER AS tree, TRUE AS whole, TRUE AS inside FROM range(100) t(i)")
def _(spark, d):
    """Each tree: one leaf more than inner nodes, and cuts within what its feature holds in the train rows."""
    df = assign_split(events(spark, d), fit_split(events(spark, d)))
    train = df.where("split = 'train'")
    low_high = [F.array(*[f(c) for c in FOREST_FEATURES]).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    nodes = fit_isolation_forest(train, FOREST_FEATURES).crossJoin(F.broadcast(train.agg(*low_high)))  # one row
    inner = F.col("feature") >= 0
    cut = F.col("threshold").between(F.get("low", F.col("feature")), F.get("high", F.col("feature")))
    return nodes.groupBy("tree").agg((F.count_if(~inner) == F.count_if(inner) + 1).alias("whole"),
                                     F.bool_and(~inner | cut).alias("inside"))


@query("score_isolation_forest", f"""WITH {EV}, {split_sql('ev')} SELECT engine_id, cycle, split, TRUE AS in_range, TRUE AS reproduced
  FROM ev JOIN sp USING (engine_id)""")
def _(spark, d):
    """Every row's score against path lengths worked out from the node table by parting the rows node by node."""
    df = assign_split(events(spark, d), fit_split(events(spark, d)))
    train = df.where("split = 'train'")
    n, forest = train.count(), written(fit_isolation_forest(train, FOREST_FEATURES), "forest")
    scored = score_isolation_forest(forest, df, FOREST_FEATURES, n_train=n)
    scored = recomputed_scores(forest, scored, FOREST_FEATURES, n_train=n, name="again")
    score = F.col("anomaly_score")
    return scored.select(*KEY, "split", ((score > 0) & (score < 1)).alias("in_range"), (F.abs(score - F.col("again")) < 1e-9).alias("reproduced"))


@query("fit_window_classifier", f"WITH {WIN} SELECT engine_id, cycle AS pred_cycle, split, label, TRUE AS in_range FROM win")
def _(spark, d):
    labeled = label_horizon(events(spark, d), TRIAL.horizon_n, TRIAL.window_l)
    split = split_engines(events(spark, d))
    parts = build_sequence_pipeline(labeled, split.where("split = 'train'"), TRIAL.window_l)
    n = len(parts["feature_columns"])
    windows = parts["windows"].join(split.select("engine_id", "split"), "engine_id")
    model = fit_window_classifier(windows.where("split = 'train'"), TRIAL.window_l, n, TRIAL.models)
    scored = predict_window_proba(model, windows, TRIAL.window_l, n)
    logit = F.log(F.col("y_proba") / (1 - F.col("y_proba")))
    fine = F.col("y_proba").between(0, 1) & ((F.abs(logit - F.col("logit")) < 1e-6) | (F.abs(F.col("logit")) > 30))
    return scored.select("engine_id", "pred_cycle", "split", "label", fine.alias("in_range"))


POLICY = TRIAL.policy.target_recall, TRIAL.policy.min_precision


@query("train_window_model", f"""WITH {WIN} SELECT split, {PER_SPLIT}, TRUE AS policy_met, TRUE AS metrics_agree FROM win GROUP BY split""")
def _(spark, d):
    """Windows by class behind the report, the policy at the chosen threshold, and the report against the scores."""
    run = train_window_model(events(spark, d), TRIAL, root=scratch(spark, "models"))
    val, policy = run["metadata"]["val_metrics"], TRIAL.policy
    met = val["recall"] >= policy.target_recall and val["precision"] >= policy.min_precision
    again = metrics_again(run["scored"].withColumn("threshold", F.lit(run["metadata"]["threshold"])), ["split"])
    names = ("pr_auc", "precision", "recall", "f1")
    same = F.forall(F.array(*[F.abs(F.col(f"r.{m}") - F.col(f"a.{m}")) < 1e-9 for m in names]), lambda x: x)
    agree = run["metrics"].alias("r").join(again.alias("a"), F.col("r.split") == F.col("a.split")).select("r.split", same.alias("metrics_agree"))
    sizes = run["scored"].groupBy("split").agg(
        F.sum(1.0 - F.col("label")).alias("negatives"), F.sum(F.col("label").cast("double")).alias("positives"), F.lit(met).alias("policy_met"))
    return sizes.join(agree, "split")


@query("train_window_model_early_stop", "SELECT TRUE AS stopped_by_rule, TRUE AS best_restored, TRUE AS first_beaten, TRUE AS recorded")
def _(spark, d):
    """The stop rule applied to the published history, and the val score of the weights that were kept against it."""
    run = train_window_model(events(spark, d), TRIAL)
    history, limit = run["history"].orderBy("epoch").collect(), TRIAL.models
    rule = early_stop_best_epoch(run["history"], limit.mlp_patience).first()
    full = rule["epochs_run"] == limit.mlp_epochs or rule["epochs_run"] - rule["best_epoch"] == limit.mlp_patience
    again = metrics_again(run["scored"].where("split = 'val'").withColumn("threshold", F.lit(0.5)), ["split"]).first()["pr_auc"]
    best = history[rule["best_epoch"] - 1]["val_pr_auc"]
    return spark.createDataFrame([(
        [r["epoch"] for r in history] == list(range(1, rule["epochs_run"] + 1)) and full, abs(again - best) < 1e-9,
        best >= history[0]["val_pr_auc"] and best == max(r["val_pr_auc"] for r in history),
        run["metadata"]["best_epoch"] == rule["best_epoch"] and run["metadata"]["epochs_run"] == len(history))],
        "stopped_by_rule boolean, best_restored boolean, first_beaten boolean, recorded boolean")


@query("train_select_report", f"""WITH {TAB} SELECT split, {PER_SPLIT}, TRUE AS metrics_agree, TRUE AS best_chosen, TRUE AS threshold_agrees, TRUE AS policy_met
  FROM tab GROUP BY split""")
def _(spark, d):
    """The report of each split, the chosen model and the threshold, worked out again from the published scores."""
    run = train_select_report(events(spark, d), TRIAL, root=scratch(spark, "models"))
    metadata, policy = run["metadata"], TRIAL.policy
    val = run["scored"].where("split = 'val'")
    areas = {r["model"]: r["pr_auc"] for r in metrics_again(val.withColumn("threshold", F.lit(0.5)), ["model"]).collect()}
    chosen = run["scored"].where(F.col("model") == metadata["model_type"]).withColumn("threshold", F.lit(metadata["threshold"]))
    at = threshold_again(chosen.where("split = 'val'"), ["model"], *POLICY).first()["again"]
    met = metadata["val_metrics"]["recall"] >= policy.target_recall and metadata["val_metrics"]["precision"] >= policy.min_precision
    return metrics_agree(run["metrics"].drop("model"), chosen, ["split"]).withColumns({
        "best_chosen": F.lit(areas[metadata["model_type"]] == max(areas.values())), "threshold_agrees": F.lit(at == metadata["threshold"]),
        "policy_met": F.lit(met)})


def _trial_folds(spark, d) -> Profile:
    """Folds in proportion to the fleet."""
    n = events(spark, d).select("engine_id").distinct().count()
    step = max(1, n // 10)
    return Profile(
        horizon_n=TRIAL.horizon_n, window_l=TRIAL.window_l, features=TRIAL.features, policy=TRIAL.policy, models=TRIAL.models,
        backtest=BacktestSpec(test_engines_per_fold=step, train_min_engines=max(2, 4 * n // 10)))


FOLD_ENGINES = """en AS (SELECT engine_id, row_number() OVER (ORDER BY engine_id) - 1 AS place, count(*) OVER () AS n
    FROM (SELECT DISTINCT engine_id FROM ev)),
  fo AS (SELECT f::INTEGER AS fold, engine_id FROM en, range(0, 3) t(f)
    WHERE place >= greatest(2, 4 * n // 10) + f * greatest(1, n // 10) AND place < greatest(2, 4 * n // 10) + (f + 1) * greatest(1, n // 10))"""


@query("run_backtest", f"""WITH {EVL}, {FOLD_ENGINES}
  SELECT fold, {PER_SPLIT}, TRUE AS metrics_agree, TRUE AS best_chosen, TRUE AS threshold_agrees FROM evl JOIN fo USING (engine_id) GROUP BY fold""")
def _(spark, d):
    """Every fold's report, best model and threshold, worked out again from the published scores."""
    run = run_backtest(events(spark, d), _trial_folds(spark, d))
    val = run["scored"].where("split = 'val'")
    areas = metrics_again(val.withColumn("threshold", F.lit(0.5)), ["fold", "model"])
    top = areas.groupBy("fold").agg(F.max("pr_auc").alias("top"))
    best = areas.join(run["best"].select("fold", "model"), ["fold", "model"]).join(top, "fold")
    at = threshold_again(val.join(best.select("fold", "model"), ["fold", "model"]), ["fold"], *POLICY)
    shown = spark.createDataFrame(sorted(run["thresholds"].items()), "fold int, shown double")
    checks = best.join(at, "fold").join(shown, "fold").select(
        "fold", (F.col("pr_auc") > F.col("top") - 1e-12).alias("best_chosen"), (F.col("again") == F.col("shown")).alias("threshold_agrees"))
    return metrics_agree(run["metrics"].drop("model"), run["test"], ["fold"]).join(checks, "fold")


def _quick_backtest(spark, d):
    folds = _trial_folds(spark, d)
    return run_backtest(events(spark, d), replace(folds, backtest=replace(folds.backtest, candidates=("logreg",))))


@query("run_backtest_folds", f"""WITH {EVL}, {FOLD_ENGINES}, sizes AS (SELECT fold, min(place) AS before, count(*) AS test FROM fo JOIN en USING (engine_id) GROUP BY fold)
  SELECT fold, before - greatest(1, ceil(2e-1 * before))::BIGINT AS train, greatest(1, ceil(2e-1 * before))::BIGINT AS val, test FROM sizes""")
def _(spark, d):
    """Engines of each role in every fold."""
    return _quick_backtest(spark, d)["folds"]


@query("run_backtest_errors", f"WITH {EV}, {FOLD_ENGINES} SELECT DISTINCT fold, TRUE AS errors_agree FROM fo")
def _(spark, d):
    """The listed errors of every fold against all its wrong rows."""
    run = _quick_backtest(spark, d)
    return errors_agree(run["errors"], run["test"], ["fold"])


@query("run_backtest_calibration", f"""WITH {EVL}, {FOLD_ENGINES} SELECT fold, count(*) AS n, sum(label)::DOUBLE AS positives, TRUE AS mean_agrees
  FROM evl JOIN fo USING (engine_id) GROUP BY fold""", ["positives"])
def _(spark, d):
    """The bins of every fold hold its test rows: their number, their positives and the sum of their scores."""
    run = _quick_backtest(spark, d)
    bins = run["calibration"].groupBy("fold").agg(
        F.sum("count").alias("n"), F.sum(F.col("count") * F.col("frac_pos")).alias("positives"), F.sum(F.col("count") * F.col("mean_pred")).alias("total"))
    sums = run["test"].groupBy("fold").agg(F.sum("y_proba").alias("want"))
    return bins.join(sums, "fold").select("fold", "n", "positives", (F.abs(F.col("total") - F.col("want")) < 1e-6).alias("mean_agrees"))


@query("run_anomaly", f"""WITH {TAB}, ss AS (SELECT split, count(*) AS n, sum(label)::BIGINT AS positives FROM tab GROUP BY split)
  SELECT split, k, n, positives, ceil(k * n)::BIGINT AS m, TRUE AS lifts_agree FROM ss, (SELECT unnest([1e-2, 5e-2]) AS k)""")
def _(spark, d):
    """What the lifts of each split are taken from, and the lifts against a full ranking of the published scores."""
    run = run_anomaly(events(spark, d), TRIAL)
    return lifts_agree(run["topk"], run["scored"])


LABELED_FEATURES = f"""lf AS (SELECT * FROM ({feature_sql(EVENT_SIGNALS, 'evl', SHORT.features.windows, keep=['label'])}) WHERE cycle >= 10)"""
N_NULLS = " + ".join(f'("{c}" IS NULL)::INTEGER' for c in MODEL_FEATURES)


@query("run_anomaly_report", f"""WITH {EVL}, {split_sql('ev')}, {LABELED_FEATURES}
  SELECT split, count(*) AS n, sum(label)::BIGINT AS positives, avg(label) AS base_rate, sum({N_NULLS})::BIGINT AS n_nan, 0::BIGINT AS n_inf,
    TRUE AS top_agrees, TRUE AS stored, TRUE AS reproduced FROM lf JOIN sp USING (engine_id) GROUP BY split""", ["base_rate"])
def _(spark, d):
    """Base rates, what was imputed, the ten strangest rows, and the stored scores against path lengths in the stored forest."""
    root = scratch(spark, "anomaly")
    run = run_anomaly(events(spark, d), TRIAL, root=root)
    stored, forest = spark.read.parquet(f"{root}/scores"), spark.read.parquet(f"{root}/forest")
    listed = F.array_sort(F.collect_list(F.struct((-F.col("anomaly_score")).alias("s"), "engine_id", "cycle")))
    # a rank filter this small is applied per task before the shuffle
    place = F.row_number().over(Window.partitionBy("split").orderBy(-F.col("anomaly_score"), "engine_id", "cycle"))
    want = stored.withColumn("_place", place).where(F.col("_place") <= 10).groupBy("split").agg(listed.alias("want"))
    top = stored.groupBy("split").agg(F.count("*").alias("n_stored")).join(want, "split")
    got = run["top_anomalies"].groupBy("split").agg(listed.alias("got"))
    n_train = stored.where("split = 'train'").count()
    again = recomputed_scores(forest, run["imputed"], run["features"], TRIAL.forest.max_samples, n_train, "again").select(*KEY, "again")
    same = stored.join(again, KEY).groupBy("split").agg(F.bool_and(F.abs(F.col("again") - F.col("anomaly_score")) < 1e-9).alias("reproduced"))
    return (run["base_rates"].join(run["nonfinite"], "split").join(top, "split").join(got, "split").join(same, "split")
            .select("split", "n", "positives", "base_rate", "n_nan", "n_inf", (F.col("want") == F.col("got")).alias("top_agrees"),
                    (F.col("n_stored") == F.col("n")).alias("stored"), "reproduced"))


@query("compare_models", f"""WITH {WIN}, m AS (SELECT unnest(['logreg', 'gbt']) AS model)
  SELECT model, split, {PER_SPLIT}, TRUE AS metrics_agree FROM tab, m GROUP BY ALL
  UNION ALL SELECT 'mlp', split, {PER_SPLIT}, TRUE FROM win GROUP BY split""")
def _(spark, d):
    """Every model's report against its published scores and threshold."""
    run = compare_models(events(spark, d), TRIAL)
    return metrics_agree(run["metrics"], run["scored"], ["model", "split"])


@query("compare_models_choice", "SELECT unnest(['logreg', 'gbt']) AS model, TRUE AS gap_agrees, TRUE AS threshold_agrees, TRUE AS best_agrees")
def _(spark, d):
    """Gap, threshold and best model of the comparison, worked out again from the published scores."""
    run = compare_models(events(spark, d), TRIAL, with_windows=False, with_forest=False)
    areas = metrics_again(run["scored"], ["model", "split"]).groupBy("model").pivot("split", ["train", "val"]).agg(F.first("pr_auc"))
    top = areas.agg(F.max("val")).first()[0]
    at = threshold_again(run["scored"].where("split = 'val'"), ["model"], *POLICY)
    shown = spark.createDataFrame(sorted(run["thresholds"].items()), "model string, shown double")
    best = run["best"].first()["model"]
    return run["gap"].join(areas, "model").join(at, "model").join(shown, "model").select(
        "model", (F.abs(F.col("gap") - F.col("train") + F.col("val")) < 1e-9).alias("gap_agrees"), (F.col("again") == F.col("shown")).alias("threshold_agrees"),
        F.when(F.col("model") == best, F.col("val") > top - 1e-12).otherwise(F.lit(True)).alias("best_agrees"))


REQUEST_SIGNALS = ["sensor_1", "sensor_2"]


@query("score_requests", f"WITH {REQ} SELECT request_id, reject_reason, CASE WHEN reject_reason IS NULL THEN TRUE END AS consistent, "
       "CASE WHEN reject_reason IS NULL THEN TRUE END AS reproduced FROM rr")
def _(spark, d):
    """Every JSON request: its response (bucket and alert recomputed, score against the published coefficients) or why it has none."""
    run = train_select_report(events(spark, d).select(*KEY, *REQUEST_SIGNALS), TRIAL, candidates=("logreg",))
    bodies = request_bodies(spark, d)
    responses, rejected = score_window_requests(bodies, REQUEST_SIGNALS, run["model"], run["metadata"], TRIAL)
    features, _ = request_features(parse_window_json(bodies), REQUEST_SIGNALS, TRIAL.features, TRIAL.window_l)
    table = prepared_table(events(spark, d).select(*KEY, *REQUEST_SIGNALS), TRIAL)
    again = features.withColumn("z", _standardised(table, run["metadata"]["feature_columns"]))
    again = again.select("request_id", (1 / (1 + F.exp(-_logit(run["model"].stages[-1])))).alias("again"))
    renamed = responses.withColumns({"engine_id": F.col("request_id"), "cycle": F.lit(1).cast("long")})
    fine = _consistent(renamed).select(F.col("engine_id").alias("request_id"), "consistent")
    good = responses.join(again, "request_id").join(fine, "request_id").select(
        "request_id", F.lit(None).cast("string").alias("reject_reason"), "consistent", (F.abs(F.col("again") - F.col("risk_score")) < 1e-9).alias("reproduced"))
    return good.unionByName(rejected, allowMissingColumns=True)


def _saved(spark, d) -> str:
    root = scratch(spark, "models")
    train_select_report(events(spark, d), TRIAL, candidates=("logreg",), root=root)
    return root


@query("save_model_version", f"""SELECT v AS version, 'logreg' AS model_type, {len(MODEL_FEATURES)}::INTEGER AS n_features,
  CASE WHEN v = 'v2' THEN 5e-1 END AS threshold_saved, TRUE AS active FROM (SELECT unnest(['v1', 'v2']) AS v)""")
def _(spark, d):
    """What is on disk after two saves: each version's metadata and which one is active."""
    root = _saved(spark, d)
    model, metadata = load_active_model(spark, "tabular", root)
    save_model_version(spark, "tabular", "v2", model, {**metadata, "threshold": 0.5}, root)
    rows = []
    for version in ("v1", "v2"):
        set_active_version(spark, "tabular", version, root)
        _, found = load_active_model(spark, "tabular", root)
        same = version == "v2" or found["threshold"] == metadata["threshold"]
        rows.append((found["version"], found["model_type"], len(found["feature_columns"]),
                     found["threshold"] if version == "v2" else None, same and found["version"] == version))
    return spark.createDataFrame(rows, "version string, model_type string, n_features int, threshold_saved double, active boolean")


@query("save_model_version_conflicts", """SELECT * FROM (VALUES ('interrupted', 'not there'), ('saved after it', 'v1 at 0.25'),
  ('competing', 'refused'), ('after the refusal', 'v1 at 0.25'), ('activated without a commit', 'not there'), ('changed on disk', 'refused')) t(step, outcome)""")
def _(spark, d):
    """A save cut short before its commit, one that competes for a version, and a file changed afterwards."""
    run = train_select_report(events(spark, d), TRIAL, candidates=("logreg",))
    root, at = scratch(spark, "models"), lambda t: {**run["metadata"], "threshold": t}

    def outcome(step):
        try:
            step()
            _, found = load_active_model(spark, "m", root)
            return f"{found['version']} at {found['threshold']}"
        except FileNotFoundError:
            return "not there"
        except (FileExistsError, ValueError):
            return "refused"

    write_attempt(spark, "m", "v1", run["model"], at(0.75), root)
    rows = [("interrupted", outcome(lambda: None)), ("saved after it", outcome(lambda: save_model_version(spark, "m", "v1", run["model"], at(0.25), root))),
            ("competing", outcome(lambda: save_model_version(spark, "m", "v1", run["model"], at(0.5), root))), ("after the refusal", outcome(lambda: None)),
            ("activated without a commit", outcome(lambda: set_active_version(spark, "m", "v2", root)))]
    set_active_version(spark, "m", "v1", root)
    kept = json.loads(spark.read.text(f"{root}/m/v1/COMMIT", wholetext=True).first()[0])["folder"]
    replace_file(spark, f"{root}/m/v1/{kept}/metadata/part-extra.txt", b"{}")
    return spark.createDataFrame([*rows, ("changed on disk", outcome(lambda: None))], "step string, outcome string")


NEWEST = f"WITH {EV} SELECT engine_id, max(cycle) AS cycle, TRUE AS consistent FROM ev GROUP BY engine_id HAVING count(*) >= 10"


@query("load_active_model", NEWEST)
def _(spark, d):
    """Save, activate, load, and score the newest windows with the loaded model."""
    model, metadata = load_active_model(spark, "tabular", _saved(spark, d))
    return _consistent(score_latest_windows(events(spark, d), model, metadata, TRIAL))


@query("score_latest_windows", NEWEST)
def _(spark, d):
    run = train_select_report(events(spark, d), TRIAL, candidates=("logreg",))
    return _consistent(score_latest_windows(events(spark, d), run["model"], run["metadata"], TRIAL))


@query("latest_window_rejects", f"""WITH {EV} SELECT engine_id, max(cycle) AS cycle, 'short history' AS reject_reason
  FROM ev GROUP BY engine_id HAVING count(*) < 70""")
def _(spark, d):
    """Engines without a window of 70 rows."""
    return latest_window_rejects(events(spark, d), Profile(window_l=70, features=SHORT.features))


@query("score_latest_with_network", f"""WITH {EV} SELECT engine_id, max(cycle) AS cycle, TRUE AS consistent, count(*) FILTER (back <= 10 AND sensor_2 = 99) = 0 AS scored,
  CASE WHEN count(*) FILTER (back <= 10 AND sensor_2 = 99) > 0 THEN 'not finite' END AS reject_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) AS back FROM ev) GROUP BY engine_id""")
def _(spark, d):
    """Newest windows by a saved and reloaded network; readings of 99 are spoiled, and such windows come back with a reason."""
    root, df = scratch(spark, "models"), events(spark, d)
    train_window_model(df, TRIAL, root=root)
    model, metadata = load_active_model(spark, "seq", root)
    spoiled = df.withColumn("sensor_2", F.when(F.col("sensor_2") == 99, float("nan")).otherwise(F.col("sensor_2")))
    responses, rejected = score_latest_with_network(spoiled, model, metadata)
    scored = _consistent(responses).select(*KEY, F.lit(True).alias("scored"), "consistent", F.lit(None).cast("string").alias("reject_reason"))
    return scored.union(rejected.select(*KEY, F.lit(False), F.lit(True), "reject_reason"))


ARRIVALS = 3


def _arrivals(spark, d):
    """The fleet cut by cycle into the files of three deliveries."""
    df = events(spark, d)
    span = df.agg(F.max("cycle")).first()[0] // ARRIVALS + 1
    return [df.where((F.col("cycle") > i * span) & (F.col("cycle") <= (i + 1) * span)) for i in range(ARRIVALS)]


def _deliver(spark, d, start):
    """Write one delivery after another; after each, run the stream until it has read everything."""
    source = scratch(spark, "arrivals")
    for part in _arrivals(spark, d):
        part.write.mode("append").parquet(source)
        start(spark.readStream.schema(part.schema).parquet(source)).awaitTermination()


STREAM_STATS = ("mean", "std", "var", "sum", "min", "max", "median", "count")
STREAM_SIGNALS = ["sensor_1", "sensor_3"]
STREAM_SPEC = FeatureSpec(windows=(3, 7), stats=STREAM_STATS)
STREAM_COLUMNS = feature_columns(EVENT_SIGNALS, SHORT.features.windows)
ALL_STREAM_COLUMNS = feature_columns(STREAM_SIGNALS, (3, 7), STREAM_STATS)


@query("stream_features", f"WITH {EV}, f AS ({feature_sql(EVENT_SIGNALS, 'ev', SHORT.features.windows)}) SELECT *, 0::BIGINT AS dropped FROM f",
       feature_places(STREAM_COLUMNS))
def _(spark, d):
    """The engines' last rows carry the features across three deliveries; the result equals the batch features."""
    out, state, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-engines"), scratch(spark, "stream-state")
    _deliver(spark, d, lambda stream: stream_features(stream, SHORT.features, parquet_sink(out), state, checkpoint))
    return spark.read.parquet(out).drop("batch")


@query("stream_all_statistics", f"WITH {EV}, f AS ({feature_sql(STREAM_SIGNALS, 'ev', (3, 7), STREAM_STATS)}) SELECT *, 0::BIGINT AS dropped FROM f",
       {c: {"sensor_1__roll3__var": 5, "sensor_1__roll7__var": 5, "sensor_3__roll3__var": 2, "sensor_3__roll7__var": 2}.get(c, 3 if c.endswith(("std", "var")) else 5)
        for c in ALL_STREAM_COLUMNS})
def _(spark, d):
    """All eight statistics, with a version of all engines after every second micro-batch."""
    out, state, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-engines"), scratch(spark, "stream-state")
    _deliver(spark, d, lambda stream: stream_features(
        stream.select(*KEY, *STREAM_SIGNALS), STREAM_SPEC, parquet_sink(out), state, checkpoint, all_every=2))
    return spark.read.parquet(out).drop("batch")


@query("stream_late_rows", f"""WITH {EV}, f AS ({feature_sql(['sensor_1'], 'ev', (3,))}),
  spans AS (SELECT max(cycle) // 3 + 1 AS span FROM ev),
  late AS (SELECT engine_id, cycle, d FROM ev, spans, (SELECT unnest([1, 2]) AS d) WHERE cycle <= d * span AND cycle % 5 = 0)
  SELECT f.*, (SELECT count(*) FROM late WHERE late.engine_id = f.engine_id AND late.d <= (f.cycle - 1) // span)::BIGINT AS dropped
  FROM f, spans""", feature_places(feature_columns(["sensor_1"], (3,))))
def _(spark, d):
    """Each later delivery repeats every fifth cycle delivered before, with other values: dropped and counted, and without effect.
    The second micro-batch is then run again, which changes nothing."""
    out, state, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-engines"), scratch(spark, "stream-state")
    source, spec = scratch(spark, "arrivals"), FeatureSpec(windows=(3,))
    df = events(spark, d).select(*KEY, "sensor_1")
    span = df.agg(F.max("cycle")).first()[0] // ARRIVALS + 1
    for i, part in enumerate(_arrivals(spark, d)):
        again = df.where((F.col("cycle") <= i * span) & (F.col("cycle") % 5 == 0)).withColumn("sensor_1", F.lit(-1e9))
        part.select(*KEY, "sensor_1").unionByName(again).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        stream_features(stream, spec, parquet_sink(out), state, checkpoint).awaitTermination()
    engines = EngineRows(spark, state, ["sensor_1"], spec.history(), 20)
    late = df.where((F.col("cycle") <= span) & (F.col("cycle") % 5 == 0)).withColumn("sensor_1", F.lit(-1e9))
    batch_features(_arrivals(spark, d)[1].select(*KEY, "sensor_1").unionByName(late), 1, spec, engines, parquet_sink(out))
    return spark.read.parquet(out).drop("batch")


@query("stream_score_alerts", f"""WITH {EV} SELECT engine_id, cycle, cycle >= 10 AS scored, TRUE AS consistent FROM ev""")
def _(spark, d):
    """Responses and rejects of all micro-batches: every row of the fleet is in one of them."""
    run = train_select_report(events(spark, d), TRIAL, candidates=("logreg",))
    out, state, checkpoint = scratch(spark, "alerts"), scratch(spark, "stream-engines"), scratch(spark, "stream-state")
    _deliver(spark, d, lambda stream: stream_score_alerts(
        stream, SHORT.features, run["model"], run["metadata"], out, state, checkpoint, alerts_only=False))
    yes = F.lit(True)
    responses = _consistent(spark.read.parquet(out)).withColumn("scored", yes)
    rejected = spark.read.parquet(f"{out}_rejected").select(*KEY, yes.alias("consistent"), F.lit(False).alias("scored"))
    return responses.unionByName(rejected)
