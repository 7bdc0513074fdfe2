"""Scans, sinks, projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    AN, AP_SQL, DEFAULT, EV, EVENT_SIGNALS, EVL, KEY, LI, LIL, LINE_SIGNALS, ROC_SQL, SC, SHORT,
    anomaly_scored, events, events_labeled, feature_columns, feature_places, feature_sql, lines, lines_labeled, query,
    scored, scratch, split_sql, sweep_sql,
)
from fleethazard.functions.columns import model_feature_columns, sequence_feature_columns, signal_columns
from fleethazard.functions.policy import apply_policy
from fleethazard.functions.scalar import is_finite, nonfinite_to_null, predict_at, risk_bucket, sigmoid
from fleethazard.operators.features import build_tabular_features, feature_frame, filter_min_history
from fleethazard.operators.metrics import compute_metrics, metrics_long
from fleethazard.operators.requests import parse_window_json, request_features, validate_window_request
from fleethazard.operators.scaling import (
    fit_median_imputer, fit_scaler, impute_median, median_params, scaler_params, standardize,
)
from fleethazard.operators.sequences import filter_index_by_engine_ids, sequence_index
from fleethazard.operators.splits import cap_engines_per_split, semi_join_split, split_engines
from fleethazard.plans.tables import join_features_labels, join_remaining_left
from fleethazard.sources.tables import (
    ingest_processed, scan_label_columns, scan_parquet, scan_raw_sensor_text, write_metrics_table, write_parquet_table,
    write_raw_sensor_text,
)

S, E = SHORT.features, ", ".join(EVENT_SIGNALS)
EV_FEATURES = feature_columns(EVENT_SIGNALS, S.windows)
EV_PLACES = feature_places(EV_FEATURES)


@query("scan_parquet", "SELECT * FROM lineitem")
def _(spark, d):
    return scan_parquet(spark, f"{d}/lineitem.parquet")


@query("scan_label_columns", f"WITH {EVL} SELECT engine_id, cycle, label, remaining FROM evl")
def _(spark, d):
    path = scratch(spark, "labeled")
    write_parquet_table(events_labeled(spark, d), path)
    return scan_label_columns(spark, path)


@query("scan_raw_sensor_text", f"WITH {LI} SELECT * FROM li")
def _(spark, d):
    path = scratch(spark, "raw")
    write_raw_sensor_text(lines(spark, d), path)
    return scan_raw_sensor_text(spark, path, [*KEY, *LINE_SIGNALS])


@query("ingest_processed", f"WITH {LI} SELECT * FROM li")
def _(spark, d):
    raw = scratch(spark, "raw")
    write_raw_sensor_text(lines(spark, d), raw)
    return ingest_processed(spark, raw, scratch(spark, "processed"), [*KEY, *LINE_SIGNALS])


@query("write_parquet_table", f"WITH {LIL} SELECT engine_id, cycle, failure_cycle, remaining, label FROM lil")
def _(spark, d):
    labeled = lines_labeled(spark, d).select(*KEY, "failure_cycle", "remaining", "label")
    return write_parquet_table(labeled, scratch(spark, "labeled"))


METRIC_SQL = f"""WITH {SC}, {sweep_sql()},
area AS (SELECT model, split, {AP_SQL} AS pr_auc, {ROC_SQL} AS roc_auc FROM sw GROUP BY ALL),
cm AS (SELECT model, split,
  count(*) FILTER (WHERE label = 0 AND y_proba < 5e-1)::DOUBLE AS tn, count(*) FILTER (WHERE label = 0 AND y_proba >= 5e-1)::DOUBLE AS fp,
  count(*) FILTER (WHERE label = 1 AND y_proba < 5e-1)::DOUBLE AS fn, count(*) FILTER (WHERE label = 1 AND y_proba >= 5e-1)::DOUBLE AS tp,
  avg((y_proba - label) * (y_proba - label)) AS brier FROM sc GROUP BY ALL),
mt AS (SELECT model, split, pr_auc, roc_auc,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1, tn, fp, fn, tp, brier
  FROM cm JOIN area USING (model, split))"""


@query("write_metrics_table", METRIC_SQL + """ SELECT * FROM mt
  UNPIVOT INCLUDE NULLS (value FOR metric IN (pr_auc, roc_auc, precision, recall, f1, tn, fp, fn, tp, brier))""", ["value"])
def _(spark, d):
    long = metrics_long(compute_metrics(scored(spark, d), 0.5, group=["model", "split"]), ["model", "split"])
    return write_metrics_table(long, scratch(spark, "metrics"))


@query("signal_columns", f"WITH {EV} SELECT engine_id, cycle, {E} FROM ev")
def _(spark, d):
    df = events(spark, d)
    return df.select(*KEY, *signal_columns(df))


@query("sequence_feature_columns", f"WITH {EV} SELECT engine_id, cycle, {E} FROM ev")
def _(spark, d):
    df = events(spark, d)
    return df.select(*KEY, *sequence_feature_columns(df))


@query("model_feature_columns", f"WITH {EVL} SELECT {E} FROM evl")
def _(spark, d):
    df = events_labeled(spark, d)
    return df.select(*model_feature_columns(df))


@query("label_horizon", f"WITH {LIL} SELECT * FROM lil")
def _(spark, d):
    return lines_labeled(spark, d)


@query("filter_min_history", f"WITH {LI} SELECT * FROM li WHERE cycle >= 50")
def _(spark, d):
    return filter_min_history(lines(spark, d), DEFAULT.features, DEFAULT.window_l)


@query("predict_at_threshold", f"WITH {SC} SELECT engine_id, cycle, model, CAST(y_proba >= 5e-1 AS INTEGER) AS y_pred FROM sc")
def _(spark, d):
    return scored(spark, d).select(*KEY, "model", predict_at(F.col("y_proba"), 0.5).alias("y_pred"))


BUCKET = "CASE WHEN y_proba < 2e-1 THEN 'low' WHEN y_proba < 5e-1 THEN 'med' ELSE 'high' END"


@query("risk_bucket", f"WITH {SC} SELECT engine_id, cycle, model, {BUCKET} AS bucket FROM sc")
def _(spark, d):
    return scored(spark, d).select(*KEY, "model", risk_bucket(F.col("y_proba"), [0.2, 0.5]).alias("bucket"))


@query("apply_policy", f"""WITH {SC} SELECT engine_id, cycle, model, y_proba, {BUCKET} AS bucket, 3e-1 AS threshold,
  y_proba >= 3e-1 AS is_alert FROM sc""")
def _(spark, d):
    return apply_policy(scored(spark, d).select(*KEY, "model", "y_proba"), 0.3, [0.2, 0.5])


@query("cap_engines_per_split", f"""WITH {EV}, {split_sql('ev')} SELECT * FROM sp
  WHERE split_rank <= CASE split WHEN 'train' THEN 20 WHEN 'val' THEN 5 ELSE 1000000 END""")
def _(spark, d):
    return cap_engines_per_split(split_engines(events(spark, d)), {"train": 20, "val": 5})


# every fifth value turns infinite or NaN, to have something to clean
SPOILED = "CASE WHEN sensor_2 < 10 THEN 'inf'::DOUBLE WHEN sensor_2 < 20 THEN 'nan'::DOUBLE ELSE sensor_1 END"


def _spoiled(df):
    return F.when(F.col("sensor_2") < 10, float("inf")).when(F.col("sensor_2") < 20, float("nan")).otherwise(F.col("sensor_1"))


@query("nonfinite_to_null", f"WITH {EV} SELECT engine_id, cycle, CASE WHEN sensor_2 >= 20 THEN sensor_1 END AS x FROM ev")
def _(spark, d):
    df = events(spark, d)
    return df.select(*KEY, nonfinite_to_null(_spoiled(df)).alias("x"))


def request_bodies(spark, d):
    """All rows as JSON requests of ten cycles each; short blocks and wild values give faulty ones."""
    # a window has 10 rows, 9 when its first reading is above 30
    first = F.max(F.when(F.col("cycle") % 10 == 1, F.col("sensor_1")))
    block = F.expr("engine_id * 1000000 + (cycle - 1) div 10")
    steps = events(spark, d).groupBy(block.alias("engine_id")).agg(
        F.array_sort(F.collect_list(F.struct("cycle", "sensor_1", "sensor_2", "sensor_3"))).alias("steps"),
        first.alias("first"))
    row = lambda s: F.create_map(
        F.lit("sensor_1"), F.when(s["sensor_3"] >= 3595, F.lit(float("nan"))).otherwise(s["sensor_1"]),
        F.when(s["sensor_2"] == 99, "other").otherwise("sensor_2"), s["sensor_2"])
    window = F.transform(F.slice("steps", F.lit(1), F.when(F.col("first") > 30, 9).otherwise(10)), row)
    return steps.select(F.col("engine_id").alias("request_id"), F.to_json(F.struct(window.alias("window"))).alias("body"))


REQ = f"""{EV}, bk AS (SELECT * REPLACE (engine_id * 1000000 + (cycle - 1) // 10 AS engine_id, (cycle - 1) % 10 + 1 AS cycle) FROM ev),
fr AS (SELECT *, max(CASE WHEN cycle = 1 THEN sensor_1 END) OVER (PARTITION BY engine_id) AS first FROM bk),
rq AS (SELECT * FROM fr WHERE cycle <= CASE WHEN first > 30 THEN 9 ELSE 10 END),
rr AS (SELECT engine_id AS request_id,
  CASE WHEN count(*) <> 10 THEN 'wrong length' WHEN max((sensor_2 = 99)::INT) = 1 THEN 'missing keys'
       WHEN max((sensor_3 >= 3595)::INT) = 1 THEN 'not finite' END AS reject_reason,
  count(*)::INTEGER AS n_rows FROM rq GROUP BY ALL)"""


@query("parse_window_json", f"""WITH {REQ} SELECT engine_id AS request_id, count(*)::INTEGER AS n_rows,
  sum(CASE WHEN sensor_2 <> 99 THEN sensor_2 ELSE 0 END) AS sum_sensor_2 FROM rq GROUP BY ALL""", ["sum_sensor_2"])
def _(spark, d):
    total = F.aggregate("window", F.lit(0.0), lambda acc, m: acc + F.coalesce(m["sensor_2"], F.lit(0.0)))
    return parse_window_json(request_bodies(spark, d)).select(
        "request_id", F.size("window").alias("n_rows"), total.alias("sum_sensor_2"))


@query("validate_window_request", f"WITH {REQ} SELECT request_id, reject_reason FROM rr")
def _(spark, d):
    parsed = parse_window_json(request_bodies(spark, d))
    return validate_window_request(parsed, ["sensor_1", "sensor_2"], 10).select("request_id", "reject_reason")


RQ_FEATURES = feature_columns(["sensor_1", "sensor_2"], S.windows)


@query("score_window_requests", f"""WITH {REQ}, ok AS (SELECT rq.* FROM rq JOIN rr ON rq.engine_id = rr.request_id
    WHERE reject_reason IS NULL),
  f AS ({feature_sql(["sensor_1", "sensor_2"], "ok", S.windows)})
  SELECT request_id, reject_reason, {", ".join(f'"{c}"' for c in RQ_FEATURES)} FROM rr LEFT JOIN f
  ON rr.request_id = f.engine_id AND f.cycle = 10""", feature_places(RQ_FEATURES))
def _(spark, d):
    """Valid requests with their features, faulty ones with the reason (the score itself needs a fitted model)."""
    good, bad = request_features(parse_window_json(request_bodies(spark, d)), ["sensor_1", "sensor_2"], S, 10)
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query("join_features_labels", f"""WITH {EVL}, f AS ({feature_sql(EVENT_SIGNALS, "ev", S.windows)})
  SELECT f.*, label FROM f JOIN evl USING (engine_id, cycle)""", EV_PLACES)
def _(spark, d):
    features = build_tabular_features(events(spark, d), S, SHORT.window_l)
    return join_features_labels(features, events_labeled(spark, d).select(*KEY, "label"))


@query("join_remaining_left", f"WITH {SC} SELECT engine_id, cycle, model, y_proba, remaining FROM sc WHERE split = 'test'")
def _(spark, d):
    test = scored(spark, d).where("split = 'test'").select(*KEY, "model", "y_proba")
    return join_remaining_left(test, events_labeled(spark, d))


@query("semi_join_split", f"WITH {LI}, {split_sql('li')} SELECT * FROM li WHERE engine_id IN (SELECT engine_id FROM sp WHERE split = 'val')")
def _(spark, d):
    df = lines(spark, d)
    return semi_join_split(df, split_engines(df), "val")


@query("filter_index_by_engine_ids", f"""WITH {EVL}, {split_sql('ev')} SELECT engine_id, cycle AS pred_cycle, end_pos FROM
  (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle) - 1 AS end_pos FROM evl)
  WHERE end_pos >= 9 AND engine_id IN (SELECT engine_id FROM sp WHERE split = 'test')""")
def _(spark, d):
    split = split_engines(events(spark, d)).where("split = 'test'")
    return filter_index_by_engine_ids(sequence_index(events_labeled(spark, d), 10), split)


def _scaler(spark, d):
    df = lines(spark, d)
    return df, fit_scaler(semi_join_split(df, split_engines(df), "train"), LINE_SIGNALS)


def _scaler_sql(signals, source, stat="avg({s}) AS m_{s}, stddev_pop({s}) AS s_{s}"):
    return (f"st AS (SELECT {', '.join(stat.format(s=s) for s in signals)} FROM {source} JOIN sp USING (engine_id) "
            "WHERE split = 'train')")


Z = ", ".join(f"({s} - m_{s}) / CASE WHEN s_{s} = 0 THEN 1e0 ELSE s_{s} END AS {s}" for s in LINE_SIGNALS)


@query("apply_train_stats", f"WITH {LI}, {split_sql('li')}, {_scaler_sql(LINE_SIGNALS, 'li')} SELECT engine_id, cycle, {Z} FROM li, st",
       LINE_SIGNALS)
def _(spark, d):
    df, fitted = _scaler(spark, d)
    return standardize(df, scaler_params(fitted))


ZE = ", ".join(f"({s} - m_{s}) / CASE WHEN s_{s} = 0 THEN 1e0 ELSE s_{s} END AS {s}" for s in EVENT_SIGNALS)


@query("standardize", f"WITH {EV}, {split_sql('ev')}, {_scaler_sql(EVENT_SIGNALS, 'ev')} SELECT engine_id, cycle, {ZE} FROM ev, st",
       EVENT_SIGNALS)
def _(spark, d):
    df = events(spark, d)
    fitted = fit_scaler(semi_join_split(df, split_engines(df), "train"), EVENT_SIGNALS)
    return standardize(df, scaler_params(fitted))


@query("fit_scaler", f"WITH {EV}, {split_sql('ev')}, t AS (SELECT ev.* FROM ev JOIN sp USING (engine_id) WHERE split = 'train') "
       + " UNION ALL ".join(f"SELECT '{s}' AS feature, avg({s}) AS mean, CASE WHEN stddev_pop({s}) = 0 THEN 1e0 ELSE stddev_pop({s}) END AS std FROM t"
                            for s in EVENT_SIGNALS), ["mean", "std"])
def _(spark, d):
    df = events(spark, d)
    return fit_scaler(semi_join_split(df, split_engines(df), "train"), EVENT_SIGNALS)


FILLED = ["sensor_1", "sensor_2", "sensor_3", "x"]


def _holes(spark, d):
    df = events(spark, d)
    return df.select(*KEY, "sensor_1", "sensor_2", "sensor_3", _spoiled(df).alias("x"))


HOLES = f"{EV}, {split_sql('ev')}, ho AS (SELECT engine_id, cycle, sensor_1, sensor_2, sensor_3, {SPOILED} AS x FROM ev)"
HOLES_TRAIN = (f"{HOLES}, tr AS (SELECT sensor_1, sensor_2, sensor_3, CASE WHEN isfinite(x) THEN x END AS x "
               "FROM ho JOIN sp USING (engine_id) WHERE split = 'train')")


@query("fit_median_imputer", f"WITH {HOLES_TRAIN} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, median({c}) AS median FROM tr" for c in FILLED), ["median"])
def _(spark, d):
    df = _holes(spark, d)
    return fit_median_imputer(semi_join_split(df, split_engines(df), "train"), FILLED)


@query("impute_median", f"""WITH {HOLES_TRAIN} SELECT engine_id, cycle, sensor_1, sensor_2, sensor_3,
  CASE WHEN isfinite(x) THEN x ELSE (SELECT median(x) FROM tr) END AS x FROM ho""", FILLED)
def _(spark, d):
    df = _holes(spark, d)
    fitted = fit_median_imputer(semi_join_split(df, split_engines(df), "train"), FILLED)
    return impute_median(df, median_params(fitted))


@query("nonfinite_counts", f"""WITH {HOLES} SELECT split, sum(CASE WHEN isnan(x) THEN 1 ELSE 0 END)::BIGINT AS n_nan,
  sum(CASE WHEN isinf(x) THEN 1 ELSE 0 END)::BIGINT AS n_inf FROM ho JOIN sp USING (engine_id) GROUP BY split""")
def _(spark, d):
    from fleethazard.operators.scaling import nonfinite_counts
    from fleethazard.operators.splits import assign_split, fit_split

    df = _holes(spark, d)
    return nonfinite_counts(assign_split(df, fit_split(df)), FILLED)


@query("assemble_feature_columns", f"WITH {EV} {feature_sql(EVENT_SIGNALS, 'ev', S.windows)}", EV_PLACES)
def _(spark, d):
    return feature_frame(events(spark, d), S)


@query("sort_by_key", f"WITH {LI} SELECT * FROM li ORDER BY engine_id, cycle")
def _(spark, d):
    return lines(spark, d).orderBy(*KEY)


@query("score_sigmoid", f"WITH {EV} SELECT engine_id, cycle, 1e0 / (1e0 + exp(-((sensor_1 - 2e1) / 1e1))) AS p FROM ev", ["p"])
def _(spark, d):
    return events(spark, d).select(*KEY, sigmoid((F.col("sensor_1") - 20.0) / 10.0).alias("p"))


@query("union_splits", f"WITH {AN} SELECT engine_id, cycle, label, remaining, anomaly_score, split FROM an")
def _(spark, d):
    """Three tables, one for each split, stacked again under their names."""
    df = anomaly_scored(spark, d).select(*KEY, "label", "remaining", "anomaly_score", "split")
    parts = [df.where(F.col("split") == s).drop("split").withColumn("split", F.lit(s)) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("float32_cast", f"WITH {LI} SELECT engine_id, cycle, CAST(CAST(sensor_2 AS FLOAT) AS DOUBLE) AS x FROM li", ["x"], 4)
def _(spark, d):
    return lines(spark, d).select(*KEY, F.col("sensor_2").cast("float").cast("double").alias("x"))


@query("isfinite", f"WITH {EV} SELECT engine_id, cycle, isfinite({SPOILED}) AS finite FROM ev")
def _(spark, d):
    df = events(spark, d)
    return df.select(*KEY, is_finite(_spoiled(df)).alias("finite"))
