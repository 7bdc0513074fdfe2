"""Metrics, thresholds, calibration, top-k, errors and model choice over scored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    AN, AP_SQL, EVL, KEY, ROC_SQL, SC, anomaly_scored, events_labeled, query, scored, sweep_sql,
)
from fleethazard.functions.scalar import ceil_count, digitize, linspace_edges
from fleethazard.operators.metrics import (
    brier_score, calibration_bins, calibration_edges, check_score_range, class_balanced_weights, compute_metrics,
    confusion_matrix, early_stop_best_epoch, eval_sequence_metrics, log_loss_with_logits, overfit_gap, select_best_model,
    split_base_rate, top_anomalies, top_errors, top_fraction, topk_lift, with_precision_recall_f1,
)
from fleethazard.operators.sweep import (
    average_precision, distinct_scores, pr_curve, ranking_metrics, roc_auc, score_running_counts, threshold_sweep,
    thresholds_highest, thresholds_max_precision, thresholds_target_recall,
)
from fleethazard.catalog.tables import METRIC_SQL

G = ["model", "split"]
SW, SWE = f"WITH {SC}, {sweep_sql()}", f"WITH {SC}, {sweep_sql(ends=True)}"
CM = """SELECT model, split,
  count(*) FILTER (WHERE label = 0 AND y_proba < 5e-1) AS tn, count(*) FILTER (WHERE label = 0 AND y_proba >= 5e-1) AS fp,
  count(*) FILTER (WHERE label = 1 AND y_proba < 5e-1) AS fn, count(*) FILTER (WHERE label = 1 AND y_proba >= 5e-1) AS tp
  FROM sc GROUP BY ALL"""


@query("distinct_scores", f"WITH {SC} SELECT model, split, threshold FROM (SELECT model, split, y_proba AS threshold FROM sc "
       "UNION SELECT DISTINCT model, split, unnest([0e0, 1e0]) FROM sc)")
def _(spark, d):
    return distinct_scores(scored(spark, d), group=G)


@query("threshold_sweep", f"{SWE} SELECT * FROM sw", ["precision", "recall"])
def _(spark, d):
    return threshold_sweep(scored(spark, d), group=G)


@query("pr_curve", f"{SW} SELECT model, split, threshold, precision, recall FROM sw", ["precision", "recall"])
def _(spark, d):
    return pr_curve(scored(spark, d), group=G)


@query("score_running_counts", f"{SW} SELECT model, split, threshold, tp, fp FROM sw")
def _(spark, d):
    return score_running_counts(scored(spark, d), group=G)


@query("confusion_matrix", f"WITH {SC} {CM}")
def _(spark, d):
    return confusion_matrix(scored(spark, d), 0.5, group=G)


@query("precision_recall_f1", f"""WITH {SC}, cm AS ({CM}) SELECT *,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0e0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0e0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1 FROM cm""", ["precision", "recall", "f1"])
def _(spark, d):
    return with_precision_recall_f1(confusion_matrix(scored(spark, d), 0.5, group=G))


@query("average_precision", f"{SW} SELECT model, split, {AP_SQL} AS pr_auc FROM sw GROUP BY ALL", ["pr_auc"])
def _(spark, d):
    return average_precision(scored(spark, d), group=G)


@query("roc_auc", f"{SW} SELECT model, split, {ROC_SQL} AS roc_auc FROM sw GROUP BY ALL", ["roc_auc"])
def _(spark, d):
    return roc_auc(scored(spark, d), group=G)


@query("brier_score", f"WITH {SC} SELECT model, split, avg((y_proba - label) * (y_proba - label)) AS brier FROM sc GROUP BY ALL", ["brier"])
def _(spark, d):
    return brier_score(scored(spark, d), group=G)


@query("compute_metrics", METRIC_SQL + """ SELECT model, split, pr_auc, roc_auc, precision, recall, f1,
  tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp, brier FROM mt""",
       ["pr_auc", "roc_auc", "precision", "recall", "f1", "brier"])
def _(spark, d):
    return compute_metrics(scored(spark, d), 0.5, group=G)


LOGIT_SQL = "lg AS (SELECT engine_id, cycle, split, label, (y_proba - 5e-1) * 6e0 AS logit FROM sc WHERE model = 'a')"
LOSS_SQL = f"""{LOGIT_SQL}, ls AS (SELECT *, greatest(logit, 0e0) + ln(1e0 + exp(-abs(logit))) - label * logit AS l,
    row_number() OVER (PARTITION BY split ORDER BY engine_id, cycle) - 1 AS i FROM lg),
  bt AS (SELECT split, i // 32 AS b, avg(l) AS m FROM ls GROUP BY ALL),
  bl AS (SELECT split, avg(m) AS loss FROM bt GROUP BY split)"""


def _logits(spark, d):
    df = scored(spark, d).where("model = 'a'")
    return df.select(*KEY, "split", "label", ((F.col("y_proba") - 0.5) * 6.0).alias("logit"))


ORDER = ("engine_id", "cycle")


@query("log_loss_with_logits", f"WITH {SC}, {LOSS_SQL}, rl AS (SELECT split, avg(l) AS row_loss FROM ls GROUP BY split) "
       "SELECT split, loss, row_loss FROM bl JOIN rl USING (split)", ["loss", "row_loss"])
def _(spark, d):
    return log_loss_with_logits(_logits(spark, d), [F.col(c) for c in ORDER], group=["split"])


@query("eval_sequence_metrics", f"""WITH {SC}, {LOSS_SQL}, sc2 AS (SELECT split, label, 1e0 / (1e0 + exp(-logit)) AS y_proba FROM lg),
  {sweep_sql(["split"], "sc2")}, ap AS (SELECT split, {AP_SQL} AS pr_auc FROM sw GROUP BY split),
  cm AS (SELECT split, count(*) FILTER (WHERE label = 0 AND y_proba >= 6e-1) AS fp,
    count(*) FILTER (WHERE label = 1 AND y_proba < 6e-1) AS fn, count(*) FILTER (WHERE label = 1 AND y_proba >= 6e-1) AS tp
    FROM sc2 GROUP BY split)
  SELECT split, loss, pr_auc, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0e0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0e0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1
  FROM bl JOIN ap USING (split) JOIN cm USING (split)""", ["loss", "pr_auc", "precision", "recall", "f1"])
def _(spark, d):
    return eval_sequence_metrics(_logits(spark, d), [F.col(c) for c in ORDER], 0.6, group=["split"])


@query("select_threshold_max_precision", f"""{SWE}, ok AS (SELECT * FROM sw WHERE recall >= 8.5e-1 AND precision >= 3e-1),
  bs AS (SELECT model, split, threshold FROM ok QUALIFY row_number() OVER (PARTITION BY model, split ORDER BY precision DESC, threshold DESC) = 1)
  SELECT model, split, threshold FROM (SELECT DISTINCT model, split FROM sw) LEFT JOIN bs USING (model, split)""")
def _(spark, d):
    return thresholds_max_precision(scored(spark, d), 0.85, 0.30, group=G)


@query("select_threshold_highest", f"""{SW} SELECT model, split,
  max(threshold) FILTER (WHERE recall >= 8.5e-1 AND precision >= 3e-1) AS threshold FROM sw GROUP BY ALL""")
def _(spark, d):
    return thresholds_highest(scored(spark, d), 0.85, 0.30, group=G)


@query("select_threshold_target_recall", f"""{SW} SELECT model, split,
  coalesce(max(threshold) FILTER (WHERE positives > 0 AND recall >= 8.5e-1), 1e0) AS threshold FROM sw GROUP BY ALL""")
def _(spark, d):
    return thresholds_target_recall(scored(spark, d), 0.85, group=G)


EDGE_SQL = """ed AS (SELECT model, split, list_sort(list_distinct([0e0, 1e0] || quantile_cont(y_proba, [1e-1, 2e-1, 3e-1, 4e-1, 5e-1, 6e-1, 7e-1, 8e-1, 9e-1])))
  AS edges FROM sc GROUP BY ALL)"""
BIN_SQL = """SELECT model, split, len(list_filter(edges[2:len(edges) - 1], lambda e: e < y_proba))::INTEGER AS bin_idx, count(*) AS count,
  avg(y_proba) AS mean_pred, avg(label) AS frac_pos FROM sc JOIN ed USING (model, split) GROUP BY ALL"""


@query("calibration_bins", f"WITH {SC}, {EDGE_SQL} {BIN_SQL}", ["mean_pred", "frac_pos"])
def _(spark, d):
    return calibration_bins(scored(spark, d), 10, "quantile", group=G)


UNIFORM = "ed AS (SELECT DISTINCT model, split, list_transform(range(0, 11), lambda i: i / 1e1) AS edges FROM sc)"


@query("calibration_bins_uniform", f"WITH {SC}, {UNIFORM} {BIN_SQL}", ["mean_pred", "frac_pos"])
def _(spark, d):
    return calibration_bins(scored(spark, d), 10, "uniform", group=G)


@query("calibration_bins_unpinned", f"""WITH {SC}, ed AS (SELECT model, split, list_sort(list_distinct(
    quantile_cont(y_proba, [0e0, 1e-1, 2e-1, 3e-1, 4e-1, 5e-1, 6e-1, 7e-1, 8e-1, 9e-1, 1e0]))) AS edges FROM sc GROUP BY ALL) {BIN_SQL}""",
       ["mean_pred", "frac_pos"])
def _(spark, d):
    """The plotted variant: the outer edges stay at the extreme scores."""
    return calibration_bins(scored(spark, d), 10, "quantile", group=G, pin_ends=False)


@query("quantile_edges", f"WITH {SC}, {EDGE_SQL} SELECT model, split, unnest(edges) AS edge FROM ed", ["edge"])
def _(spark, d):
    edges = calibration_edges(scored(spark, d), 10, "quantile", group=G)
    return edges.select(*G, F.explode("edges").alias("edge"))


@query("linspace_edges", f"""WITH {SC}, {UNIFORM} SELECT model, split, unnest(edges) AS edge FROM ed""", ["edge"])
def _(spark, d):
    edges = calibration_edges(scored(spark, d), 10, "uniform", group=G)
    return edges.select(*G, F.explode("edges").alias("edge"))


@query("digitize", f"""WITH {SC} SELECT engine_id, cycle, model,
  len(list_filter(list_transform(range(1, 10), lambda i: i / 1e1), lambda e: e < y_proba))::INTEGER AS bin_idx FROM sc""")
def _(spark, d):
    edges = F.slice(linspace_edges(10), 2, 9)
    return scored(spark, d).select(*KEY, "model", digitize(F.col("y_proba"), edges).alias("bin_idx"))


@query("ceil_count", f"WITH {AN} SELECT split, greatest(1, ceil(1e-2 * count(*)))::BIGINT AS m1, greatest(1, ceil(5e-2 * count(*)))::BIGINT AS m5 FROM an GROUP BY split")
def _(spark, d):
    n = anomaly_scored(spark, d).groupBy("split").agg(F.count("*").alias("n"))
    return n.select("split", ceil_count(F.col("n"), 0.01).alias("m1"), ceil_count(F.col("n"), 0.05).alias("m5"))


RANKED = """rn AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY anomaly_score DESC, engine_id, cycle) AS rank,
  count(*) OVER (PARTITION BY split) AS n FROM an)"""


@query("topk_lift", f"""WITH {AN}, {RANKED}, ks AS (SELECT unnest([1e-2, 5e-2]) AS k),
  ag AS (SELECT split, k, count(*) AS n, sum(label)::BIGINT AS positives, max(greatest(1, ceil(k * n)))::BIGINT AS m,
    sum(CASE WHEN rank <= greatest(1, ceil(k * n)) THEN label ELSE 0 END) AS tp FROM rn, ks GROUP BY ALL)
  SELECT split, k, n, positives, m, tp::DOUBLE / m AS precision,
    CASE WHEN positives > 0 THEN (tp::DOUBLE / m) / (positives::DOUBLE / n) END AS lift,
    CASE WHEN positives > 0 THEN tp::DOUBLE / positives END AS capture FROM ag""", ["precision", "lift", "capture"])
def _(spark, d):
    return topk_lift(anomaly_scored(spark, d))


@query("top_fraction", f"WITH {AN}, {RANKED} SELECT engine_id, cycle, label, remaining, split, anomaly_score, rank FROM rn WHERE rank <= greatest(1, ceil(5e-2 * n))")
def _(spark, d):
    return top_fraction(anomaly_scored(spark, d), 0.05, group=["split"])


@query("top_anomalies", f"WITH {AN}, {RANKED} SELECT engine_id, cycle, label, remaining, split, anomaly_score, rank::INTEGER AS rank FROM rn WHERE rank <= 10")
def _(spark, d):
    return top_anomalies(anomaly_scored(spark, d))


@query("split_base_rate", f"WITH {AN} SELECT split, count(*) AS n, sum(label)::BIGINT AS positives, avg(label) AS base_rate FROM an GROUP BY split", ["base_rate"])
def _(spark, d):
    return split_base_rate(anomaly_scored(spark, d))


@query("class_balanced_weights", f"""WITH {EVL} SELECT label, count(*) AS n_class,
  (SELECT count(*) FROM evl) / (2e0 * count(*)) AS weight FROM evl GROUP BY label""", ["weight"])
def _(spark, d):
    return class_balanced_weights(events_labeled(spark, d))


AREA = f"{SW}, area AS (SELECT model, split, {AP_SQL} AS pr_auc FROM sw GROUP BY ALL)"


@query("overfit_gap", f"""{AREA} SELECT model, max(CASE WHEN split = 'train' THEN pr_auc END) AS train_pr_auc,
  max(CASE WHEN split = 'val' THEN pr_auc END) AS val_pr_auc,
  max(CASE WHEN split = 'train' THEN pr_auc END) - max(CASE WHEN split = 'val' THEN pr_auc END) AS gap FROM area GROUP BY model""",
       ["train_pr_auc", "val_pr_auc", "gap"])
def _(spark, d):
    return overfit_gap(ranking_metrics(scored(spark, d), group=G))


@query("select_best_model", f"{AREA} SELECT model, pr_auc AS val_pr_auc FROM area WHERE split = 'val' ORDER BY pr_auc DESC, model LIMIT 1", ["val_pr_auc"])
def _(spark, d):
    return select_best_model(ranking_metrics(scored(spark, d), group=G), ["a", "b"])


@query("check_score_range", f"WITH {SC} SELECT model, split, count(*) FILTER (WHERE y_proba IS NULL OR y_proba < 0 OR y_proba > 1) AS violations FROM sc GROUP BY ALL")
def _(spark, d):
    return check_score_range(scored(spark, d), group=G)


@query("top_errors", f"""WITH {SC}, er AS (SELECT model, engine_id, cycle, y_proba, label, (y_proba >= 5e-1)::INTEGER AS y_pred, remaining FROM sc),
  wr AS (SELECT *, CASE WHEN y_pred = 1 THEN 'fp' ELSE 'fn' END AS error FROM er WHERE y_pred <> label),
  rn AS (SELECT *, row_number() OVER (PARTITION BY model, error ORDER BY y_proba DESC, engine_id, cycle)::INTEGER AS rank FROM wr)
  SELECT *, CASE WHEN error = 'fp' THEN CASE WHEN remaining > 0 AND remaining <= 10 THEN 'premature_alarm'
    WHEN remaining <= 0 THEN 'at_or_past_failure' ELSE 'noise_fp' END END AS fp_kind FROM rn WHERE rank <= 20""")
def _(spark, d):
    df = scored(spark, d).withColumn("y_pred", (F.col("y_proba") >= 0.5).cast("int"))
    return top_errors(df, horizon_n=8, early_alarm_slack=2, top_k=20, group=["model"])


def _history(spark, d):
    """A training history per split: one epoch per cycle of remaining life, its loss and PR-AUC from the events."""
    df = scored(spark, d).where("model = 'a'")
    return df.groupBy("split", F.col("remaining").alias("epoch")).agg(
        (F.floor(F.avg("y_proba") * 20) / 20).alias("val_pr_auc"), (F.count("*") / 100).alias("val_loss"))


@query("early_stop_best_epoch", f"""WITH RECURSIVE {SC}, h AS (SELECT split, remaining AS epoch, floor(avg(y_proba) * 20) / 20 AS val_pr_auc,
    count(*) / 1e2 AS val_loss FROM sc WHERE model = 'a' GROUP BY ALL),
  walk AS (SELECT split, epoch, val_pr_auc AS a, val_loss AS l, epoch AS best, 0 AS stale FROM h WHERE epoch = 0
    UNION ALL
    SELECT w.split, h.epoch,
      CASE WHEN h.val_pr_auc > w.a OR (h.val_pr_auc = w.a AND h.val_loss < w.l) THEN h.val_pr_auc ELSE w.a END,
      CASE WHEN h.val_pr_auc > w.a OR (h.val_pr_auc = w.a AND h.val_loss < w.l) THEN h.val_loss ELSE w.l END,
      CASE WHEN h.val_pr_auc > w.a OR (h.val_pr_auc = w.a AND h.val_loss < w.l) THEN h.epoch ELSE w.best END,
      CASE WHEN h.val_pr_auc > w.a OR (h.val_pr_auc = w.a AND h.val_loss < w.l) THEN 0 ELSE w.stale + 1 END
    FROM walk w JOIN h ON h.split = w.split AND h.epoch = w.epoch + 1 WHERE w.stale < 5)
  SELECT split, arg_max(best, epoch) AS best_epoch, arg_max(a, epoch) AS best_val_pr_auc, arg_max(l, epoch) AS best_val_loss,
    count(*) AS epochs_run FROM walk GROUP BY split""", ["best_val_pr_auc", "best_val_loss"])
def _(spark, d):
    return early_stop_best_epoch(_history(spark, d), 5, group=["split"])
