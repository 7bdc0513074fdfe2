import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleethazard.functions.policy import apply_policy
from fleethazard.functions.scalar import risk_bucket
from fleethazard.operators.metrics import (
    brier_score, calibration_bins, compute_metrics, early_stop_best_epoch, eval_sequence_metrics, log_loss_with_logits,
    select_best_model, top_errors, top_fraction, topk_lift,
)
from fleethazard.operators.sweep import (
    PolicyError, pr_curve, ranking_metrics, select_threshold_highest, select_threshold_max_precision,
    select_threshold_target_recall, threshold_sweep, thresholds_max_precision,
)


def test_max_precision_threshold(scores):
    assert select_threshold_max_precision(scores([0, 0, 0, 1, 1], [.1, .2, .3, .8, .9]), 1.0, 0.5) == 0.8


def test_max_precision_impossible(scores):
    with pytest.raises(PolicyError, match="Model too weak for policy"):
        select_threshold_max_precision(scores([0, 0, 0, 1], [.6] * 4), 0.85, 0.5)


def test_highest_threshold(scores):
    assert select_threshold_highest(scores([1, 1, 1, 0, 0, 0], [.9, .8, .7, .6, .4, .2]), 2 / 3, 1.0) == 0.8
    with pytest.raises(PolicyError):
        select_threshold_highest(scores([1, 1, 0], [.9, .8, .85]), 1.0, 1.0)


def test_target_recall_threshold(scores):
    assert select_threshold_target_recall(scores([0, 0, 1, 1], [.1, .4, .6, .9]), 1.0) == 0.6
    assert select_threshold_target_recall(scores([0, 0], [.1, .4]), 0.5) == 1.0


def _brute_sweep(y, p):
    out = {}
    for t in sorted({*p, 0.0, 1.0}):
        pred = p >= t
        tp, fp = int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum())
        out[t] = (tp, fp, tp / (tp + fp) if tp + fp else 0.0, tp / y.sum() if y.sum() else 0.0)
    return out


@pytest.mark.parametrize("seed,ties", [(0, 1), (1, 1), (2, 3)])
def test_sweep_equals_a_rescan_per_threshold(scores, seed, ties):
    rng = np.random.default_rng(seed)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), ties)
    got = {r.threshold: (r.tp, r.fp, r.precision, r.recall) for r in threshold_sweep(scores(y, p)).collect()}
    want = _brute_sweep(y, p)
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t]) for t in want)


def test_areas(scores):
    got = ranking_metrics(scores([1, 0, 1, 0, 1], [.9, .8, .7, .6, .5])).first()
    assert got.pr_auc == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)
    assert got.roc_auc == pytest.approx(3 / 6)


@pytest.mark.parametrize("seed", [0, 1])
def test_roc_equals_pair_counting_with_ties(scores, seed):
    rng = np.random.default_rng(seed)
    y, p = rng.integers(0, 2, 200), np.round(rng.random(200), 1)
    pos, neg = p[y == 1], p[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert ranking_metrics(scores(y, p)).first().roc_auc == pytest.approx(want)


def test_single_class(scores):
    only_negative = ranking_metrics(scores([0, 0], [.1, .2])).first()
    assert only_negative.roc_auc is None and only_negative.pr_auc == 0.0


def test_pr_curve_leaves_out_the_artificial_ends(scores):
    assert {r.threshold for r in pr_curve(scores([0, 1], [.3, .6])).collect()} == {.3, .6}


def test_metrics_bundle(scores):
    got = compute_metrics(scores([0, 0, 1, 1], [.1, .7, .4, .9]), 0.5).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 1, 1, 1)
    assert (got.precision, got.recall, got.f1) == (0.5, 0.5, 0.5)
    empty = compute_metrics(scores([0, 1], [.1, .2]), 0.9).first()
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)


def test_scores_out_of_range(scores):
    for bad in (1.5, -0.1):
        with pytest.raises(ValueError, match=r"in \[0, 1\]"):
            compute_metrics(scores([0, 1], [.1, bad]), 0.5)
        with pytest.raises(ValueError, match=r"in \[0, 1\]"):
            calibration_bins(scores([0, 1], [.1, bad]))


def test_calibration_arguments(scores):
    with pytest.raises(ValueError, match="n_bins must be"):
        calibration_bins(scores([0], [.1]), n_bins=1)
    with pytest.raises(ValueError, match="strategy must be"):
        calibration_bins(scores([0], [.1]), strategy="other")


def _numpy_calibration(y, p, n_bins, strategy):
    if strategy == "uniform":
        edges = np.linspace(0, 1, n_bins + 1)
    else:
        edges = np.quantile(p, np.linspace(0, 1, n_bins + 1))
        edges[0], edges[-1] = 0.0, 1.0
        edges = np.unique(edges)
    idx = np.digitize(p, edges[1:-1], right=True)
    return {i: ((idx == i).sum(), p[idx == i].mean(), y[idx == i].mean()) for i in np.unique(idx)}


@pytest.mark.parametrize("strategy", ["uniform", "quantile"])
@pytest.mark.parametrize("places", [1, 6])
def test_calibration_equals_numpy(scores, strategy, places):
    rng = np.random.default_rng(7)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400) ** 2, places)
    got = {r.bin_idx: (r["count"], r.mean_pred, r.frac_pos) for r in calibration_bins(scores(y, p), 10, strategy).collect()}
    want = _numpy_calibration(y, p, 10, strategy)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in want)


def test_calibration_counts_cover_all_rows(scores):
    df = scores([0, 1, 0, 1, 0, 1], [.05, .06, .07, .95, .96, .97])
    assert sum(r["count"] for r in calibration_bins(df, 10, "uniform").collect()) == 6
    assert brier_score(df).first().brier == pytest.approx(np.mean(
        (np.array([.05, .06, .07, .95, .96, .97]) - [0, 1, 0, 1, 0, 1]) ** 2))


def test_buckets(spark):
    df = spark.createDataFrame([(.19,), (.2,), (.49,), (.5,)], "p double")
    assert [r.b for r in df.select(risk_bucket(F.col("p"), [.2, .5]).alias("b")).collect()] == ["low", "med", "med", "high"]
    with pytest.raises(ValueError, match="two cut-offs"):
        risk_bucket(F.col("p"), [.2])
    out = apply_policy(spark.createDataFrame([(.1,), (.2,), (.7,)], "y_proba double"), 0.3, [.2, .5]).collect()
    assert [r.bucket for r in out] == ["low", "med", "high"] and {r.threshold for r in out} == {0.3}
    assert [r.is_alert for r in out] == [False, False, True]


def test_errors_order(spark):
    rows = [(i, i, y, p, q) for i, (p, q, y) in enumerate(zip([.8, .2, .9, .7, .3], [1, 0, 1, 1, 0], [0, 1, 0, 0, 1]))]
    out = top_errors(spark.createDataFrame(rows, "engine_id long, cycle long, label int, y_proba double, y_pred int")).toPandas()
    out = out.sort_values("rank")
    assert out[out.error == "fp"].y_proba.tolist() == [.9, .8, .7]
    assert out[out.error == "fn"].y_proba.tolist() == [.3, .2]
    assert out.fp_kind.isna().all()


def test_error_kinds(spark):
    rows = [(1, i, 0, .9 - i / 10, 1, r) for i, r in enumerate([35, 50, 0, None])]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, label int, y_proba double, y_pred int, remaining long")
    kinds = [r.fp_kind for r in top_errors(df, 30, 10).orderBy("rank").collect()]
    assert kinds == ["premature_alarm", "noise_fp", "at_or_past_failure", None]
    with pytest.raises(ValueError, match="lacks the columns"):
        top_errors(df.drop("label"))


def test_topk(spark):
    rows = [(1, i, int(i < 10), i / 200, "val") for i in range(200)] + [(2, i, 0, 0.5, "test") for i in range(3)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, label int, anomaly_score double, split string")
    out = {(r.split, r.k): r for r in topk_lift(df).collect()}
    assert out[("val", 0.05)].m == 10 and out[("val", 0.05)].precision == 0.0
    assert out[("test", 0.01)].m == 1 and out[("test", 0.01)].lift is None and out[("test", 0.01)].capture is None


def test_log_loss_is_a_mean_of_batch_means(spark):
    rng = np.random.default_rng(2)
    z, y = rng.normal(size=70) * 3, rng.integers(0, 2, 70)
    df = spark.createDataFrame(pd.DataFrame({"i": range(70), "logit": z, "label": y}))
    loss = np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - y * z
    got = log_loss_with_logits(df, [F.col("i")]).first()
    assert got.loss == pytest.approx(np.mean([loss[:32].mean(), loss[32:64].mean(), loss[64:].mean()]))
    assert got.row_loss == pytest.approx(loss.mean())
    assert log_loss_with_logits(df.where("i < 0"), [F.col("i")]).first().loss == 0.0
    full = eval_sequence_metrics(df, [F.col("i")], 0.5).first()
    pred = 1 / (1 + np.exp(-z)) >= 0.5
    assert full.precision == pytest.approx((pred & (y == 1)).sum() / pred.sum())


def test_best_model_and_ties(spark):
    df = spark.createDataFrame([("b", "val", .5), ("a", "val", .5), ("c", "train", .9)], "model string, split string, pr_auc double")
    assert select_best_model(df, ["a", "b"]).first().model == "a"
    assert select_best_model(df, ["b", "a"]).first().model == "b"


@pytest.mark.parametrize("history,patience,want", [
    ([(.5, 1.0), (.5, .9), (.4, .1), (.5, .9), (.9, .1)], 2, (1, .5, 4)),
    ([(.5, 1.0), (.6, 1.0), (.7, 1.0)], 1, (2, .7, 3)),
    ([(.5, 1.0), (.4, 1.0), (.7, 1.0)], 1, (0, .5, 2)),
])
def test_early_stopping(spark, history, patience, want):
    rows = [(i, loss, auc) for i, (auc, loss) in enumerate(history)]
    out = early_stop_best_epoch(spark.createDataFrame(rows, "epoch int, val_loss double, val_pr_auc double"), patience).first()
    assert (out.best_epoch, out.best_val_pr_auc, out.epochs_run) == want


def _ranked(pdf, ks):
    """Top-k by sorting everything."""
    out = {}
    for split, x in pdf.groupby("split"):
        x = x.sort_values(["anomaly_score", "engine_id", "cycle"], ascending=[False, True, True])
        for k in ks:
            m = max(1, int(np.ceil(len(x) * k)))
            out[split, k] = (m, x[:m])
    return out


@pytest.mark.parametrize("shift", [16, 2])
@pytest.mark.parametrize("levels", [1, 3, 40, 100_000])
def test_top_rows_equal_a_full_sort(spark, monkeypatch, levels, shift):
    """From a single score for all rows to hardly any ties; ties that end inside an engine, and inside a block of its cycles."""
    from fleethazard.operators import metrics as module, ordered

    monkeypatch.setattr(module, "CYCLE_SHIFT", shift)
    monkeypatch.setattr(ordered, "WHOLE_ROWS", 300_000 if shift == 16 else 0)  # sums as a whole, and cut by value
    rng = np.random.default_rng(levels)
    n = 900
    pdf = pd.DataFrame({"split": np.where(np.arange(n) < 700, "train", "val"), "engine_id": np.where(rng.random(n) < 0.4, 3, rng.integers(0, 9, n)),
                        "cycle": rng.permutation(n), "label": (rng.random(n) < 0.2).astype(int), "anomaly_score": rng.integers(0, levels, n) / levels})
    ks = (0.001, 0.013, 0.05, 0.5, 1.0)
    want = _ranked(pdf, ks)
    df = spark.createDataFrame(pdf).repartition(5)
    for r in topk_lift(df, ks).collect():
        m, top = want[r.split, r.k]
        base = pdf[pdf.split == r.split].label.mean()
        assert r.m == m and r.precision == pytest.approx(top.label.mean()) and r.lift == pytest.approx(top.label.mean() / base)
    for k in (0.013, 0.5):
        got = top_fraction(df, k, group=["split"]).toPandas().sort_values("rank")
        for split, x in got.groupby("split"):
            assert x["rank"].tolist() == list(range(1, want[split, k][0] + 1))
            assert x["cycle"].tolist() == want[split, k][1]["cycle"].tolist()
    assert top_fraction(df, 0.02).count() == 18


def test_scored_rows_are_evaluated_once(spark):
    """Sweeps, metrics, calibration and top-k read what they ask about from counts per score."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(400).selectExpr("id % 5 AS engine_id", "id AS cycle", "int(id % 3 = 0) AS label", "id / 400 AS y_proba", "'val' AS split")
    df = df.mapInArrow(watched, df.schema)
    for run, times in [(lambda: threshold_sweep(df), 1), (lambda: compute_metrics(df, 0.5), 1), (lambda: calibration_bins(df), 1),
                       (lambda: thresholds_max_precision(df, 0.5, 0.1), 1), (lambda: topk_lift(df, score="y_proba"), 1)]:
        before = seen.value
        run().collect()
        assert seen.value - before == 400 * times
