"""Classification metrics, calibration, top-k lift and model choice. One row per group (model, split, fold)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.functions.columns import require_columns
from fleethazard.functions.scalar import ceil_count, digitize, linspace_edges, logit_loss, predict_at, ratio
from fleethazard.operators.ordered import exact_quantiles, global_rank, lookup_join, running_totals
from fleethazard.operators.sweep import ranking_metrics, ranking_of, score_counts
from fleethazard.session import written

METRICS = ("pr_auc", "roc_auc", "precision", "recall", "f1", "tn", "fp", "fn", "tp", "brier")


def check_score_range(df: DataFrame, score: str = "y_proba", group: Sequence[str] = ()) -> DataFrame:
    """Rows whose probability is null or outside [0, 1]."""
    bad = ~F.coalesce(F.col(score).between(0.0, 1.0), F.lit(False))
    return df.groupBy(*group).agg(F.count_if(bad).alias("violations"))


def require_score_range(df: DataFrame, score: str = "y_proba", name: str | None = None) -> None:
    if not df.where(~F.coalesce(F.col(score).between(0.0, 1.0), F.lit(False))).isEmpty():
        raise ValueError(f"{name or score} must be in [0, 1]")


def _confusion(label: str, pred: Column) -> list[Column]:
    y = F.col(label)
    return [
        F.count_if((y == 0) & (pred == 0)).alias("tn"), F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"), F.count_if((y == 1) & (pred == 1)).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, threshold: Column | float, score: str = "y_proba", label: str = "label",
                     group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(*_confusion(label, predict_at(F.col(score), threshold)))


def with_precision_recall_f1(counts: DataFrame) -> DataFrame:
    """precision, recall and F1 from tp, fp, fn; empty denominators give 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    })


def brier_score(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def compute_metrics(df: DataFrame, threshold: Column | float, score: str = "y_proba", label: str = "label",
                    group: Sequence[str] = ()) -> DataFrame:
    """All metrics at a threshold (a value, or a column that is constant in a group), from one table of counts per score."""
    keys = list(group) or ["_g"]
    rows = df if group else df.withColumn("_g", F.lit(1))
    given = {"at": F.max(threshold)} if isinstance(threshold, Column) else {}
    counted = score_counts(rows, score, label, keys, **given)
    require_score_range(counted, "threshold", score)
    pred, s, pos = predict_at(F.col("threshold"), F.col("at") if given else threshold), F.col("threshold"), F.col("pos")
    neg = F.col("n") - pos
    rows_where = lambda n, y: F.sum(F.when(pred == y, n).otherwise(0)).cast("long")
    at = with_precision_recall_f1(counted.groupBy(*keys).agg(
        rows_where(neg, 0).alias("tn"), rows_where(neg, 1).alias("fp"), rows_where(pos, 0).alias("fn"), rows_where(pos, 1).alias("tp"),
        (F.sum(neg * s * s + pos * (1 - s) * (1 - s)) / F.sum("n")).alias("brier")))
    return at.join(ranking_of(counted, keys), keys).select(*group, *METRICS)


def metrics_long(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, metric): the report table."""
    names = [c for c in METRICS if c in metrics.columns]
    doubles = metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot(list(keys), names, "metric", "value")


def log_loss_with_logits(df: DataFrame, order: Sequence[Column], logit: str = "logit", label: str = "label",
                         batch: int = 32, group: Sequence[str] = ()) -> DataFrame:
    """Mean of the mean loss of consecutive batches (the last may be short), and the plain mean over rows."""
    loss = logit_loss(F.col(logit), F.col(label))
    placed = global_rank(df.select(*group, loss.alias("_loss"), *order), order, group)
    batches = placed.groupBy(*group, F.floor((F.col("rank") - 1) / batch).alias("_b")).agg(
        F.avg("_loss").alias("_m"), F.sum("_loss").alias("_s"), F.count("*").alias("_n"))
    return batches.groupBy(*group).agg(
        F.coalesce(F.avg("_m"), F.lit(0.0)).alias("loss"),
        F.coalesce(F.sum("_s") / F.sum("_n"), F.lit(0.0)).alias("row_loss"))


def eval_sequence_metrics(df: DataFrame, order: Sequence[Column], threshold: float | None = None,
                          logit: str = "logit", label: str = "label", group: Sequence[str] = (),
                          score: str | None = None) -> DataFrame:
    """Loss and PR-AUC of logits; precision, recall and F1 too when a threshold on the probability is given.

    ``score`` names the probability the threshold was chosen from, if there is one: computed again from the logit, it may differ
    in the last digit, and the row at the threshold would be lost.
    """
    scored = df.withColumn("_p", F.col(score) if score else 1.0 / (1.0 + F.exp(-F.col(logit))))
    keys = list(group) or ["_g"]
    if not group:
        scored = scored.withColumn("_g", F.lit(1))
    out = (
        log_loss_with_logits(scored, order, logit, label, group=keys).drop("row_loss")
        .join(ranking_metrics(scored, "_p", label, keys).drop("roc_auc"), keys)
    )
    if threshold is not None:
        at = with_precision_recall_f1(confusion_matrix(scored, threshold, "_p", label, keys))
        out = out.join(at.select(*keys, "precision", "recall", "f1"), keys)
    return out if group else out.drop("_g")


def _check_bins(n_bins: int, strategy: str) -> None:
    if n_bins < 2:
        raise ValueError(f"n_bins must be at least 2: {n_bins}")
    if strategy not in ("uniform", "quantile"):
        raise ValueError(f"strategy must be uniform or quantile: {strategy}")


def calibration_edges(df: DataFrame, n_bins: int = 10, strategy: str = "quantile", score: str = "y_proba",
                      group: Sequence[str] = (), pin_ends: bool = True, weight: str | None = None) -> DataFrame:
    """``edges`` array per group: evenly spaced, or exact quantiles with the ends pinned to 0 and 1, deduplicated."""
    _check_bins(n_bins, strategy)
    if strategy == "uniform":
        groups = df.select(*group).distinct() if group else df.sparkSession.range(1).select()
        return groups.select(*group, linspace_edges(n_bins).alias("edges"))
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(df, score, probs, group, weight)
    if pin_ends:
        q = q.withColumn("quantile", F.when(F.col("prob") == 0.0, 0.0).when(F.col("prob") == 1.0, 1.0)
                         .otherwise(F.col("quantile")))
    return q.groupBy(*group).agg(F.array_sort(F.collect_set("quantile")).alias("edges"))  # n_bins + 1 values


def calibration_bins(df: DataFrame, n_bins: int = 10, strategy: str = "quantile", score: str = "y_proba",
                     label: str = "label", group: Sequence[str] = (), pin_ends: bool = True) -> DataFrame:
    """``bin_idx, count, mean_pred, frac_pos`` of the non-empty right-closed bins; empty bins keep their index."""
    _check_bins(n_bins, strategy)
    keys = list(group) or ["_g"]
    counted = score_counts(df if group else df.withColumn("_g", F.lit(1)), score, label, keys)
    require_score_range(counted, "threshold", score)
    edges = calibration_edges(counted, n_bins, strategy, "threshold", keys, pin_ends, weight="n")
    # an edge array per (model, split, fold)
    binned = lookup_join(counted, edges, keys)
    interior = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    n = F.sum("n")
    out = binned.groupBy(*keys, digitize(F.col("threshold"), interior).alias("bin_idx")).agg(
        n.alias("count"), (F.sum(F.col("n") * F.col("threshold")) / n).alias("mean_pred"), (F.sum("pos") / n).alias("frac_pos"))
    return out if group else out.drop("_g")


CYCLE_SHIFT = 16  # of rows that tie, blocks of 2^16 cycles of an engine are counted; only the last block is ordered


def top_cuts(counted: DataFrame, ks: Sequence[float], group: Sequence[str]) -> DataFrame:
    """Where the top ceil(k*n) rows of each group end, from a table of `score_counts`: one row per group and ``k`` with ``m``,
    the score ``cut`` of the last row, the rows above it (``above``, ``above_pos`` with label 1), those at it (``tied, tied_pos``), and
    ``n_rows, positives`` of the group."""
    run = running_totals(counted, [F.col("threshold").desc()], {"upto": "n", "upto_pos": "pos"}, group, by="threshold",
                         descending=True, at_rest=True)
    sizes = F.array(*[F.struct(F.lit(float(k)).alias("k"), ceil_count(F.col("upto_total"), k).alias("m")) for k in ks])
    here = F.filter(sizes, lambda c: (c["m"] <= F.col("upto")) & (c["m"] > F.col("upto") - F.col("n")))
    return run.withColumn("_c", F.explode(here)).select(
        *group, "_c.k", "_c.m", F.col("threshold").alias("cut"), (F.col("upto") - F.col("n")).alias("above"),
        (F.col("upto_pos") - F.col("pos")).alias("above_pos"), F.col("n").alias("tied"), F.col("pos").alias("tied_pos"),
        F.col("upto_total").alias("n_rows"), F.col("upto_pos_total").alias("positives"))


def first_of_ties(ties: DataFrame, keys: Sequence[str], need: str = "need") -> DataFrame:
    """The first ``need`` rows of ``ties`` per ``keys``, by engine and cycle.

    Blocks of cycles are counted and summed along the engines; whole blocks before the last are in, and only rows of the block
    in which the count is reached are ordered. (engine_id, cycle) is unique, so that is 2^CYCLE_SHIFT rows at most."""
    block = F.shiftright(F.col("cycle").cast("long"), CYCLE_SHIFT).alias("_block")
    ties = ties.withColumn("_block", block)
    blocks = ties.groupBy(*keys, "engine_id", "_block").agg(F.count("*").cast("long").alias("_n"), F.max(need).alias("_need"))
    run = running_totals(blocks, [F.col("engine_id"), F.col("_block")], {"_upto": "_n"}, keys, by="engine_id")
    last = run.where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need"))).select(
        *keys, F.col("engine_id").alias("_e"), F.col("_block").alias("_b"), (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_rest"))
    placed = lookup_join(ties, last, keys)  # one row per key
    before = (F.col("engine_id") < F.col("_e")) | ((F.col("engine_id") == F.col("_e")) & (F.col("_block") < F.col("_b")))
    inside = (F.col("engine_id") == F.col("_e")) & (F.col("_block") == F.col("_b"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("cycle"))
    edge = placed.where(inside).withColumn("_place", place).where(F.col("_place") <= F.col("_rest")).drop("_place")
    return placed.where(before).unionByName(edge).drop("_block", "_e", "_b", "_rest")


def top_fraction(df: DataFrame, k: float, score: str = "anomaly_score", group: Sequence[str] = ()) -> DataFrame:
    """The ceil(k*n) highest scored rows of each group, ties by (engine_id, cycle), with their ``rank``.

    Counts per score give the score at which the selection ends; only the rows selected are ordered."""
    keys = list(group) or ["_g"]
    rows = df.withColumns({"_s": F.col(score).cast("double"), **({} if group else {"_g": F.lit(1)})})
    counted = score_counts(rows.withColumn("_y", F.lit(0)), "_s", "_y", keys)
    cuts = written(top_cuts(counted, [k], keys).select(*keys, "cut", (F.col("m") - F.col("above")).alias("need"), "tied"), "top-cuts")
    placed = rows.join(cuts, keys)  # at rest: a row per group and k
    whole = (F.col("need") == F.col("tied")) & F.col("_s").eqNullSafe(F.col("cut"))
    # scores rank as Spark orders them: NaN above all numbers, null below
    above = (F.col("_s") > F.col("cut")) | (F.col("_s").isNotNull() & F.col("cut").isNull())
    chosen = placed.where(above | whole)
    ties = placed.where(F.col("_s").eqNullSafe(F.col("cut")) & (F.col("need") < F.col("tied")))
    if not cuts.where("need < tied").isEmpty():
        chosen = chosen.unionByName(first_of_ties(ties, keys))
    ranked = global_rank(chosen.drop("_s", "cut", "need", "tied"), [F.col(score).desc(), F.col("engine_id"), F.col("cycle")], keys)
    return ranked.drop("rank_total", *([] if group else ["_g"]))


def topk_lift(df: DataFrame, ks: Sequence[float] = (0.01, 0.05), score: str = "anomaly_score", label: str = "label",
              group: Sequence[str] = ("split",)) -> DataFrame:
    """Precision, lift and capture in the top ceil(k*n) rows; lift and capture are null without positives.

    Rows above the cut are known from counts per score; of those that tie at it, as many as are needed are looked up."""
    rows = df.select(*group, F.col(score).cast("double").alias("_s"), label, "engine_id", "cycle")
    cuts = written(top_cuts(score_counts(rows, "_s", label, group), ks, group), "top-cuts")
    partly = cuts.where((F.col("m") - F.col("above") < F.col("tied")) & (F.col("tied_pos") > 0) & (F.col("tied_pos") < F.col("tied")))
    # where all rows that tie have the same label, it doesn't matter which are taken
    found = F.when(F.col("tied_pos") == F.col("tied"), F.col("m") - F.col("above")).otherwise(F.when(F.col("m") - F.col("above") == F.col("tied"), F.col("tied_pos")).otherwise(0))
    if not partly.isEmpty():
        at = partly.select(*group, "k", "cut", (F.col("m") - F.col("above")).alias("need"))
        ties = rows.join(at, list(group)).where(F.col("_s").eqNullSafe(F.col("cut")))
        some = first_of_ties(ties, [*group, "k"]).groupBy(*group, "k").agg(F.sum(F.col(label).cast("long")).alias("_some"))
        cuts = cuts.join(some, [*group, "k"], "left")
        found = F.coalesce(F.col("_some"), found)
    base, top_pos = F.col("positives") / F.col("n_rows"), F.col("above_pos") + found
    precision = top_pos / F.col("m")
    return cuts.select(*group, "k", F.col("n_rows").alias("n"), "positives", "m", precision.alias("precision"),
                       F.when(base > 0, F.try_divide(precision, base)).alias("lift"),
                       F.try_divide(top_pos.cast("double"), F.col("positives").cast("double")).alias("capture"))


def top_anomalies(df: DataFrame, top: int = 10, score: str = "anomaly_score", group: Sequence[str] = ("split",)) -> DataFrame:
    """The ``top`` highest scores of each split."""
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), "engine_id", "cycle")
    # a rank filter this small is applied per task before the shuffle
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def split_base_rate(df: DataFrame, label: str = "label", group: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("positives"),
        F.avg(F.col(label).cast("double")).alias("base_rate"))


def class_balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """n / (2 * n_class) per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_class"))
    return counts.select(label, "n_class",
                         (F.sum("n_class").over(Window.partitionBy()) / (2.0 * F.col("n_class"))).alias("weight"))


def overfit_gap(metrics: DataFrame) -> DataFrame:
    """train - val PR-AUC per model."""
    pick = lambda s: F.max(F.when(F.col("split") == s, F.col("pr_auc")))
    return metrics.groupBy("model").agg(
        pick("train").alias("train_pr_auc"), pick("val").alias("val_pr_auc"),
        (pick("train") - pick("val")).alias("gap"))


def select_best_model(metrics: DataFrame, candidates: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Highest val PR-AUC; of equals, the candidate named first."""
    order = F.create_map(*[F.lit(x) for i, c in enumerate(candidates) for x in (c, -i)])
    known = metrics.where((F.col("split") == "val") & F.col("model").isin(list(candidates)))
    best = F.max(F.struct("pr_auc", order[F.col("model")].alias("_o"), "model"))
    return known.groupBy(*group).agg(best.alias("b")).select(*group, F.col("b.model").alias("model"),
                                                             F.col("b.pr_auc").alias("val_pr_auc"))


def fp_kind(remaining: Column, horizon_n: int, early_alarm_slack: int) -> Column:
    return (F.when(remaining.isNull(), None)
            .when((remaining > 0) & (remaining <= horizon_n + early_alarm_slack), "premature_alarm")
            .when(remaining <= 0, "at_or_past_failure").otherwise("noise_fp"))


def top_errors(df: DataFrame, horizon_n: int = 30, early_alarm_slack: int = 10, top_k: int = 20,
               group: Sequence[str] = ()) -> DataFrame:
    """The ``top_k`` false positives and the ``top_k`` false negatives, highest probability first."""
    require_columns(df, ["engine_id", "cycle", "label", "y_proba", "y_pred"])
    if "remaining" not in df.columns:
        df = df.withColumn("remaining", F.lit(None).cast("long"))
    wrong = df.where(F.col("y_pred") != F.col("label")).withColumn(
        "error", F.when(F.col("y_pred") == 1, "fp").otherwise("fn"))
    w = Window.partitionBy(*group, "error").orderBy(F.col("y_proba").desc(), "engine_id", "cycle")
    kind = F.when(F.col("error") == "fp", fp_kind(F.col("remaining"), horizon_n, early_alarm_slack))
    return (
        wrong.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)
        .select(*group, "error", "rank", "engine_id", "cycle", "y_proba", "label", "y_pred", "remaining",
                kind.alias("fp_kind"))
    )


def early_stop_best_epoch(history: DataFrame, patience: int, group: Sequence[str] = ()) -> DataFrame:
    """Best epoch by (PR-AUC, lower loss) and the epoch at which training stops for lack of improvement.

    ``history`` has one row per epoch: ``epoch, val_loss, val_pr_auc``.
    """
    along = Window.partitionBy(*group).orderBy("epoch")
    place = F.struct(F.col("val_pr_auc").alias("a"), (-F.col("val_loss")).alias("l"))
    best_before = F.max(place).over(along.rowsBetween(Window.unboundedPreceding, -1))
    marked = history.withColumn("_better", best_before.isNull() | (place > best_before))
    marked = marked.withColumn("_run", F.sum(F.col("_better").cast("int")).over(along))
    marked = marked.withColumn(
        "_stale", F.sum((~F.col("_better")).cast("int")).over(
            Window.partitionBy(*group, "_run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)))
    stop = F.min(F.when(F.col("_stale") >= patience, F.col("epoch"))).over(Window.partitionBy(*group))
    seen = marked.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("epoch") <= F.col("_stop")))
    best = F.max(F.when(F.col("_better"), F.struct("val_pr_auc", (-F.col("val_loss")).alias("l"), "epoch")))
    return seen.groupBy(*group).agg(
        best["epoch"].alias("best_epoch"), best["val_pr_auc"].alias("best_val_pr_auc"), (-best["l"]).alias("best_val_loss"),
        F.count("*").alias("epochs_run"))
