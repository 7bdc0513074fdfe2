"""Score sweeps: one pass over the distinct scores answers every threshold question.

Rows are collapsed to one row per distinct score before anything is ordered,
so a score shared by a third of all rows is one row; the running sums are
those of `running_totals`. The group columns are small (model, split, fold).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.scalar import ratio
from fleethazard.operators.ordered import running_totals
from fleethazard.session import written


def distinct_scores(df: DataFrame, score: str = "y_proba", group: Sequence[str] = ()) -> DataFrame:
    """Threshold candidates: the distinct scores and 0.0 and 1.0."""
    ends = df.select(*group).distinct().withColumn("threshold", F.explode(F.array(F.lit(0.0), F.lit(1.0)))) if group \
        else df.sparkSession.createDataFrame([(0.0,), (1.0,)], "threshold double")
    return df.select(*group, F.col(score).alias("threshold")).unionByName(ends).distinct()


def score_counts(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = (), **more: Column) -> DataFrame:
    """``threshold`` (a distinct score), ``pos`` and ``n`` per group, with the aggregates in ``more``, written once: whatever is asked
    about the scores afterwards reads this table, and what made them runs a single time."""
    counted = df.groupBy(*group, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"), *[c.alias(k) for k, c in more.items()])
    return written(counted, "score-counts")


def sweep_counts(counted: DataFrame, group: Sequence[str] = (), with_ends: bool = False) -> DataFrame:
    """`threshold_sweep` over a table of `score_counts`."""
    if with_ends:
        zero = F.lit(0).cast("long")
        ends = counted.select(*group).distinct() if group else counted.sparkSession.range(1).select()
        ends = ends.select(*group, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("threshold"), zero.alias("pos"), zero.alias("n"))
        counted = counted.select(*ends.columns).unionByName(ends).groupBy(*group, "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    run = running_totals(counted, [F.col("threshold").desc()], {"tp": "pos", "predicted": "n"}, group, by="threshold",
                         descending=True, at_rest=True)
    return run.select(
        *group, "threshold", "pos", "n", "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        F.col("tp_total").alias("positives"), F.col("predicted_total").alias("total"),
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("tp_total")).alias("recall"),
    )


def threshold_sweep(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = (),
                    with_ends: bool = True) -> DataFrame:
    """Per candidate threshold (predict 1 iff score >= threshold): counts, precision, recall.

    Columns: group, ``threshold, pos, n`` (rows with exactly this score),
    ``tp, fp, positives, total, precision, recall``.
    """
    return sweep_counts(score_counts(df, score, label, group), group, with_ends)


def pr_curve(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score."""
    return threshold_sweep(df, score, label, group, with_ends=False).select(*group, "threshold", "precision", "recall")


def score_running_counts(df: DataFrame, score: str = "y_proba", label: str = "label",
                         group: Sequence[str] = ()) -> DataFrame:
    """Cumulative true and false positives going down the scores."""
    return threshold_sweep(df, score, label, group, with_ends=False).select(*group, "threshold", "tp", "fp")


def average_precision_of(sweep: DataFrame) -> Column:
    """Step-wise area: sum of recall gained at a score times the precision there. 0 without positives."""
    gained = ratio(F.col("pos"), F.col("positives"))
    return F.sum(gained * F.col("precision"))


def roc_auc_of(sweep: DataFrame) -> Column:
    """Trapezoid area over distinct scores, so ties count half. Null for a single class."""
    negatives = F.col("n") - F.col("pos")
    height = (F.col("tp") - F.col("pos") + F.col("tp")) / 2.0
    pairs = F.max(F.col("positives").cast("double") * (F.col("total") - F.col("positives")))
    return F.try_divide(F.sum(negatives * height), F.when(pairs > 0, pairs))


def ranking_metrics(df: DataFrame, score: str = "y_proba", label: str = "label",
                    group: Sequence[str] = ()) -> DataFrame:
    """``pr_auc, roc_auc`` per group."""
    return ranking_of(score_counts(df, score, label, group), group)


def ranking_of(counted: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """`ranking_metrics` over a table of `score_counts`."""
    sweep = sweep_counts(counted, group)
    return sweep.groupBy(*group).agg(average_precision_of(sweep).alias("pr_auc"), roc_auc_of(sweep).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, label, group).select(*group, "pr_auc")


def roc_auc(df: DataFrame, score: str = "y_proba", label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, score, label, group).select(*group, "roc_auc")


class PolicyError(ValueError):
    """No threshold satisfies the policy."""


def _meets(target_recall: float, min_precision: float) -> Column:
    return (F.col("recall") >= F.lit(float(target_recall))) & (F.col("precision") >= F.lit(float(min_precision)))


def thresholds_max_precision(df: DataFrame, target_recall: float, min_precision: float, score: str = "y_proba",
                             label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    """Highest precision among the thresholds that meet the policy, then the highest threshold; null if none does."""
    sweep = threshold_sweep(df, score, label, group)
    ok = _meets(target_recall, min_precision)
    return sweep.groupBy(*group).agg(
        F.max(F.when(ok, F.struct("precision", "threshold")))["threshold"].alias("threshold"))


def thresholds_highest(df: DataFrame, target_recall: float, min_precision: float, score: str = "y_proba",
                       label: str = "label", group: Sequence[str] = ()) -> DataFrame:
    """Highest observed score that meets the policy; null if none does."""
    sweep = threshold_sweep(df, score, label, group, with_ends=False)
    return sweep.groupBy(*group).agg(
        F.max(F.when(_meets(target_recall, min_precision), F.col("threshold"))).alias("threshold"))


def thresholds_target_recall(df: DataFrame, target_recall: float, score: str = "y_proba", label: str = "label",
                             group: Sequence[str] = ()) -> DataFrame:
    """Highest score whose recall reaches the target; 1.0 without positives."""
    sweep = threshold_sweep(df, score, label, group, with_ends=False)
    reached = (F.col("positives") > 0) & (F.col("recall") >= F.lit(float(target_recall)))
    return sweep.groupBy(*group).agg(
        F.coalesce(F.max(F.when(reached, F.col("threshold"))), F.lit(1.0)).alias("threshold"))


def required_thresholds(found: DataFrame, group: Sequence[str], target_recall: float, min_precision: float) -> list:
    """One row per group (few: models, folds); raises if a group has no threshold."""
    rows = found.select(*group, "threshold").orderBy(*group).collect()
    for r in rows:
        if r["threshold"] is None:
            raise PolicyError(f"Model too weak for policy: recall {target_recall} and precision {min_precision} are never reached "
                              f"together by {', '.join(f'{g} {r[g]}' for g in group)}")
    return rows


def _required(found: DataFrame, target_recall: float, min_precision: float) -> float:
    value = found.first()["threshold"]
    if value is None:
        raise PolicyError(
            f"Model too weak for policy: recall {target_recall} and precision {min_precision} are never reached together")
    return float(value)


def select_threshold_max_precision(df: DataFrame, target_recall: float, min_precision: float, **columns: str) -> float:
    return _required(thresholds_max_precision(df, target_recall, min_precision, **columns), target_recall, min_precision)


def select_threshold_highest(df: DataFrame, target_recall: float, min_precision: float, **columns: str) -> float:
    return _required(thresholds_highest(df, target_recall, min_precision, **columns), target_recall, min_precision)


def select_threshold_target_recall(df: DataFrame, target_recall: float, **columns: str) -> float:
    return float(thresholds_target_recall(df, target_recall, **columns).first()["threshold"])
