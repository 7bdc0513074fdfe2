"""Quality classifier by co-training: a text view and a metadata view label confident documents for each other."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.quality_rules import SYMBOLS
from fleethazard.llm.support import LOWER, SPACES, UPPER, in_small_batches, packed, unpacked
from fleethazard.session import written

HASHED = 16  # columns for each hashed metadata value
FOLDS = 5  # of each class, one labelled id in five calibrates and is not trained on
TEXT_FEATURES = 11
CHARACTERS = [[ord(c) for c in kind] for kind in (SPACES, UPPER, LOWER, SYMBOLS, "!?", "|", "0123456789", ".,;:")]


def text_features(text: str | None) -> list[float]:
    """What the text itself shows: shares of kinds of characters, of different words and of lines. Two raw counts follow:
    characters that are no white space, plus one, and lines."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    of = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    spaces, upper, lower, symbols, shouts, bars, digits, stops = (int(of[kind].sum()) for kind in CHARACTERS)
    words, lines = data.split(), data.split(b"\n")  # bytes split at SPACES
    n, chars, n_lines = len(words) + 1.0, len(text) - spaces + 1.0, float(len(lines))
    return [len(set(words)) / n, upper / chars, lower / chars, symbols / chars, shouts / chars, bars / chars, digits / chars, stops / chars,
            float(np.log(n)), chars / n, len(set(lines)) / n_lines, chars, n_lines]


def with_text_view(df: DataFrame) -> DataFrame:
    """``df`` with ``view``, the `text_features` of its column ``text``: one pass over the whole text."""
    @F.pandas_udf("array<double>")
    def view(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in texts])

    return in_small_batches(df).withColumn("view", view("text"))


def text_view() -> Column:
    return F.slice("view", 1, TEXT_FEATURES)


def metadata_view() -> Column:
    """What is known beside the words: host, declared language, length and line structure, hashed or in logarithms."""
    def hashed(value: Column) -> Column:
        place = F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(HASHED))
        return F.transform(F.sequence(F.lit(0), F.lit(HASHED - 1)), lambda k: (k == place).cast("double"))

    chars, n_lines = F.get("view", F.lit(TEXT_FEATURES)), F.get("view", F.lit(TEXT_FEATURES + 1))
    return F.concat(hashed(F.col("host")), hashed(F.col("lang")), F.array(F.log(chars), F.log(n_lines), F.log(chars / n_lines)))


@dataclass
class Logistic:
    """Ridge-regularised logistic regression on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # intercept last

    @classmethod
    def same(cls) -> Logistic:
        """A single column as it is."""
        return cls(np.zeros(1), np.ones(1), np.array([1.0, 0.0]))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        z = np.c_[(x - mean) / scale, np.ones(len(x))]
        w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
            w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -30, 30)

    def column(self, features: Column) -> Column:
        """The same logit as an expression on an array of features. The weights are one constant array, so that all models share their
        generated code and the executors' memory doesn't fill with a class for each."""
        per = self.weights[:-1] / self.scale
        start = float(self.weights[-1] - (per * self.mean).sum())
        weighted = F.zip_with(features, F.array(*[F.lit(float(w)) for w in per]), lambda x, w: x * w)
        return F.least(F.greatest(F.aggregate(weighted, F.lit(start), lambda total, x: total + x), F.lit(-30.0)), F.lit(30.0))


@dataclass
class CoTrained:
    text: Logistic
    metadata: Logistic
    calibrate: tuple[Logistic, Logistic]
    prior: float  # log-odds of a good document among the labelled rows given
    held_out_accuracy: float  # NaN if nothing was held out


def log_odds(y: np.ndarray) -> float:
    return float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))


def folds_of(label: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Folds dealt out within each class by order of ``key``, equal keys together: a class with two keys is in and out of fold 0."""
    fold = np.zeros(len(label), dtype=np.int64)
    for y in np.unique(label):
        fold[label == y] = np.unique(key[label == y], return_inverse=True)[1] % FOLDS
    return fold


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]  # text view, metadata view, label


def co_train(text: np.ndarray, metadata: np.ndarray, label: np.ndarray, fold: np.ndarray, rounds: int,
             surest: Callable[[int, Logistic, float], Rows]) -> CoTrained | None:
    """Each round, each view labels the unlabelled rows it is surest of, and the other view trains on them.

    ``surest(k, model, prior)`` gives those rows for view k (0 text, 1 metadata), never one that the other view has already had.
    Rows of fold 0 train nothing: they calibrate both views, whose log-odds are added and the prior's taken off once. If a
    class is missing in or out of fold 0, all rows train and nothing calibrates. None if the labels don't show both classes."""
    if len(np.unique(label)) < 2:
        return None
    train, held = fold > 0, fold == 0
    calibrated = all(len(np.unique(label[part])) == 2 for part in (train, held))
    if not calibrated:
        train = np.ones(len(label), dtype=bool)
    views = [text, metadata]
    known = [(v[train], label[train]) for v in views]
    for _ in range(rounds):
        for k in (0, 1):
            found = surest(k, Logistic.fit(*known[k]), log_odds(known[k][1]))
            x, y = known[1 - k]
            known[1 - k] = np.concatenate([x, found[1 - k].reshape(-1, x.shape[1])]), np.r_[y, found[2]]
    models = [Logistic.fit(*rows) for rows in known]
    y = label[held] if calibrated else label[train]
    prior = log_odds(y)
    if not calibrated:
        return CoTrained(models[0], models[1], (Logistic.same(), Logistic.same()), prior, float("nan"))
    calibrate = tuple(Logistic.fit(m.logit(v[held])[:, None], y) for m, v in zip(models, views))
    both = sum(c.logit(m.logit(v[held])[:, None]) for c, m, v in zip(calibrate, models, views)) - prior
    return CoTrained(models[0], models[1], calibrate, prior, float(((both > 0) == (y == 1)).mean()))


class Pool:
    """All unlabelled rows of a corpus, from which each round takes the surest: ``id, mark, text, metadata``, where ``mark`` tells
    rows apart (equal rows may share one and then go together)."""

    def __init__(self, rows: DataFrame, shift: float, confidence: float, per_round: int):
        self.rows, self.shift, self.per_round = rows, shift, per_round
        self.least = float(np.log(confidence / (1 - confidence)))
        self.had: tuple[set[int], set[int]] = (set(), set())  # marks each view was taught: a few per round

    def surest(self, k: int, model: Logistic, prior: float) -> Rows:
        """The ``per_round`` rows of either class that view ``k`` is surest of, out of the whole table. A row is sure by its log-odds with
        and without the prior, so a frequent class alone makes no row sure; equally sure rows go by their mark."""
        name = ("text", "metadata")[k]
        rows = self.rows.withColumn("odds", model.column(F.col(name))).withColumns({"alone": F.col("odds") - prior, "with": F.col("odds") + self.shift})
        both = F.when(F.col("with") * F.col("alone") > 0, F.least(F.abs("with"), F.abs("alone"))).otherwise(0.0)
        rows = rows.withColumn("strength", F.round(both, 9)).where(F.col("strength") >= self.least)
        if self.had[1 - k]:
            taught = self.rows.sparkSession.createDataFrame([(m,) for m in sorted(self.had[1 - k])], "mark long")
            rows = rows.join(F.broadcast(taught), "mark", "left_anti")  # 2 * per_round rows for each round at most
        best = [rows.where((F.col("with") > 0) == F.lit(bool(y))).orderBy(F.desc("strength"), "mark").limit(self.per_round) for y in (0, 1)]
        got = best[0].union(best[1]).select("mark", "text", "metadata", (F.col("with") > 0).cast("int").alias("y")).toPandas()
        self.had[1 - k].update(got["mark"].tolist())
        stack = lambda c: np.array(got[c].tolist(), dtype=float)
        return stack("text"), stack("metadata"), got["y"].to_numpy(dtype=np.int64)


def _labelled(labels: DataFrame, ids: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``owner, label`` of each id of ``ids`` with a label: good only if all its labels say so."""
    given = labels.select(F.col(id_col).alias("owner"), F.col(label_col).cast("double").alias("label")).dropna()
    odd = given.where(~F.col("label").isin(0.0, 1.0)).first()
    if odd is not None:
        raise ValueError(f"{label_col} must be 0 or 1, found {odd['label']:g}")
    return given.groupBy("owner").agg(F.min("label").cast("int").alias("label")).join(ids, F.col("owner") == F.col("id"), "left_semi")


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source", lang_col: str = "lang", label_col: str = "quality",
                     max_labelled: int = 20_000, rounds: int = 3, confidence: float = 0.95,
                     per_round: int = 1_000, threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with ``text_score``, ``metadata_score`` (calibrated), ``score`` and ``kept``
    (``score >= threshold``).

    Both views start from at most ``max_labelled`` labelled documents of each class: those whose ids have the smallest hashes, one row for
    each id. In each of ``rounds`` rounds each view scores every other document of the corpus, and the ``per_round`` surest
    of either class teach the other view. All documents are scored in the end, whole texts, without a shuffle. Scores count the
    classes as the labels of ``docs`` do, not as the sample does. Of each class, one id in five is held out to calibrate; if a
    class has one id only, nothing is.

    Labels are 0 or 1; any other raises ValueError. An id with several labels counts as good only if all say so; null
    labels, null ids and labels of ids that ``docs`` lacks are not used. Null text counts as empty. Rows without an id and rows that
    repeat one are scored each by itself. Without labels of both classes, all scores are 0.5 and all is kept. Input columns named
    like an added one give way; an empty table gives an empty table.

    The views of all documents are written once, without the texts, and read in each round; only the rows that teach reach the driver.
    """
    names = {"id": id_col, "text": text_col, "host": host_col, "lang": lang_col}
    base = packed(docs, **names)
    given = written(_labelled(labels, base.select("id"), id_col, label_col), "labelled")
    n_of = {r["label"]: r["count"] for r in given.groupBy("label").count().collect()}
    model, shift = None, 0.0
    if len(n_of) == 2:
        slot = F.xxhash64(F.lit("sample"), "owner")
        sampled = [given.where(F.col("label") == y).orderBy(slot, "owner").limit(max_labelled) for y in (0, 1)]
        chosen = F.broadcast(written(sampled[0].union(sampled[1]), "sampled-labels"))  # 2 * max_labelled rows at most
        views = with_text_view(base.select("id", "text", "host", "lang")).select(
            "id", F.xxhash64(F.lit("mark"), "id", "text", "host", "lang").alias("mark"),
            text_view().alias("text"), metadata_view().alias("metadata"))
        views = written(views, "views")
        taught = views.join(chosen, F.col("id") == F.col("owner")).groupBy("owner").agg(
            F.first("label").alias("label"), F.min_by(F.struct("text", "metadata"), "mark").alias("row"))
        sample = taught.select("owner", "label", F.xxhash64(F.lit("fold"), "owner").alias("key"), "row.*").toPandas().sort_values("owner", kind="stable")
        label = sample["label"].to_numpy(dtype=np.int64)
        taken = np.bincount(label, minlength=2)
        shift = float(np.log(n_of[1] / taken[1]) - np.log(n_of[0] / taken[0]))  # the sample may thin one class more than the other
        pool = Pool(views.join(chosen, F.col("id") == F.col("owner"), "left_anti"), shift, confidence, per_round)
        stack = lambda c: np.array(sample[c].tolist(), dtype=float)
        model = co_train(stack("text"), stack("metadata"), label, folds_of(label, sample["key"].to_numpy()), rounds, pool.surest)
    if model is None:
        half = F.lit(0.5)
        return unpacked(base, docs, names, {"text_score": half, "metadata_score": half, "score": half, "kept": F.lit(True)})
    logits = [c.column(F.array(m.column(v))) for c, m, v in zip(
        model.calibrate, (model.text, model.metadata), (text_view(), metadata_view()))]
    done = with_text_view(base).withColumns({"text_logit": logits[0], "metadata_logit": logits[1]})
    chance = lambda logit: F.round(1 / (1 + F.exp(-logit - shift)), 6)
    score = chance(F.col("text_logit") + F.col("metadata_logit") - model.prior)
    return unpacked(done, docs, names, {"text_score": chance(F.col("text_logit")),
                                        "metadata_score": chance(F.col("metadata_logit")), "score": score,
                                        "kept": score >= threshold})
