"""Exploration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    EV, EVENT_SIGNALS, EVL, KEY, LI, LIL, LINE_SIGNALS, events, events_labeled, lines, lines_labeled, query,
)
from fleethazard.operators import eda

DESCRIBE = ["mean", "std", "min", "max", "q25", "q50", "q75"]


def _describe_sql(x, source):
    return f"""SELECT count({x}) AS count, avg({x}) AS mean, stddev_samp({x}) AS std, min({x})::DOUBLE AS min, max({x})::DOUBLE AS max,
  quantile_cont({x}, 2.5e-1)::DOUBLE AS q25, quantile_cont({x}, 5e-1)::DOUBLE AS q50, quantile_cont({x}, 7.5e-1)::DOUBLE AS q75 FROM {source}"""


@query("engine_lifetime", f"WITH {LI} SELECT engine_id, max(cycle) AS lifetime FROM li GROUP BY engine_id")
def _(spark, d):
    return eda.engine_lifetime(lines(spark, d))


@query("eda_lifetime_describe", f"WITH {LI}, lt AS (SELECT max(cycle) AS lifetime FROM li GROUP BY engine_id) {_describe_sql('lifetime', 'lt')}", DESCRIBE)
def _(spark, d):
    return eda.describe(eda.engine_lifetime(lines(spark, d)), "lifetime")


@query("eda_missingness", f"""WITH {EV}, h AS (SELECT engine_id, cycle, {", ".join(
    f"CASE WHEN {s} >= {i * 5} THEN {s} END AS {s}" for i, s in enumerate(EVENT_SIGNALS))} FROM ev)
  SELECT * FROM ({" UNION ALL ".join(f"SELECT '{c}' AS column, avg(({c} IS NULL)::INT::DOUBLE) AS missing_share FROM h"
                                      for c in [*KEY, *EVENT_SIGNALS])}) ORDER BY missing_share DESC, 1 LIMIT 10""", ["missing_share"])
def _(spark, d):
    holes = [F.when(F.col(s) >= i * 5, F.col(s)).alias(s) for i, s in enumerate(EVENT_SIGNALS)]
    return eda.missingness(events(spark, d).select(*KEY, *holes))


@query("eda_label_distribution", f"""WITH {LIL} SELECT count(*) AS n, sum(label)::BIGINT AS positives, count(*) - sum(label)::BIGINT AS negatives,
  avg(label) AS positive_rate, (count(*) - sum(label))::DOUBLE / sum(label) AS imbalance FROM lil""", ["positive_rate", "imbalance"])
def _(spark, d):
    return eda.label_distribution(lines_labeled(spark, d))


@query("eda_positives_per_engine", f"WITH {LIL} SELECT engine_id, sum(label)::BIGINT AS positives FROM lil GROUP BY engine_id")
def _(spark, d):
    return eda.positives_per_engine(lines_labeled(spark, d))


@query("eda_positives_describe", f"WITH {EVL}, p AS (SELECT sum(label)::BIGINT AS positives FROM evl GROUP BY engine_id) {_describe_sql('positives', 'p')}", DESCRIBE)
def _(spark, d):
    return eda.describe(eda.positives_per_engine(events_labeled(spark, d)), "positives")


@query("eda_remaining_range", f"""WITH {LIL} SELECT min(remaining) AS min_remaining, max(remaining) AS max_remaining, count(*) AS rows_kept,
  (SELECT count(*) FROM li) AS rows_all FROM lil""")
def _(spark, d):
    return eda.remaining_range(lines_labeled(spark, d), lines(spark, d))


def _histogram_sql(x, source, bins):
    return f"""b AS (SELECT min({x})::DOUBLE AS lo, max({x})::DOUBLE - min({x})::DOUBLE AS wd FROM {source})
  SELECT bin, lo + bin * wd / {bins} AS low, lo + (bin + 1) * wd / {bins} AS high, count(*) AS count
  FROM (SELECT least(floor(({x} - lo) * {bins} / wd), {bins - 1})::BIGINT AS bin, lo, wd FROM {source}, b) GROUP BY bin, lo, wd"""


@query("eda_histogram_lifetime", f"WITH {LI}, lt AS (SELECT max(cycle) AS x FROM li GROUP BY engine_id), {_histogram_sql('x', 'lt', 30)}", ["low", "high"])
def _(spark, d):
    return eda.histogram(eda.engine_lifetime(lines(spark, d)), "lifetime", 30)


@query("eda_histogram", f"WITH {EV}, {_histogram_sql('sensor_1', 'ev', 30)}", ["low", "high"])
def _(spark, d):
    return eda.histogram(events(spark, d), "sensor_1", 30)


@query("eda_histogram_remaining", f"WITH {LIL}, ps AS (SELECT remaining AS x FROM lil WHERE label = 1), {_histogram_sql('x', 'ps', 30)}", ["low", "high"])
def _(spark, d):
    return eda.histogram(lines_labeled(spark, d).where("label = 1"), "remaining", 30)


PAIRS = [(a, b) for i, a in enumerate(EVENT_SIGNALS) for b in EVENT_SIGNALS[i + 1:]]
CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL ELSE corr({a}, {b}) END AS r FROM ev" for a, b in PAIRS)


@query("eda_correlation", f"WITH {EV} {CORR}", ["r"])
def _(spark, d):
    return eda.correlation(events(spark, d), EVENT_SIGNALS)


HOLES = {"sensor_1": "CASE WHEN cycle % 3 > 0 THEN sensor_1 END", "sensor_2": "CASE WHEN cycle % 5 > 0 THEN sensor_2 END",
         "sensor_3": "CASE WHEN engine_id % 2 = 0 THEN sensor_3 + 1e6 END"}


@query("eda_correlation_with_missing", f"WITH {EV}, x AS (SELECT engine_id, cycle, op_setting_3, {', '.join(f'{e} AS {c}' for c, e in HOLES.items())} FROM ev), "
       "p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN stddev_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER ({a} IS NOT NULL) > 0 THEN corr({a}, {b}) END AS r FROM x"
    for k, a in enumerate(["op_setting_3", *HOLES]) for b in ["op_setting_3", *HOLES][k + 1:]) + ") SELECT * FROM p", ["r"])
def _(spark, d):
    """Each pair over the rows that hold both values; one column is constant, one far from zero."""
    df = events(spark, d)
    return eda.correlation(df.select("op_setting_3", *[F.expr(e).alias(c) for c, e in HOLES.items()]), ["op_setting_3", *HOLES])


@query("eda_high_corr_pairs", f"""WITH {LI}, x AS (SELECT *, sensor_1 + sensor_4 AS sensor_5, sensor_2 * -2 + sensor_1 AS sensor_6 FROM li), c AS (""" + " UNION ALL ".join(
    f"SELECT 'sensor_{i}' AS a, 'sensor_{j}' AS b, corr(sensor_{i}, sensor_{j}) AS r FROM x" for i in range(1, 7) for j in range(i + 1, 7))
    + ") SELECT a, b, round(r, 3) AS r FROM c WHERE abs(r) > 9e-1", ["r"])
def _(spark, d):
    """Two derived sensors follow others closely."""
    df = lines(spark, d).withColumns({
        "sensor_5": F.col("sensor_1") + F.col("sensor_4"), "sensor_6": F.col("sensor_2") * -2 + F.col("sensor_1")})
    return eda.high_corr_pairs(df, [f"sensor_{i}" for i in range(1, 7)])


@query("eda_sensor_variability", f"WITH {EV} SELECT sensor, std, std < 1e-2 AS low_variance FROM ("
       + " UNION ALL ".join(f"SELECT '{s}' AS sensor, stddev_samp({s}) AS std FROM ev" for s in EVENT_SIGNALS) + ")", ["std"], 4)
def _(spark, d):
    return eda.sensor_variability(events(spark, d), EVENT_SIGNALS)


@query("eda_distinct_values", f"WITH {EV} SELECT count(*) AS n_rows, count(DISTINCT engine_id) AS n_engines, "
       + ", ".join(f"count(DISTINCT op_setting_{i}) AS n_op_setting_{i}" for i in (1, 2, 3)) + " FROM ev")
def _(spark, d):
    return eda.distinct_values(events(spark, d), ["op_setting_1", "op_setting_2", "op_setting_3"])


PROFILE = [f"{s}_{t}" for s in LINE_SIGNALS for t in ("mean", "std")]


@query("eda_degradation_profile", f"""WITH {LI}, a AS (SELECT *, max(cycle) OVER (PARTITION BY engine_id) - cycle AS cycles_to_failure FROM li)
  SELECT cycles_to_failure, {", ".join(f"avg({s}) AS {s}_mean, stddev_samp({s}) AS {s}_std" for s in LINE_SIGNALS)}
  FROM a WHERE cycles_to_failure < 50 GROUP BY cycles_to_failure""", PROFILE, 5)
def _(spark, d):
    return eda.degradation_profile(lines(spark, d), LINE_SIGNALS)


@query("eda_sample_series", f"""WITH {LI} SELECT engine_id, cycle, sensor_1, sensor_2, max(cycle) OVER (PARTITION BY engine_id) AS lifetime FROM li
  WHERE engine_id IN (SELECT DISTINCT engine_id FROM li ORDER BY 1 LIMIT 3)""")
def _(spark, d):
    return eda.sample_series(lines(spark, d), ["sensor_1", "sensor_2"])


@query("eda_histogram_positives", f"""WITH {EVL}, ps AS (SELECT sum(label)::BIGINT + engine_id % 7 AS x FROM evl GROUP BY engine_id), {_histogram_sql('x', 'ps', 20)}""",
       ["low", "high"])
def _(spark, d):
    """Positives per engine (shifted by engine, as gap-free engines all have the same number)."""
    per_engine = eda.positives_per_engine(events_labeled(spark, d)).withColumn("x", F.col("positives") + F.col("engine_id") % 7)
    return eda.histogram(per_engine, "x", 20)


@query("eda_histogram_settings", f"""WITH {EV}, st AS (SELECT op_setting_1 AS x FROM ev), {_histogram_sql('x', 'st', 30)}""", ["low", "high"])
def _(spark, d):
    return eda.histogram(events(spark, d), "op_setting_1", 30)


@query("eda_constant_histogram", f"WITH {EV} SELECT 15::BIGINT AS bin, 100e0 AS low, 9.95e1 + 16 * 1e0 / 30 AS high, count(*) AS count FROM ev", ["low", "high"])
def _(spark, d):
    """A constant setting falls into the middle bin of a unit range."""
    return eda.histogram(events(spark, d), "op_setting_3", 30)
