"""Window functions along an engine, features and sequences."""

from __future__ import annotations


from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    DEFAULT, EV, EVENT_SIGNALS, EVL, KEY, LI, LIL, LINE_SIGNALS, SHORT,
    events, events_labeled, feature_columns, feature_places, feature_sql, lines, lines_labeled, query, split_sql,
)
from fleethazard.operators.features import build_tabular_features, feature_frame, last_window_features
from fleethazard.operators.labeling import with_failure_cycle
from fleethazard.operators.sequences import (
    CHUNK_ROWS, build_sequence_pipeline, engine_arrays, engine_position, extract_window, sequence_index, sequence_windows,
)
from fleethazard.operators.splits import split_engines
from fleethazard.params import FeatureSpec
from fleethazard.plans.scoring import latest_window_features
from fleethazard.plans.tables import training_table

S = SHORT.features
D = DEFAULT.features
LINE_FEATURES = feature_columns(LINE_SIGNALS, D.windows)
# sample deviations of prices: 12 significant digits leave 3 places beyond doubt
LINE_PLACES = {c: 3 if c.endswith("__std") else 5 for c in LINE_FEATURES}
LINE_ROLL = f"WITH {LI} SELECT * FROM ({feature_sql(LINE_SIGNALS, 'li', D.windows)}) WHERE cycle >= 50"


@query("fleet_risk_summary", f"""WITH {LIL}, f AS ({feature_sql(LINE_SIGNALS, "li", D.windows)}),
  j AS (SELECT f.*, label FROM f JOIN lil USING (engine_id, cycle))
  SELECT engine_id, count(*) AS n, sum(label)::BIGINT AS positives, avg(sensor_1__roll50__mean) AS quantity_level,
    avg(sensor_2__roll20__std) AS price_spread, avg(CASE WHEN label = 1 THEN sensor_1__roll10__mean END) AS quantity_before_end,
    max(abs(sensor_3__delta1)) AS largest_discount_step, avg(sensor_4__lag5) AS tax_lagged
  FROM j GROUP BY engine_id""",
       {"quantity_level": 6, "price_spread": 4, "quantity_before_end": 6, "largest_discount_step": 6, "tax_lagged": 6})
def _(spark, d):
    """Flagship: label, features and their per-engine summary, in one pass over the fleet."""
    table = training_table(lines(spark, d), DEFAULT)
    return table.groupBy("engine_id").agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("positives"),
        F.avg("sensor_1__roll50__mean").alias("quantity_level"), F.avg("sensor_2__roll20__std").alias("price_spread"),
        F.avg(F.when(F.col("label") == 1, F.col("sensor_1__roll10__mean"))).alias("quantity_before_end"),
        F.max(F.abs("sensor_3__delta1")).alias("largest_discount_step"), F.avg("sensor_4__lag5").alias("tax_lagged"))


ALL_STATS = ("mean", "std", "var", "sum", "min", "max", "median", "count")
STAT_COLUMNS = feature_columns(["sensor_1", "sensor_3"], (7,), ALL_STATS, (), ())


@query("rolling_stat", f"WITH {EV} {feature_sql(['sensor_1', 'sensor_3'], 'ev', (7,), ALL_STATS, (), ())}",
       # places at which no variance of such values can be a rounding tie
       {c: {"sensor_1__roll7__var": 5, "sensor_3__roll7__var": 2}.get(c, 3 if c.endswith("std") else 5) for c in STAT_COLUMNS})
def _(spark, d):
    df = events(spark, d).select(*KEY, "sensor_1", "sensor_3")
    return feature_frame(df, FeatureSpec(windows=(7,), stats=ALL_STATS, lags=(), deltas=()))


@query("rolling_with_gaps", f"""WITH {EV}, g AS (SELECT engine_id, cycle, CASE WHEN sensor_2 >= 10 THEN sensor_1 END AS sensor_1 FROM ev)
  {feature_sql(['sensor_1'], 'g', (3, 5))}""", feature_places(feature_columns(["sensor_1"], (3, 5))))
def _(spark, d):
    """Missing values inside frames: a statistic waits until its window is complete."""
    df = events(spark, d).select(*KEY, F.when(F.col("sensor_2") >= 10, F.col("sensor_1")).alias("sensor_1"))
    return feature_frame(df, FeatureSpec(windows=(3, 5)))


SPOILED = "CASE WHEN sensor_2 < 10 THEN NULL ELSE sensor_1 END"
SHIFTED = "sensor_1 + CASE WHEN cycle > 10 THEN 1e8 ELSE 0e0 END"


@query("rolling_nonfinite", f"""WITH {EV}, g AS (SELECT engine_id, cycle, {SPOILED} AS sensor_1 FROM ev)
  {feature_sql(['sensor_1'], 'g', (3, 5))}""", feature_places(feature_columns(["sensor_1"], (3, 5))))
def _(spark, d):
    """NaN and infinities inside frames count as missing, and are forgotten once the frame has passed them."""
    wild = F.when(F.col("sensor_2") < 5, float("nan")).when(F.col("sensor_2") < 10, float("inf")).otherwise(F.col("sensor_1"))
    return feature_frame(events(spark, d).select(*KEY, wild.alias("sensor_1")), FeatureSpec(windows=(3, 5)))


@query("rolling_level_shift", f"""WITH {EV}, g AS (SELECT engine_id, cycle, {SHIFTED} AS sensor_1 FROM ev)
  {feature_sql(['sensor_1'], 'g', (5,))}""", {c: 2 if c.endswith("std") else 4 for c in feature_columns(["sensor_1"], (5,))})
def _(spark, d):
    """A step of 1e8: deviations after it are those of the noise."""
    step = F.col("sensor_1") + F.when(F.col("cycle") > 10, 1e8).otherwise(0.0)
    return feature_frame(events(spark, d).select(*KEY, step.alias("sensor_1")), FeatureSpec(windows=(5,)))


LONG_WINDOWS, LONG_STATS = (10, 500, 5000), ("mean", "std", "sum", "min", "max", "count")
LONG_COLUMNS = feature_columns(["sensor_1", "sensor_3"], LONG_WINDOWS, LONG_STATS, (1,), ())


@query("rolling_long_windows", f"""WITH {LI}, lj AS (SELECT engine_id % 4 AS engine_id, engine_id * 100000 + cycle AS cycle, sensor_1, sensor_3 FROM li)
  {feature_sql(['sensor_1', 'sensor_3'], 'lj', LONG_WINDOWS, LONG_STATS, (1,), ())}""",
       {c: 4 if c.endswith("std") else 5 for c in LONG_COLUMNS})
def _(spark, d):
    """Suppliers joined to four long engines: windows up to 5,000 rows, over engines that are cut into blocks."""
    joined = (F.col("engine_id") % 4).alias("engine_id"), (F.col("engine_id") * 100_000 + F.col("cycle")).alias("cycle")
    df = lines(spark, d).select(*joined, "sensor_1", "sensor_3")
    return feature_frame(df, FeatureSpec(windows=LONG_WINDOWS, stats=LONG_STATS, lags=(1,), deltas=()))


@query("rolling_long_level_shift", f"""WITH {LI}, lj AS (SELECT engine_id % 4 AS engine_id, engine_id * 100000 + cycle AS cycle,
    CASE WHEN sensor_3 > 9.5e-2 AND cycle = 7 THEN NULL ELSE sensor_1 + CASE WHEN engine_id > 50 THEN 1e8 ELSE 0e0 END END AS sensor_1 FROM li)
  {feature_sql(['sensor_1'], 'lj', (500,), ('mean', 'std'), (), ())}""",
       {"sensor_1__roll500__mean": 4, "sensor_1__roll500__std": 2})
def _(spark, d):
    """A step of 1e8 and spoiled readings, in windows of 500 rows."""
    joined = (F.col("engine_id") % 4).alias("engine_id"), (F.col("engine_id") * 100_000 + F.col("cycle")).alias("cycle")
    spoiled = (F.col("sensor_3") > 0.095) & (F.col("cycle") == 7)
    value = F.when(spoiled, float("nan")).otherwise(F.col("sensor_1") + F.when(F.col("engine_id") > 50, 1e8).otherwise(0.0))
    df = lines(spark, d).select(*joined, value.alias("sensor_1"))
    return feature_frame(df, FeatureSpec(windows=(500,), stats=("mean", "std"), lags=(), deltas=()))


@query("lag_feature", f"WITH {LI} {feature_sql(LINE_SIGNALS, 'li', (), (), (1, 5), ())}", {
    c: 6 for c in feature_columns(LINE_SIGNALS, (), (), (1, 5), ())})
def _(spark, d):
    return feature_frame(lines(spark, d), FeatureSpec(windows=(), stats=(), lags=(1, 5), deltas=()))


@query("delta_feature", f"WITH {LI} {feature_sql(LINE_SIGNALS, 'li', (), (), (), (1,))}",
       {c: 6 for c in feature_columns(LINE_SIGNALS, (), (), (), (1,))})
def _(spark, d):
    return feature_frame(lines(spark, d), FeatureSpec(windows=(), stats=(), lags=(), deltas=(1,)))


@query("build_tabular_features", LINE_ROLL, LINE_PLACES)
def _(spark, d):
    return build_tabular_features(lines(spark, d), D, DEFAULT.window_l)


@query("build_tabular_features_frames", LINE_ROLL, LINE_PLACES)
def _(spark, d):
    """The same table from sliding frames."""
    return build_tabular_features(lines(spark, d), D, DEFAULT.window_l)


@query("training_table_labeled_history", f"""WITH {EVL}, f AS ({feature_sql(EVENT_SIGNALS, 'evl', S.windows,
       keep=['failure_cycle', 'remaining', 'label'])}) SELECT * FROM f WHERE cycle >= 10""",
       feature_places(feature_columns(EVENT_SIGNALS, S.windows)))
def _(spark, d):
    """Features built after labelling has dropped the first cycles: leading frames are null."""
    return training_table(events(spark, d), SHORT, "labeled")


@query("failure_cycle", f"WITH {LI} SELECT *, max(cycle) OVER (PARTITION BY engine_id) AS failure_cycle FROM li")
def _(spark, d):
    df = with_failure_cycle(lines(spark, d))
    return df.select(*KEY, *LINE_SIGNALS, "failure_cycle")


@query("engine_position", f"""WITH {LIL} SELECT engine_id, cycle,
  row_number() OVER (PARTITION BY engine_id ORDER BY cycle) - 1 AS end_pos FROM lil""")
def _(spark, d):
    return engine_position(lines_labeled(spark, d).select(*KEY))


@query("sequence_index", f"""WITH {LIL} SELECT * FROM (SELECT engine_id, cycle AS pred_cycle,
  row_number() OVER (PARTITION BY engine_id ORDER BY cycle) - 1 AS end_pos FROM lil) WHERE end_pos >= 49""")
def _(spark, d):
    return sequence_index(lines_labeled(spark, d), DEFAULT.window_l)


def _window_digest(windows, n):
    """Shape, corner values and per-window sums, which together pin a window's content and order."""
    weighted = F.aggregate(
        F.transform("window", lambda row, i: row[0].cast("double") * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return windows.select(
        "engine_id", "pred_cycle", "label", F.size("window").alias("n_rows"), F.size(F.col("window")[0]).alias("n_cols"),
        F.col("window")[0][0].cast("double").alias("first_value"),
        F.element_at("window", -1)[n - 1].cast("double").alias("last_value"), weighted.alias("weighted_sum"))


def _window_sql(source, signals, length, first, last):
    return f"""SELECT engine_id, cycle AS pred_cycle, label, {length}::INTEGER AS n_rows, {len(signals)}::INTEGER AS n_cols,
  first_value({first}::FLOAT::DOUBLE) OVER w AS first_value, {last}::FLOAT::DOUBLE AS last_value,
  sum({first}::FLOAT::DOUBLE * pos) OVER w - (pos - {length}) * sum({first}::FLOAT::DOUBLE) OVER w AS weighted_sum,
  count(*) OVER w AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle) AS pos FROM {source})
  WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW)"""


@query("sequence_windows", f"""WITH {EVL} SELECT * EXCLUDE (c) FROM ({_window_sql('evl', EVENT_SIGNALS, 10, 'op_setting_1', 'sensor_3')})
  WHERE c = 10""", {"first_value": 4, "last_value": 4, "weighted_sum": 3})
def _(spark, d):
    return _window_digest(sequence_windows(events_labeled(spark, d), EVENT_SIGNALS, 10), len(EVENT_SIGNALS))


ZS = ", ".join(f"({s} - (SELECT avg({s}) FROM tr)) / (SELECT CASE WHEN stddev_pop({s}) = 0 THEN 1e0 ELSE stddev_pop({s}) END FROM tr) AS {s}"
               for s in EVENT_SIGNALS)


@query("build_sequence_pipeline", f"""WITH {EVL}, {split_sql('ev')}, tr AS (SELECT evl.* FROM evl JOIN sp USING (engine_id) WHERE split = 'train'),
  z AS (SELECT engine_id, cycle, label, {ZS} FROM evl)
  SELECT * EXCLUDE (c) FROM ({_window_sql('z', EVENT_SIGNALS, 10, 'op_setting_1', 'sensor_3')}) WHERE c = 10""",
       {"first_value": 3, "last_value": 3, "weighted_sum": 2})
def _(spark, d):
    train = split_engines(events(spark, d)).where("split = 'train'")
    parts = build_sequence_pipeline(events_labeled(spark, d), train, SHORT.window_l)
    return _window_digest(parts["windows"], len(parts["feature_columns"]))


def _arrays_sql(rows):
    return f"""WITH {EVL}, ps AS (SELECT *, row_number() OVER (PARTITION BY engine_id ORDER BY cycle) - 1 AS pos FROM evl)
  SELECT engine_id, (pos // {rows} * {rows})::BIGINT AS start_pos, count(*)::INTEGER AS n, min(cycle) AS first_cycle,
    max(cycle) AS last_cycle, arg_min(sensor_1, cycle)::FLOAT::DOUBLE AS x_first, arg_max(sensor_3, cycle)::FLOAT::DOUBLE AS x_last,
    sum(label)::BIGINT AS positives, max(remaining)::DOUBLE AS first_remaining FROM ps GROUP BY ALL"""


def _arrays(spark, d, rows):
    arrays = engine_arrays(events_labeled(spark, d), EVENT_SIGNALS, chunk_rows=rows)
    n = len(EVENT_SIGNALS)
    return arrays.select(
        "engine_id", "start_pos", F.size("x").alias("n"), F.col("cycles")[0].alias("first_cycle"),
        F.element_at("cycles", -1).alias("last_cycle"), F.col("x")[0][EVENT_SIGNALS.index("sensor_1")].cast("double").alias("x_first"),
        F.element_at("x", -1)[n - 1].cast("double").alias("x_last"),
        F.aggregate("y", F.lit(0).cast("long"), lambda a, b: a + b).alias("positives"),
        F.col("remaining")[0].cast("double").alias("first_remaining"))


@query("engine_arrays", _arrays_sql(CHUNK_ROWS), ["x_first", "x_last"], 4)
def _(spark, d):
    return _arrays(spark, d, CHUNK_ROWS)


@query("engine_arrays_chunked", _arrays_sql(16), ["x_first", "x_last"], 4)
def _(spark, d):
    """Histories beyond a chunk come in several rows."""
    return _arrays(spark, d, 16)


@query("extract_window", f"""WITH {LI} SELECT engine_id, cycle, sensor_1::FLOAT::DOUBLE AS sensor_1, sensor_2::FLOAT::DOUBLE AS sensor_2
  FROM li WHERE engine_id = 3 AND cycle BETWEEN 51 AND 100""", ["sensor_1", "sensor_2"], 4)
def _(spark, d):
    window = extract_window(lines(spark, d), ["sensor_1", "sensor_2"], 3, 99, 50)
    return window.withColumns({c: F.col(c).cast("double") for c in ("sensor_1", "sensor_2")})


LAST_COLUMNS = feature_columns(EVENT_SIGNALS, S.windows)


@query("last_window_features", f"""WITH {EV}, f AS ({feature_sql(EVENT_SIGNALS, 'ev', S.windows)})
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) = 1""", feature_places(LAST_COLUMNS))
def _(spark, d):
    return last_window_features(events(spark, d), S, SHORT.window_l).drop("rows_seen")


@query("latest_window_features", f"""WITH {LI}, f AS ({feature_sql(LINE_SIGNALS, 'li', D.windows)})
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY cycle DESC) = 1""", LINE_PLACES)
def _(spark, d):
    """What `score_latest_windows` feeds to a model."""
    return latest_window_features(lines(spark, d), DEFAULT)


@query("short_window_features", f"""WITH {EV}, h AS (SELECT engine_id * 1000000 + (cycle - 1) // 2 AS engine_id, cycle, sensor_1 FROM ev)
  SELECT engine_id, max(cycle) AS cycle, avg(sensor_1) AS sensor_1__roll5__mean,
    CASE WHEN count(*) > 1 THEN stddev_samp(sensor_1) ELSE 0e0 END AS sensor_1__roll5__std FROM h GROUP BY engine_id""",
       {"sensor_1__roll5__mean": 5, "sensor_1__roll5__std": 4})
def _(spark, d):
    """Windows longer than the rows at hand are cut short: every engine in pieces of two cycles."""
    piece = F.expr("engine_id * 1000000 + (cycle - 1) div 2").alias("engine_id")
    df = events(spark, d).select(piece, "cycle", "sensor_1")
    return last_window_features(df, FeatureSpec(windows=(5,), lags=(), deltas=()), 10).drop("rows_seen")


@query("leakage_probe", f"""WITH {EV}, f AS ({feature_sql(['sensor_1'], 'ev', S.windows)}) SELECT * FROM f WHERE cycle <= 30""",
       feature_places(feature_columns(["sensor_1"], S.windows)))
def _(spark, d):
    """Features up to cycle 30 of a table whose later readings were all overwritten."""
    df = events(spark, d).select(*KEY, F.when(F.col("cycle") > 30, 9999.0).otherwise(F.col("sensor_1")).alias("sensor_1"))
    return feature_frame(df, S).where("cycle <= 30")
