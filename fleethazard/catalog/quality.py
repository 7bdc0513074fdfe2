"""Table checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethazard.catalog.base import (
    EV, EVENT_SIGNALS, EVL, KEY, LI, SHORT, events, events_in_order, events_labeled, feature_columns, feature_sql, lines, query,
)
from fleethazard.operators.features import feature_frame
from fleethazard.operators.quality import (
    check_expected_columns, check_monotonic_cycle, check_no_duplicates, check_sorted_by_key, validate_tabular_features,
)
from fleethazard.operators.scaling import fit_scaler, scaler_params, standardize
from fleethazard.operators.sequences import sequence_index, sequence_windows, validate_index, validate_sequences


@query("check_expected_columns", f"WITH {EV} SELECT count(*) AS n FROM ev")
def _(spark, d):
    df = events(spark, d)
    check_expected_columns(df, [*KEY, *EVENT_SIGNALS])
    return df.agg(F.count("*").alias("n"))


@query("check_no_duplicates", f"""WITH {LI} SELECT coalesce(sum(c), 0)::BIGINT AS duplicate_rows
  FROM (SELECT count(*) AS c FROM li GROUP BY engine_id, cycle HAVING count(*) > 1)""")
def _(spark, d):
    return check_no_duplicates(lines(spark, d))


@query("check_duplicate_orders", """SELECT coalesce(sum(c), 0)::BIGINT AS duplicate_rows
  FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(spark, d):
    """The same check on a key that is not unique."""
    return check_no_duplicates(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


MONO = """SELECT engine_id, sum(bad)::BIGINT AS violations FROM (SELECT engine_id,
  CASE WHEN c <= lag(c) OVER (PARTITION BY engine_id ORDER BY event_id) THEN 1 ELSE 0 END AS bad FROM x) GROUP BY engine_id HAVING sum(bad) > 0"""


@query("check_monotonic_cycle", f"WITH {EV}, x AS (SELECT engine_id, cycle AS c, event_id FROM ev) {MONO}")
def _(spark, d):
    """No rows: cycles follow the ingest order."""
    return check_monotonic_cycle(events_in_order(spark, d), "event_id")


@query("check_monotonic_readings", f"WITH {EV}, x AS (SELECT engine_id, floor(sensor_1)::BIGINT AS c, event_id FROM ev) {MONO}")
def _(spark, d):
    """A column that does go back."""
    df = events_in_order(spark, d).withColumn("cycle", F.floor("sensor_1"))
    return check_monotonic_cycle(df, "event_id")


@query("check_sorted_by_key", f"""WITH {EV} SELECT sum(bad)::BIGINT AS violations FROM (SELECT CASE WHEN
    engine_id < lag(engine_id) OVER o OR (engine_id = lag(engine_id) OVER o AND cycle < lag(cycle) OVER o) THEN 1 ELSE 0 END AS bad
    FROM ev WINDOW o AS (ORDER BY event_id))""")
def _(spark, d):
    """Events arrive in time order, which is far from key order."""
    return check_sorted_by_key(events_in_order(spark, d), "event_id")


NAMES = feature_columns(["sensor_1", "sensor_2"], SHORT.features.windows)


@query("validate_tabular_features", f"""WITH {EV}, g AS (SELECT engine_id, cycle, CASE WHEN sensor_2 >= 5 THEN sensor_1 END AS sensor_1, sensor_2 FROM ev),
  f AS ({feature_sql(["sensor_1", "sensor_2"], "g", SHORT.features.windows)}) """ + " UNION ALL ".join(
    f"""SELECT 'missing' AS "check", '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL AND cycle >= 10) AS violations FROM f
    UNION ALL SELECT 'non_finite', '{c}', count(*) FILTER (WHERE isinf("{c}")) FROM f""" for c in NAMES)
       + " UNION ALL SELECT 'duplicate_key', 'engine_id,cycle', 0")
def _(spark, d):
    df = events(spark, d).select(*KEY, F.when(F.col("sensor_2") >= 5, F.col("sensor_1")).alias("sensor_1"), "sensor_2")
    return validate_tabular_features(feature_frame(df, SHORT.features), SHORT.window_l)


@query("validate_sequences", f"""WITH {EVL}, b AS (SELECT engine_id, cycle, max((sensor_2 < 2)::INT) OVER w AS hole, count(*) OVER w AS c FROM evl
    WINDOW w AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
  SELECT count(*) AS n_windows, 0::BIGINT AS bad_shape, sum(hole)::BIGINT AS non_finite FROM b WHERE c = 10""")
def _(spark, d):
    df = events_labeled(spark, d)
    scaled = standardize(df, scaler_params(fit_scaler(df, ["sensor_1", "sensor_3"])))
    holes = scaled.withColumn("sensor_1", F.when(F.col("sensor_2") < 2, float("inf")).otherwise(F.col("sensor_1")))
    return validate_sequences(sequence_windows(holes, ["sensor_1", "sensor_3"], 10), 10, 2)


@query("validate_index", f"""WITH {EVL}, ix AS (SELECT engine_id + CASE WHEN engine_id < 5 THEN -1000 ELSE 0 END AS engine_id, cycle AS pred_cycle,
      row_number() OVER (PARTITION BY engine_id ORDER BY cycle) - 1 + CASE WHEN cycle = 30 THEN 500 WHEN cycle = 25 THEN -15 ELSE 0 END AS end_pos FROM evl
      QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY cycle) >= 10),
  t AS (SELECT engine_id, count(*) AS c FROM evl GROUP BY engine_id)
  SELECT * FROM (SELECT ix.engine_id, pred_cycle, end_pos, CASE WHEN c IS NULL THEN 'engine not found'
    WHEN end_pos < 0 OR end_pos >= c THEN 'end_pos out of range' WHEN end_pos < 9 THEN 'end_pos < window_length - 1' END AS reason
    FROM ix LEFT JOIN t ON ix.engine_id = t.engine_id) WHERE reason IS NOT NULL""")
def _(spark, d):
    """A sequence index with unknown engines and shifted positions."""
    df = events_labeled(spark, d)
    shift = F.when(F.col("pred_cycle") == 30, 500).when(F.col("pred_cycle") == 25, -15).otherwise(0)
    broken = sequence_index(df, 10).withColumn("end_pos", F.col("end_pos") + shift).withColumn(
        "engine_id", F.col("engine_id") + F.when(F.col("engine_id") < 5, -1000).otherwise(0))
    return validate_index(broken, df, 10)
