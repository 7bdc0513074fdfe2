"""Registry of runnable queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethazard.operators.labeling import label_horizon
from fleethazard.operators.splits import assign_split, fit_split
from fleethazard.params import BacktestSpec, ModelSpec, PolicySpec, Profile, SHORT
from fleethazard.session import scratch  # noqa: F401  (for the query modules)
from fleethazard.sources.fleets import processed_fleet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RAW: dict[str, Query] = {}  # the same queries before rounding
ORACLES: dict[str, str] = {}

DEFAULT = Profile()
# random test signals do not reach the default precision
TRIAL = Profile(
    horizon_n=SHORT.horizon_n, window_l=SHORT.window_l, features=SHORT.features,
    policy=PolicySpec(target_recall=0.85, min_precision=0.05),
    models=ModelSpec(),
    backtest=BacktestSpec(),
)
EVENT_SIGNALS = [f"op_setting_{i}" for i in (1, 2, 3)] + [f"sensor_{i}" for i in (1, 2, 3)]
LINE_SIGNALS = [f"sensor_{i}" for i in (1, 2, 3, 4)]
KEY = ["engine_id", "cycle"]


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in places.items()})


def query(name: str, sql: str | None = None, doubles: Sequence[str] | dict[str, int] = (), places: int = 6):
    """Register a query; ``doubles`` are rounded alike on both sides."""
    digits = doubles if isinstance(doubles, dict) else {c: places for c in doubles}

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir), digits)

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name], RAW[name] = run, fn
        if sql is not None:
            fixes = ", ".join(f'round("{c}", {n}) + 0e0 AS "{c}"' for c, n in digits.items())
            ORACLES[name] = f"SELECT * REPLACE ({fixes}) FROM ({sql})" if fixes else sql
        return fn

    return register


# ---------------------------------------------------------------- test inputs, in Spark

def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_fleet(spark, sf_dir, "lineitem")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_fleet(spark, sf_dir, "events").drop("event_id")


def events_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_fleet(spark, sf_dir, "events")


def lines_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_horizon(lines(spark, sf_dir), DEFAULT.horizon_n, DEFAULT.window_l)


def events_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_horizon(events(spark, sf_dir), SHORT.horizon_n, SHORT.window_l)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two made-up models' scores of every labeled event, with ties, computed from its columns."""
    df = assign_split(events_labeled(spark, sf_dir), fit_split(events(spark, sf_dir)))
    near = 8.0 / (8.0 + F.col("remaining"))
    mix = lambda a, b, s: F.floor(1000.0 * (a * near + b * F.col(s) / (F.col(s) + 10.0))) / 1000.0
    models = F.array(
        F.struct(F.lit("a").alias("model"), mix(0.65, 0.35, "sensor_1").alias("y_proba")),
        F.struct(F.lit("b").alias("model"), mix(0.30, 0.70, "sensor_2").alias("y_proba")),
    )
    return df.select(*KEY, "label", "remaining", "split", F.inline(models))


def anomaly_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where(F.col("model") == "a").drop("model").withColumnRenamed("y_proba", "anomaly_score")


# ---------------------------------------------------------------- the same inputs, in SQL

EV = """ev AS (
  SELECT user_id AS engine_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
         hour(ts)::DOUBLE AS op_setting_1,
         CASE event_type WHEN 'view' THEN 1e0 WHEN 'click' THEN 2e0 WHEN 'signup' THEN 3e0
                         WHEN 'purchase' THEN 4e0 WHEN 'error' THEN 5e0 END AS op_setting_2,
         100e0 AS op_setting_3, value AS sensor_1,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_2,
         (minute(ts) * 60 + floor(second(ts)))::DOUBLE AS sensor_3, event_id
  FROM events)"""
LI = """li AS (
  SELECT l_suppkey AS engine_id,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS cycle,
         l_quantity AS sensor_1, l_extendedprice AS sensor_2, l_discount AS sensor_3, l_tax AS sensor_4
  FROM lineitem)"""


def labeled_sql(source: str, name: str, horizon: int, window_l: int) -> str:
    return f"""{name} AS (
  SELECT *, CAST(remaining > 0 AND remaining <= {horizon} AS INTEGER) AS label
  FROM (SELECT *, max(cycle) OVER (PARTITION BY engine_id) AS failure_cycle,
               max(cycle) OVER (PARTITION BY engine_id) - cycle AS remaining FROM {source})
  WHERE cycle >= {window_l})"""


EVL = f"{EV}, {labeled_sql('ev', 'evl', 8, 10)}"
LIL = f"{LI}, {labeled_sql('li', 'lil', 30, 50)}"


def split_sql(source: str, seed: int = 42) -> str:
    return f"""hr AS (
  SELECT engine_id, row_number() OVER (ORDER BY md5('{seed}:' || engine_id), engine_id) - 1 AS rk, count(*) OVER () AS n
  FROM (SELECT DISTINCT engine_id FROM {source})),
cut AS (SELECT *, floor(n * 7e-1) AS v, floor(n * 7e-1) + floor(n * 1.5e-1) AS t FROM hr),
sp AS (SELECT engine_id, CASE WHEN rk < v THEN 'train' WHEN rk < t THEN 'val' ELSE 'test' END AS split,
              CAST(rk + 1 - CASE WHEN rk < v THEN 0 WHEN rk < t THEN v ELSE t END AS BIGINT) AS split_rank FROM cut)"""


SC = f"""{EVL}, {split_sql('ev')}, sc AS (
  SELECT engine_id, cycle, label, remaining, split, 'a' AS model,
         floor(1e3 * (6.5e-1 * (8e0 / (8e0 + remaining)) + 3.5e-1 * sensor_1 / (sensor_1 + 1e1))) / 1e3 AS y_proba
  FROM evl JOIN sp USING (engine_id)
  UNION ALL
  SELECT engine_id, cycle, label, remaining, split, 'b' AS model,
         floor(1e3 * (3e-1 * (8e0 / (8e0 + remaining)) + 7e-1 * sensor_2 / (sensor_2 + 1e1))) / 1e3 AS y_proba
  FROM evl JOIN sp USING (engine_id))"""
AN = f"{SC}, an AS (SELECT engine_id, cycle, label, remaining, split, y_proba AS anomaly_score FROM sc WHERE model = 'a')"


def sweep_sql(group: Sequence[str] = ("model", "split"), source: str = "sc", score: str = "y_proba",
              ends: bool = False) -> str:
    """CTE ``sw``: one row per group and distinct score, running counts downwards."""
    g = ", ".join(group)
    extra = f" UNION ALL SELECT DISTINCT {g}, unnest([0e0, 1e0]) AS threshold, 0 AS pos, 0 AS n FROM {source}" if ends else ""
    return f"""gs AS (SELECT {g}, threshold, sum(pos) AS pos, sum(n) AS n FROM (
    SELECT {g}, {score} AS threshold, sum(label) AS pos, count(*) AS n FROM {source} GROUP BY ALL{extra}) GROUP BY ALL),
rs AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS predicted,
              sum(pos) OVER (PARTITION BY {g}) AS positives, sum(n) OVER (PARTITION BY {g}) AS total
       FROM gs WINDOW w AS (PARTITION BY {g} ORDER BY threshold DESC)),
sw AS (SELECT {g}, threshold, pos::BIGINT AS pos, n::BIGINT AS n, tp::BIGINT AS tp, (predicted - tp)::BIGINT AS fp,
              positives::BIGINT AS positives, total::BIGINT AS total,
              CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0e0 END AS precision,
              CASE WHEN positives > 0 THEN tp::DOUBLE / positives ELSE 0e0 END AS recall FROM rs)"""


AP_SQL = "sum(CASE WHEN positives > 0 THEN pos::DOUBLE / positives ELSE 0e0 END * precision)"
ROC_SQL = ("sum((n - pos) * (tp + tp - pos) / 2e0) / "
           "nullif(max(positives::DOUBLE * (total - positives)), 0)")


def feature_sql(signals: Sequence[str], source: str, windows: Sequence[int], stats: Sequence[str] = ("mean", "std"),
                lags: Sequence[int] = (1, 5), deltas: Sequence[int] = (1,), keep: Sequence[str] = ()) -> str:
    fn = {"mean": "avg", "std": "stddev_samp", "var": "var_samp", "sum": "sum", "min": "min", "max": "max",
          "count": "count", "median": "median"}
    cols = {}
    for s in signals:
        for w in windows:
            for t in stats:
                cols[f"{s}__roll{w}__{t}"] = f"CASE WHEN count({s}) OVER w{w} >= {w} THEN ({fn[t]}({s}) OVER w{w})::DOUBLE END"
        cols |= {f"{s}__lag{k}": f"lag({s}, {k}) OVER o" for k in lags}
        cols |= {f"{s}__delta{k}": f"{s} - lag({s}, {k}) OVER o" for k in deltas}
    select = ", ".join(["engine_id", "cycle", *keep, *[f'{cols[c]} AS "{c}"' for c in sorted(cols)]])
    frames = ", ".join([f"w{w} AS (PARTITION BY engine_id ORDER BY cycle ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
                        for w in windows] + ["o AS (PARTITION BY engine_id ORDER BY cycle)"])
    return f"SELECT {select} FROM {source} WINDOW {frames}"


def feature_columns(signals: Sequence[str], windows: Sequence[int], stats: Sequence[str] = ("mean", "std"),
                    lags: Sequence[int] = (1, 5), deltas: Sequence[int] = (1,)) -> list[str]:
    return sorted([f"{s}__roll{w}__{t}" for s in signals for w in windows for t in stats]
                  + [f"{s}__lag{k}" for s in signals for k in lags] + [f"{s}__delta{k}" for s in signals for k in deltas])


def feature_places(columns: Sequence[str]) -> dict[str, int]:
    """Deviations of prices carry fewer digits than the rest."""
    return {c: 3 if c.endswith(("__std", "__var")) else 5 for c in columns}
