"""Splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethazard.catalog.base import DEFAULT, EV, KEY, LI, events, lines, query, split_sql
from fleethazard.operators.splits import (
    assign_split, check_split_partition, distinct_engines, expanding_folds, fit_split, split_engines, train_val_engines,
)

B = DEFAULT.backtest


@query("distinct_engines", "SELECT DISTINCT l_suppkey AS engine_id FROM lineitem ORDER BY 1")
def _(spark, d):
    return distinct_engines(lines(spark, d)).orderBy("engine_id")


@query("split_engines", f"WITH {EV}, {split_sql('ev')} SELECT * FROM sp")
def _(spark, d):
    return split_engines(events(spark, d))


@query("assign_split", f"WITH {LI}, {split_sql('li')} SELECT engine_id, cycle, split FROM li JOIN sp USING (engine_id)")
def _(spark, d):
    df = lines(spark, d)
    return assign_split(df.select(*KEY), fit_split(df))


@query("check_split_partition", f"""WITH {EV}, {split_sql('ev')},
  pe AS (SELECT engine_id, count(DISTINCT split) AS k, count(*) AS c FROM sp GROUP BY engine_id),
  al AS (SELECT DISTINCT engine_id, true AS known FROM ev)
  SELECT count(*) FILTER (WHERE k > 1) AS overlapping, count(*) FILTER (WHERE c > 1) AS repeated,
    count(*) FILTER (WHERE c IS NULL) AS uncovered, count(*) FILTER (WHERE known IS NULL) AS unknown
  FROM pe FULL JOIN al USING (engine_id)""")
def _(spark, d):
    return check_split_partition(split_engines(events(spark, d)), events(spark, d))


FOLDS = """en AS (SELECT engine_id, row_number() OVER (ORDER BY engine_id) - 1 AS place, count(*) OVER () AS n
    FROM (SELECT DISTINCT engine_id FROM ev)),
  fo AS (SELECT f::INTEGER AS fold, engine_id, CASE WHEN place < 40 + f * 10 THEN 'train' ELSE 'test' END AS role, place::INTEGER AS place
    FROM en, range(0, 3) t(f) WHERE 40 + f * 10 + 10 <= n AND place < 40 + f * 10 + 10)"""


@query("expanding_folds", f"WITH {EV}, {FOLDS} SELECT * FROM fo")
def _(spark, d):
    return expanding_folds(events(spark, d), B.n_folds, B.train_min_engines, B.test_engines_per_fold)


@query("train_val_engines", f"""WITH {EV}, {FOLDS}, nn AS (SELECT *, count(*) OVER (PARTITION BY fold, role) AS c,
    row_number() OVER (PARTITION BY fold, role ORDER BY place) AS i FROM fo)
  SELECT fold, engine_id, CASE WHEN role = 'train' AND c > 1 AND i > c - greatest(1, ceil(2e-1 * c)) THEN 'val' ELSE role END AS role, place FROM nn""")
def _(spark, d):
    folds = expanding_folds(events(spark, d), B.n_folds, B.train_min_engines, B.test_engines_per_fold)
    return train_val_engines(folds, B.val_ratio)
