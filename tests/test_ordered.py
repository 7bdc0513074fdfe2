"""Blocks, halos, positions, running totals and quantiles against plain computations, with hot keys and gaps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleethazard.operators.ordered import drop_halo, exact_quantiles, global_rank, running_totals, with_halo, with_position


@pytest.fixture(scope="module")
def gappy(spark):
    """A hot engine with a third of the rows, sparse and dense stretches, and many short engines."""
    rng = np.random.default_rng(0)
    frames = []
    for engine in range(20):
        n = 400 if engine == 0 else 40
        steps = rng.choice([1, 1, 1, 3, 90], n)
        frames.append(pd.DataFrame({"engine_id": engine, "cycle": np.cumsum(steps), "x": rng.normal(size=n)}))
    return spark.createDataFrame(pd.concat(frames)).cache()


@pytest.mark.parametrize("shift", [3, 6, 16])
@pytest.mark.parametrize("rows", [0, 1, 7, 49])
def test_halo_gives_the_frames_of_the_whole_engine(gappy, rows, shift):
    whole = Window.partitionBy("engine_id").orderBy("cycle").rowsBetween(-rows, 0)
    want = gappy.select("engine_id", "cycle", F.collect_list("x").over(whole).alias("v"))
    cut, parts = with_halo(gappy, rows, shift=shift)
    w = Window.partitionBy(*parts).orderBy("cycle").rowsBetween(-rows, 0)
    got = drop_halo(cut.withColumn("v", F.collect_list("x").over(w))).select("engine_id", "cycle", "v")
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_blocks_bound_the_rows_of_a_window_partition(gappy):
    cut, parts = with_halo(gappy, 5, shift=4)
    home = cut.where("NOT _halo").groupBy(*parts).count().agg(F.max("count")).first()[0]
    added = cut.where("_halo").groupBy(*parts).count().agg(F.max("count")).first()[0]
    assert home < 2 * 16 and added <= 5


def test_sparse_order_values_do_not_multiply_the_rows(spark):
    """Gaps far wider than a block: blocks are merged, so few rows are added."""
    rows = [(e, i * 1000, float(i)) for e in (1, 2) for i in range(600)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, x double")
    cut, parts = with_halo(df, 9, shift=6)
    assert cut.where("_halo").count() < 0.2 * len(rows)
    assert cut.groupBy(*parts).count().agg(F.max("count")).first()[0] < 2 * 64 + 9
    whole = Window.partitionBy("engine_id").orderBy("cycle").rowsBetween(-9, 0)
    w = Window.partitionBy(*parts).orderBy("cycle").rowsBetween(-9, 0)
    want = df.select("engine_id", "cycle", F.sum("x").over(whole).alias("v"))
    got = drop_halo(cut.withColumn("v", F.sum("x").over(w))).select("engine_id", "cycle", "v")
    assert got.exceptAll(want).isEmpty() and got.count() == len(rows)


def test_one_block_needs_no_extra_columns(gappy):
    cut, parts = with_halo(gappy, 5)
    assert parts == ["engine_id"] and "_block" not in cut.columns


@pytest.mark.parametrize("shift", [3, 16])
def test_position(gappy, shift):
    want = gappy.toPandas().sort_values(["engine_id", "cycle"])
    want["end_pos"] = want.groupby("engine_id").cumcount()
    got = with_position(gappy, shift=shift).toPandas().sort_values(["engine_id", "cycle"])
    assert got["end_pos"].tolist() == want["end_pos"].tolist()


def test_running_totals_over_many_partitions(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "a", "b"], 5000), "k": rng.permutation(5000), "v": rng.integers(0, 9, 5000)})
    got = running_totals(spark.createDataFrame(pdf), [F.col("k").desc()], {"s": "v"}, ["g"]).toPandas()
    pdf = pdf.sort_values("k", ascending=False)
    pdf["s"] = pdf.groupby("g")["v"].cumsum()
    merged = got.merge(pdf, on=["g", "k"], suffixes=("", "_want"))
    assert (merged["s"] == merged["s_want"]).all() and len(merged) == 5000
    assert (merged["s_total"] == merged["g"].map(pdf.groupby("g")["v"].sum())).all()


def test_rank_of_a_table_where_a_third_of_the_scores_tie(spark):
    pdf = pd.DataFrame({"engine_id": np.arange(900) % 7, "cycle": np.arange(900), "s": np.where(np.arange(900) < 300, 0.5, np.arange(900) / 900)})
    got = global_rank(spark.createDataFrame(pdf), [F.col("s").desc(), F.col("engine_id"), F.col("cycle")]).toPandas()
    want = pdf.sort_values(["s", "engine_id", "cycle"], ascending=[False, True, True]).reset_index(drop=True)
    got = got.sort_values("rank")
    assert got["rank"].tolist() == list(range(1, 901))
    assert got["cycle"].tolist() == want["cycle"].tolist() and set(got["rank_total"]) == {900}


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_equal_numpy(spark, n):
    x = np.round(np.random.default_rng(n).exponential(size=n), 1)
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": x})), "x", probs).orderBy("prob").toPandas()
    assert np.allclose(got["quantile"], np.quantile(x, probs), rtol=0, atol=1e-12)


@pytest.mark.parametrize("whole", [0, 300_000])
def test_running_totals_along_values(spark, monkeypatch, whole):
    """Cut by value, or summed as a whole: the same sums, down and up, with a group that holds a single row."""
    from fleethazard.operators import ordered

    monkeypatch.setattr(ordered, "WHOLE_ROWS", whole)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": np.where(np.arange(3000) == 7, "c", rng.choice(["a", "b"], 3000)), "k": rng.permutation(3000) / 7.0, "v": rng.integers(0, 9, 3000)})
    for descending in (False, True):
        order = F.col("k").desc() if descending else F.col("k")
        got = running_totals(spark.createDataFrame(pdf), [order], {"s": "v"}, ["g"], by="k", descending=descending).toPandas()
        want = pdf.sort_values("k", ascending=not descending)
        want["s"] = want.groupby("g")["v"].cumsum()
        merged = got.merge(want, on=["g", "k"], suffixes=("", "_want"))
        assert (merged["s"] == merged["s_want"]).all() and len(merged) == 3000
        assert (merged["s_total"] == merged["g"].map(pdf.groupby("g")["v"].sum())).all()


def test_a_lookup_table_beyond_its_cells_is_not_broadcast(spark, monkeypatch):
    """Its file is far below Spark's broadcast threshold all the same."""
    from fleethazard.operators import ordered

    df, side = spark.range(5000), spark.range(0, 5000, 2).withColumn("x", F.col("id") + 1)
    assert "BroadcastHashJoin" in ordered.lookup_join(df, side, ["id"])._jdf.queryExecution().toString()
    monkeypatch.setattr(ordered, "LOOKUP_CELLS", 4000)
    for how, n in (("inner", 2500), ("left", 5000), ("left_semi", 2500)):
        joined = ordered.lookup_join(df, side, ["id"], how)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().toString() and joined.count() == n
