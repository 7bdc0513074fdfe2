import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleethazard.functions.columns import RAW_COLUMNS
from fleethazard.operators.eda import correlation
from fleethazard.operators.quality import (
    check_expected_columns, check_monotonic_cycle, require_monotonic_cycle, require_no_duplicates, require_sorted_by_key,
    require_valid_features, validate_tabular_features,
)
from fleethazard.operators.requests import parse_window_json, validate_window_request
from fleethazard.operators import scaling
from fleethazard.operators.scaling import all_finite, fit_median_imputer, fit_scaler, impute_median, median_params, scaler_params, standardize
from fleethazard.operators.sequences import (
    build_sequence_pipeline, engine_arrays, extract_window, require_valid_index, sequence_index, sequence_windows, validate_sequences,
)
from fleethazard.session import compiled_methods
from fleethazard.operators.splits import (
    assign_split, cap_engines_per_split, check_split_partition, expanding_folds, fit_split, semi_join_split, split_engines, train_val_engines,
)
from fleethazard.params import SplitSpec
from fleethazard.sources.tables import ingest_processed, scan_raw_sensor_text


def _engines(spark, ids):
    return spark.createDataFrame([(int(i),) for i in ids], "engine_id long")


def _lists(split):
    return {s: sorted(r.engine_id for r in split.where(F.col("split") == s).collect()) for s in ("train", "val", "test")}


def test_split_is_a_seeded_partition(spark):
    ids = _engines(spark, range(1, 101))
    a, again, other = (_lists(split_engines(ids, SplitSpec(seed=s))) for s in (42, 42, 123))
    assert a == again and a != other
    assert [len(a[s]) for s in ("train", "val", "test")] == [70, 15, 15]
    assert sorted(sum(a.values(), [])) == list(range(1, 101))
    assert set(check_split_partition(split_engines(ids), ids).first()) == {0}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_split_column_equals_split_table(spark, n):
    ids = _engines(spark, range(n))
    table = {r.engine_id: r.split for r in split_engines(ids).collect()}
    column = {r.engine_id: r.split for r in assign_split(ids, fit_split(ids)).collect()}
    assert table == column and len(table) == n


def test_split_errors(spark):
    with pytest.raises(ValueError, match="no engine to split"):
        split_engines(_engines(spark, [1]).limit(0))
    with pytest.raises(ValueError, match="not to 1"):
        split_engines(_engines(spark, [1]), SplitSpec(train=0.9))


def test_caps(spark):
    split = split_engines(_engines(spark, range(100)))
    capped = _lists(cap_engines_per_split(split, {"train": 5, "val": None, "test": 2}))
    assert [len(capped[s]) for s in ("train", "val", "test")] == [5, 15, 2]
    with pytest.raises(ValueError, match="no engine is left in split val"):
        cap_engines_per_split(split, {"val": 0})


def _fold_lists(folds):
    out = {}
    for r in folds.orderBy("fold", "place").collect():
        out.setdefault((r.fold, r.role), []).append(r.engine_id)
    return out


def test_folds(spark):
    folds = _fold_lists(expanding_folds(_engines(spark, np.random.default_rng(0).permutation(np.arange(1, 13))), 3, 4, 2))
    assert [folds[(i, "train")] for i in range(3)] == [list(range(1, 5)), list(range(1, 7)), list(range(1, 9))]
    assert [folds[(i, "test")] for i in range(3)] == [[5, 6], [7, 8], [9, 10]]
    short = _fold_lists(expanding_folds(_engines(spark, range(1, 8)), 10, 4, 2))
    assert short == {(0, "train"): [1, 2, 3, 4], (0, "test"): [5, 6]}


@pytest.mark.parametrize("ids,want", [(range(1, 11), ([*range(1, 9)], [9, 10])), ([1, 2], ([1], [2])), ([1], ([1], []))])
def test_validation_engines(spark, ids, want):
    rows = [(0, int(i), "train", k) for k, i in enumerate(ids)]
    got = _fold_lists(train_val_engines(spark.createDataFrame(rows, "fold int, engine_id long, role string, place int"), 0.2))
    assert (got.get((0, "train"), []), got.get((0, "val"), [])) == want


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    check_expected_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="not found"):
        check_expected_columns(df, ["a", "b", "c"])
    with pytest.raises(ValueError, match="not expected"):
        check_expected_columns(df, ["a"])


def _keys(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "engine_id long, cycle long, ord long")


def test_key_checks(spark):
    with pytest.raises(ValueError, match="2 rows .* duplicate"):
        require_no_duplicates(_keys(spark, [(1, 1), (1, 1)]))
    with pytest.raises(ValueError, match="monotonic"):
        require_monotonic_cycle(_keys(spark, [(1, 1), (1, 3), (1, 2)]), "ord")
    with pytest.raises(ValueError, match="key order"):
        require_sorted_by_key(_keys(spark, [(1, 1), (2, 1), (1, 2)]), "ord")
    good = _keys(spark, [(1, 1), (1, 2), (2, 1), (2, 2)])
    require_no_duplicates(good)
    require_monotonic_cycle(good, "ord")
    require_sorted_by_key(good, "ord")


def test_order_checks_across_blocks(spark):
    """Ordinals far apart put neighbours into different blocks."""
    rows = [(1, 5, 0), (1, 6, 70_000), (1, 4, 200_000), (2, 1, 900_000)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, ord long")
    assert [tuple(r) for r in check_monotonic_cycle(df, "ord").collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        require_sorted_by_key(df, "ord")


def test_feature_contract(spark):
    df = spark.createDataFrame([(1, 1, None, 1.0), (1, 2, 2.0, float("inf"))], "engine_id long, cycle long, f double, g double")
    out = {(r["check"], r["column"]): r.violations for r in validate_tabular_features(df, 1).collect()}
    assert out == {("missing", "f"): 1, ("missing", "g"): 0, ("non_finite", "f"): 0, ("non_finite", "g"): 1,
                   ("duplicate_key", "engine_id,cycle"): 0}
    with pytest.raises(ValueError, match="check failed"):
        require_valid_features(df, 1)
    with pytest.raises(ValueError, match="no features"):
        validate_tabular_features(df.select("engine_id", "cycle"), 1)


def test_scaler(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 2.0), (2, 1, 100.0), (2, 2, 200.0)], "engine_id long, cycle long, sensor_1 double")
    params = scaler_params(fit_scaler(df.where("engine_id = 1"), ["sensor_1"]))
    assert [r.sensor_1 for r in standardize(df, params).where("engine_id = 1").orderBy("cycle").collect()] == [-1.0, 1.0]
    flat = df.withColumn("sensor_1", F.lit(5.0))
    assert {r.sensor_1 for r in standardize(flat, scaler_params(fit_scaler(flat, ["sensor_1"]))).collect()} == {0.0}


def test_scaler_errors(spark):
    df = spark.createDataFrame([(1, 1, 0.0)], "engine_id long, cycle long, sensor_1 double")
    for columns, message in (([], "at least one feature"), (["x"], "lacks the columns"),):
        with pytest.raises(ValueError, match=message):
            fit_scaler(df, columns)
    with pytest.raises(ValueError, match="have no rows"):
        fit_scaler(df.limit(0), ["sensor_1"])
    with pytest.raises(ValueError, match="differ in length"):
        standardize(df, {"feature_columns": ["sensor_1"], "mean": [], "std": [1.0]})
    with pytest.raises(ValueError, match="described by"):
        standardize(df, {"mean": []})


@pytest.mark.parametrize("n", [1, 2, 9, 4000])
def test_medians_are_exact(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.round(rng.exponential(size=n), 2)})
    pdf.loc[rng.random(n) < 0.2, "a"] = np.nan
    pdf.loc[0, "a"] = 1.0
    if n > 2:
        pdf.loc[1, "c"] = np.inf
    got = median_params(fit_median_imputer(spark.createDataFrame(pdf), ["a", "b", "c"]))
    want = pdf.replace(np.inf, np.nan).median()
    assert all(got[c] == pytest.approx(want[c], abs=1e-12) for c in "abc")
    filled = impute_median(spark.createDataFrame(pdf), got).toPandas()
    assert np.isfinite(filled.to_numpy()).all()


def test_a_bracket_that_misses_the_middle_is_opened(spark, monkeypatch):
    """The sketch only narrows what is ordered: with one that is wrong for every feature the medians are still exact."""
    monkeypatch.setattr(scaling.F, "kll_sketch_get_quantile_double", lambda sketch, q: F.array(F.lit(7.0), F.lit(7.5)))
    df = spark.createDataFrame([(float(i % 5), float(i), -1.0) for i in range(100)], "a double, b double, c double")
    assert median_params(fit_median_imputer(df, ["a", "b", "c"])) == {"a": 2.0, "b": 49.5, "c": -1.0}


@pytest.mark.parametrize("bad", [None, float("nan"), float("-inf")])
def test_all_finite_sees_one_bad_value(spark, bad):
    df = spark.createDataFrame([(i, float(i), 1) for i in range(50)], "i int, a double, n int").repartition(3)
    assert all_finite(df, ["a", "n"]) and all_finite(df.where("i < 0"), ["a", "n"])
    spoiled = df.withColumn("a", F.when(F.col("i") != 31, F.col("a")).otherwise(F.lit(bad).cast("double")))
    assert not all_finite(spoiled, ["n", "a"]) and all_finite(spoiled, ["n"])


def test_compiled_methods_leave_the_setting_as_it_was(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), compiled_methods(spark):
        assert spark.conf.get(name) == "8000"
        raise KeyError
    assert spark.conf.get(name) == before


def test_median_of_nothing(spark):
    with pytest.raises(ValueError, match="no finite train value"):
        fit_median_imputer(spark.createDataFrame([(None,)], "a double"), ["a"])


@pytest.fixture
def ladder(spark):
    rows = [(1, c, c * 10.0, 0) for c in range(1, 6)]
    return spark.createDataFrame(rows, "engine_id long, cycle long, sensor_1 double, label int")


def test_windows(ladder):
    out = {r.pred_cycle: r for r in sequence_windows(ladder, ["sensor_1"], 3).collect()}
    assert sorted(out) == [3, 4, 5] and out[5].window == [[30.0], [40.0], [50.0]] and out[5].label == 0
    assert [tuple(r) for r in sequence_index(ladder, 3).orderBy("end_pos").collect()] == [(1, 3, 2), (1, 4, 3), (1, 5, 4)]
    with pytest.raises(ValueError, match="at least one row"):
        sequence_index(ladder, 0)


def test_extract_window(ladder):
    assert [r.sensor_1 for r in extract_window(ladder, ["sensor_1"], 1, 4, 3).orderBy("cycle").collect()] == [30.0, 40.0, 50.0]
    with pytest.raises(KeyError):
        extract_window(ladder, ["sensor_1"], 9, 4, 3)
    with pytest.raises(ValueError, match="out of range"):
        extract_window(ladder, ["sensor_1"], 1, 99, 3)
    with pytest.raises(ValueError, match="window_length - 1"):
        extract_window(ladder, ["sensor_1"], 1, 1, 3)


@pytest.mark.parametrize("end_pos,message", [(99, "out of range"), (1, "window_length - 1")])
def test_bad_index(spark, ladder, end_pos, message):
    index = spark.createDataFrame([(1, 3, end_pos)], "engine_id long, pred_cycle long, end_pos long")
    with pytest.raises(ValueError, match=message):
        require_valid_index(index, ladder, 3)
    require_valid_index(sequence_index(ladder, 3), ladder, 3)


def test_arrays_come_in_bounded_chunks(ladder):
    out = engine_arrays(ladder, ["sensor_1"], chunk_rows=2).orderBy("start_pos").collect()
    assert [(r.start_pos, r.cycles, [x[0] for x in r.x]) for r in out] == [
        (0, [1, 2], [10.0, 20.0]), (2, [3, 4], [30.0, 40.0]), (4, [5], [50.0])]


def test_sequence_pipeline(spark):
    rows = [(e, c, (e - 1) * 100.0 + c - 1, 0) for e in (1, 2) for c in range(1, 5)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, sensor_1 double, label int")
    parts = build_sequence_pipeline(df, _engines(spark, [1]), 3)
    assert parts["feature_columns"] == ["sensor_1"] and parts["index"].count() == 4
    mean = parts["scaled"].where("engine_id = 1").agg(F.avg("sensor_1")).first()[0]
    assert abs(mean) < 1e-9
    assert tuple(validate_sequences(parts["windows"], 3, 1).first()) == (4, 0, 0)
    with pytest.raises(ValueError, match="long enough"):
        build_sequence_pipeline(df, _engines(spark, [1]), 9)
    with pytest.raises(ValueError, match="no signal columns"):
        build_sequence_pipeline(df.drop("sensor_1"), _engines(spark, [1]), 3)


def test_semi_join_by_split(spark, ladder):
    split = spark.createDataFrame([(1, "val")], "engine_id long, split string")
    assert semi_join_split(ladder, split, "val").count() == 5 and semi_join_split(ladder, split, "train").count() == 0


def test_requests(spark):
    def body(n, value="0.0", key="sensor_1"):
        return '{"window": [' + ", ".join(f'{{"{key}": {value}}}' for _ in range(n)) + "]}"

    rows = [(1, body(50)), (2, body(49)), (3, body(50, "NaN")), (4, body(50, key="sensor_9")), (5, "no json")]
    parsed = parse_window_json(spark.createDataFrame(rows, "request_id long, body string"))
    got = {r.request_id: r.reject_reason for r in validate_window_request(parsed, ["sensor_1"], 50).collect()}
    assert got == {1: None, 2: "wrong length", 3: "not finite", 4: "missing keys", 5: "unreadable"}


def test_raw_text(spark, tmp_path):
    line = " ".join(["1", "1", *["0.5"] * 24])
    (tmp_path / "raw.txt").write_text(f"{line}  \n\n{line.replace('1 1', '1   2', 1)}\n")
    df = scan_raw_sensor_text(spark, str(tmp_path / "raw.txt"))
    assert df.columns == RAW_COLUMNS and [t for _, t in df.dtypes] == ["bigint"] * 2 + ["double"] * 24
    table = ingest_processed(spark, str(tmp_path / "raw.txt"), str(tmp_path / "out"))
    assert table.orderBy("cycle").select("cycle", "sensor_21").collect() == [(1, 0.5), (2, 0.5)]
    (tmp_path / "bad.txt").write_text("1 2 3\n")
    with pytest.raises(Exception, match="expected 26 fields"):
        scan_raw_sensor_text(spark, str(tmp_path / "bad.txt")).collect()
    (tmp_path / "word.txt").write_text(line.replace("0.5", "half", 1) + "\n")
    with pytest.raises(Exception, match="op_setting_1 is no double: half"):
        scan_raw_sensor_text(spark, str(tmp_path / "word.txt")).collect()
    (tmp_path / "twice.txt").write_text(f"{line}\n{line}\n")
    with pytest.raises(ValueError, match="duplicate"):
        ingest_processed(spark, str(tmp_path / "twice.txt"), str(tmp_path / "out2"))


def test_cells_are_counted_without_interpreted_arrays(spark):
    from fleethazard.operators.scaling import count_cells

    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (float("inf"), None)], "a double, b double")
    counted = count_cells(df, ["a", "b"], {"null": lambda v, i: v.isNull(), "own": lambda v, i: v == i + 1})
    assert {(r.test, r.column): r.n for r in counted.collect()} == {("null", "a"): 0, ("null", "b"): 2, ("own", "a"): 1, ("own", "b"): 1}
    assert "lambda" not in counted._jdf.queryExecution().toString()


def test_a_constant_stays_constant_over_many_partitions(spark):
    """Partial deviations merge with rounding errors; the scaler must not divide by them."""
    df = spark.range(10_000, numPartitions=17).select(
        F.col("id").alias("engine_id"), F.lit(1).cast("long").alias("cycle"), F.lit(100.1).alias("sensor_1"), F.rand(1).alias("sensor_2"))
    params = scaler_params(fit_scaler(df.where("engine_id % 3 = 0"), ["sensor_1", "sensor_2"]))
    assert params["std"][0] == 1.0 and params["std"][1] < 1.0
    assert correlation(df, ["sensor_1", "sensor_2"]).first().r is None


def test_feature_check_sees_the_row_order(spark):
    rows = [(1, 1, 0.5, 0), (1, 2, 0.5, 1), (2, 1, 0.5, 3), (1, 3, 0.5, 4)]
    df = spark.createDataFrame(rows, "engine_id long, cycle long, sensor_1__lag1 double, place long")
    found = {r["check"]: r["violations"] for r in validate_tabular_features(df, 1, ordinal="place").collect()}
    assert found == {"non_finite": 0, "missing": 0, "duplicate_key": 0, "row_order": 1}


@pytest.mark.parametrize("leaf,branch", [(16, 10), (3, 8), (5, 6)])
@pytest.mark.parametrize("start,step", [(0, 1), (-500, 1), (-(1 << 62), 1 << 53)])
def test_row_order_over_blocks(spark, monkeypatch, leaf, branch, start, step):
    """Steps down inside blocks, at their edges, across gaps and across zero; ordinals from one end of 64 bits to the other."""
    from fleethazard.operators import quality

    monkeypatch.setattr(quality, "LEAF_SHIFT", leaf)
    monkeypatch.setattr(quality, "BRANCH_SHIFT", branch)
    rng = np.random.default_rng(5)
    n = 900
    keys = [(int(e), int(c)) for e, c in zip(np.sort(rng.integers(0, 40, n)), rng.integers(0, 30, n))]
    rows = [(e, c, start + i * step) for i, (e, c) in enumerate(keys) if rng.random() < 0.8]
    want = sum(b[:2] < a[:2] for a, b in zip(rows, rows[1:]))
    df = spark.createDataFrame(rows, "engine_id long, cycle long, nth long").repartition(4)
    assert want > 100 and quality.check_sorted_by_key(df, "nth").first()["violations"] == want
    assert quality.check_sorted_by_key(df.limit(0), "nth").first()["violations"] == 0


@pytest.mark.parametrize("leaf,branch", [(16, 10), (3, 8)])
@pytest.mark.parametrize("start,step", [(0, 1), (-500, 1), (-(1 << 62), 1 << 53)])
def test_cycle_order_over_blocks(spark, monkeypatch, leaf, branch, start, step):
    """An engine's cycles against their order from one end of 64 bits to the other, without joining or broadcasting a table of blocks."""
    from fleethazard.operators import quality

    monkeypatch.setattr(quality, "LEAF_SHIFT", leaf)
    monkeypatch.setattr(quality, "BRANCH_SHIFT", branch)
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 9)), None if rng.random() < 0.1 else int(rng.integers(0, 30)), start + i * step) for i in range(900)]
    want, last = {}, {}
    for e, c, _ in rows:
        if c is not None and last.get(e) is not None and c <= last[e]:
            want[e] = want.get(e, 0) + 1
        last[e] = c
    df = spark.createDataFrame(rows, "engine_id long, cycle long, nth long").repartition(4)
    found = check_monotonic_cycle(df, "nth")
    assert dict(found.collect()) == want and sum(want.values()) > 100
    assert "Join" not in found._jdf.queryExecution().toString()


def test_correlation_equals_pairwise_deletion(spark):
    from fleethazard.operators.eda import comoments, correlation

    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(500, 6)), columns=list("abcdef"))
    pdf["b"] += 3 * pdf["a"]
    pdf["c"] = pdf["c"] * 1e-3 + 1e7  # far from zero
    pdf["d"] = 4.0
    pdf = pdf.mask(rng.random(pdf.shape) < 0.3)
    pdf["f"] = np.where(pdf["a"].isna(), 1.0, np.nan)  # never together with a
    pdf.loc[3, "e"] = np.inf
    want = pdf.replace(np.inf, np.nan).assign(c=pdf["c"] - 1e7).corr()
    df = spark.createDataFrame(pdf).repartition(5)
    got = correlation(df, list("abcdef")).collect()
    assert len(got) == 15
    for r in got:
        expected = want.loc[r.a, r.b]
        assert (r.r is None) if np.isnan(expected) else r.r == pytest.approx(expected, abs=1e-9)
    plan = comoments(df, list("abcdef"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(") == 2 and plan.count("MapInArrow") == 1  # partial and final, of a matrix each
    assert correlation(df.limit(0), list("ab")).count() in (0, 1)
