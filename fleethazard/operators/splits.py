"""Train/val/test splits and expanding folds, always by engine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.operators.ordered import lookup_join
from fleethazard.params import SplitSpec

SPLITS = ("train", "val", "test")


def distinct_engines(df: DataFrame) -> DataFrame:
    return df.select("engine_id").distinct()


def engine_hash(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("engine_id").cast("string")))


def hash_rank(engines: DataFrame, seed: int) -> DataFrame:
    """0-based rank of every engine by its seeded hash, with the engine count.

    The first four hex digits cut the engines into 65,536 even buckets; the
    bucket counts (a table of fixed size) are summed in order and every bucket
    is ranked on its own.
    """
    hashed = engines.withColumn("_h", engine_hash(seed)).withColumn("_bucket", F.substring("_h", 1, 4))
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_bucket")
    starts = counts.select(
        "_bucket",
        (F.sum("_n").over(ahead) - F.col("_n")).alias("_start"),
        F.sum("_n").over(Window.partitionBy()).alias("n_engines"),
    )
    inside = Window.partitionBy("_bucket").orderBy("_h", "engine_id")
    return (
        hashed.join(F.broadcast(starts), "_bucket")  # 65,536 rows at most
        .withColumn("rank", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_start")
    )


def _check_ratios(spec: SplitSpec) -> None:
    total = spec.train + spec.val + spec.test
    if abs(total - 1.0) > 1e-6:
        raise ValueError(f"split ratios add up to {total}, not to 1")


def _cuts(n: Column, spec: SplitSpec) -> tuple[Column, Column]:
    """Ranks at which val and test begin; products are truncated like int(n * ratio)."""
    n_train = F.floor(n.cast("double") * F.lit(spec.train))
    return n_train, n_train + F.floor(n.cast("double") * F.lit(spec.val))


def split_engines(engines: DataFrame, spec: SplitSpec = SplitSpec()) -> DataFrame:
    """``engine_id, split, split_rank`` (1-based place inside the split): seeded, disjoint, complete."""
    _check_ratios(spec)
    engines = distinct_engines(engines)
    if engines.isEmpty():
        raise ValueError("there is no engine to split")
    val_from, test_from = _cuts(F.col("n_engines"), spec)
    rank = F.col("rank")
    return hash_rank(engines, spec.seed).select(
        "engine_id",
        F.when(rank < val_from, "train").when(rank < test_from, "val").otherwise("test").alias("split"),
        (rank + 1 - F.when(rank < val_from, 0).when(rank < test_from, val_from).otherwise(test_from))
        .cast("long").alias("split_rank"),
    )


@dataclass(frozen=True)
class SplitCuts:
    """The split as two positions in hash order: (hash, engine) of the first val and the first test engine."""

    seed: int
    val: tuple[str, int] | None
    test: tuple[str, int] | None

    def column(self) -> Column:
        """The split of a row, from its engine id alone: no join, no shuffle."""
        place = F.struct(engine_hash(self.seed).alias("h"), F.col("engine_id").alias("e"))
        before = lambda cut: F.lit(True) if cut is None else (
            place < F.struct(F.lit(cut[0]).alias("h"), F.lit(cut[1]).cast("long").alias("e")))
        return F.when(before(self.val), "train").when(before(self.test), "val").otherwise("test")


def fit_split(engines: DataFrame, spec: SplitSpec = SplitSpec()) -> SplitCuts:
    """Find the two cuts; only two rows reach the driver."""
    _check_ratios(spec)
    engines = distinct_engines(engines)
    if engines.isEmpty():
        raise ValueError("there is no engine to split")
    val_from, test_from = _cuts(F.col("n_engines"), spec)
    rank = F.col("rank")
    found = (
        hash_rank(engines, spec.seed).where((rank == val_from) | (rank == test_from))
        .select("_h", "engine_id", (rank == val_from).alias("v"), (rank == test_from).alias("t")).collect()
    )
    place = lambda flag: next(((r["_h"], r["engine_id"]) for r in found if r[flag]), None)
    return SplitCuts(spec.seed, place("v"), place("t"))


def assign_split(df: DataFrame, cuts: SplitCuts) -> DataFrame:
    return df.withColumn("split", cuts.column())


def semi_join_split(df: DataFrame, split: DataFrame, name: str) -> DataFrame:
    """Rows whose engine belongs to split ``name``."""
    return lookup_join(df, split.where(F.col("split") == name).select("engine_id"), ["engine_id"], "left_semi")


def cap_engines_per_split(split: DataFrame, caps: dict[str, int | None]) -> DataFrame:
    """Keep the first ``caps[split]`` engines of each split list; a split left empty raises."""
    keep = F.lit(False)
    for name in SPLITS:
        cap = caps.get(name)
        keep = keep | ((F.col("split") == name) & (F.lit(True) if cap is None else F.col("split_rank") <= cap))
    capped = split.where(keep)
    present = {r["split"] for r in capped.select("split").distinct().collect()}
    for name in SPLITS:
        if name not in present:
            raise ValueError(f"no engine is left in split {name}")
    return capped


def check_split_partition(split: DataFrame, engines: DataFrame) -> DataFrame:
    """Counts that must all be zero: engines in two splits, engines without a split, strangers in the split."""
    all_engines = distinct_engines(engines).withColumn("_known", F.lit(True))
    per_engine = split.groupBy("engine_id").agg(F.count_distinct("split").alias("_k"), F.count("*").alias("_rows"))
    both = per_engine.join(all_engines, "engine_id", "full_outer")
    return both.agg(
        F.count_if(F.col("_k") > 1).alias("overlapping"),
        F.count_if(F.col("_rows") > 1).alias("repeated"),
        F.count_if(F.col("_rows").isNull()).alias("uncovered"),
        F.count_if(F.col("_known").isNull()).alias("unknown"),
    )


def expanding_folds(engines: DataFrame, n_folds: int, train_min_engines: int,
                    test_engines_per_fold: int) -> DataFrame:
    """``fold, engine_id, role, place``: fold i trains on the first ``min + i*k`` engines and tests on the next k.

    Only the first ``min + n_folds*k`` engine ids are ever needed, so they are
    taken as a sorted top list. A fold without its full test set is left out.
    """
    needed = train_min_engines + n_folds * test_engines_per_fold
    first = distinct_engines(engines).orderBy("engine_id").limit(needed)
    ranked = first.select("engine_id", (F.row_number().over(Window.orderBy("engine_id")) - 1).alias("place"),
                          F.count("*").over(Window.partitionBy()).alias("_n"))
    train_end = train_min_engines + F.col("fold") * test_engines_per_fold
    return (
        ranked.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
        .where((train_end + test_engines_per_fold <= F.col("_n")) & (F.col("place") < train_end + test_engines_per_fold))
        .select("fold", "engine_id", F.when(F.col("place") < train_end, "train").otherwise("test").alias("role"), "place")
    )


def train_val_engines(folds: DataFrame, val_ratio: float) -> DataFrame:
    """Turn the last max(1, ceil(ratio*n)) train engines of every fold into ``val``; a single engine stays train."""
    per_fold = Window.partitionBy("fold", "role")  # a fold holds a configured number of engines
    n = F.count("*").over(per_fold)
    n_val = F.greatest(F.lit(1), F.ceil(F.lit(float(val_ratio)) * n))
    nth = F.row_number().over(per_fold.orderBy("place"))
    is_val = (F.col("role") == "train") & (n > 1) & (nth > n - n_val)
    return folds.withColumn("_v", is_val).select(
        "fold", "engine_id", F.when(F.col("_v"), "val").otherwise(F.col("role")).alias("role"), "place")
