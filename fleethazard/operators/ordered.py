"""Order-dependent building blocks that never put a whole engine, or a whole table, in one task.

Two situations occur:

* a frame of a few rows along one engine (rolling statistics, lags, windows):
  the engine is cut into blocks of cycle values and every block is led by the
  few rows that come before it (`with_halo`);
* a running total along a whole table (score sweeps, ranks, exact quantiles):
  the rows are range-partitioned, counted per partition, and every partition
  adds the totals of the partitions before it (`running_totals`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethazard.session import checkpointed, written

KEY, ORDER = "engine_id", "cycle"
BLOCK_SHIFT = 16  # a block spans 2**16 order values, so at most 65,536 rows of one engine
MAX_PARTS = 256  # value ranges a table of running totals is cut into
WHOLE_ROWS = 300_000  # a table of at most this many collapsed rows is summed in one pass per group
LOOKUP_CELLS = 2_000_000  # lookup tables of more cells are shuffled, however small their files are

_BLOCK, _HALO = "_block", "_halo"


def lookup_join(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a narrow lookup table, evaluated once: it is written to the shared folder, and its size there tells Spark whether it may
    be broadcast (``spark.sql.autoBroadcastJoinThreshold``). Files of sorted keys are many times smaller than their rows, so
    tables of more than ``LOOKUP_CELLS`` are never broadcast. Then both sides are shuffled, and adaptive execution splits the
    partitions of a hot key.
    """
    side = written(side, "lookup")
    if side.count() * len(side.columns) > LOOKUP_CELLS:  # its footers tell
        side = side.hint("merge")
    return df.join(side, list(on), how)


def _block_summary(df: DataFrame, keys: Sequence[str], order: str, shift: int) -> DataFrame:
    """One row per (keys, block): row count and rows of the same key in earlier blocks."""
    ahead = Window.partitionBy(*keys).orderBy(_BLOCK)
    return (
        df.select(*keys, F.shiftright(F.col(order).cast("long"), shift).alias(_BLOCK))
        .groupBy(*keys, _BLOCK)
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(ahead))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )


def _one_block(df: DataFrame, order: str, shift: int) -> bool:
    low, high = df.agg(F.min(order), F.max(order)).first()
    return low is None or (low >> shift) == (high >> shift)


def with_halo(df: DataFrame, rows: int, keys: Sequence[str] = (KEY,), order: str = ORDER,
              shift: int = BLOCK_SHIFT) -> tuple[DataFrame, list[str]]:
    """Cut every key into blocks; add to each block the ``rows`` rows that precede it.

    Returns the frame and the columns to partition a window by. Rows that were
    added carry ``_halo = true``: windows read them, results leave them out
    (`drop_halo`). The preceding rows are found by row count, not by order
    value, so gaps in the order column do no harm. ``(keys, order)`` must be
    unique, which bounds a block by ``2**shift`` rows.

    A scan of the order column alone tells whether any key reaches past one
    block; when none does, the frame stays as it is and costs one exchange.
    Where order values are so sparse that the added rows would outweigh the
    rest, neighbouring blocks are merged by row count first.
    """
    keys = list(keys)
    if _one_block(df, order, shift):
        return df.withColumn(_HALO, F.lit(False)), keys

    home = df.withColumn(_BLOCK, F.shiftright(F.col(order).cast("long"), shift))
    if rows == 0:
        return home.withColumn(_HALO, F.lit(False)), keys + [_BLOCK]

    blocks = _block_summary(df, keys, order, shift)
    # a block receives `rows` rows, or all that come before it
    added, total = blocks.agg(F.sum(F.least(F.lit(rows), F.col("_start"))), F.sum("_n")).first()
    if 4 * added > total:
        home, blocks = _merge_blocks(home, blocks, keys, shift)
    following = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(1, rows)
    targets = (
        blocks.withColumn("_next", F.collect_list(F.struct(_BLOCK, "_start")).over(following))
        # every later block that starts fewer than `rows` rows after this one ends
        .withColumn("_next", F.filter("_next", lambda b: b["_start"] - F.col("_end") < rows))
        .where(F.size("_next") > 0)
        .select(*keys, _BLOCK, "_end", "_next")
    )
    newest = Window.partitionBy(*keys, _BLOCK).orderBy(F.col(order).desc())
    tails = (
        lookup_join(home, targets, [*keys, _BLOCK])
        .withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= rows)
        .withColumn("_to", F.explode("_next"))
        # row `_back` from the end sits at position `_end - _back`
        .where(F.col("_to._start") - F.col("_end") + F.col("_back") <= rows)
        .select(*df.columns, F.col("_to." + _BLOCK).alias(_BLOCK), F.lit(True).alias(_HALO))
    )
    return home.withColumn(_HALO, F.lit(False)).unionByName(tails), keys + [_BLOCK]


def _merge_blocks(home: DataFrame, blocks: DataFrame, keys: list[str], shift: int) -> tuple[DataFrame, DataFrame]:
    """Join neighbouring blocks that start within the same ``2**shift`` rows; a merged block has under twice as many."""
    chunk = F.shiftright("_start", shift).alias("_chunk")
    members = blocks.select(*keys, _BLOCK, chunk)
    merged = blocks.groupBy(*keys, chunk).agg(
        F.sum("_n").alias("_n"), F.max("_end").alias("_end"), F.min("_start").alias("_start"))
    return (
        lookup_join(home, members, [*keys, _BLOCK]).drop(_BLOCK).withColumnRenamed("_chunk", _BLOCK),
        merged.withColumnRenamed("_chunk", _BLOCK),
    )


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(_HALO)).drop(_HALO, _BLOCK)


def with_position(df: DataFrame, name: str = "end_pos", keys: Sequence[str] = (KEY,), order: str = ORDER,
                  shift: int = BLOCK_SHIFT) -> DataFrame:
    """0-based row position along each key: rows in earlier blocks plus the rank inside the block."""
    keys = list(keys)
    if _one_block(df, order, shift):
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumn(name, F.row_number().over(w).cast("long") - 1)
    blocked = df.withColumn(_BLOCK, F.shiftright(F.col(order).cast("long"), shift))
    starts = _block_summary(df, keys, order, shift).select(*keys, _BLOCK, "_start")
    w = Window.partitionBy(*keys, _BLOCK).orderBy(order)
    return (
        lookup_join(blocked, starts, [*keys, _BLOCK])
        .withColumn(name, F.col("_start") + F.row_number().over(w) - 1)
        .drop(_BLOCK, "_start")
    )


def _part_of(value: Column, cuts: list, first: int = 0) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, by bisection."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value > F.lit(cuts[middle]), _part_of(value, cuts[middle + 1:], first + middle + 1)).otherwise(
        _part_of(value, cuts[:middle], first))


def _parts(df: DataFrame, by: str, descending: bool) -> Column:
    """The part of a row as an expression of its value: cut points from a sketch, one for each shuffle partition, up to a bound."""
    n = min(MAX_PARTS, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cuts = df.agg(F.percentile_approx(by, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    part = _part_of(F.col(by), sorted(set(cuts)))
    return -part if descending else part


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, str],
                   group: Sequence[str] = (), by: str | None = None, descending: bool = False, at_rest: bool = False) -> DataFrame:
    """Running and overall sums along ``order``, exact for any distribution of values.

    ``sums`` maps a name to an integer column; the result gains ``name`` (the
    sum up to and including the row) and ``name_total``. ``order`` must be
    unique inside a group. Groups are few (models, splits, folds, features):
    the table of partition totals has at most one row per partition and group.

    If the order begins with a numeric column, ``by`` names it (``descending`` if
    the order is): equal values were collapsed before, so cut points on the value
    alone part the rows evenly, and a row's part is an expression. The rows are
    written once, unless they are read from such a table (``at_rest``); cut
    points, totals and running sums come from there. Up to ``WHOLE_ROWS`` rows
    need no cuts. Otherwise ties may be many; the rows are range-partitioned along the whole order and
    checkpointed, because those cut points come from a sample and a second
    evaluation could cut elsewhere.
    """
    group = list(group)
    if by is not None:
        df = df if at_rest else written(df, "running-totals")
        if df.count() <= WHOLE_ROWS:  # of a table at rest, its footers tell
            along = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            return df.withColumns({n: F.sum(c).over(along) for n, c in sums.items()}
                                  | {f"{n}_total": F.sum(c).over(Window.partitionBy(*group)) for n, c in sums.items()})
        cut = df.withColumn("_part", _parts(df, by, descending))
    else:
        cut = df.repartitionByRange(*group, *order) if group else df.repartitionByRange(*order)
        cut = checkpointed(cut.withColumn("_part", F.spark_partition_id()))

    inside = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = cut.groupBy(*group, "_part").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    offsets = offsets.select(
        *group, "_part",
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(whole).alias(f"{n}_total") for n in sums],
    )
    running = cut.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    return (
        lookup_join(running, offsets, [*group, "_part"])
        .withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums})
        .drop("_part", *[f"_o_{n}" for n in sums])
    )


def global_rank(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """1-based rank along a unique order, plus ``{name}_total``, the size of the group."""
    return running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, {name: "_one"}, group).drop("_one")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """Linear-interpolation quantiles per group: one row per (group, prob), columns ``prob, quantile``.

    Equal values are collapsed before they are ordered, so ties cost nothing.
    """
    group = list(group)
    n = F.sum(weight) if weight else F.count("*")
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(n.cast("long").alias("_n"))
    ranked = running_totals(counted, [F.col(value)], {"_upto": "_n"}, group, by=value)
    places = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), ((F.col("_upto_total") - 1) * F.lit(float(p))).alias("at"))
        for p in probs
    ])
    first = F.col("_upto") - F.col("_n")
    holds = lambda place: (place >= first) & (place < F.col("_upto"))
    low = lambda at: F.floor(at)
    high = lambda at: F.least(F.floor(at) + 1, F.col("_upto_total") - 1)
    wanted = F.filter(places, lambda q: holds(low(q["at"])) | holds(high(q["at"])))
    at = F.col("_q.at")
    picked = (
        ranked.withColumn("_q", F.explode(wanted))
        .groupBy(*group, F.col("_q.prob").alias("prob"))
        .agg(
            F.max(F.when(holds(low(at)), F.col(value))).alias("_low"),
            F.max(F.when(holds(high(at)), F.col(value))).alias("_high"),
            F.max(at - F.floor(at)).alias("_frac"),
        )
    )
    return picked.select(
        *group, "prob",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_frac")).cast("double").alias("quantile"),
    )
