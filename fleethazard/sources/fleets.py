"""Sensor histories cut from general tables: orders shipped per supplier, events per user.

A cycle is the row's rank in time within its engine. A hot engine is ranked in
blocks of time (a supplier's ship days, a user's hours), each block starting
where the counts of the blocks before it end, so no engine is sorted by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleethazard.operators.ordered import lookup_join
from fleethazard.session import shared_dir

HOT_ROWS = 1_000_000  # engines with more rows are ranked block by block

# event type codes
EVENT_CODES = {"view": 1.0, "click": 2.0, "signup": 3.0, "purchase": 4.0, "error": 5.0}


def number_cycles(df: DataFrame, block: Column, order: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``cycle``: 1-based rank by ``order`` within ``engine_id``. ``block`` must not decrease along ``order``."""
    hot = df.groupBy("engine_id").agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows).select("engine_id")
    if hot.isEmpty():
        w = Window.partitionBy("engine_id").orderBy(*order)
        return df.withColumn("cycle", F.row_number().over(w).cast("long"))

    # at most rows / hot_rows engines are hot
    marked = lookup_join(df, hot.withColumn("_hot", F.lit(True)), ["engine_id"], "left")
    blocked = marked.withColumn("_block", F.when(F.col("_hot"), block.cast("long")).otherwise(0)).drop("_hot")
    ahead = Window.partitionBy("engine_id").orderBy("_block")
    starts = (
        blocked.groupBy("engine_id", "_block").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.sum("_n").over(ahead) - F.col("_n")).drop("_n")
    )
    w = Window.partitionBy("engine_id", "_block").orderBy(*order)
    return (
        lookup_join(blocked, starts, ["engine_id", "_block"])
        .withColumn("cycle", (F.col("_start") + F.row_number().over(w)).cast("long"))
        .drop("_block", "_start")
    )


def lineitem_fleet(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Engine = supplier, cycle = shipment order, four sensors."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_suppkey", "engine_id")
    day = F.unix_date(F.to_date("l_shipdate"))
    ranked = number_cycles(rows, day, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], hot_rows)
    return ranked.select(
        "engine_id", "cycle",
        F.col("l_quantity").alias("sensor_1"),
        F.col("l_extendedprice").alias("sensor_2"),
        F.col("l_discount").alias("sensor_3"),
        F.col("l_tax").alias("sensor_4"),
    )


def events_fleet(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Engine = user, cycle = event order, three settings (one constant) and three sensors; keeps ``event_id``."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("user_id", "engine_id")
    hour = F.unix_date(F.to_date("ts")) * 24 + F.hour("ts")
    ranked = number_cycles(rows, hour, ["ts", "event_id"], hot_rows)
    codes = F.create_map(*[F.lit(x) for pair in EVENT_CODES.items() for x in pair])
    return ranked.select(
        "engine_id", "cycle",
        F.hour("ts").cast("double").alias("op_setting_1"),
        codes[F.col("event_type")].alias("op_setting_2"),
        F.lit(100.0).alias("op_setting_3"),
        F.col("value").alias("sensor_1"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_2"),
        (F.minute("ts") * 60 + F.second("ts")).cast("double").alias("sensor_3"),
        "event_id",
    )


_FLEETS = {"lineitem": lineitem_fleet, "events": events_fleet}
_written: dict[tuple[str, str, str], str] = {}


def processed_fleet(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The fleet as a key-ordered Parquet table in the shared folder, written once per application.

    Cycles are numbered once, and every operator starts from a columnar scan it can prune.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = f"{shared_dir(spark)}/fleets/{key[0]}/{len(_written)}-{kind}"
        ordered = _FLEETS[kind](spark, sf_dir).repartitionByRange("engine_id", "cycle")
        ordered.sortWithinPartitions("engine_id", "cycle").write.mode("overwrite").parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])
