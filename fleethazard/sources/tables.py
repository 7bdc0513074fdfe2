"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethazard.functions.columns import RAW_COLUMNS
from fleethazard.functions.scalar import nonfinite_to_null
from fleethazard.operators.quality import check_expected_columns, require_no_duplicates
from fleethazard.session import remove


def scan_raw_sensor_text(spark: SparkSession, path: str, columns: Sequence[str] = tuple(RAW_COLUMNS)) -> DataFrame:
    """Headerless whitespace-delimited text: two integer key columns, then doubles.

    Blank lines and trailing blanks are tolerated; a value of the wrong type or
    a line of the wrong width fails the job. NaN and infinities become null.
    """
    fields = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    lines = spark.read.text(path).where(F.trim("value") != "").select(fields.alias("f"))
    width = F.when(F.size("f") == len(columns), F.col("f")).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {len(columns)} fields, got "), F.size("f").cast("string"))))

    def typed(i: int, kind: str) -> Column:
        text = F.col("f")[i]
        bad = F.raise_error(F.concat(F.lit(f"{columns[i]} is no {kind}: "), text))
        value = F.coalesce(text.try_cast(kind), bad.cast(kind))
        return (nonfinite_to_null(value) if kind == "double" else value).alias(columns[i])

    return lines.select(width.alias("f")).select(*[typed(i, "long" if i < 2 else "double") for i in range(len(columns))])


def write_raw_sensor_text(df: DataFrame, path: str) -> None:
    """The same layout, one row per line."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_parquet_table(df: DataFrame, path: str) -> DataFrame:
    """Write and return the table as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_key_ordered(df: DataFrame, path: str) -> DataFrame:
    """Write in (engine_id, cycle) order: range-partitioned files, each sorted, so key filters skip row groups."""
    ordered = df.repartitionByRange("engine_id", "cycle").sortWithinPartitions("engine_id", "cycle")
    return write_parquet_table(ordered, path)


def ingest_processed(spark: SparkSession, raw_path: str, out_path: str,
                     columns: Sequence[str] = tuple(RAW_COLUMNS)) -> DataFrame:
    """Raw text to the canonical table: typed, key-unique, key-ordered Parquet.

    With unique keys and sorted files, cycles are strictly increasing per
    engine by construction.
    """
    df = scan_raw_sensor_text(spark, raw_path, columns)
    check_expected_columns(df, columns)
    table = write_key_ordered(df, out_path)
    try:
        require_no_duplicates(table)  # on the Parquet: the text is parsed once
    except ValueError:
        remove(spark, out_path)
        raise
    return table


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_label_columns(spark: SparkSession, path: str) -> DataFrame:
    """Key and label, and ``remaining`` if the table has it."""
    table = spark.read.parquet(path)
    return table.select("engine_id", "cycle", "label", *(["remaining"] if "remaining" in table.columns else []))


def write_metrics_table(metrics_long: DataFrame, path: str) -> DataFrame:
    """The long metric report, as Parquet and as JSON lines beside it."""
    metrics_long.write.mode("overwrite").json(f"{path}/json")
    return write_parquet_table(metrics_long, f"{path}/parquet")
