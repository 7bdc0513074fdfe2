"""What the corpus operators share: carrying extra columns, text expressions, and per-document word lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"  # \x20 and \x09-\x0D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


BATCH_BYTES = 4 << 20  # of the Arrow batches in which texts go to Python and back


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches are from now on bounded by bytes. Spark bounds them by rows alone (10,000), so that a
    task's memory, in the JVM and in its Python worker, would grow with the length of the texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **named: str) -> DataFrame:
    """``df`` with the columns in ``named`` (new name -> old name) and all others in one struct ``rest``,
    so that no column of the caller can clash with those an operator adds."""
    others = [c for c in df.columns if c not in named.values()]
    rest = F.struct(*[field(c).alias(f"c{i}") for i, c in enumerate(others)]) if others else F.lit(0)
    return df.select(*[field(old).alias(new) for new, old in named.items()], rest.alias("rest"))


def unpacked(packed_df: DataFrame, original: DataFrame, named: dict[str, str], added: dict[str, Column]) -> DataFrame:
    """The columns of ``original`` in their order, then ``added``; an input column named like an added one gives way."""
    others = [c for c in original.columns if c not in named.values()]
    where = {c: F.col(f"rest.c{i}") for i, c in enumerate(others)} | {old: F.col(new) for new, old in named.items()}
    keep = [where[c].alias(c) for c in original.columns if c not in added]
    return packed_df.select(*keep, *[v.alias(k) for k, v in added.items()])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash128(value: Column) -> list[Column]:
    """Two 64-bit hashes of a string, so that distinct strings don't meet at any realistic corpus size."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(7), value).alias("h2")]


def words_of(text: Column, separators: str = "[\\x20\\x09-\\x0D]+") -> Column:
    """The words between runs of ``separators`` (a Java pattern); null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators, -1), lambda w: w != "")


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
