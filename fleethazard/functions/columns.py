"""Which columns are signals, which are features, and how features are named."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: prefixes of signals, columns that are no features
SIGNAL_PREFIXES = ("op_setting_", "sensor_")
NOT_FEATURES = ("engine_id", "cycle", "label", "remaining", "failure_cycle")
# fixed values: the raw record layout
RAW_COLUMNS = ["engine_id", "cycle"] + [f"op_setting_{i}" for i in range(1, 4)] + [f"sensor_{i}" for i in range(1, 22)]


def signal_columns(df: DataFrame) -> list[str]:
    """Numeric signal columns, in table order."""
    found = [f.name for f in df.schema.fields
             if f.name.startswith(SIGNAL_PREFIXES) and isinstance(f.dataType, T.NumericType)]
    if not found:
        raise ValueError(f"table has no numeric column that starts with one of {SIGNAL_PREFIXES}")
    return found


def sequence_feature_columns(df: DataFrame) -> list[str]:
    """Signal columns in name order, whatever their type."""
    return sorted(c for c in df.columns if c.startswith(SIGNAL_PREFIXES))


def model_feature_columns(df: DataFrame, also_exclude: Iterable[str] = ()) -> list[str]:
    """Every column that is no key and no target, in name order (the order models are fitted in)."""
    skip = {*NOT_FEATURES, *also_exclude}
    return sorted(c for c in df.columns if c not in skip)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"table lacks the columns {missing}")


# fixed values: the formats of feature names
def roll_name(signal: str, window: int, stat: str) -> str:
    return f"{signal}__roll{window}__{stat}"


def lag_name(signal: str, k: int) -> str:
    return f"{signal}__lag{k}"


def delta_name(signal: str, k: int) -> str:
    return f"{signal}__delta{k}"
